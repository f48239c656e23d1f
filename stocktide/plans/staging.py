"""Staging: one cleaned table per feed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocktide.functions import cleaning as clean
from stocktide.functions.numbers import money
from stocktide.operators.changes import HotKeys, version_history
from stocktide.operators.dedup import keep_first


def stg_pos_transactions(raw: DataFrame) -> DataFrame:
    """One row per (transaction, line): first delivery wins; unit, business time and lateness made explicit."""
    first = keep_first(raw, ["txn_id", "txn_line_no"], ["ingest_date"])
    utc = clean.wall_clock("event_ts")
    day = clean.business_date(utc)
    return first.select(
        "txn_id", "txn_line_no", "basket_id", "outlet_code", "channel", "sku_code",
        utc.alias("event_ts_utc"),
        clean.business_time(utc).alias("event_ts_ist"),
        day.alias("event_date_ist"),
        clean.renamed("quantity_units", "qty").alias("qty_original"),
        F.col("uom").alias("uom_original"),
        F.col("uom").isNull().alias("uom_unknown_flag"),
        money("unit_price").alias("unit_price"),
        money("discount_amount").alias("discount_amount"),
        money("tax_amount").alias("tax_amount"),
        "payment_mode", "till_id", "cashier_id", "promo_code", "loyalty_id", "source_file", "ingest_date",
        clean.is_late("ingest_date", day).alias("is_late_arrival"),
    )


def stg_reefer_telemetry(raw: DataFrame) -> DataFrame:
    """One row per reading; identity is the device, its raw clock and its position."""
    first = keep_first(raw, ["device_id", "reading_ts", "gps_lat", "gps_lon"], ["dt"])
    unit = clean.resolved_unit("temp_unit", "telemetry_vendor")
    return first.select(
        "device_id", "telemetry_vendor", "firmware_version", "vehicle_registration", "route_code",
        "warehouse_code", "gateway_id",
        clean.deskew(clean.wall_clock("reading_ts"), "firmware_version").alias("reading_ts_corrected"),
        unit.alias("temp_unit_resolved"),
        clean.to_celsius("temp_value", unit).alias("temp_value_celsius"),
        F.col("temp_value").isNull().alias("temp_reading_missing"),
        "humidity_pct", "door_open_flag", "gps_lat", "gps_lon", "battery_pct", "dt",
    )


def stg_wms_scan_events(raw: DataFrame) -> DataFrame:
    first = keep_first(raw, ["scan_id"], ["dt"])
    return first.withColumn("event_ts", clean.wall_clock("event_ts"))


def change_rows(raw: DataFrame) -> DataFrame:
    """Typed change rows of a CDC feed, before any deduplication."""
    renamed = {"__op": F.col("__op").alias("op_type"), "__op_ts": clean.wall_clock("__op_ts").alias("op_ts"),
               "__seq": F.col("__seq").alias("seq")}
    return raw.select(*[renamed.get(c, F.col(c)) for c in raw.columns])


def stg_outlet_history(raw: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    return version_history(change_rows(raw), "outlet_code", hot=hot)


def stg_product_history(raw: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    rows = change_rows(raw).withColumns({"mrp": money("mrp"), "list_price": money("list_price")})
    return version_history(rows, "sku_code", hot=hot)


def stg_sales_order_header(raw: DataFrame) -> DataFrame:
    """Every order version; the inflated source is corrected next to its raw value."""
    rows = change_rows(raw).withColumns({
        "order_date": F.to_date("order_date"),
        "requested_delivery_date": F.to_date("requested_delivery_date"),
        "order_value_gross": money("order_value_gross"),
        "discount_amount": money("discount_amount"),
        "tax_amount": money("tax_amount"),
    })
    return version_history(rows, "order_number").withColumns({
        "order_value_gross_corrected": clean.deflated("order_value_gross", "source_system"),
        "is_deleted": clean.is_delete("op_type"),
    })
