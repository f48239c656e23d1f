"""Star schema: versioned and static dimensions, four facts, and the flat sales view."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocktide.functions import cleaning as clean
from stocktide.functions import fiscal
from stocktide.operators.asof import asof_join
from stocktide.operators.changes import HotKeys, canonical_snapshot, validity_windows
from stocktide.operators.dedup import most_common

OUTLET_ATTRIBUTES = (
    "outlet_name", "channel", "outlet_format", "city", "route_code", "warehouse_code", "credit_limit",
    "credit_terms_days", "gst_number",
)
PRODUCT_ATTRIBUTES = (
    "product_name", "category", "brand", "case_pack", "mrp", "list_price", "gst_rate_pct", "shelf_life_days",
    "is_chilled",
)
STAGES = ("RECEIVE", "PUTAWAY", "PICK", "PACK", "STAGE", "DISPATCH")


def dim_outlet(history: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    return _versioned(history, "outlet_code", OUTLET_ATTRIBUTES, hot)


def dim_product(history: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    return _versioned(history, "sku_code", PRODUCT_ATTRIBUTES, hot)


def _versioned(history: DataFrame, key: str, attributes: tuple[str, ...], hot: HotKeys | None) -> DataFrame:
    return validity_windows(history, key, hot=hot).select(
        key, "version_no", *attributes, "is_deleted", "valid_from", "valid_to", "is_current"
    )


def dim_calendar(reference: DataFrame) -> DataFrame:
    return reference.withColumn("is_weekend", F.col("is_weekend").cast("boolean"))


def calendar_between(bounds: DataFrame, first: str = "first_day", last: str = "last_day") -> DataFrame:
    """The calendar by rule, for a one-row frame of bounds, where no reference file lists the days."""
    day = F.col("calendar_date")
    return bounds.select(F.explode(F.sequence(F.to_date(first), F.to_date(last))).alias("calendar_date")).select(
        day,
        fiscal.fiscal_year(day).alias("fiscal_year"),
        fiscal.fiscal_quarter(day).alias("fiscal_quarter"),
        fiscal.fiscal_month_no(day).alias("fiscal_month_no"),
        F.weekofyear(day).alias("iso_week"),
        F.date_format(day, "EEEE").alias("day_of_week"),
        F.weekday(day).isin(5, 6).alias("is_weekend"),
    )


def fct_sales(pos: DataFrame, uom: DataFrame) -> DataFrame:
    """One row per line with its money measures and, where convertible, its eaches.

    The case sizes are left to the planner: small they are broadcast, large they are shuffled and AQE splits a
    hot product.
    """
    factors = uom.select("sku_code", "eaches_per_case")
    unit, factor = "uom_original", "eaches_per_case"
    qty, price, off, tax = "qty_original", "unit_price", "discount_amount", "tax_amount"
    return pos.join(factors, "sku_code", "left").select(
        "txn_id", "txn_line_no", "basket_id", "outlet_code", F.col("channel").alias("channel_at_sale"), "sku_code",
        "event_ts_utc", "event_ts_ist", "event_date_ist", "is_late_arrival",
        "qty_original", "uom_original", "uom_unknown_flag", "eaches_per_case",
        clean.factor_missing(unit, factor).alias("uom_conversion_missing"),
        clean.in_eaches(qty, unit, factor).alias("qty_eaches"),
        "unit_price", "discount_amount", "tax_amount",
        clean.line_gross(qty, price).alias("gross_sales_amount"),
        clean.line_net(qty, price, off).alias("net_sales_amount"),
        clean.line_with_tax(qty, price, off, tax).alias("sales_amount_incl_tax"),
        "payment_mode", "promo_code", "source_file",
    )


#: Version of the outlet and of the product in force at the time of sale: the keys of the flat view's joins.
VERSION_KEYS = ("outlet_version_no", "product_version_no")


#: Stores a frame between two steps, so that the shuffled rows of the first are gone when the second begins.
Step = Callable[[DataFrame], DataFrame]


def with_versions(
    sales: DataFrame, outlets: DataFrame, products: DataFrame, days_from: DataFrame | None = None, step: Step = lambda df: df
) -> DataFrame:
    """The facts with the VERSION_KEYS, NULL where no version was in force.

    The point-in-time joins run once, when the fact is built, and carry a number instead of attributes. ``days_from`` is
    a cheaper frame that holds at least the keys and times of ``sales``. ``step`` keeps what each of the joins gives.
    """
    for dim, key, name in ((outlets, "outlet_code", VERSION_KEYS[0]), (products, "sku_code", VERSION_KEYS[1])):
        sales = step(asof_join(
            sales, dim, fact_key=key, fact_ts="event_ts_ist", version_key=key, attrs={name: "version_no"},
            spread=("txn_id", "txn_line_no"), days_from=days_from,
        ))
    return sales


def fct_cold_chain_readings(telemetry: DataFrame) -> DataFrame:
    celsius, missing = "temp_value_celsius", "temp_reading_missing"
    return telemetry.select(
        "device_id", "vehicle_registration", "telemetry_vendor", "firmware_version", "gateway_id",
        "route_code", "warehouse_code",
        F.col("reading_ts_corrected").alias("reading_ts"), "dt", celsius, missing,
        clean.above_band(celsius, missing).alias("is_excursion"),
        clean.below_band(celsius, missing).alias("is_below_band"),
        "humidity_pct", "door_open_flag", "battery_pct", "gps_lat", "gps_lon",
    )


def fct_orders(history: DataFrame) -> DataFrame:
    """One row per order: its latest non-deleted version. Net and tax arithmetic is kept but fit for no KPI."""
    net = F.col("order_value_gross_corrected") - F.col("discount_amount")
    return canonical_snapshot(history, "order_number").select(
        "order_number", "order_date", "requested_delivery_date", "order_status",
        "outlet_code", "warehouse_code", "route_code", "source_system", "line_count",
        "order_value_gross", "order_value_gross_corrected", "discount_amount", "tax_amount",
        net.cast("decimal(18,2)").alias("order_value_net"),
        (net + F.col("tax_amount")).cast("decimal(18,2)").alias("order_value_incl_tax"),
        F.col("is_ever_deleted").alias("is_deleted"),
        F.col("op_ts").alias("snapshot_op_ts"), F.col("seq").alias("snapshot_seq"),
    )


def stage_pivot(scans: DataFrame, key: str = "order_number") -> DataFrame:
    """First-seen time of each handling stage as a column, and how many distinct stages were seen."""
    first_seen = scans.groupBy(key, "event_type").agg(F.min("event_ts").alias("first_ts"))
    return first_seen.groupBy(key).agg(
        *[F.max(F.when(F.col("event_type") == s, F.col("first_ts"))).alias(f"{s.lower()}_ts") for s in STAGES],
        F.count(F.lit(1)).alias("n_stages_present"),
    )


def fct_warehouse_cycle_time(scans: DataFrame) -> DataFrame:
    """Diagnostic only: the scans do not belong to one journey."""
    owner = most_common(scans, "order_number", "warehouse_code", "dominant_warehouse_code")
    return stage_pivot(scans).join(owner, "order_number", "left").select(
        "order_number", "dominant_warehouse_code", *[f"{s.lower()}_ts" for s in STAGES], "n_stages_present",
        clean.seconds_between("receive_ts", "dispatch_ts").alias("cycle_time_seconds"),
        (F.col("dispatch_ts") >= F.col("receive_ts")).alias("is_cycle_time_plausible"),
    )


def _at_version(dim: DataFrame, key: str, version: str, attrs: Mapping[str, str]) -> DataFrame:
    """The attributes of a dimension under the key and version by which facts name them."""
    return dim.select(key, F.col("version_no").alias(version), *[F.col(c).alias(n) for n, c in attrs.items()])


#: Attributes of the versions in force at the time of sale, by their names in the flat view.
OUTLET_AT_SALE = {
    "outlet_name": "outlet_name", "outlet_gst_number": "gst_number", "outlet_warehouse_code": "warehouse_code",
    "outlet_is_deleted": "is_deleted",
}
PRODUCT_AT_SALE = {
    "product_name": "product_name", "product_category": "category", "product_is_chilled": "is_chilled",
    "product_case_pack": "case_pack", "product_mrp_at_sale": "mrp", "product_list_price_at_sale": "list_price",
    "product_is_deleted": "is_deleted",
}
FLAT_COLUMNS = (
    "txn_id", "txn_line_no", "basket_id",
    "event_ts_ist", "event_date_ist", "fiscal_year", "fiscal_quarter", "fiscal_month_no", "iso_week",
    "day_of_week", "is_weekend", "is_late_arrival",
    "outlet_code", "outlet_name", "outlet_gst_number", "outlet_warehouse_code", "outlet_version_no",
    "outlet_is_deleted",
    "warehouse_name", "warehouse_region", "warehouse_city",
    "channel_at_sale",
    "sku_code", "product_name", "product_category", "product_is_chilled", "product_case_pack",
    "product_mrp_at_sale", "product_list_price_at_sale", "product_version_no", "product_is_deleted",
    "qty_original", "uom_original", "uom_unknown_flag", "uom_conversion_missing", "eaches_per_case", "qty_eaches",
    "unit_price", "gross_sales_amount", "discount_amount", "net_sales_amount", "tax_amount",
    "sales_amount_incl_tax",
    "payment_mode", "promo_code", "source_file",
)


def rpt_sales_flat(
    sales: DataFrame,
    outlets: DataFrame,
    products: DataFrame,
    calendar: DataFrame,
    warehouses: DataFrame,
) -> DataFrame:
    """The facts with the dimension versions valid at the time of sale; only attributes fit for reporting.

    Same row count as ``sales``. The facts name their versions, so that both joins are equalities on a unique key: the
    planner broadcasts or shuffles them by size, AQE splits hot keys, and a join whose attributes nobody reads costs
    nothing that the optimizer can't see.
    """
    outlet = _at_version(outlets, "outlet_code", VERSION_KEYS[0], OUTLET_AT_SALE)
    product = _at_version(products, "sku_code", VERSION_KEYS[1], PRODUCT_AT_SALE)
    with_product = sales.join(outlet, ["outlet_code", VERSION_KEYS[0]], "left").join(
        product, ["sku_code", VERSION_KEYS[1]], "left"
    )
    return _on_day_and_site(with_product, calendar, warehouses).select(*FLAT_COLUMNS)


def _on_day_and_site(sales: DataFrame, calendar: DataFrame, warehouses: DataFrame) -> DataFrame:
    days = calendar.withColumnRenamed("calendar_date", "event_date_ist")
    sites = warehouses.select(
        F.col("warehouse_code").alias("outlet_warehouse_code"), "warehouse_name",
        F.col("region_name").alias("warehouse_region"), F.col("city").alias("warehouse_city"),
    )
    # One row per day: the calendar cannot outgrow a broadcast.
    return sales.join(F.broadcast(days), "event_date_ist", "left").join(sites, "outlet_warehouse_code", "left")


def line_columns(sales: DataFrame, columns: Sequence[str]) -> list[str]:
    """The columns of the facts that the flat view reads for ``columns``."""
    return [c for c in sales.columns if c in {*columns, "outlet_code", "sku_code", "event_ts_ist", "event_date_ist"}]


def attributes_at_sale(attributes: Mapping[str, str], columns: Sequence[str]) -> dict[str, str]:
    """Those of a dimension's attributes that ``columns`` of the flat view need, the site's key among them."""
    needed = {*columns, *(["outlet_warehouse_code"] if {"warehouse_name", "warehouse_region", "warehouse_city"} & {*columns} else [])}
    return {n: c for n, c in attributes.items() if n in needed}


def flat_columns(
    sales: DataFrame, outlets: DataFrame, products: DataFrame, calendar: DataFrame, warehouses: DataFrame, columns: Sequence[str],
    step: Step = lambda df: df,
) -> DataFrame:
    """``columns`` of ``rpt_sales_flat`` from facts without version keys, for one reader of few columns.

    The point-in-time joins carry the attributes themselves, so the lines are exchanged once for each dimension that is
    read and not again to fetch them. The outlet's comes last: it leaves the lines of a basket in one task. ``step`` keeps
    what the product's join gives, if there is one.
    """
    moments = sales  # keys and times do not change on the way
    for dim, key, version, attributes in (
        (products, "sku_code", VERSION_KEYS[1], PRODUCT_AT_SALE), (outlets, "outlet_code", VERSION_KEYS[0], OUTLET_AT_SALE),
    ):
        attrs = attributes_at_sale({**attributes, version: "version_no"}, columns)
        if attrs:
            sales = asof_join(sales, dim, fact_key=key, fact_ts="event_ts_ist", version_key=key, attrs=attrs, days_from=moments)
            sales = step(sales) if dim is products else sales
        elif "outlet_warehouse_code" in attributes:
            sales = sales.withColumn("outlet_warehouse_code", F.lit(None).cast("string"))
    return _on_day_and_site(sales, calendar, warehouses).select(*columns)
