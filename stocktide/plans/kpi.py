"""The KPI query library. Parameters have the defaults of a whole period; dates are inclusive.

Sales queries take any frame with the columns they name: the flat view where dimension attributes are asked
for, the fact table where they are not, so no join is paid that the answer does not need.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocktide.functions import fiscal
from stocktide.functions.numbers import as_double, count_where, percent, round_to, sum_where
from stocktide.operators.quantiles import exact_median
from stocktide.operators.shares import grand_total, share_of_groups
from stocktide.plans.finance import crore

Day = dt.date | str
FIRST_DAY, LAST_DAY = "0001-01-01", "9999-12-31"
DAY = "event_date_ist"


def period(df: DataFrame, date_from: Day, date_to: Day, day: str = DAY) -> DataFrame:
    return df.where(F.col(day).between(F.lit(date_from).cast("date"), F.lit(date_to).cast("date")))


def gross_by_channel(sales: DataFrame, calendar: DataFrame, fiscal_year: str = "FY27", fiscal_quarter: str = "Q1") -> DataFrame:
    """Sales of one fiscal quarter by channel with each channel's share.

    The calendar alone decides which days belong to the quarter: its labels are joined, a row per day, and its first and
    last day bound the scan as scalar subqueries.
    """
    quarter_days = calendar.where(
        (F.col("fiscal_year") == fiscal_year) & (F.col("fiscal_quarter") == fiscal_quarter)
    ).select(F.col("calendar_date").alias(DAY)).distinct()
    first, last = (quarter_days.agg(f(DAY)).scalar() for f in (F.min, F.max))
    bounded = sales.where((F.col(DAY) >= first) & (F.col(DAY) <= last))
    return _by_channel(bounded.join(quarter_days, DAY))


def gross_by_fiscal_quarter(sales: DataFrame, calendar: DataFrame) -> DataFrame:
    """Sales of every fiscal quarter of the calendar by channel, with each channel's share of its quarter."""
    days = calendar.select(F.col("calendar_date").alias(DAY), "fiscal_year", "fiscal_quarter").dropDuplicates([DAY])
    return _by_channel(sales.join(days, DAY), "fiscal_year", "fiscal_quarter")


def gross_by_channel_last_quarter(sales: DataFrame) -> DataFrame:
    """The same for the last complete fiscal quarter in the data, found by a scalar subquery on its latest day."""
    latest = as_of_date(sales).scalar()
    ended = F.date_add(latest, 1)
    end_year, quarter = fiscal.fiscal_end_year(ended), fiscal.fiscal_quarter_no(ended)
    start = F.add_months(fiscal.quarter_start(end_year, quarter), -3)
    return _by_channel(sales.where((F.col(DAY) >= start) & (F.col(DAY) < F.add_months(start, 3))))


def _by_channel(sales: DataFrame, *keys: str) -> DataFrame:
    """Sales by channel within each of the keys' groups, with the channel's share of its group."""
    grouped = sales.groupBy(*keys, F.col("channel_at_sale").alias("channel")).agg(
        F.count(F.lit(1)).alias("transaction_lines"),
        F.countDistinct("basket_id").alias("baskets"),
        F.sum("gross_sales_amount").alias("_gross"),
        F.sum("net_sales_amount").alias("_net"),
        F.sum("sales_amount_incl_tax").alias("_incl"),
    )
    return grouped.select(
        *keys, "channel", "transaction_lines", "baskets",
        as_double("_gross").alias("gross_sales_inr"), crore("_gross").alias("gross_sales_cr"),
        as_double("_net").alias("net_sales_inr"), as_double("_incl").alias("sales_incl_tax_inr"),
        share_of_groups("_gross", *keys).alias("pct_of_total"),
    ).orderBy(*keys, F.desc("gross_sales_inr"), "channel")


def as_of_date(sales: DataFrame) -> DataFrame:
    """Latest business day in the data: relative periods hang on it, not on the clock."""
    return sales.agg(F.max(DAY).alias("as_of_date"))


GROUPINGS = {
    "month": lambda: F.date_format(DAY, "yyyy-MM"),
    "fiscal_quarter": lambda: F.concat("fiscal_year", F.lit("-"), "fiscal_quarter"),
    "channel": lambda: F.col("channel_at_sale"),
    "category": lambda: F.col("product_category"),
    "region": lambda: F.col("warehouse_region"),
}


def sales_summary(flat: DataFrame, group_by: str = "month", date_from: Day = FIRST_DAY, date_to: Day = LAST_DAY) -> DataFrame:
    """All sales measures by a chosen grouping; an unknown grouping gives no rows."""
    group: Column = GROUPINGS[group_by]() if group_by in GROUPINGS else F.lit(None).cast("string")
    baskets = F.countDistinct("basket_id")
    gross = F.sum("gross_sales_amount")
    return (
        period(flat, date_from, date_to)
        .withColumn("grouping", group)
        .where(F.col("grouping").isNotNull())
        .groupBy("grouping")
        .agg(
            F.count(F.lit(1)).alias("transaction_lines"),
            baskets.alias("baskets"),
            as_double(gross).alias("gross_sales"),
            as_double(F.sum("discount_amount")).alias("discount"),
            as_double(F.sum("net_sales_amount")).alias("net_sales"),
            as_double(F.sum("tax_amount")).alias("tax"),
            as_double(F.sum("sales_amount_incl_tax")).alias("sales_incl_tax"),
            round_to(F.try_divide(as_double(gross), as_double(baskets)), 2).alias("avg_basket_value"),
            percent(count_where(F.col("is_late_arrival")), F.count(F.lit(1))).alias("pct_late_arriving"),
        )
        .orderBy("grouping")
    )


def units_sold(sales: DataFrame, date_from: Day = FIRST_DAY, date_to: Day = LAST_DAY) -> DataFrame:
    qty, unit = F.col("qty_original").cast("long"), F.col("uom_original")
    unknown = sum_where(qty, F.col("uom_unknown_flag"))
    return (
        period(sales, date_from, date_to)
        .groupBy(F.col("channel_at_sale").alias("channel"))
        .agg(
            F.sum(qty).alias("units_as_transacted"),
            sum_where(qty, unit == "EA").alias("units_known_eaches"),
            sum_where(qty, unit == "CS").alias("units_known_cases"),
            unknown.alias("units_unknown_uom"),
            percent(unknown, F.sum(qty)).alias("pct_unknown_uom"),
        )
        .orderBy(F.desc("units_as_transacted"), "channel")
    )


def units_in_eaches(sales: DataFrame, date_from: Day = FIRST_DAY, date_to: Day = LAST_DAY) -> DataFrame:
    converted = count_where(F.col("qty_eaches").isNotNull())
    return (
        period(sales, date_from, date_to)
        .groupBy(F.col("channel_at_sale").alias("channel"))
        .agg(
            F.sum("qty_eaches").alias("units_eaches"),
            F.count(F.lit(1)).alias("lines_total"),
            converted.alias("lines_converted"),
            percent(converted, F.count(F.lit(1))).alias("pct_coverage"),
            count_where(F.col("uom_unknown_flag")).alias("excluded_no_uom_in_feed"),
            count_where(F.col("uom_conversion_missing")).alias("excluded_sku_not_in_ref"),
        )
        .orderBy(F.desc_nulls_last("units_eaches"), "channel")
    )


def top_products(
    flat: DataFrame, top_n: int = 10, date_from: Day = FIRST_DAY, date_to: Day = LAST_DAY, sales: DataFrame | None = None
) -> DataFrame:
    """Best sellers. The share is of the whole window, so its total is taken before the limit; ``sales``, the same
    lines without their dimensions, spares the total the joins of the view."""
    window = period(flat, date_from, date_to)
    ranked = (
        window.groupBy("sku_code")
        .agg(
            F.min("product_name").alias("product_name"),
            F.min("product_category").alias("category"),
            F.min("product_is_chilled").alias("is_chilled"),
            F.count(F.lit(1)).alias("lines"),
            F.sum("gross_sales_amount").alias("_gross"),
            F.sum("qty_eaches").alias("units_eaches"),
        )
        .orderBy(F.desc("_gross"), "sku_code")
        .limit(top_n)
    )
    lines = window if sales is None else period(sales, date_from, date_to)
    whole = grand_total(lines, "gross_sales_amount")
    return ranked.select(
        "sku_code", "product_name", "category", "is_chilled", "lines", as_double("_gross").alias("gross_sales"),
        "units_eaches", percent("_gross", whole).alias("pct_of_window"),
    )


def top_outlets(flat: DataFrame, top_n: int = 10, date_from: Day = FIRST_DAY, date_to: Day = LAST_DAY) -> DataFrame:
    return (
        period(flat, date_from, date_to)
        .groupBy("outlet_code")
        .agg(
            F.min("outlet_name").alias("outlet_name"),
            F.min("channel_at_sale").alias("channel"),
            F.min("warehouse_region").alias("region"),
            F.countDistinct("basket_id").alias("baskets"),
            F.sum("gross_sales_amount").alias("_gross"),
        )
        .orderBy(F.desc("_gross"), "outlet_code")
        .limit(top_n)
        .select(
            "outlet_code", "outlet_name", "channel", "region", "baskets", as_double("_gross").alias("gross_sales"),
            round_to(F.try_divide(as_double("_gross"), as_double("baskets")), 2).alias("avg_basket_value"),
        )
    )


def top_categories(flat: DataFrame, date_from: Day = FIRST_DAY, date_to: Day = LAST_DAY) -> DataFrame:
    return (
        period(flat, date_from, date_to)
        .groupBy(F.col("product_category").alias("category"))
        .agg(F.countDistinct("sku_code").alias("skus_sold"), F.sum("gross_sales_amount").alias("_gross"))
        .select(
            "category", "skus_sold", as_double("_gross").alias("gross_sales"),
            share_of_groups("_gross").alias("pct_of_window"),
        )
        .orderBy(F.desc("gross_sales"), F.asc_nulls_last("category"))
    )


def order_value(orders: DataFrame, date_from: Day = FIRST_DAY, date_to: Day = LAST_DAY) -> DataFrame:
    """Order value by source system before and after the freight correction, for orders never deleted."""
    live = period(orders, date_from, date_to, "order_date").where(~F.col("is_deleted"))
    raw, corrected = F.col("_raw"), F.col("_corrected")
    sums = live.groupBy("source_system").agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum("order_value_gross").alias("_raw"),
        F.sum("order_value_gross_corrected").alias("_corrected"),
    )
    cents = live.select("source_system", (F.col("order_value_gross_corrected") * 100).cast("long").alias("_cents"))
    middle = exact_median(cents, ["source_system"], "_cents", "_median")
    return (
        sums.join(middle, "source_system", "left")
        .select(
            "source_system", "orders",
            crore("_raw").alias("gross_raw_cr"), crore("_corrected").alias("gross_corrected_cr"),
            round_to(
                F.try_divide(F.lit(100.0) * as_double(raw), as_double(corrected)) - F.lit(100.0), 2
            ).alias("inflation_removed_pct"),
            round_to(as_double(corrected) / F.col("orders"), 0).alias("avg_order_value"),
            round_to(F.col("_median") / F.lit(100.0), 0).alias("median_order_value"),
            share_of_groups("orders").alias("pct_of_orders"),
        )
        .orderBy(F.desc("gross_corrected_cr"), "source_system")
    )


def excursion_by_month(readings: DataFrame) -> DataFrame:
    """Share of valid readings above and below the band; missing readings are in neither part of the ratio."""
    missing, above, below = F.col("temp_reading_missing"), F.col("is_excursion"), F.col("is_below_band")
    valid = count_where(~missing)
    return (
        readings.groupBy(F.date_trunc("month", "reading_ts").cast("timestamp_ntz").alias("month"))
        .agg(
            F.count(F.lit(1)).alias("readings_total"),
            valid.alias("readings_valid"),
            percent(count_where(above), valid).alias("excursion_pct_above_band"),
            percent(count_where(below), valid).alias("below_band_pct"),
            percent(count_where(above | below), valid).alias("outside_band_pct"),
            percent(count_where(missing), F.count(F.lit(1))).alias("missing_reading_pct"),
        )
        .orderBy("month")
    )
