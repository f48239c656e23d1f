"""Proofs that some questions cannot be answered from the feeds."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocktide.functions.cleaning import seconds_between
from stocktide.functions.numbers import as_double, count_where, percent, ratio, round_to
from stocktide.operators.changes import HotKeys, by_heat, hot_keys
from stocktide.operators.quantiles import exact_median, exact_percentiles
from stocktide.plans.marts import STAGES

DAY_SECONDS = 86400.0


def distinct_per(df: DataFrame, key: str, **columns: str) -> DataFrame:
    """Distinct values of several columns for each key."""
    return df.groupBy(key).agg(*[F.countDistinct(c).alias(out) for out, c in columns.items()])


def mean_of(count: str, places: int):
    """Mean of a whole-number column from its exact sum."""
    return round_to(ratio(F.sum(count), F.count(count)), places)


def vehicle_spread(readings: DataFrame) -> DataFrame:
    """Routes and warehouses seen per vehicle: were they assignments, each would be near one."""
    per_vehicle = distinct_per(readings, "vehicle_registration", n_routes="route_code", n_warehouses="warehouse_code")
    routes = readings.agg(F.countDistinct("route_code").alias("n")).scalar()
    return per_vehicle.agg(
        F.count("vehicle_registration").alias("vehicles"),
        mean_of("n_routes", 1).alias("avg_routes_per_vehicle"),
        mean_of("n_warehouses", 1).alias("avg_warehouses_per_vehicle"),
        F.max("n_routes").alias("max_routes_per_vehicle"),
    ).select("*", routes.alias("routes_in_existence"))


def devices_on_many_vehicles(readings: DataFrame) -> DataFrame:
    return distinct_per(readings, "device_id", n_vehicles="vehicle_registration").where("n_vehicles > 1")


def negative_durations(cycles: DataFrame) -> DataFrame:
    negative = count_where(F.col("cycle_time_seconds") < 0)
    return cycles.where(F.col("cycle_time_seconds").isNotNull()).agg(
        F.count(F.lit(1)).alias("orders_with_both_scans"), negative.alias("negative_duration"),
        percent(negative, F.count(F.lit(1))).alias("pct_negative"),
    )


def plausible_durations(cycles: DataFrame) -> DataFrame:
    usable = cycles.where("is_cycle_time_plausible")
    days = lambda c: round_to(as_double(c) / F.lit(DAY_SECONDS), 1)
    middle = exact_median(usable, [], "cycle_time_seconds", "m").agg(F.max("m").alias("m")).scalar()
    return usable.agg(
        F.count(F.lit(1)).alias("plausible_orders"),
        F.min("cycle_time_seconds").alias("_lo"), F.max("cycle_time_seconds").alias("_hi"),
    ).select("plausible_orders", days(middle).alias("median_days"), days("_lo").alias("min_days"), days("_hi").alias("max_days"))


def items_per_journey(scans: DataFrame) -> DataFrame:
    """Distinct products and batches on orders that show all six stages: one journey would show one of each."""
    per_order = distinct_per(scans, "order_number", n_skus="sku_code", n_batches="batch_id", n_stages="event_type")
    return per_order.where(F.col("n_stages") == len(STAGES)).agg(
        mean_of("n_skus", 2).alias("avg_distinct_skus"), mean_of("n_batches", 2).alias("avg_distinct_batches"),
        F.count(F.lit(1)).alias("orders_with_all_6_stages"),
    )


def channel_changes(outlets: DataFrame) -> DataFrame:
    per_outlet = distinct_per(outlets, "outlet_code", n="channel")
    return per_outlet.agg(
        count_where(F.col("n") > 1).alias("outlets_appearing_to_change_channel"),
        F.count("outlet_code").alias("outlets_total"),
    )


NOISE_PROFILE = {
    "channel": "channel", "outlet_format": "outlet_format", "city": "city", "route_code": "route_code",
    "credit_limit": "credit_limit", "warehouse_code": "warehouse_code", "outlet_name": "outlet_name",
}


#: Up to so many versions an outlet's distinct values are held as sets; those of a busier one are counted as pairs.
MANY_VERSIONS = 1_000


def noise_profile(outlets: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Mean distinct values per attribute over outlets with more than two versions; a real attribute has one.

    Counted as pairs, a version is a row for each attribute and each of them stands in a hash table. As sets, versions stay
    one row and an outlet is one row of short sets. ``hot`` gives the ``hot_keys`` of over ``MANY_VERSIONS`` where a cheaper
    frame with all versions can tell them. Doubles are compared as text: a set holds every NaN.
    """
    versions = outlets.select("outlet_code", *NOISE_PROFILE)
    doubles = [c for c, t in versions.dtypes if t in ("float", "double")]
    versions = versions.withColumns({c: F.when(F.col(c) == 0, F.lit(0.0)).otherwise(F.col(c)).cast("string") for c in doubles})
    found = hot() if hot else hot_keys(versions, "outlet_code", MANY_VERSIONS)

    def counted(rows: DataFrame, distinct: Callable[[str], Column]) -> DataFrame:
        return rows.groupBy("outlet_code").agg(F.count(F.lit(1)).alias("_versions"), *[distinct(c).alias(c) for c in NOISE_PROFILE])

    per_outlet = by_heat(
        versions, "outlet_code", found, lambda rows: counted(rows, lambda c: F.size(F.collect_set(c)).cast("long")), lambda rows: counted(rows, F.countDistinct)
    )
    return per_outlet.where("_versions > 2").agg(*[mean_of(c, 2).alias(f"avg_distinct_{c}") for c in NOISE_PROFILE])


def one_outlet(outlets: DataFrame, outlet_code: str) -> DataFrame:
    return outlets.where(F.col("outlet_code") == outlet_code).select(
        "outlet_code", "version_no", "channel", "outlet_format", "city", "route_code", "warehouse_code", "valid_from"
    ).orderBy("version_no")


def busiest_outlet(outlets: DataFrame) -> DataFrame:
    """Outlet with the most versions, as the worked example."""
    versions = outlets.groupBy("outlet_code").agg(F.count(F.lit(1)).alias("n"))
    return versions.orderBy(F.desc("n"), "outlet_code").limit(1).select("outlet_code")


def first_version_channels(outlets: DataFrame) -> DataFrame:
    return (
        outlets.where("version_no = 1")
        .groupBy(F.col("channel").alias("reliable_channel"))
        .agg(F.count(F.lit(1)).alias("outlets"))
        .orderBy(F.desc("outlets"), "reliable_channel")
    )


def reverse_share(scans: DataFrame, key: str) -> DataFrame:
    """Share of keys whose dispatch precedes their receipt, for any stitching key."""
    seen = lambda stage: F.min(F.when(F.col("event_type") == stage, F.col("event_ts")))
    both = scans.groupBy(key).agg(seen("RECEIVE").alias("a"), seen("DISPATCH").alias("b")).where("a IS NOT NULL AND b IS NOT NULL")
    reverse = count_where(seconds_between("a", "b") < 0)
    return both.agg(
        F.lit(key).alias("stitch_key"), F.count(F.lit(1)).alias("keys_with_both"), reverse.alias("reversed"),
        percent(reverse, F.count(F.lit(1))).alias("pct_reversed"),
    )


def order_noise_profile(orders: DataFrame) -> DataFrame:
    """Relation of gross, discount and tax on orders, and the tax rate they imply (percent, four decimals)."""
    gross, off, tax = "order_value_gross_corrected", "discount_amount", "tax_amount"
    rate = round_to(F.lit(100.0) * ratio(tax, gross), 4)
    scaled = orders.select(round_to(rate * 10000.0, 0).cast("long").alias("_rate"))
    spread = exact_percentiles(scaled, [], "_rate", {"lo": 0.0, "mid": 0.5, "hi": 1.0})
    one = lambda c: (spread.agg(F.max(c).alias(c)).scalar() / F.lit(10000.0))
    return orders.agg(
        F.count(F.lit(1)).alias("orders"),
        round_to(F.corr(as_double(gross), as_double(off)), 4).alias("corr_gross_discount"),
        round_to(F.corr(as_double(gross), as_double(tax)), 4).alias("corr_gross_tax"),
        count_where(F.col("order_value_net") < 0).alias("negative_net_orders"),
        as_double(F.min("order_value_net")).alias("lowest_net"),
    ).select(
        "*", one("lo").alias("min_tax_rate_pct"), one("mid").alias("median_tax_rate_pct"), one("hi").alias("max_tax_rate_pct")
    )


def negative_net_by_source(orders: DataFrame) -> DataFrame:
    negative = count_where(F.col("order_value_net") < 0)
    return orders.groupBy("source_system").agg(
        F.count(F.lit(1)).alias("orders"), negative.alias("negative_net"), percent(negative, F.count(F.lit(1)), 3).alias("pct_negative_net")
    )
