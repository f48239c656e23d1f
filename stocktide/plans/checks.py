"""Checks of the built data: what the cleaning removed, what the histories look like, what must never happen."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocktide.functions import cleaning as clean
from stocktide.functions.numbers import count_where, percent, ratio, round_to, sum_where
from stocktide.operators.asof import moments_matched, window_defects
from stocktide.operators.changes import validity_windows
from stocktide.operators.quantiles import exact_percentiles


def row_counts(tables: Mapping[str, DataFrame], name: str = "model") -> DataFrame:
    """Row count per table as one frame."""
    counts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias(name), "row_count") for n, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def dedup_counts(pairs: Mapping[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Raw against staged rows; the difference is what deduplication removed."""
    raw = row_counts({n: r for n, (r, _) in pairs.items()}, "feed").withColumnRenamed("row_count", "raw_rows")
    staged = row_counts({n: s for n, (_, s) in pairs.items()}, "feed").withColumnRenamed("row_count", "staged_rows")
    return raw.join(staged, "feed").withColumn("removed_rows", F.col("raw_rows") - F.col("staged_rows"))


def late_rate(pos: DataFrame) -> DataFrame:
    """Late arrivals and the split of known units."""
    late, known = count_where(F.col("is_late_arrival")), F.count("uom_original")
    unit = lambda u: count_where(F.col("uom_original") == u)
    return pos.agg(
        F.count(F.lit(1)).alias("lines"), late.alias("late_lines"), percent(late, F.count(F.lit(1))).alias("pct_late"),
        count_where(F.col("uom_unknown_flag")).alias("unit_unknown"),
        percent(unit("EA"), known).alias("pct_eaches_of_known"), percent(unit("CS"), known).alias("pct_cases_of_known"),
    )


def telemetry_rates(telemetry: DataFrame) -> DataFrame:
    n, where = F.count(F.lit(1)), lambda c: count_where(c)
    return telemetry.agg(
        n.alias("readings"),
        percent(where(F.col("firmware_version") == clean.SKEWED_FIRMWARE), n).alias("pct_skewed_clock"),
        percent(where(F.col("temp_reading_missing")), n).alias("pct_missing"),
        percent(where(F.col("temp_unit_resolved") == "F"), n).alias("pct_fahrenheit"),
        where(F.col("temp_unit_resolved").isNull()).alias("unit_unresolved"),
    )


def null_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULLs per join column, one row per column, in one pass."""
    counts = df.agg(*[count_where(F.col(c).isNull()).alias(c) for c in columns])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_rows")) for c in columns])
    return counts.select(F.inline(rows))


def version_ties(history: DataFrame, key: str) -> DataFrame:
    """Keys and times at which more than one change is recorded."""
    return history.groupBy(key, "op_ts").agg(F.count(F.lit(1)).alias("versions")).where("versions > 1")


def extract_lag(history: DataFrame) -> DataFrame:
    lag = F.date_diff("extract_date", F.to_date("op_ts"))
    return history.groupBy("op_type").agg(
        F.count(F.lit(1)).alias("changes"), count_where(lag != 0).alias("lagging"),
        percent(count_where(lag != 0), F.count(F.lit(1))).alias("pct_lagging"), F.max(lag).alias("max_lag_days"),
    )


def delete_resurrection(history: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Deleted keys, those with a change after the deletion, and current versions among them (none may exist)."""
    position = F.struct("op_ts", "seq")
    deleted = clean.is_delete("op_type")
    keys = history.groupBy(key).agg(
        F.min(F.when(deleted, position)).alias("_deleted_at"), F.max(F.when(~deleted, position)).alias("_alive_at")
    ).where("_deleted_at IS NOT NULL")
    current = dimension.where("is_deleted AND is_current").agg(F.count(F.lit(1)).alias("n")).scalar()
    return keys.agg(
        F.count(F.lit(1)).alias("deleted_keys"),
        count_where(F.col("_alive_at") > F.col("_deleted_at")).alias("with_later_change"),
    ).select("*", current.alias("current_versions_of_deleted"))


def scd2_integrity(dimension: DataFrame, key: str, joined: DataFrame, version: str) -> DataFrame:
    """Overlapping windows, live keys without exactly one current version, facts without a version."""
    following = validity_windows(
        dimension.select(key, "version_no", F.col("valid_from").alias("op_ts"), "valid_to", F.lit("U").alias("op_type")).withColumnRenamed("valid_to", "_to"),
        key,
    )
    overlaps = following.where(~F.col("is_last_version") & (F.col("_to") > F.col("valid_to")))
    currents = dimension.groupBy(key).agg(
        count_where(F.col("is_current")).alias("n"), F.max("is_deleted").alias("gone")
    ).where(F.col("n") != F.when(F.col("gone"), 0).otherwise(1))
    count = lambda df: df.agg(F.count(F.lit(1)).alias("n")).scalar()
    return joined.agg(
        F.count(F.lit(1)).alias("fact_rows"), count_where(F.col(version).isNull()).alias("facts_without_version")
    ).select("*", count(overlaps).alias("overlapping_windows"), count(currents).alias("keys_with_wrong_current"))


def stored_windows(dimension: DataFrame, key: str, facts: DataFrame, fact_ts: str) -> DataFrame:
    """The stored windows against each other and against the facts: overlaps, gaps, rows that a range join would give."""
    defects = window_defects(dimension, key=key)
    moments = moments_matched(facts, dimension, fact_key=key, fact_ts=fact_ts, version_key=key)
    n, held = F.col("facts"), F.col("versions")
    counted = moments.agg(
        F.sum(n).alias("fact_rows"), F.sum(n * F.greatest(held, F.lit(1))).alias("rows_of_left_range_join"),
        F.coalesce(sum_where("facts", held == 0), F.lit(0)).alias("facts_without_version"),
        F.coalesce(sum_where("facts", held > 1), F.lit(0)).alias("facts_with_several"),
    )
    count = lambda c: defects.agg(count_where(F.col(c)).alias("n")).scalar()
    return counted.select("*", count("overlaps").alias("overlapping_windows"), count("gap").alias("windows_after_gap"))


def channel_match(sales: DataFrame, outlets: DataFrame) -> DataFrame:
    """Lines whose channel is the one of the outlet's first version."""
    first = outlets.where("version_no = 1").select("outlet_code", F.col("channel").alias("_first"))
    counted = sales.groupBy("outlet_code", "channel_at_sale").agg(F.count(F.lit(1)).alias("n"))
    same = F.sum(F.when(F.col("channel_at_sale") == F.col("_first"), F.col("n")).otherwise(0))
    return counted.join(first, "outlet_code").agg(
        F.sum("n").alias("lines"), same.alias("matching"), percent(same, F.sum("n")).alias("pct_matching")
    )


def vehicle_day_breach(readings: DataFrame) -> DataFrame:
    """One bad reading marks the vehicle's day; the reading-level rate stands beside it."""
    days = readings.groupBy("vehicle_registration", "dt").agg(
        F.max("is_excursion").alias("breached"), F.count("is_excursion").alias("valid"),
        count_where(F.col("is_excursion")).alias("bad"),
    ).where("valid > 0")
    breached = count_where(F.col("breached"))
    return days.agg(
        F.count(F.lit(1)).alias("vehicle_days"), breached.alias("breached_days"),
        percent(breached, F.count(F.lit(1))).alias("pct_vehicle_days"),
        percent(F.sum("bad"), F.sum("valid")).alias("pct_readings"),
    )


def canonical_agreement(history: DataFrame) -> DataFrame:
    """Orders deleted at any time, deleted as their latest change, and orders whose snapshot is simply the latest change."""
    position = F.struct("op_ts", "seq", "op_type")
    per_order = history.groupBy("order_number").agg(
        F.max(clean.is_delete("op_type")).alias("ever"),
        F.max(position).alias("last"),
        F.max(F.when(~clean.is_delete("op_type"), position)).alias("canonical"),
    )
    agree = F.coalesce("canonical", "last") == F.col("last")
    return per_order.agg(
        F.count(F.lit(1)).alias("orders"),
        count_where(F.col("ever")).alias("ever_deleted"),
        count_where(F.col("last.op_type") == "D").alias("latest_is_delete"),
        count_where(agree).alias("canonical_is_latest"),
    )


def negative_lines(sales: DataFrame) -> DataFrame:
    return sales.agg(
        F.count(F.lit(1)).alias("lines"), count_where(F.col("net_sales_amount") < 0).alias("negative_net_lines")
    )


def series_day_percentiles(health: DataFrame, source: str = "gateway_id") -> DataFrame:
    """How far days fall below the median of their series: lowest, 0.1st and 1st percentile, in percent."""
    usable = health.where("gateway_median > 0 AND readings > 0")
    scaled = usable.select(F.round(F.col("pct_of_gateway_median") * 10, 0).cast("long").alias("_pct"))
    spread = exact_percentiles(scaled, [], "_pct", {"min_pct": 0.0, "p0_1_pct": 0.001, "p1_pct": 0.01})
    counted = usable.agg(F.count(F.lit(1)).alias("n")).scalar()
    return spread.select(
        counted.alias("series_days"), *[round_to(F.col(c) / F.lit(10.0), 3).alias(c) for c in ("min_pct", "p0_1_pct", "p1_pct")]
    )


def period_coverage(sales: DataFrame, calendar: DataFrame, tail_days: int = 7) -> DataFrame:
    """Days with sales over days expected per fiscal quarter, and the mean of the quarter's last days over its mean."""
    daily = sales.groupBy(F.col("event_date_ist").alias("calendar_date")).agg(F.count(F.lit(1)).alias("n"))
    last_day = calendar.groupBy("fiscal_year", "fiscal_quarter").agg(F.max("calendar_date").alias("_end"))
    days = (
        calendar.join(daily, "calendar_date", "left")
        .join(last_day, ["fiscal_year", "fiscal_quarter"])
        .withColumn("n", F.coalesce("n", F.lit(0)))
    )
    tail = F.col("calendar_date") > F.date_sub("_end", tail_days)
    whole = ratio(F.sum("n"), F.count(F.lit(1)))
    last = ratio(F.sum(F.when(tail, F.col("n"))), count_where(tail))
    return days.groupBy("fiscal_year", "fiscal_quarter").agg(
        F.count(F.lit(1)).alias("days_expected"), count_where(F.col("n") > 0).alias("days_present"),
        round_to(whole, 2).alias("mean_lines"), round_to(last, 2).alias("tail_mean_lines"),
        percent(last, whole, 1).alias("tail_pct_of_mean"),
    )
