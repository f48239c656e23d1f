"""Data quality: partitions against the manifest, days against baselines, sources inside a feed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocktide.functions.numbers import count_where, percent, ratio, round_to
from stocktide.operators.completeness import silent_runs, sparse_median, status, with_median, with_trailing_mean, zero_filled
from stocktide.operators.quantiles import exact_percentiles
from stocktide.operators.reconcile import full_reconcile
from stocktide.sources import schemas

# Thresholds of the checks here, status, severity and verdict names below.
MIN_DAILY_ROWS = 100
COLLAPSE, LOW, TREND_LOW = 0.50, 0.75, 0.75
GATEWAY_DEGRADED, GATEWAY_HOLE = 0.50, 0.40
Z_LIMIT = 3.5


def daily_counts(feeds: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per (feed, partition day) over any number of feeds."""
    parts = [
        df.groupBy(F.col(schemas.PARTITION_COLUMN[name]).alias("d"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit(name).alias("feed"), "d", "n")
        for name, df in feeds.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def partition_counts(feeds: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per (feed, partition) with the partition spelled as its folder."""
    column = F.create_map(*[F.lit(x) for name in feeds for x in (name, schemas.PARTITION_COLUMN[name])])
    return daily_counts(feeds).select(
        "feed", F.concat(column[F.col("feed")], F.lit("="), F.col("d").cast("string")).alias("partition"),
        F.col("n").alias("actual_rows"),
    )


def dq_partition_reconciliation(
    manifest: DataFrame, listed: Mapping[str, DataFrame], unlisted: Mapping[str, DataFrame]
) -> DataFrame:
    """Delivered rows against the manifest, orphans of both sides kept; feeds without a manifest get a row each."""
    expected = manifest.select(
        "feed", "partition", F.col("row_count").alias("expected_rows"), F.col("file_count").alias("expected_files"),
        F.col("bytes").alias("expected_bytes"),
    )
    matched = full_reconcile(expected, partition_counts(listed), ["feed", "partition"]).withColumn(
        "actual_rows", F.coalesce("actual_rows", F.lit(0))
    )
    no_baseline = (
        daily_counts(unlisted)
        .groupBy("feed")
        .agg(F.sum("n").alias("actual_rows"))
        .withColumn("partition", F.lit("ALL"))
    )
    rows = matched.unionByName(no_baseline, allowMissingColumns=True)
    expected_rows, actual_rows = F.col("expected_rows"), F.col("actual_rows")
    return rows.select(
        "feed", "partition", "expected_rows", "actual_rows",
        (actual_rows - expected_rows).alias("row_delta"),
        percent(actual_rows, expected_rows, 4).alias("pct_of_expected"),
        "expected_files", "expected_bytes",
        status(
            (expected_rows.isNull() & (F.col("partition") == "ALL"), "NO_MANIFEST_BASELINE"),
            (expected_rows.isNull(), "UNEXPECTED_PARTITION"),
            (actual_rows == 0, "PARTITION_UNREADABLE"),
            (actual_rows < expected_rows, "SHORTFALL"),
            (actual_rows > expected_rows, "SURPLUS"),
            otherwise="MATCH",
        ).alias("status"),
    )


def dq_feed_completeness(daily: DataFrame, calendar: DataFrame) -> DataFrame:
    """Every feed on every day against its median and its trailing mean."""
    filled = zero_filled(
        daily.withColumnRenamed("n", "rows_present"), ["feed"], calendar, day="d", count="rows_present"
    )
    based = with_trailing_mean(
        with_median(filled, ["feed"], "rows_present", "_median"), ["feed"], "calendar_date", "rows_present", "_mean"
    )
    rows, median, mean = F.col("rows_present"), F.col("_median"), F.col("_mean")
    small, absent = median < MIN_DAILY_ROWS, F.col("day_absent") | (rows == 0)
    collapsed, low, falling = rows < COLLAPSE * median, rows < LOW * median, rows < TREND_LOW * mean
    return based.select(
        "feed", "calendar_date", "rows_present", "day_absent",
        round_to(median, 0).alias("feed_median"),
        percent(rows, median, 1).alias("pct_of_feed_median"),
        round_to(mean, 0).alias("trailing_28d_mean"),
        percent(rows, mean, 1).alias("pct_of_trailing_28d"),
        (~small).alias("is_volume_monitorable"),
        status(
            (small & (rows == 0), "ZERO_ROWS_LOW_VOLUME_FEED"),
            (small, "NOT_MONITORABLE_LOW_VOLUME"),
            (absent, "DAY_ABSENT"),
            (collapsed, "VOLUME_COLLAPSE"),
            (low, "VOLUME_LOW"),
            (falling, "VOLUME_LOW_VS_TREND"),
            otherwise="OK",
        ).alias("status"),
        status((small, "INFO"), (absent | collapsed, "ALERT"), (low | falling, "WARN"), otherwise="OK").alias("severity"),
    )


def source_days(readings: DataFrame, sources: Sequence[str] = ("gateway_id",), day: str = "dt") -> DataFrame:
    return readings.groupBy(*sources, day).agg(F.count(F.lit(1)).alias("readings"))


def dq_gateway_health(readings: DataFrame, calendar: DataFrame, source: str = "gateway_id") -> DataFrame:
    """Every source on every day against its own median, silent days included in the median."""
    based = with_median(
        zero_filled(source_days(readings, [source]), [source], calendar, day="dt", count="readings"),
        [source], "readings", "_median",
    )
    n, median = F.col("readings"), F.col("_median")
    return based.select(
        source, "calendar_date", "readings", "day_absent",
        round_to(median, 0).alias("gateway_median"),
        percent(n, median, 1).alias("pct_of_gateway_median"),
        status((n == 0, "OUTAGE"), (n < GATEWAY_DEGRADED * median, "DEGRADED"), otherwise="OK").alias("status"),
    )


def gateway_holes(readings: DataFrame, calendar: DataFrame) -> DataFrame:
    """Days under 40% of the gateway's median over the days it was observed, silent days left out of the median."""
    seen = source_days(readings)
    filled = zero_filled(seen, ["gateway_id"], calendar, day="dt", count="readings", out_day="dt")
    median = seen.groupBy("gateway_id").agg(F.median("readings").alias("_median"))
    n = F.col("readings")
    return filled.join(median, "gateway_id").where(n < GATEWAY_HOLE * F.col("_median")).select(
        "gateway_id", "dt", "readings",
        round_to("_median", 0).alias("median_daily"),
        percent(n, "_median", 1).alias("pct_of_median"),
        F.when(F.col("day_absent"), "DAY_ABSENT").otherwise("VOLUME_COLLAPSE").alias("finding"),
    )


def sparse_health(readings: DataFrame, bounds: DataFrame, sources: Sequence[str], day: str) -> DataFrame:
    """Days of a source that are not well, as ``dq_gateway_health`` finds them, without a row for every silent day.

    A silent run is one row with its ``days``; a degraded day is a run of one. For sources by the million: tills, docks.
    """
    daily = source_days(readings, sources, day)
    runs = silent_runs(daily, sources, bounds, day=day).withColumn("readings", F.lit(0).cast("long"))
    median = sparse_median(daily, sources, bounds, day=day, count="readings", out="median")
    low = daily.join(median, list(sources)).where(F.col("readings") < GATEWAY_DEGRADED * F.col("median")).select(
        *sources, F.col(day).alias("absent_from"), F.col(day).alias("absent_to"), F.lit(1).alias("days"), "readings",
        "median", F.lit("DEGRADED").alias("status"),
    )
    silent = runs.join(median, list(sources)).withColumn("status", F.lit("OUTAGE"))
    return silent.unionByName(low).withColumnsRenamed({"absent_from": "first_day", "absent_to": "last_day"})


def outlying_days(filled: DataFrame, keys: Sequence[str], count: str, limit: float = Z_LIMIT) -> DataFrame:
    """Days far from the middle of their series by the modified z-score, 0.6745 (x - median) / MAD.

    Two rounds of exact percentiles: of the counts, and of their distances from the median, doubled to stay whole
    numbers. A series whose days are mostly equal has a MAD of zero: every other day of it is named, without a score.
    """
    median = exact_percentiles(filled, keys, count, {"median": 0.5})
    based = filled.join(median, list(keys)).withColumn("_twice", F.abs(F.col(count) * 2 - F.col("median") * 2).cast("long"))
    mad = exact_percentiles(based, keys, "_twice", {"_mad": 0.5}).withColumn("mad", F.col("_mad") / 2).drop("_mad")
    scored = based.join(mad, list(keys)).withColumn(
        "z_score", round_to(ratio(F.lit(0.6745) * (F.col(count) - F.col("median")), "mad"), 4)
    )
    far = (F.abs("z_score") > limit) | ((F.col("mad") == 0) & (F.col("_twice") > 0))
    return scored.where(far).drop("_twice")


def null_rate(readings: DataFrame) -> DataFrame:
    missing = count_where(F.col("temp_reading_missing"))
    return readings.groupBy("telemetry_vendor", "firmware_version").agg(
        F.count(F.lit(1)).alias("readings"), missing.alias("null_readings"),
        percent(missing, F.count(F.lit(1)), 3).alias("null_pct"),
    )



def short_partitions(reconciliation: DataFrame) -> DataFrame:
    return reconciliation.where(~F.col("status").isin("MATCH", "NO_MANIFEST_BASELINE")).select(
        "feed", "partition", "expected_rows", "actual_rows", "row_delta", "pct_of_expected", "status"
    ).orderBy(F.asc_nulls_last("row_delta"), "feed", "partition")


def no_baseline(reconciliation: DataFrame) -> DataFrame:
    return reconciliation.where(F.col("status") == "NO_MANIFEST_BASELINE").select(
        "feed", F.col("actual_rows").alias("rows_loaded"), "status"
    ).orderBy("feed")


def alert_days(completeness: DataFrame) -> DataFrame:
    return completeness.where(F.col("severity").isin("ALERT", "WARN")).select(
        "feed", "calendar_date", "rows_present", "feed_median", "pct_of_feed_median", "status", "severity"
    ).orderBy("severity", "feed", "calendar_date")


def inner_holes(health: DataFrame) -> DataFrame:
    return health.where(F.col("status") != "OK").drop("day_absent").orderBy("status", "gateway_id", "calendar_date")


def defects_first(reconciliation: DataFrame) -> DataFrame:
    """Report order of the partition reconciliation: deviations and unlisted partitions before the matches."""
    deviates = (F.coalesce("row_delta", F.lit(0)) != 0) | F.col("expected_rows").isNull()
    return reconciliation.orderBy(F.when(deviates, 0).otherwise(1), "feed", "partition")


def outages_first(health: DataFrame) -> DataFrame:
    return health.orderBy(F.when(F.col("readings") == 0, 0).otherwise(1), "gateway_id", "calendar_date")


def publish_verdict(reconciliation: DataFrame, completeness: DataFrame, health: DataFrame) -> DataFrame:
    """One row: how many defects stand, and whether to publish."""
    parts = reconciliation.agg(
        count_where(~F.col("status").isin("MATCH", "NO_MANIFEST_BASELINE")).alias("short_partitions"),
        F.sum(F.when(F.col("status") == "SHORTFALL", F.col("row_delta"))).alias("rows_missing"),
        count_where(F.col("status") == "NO_MANIFEST_BASELINE").alias("unreconcilable_feeds"),
    )
    alerts = completeness.agg(count_where(F.col("severity") == "ALERT").alias("n")).scalar()
    outages = health.agg(count_where(F.col("status") == "OUTAGE").alias("n")).scalar()
    counted = parts.select("*", alerts.alias("feed_day_alerts"), outages.alias("gateway_outage_days"))
    clean = (F.col("short_partitions") == 0) & (F.col("feed_day_alerts") == 0) & (F.col("gateway_outage_days") == 0)
    return counted.withColumn(
        "verdict", F.when(clean, "CLEAN").otherwise("DEFECTS PRESENT - read sections 1-4 before publishing")
    )
