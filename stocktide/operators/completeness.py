"""Completeness of daily series: spine, zero fill, baselines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def calendar_spine(series: DataFrame, calendar: DataFrame, day: str = "calendar_date") -> DataFrame:
    """Every series on every calendar day. The calendar travels as one array, bounded by the days it lists.

    A calendar that names the series lists each one's own days, and is the spine itself: a series that was never
    observed is there too.
    """
    if set(series.columns) <= set(calendar.columns):
        return calendar.select(*series.columns, day).distinct()
    days = calendar.agg(F.sort_array(F.collect_set(day)).alias("days")).scalar()
    return series.withColumn("_days", days).select(*series.columns, F.explode("_days").alias(day))


def zero_filled(
    daily: DataFrame, keys: Sequence[str], calendar: DataFrame, *, day: str, count: str, out_day: str = "calendar_date"
) -> DataFrame:
    """Daily counts on the full spine: an absent day becomes a zero and is flagged ``day_absent``.

    Series come from the observed rows; days outside the calendar drop out.
    """
    observed = daily.select(*keys, F.col(day).alias(out_day), count)
    spine = calendar_spine(observed.select(*keys).distinct(), calendar)
    if out_day != "calendar_date":
        spine = spine.withColumnRenamed("calendar_date", out_day)
    return spine.join(observed, [*keys, out_day], "left").select(
        *keys, out_day, F.coalesce(count, F.lit(0)).alias(count), F.col(count).isNull().alias("day_absent")
    )


def with_median(df: DataFrame, keys: Sequence[str], count: str, out: str) -> DataFrame:
    """Median of each series over its days; a series never has more rows than the calendar has days."""
    return df.withColumn(out, F.median(count).over(Window.partitionBy(*keys)))


def silent_runs(daily: DataFrame, keys: Sequence[str], bounds: DataFrame, *, day: str, first: str = "first_day", last: str = "last_day") -> DataFrame:
    """Runs of days on which a series was not observed, ``absent_from`` to ``absent_to``, and their ``days``.

    ``bounds`` has one row with the first and the last day to be watched. Only observed days are read: a run is what
    lies between two of them, before the first or after the last, so a million series over ten years of days cost no
    row for a silent day. A series has at most as many rows as there are days.
    """
    ordered = Window.partitionBy(*keys).orderBy(day)
    start, end = _watched(bounds, first, last)
    seen = daily.select(*keys, day).distinct().where(F.col(day).between(start, end))
    begin = F.when(F.lag(day).over(ordered).isNull(), start)  # only before the first observed day
    around = seen.select(
        *keys,
        F.array(
            F.struct(begin.alias("absent_from"), F.date_sub(day, 1).alias("absent_to")),
            F.struct(F.date_add(day, 1).alias("absent_from"), F.coalesce(F.date_sub(F.lead(day).over(ordered), 1), end).alias("absent_to")),
        ).alias("_runs"),
    )
    return (
        around.select(*keys, F.explode("_runs").alias("_r"))
        .select(*keys, "_r.*")
        .where("absent_from <= absent_to")
        .withColumn("days", F.date_diff("absent_to", "absent_from") + 1)
    )


def sparse_median(daily: DataFrame, keys: Sequence[str], bounds: DataFrame, *, day: str, count: str, out: str, first: str = "first_day", last: str = "last_day") -> DataFrame:
    """Each series with the median of its count over all watched days, silent ones as zero, from observed rows alone."""
    start, end = _watched(bounds, first, last)
    seen = daily.where(F.col(day).between(start, end))
    counts = F.sort_array(F.collect_list(count)).alias("_counts")  # at most one for each day
    per_series = seen.groupBy(*keys).agg(counts).withColumn("_days", F.date_diff(end, start) + 1)
    zeros = F.col("_days") - F.size("_counts")
    at = lambda place: F.when(place < zeros, F.lit(0)).otherwise(F.get("_counts", place - zeros))
    low, high = F.floor((F.col("_days") - 1) / 2).cast("int"), F.floor(F.col("_days") / 2).cast("int")
    return per_series.select(*keys, ((at(low) + at(high)) / F.lit(2.0)).alias(out))


def _watched(bounds: DataFrame, first: str, last: str) -> tuple[Column, Column]:
    return bounds.agg(F.min(first)).scalar(), bounds.agg(F.max(last)).scalar()


def with_trailing_mean(df: DataFrame, keys: Sequence[str], day: str, count: str, out: str, days: int = 28) -> DataFrame:
    """Mean of the preceding days, the current one left out; NULL on the first day."""
    frame = Window.partitionBy(*keys).orderBy(day).rowsBetween(-days, -1)
    return df.withColumn(out, F.avg(count).over(frame))


def status(*rules: tuple[Column, str], otherwise: str) -> Column:
    """First rule that holds names the status; an unknown condition does not hold."""
    chain = F
    for cond, label in rules:
        chain = chain.when(cond, F.lit(label))
    return chain.otherwise(F.lit(otherwise))
