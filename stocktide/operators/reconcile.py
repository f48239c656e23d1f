"""Reconciliation operators: both-sided matching, week buckets, build comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def full_reconcile(expected: DataFrame, actual: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join on the keys with the orphans of both sides kept."""
    return expected.join(actual, list(keys), "full")


def week_days(weeks: DataFrame, week: str = "week_start") -> DataFrame:
    """The seven days of each week start, as a lookup from day to week."""
    return weeks.select(week, F.explode(F.sequence(week, F.date_add(week, 6))).alias("_day"))


def in_weeks(df: DataFrame, day: str, weeks: DataFrame, week: str = "week_start") -> DataFrame:
    """Inner join of rows to the listed week that holds their day, as an equality on the day.

    Holds for any list of starts, overlapping weeks included. The lookup has seven rows for each published week,
    so its size is bound by the calendar and it is broadcast.
    """
    lookup = week_days(weeks, week)
    return df.join(F.broadcast(lookup), F.col(day) == F.col("_day")).drop("_day")


def partition_digests(df: DataFrame, partition: str) -> DataFrame:
    """Per partition: rows, and three figures of the hashes of its rows that do not depend on their order.

    The exclusive or sees every row that stands an odd number of times with 64 bits; the sums, of 24 bits each so that
    they can't overflow, see multiplicities too. Nulls are hashed by their place.
    """
    columns = sorted(df.columns)
    row = F.xxhash64(*columns, *[F.col(c).isNull() for c in columns])
    return df.select(partition, row.alias("_h")).groupBy(partition).agg(
        F.count(F.lit(1)).alias("rows"), F.bit_xor("_h").alias("parity"),
        F.sum(F.shiftrightunsigned("_h", 40)).alias("upper"),
        F.sum(F.shiftrightunsigned("_h", 16).bitwiseAND(F.lit(0xFFFFFF))).alias("middle"),
    )


def differing_partitions(left: DataFrame, right: DataFrame, partition: str) -> DataFrame:
    """Partitions that only one side has or whose digests differ, with both row counts (NULL where absent)."""
    a, b = partition_digests(left, partition).alias("a"), partition_digests(right, partition).alias("b")
    figures = ("rows", "parity", "upper", "middle")
    same = F.lit(True)
    for c in figures:
        same = same & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    return a.join(b, F.col(f"a.{partition}").eqNullSafe(F.col(f"b.{partition}")), "full").where(~same).select(
        F.coalesce(f"a.{partition}", f"b.{partition}").alias(partition),
        F.col("a.rows").alias("left_rows"), F.col("b.rows").alias("right_rows"),
    )


def stored_diff(left: DataFrame, right: DataFrame, partition: str) -> DataFrame:
    """``two_way_diff`` of two stored tables with one layout: rows meet only in partitions whose digests differ.

    The names of those partitions come to the driver (as many as there are folders at most), so that the second reading
    opens no other folder.
    """
    names = [r[0] for r in differing_partitions(left, right, partition).select(partition).collect()]
    here = F.col(partition).isin([n for n in names if n is not None])
    if None in names:
        here = here | F.col(partition).isNull()
    return two_way_diff(left.where(here), right.where(here))


def two_way_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of one build that the other lacks, with multiplicity; counts meet before the exchange."""
    columns = left.columns
    signed = left.select(*columns, F.lit(1).alias("_sign")).unionByName(right.select(*columns, F.lit(-1).alias("_sign")))
    return (
        signed.groupBy(*columns)
        .agg(F.sum("_sign").alias("surplus"))
        .where("surplus <> 0")
    )
