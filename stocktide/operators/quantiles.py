"""Exact medians and percentiles without holding a group in one task.

The built-in ``median`` keeps every distinct value of a group in one buffer. Here values are whole numbers
(cents, seconds, scaled ratios): equal values collapse into counts, counts are summed over buckets of 2^20
values, and only the bucket that holds the wanted rank is opened. A window therefore sees either the buckets of
a group or the distinct values of one bucket, at most about a million for each whatever the row count.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET_BITS = 20


def exact_percentiles(
    df: DataFrame,
    groups: Sequence[str],
    value: str,
    fractions: Mapping[str, float],
    bucket_bits: int = BUCKET_BITS,
) -> DataFrame:
    """Linear-interpolated percentiles of an integer column, one double column per entry of ``fractions``."""
    counted = (
        df.where(F.col(value).isNotNull())
        .select(F.struct(*groups, F.lit(0).alias("_one")).alias("_g"), F.col(value).cast("long").alias("_v"))
        .groupBy("_g", "_v")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_bucket", F.floor(F.col("_v") / F.lit(float(2**bucket_bits))))
    )
    by_bucket = Window.partitionBy("_g").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = (
        counted.groupBy("_g", "_bucket")
        .agg(F.sum("_n").alias("_n"))
        .select(
            "_g",
            "_bucket",
            F.col("_n").alias("_size"),
            F.coalesce(F.sum("_n").over(by_bucket), F.lit(0)).alias("_below"),
            F.sum("_n").over(Window.partitionBy("_g")).alias("_total"),
        )
    )
    # Ranks are 0-based; each fraction needs the value at the rank below and above its position.
    wanted = F.array(
        *[
            F.struct(F.lit(name).alias("name"), (F.lit(q) * (F.col("_total") - 1)).alias("pos"))
            for name, q in fractions.items()
        ]
    )
    targets = (
        buckets.select("*", F.explode(wanted).alias("_want"))
        .select(
            "_g", "_bucket", "_below", "_size", "_want.name", "_want.pos",
            F.explode(F.array_distinct(F.array(F.floor("_want.pos"), F.ceil("_want.pos")))).alias("_rank"),
        )
        .where("_rank >= _below AND _rank < _below + _size")
    )
    opened = targets.select("_g", "_bucket", "_below").distinct()
    in_bucket = Window.partitionBy("_g", "_bucket").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    placed = counted.join(opened, ["_g", "_bucket"]).select(
        "_g", "_bucket", "_v", "_n",
        (F.col("_below") + F.coalesce(F.sum("_n").over(in_bucket), F.lit(0))).alias("_from"),
    )
    hits = (
        placed.join(targets.select("_g", "_bucket", "name", "pos", "_rank"), ["_g", "_bucket"])
        .where("_rank >= _from AND _rank < _from + _n")
        .groupBy("_g", "name", "pos")
        .agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
        .withColumn("_q", F.col("_lo") + (F.col("_hi") - F.col("_lo")) * (F.col("pos") - F.floor("pos")))
    )
    return hits.groupBy("_g").agg(
        *[F.max(F.when(F.col("name") == name, F.col("_q"))).alias(name) for name in fractions]
    ).select(*[F.col(f"_g.{g}").alias(g) for g in groups], *fractions)


def ordered_key(value: Column) -> Column:
    """A long that orders as the doubles of `value` do, NaN last; both zeros have one key.

    Sign, exponent and fraction are put together from exact operations: powers of two and divisions by them.
    """
    size = F.abs(value)
    guess = F.floor(F.log2(size))
    # The logarithm is rounded, so that it can be off by one next to a power of two.
    exponent = F.when(F.pow(F.lit(2.0), guess) > size, guess - 1).when(F.pow(F.lit(2.0), guess + 1) <= size, guess + 1).otherwise(guess)
    exponent = F.least(exponent, F.lit(1023))
    normal = (exponent + 1023) * F.lit(1 << 52) + ((size / F.pow(F.lit(2.0), exponent) - 1) * F.lit(2.0**52)).cast("long")
    tiny = (size * F.lit(2.0**537) * F.lit(2.0**537)).cast("long")
    endless = F.lit(2047 << 52)
    key = F.when(F.isnan(value), endless + 1).when(size == float("inf"), endless).when(size < 2.0**-1022, tiny).otherwise(normal)
    return F.when(value < 0, -key).otherwise(key)


def radix_percentiles(df: DataFrame, groups: Sequence[str], value: str, fractions: Mapping[str, float], digit_bits: int = BUCKET_BITS) -> DataFrame:
    """Linear-interpolated percentiles of a whole-number or double column of any range, as exact doubles.

    A radix descent: each level counts one digit of the values under the prefixes that hold a wanted rank and opens
    those digits that still hold one. A window sees the digits under one prefix, at most 2^digit_bits rows, whatever
    the values are. Between levels go the open prefixes alone, at most two for each group and fraction. Nulls don't
    count; a group without values has no row; null group keys are a group.
    """
    is_double = df.schema[value].dataType.typeName() in ("double", "float")
    typed = F.col(value).cast("double" if is_double else "long")
    counted = (
        df.where(F.col(value).isNotNull())
        .select(F.struct(*groups, F.lit(0).alias("_one")).alias("_g"), (ordered_key(typed) if is_double else typed).alias("_key"), typed.alias("_v"))
        .groupBy("_g", "_key")
        .agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_v"))
    )
    positions = {name: F.lit(float(q)) * (F.col("_total") - 1) for name, q in fractions.items()}

    def holds(rank: Column) -> Column:
        return (rank >= F.col("_from")) & (rank < F.col("_from") + F.col("_size"))

    wanted = reduce(lambda a, b: a | b, [holds(edge(p)) for p in positions.values() for edge in (F.floor, F.ceil)])
    opened = counted.groupBy("_g").agg(F.sum("_n").alias("_total")).select("_g", F.lit(0).cast("long").alias("_prefix"), F.lit(0).cast("long").alias("_below"), "_total")
    shifts = [*range(64 - digit_bits, 0, -digit_bits), 0]
    for above, shift in zip([None, *shifts], shifts, strict=False):
        prefix = F.lit(0).cast("long") if above is None else F.shiftright("_key", above)
        digits = (
            counted.withColumn("_prefix", prefix)
            .join(opened, ["_g", "_prefix"])
            .groupBy("_g", "_prefix", "_below", "_total", F.shiftright("_key", shift).alias("_next"))
            .agg(F.sum("_n").alias("_size"), F.min("_v").alias("_v"))
        )
        before = Window.partitionBy("_g", "_prefix").orderBy("_next").rowsBetween(Window.unboundedPreceding, -1)
        placed = digits.withColumn("_from", F.col("_below") + F.coalesce(F.sum("_size").over(before), F.lit(0))).where(wanted)
        opened = placed.select("_g", F.col("_next").alias("_prefix"), F.col("_from").alias("_below"), "_total")
    # The last digits are single values.
    edges = [F.max(F.when(holds(edge(p)), F.col("_v"))).alias(f"_{side}_{name}") for name, p in positions.items() for side, edge in (("lo", F.floor), ("hi", F.ceil))]
    found = placed.groupBy("_g", "_total").agg(*edges)

    def between(name: str, position: Column) -> Column:
        low, high = F.col(f"_lo_{name}").cast("double"), F.col(f"_hi_{name}").cast("double")
        return F.when(low == high, low).otherwise(low + (high - low) * (position - F.floor(position))).alias(name)

    return found.select(*[F.col(f"_g.{g}").alias(g) for g in groups], *[between(n, p) for n, p in positions.items()])


def exact_median(df: DataFrame, groups: Sequence[str], value: str, out: str) -> DataFrame:
    return exact_percentiles(df, groups, value, {out: 0.5})
