"""Numeric helpers whose results do not depend on row order or on the engine's own rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def money(col: Column | str) -> Column:
    """Fixed-point amount: sums stay exact however the rows are partitioned."""
    return _col(col).cast(MONEY)


def as_double(col: Column | str) -> Column:
    return _col(col).cast("double")


def round_to(col: Column | str, places: int) -> Column:
    """Half-away-from-zero rounding of the binary value.

    Spark's ``round`` works on the decimal text of a double and moves 1.005 to 1.01; SQL engines that scale,
    round and unscale give 1.0. The latter is reproduced here.
    """
    scale = float(10**places)
    value = as_double(col)
    return F.signum(value) * F.floor(F.abs(value) * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


def ratio(top: Column | str, bottom: Column | str) -> Column:
    """Double division; a zero or missing denominator gives NULL."""
    return F.try_divide(as_double(top), as_double(bottom))


def percent(top: Column | str, bottom: Column | str, places: int = 2) -> Column:
    return round_to(F.try_divide(F.lit(100.0) * as_double(top), as_double(bottom)), places)


def count_where(cond: Column) -> Column:
    """Rows for which a three-valued condition is true."""
    return F.count(F.when(cond, F.lit(1)))


def sum_where(value: Column | str, cond: Column) -> Column:
    """Sum over the rows for which the condition is true, NULL when there are none."""
    return F.sum(F.when(cond, _col(value)))


def total(value: Column | str) -> Column:
    """Exact money total, handed out as a double."""
    return as_double(F.sum(money(value)))


def _col(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col
