"""Share of the total over a grouped result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stocktide.functions.numbers import percent, total


def share_of_groups(value: str, *within: str) -> Column:
    """Percent of the sum over all groups (of those with equal `within` columns): for keys that are a short code list (channel, source, category).

    ``value`` is a decimal or whole number, so the total does not depend on the order of the groups.
    """
    return percent(value, F.sum(value).over(Window.partitionBy(*(within or (F.lit(0),)))))


def grand_total(df: DataFrame, value: str | Column) -> Column:
    """Total of the ungrouped rows as a scalar: for keys that grow with the data, where no task may see all groups."""
    return df.agg(total(value).alias("total")).scalar()
