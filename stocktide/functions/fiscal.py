"""April-to-March fiscal year: labels of a date, bounds of a quarter."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fiscal_end_year(day: Column) -> Column:
    """Calendar year in which the fiscal year of the date ends."""
    return F.year(F.add_months(day, 9))


def fiscal_year(day: Column) -> Column:
    return F.concat(F.lit("FY"), F.lpad((fiscal_end_year(day) % 100).cast("string"), 2, "0"))


def fiscal_quarter_no(day: Column) -> Column:
    return F.quarter(F.add_months(day, -3))


def fiscal_quarter(day: Column) -> Column:
    return F.concat(F.lit("Q"), fiscal_quarter_no(day).cast("string"))


def fiscal_month_no(day: Column) -> Column:
    return F.month(F.add_months(day, -3))


def quarter_start(end_year: Column, quarter: Column) -> Column:
    """First day of a fiscal quarter, from the year the fiscal year ends in and the quarter number."""
    april = F.make_date(end_year.cast("int") - 1, F.lit(4), F.lit(1))
    return F.add_months(april, ((quarter - 1) * 3).cast("int"))


def quarter_end(end_year: Column, quarter: Column) -> Column:
    return F.last_day(F.add_months(quarter_start(end_year, quarter), 2))
