"""Row-level cleaning rules of the feeds, each a pure Column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stocktide.functions.numbers import MONEY, as_double, money, round_to

# Offsets, versions, vendors, units and factors that the feeds are known to carry.
OFFSET_HOURS, OFFSET_MINUTES = 5, 30
SKEWED_FIRMWARE, SKEW_HOURS = "2.1.4", 7
FAHRENHEIT_VENDOR = "COLDEYE"
BAND_LOW, BAND_HIGH = 2, 8
INFLATED_SOURCE, INFLATION_FACTOR = "PARTNER_API", 1.085
UNIT_EACH, UNIT_CASE = "EA", "CS"
DELETE_OP = "D"


def wall_clock(text: Column | str) -> Column:
    """Zone-less timestamp of a delivered string; a trailing Z keeps the wall clock."""
    return _col(text).cast("timestamp_ntz")


def business_time(utc: Column) -> Column:
    return utc + F.make_dt_interval(hours=F.lit(OFFSET_HOURS), mins=F.lit(OFFSET_MINUTES))


def business_date(utc: Column) -> Column:
    return F.to_date(business_time(utc))


def renamed(new: str, old: str) -> Column:
    """One value out of a column that was renamed part-way through the feed."""
    return F.coalesce(F.col(new), F.col(old))


def is_late(arrived: Column | str, happened: Column | str) -> Column:
    return _col(arrived) != _col(happened)


def deskew(clock: Column, firmware: Column | str) -> Column:
    """Take the known lead off the clock of the affected firmware."""
    lead = F.make_dt_interval(hours=F.lit(SKEW_HOURS))
    return F.when(_col(firmware) == SKEWED_FIRMWARE, clock - lead).otherwise(clock)


def resolved_unit(unit: Column | str, vendor: Column | str) -> Column:
    by_vendor = F.when(_col(vendor) == FAHRENHEIT_VENDOR, F.lit("F")).otherwise(F.lit("C"))
    return F.coalesce(_col(unit), by_vendor)


def to_celsius(value: Column | str, unit: Column) -> Column:
    value = _col(value)
    converted = (value - F.lit(32.0)) * F.lit(5.0) / F.lit(9.0)
    return F.when(unit == "F", converted).otherwise(value)


def above_band(celsius: Column | str, missing: Column | str) -> Column:
    """NULL, not false, when there is no reading."""
    return F.when(~_col(missing), _col(celsius) > BAND_HIGH)


def below_band(celsius: Column | str, missing: Column | str) -> Column:
    return F.when(~_col(missing), _col(celsius) < BAND_LOW)


def deflated(gross: Column | str, source: Column | str) -> Column:
    """Back the double-counted freight out of the one source that inflates its gross."""
    plain = round_to(as_double(gross) / F.lit(INFLATION_FACTOR), 2).cast(MONEY)
    return F.when(_col(source) == INFLATED_SOURCE, plain).otherwise(money(gross))


def is_delete(op: Column | str) -> Column:
    return _col(op) == DELETE_OP


def line_gross(qty: Column | str, price: Column | str) -> Column:
    return money(_col(qty) * _col(price))


def line_net(qty: Column | str, price: Column | str, discount: Column | str) -> Column:
    return money(line_gross(qty, price) - _col(discount))


def line_with_tax(qty: Column | str, price: Column | str, discount: Column | str, tax: Column | str) -> Column:
    return money(line_net(qty, price, discount) + _col(tax))


def in_eaches(qty: Column | str, unit: Column | str, factor: Column | str) -> Column:
    """Eaches of a line; NULL when the unit is unknown or the case size is not on file."""
    qty, unit = _col(qty).cast("long"), _col(unit)
    return F.when(unit == UNIT_EACH, qty).when(unit == UNIT_CASE, qty * _col(factor))


def factor_missing(unit: Column | str, factor: Column | str) -> Column:
    return (_col(unit) == UNIT_CASE) & _col(factor).isNull()


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Whole-second boundaries crossed between two zone-less timestamps, whatever the session zone."""
    start, end = _col(start), _col(end)
    days = F.date_diff(F.to_date(end), F.to_date(start)).cast("long")
    return days * 86400 + _second_of_day(end) - _second_of_day(start)


def nan_to_null(col: Column | str) -> Column:
    return F.nanvl(_col(col), F.lit(None).cast("double"))


def _second_of_day(ts: Column) -> Column:
    return F.hour(ts) * 3600 + F.minute(ts) * 60 + F.floor(F.second(ts)).cast("int")


def _col(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col
