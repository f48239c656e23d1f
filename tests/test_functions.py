"""Column rules on a few rows each."""

import datetime as dt

from pyspark.sql import functions as F

from stocktide.functions import cleaning as clean
from stocktide.functions import fiscal
from stocktide.functions.numbers import percent, round_to


def one(df):
    return tuple(df.first())


def test_rounding_follows_the_binary_value(spark):
    df = spark.createDataFrame([(1.005, 0.285, -2.5, 5.015)], "a double, b double, c double, d double")
    assert one(df.select(round_to("a", 2), round_to("b", 2), round_to("c", 0), round_to("d", 2))) == (1.0, 0.28, -3.0, 5.01)


def test_percent_of_zero_is_null(spark):
    df = spark.createDataFrame([(1, 0, 3)], "a int, z int, b int")
    assert one(df.select(percent("a", "z"), percent("a", "b"))) == (None, 33.33)


def test_business_day_crosses_midnight(spark):
    df = spark.createDataFrame([("2025-01-01T20:30:00Z",), ("2025-01-01T18:29:59Z",)], "ts string")
    days = [r[0] for r in df.select(clean.business_date(clean.wall_clock("ts"))).collect()]
    assert days == [dt.date(2025, 1, 2), dt.date(2025, 1, 1)]


def test_band_is_strict_and_unknown_when_missing(spark):
    df = spark.createDataFrame([(None,), (8.0,), (8.01,), (2.0,), (1.99,)], "t double").withColumn("m", F.col("t").isNull())
    flags = [tuple(r) for r in df.select(clean.above_band("t", "m"), clean.below_band("t", "m")).collect()]
    assert flags == [(None, None), (False, False), (True, False), (False, False), (False, True)]


def test_units_and_clock(spark):
    df = spark.createDataFrame(
        [("COLDEYE", None, 50.0, "2.1.4"), ("THERMLOG", None, 5.0, "2.0"), ("THERMLOG", "F", 41.0, "2.0"), ("COLDEYE", "C", None, "2.0")],
        "vendor string, unit string, v double, fw string",
    ).withColumn("ts", F.lit("2025-07-01 09:00:00").cast("timestamp_ntz"))
    unit = clean.resolved_unit("unit", "vendor")
    rows = df.select(unit, clean.to_celsius("v", unit), F.hour(clean.deskew(F.col("ts"), "fw"))).collect()
    assert [tuple(r) for r in rows] == [("F", 10.0, 2), ("C", 5.0, 9), ("F", 5.0, 9), ("C", None, 9)]


def test_eaches_need_a_unit_and_a_factor(spark):
    df = spark.createDataFrame([(3, "EA", 12), (3, "CS", 12), (3, "CS", None), (3, None, 12)], "q int, u string, f int")
    rows = df.select(clean.in_eaches("q", "u", "f"), clean.factor_missing("u", "f")).collect()
    assert [tuple(r) for r in rows] == [(3, False), (36, False), (None, True), (None, False)]  # NULL AND FALSE is FALSE


def test_only_the_inflating_source_is_corrected(spark):
    df = spark.createDataFrame([("PARTNER_API", 108.5), ("ERP_WEB", 108.5)], "s string, g double")
    assert [float(r[0]) for r in df.select(clean.deflated("g", "s")).collect()] == [100.0, 108.5]


def test_seconds_count_boundaries(spark):
    df = spark.createDataFrame([("2025-01-01 00:00:09.9", "2025-01-01 00:00:11.1"), ("2025-01-02 00:00:00", "2025-01-01 23:59:59")], "a string, b string")
    assert [r[0] for r in df.select(clean.seconds_between(clean.wall_clock("a"), clean.wall_clock("b"))).collect()] == [2, -1]


def test_not_a_number_is_no_reading(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,), (None,)], "v double")
    assert [r[0] for r in df.select(clean.nan_to_null("v")).collect()] == [None, 1.0, None]


def test_fiscal_labels_and_bounds(spark):
    df = spark.createDataFrame([(dt.date(2026, 4, 1),), (dt.date(2026, 3, 31),), (dt.date(2025, 12, 31),)], "d date")
    d = F.col("d")
    end, q = fiscal.fiscal_end_year(d), fiscal.fiscal_quarter_no(d)
    rows = df.select(fiscal.fiscal_year(d), fiscal.fiscal_quarter(d), fiscal.fiscal_month_no(d), fiscal.quarter_start(end, q), fiscal.quarter_end(end, q)).collect()
    assert [tuple(r) for r in rows] == [
        ("FY27", "Q1", 1, dt.date(2026, 4, 1), dt.date(2026, 6, 30)),
        ("FY26", "Q4", 12, dt.date(2026, 1, 1), dt.date(2026, 3, 31)),
        ("FY26", "Q3", 9, dt.date(2025, 10, 1), dt.date(2025, 12, 31)),
    ]
