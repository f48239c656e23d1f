"""Data quality statuses, reconciliation verdicts and routing on hand-made rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stocktide.plans import dq, finance, kpi, limits, marts, routing

DAY = dt.date(2025, 1, 1)
#: Columns of the facts that the flat view hands through.
FACT_ONLY = (
    "basket_id", "is_late_arrival", "channel_at_sale", "qty_original", "uom_original", "uom_unknown_flag", "uom_conversion_missing", "eaches_per_case",
    "qty_eaches", "unit_price", "gross_sales_amount", "discount_amount", "net_sales_amount", "tax_amount", "sales_amount_incl_tax", "payment_mode",
    "promo_code", "source_file",
)


def day(n):
    return DAY + dt.timedelta(days=n)


def test_partition_statuses(spark):
    manifest = spark.createDataFrame(
        [("wms_scan_events", f"dt={day(i)}", 1, n, 10) for i, n in enumerate([5, 7, 3, 4])],
        "feed string, partition string, file_count bigint, row_count bigint, bytes bigint",
    )
    rows = [(day(0),)] * 5 + [(day(1),)] * 6 + [(day(2),)] * 4 + [(day(9),)] * 2
    wms = spark.createDataFrame(rows, "dt date")
    outlets = spark.createDataFrame([(day(0),)] * 3, "extract_date date")
    got = dq.dq_partition_reconciliation(manifest, {"wms_scan_events": wms}, {"erp_cdc/outlet_master": outlets})
    statuses = {(r["feed"][:3], r["partition"]): (r["status"], r["row_delta"]) for r in got.collect()}
    assert statuses == {
        ("wms", "dt=2025-01-01"): ("MATCH", 0), ("wms", "dt=2025-01-02"): ("SHORTFALL", -1), ("wms", "dt=2025-01-03"): ("SURPLUS", 1),
        ("wms", "dt=2025-01-04"): ("PARTITION_UNREADABLE", -4), ("wms", "dt=2025-01-10"): ("UNEXPECTED_PARTITION", None),
        ("erp", "ALL"): ("NO_MANIFEST_BASELINE", None),
    }
    assert dq.defects_first(got).first()["status"] != "MATCH"
    assert [r["status"] for r in dq.short_partitions(got).collect()][:2] == ["PARTITION_UNREADABLE", "SHORTFALL"]


def test_feed_day_statuses(spark):
    calendar = spark.createDataFrame([(day(i),) for i in range(9)], "calendar_date date")
    big = [200, 200, 200, 0, 90, 140, 200, 200, 200]
    daily = spark.createDataFrame(
        [("big", day(i), n) for i, n in enumerate(big) if n] + [("small", day(i), 4) for i in range(8)], "feed string, d date, n bigint"
    )
    got = {(r["feed"], (r["calendar_date"] - DAY).days): (r["status"], r["severity"]) for r in dq.dq_feed_completeness(daily, calendar).collect()}
    assert got[("big", 3)] == ("DAY_ABSENT", "ALERT")
    assert got[("big", 4)] == ("VOLUME_COLLAPSE", "ALERT")
    assert got[("big", 5)] == ("VOLUME_LOW", "WARN")
    assert got[("big", 0)] == ("OK", "OK")
    assert got[("small", 8)] == ("ZERO_ROWS_LOW_VOLUME_FEED", "INFO")
    assert got[("small", 0)] == ("NOT_MONITORABLE_LOW_VOLUME", "INFO")


def test_volume_below_its_trend(spark):
    calendar = spark.createDataFrame([(day(i),) for i in range(40)], "calendar_date date")
    daily = spark.createDataFrame([("f", day(i), 1000 if i < 15 else 100 if i < 39 else 100) for i in range(40)], "feed string, d date, n bigint")
    got = {(r["calendar_date"] - DAY).days: r["status"] for r in dq.dq_feed_completeness(daily, calendar).collect()}
    assert got[20] == "VOLUME_LOW_VS_TREND" and got[3] == "OK"


def test_gateway_medians_differ_in_silent_days(spark):
    calendar = spark.createDataFrame([(day(i),) for i in range(4)], "calendar_date date")
    readings = spark.createDataFrame([("g", day(0))] * 10 + [("g", day(1))] * 3, "gateway_id string, dt date")
    health = {(r["calendar_date"] - DAY).days: (r["gateway_median"], r["status"]) for r in dq.dq_gateway_health(readings, calendar).collect()}
    assert health == {0: (2.0, "OK"), 1: (2.0, "OK"), 2: (2.0, "OUTAGE"), 3: (2.0, "OUTAGE")}
    holes = {(r["dt"] - DAY).days: (r["median_daily"], r["finding"]) for r in dq.gateway_holes(readings, calendar).collect()}
    assert holes == {2: (7.0, "DAY_ABSENT"), 3: (7.0, "DAY_ABSENT")}


def test_cell_without_sales_reads_as_understated(spark):
    legacy = spark.createDataFrame(
        [(DAY, "GT", 103.0, 1, 1), (DAY, "MT", 500.0, 1, 1), (DAY, "ECOM", 10.0, 1, 1), (DAY, "HORECA", 10.0, 1, 1)],
        "week_ending date, channel string, gross_sales_inr double, units_sold bigint, basket_count bigint",
    )
    sales = spark.createDataFrame([(day(1), "GT", "b", 1, 100), (day(6), "MT", "b", 1, 100), (day(6), "ECOM", "b", 1, 100), (day(7), "HORECA", "b", 1, 10)],
                                  "event_date_ist date, channel_at_sale string, basket_id string, qty_original int, g int").withColumn("gross_sales_amount", F.col("g").cast("decimal(18,2)"))
    raw = spark.createDataFrame([(day(1), "GT", 1, None, 100.0), (day(1), "GT", None, 1, 100.0)], "ingest_date date, channel string, qty int, quantity_units int, unit_price double")
    recon = finance.rpt_finance_reconciliation(sales, raw, legacy)
    got = {r["channel"]: (r["reconciliation_status"], r["duplicate_lines_counted"]) for r in recon.collect()}
    assert got == {
        "GT": ("RECONCILED_WITHIN_5PCT", 1), "MT": ("PUBLISHED_OVERSTATES", None), "ECOM": ("PUBLISHED_UNDERSTATES", None),
        "HORECA": ("PUBLISHED_UNDERSTATES", None),
    }


def test_share_is_of_the_whole_window_not_of_the_rows_shown(spark):
    flat = spark.createDataFrame([(DAY, f"s{i}", "n", "c", 1, 1, 10 * (i + 1)) for i in range(4)],
                                 "event_date_ist date, sku_code string, product_name string, product_category string, product_is_chilled long, qty_eaches long, g int")
    flat = flat.withColumn("gross_sales_amount", F.col("g").cast("decimal(18,2)"))
    got = kpi.top_products(flat, 2).collect()
    assert [(r["sku_code"], r["pct_of_window"]) for r in got] == [("s3", 40.0), ("s2", 30.0)]


def test_unknown_grouping_gives_no_rows(spark):
    columns = {n: "string" for n in ("basket_id", "channel_at_sale", "fiscal_year", "fiscal_quarter", "product_category", "warehouse_region")}
    money = ("gross_sales_amount", "discount_amount", "net_sales_amount", "tax_amount", "sales_amount_incl_tax")
    schema = ", ".join([f"{n} {t}" for n, t in columns.items()] + [f"{n} decimal(18,2)" for n in money] + ["event_date_ist date", "is_late_arrival boolean"])
    flat = spark.createDataFrame([], schema)
    assert kpi.sales_summary(flat, "weekday").count() == 0


QUESTIONS = {
    "gross sales by channel last quarter": ("gross_sales_by_channel", None),
    "How do our net sales look, by region?": ("sales_summary", "region"),
    "units in eaches last month": ("units_in_eaches", None),
    "volume sold": ("units_sold", None),
    "top 10 SKUs": ("top_products", None),
    "how does that compare to the finance report": ("finance_reconciliation", None),
    "are orders comparable across ERP and SFA": ("order_value_by_source", None),
    "which days have missing data": ("feed_completeness", None),
    "excursion rate by carrier": ("blocked_excursion_by_carrier", None),
    "proportion of chilled trips breached temperature": ("blocked_trip_excursion", None),
    "median dock-to-dispatch cycle time": ("blocked_cycle_time", None),
    "which outlets changed channel": ("blocked_channel_change", None),
    "order discount": ("blocked_order_net_value", None),
    "what is the weather": ("unknown", None),
}


def test_questions_are_routed(spark):
    q = spark.createDataFrame([(i, t) for i, t in enumerate(QUESTIONS)], "id int, question string")
    got = {r["id"]: (r["intent"], r["group_by"]) for r in routing.picked(q, ["id"]).collect()}
    assert got == {i: expected for i, expected in enumerate(QUESTIONS.values())}


D = dt.date


@pytest.mark.parametrize(
    "text, anchor, expected",
    [
        ("sales in June 2026", D(2026, 6, 30), (D(2026, 6, 1), D(2026, 6, 30), "June 2026")),
        ("sept 2025", D(2026, 6, 30), (D(2025, 9, 1), D(2025, 9, 30), "September 2025")),
        ("last 7 days", D(2026, 6, 30), (D(2026, 6, 24), D(2026, 6, 30), "last 7 days")),
        ("last 90 days", D(2026, 6, 30), (D(2026, 4, 2), D(2026, 6, 30), "last 90 days")),
        ("last month", D(2026, 6, 30), (D(2026, 6, 1), D(2026, 6, 30), "June 2026")),
        ("last month", D(2026, 6, 29), (D(2026, 5, 1), D(2026, 5, 31), "May 2026")),
        ("this month", D(2026, 6, 12), (D(2026, 6, 1), D(2026, 6, 12), "June 2026")),
        ("last year", D(2026, 6, 30), (D(2025, 1, 1), D(2025, 12, 31), "calendar 2025")),
        ("all time", D(2026, 6, 30), (D(2000, 1, 1), D(2026, 6, 30), "the whole period")),
        ("FY26 Q3", D(2026, 6, 30), (D(2025, 10, 1), D(2025, 12, 31), "FY26-Q3")),
        ("last quarter", D(2026, 6, 30), (D(2026, 4, 1), D(2026, 6, 30), "FY27-Q1")),
        ("last quarter", D(2026, 6, 29), (D(2026, 1, 1), D(2026, 3, 31), "FY26-Q4")),
        ("last complete quarter", D(2026, 6, 29), (D(2026, 4, 1), D(2026, 6, 30), "FY27-Q1")),
        ("", D(2026, 2, 1), (D(2026, 1, 1), D(2026, 3, 31), "FY26-Q4")),
    ],
)
def test_periods(spark, text, anchor, expected):
    q = spark.createDataFrame([(text,)], "question string")
    r = routing.with_periods(q, [], F.lit(anchor)).first()
    assert (r["date_from"], r["date_to"], r["label"]) == expected


def test_text_is_normalised_once_not_once_a_term(spark):
    asked = spark.createDataFrame([(1, 0, "Net SALES, by month!"), (2, 0, None)], "conv_id long, turn long, question string")
    scores = routing.scored(asked.repartition(2), ("conv_id", "turn"))
    plan = scores._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_replace" in plan and "Contains(regexp_replace" not in plan.replace("contains(", "Contains(")
    assert {(r["conv_id"], r["intent"], r["score"]) for r in scores.collect()} == {(1, "sales_summary", 1)}


def test_columns_of_the_flat_view_without_stored_versions(spark):
    """The same rows as the whole view, from facts without version keys and without the other columns."""
    at = lambda n, hour=10: dt.datetime(2025, 1, 1, hour) + dt.timedelta(days=n)
    facts = [(1, 1, "o1", "s1", at(0)), (1, 2, "o1", "s2", at(0)), (2, 1, "o1", "s1", at(3)), (3, 1, "o2", None, at(3)), (4, 1, None, "s1", at(9)), (5, 1, "o9", "s9", at(1)), (6, 1, "o2", "s2", None)]
    sales = spark.createDataFrame(facts, "txn_id int, txn_line_no int, outlet_code string, sku_code string, event_ts_ist timestamp_ntz").withColumn("event_date_ist", F.to_date("event_ts_ist"))
    sales = sales.withColumns({c: F.lit(None).cast("string") for c in marts.FLAT_COLUMNS if c in FACT_ONLY})
    open_end = dt.datetime(9999, 12, 31)
    windows = lambda key: [(key + "1", 1, at(-5), at(2)), (key + "1", 2, at(2), open_end), (key + "2", 4, at(-5), open_end)]

    def dim(key, attributes):
        df = spark.createDataFrame(windows(key[0]), f"{key} string, version_no bigint, valid_from timestamp_ntz, valid_to timestamp_ntz")
        return df.withColumns({c: F.concat_ws("-", key, "version_no", F.lit(c)) for c in attributes.values()})

    outlets, products = dim("outlet_code", marts.OUTLET_AT_SALE), dim("sku_code", marts.PRODUCT_AT_SALE)
    calendar = marts.calendar_between(spark.createDataFrame([(day(0), day(5))], "first_day date, last_day date"))
    sites = spark.createDataFrame([("o1-2-warehouse_code", "north site", "north", "x")], "warehouse_code string, warehouse_name string, region_name string, city string")
    whole = marts.rpt_sales_flat(marts.with_versions(sales, outlets, products), outlets, products, calendar, sites)
    for columns in (marts.FLAT_COLUMNS, ("txn_id", "warehouse_region", "product_category"), ("txn_id", "fiscal_year"), ("txn_id", "product_version_no")):
        lines = sales.select(*marts.line_columns(sales, columns))
        got = marts.flat_columns(lines, outlets, products, calendar, sites, columns)
        assert got.columns == list(columns)
        assert sorted(map(repr, got.collect())) == sorted(map(repr, whole.select(*columns).collect()))


def outlet_versions(spark):
    """Outlets with 1 to 9 versions and a missing key; values repeat, are null, NaN or zero of either sign."""
    doubles = (0.0, float("nan"), None, -0.0, float("nan"), 2.5, 2.5)
    rows = []
    for outlet in (*[f"o{i}" for i in range(9)], None):
        for v in range(1 + (4 if outlet is None else int(outlet[1:]))):
            rows.append((outlet, "abc"[v % 3], None if v % 2 else "f", f"c{v // 2}", f"r{v}", doubles[v % 7], None, "n"))
    ddl = "outlet_code string, channel string, outlet_format string, city string, route_code string, credit_limit double, warehouse_code string, outlet_name string"
    return rows, spark.createDataFrame(rows, ddl).repartition(3)


@pytest.mark.parametrize("many", [1000, 5])
def test_noise_profile_matches_brute_force_with_and_without_busy_outlets(spark, monkeypatch, many):
    monkeypatch.setattr(limits, "MANY_VERSIONS", many, raising=False)
    rows, outlets = outlet_versions(spark)
    columns = outlets.columns[1:]
    by_outlet = {k: [r for r in rows if r[0] == k] for k in {r[0] for r in rows}}
    kept = [versions for versions in by_outlet.values() if len(versions) > 2]

    def distinct(versions, i):  # NaN is one value, and zero has no sign
        return len({"nan" if r[i] != r[i] else r[i] for r in versions if r[i] is not None})

    want = {f"avg_distinct_{c}": int(sum(distinct(v, i) for v in kept) / len(kept) * 100 + 0.5) / 100 for i, c in enumerate(columns, 1)}
    assert limits.noise_profile(outlets).first().asDict() == want


def test_noise_profile_keeps_a_version_one_row(spark):
    """No row for each attribute: a version is not multiplied on its way to the counts."""
    _, outlets = outlet_versions(spark)
    assert "Expand" not in limits.noise_profile(outlets)._jdf.queryExecution().executedPlan().toString()


def test_each_point_in_time_join_is_a_step_of_its_own(spark):
    """What a join gives can be stored before the next one shuffles; results stay the same."""
    facts = [(1, 1, "o1", "s1", dt.datetime(2025, 1, 1)), (2, 1, "o2", None, dt.datetime(2025, 1, 3)), (3, 1, None, "s1", None)]
    sales = spark.createDataFrame(facts, "txn_id int, txn_line_no int, outlet_code string, sku_code string, event_ts_ist timestamp_ntz")
    window = (7, dt.datetime(2024, 1, 1), dt.datetime(9999, 12, 31))
    outlets, products = (
        spark.createDataFrame([(f"{c[0]}1", *window)], f"{c} string, version_no bigint, valid_from timestamp_ntz, valid_to timestamp_ntz")
        for c in ("outlet_code", "sku_code")
    )
    seen = []
    got = marts.with_versions(sales, outlets, products, step=lambda df: seen.append(df.columns[-1]) or df)
    assert seen == list(marts.VERSION_KEYS)
    assert sorted((r[0], r[5], r[6]) for r in got.collect()) == [(1, 7, 7), (2, None, None), (3, None, None)]
