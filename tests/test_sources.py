"""The delivered layout: drift, unreadable files, missing inputs, rebuild."""

import datetime as dt
import pathlib

import pytest
from pyspark.sql import functions as F

from stocktide.plans import checks, marts, staging
from stocktide.plans.warehouse import Feeds, Models, build_tables
from stocktide.sources import feeds, sample, schemas

SF = "/root/testdata/sf0.001"


def test_drifting_feed_keeps_both_spellings(spark, tmp_path):
    root = str(tmp_path)
    before = spark.range(2).select(F.lit("t1").alias("txn_id"), F.col("id").cast("smallint").alias("txn_line_no"), F.lit(5).alias("qty"))
    after = spark.range(3).select(F.lit("t2").alias("txn_id"), F.col("id").cast("smallint").alias("txn_line_no"), F.lit(7).alias("quantity_units"), F.lit("EA").alias("uom"))
    before.write.parquet(f"{root}/raw/pos_transactions/ingest_date=2025-09-30")
    after.write.parquet(f"{root}/raw/pos_transactions/ingest_date=2025-10-01")
    df = feeds.scan_feed(spark, root, "pos_transactions")
    assert dict(df.dtypes)["ingest_date"] == "date"
    got = {(r["ingest_date"], r["qty"], r["quantity_units"], r["uom"]): r["count"] for r in df.groupBy("ingest_date", "qty", "quantity_units", "uom").count().collect()}
    assert got == {(dt.date(2025, 9, 30), 5, None, None): 2, (dt.date(2025, 10, 1), None, 7, "EA"): 3}


def test_unreadable_file_is_skipped_and_its_siblings_stay(spark, tmp_path):
    root = str(tmp_path)
    day = pathlib.Path(f"{root}/raw/reefer_telemetry/dt=2025-07-14")
    readings = sample.feed(spark, SF, "feed_telemetry").drop("dt")
    readings.repartition(2).write.parquet(str(day))
    files = sorted(day.glob("part-*.parquet"))
    whole = [spark.read.parquet(str(f)).count() for f in files]
    content = files[0].read_bytes()
    files[0].write_bytes(content[: len(content) * 72 // 100])
    with pytest.raises(Exception):
        feeds.scan_feed(spark, root, "reefer_telemetry").count()
    kept = feeds.scan_feed(spark, root, "reefer_telemetry", skip_files=[f"dt=2025-07-14/{files[0].name}"], source_file="file")
    assert kept.count() == whole[1]
    assert kept.select("file").distinct().count() == 1


def test_missing_inputs_stop_the_build(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="wms_scan_events"):
        Feeds.delivered(spark, str(tmp_path))


def delivered(spark, root):
    """The given tables written in the delivered layout, one folder per feed."""
    given = Feeds.from_tables(spark, SF)
    for name, df in given.raw.items():
        column = schemas.PARTITION_COLUMN[name]
        # Few folders keep the test quick: the days of each month share one.
        monthly = df.withColumn(column, F.trunc(column, "month"))
        feeds.write_feed(monthly, root, name, column)
    csv = {"uom_conversion": given.uom, "warehouse_master": given.warehouses, "carrier_master": given.carriers,
           "legacy_finance_weekly_report": given.legacy,
           "fiscal_calendar": given.calendar.withColumn("is_weekend", F.col("is_weekend").cast("int"))}
    for name, df in csv.items():
        df.coalesce(1).write.option("header", True).csv(f"{root}/reference/{name}.csv")
    given.manifest.coalesce(1).write.option("header", True).csv(f"{root}/_manifest/expected_partitions.csv")
    return given


def test_build_from_the_delivered_layout_twice(spark, tmp_path):
    root = f"{tmp_path}/data"
    given = delivered(spark, root)
    assert feeds.missing_inputs(spark, root) == []
    store = f"{tmp_path}/tables"
    built = build_tables(Feeds.delivered(spark, root), store)
    counts = lambda m: {r["model"]: r["row_count"] for r in checks.row_counts({n: getattr(m, n) for n in (*Models.NAMES, Models.VIEW)}).collect()}
    one = counts(built)
    built = build_tables(Feeds.delivered(spark, root), store)
    assert one == counts(built)
    lazy = Models(given)
    assert one["fct_sales"] == one["rpt_sales_flat"] == lazy.fct_sales.count()
    assert one["dim_outlet"] == lazy.dim_outlet.count()
    assert spark.table(Models.VIEW).count() == one["rpt_sales_flat"]
    current = built.dim_outlet.groupBy("outlet_code").agg(F.sum(F.col("is_current").cast("int")).alias("n"), F.max("is_deleted").alias("gone"))
    assert current.where("n <> CASE WHEN gone THEN 0 ELSE 1 END").count() == 0


def test_calendar_rule_matches_known_days(spark):
    bounds = spark.createDataFrame([(dt.date(2025, 3, 31), dt.date(2025, 4, 5))], "first_day date, last_day date")
    rows = [tuple(r) for r in marts.calendar_between(bounds).orderBy("calendar_date").collect()]
    assert rows[0] == (dt.date(2025, 3, 31), "FY25", "Q4", 12, 14, "Monday", False)
    assert rows[1][1:4] == ("FY26", "Q1", 1)
    assert rows[5][5:] == ("Saturday", True)


def test_conflicting_duplicate_lines_resolve_the_same_way(spark):
    raw = sample.feed(spark, SF, "feed_pos")
    once = staging.stg_pos_transactions(raw)
    again = staging.stg_pos_transactions(raw.repartition(3, "sku_code"))
    assert once.exceptAll(again).count() == 0 and again.exceptAll(once).count() == 0


def test_unreadable_files_are_found_by_a_job(spark, tmp_path):
    rows = [(f"s{i}", dt.date(2025, 1, 1 + i % 3)) for i in range(9)]
    spark.createDataFrame(rows, "scan_id string, dt date").repartition(2).write.partitionBy("dt").parquet(f"{tmp_path}/raw/wms_scan_events")
    whole = next((tmp_path / "raw/wms_scan_events/dt=2025-01-02").glob("*.parquet"))
    (whole.parent / "part-cut.parquet").write_bytes(whole.read_bytes()[:-20])
    (whole.parent / "part-text.parquet").write_bytes(b"no table")
    found = {r["file"] for r in feeds.rowless_files(spark, str(tmp_path), "wms_scan_events").collect()}
    assert found == {"dt=2025-01-02/part-cut.parquet", "dt=2025-01-02/part-text.parquet"}
    assert feeds.scan_feed(spark, str(tmp_path), "wms_scan_events", skip_files=sorted(found)).count() == 9
