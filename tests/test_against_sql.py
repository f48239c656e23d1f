"""Registered queries against their SQL over the smallest given tables (the runner covers every query)."""

import pytest

from oracle.compare import compare, connect
from oracle.queries import all_sql
from stocktide.registry import QUERIES

SF = "/root/testdata/sf0.001"
SQL = all_sql()
CHECKED = (
    "scan_skip_corrupt", "dedup_keep_first", "dedup_cdc_guard", "cdc_version_no", "scd2_windows", "canonical_snapshot",
    "asof_scd2_join", "asof_hot_day", "diff_stored_builds", "sparse_dock_health", "series_outliers", "week_bucket_join", "median_agg", "percentiles_of_doubles", "percentiles_of_moments", "multi_distinct", "trailing_mean", "fct_sales",
    "fct_warehouse_cycle_time", "dq_partition_reconciliation", "dq_feed_completeness", "rpt_finance_reconciliation",
    "rpt_sales_flat", "kpi_gross_by_channel", "kpi_top_products", "kpi_order_value", "x01_spread",
    "order_noise_profile", "series_day_percentiles", "route_pick", "route_period",
)


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", CHECKED)
def test_matches_sql(spark, con, name):
    assert compare(spark, con, SF, name, QUERIES[name], SQL[name]) is None


def test_no_python_workers_in_any_plan(spark):
    for name in ("rpt_sales_flat", "route_pick", "dq_feed_completeness"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "CartesianProduct" not in plan


def test_completeness_counts_every_row_of_every_feed(spark):
    from stocktide.plans.warehouse import Feeds, Models

    m = Models(Feeds.from_tables(spark, SF))
    seen = {r["feed"]: r["n"] for r in m.dq_feed_completeness.groupBy("feed").agg({"rows_present": "sum"}).toDF("feed", "n").collect()}
    assert seen == {name: frame.count() for name, frame in m.feeds.watched.items()}
    assert all(seen.values())


def test_gaps_are_planted_only_where_completeness_looks(spark):
    from stocktide.plans.warehouse import Feeds

    feeds = Feeds.from_tables(spark, SF)
    events = spark.read.parquet(f"{SF}/events.parquet")
    assert feeds.raw["wms_scan_events"].count() == events.count() > feeds.watched["wms_scan_events"].count()
    assert feeds.raw["reefer_telemetry"].count() == events.count() + events.where("event_id % 31 = 0").count()
    assert feeds.watched["reefer_telemetry"].count() < feeds.raw["reefer_telemetry"].count()


@pytest.mark.parametrize(("name", "scans"), [("check_scd2_integrity", 40), ("check_delete_resurrection", 8), ("order_noise_profile", 12)])
def test_shared_inputs_are_computed_once(spark, name, scans):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") <= scans


def test_second_build_is_dealt_by_size_not_over_five_tasks(spark):
    plan = QUERIES["diff_builds"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "RebalancePartitions" in plan and "RepartitionByExpression" not in plan


def test_a_month_of_the_first_build_is_not_a_file_of_each_task(spark):
    """Four tasks hold rows of every month here; dealt by month, each month is one file."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        files = QUERIES["diff_stored_builds"](spark, SF).inputFiles()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    months = [f.rsplit("/", 2)[1] for f in files if "/first/" in f]
    assert len(months) == len(set(months)) > 50


@pytest.mark.parametrize("name", ["check_dedup_counts", "model_row_counts"])
def test_feeds_are_counted_one_after_another(spark, name):
    """What is returned reads stored counts: no feed's shuffled rows wait for those of the next."""
    files = QUERIES[name](spark, SF).inputFiles()
    assert files and all("/counts-" in f for f in files)


def test_flat_columns_store_what_the_first_join_gives(spark):
    files = QUERIES["rpt_sales_flat"](spark, SF).inputFiles()
    assert any("/with_products/" in f for f in files) and not any("/lines/" in f for f in files)


def test_build_keeps_no_step(spark, tmp_path):
    import os

    from stocktide.plans.warehouse import Feeds, Models

    lazy, stored = (Models(Feeds.from_tables(spark, SF), store) for store in (None, str(tmp_path / "tables")))
    sales = stored.fct_sales
    assert set(os.listdir(tmp_path / "tables")) == {"stg_pos_transactions", "stg_outlet_history", "stg_product_history", "dim_outlet", "dim_product", "fct_sales"}
    assert sales.drop("outlet_version_no", "product_version_no").exceptAll(lazy.fct_sales).isEmpty()
    assert sales.count() == lazy.fct_sales.count()
