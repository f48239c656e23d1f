"""Headline timings as one JSON line.

The feeds are landed first as plain Parquet (the reference starts from landed feeds, so this is reported but not
counted). Counted are a full rebuild of the tables in a warm session, and each headline query over the built tables;
the first build of the session, most of which is class compilation, is reported beside it.
"""

from __future__ import annotations

import contextlib
import json
import os
import sys
import time
from functools import partial

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from stocktide.operators.asof import asof_join
from stocktide.plans import checks, dq, finance, kpi, limits, routing
from stocktide.plans.warehouse import Feeds, Frames, build_tables
from stocktide.session import local_session, scratch_path
from stocktide.sources import sample
from stocktide.sources.feeds import write_table

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def landed(spark, feeds: Feeds, root: str) -> Feeds:
    """The same feeds read back from Parquet, a file per core as a delivered feed would have many."""
    raw = {n: partial(_stored, write_table(df.repartition(int(CPUS)), f"{root}/raw/{n}")) for n, df in feeds.raw.items()}
    reference = {n: partial(_stored, write_table(df, f"{root}/reference/{n}")) for n, df in feeds.reference.items()}
    questions = write_table(sample.feed(spark, SF_DIR, "questions").repartition(int(CPUS)), f"{root}/questions")
    return Feeds(Frames(raw), Frames({**reference, "questions": partial(_stored, questions)}))


def _stored(df):
    return df


def headline(m, spark):
    sales, flat, orders, readings = m.fct_sales, m.rpt_sales_flat, m.fct_orders, m.fct_cold_chain_readings
    questions = m.feeds.reference["questions"]
    carried = lambda: asof_join(
        sales.select("txn_id", "txn_line_no", "outlet_code", "event_ts_ist"), m.dim_outlet, fact_key="outlet_code",
        fact_ts="event_ts_ist", version_key="outlet_code", attrs={"version_no": "version_no"},
    )
    return {
        "rpt_sales_flat": lambda: flat,
        "asof_scd2_join": carried,
        "kpi_gross_by_channel": lambda: kpi.gross_by_channel(sales, m.dim_calendar, "FY00", "Q3"),
        "kpi_sales_summary": lambda: kpi.sales_summary(sales, "month"),
        "kpi_sales_summary_category": lambda: kpi.sales_summary(flat, "category"),
        "kpi_units_sold": lambda: kpi.units_sold(sales),
        "kpi_units_eaches": lambda: kpi.units_in_eaches(sales),
        "kpi_top_products": lambda: kpi.top_products(flat, 10, sales=sales),
        "kpi_top_outlets": lambda: kpi.top_outlets(flat, 10),
        "kpi_top_categories": lambda: kpi.top_categories(flat),
        "kpi_recon_bases": lambda: finance.recon_bases(m.rpt_finance_reconciliation),
        "kpi_recon_corr": lambda: finance.recon_correlation(m.rpt_finance_reconciliation),
        "kpi_order_value": lambda: kpi.order_value(orders),
        "kpi_excursion_month": lambda: kpi.excursion_by_month(readings),
        "kpi_gateway_holes": lambda: dq.gateway_holes(readings, m.feeds.feed_calendar),
        "dq_verdict": lambda: dq.publish_verdict(m.dq_partition_reconciliation, m.dq_feed_completeness, m.dq_gateway_health),
        "x01_spread": lambda: limits.vehicle_spread(readings),
        "x02_items": lambda: limits.items_per_journey(m.stg_wms_scan_events),
        "x03_noise_profile": lambda: limits.noise_profile(m.dim_outlet),
        "check_channel_match": lambda: checks.channel_match(sales, m.dim_outlet),
        "route_pick": lambda: routing.picked(questions, ["conv_id", "turn"]),
    }


def run(df) -> None:
    df.write.mode("overwrite").format("noop").save()


def main() -> None:
    with contextlib.redirect_stdout(sys.stderr):
        spark = local_session(CPUS)
        clock = time.perf_counter
        started = clock()
        feeds = landed(spark, Feeds.from_tables(spark, SF_DIR), scratch_path(spark, "landed"))
        setup = clock() - started

        times = {}
        store = scratch_path(spark, "tables")
        started = clock()
        build_tables(feeds, store)
        cold = clock() - started
        started = clock()
        models = build_tables(feeds, store)
        times["build_tables"] = clock() - started
        for name, query in headline(models, spark).items():
            started = clock()
            run(query())
            times[name] = clock() - started
        raw_rows = checks.row_counts(feeds.raw).agg({"row_count": "sum"}).first()[0]
        spark.stop()
    print(json.dumps({
        "metric": "full build of all tables plus headline queries", "value": round(sum(times.values()), 3),
        "unit": "sec", "queries": {n: round(t, 3) for n, t in times.items()},
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"), "raw_rows": raw_rows,
        "landing_sec_not_counted": round(setup, 3), "first_build_sec_not_counted": round(cold, 3),
    }))


if __name__ == "__main__":
    main()
