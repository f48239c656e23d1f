"""Every query by name. Each takes the lazily composed models over the given tables and runs over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from stocktide.functions import cleaning as clean
from stocktide.functions.numbers import as_double, count_where, round_to
from stocktide.operators import changes, completeness, dedup, quantiles, reconcile
from stocktide.operators.asof import asof_join
from stocktide.operators.shares import share_of_groups
from stocktide.plans import checks, dq, finance, incremental, kpi, limits, marts, routing, staging
from stocktide.plans.marts import VERSION_KEYS
from stocktide.plans.warehouse import Feeds, Models, build_tables
from stocktide.session import scratch_path
from stocktide.sources import feeds as scans
from stocktide.sources import sample, schemas

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# Parameters the registered queries run with; the fiscal quarter is inside the given data.
FISCAL_YEAR, FISCAL_QUARTER = "FY00", "Q3"
TOP_N = 25


def query(build: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Register a function of the models under its own name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(Models(Feeds.from_tables(spark, sf_dir)))

    QUERIES[build.__name__] = run
    return build


def stored_query(build: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Register a function of the flat view: the tables under it are written first, which cuts the lineage and lets
    the dimensions be measured before a join is chosen."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(Models(Feeds.from_tables(spark, sf_dir), scratch_path(spark, "tables")))

    QUERIES[build.__name__] = run
    return build


def located_query(build: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Register a function of (spark, sf_dir)."""
    QUERIES[build.__name__] = build
    return build


def kept(df: DataFrame, label: str) -> DataFrame:
    """The frame stored in the scratch folder: what reads it several times computes it once."""
    return scans.write_table(df, scratch_path(df.sparkSession, label))


def rows():
    return F.count(F.lit(1))


def end_text():
    """The open end of a version lies beyond what nanosecond clients can hold: results carry it as text."""
    return F.col("valid_to").cast("string").alias("valid_to")


# --- sources and sinks -------------------------------------------------------------------------------------------


@located_query
def scan_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "delivered")
    scans.write_feed(sample.feed(spark, sf_dir, "feed_wms"), root, "wms_scan_events", "dt")
    return scans.scan_feed(spark, root, "wms_scan_events").groupBy("dt", "event_type").agg(
        rows().alias("scans"), F.sum("qty_cases").alias("cases"), F.max("event_ts").alias("latest")
    )


@located_query
def scan_schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files before the drift lack the new columns, files after it lack the old one."""
    root = scratch_path(spark, "delivered")
    pos = sample.feed(spark, sf_dir, "feed_pos")
    before = pos.where("qty IS NOT NULL").drop("quantity_units", "uom", "loyalty_id")
    after = pos.where("quantity_units IS NOT NULL").drop("qty")
    before.write.parquet(f"{root}/raw/pos_transactions/period=before")
    after.write.parquet(f"{root}/raw/pos_transactions/period=after")
    schema = schemas.FEEDS["pos_transactions"] + ", period string"
    drifted = scans.scan_feed(spark, root, "pos_transactions", schema=schema)
    return drifted.groupBy("period", "uom").agg(
        rows().alias("lines"), F.sum("qty").alias("qty"), F.sum("quantity_units").alias("quantity_units"),
        F.sum(clean.renamed("quantity_units", "qty")).alias("qty_original"), F.count("loyalty_id").alias("loyal_lines"),
    )


@located_query
def scan_skip_corrupt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One unreadable file is left out by name; the day's other files count."""
    root = scratch_path(spark, "delivered")
    scans.write_feed(sample.feed(spark, sf_dir, "feed_telemetry"), root, "reefer_telemetry", "dt")
    bad = "dt=2024-01-14/part-unreadable.parquet"
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/raw/reefer_telemetry/{bad}")
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path, True)
    out.write(bytearray(b"PAR1 cut short"))
    out.close()
    readings = scans.scan_feed(spark, root, "reefer_telemetry", skip_files=[bad], source_file="file")
    return readings.groupBy("dt").agg(
        rows().alias("readings"), count_where(F.col("file").isNull()).alias("without_file"),
        count_where(F.col("temp_value").isNull()).alias("null_values"),
    )


@located_query
def scan_found_corrupt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two files that were cut short are found by a job over file names, then left out; their siblings stay."""
    root, feed = scratch_path(spark, "delivered"), "reefer_telemetry"
    scans.write_feed(sample.feed(spark, sf_dir, "feed_telemetry"), root, feed, "dt")
    for day in ("2024-01-14", "2024-01-20"):
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/raw/{feed}/dt={day}/part-cut.parquet")
        out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path, True)
        out.write(bytearray(b"PAR1 cut short"))
        out.close()
    found = [r["file"] for r in scans.rowless_files(spark, root, feed).select("file").collect()]  # what a delivery broke
    cut = F.lit(len([f for f in found if f.endswith("part-cut.parquet")])).cast("long")
    readings = scans.scan_feed(spark, root, feed, skip_files=found)
    return readings.groupBy("dt").agg(rows().alias("readings"), count_where(F.col("temp_value").isNull()).alias("null_values")).withColumn("cut_files", cut)


@located_query
def scan_csv_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "delivered")
    sample.feed(spark, sf_dir, "ref_uom").write.option("header", True).csv(f"{root}/reference/uom_conversion.csv")
    return scans.scan_reference(spark, root, "uom_conversion")


@located_query
def build_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    built = build_tables(Feeds.from_tables(spark, sf_dir), scratch_path(spark, "tables"))
    return checks.row_counts({n: getattr(built, n) for n in (*Models.NAMES, Models.VIEW)})


QUERIES["build_tables"] = QUERIES.pop("build_all")


#: Models over one feed, which exchange its rows once if they are counted together.
OF_ONE_FEED = (
    ("stg_pos_transactions", "fct_sales", "rpt_finance_reconciliation"), ("stg_reefer_telemetry", "fct_cold_chain_readings"),
    ("stg_wms_scan_events", "fct_warehouse_cycle_time"), ("stg_outlet_history", "dim_outlet"), ("stg_product_history", "dim_product"),
    ("stg_sales_order_header", "fct_orders"),
)


@query
def model_row_counts(m: Models) -> DataFrame:
    """Feed by feed, so that disk holds the shuffled rows of one feed at a time; models over all feeds come last."""
    others = tuple(n for n in Models.NAMES if not any(n in group for group in OF_ONE_FEED))
    parts = [kept(checks.row_counts({n: getattr(m, n) for n in group}), "counts") for group in (*OF_ONE_FEED, others)]
    return reduce(DataFrame.unionByName, parts)


# --- row-level rules ---------------------------------------------------------------------------------------------


@query
def utc_to_business_day(m: Models) -> DataFrame:
    utc = clean.wall_clock("event_ts")
    return m.feeds.raw["pos_transactions"].select(
        "txn_id", "txn_line_no", utc.alias("event_ts_utc"), clean.business_time(utc).alias("event_ts_ist"),
        clean.business_date(utc).alias("event_date_ist"),
    )


@query
def drift_coalesce(m: Models) -> DataFrame:
    return m.feeds.raw["pos_transactions"].select(
        "txn_id", "txn_line_no", clean.renamed("quantity_units", "qty").alias("qty_original"),
        F.col("uom").isNull().alias("uom_unknown_flag"),
    )


@query
def late_arrival_flag(m: Models) -> DataFrame:
    day = clean.business_date(clean.wall_clock("event_ts"))
    return m.feeds.raw["pos_transactions"].select(
        "txn_id", "txn_line_no", "ingest_date", clean.is_late("ingest_date", day).alias("is_late_arrival")
    )


@query
def clock_skew_fix(m: Models) -> DataFrame:
    clock = clean.wall_clock("reading_ts")
    return m.feeds.raw["reefer_telemetry"].select(
        "device_id", "firmware_version", clock.alias("reading_ts"),
        clean.deskew(clock, "firmware_version").alias("reading_ts_corrected"),
    )


@query
def unit_inference(m: Models) -> DataFrame:
    unit = clean.resolved_unit("temp_unit", "telemetry_vendor")
    return m.feeds.raw["reefer_telemetry"].groupBy("telemetry_vendor", "temp_unit", unit.alias("temp_unit_resolved")).agg(
        rows().alias("readings")
    )


@query
def unit_normalise(m: Models) -> DataFrame:
    unit = clean.resolved_unit("temp_unit", "telemetry_vendor")
    return m.feeds.raw["reefer_telemetry"].select(
        "device_id", "gps_lat", "gps_lon", "dt", "temp_value", clean.to_celsius("temp_value", unit).alias("temp_value_celsius"),
        F.col("temp_value").isNull().alias("temp_reading_missing"),
    )


@query
def band_flags(m: Models) -> DataFrame:
    return m.fct_cold_chain_readings.groupBy("temp_reading_missing", "is_excursion", "is_below_band").agg(
        rows().alias("readings"), F.min("temp_value_celsius").alias("lowest"), F.max("temp_value_celsius").alias("highest")
    )


@query
def freight_correction(m: Models) -> DataFrame:
    return m.feeds.raw["erp_cdc/sales_order_header"].select(
        "order_number", F.col("__seq").alias("seq"), "source_system", "order_value_gross",
        clean.deflated("order_value_gross", "source_system").alias("order_value_gross_corrected"),
    )


@query
def sales_measures(m: Models) -> DataFrame:
    return m.fct_sales.select(
        "txn_id", "txn_line_no", "qty_original", "unit_price", "discount_amount", "tax_amount",
        "gross_sales_amount", "net_sales_amount", "sales_amount_incl_tax",
    )


@query
def units_eaches_line(m: Models) -> DataFrame:
    return m.fct_sales.select(
        "txn_id", "txn_line_no", "qty_original", "uom_original", "eaches_per_case", "uom_conversion_missing", "qty_eaches"
    )


# --- windows -----------------------------------------------------------------------------------------------------


@query
def dedup_keep_first(m: Models) -> DataFrame:
    return dedup.keep_first(m.feeds.raw["pos_transactions"], ["txn_id", "txn_line_no"], ["ingest_date"])


@query
def dedup_composite(m: Models) -> DataFrame:
    kept = dedup.keep_first(m.feeds.raw["reefer_telemetry"], ["device_id", "reading_ts", "gps_lat", "gps_lon"], ["dt"])
    return kept.select(
        "device_id", clean.wall_clock("reading_ts").alias("reading_ts"), "gps_lat", "gps_lon", "dt", "temp_value", "temp_unit"
    )


@query
def dedup_cdc_guard(m: Models) -> DataFrame:
    kept = dedup.keep_first(
        staging.change_rows(m.feeds.raw["erp_cdc/product_master"]), ["sku_code", "seq"], ["extract_date", "op_ts"]
    )
    return kept.select("sku_code", "seq", "op_type", "op_ts", "extract_date", "brand", "mrp")


@query
def cdc_version_no(m: Models) -> DataFrame:
    return m.stg_product_history.select("sku_code", "seq", "op_ts", "version_no")


@query
def scd2_windows(m: Models) -> DataFrame:
    return changes.validity_windows(m.stg_outlet_history, "outlet_code").select(
        "outlet_code", "version_no", "seq", "valid_from", end_text(), "is_last_version", "is_deleted", "is_current"
    )


@query
def ever_deleted(m: Models) -> DataFrame:
    return m.stg_outlet_history.groupBy("outlet_code").agg(
        F.max(clean.is_delete("op_type")).alias("is_deleted"), rows().alias("versions")
    )


@query
def canonical_snapshot(m: Models) -> DataFrame:
    return changes.canonical_snapshot(m.stg_sales_order_header, "order_number").select(
        "order_number", "op_type", "op_ts", "seq", "version_no", "order_value_gross", "is_ever_deleted"
    )


@query
def dominant_value(m: Models) -> DataFrame:
    return dedup.most_common(m.stg_wms_scan_events, "order_number", "warehouse_code", "dominant_warehouse_code")


@query
def median_baseline(m: Models) -> DataFrame:
    filled = completeness.zero_filled(
        dq.source_days(m.watched_readings), ["gateway_id"], m.feeds.feed_calendar, day="dt", count="readings"
    )
    return completeness.with_median(filled, ["gateway_id"], "readings", "gateway_median")


@query
def trailing_mean(m: Models) -> DataFrame:
    daily = m.stg_pos_transactions.groupBy("channel", F.col("event_date_ist").alias("d")).agg(rows().alias("n"))
    filled = completeness.zero_filled(daily, ["channel"], m.dim_calendar, day="d", count="n")
    return completeness.with_trailing_mean(filled, ["channel"], "calendar_date", "n", "trailing_28d_mean").withColumn(
        "trailing_28d_mean", round_to("trailing_28d_mean", 6)
    )


@query
def share_of_total(m: Models) -> DataFrame:
    grouped = m.fct_sales.groupBy("payment_mode", "channel_at_sale").agg(F.sum("gross_sales_amount").alias("_gross"))
    return grouped.select(
        "payment_mode", "channel_at_sale", as_double("_gross").alias("gross_sales"), share_of_groups("_gross").alias("pct_of_total")
    )


# --- in steps ----------------------------------------------------------------------------------------------------


@located_query
def cdc_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product changes applied in three batches that cut across keys and times: the versions of a full rebuild."""
    log = staging.change_rows(sample.feed(spark, sf_dir, "feed_product"))
    store = incremental.ChangeStore(spark, scratch_path(spark, "history"), log.schema, "sku_code", buckets=16)
    for part in (2, 0, 1):
        store.apply(log.where(F.pmod(F.xxhash64("seq", "extract_date"), F.lit(3)) == part), f"part {part}")
    return store.history().select("sku_code", "seq", "op_ts", "version_no")


@located_query
def late_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that arrive three days late are merged into the months they touch: first deliveries of all lines."""
    pos = sample.feed(spark, sf_dir, "feed_pos").withColumn("month", F.substring("event_ts", 1, 7))
    late, keys = F.col("txn_line_no") == 7, ["txn_id", "txn_line_no"]
    path = scratch_path(spark, "lines")
    scans.overwrite_partitions(dedup.keep_first(pos.where(~late), keys, ["ingest_date"]), path, "month")
    incremental.merge_late(path, pos.where(late), keys, ["ingest_date"], "month")
    return spark.read.schema(pos.schema).parquet(path).drop("month")


@located_query
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings as a stream of files, copies dropped by the engine's state; the watermark is wider than the feed's days."""
    feed, root = sample.feed(spark, sf_dir, "feed_telemetry"), scratch_path(spark, "stream")
    feed.write.parquet(f"{root}/in")
    at = clean.wall_clock("reading_ts").cast(TimestampType())
    kept = incremental.stream_first(spark, f"{root}/in", feed.schema, f"{root}/out", ["device_id", "reading_ts", "gps_lat", "gps_lon"], at, "400 days")
    return kept.select("device_id", clean.wall_clock("reading_ts").alias("reading_ts"), "gps_lat", "gps_lon", "dt", "temp_value", "temp_unit")


# --- joins -------------------------------------------------------------------------------------------------------


@query
def lookup_left(m: Models) -> DataFrame:
    factors = m.feeds.uom.select("sku_code", "eaches_per_case")
    lines = m.stg_pos_transactions.select("txn_id", "txn_line_no", "sku_code").join(factors, "sku_code", "left")
    return lines.select("txn_id", "txn_line_no", "sku_code", "eaches_per_case")


@query
def asof_scd2_join(m: Models) -> DataFrame:
    """Raw lines against the outlet version of their time: nothing fans out, nothing is lost."""
    utc = clean.wall_clock("event_ts")
    lines = m.feeds.raw["pos_transactions"].select("txn_id", "txn_line_no", "outlet_code", clean.business_time(utc).alias("event_ts_ist"))
    return asof_join(
        lines, m.dim_outlet, fact_key="outlet_code", fact_ts="event_ts_ist", version_key="outlet_code",
        attrs={"version_no": "version_no", "outlet_channel": "channel", "warehouse_code": "warehouse_code"},
    )


@query
def asof_hot_day(m: Models) -> DataFrame:
    """Three sevenths of the lines and a third of the versions moved to one key and one day, which is split.

    Times of that day are made from the line, so that every range of it is open; some versions begin at one time.
    """
    day = F.lit("1996-06-15").cast("timestamp_ntz")
    at = lambda seconds: (day + F.make_dt_interval(secs=seconds % 86400))
    number = lambda c: F.col(c).cast("long")
    hot = F.col("txn_line_no") <= 3
    lines = m.stg_pos_transactions.select(
        "txn_id", "txn_line_no", F.when(hot, "HOT").otherwise(F.col("outlet_code")).alias("key"),
        F.when(hot, at(number("sku_code") * 7919 + number("txn_id") * 31)).otherwise(F.col("event_ts_ist")).alias("at"),
    )
    moved = F.col("version_no") % 3 == 0
    versions = m.dim_outlet.select(
        F.when(moved, "HOT").otherwise(F.col("outlet_code")).alias("k"),
        F.when(moved, at(number("outlet_code") * 101 + F.col("version_no") * 13)).otherwise(F.col("valid_from")).alias("valid_from"),
        (number("outlet_code") * 100_000 + F.col("version_no")).alias("version"), "warehouse_code",
    )
    return asof_join(
        lines, versions, fact_key="key", fact_ts="at", version_key="k", valid_to=None, tie="version",
        attrs={"version": "version", "warehouse_code": "warehouse_code"}, hot_rows=2_000,
    )


@query
def week_bucket_join(m: Models) -> DataFrame:
    weeks = m.feeds.legacy.select(F.col("week_ending").alias("week_start")).distinct()
    return reconcile.in_weeks(m.fct_sales, "event_date_ist", weeks).groupBy("week_start").agg(
        rows().alias("lines"), F.countDistinct("basket_id").alias("baskets"),
        as_double(F.sum("gross_sales_amount")).alias("gross_sales"),
    )


@query
def full_outer_reconcile(m: Models) -> DataFrame:
    expected = m.feeds.manifest.select("feed", "partition", F.col("row_count").alias("expected_rows"))
    actual = dq.partition_counts({n: m.feeds.watched[n] for n in schemas.MANIFEST_FEEDS})
    return reconcile.full_reconcile(expected, actual, ["feed", "partition"])


@query
def calendar_spine(m: Models) -> DataFrame:
    return completeness.calendar_spine(m.fct_cold_chain_readings.select("device_id").distinct(), m.feeds.feed_calendar)


@query
def spine_zero_fill(m: Models) -> DataFrame:
    daily = dq.source_days(m.watched_readings, ["device_id"])
    return completeness.zero_filled(daily, ["device_id"], m.feeds.feed_calendar, day="dt", count="readings")


def watched_days(m: Models) -> DataFrame:
    return m.feeds.feed_calendar.agg(F.min("calendar_date").alias("first_day"), F.max("calendar_date").alias("last_day"))


@query
def sparse_dock_health(m: Models) -> DataFrame:
    """Docks of warehouses with silent runs and degraded days, from observed days alone."""
    return dq.sparse_health(m.feeds.watched["wms_scan_events"], watched_days(m), ["warehouse_code", "dock_door"], "dt")


@query
def silent_tills(m: Models) -> DataFrame:
    """Silent runs of every outlet over the years of the calendar."""
    calendar = m.dim_calendar.agg(F.min("calendar_date").alias("first_day"), F.max("calendar_date").alias("last_day"))
    tills = m.stg_pos_transactions.select("outlet_code", "event_date_ist")
    return completeness.silent_runs(tills, ["outlet_code"], calendar, day="event_date_ist")


@query
def series_outliers(m: Models) -> DataFrame:
    """Days of a device or a gateway far from its middle, by median and MAD."""
    filled = completeness.zero_filled(
        dq.source_days(m.watched_readings, ["gateway_id"]), ["gateway_id"], m.feeds.feed_calendar, day="dt", count="readings"
    )
    return dq.outlying_days(filled, ["gateway_id"], "readings").drop("day_absent")


@query
def scalar_verdict(m: Models) -> DataFrame:
    return dq_verdict(m)


# --- aggregations, sorts, set operations -------------------------------------------------------------------------


@query
def multi_distinct(m: Models) -> DataFrame:
    columns = ("basket_id", "outlet_code", "sku_code", "event_date_ist")
    return m.fct_sales.groupBy("channel_at_sale").agg(*[F.countDistinct(c).alias(f"n_{c}") for c in columns])


@query
def filtered_agg(m: Models) -> DataFrame:
    readings = m.fct_cold_chain_readings
    return readings.groupBy("telemetry_vendor").agg(
        rows().alias("readings"), count_where(F.col("is_excursion")).alias("above"),
        count_where(F.col("is_below_band")).alias("below"), count_where(F.col("temp_reading_missing")).alias("missing"),
    )


@query
def median_agg(m: Models) -> DataFrame:
    """Exact median of line value per channel, from counts of cents."""
    cents = m.fct_sales.select("channel_at_sale", (F.col("gross_sales_amount") * 100).cast("long").alias("cents"))
    middle = quantiles.exact_median(cents, ["channel_at_sale"], "cents", "m")
    return middle.select("channel_at_sale", (F.col("m") / F.lit(100.0)).alias("median_line_value"))


@stored_query
def percentiles_of_doubles(m: Models) -> DataFrame:
    """Exact percentiles of temperatures and positions as doubles, whatever their range."""
    bounds = {"p01": 0.01, "p50": 0.5, "p99": 0.99}
    readings = m.fct_cold_chain_readings
    parts = []
    for column in ("temp_value_celsius", "gps_lat", "humidity_pct"):
        spread = quantiles.radix_percentiles(readings, ["telemetry_vendor"], column, bounds)
        parts.append(spread.select("telemetry_vendor", F.lit(column).alias("measure"), *[round_to(b, 6).alias(b) for b in bounds]))
    return reduce(DataFrame.unionByName, parts)


@query
def percentiles_of_moments(m: Models) -> DataFrame:
    """First, middle and last moment of sale per channel, in microseconds: whole numbers too wide for one level."""
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("event_ts_ist"))
    moments = kept(m.fct_sales.select("channel_at_sale", micros.alias("at")), "moments")
    return quantiles.radix_percentiles(moments, ["channel_at_sale"], "at", {"first_at": 0.0, "middle_at": 0.5, "last_at": 1.0})


@query
def corr_agg(m: Models) -> DataFrame:
    orders = m.fct_orders
    pair = lambda a, b: round_to(F.corr(as_double(a), as_double(b)), 6)
    return orders.groupBy("source_system").agg(
        pair("order_value_gross", "order_value_gross_corrected").alias("corr_raw_corrected"),
        pair("order_value_gross_corrected", "discount_amount").alias("corr_gross_discount"),
    )


@query
def stage_pivot(m: Models) -> DataFrame:
    return marts.stage_pivot(m.stg_wms_scan_events)


@query
def agg_of_agg(m: Models) -> DataFrame:
    per_outlet = limits.distinct_per(m.fct_sales, "outlet_code", n_baskets="basket_id", n_skus="sku_code")
    return per_outlet.agg(
        rows().alias("outlets"), limits.mean_of("n_baskets", 4).alias("avg_baskets"), F.max("n_skus").alias("max_skus")
    )


@query
def having_distinct(m: Models) -> DataFrame:
    return limits.distinct_per(m.dim_outlet, "outlet_code", n_channels="channel").where("n_channels > 3")


def narrow_flat(spark: SparkSession, m: Models, *columns: str) -> tuple[DataFrame, DataFrame]:
    """Stored lines and, over them, columns of the flat view: no others are stored or travel."""
    return m.flat_columns(scratch_path(spark, "tables"), columns)


@located_query
def sales_summary_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary under every grouping it knows, and under one it does not know, which adds no rows."""
    m = Models(Feeds.from_tables(spark, sf_dir))
    _, flat = narrow_flat(
        spark, m, "event_date_ist", "fiscal_year", "fiscal_quarter", "channel_at_sale", "product_category", "warehouse_region", "basket_id",
        "gross_sales_amount", "discount_amount", "net_sales_amount", "tax_amount", "sales_amount_incl_tax", "is_late_arrival",
    )
    flat = kept(flat, "flat")
    names = [*kpi.GROUPINGS, "weekday"]
    parts = [kpi.sales_summary(flat, group_by=n).select(F.lit(n).alias("group_by"), "*") for n in names]
    return reduce(DataFrame.unionByName, parts)


@query
def top_n(m: Models) -> DataFrame:
    value = m.fct_orders.groupBy("outlet_code").agg(F.sum("order_value_gross_corrected").alias("_v"), rows().alias("orders"))
    return value.orderBy(F.desc("_v"), "outlet_code").limit(TOP_N).select("outlet_code", "orders", as_double("_v").alias("order_value"))


@query
def union_all_feeds(m: Models) -> DataFrame:
    return dq.daily_counts(m.feeds.raw)


# --- models ------------------------------------------------------------------------------------------------------

for _name in (*Models.NAMES, Models.VIEW):

    def _model(m: Models, name: str = _name) -> DataFrame:
        return getattr(m, name).drop(*(VERSION_KEYS if name == "fct_sales" else ()))

    _model.__name__ = _name
    query(_model)


@located_query
def rpt_sales_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return narrow_flat(spark, Models(Feeds.from_tables(spark, sf_dir)), *marts.FLAT_COLUMNS)[1]


@query
def dim_outlet(m: Models) -> DataFrame:
    return m.dim_outlet.withColumn("valid_to", end_text())


@query
def dim_product(m: Models) -> DataFrame:
    return m.dim_product.withColumn("valid_to", end_text())


@query
def dq_partition_reconciliation(m: Models) -> DataFrame:
    return dq.defects_first(m.dq_partition_reconciliation)


@query
def dq_gateway_health(m: Models) -> DataFrame:
    return dq.outages_first(m.dq_gateway_health)


@query
def dim_static(m: Models) -> DataFrame:
    sites = m.dim_warehouse.select(F.lit("warehouse").alias("dimension"), F.col("warehouse_code").alias("code"), F.col("warehouse_name").alias("name"))
    carriers = m.dim_carrier.select(F.lit("carrier").alias("dimension"), F.col("carrier_id").alias("code"), F.col("carrier_name").alias("name"))
    return sites.unionByName(carriers)


# --- KPI library -------------------------------------------------------------------------------------------------


@query
def kpi_gross_by_channel(m: Models) -> DataFrame:
    return kpi.gross_by_channel(m.fct_sales, m.dim_calendar, FISCAL_YEAR, FISCAL_QUARTER)


@query
def kpi_gross_by_channel_1990s(m: Models) -> DataFrame:
    """A quarter before the year 2000, so that labels and years can't be mixed up unseen."""
    return kpi.gross_by_channel(m.fct_sales, m.dim_calendar, "FY97", "Q1")


@query
def kpi_gross_by_fiscal_quarter(m: Models) -> DataFrame:
    return kpi.gross_by_fiscal_quarter(m.fct_sales, m.dim_calendar)


@query
def kpi_gross_by_channel_latest(m: Models) -> DataFrame:
    return kpi.gross_by_channel_last_quarter(m.fct_sales)


@query
def kpi_sales_summary(m: Models) -> DataFrame:
    """By month, for which the facts alone suffice."""
    return kpi.sales_summary(m.fct_sales, group_by="month")


@query
def kpi_units_sold(m: Models) -> DataFrame:
    return kpi.units_sold(m.fct_sales)


@query
def kpi_units_eaches(m: Models) -> DataFrame:
    return kpi.units_in_eaches(m.fct_sales)


@located_query
def kpi_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, flat = narrow_flat(
        spark, Models(Feeds.from_tables(spark, sf_dir)), "event_date_ist", "sku_code", "product_name", "product_category", "product_is_chilled",
        "gross_sales_amount", "qty_eaches",
    )
    return kpi.top_products(flat, TOP_N, sales=lines)


@located_query
def kpi_top_outlets(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("event_date_ist", "outlet_code", "outlet_name", "channel_at_sale", "warehouse_region", "basket_id", "gross_sales_amount")
    return kpi.top_outlets(narrow_flat(spark, Models(Feeds.from_tables(spark, sf_dir)), *columns)[1], TOP_N)


@located_query
def kpi_top_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("event_date_ist", "product_category", "sku_code", "gross_sales_amount")
    return kpi.top_categories(narrow_flat(spark, Models(Feeds.from_tables(spark, sf_dir)), *columns)[1])


@query
def kpi_recon_bases(m: Models) -> DataFrame:
    return finance.recon_bases(m.rpt_finance_reconciliation)


@query
def kpi_recon_bug_impact(m: Models) -> DataFrame:
    return finance.recon_bug_impact(m.rpt_finance_reconciliation)


@query
def kpi_recon_corr(m: Models) -> DataFrame:
    return finance.recon_correlation(m.rpt_finance_reconciliation)


@query
def kpi_order_value(m: Models) -> DataFrame:
    return kpi.order_value(m.fct_orders)


@query
def kpi_excursion_month(m: Models) -> DataFrame:
    return kpi.excursion_by_month(m.fct_cold_chain_readings)


@query
def kpi_null_rate(m: Models) -> DataFrame:
    return dq.null_rate(m.fct_cold_chain_readings).orderBy("telemetry_vendor", "firmware_version")


@query
def kpi_gateway_holes(m: Models) -> DataFrame:
    return dq.gateway_holes(m.watched_readings, m.feeds.feed_calendar).orderBy("gateway_id", "dt")


@query
def dq_short_partitions(m: Models) -> DataFrame:
    return dq.short_partitions(m.dq_partition_reconciliation)


@query
def dq_no_baseline(m: Models) -> DataFrame:
    return dq.no_baseline(m.dq_partition_reconciliation)


@query
def dq_alert_days(m: Models) -> DataFrame:
    return dq.alert_days(m.dq_feed_completeness)


@query
def dq_inner_holes(m: Models) -> DataFrame:
    return dq.inner_holes(m.dq_gateway_health)


@query
def dq_verdict(m: Models) -> DataFrame:
    return dq.publish_verdict(m.dq_partition_reconciliation, m.dq_feed_completeness, m.dq_gateway_health)


@query
def x01_carriers(m: Models) -> DataFrame:
    return m.dim_carrier


@query
def x01_spread(m: Models) -> DataFrame:
    return limits.vehicle_spread(m.fct_cold_chain_readings)


@query
def x01_one_to_one(m: Models) -> DataFrame:
    return limits.devices_on_many_vehicles(m.fct_cold_chain_readings)


@query
def x02_negative(m: Models) -> DataFrame:
    return limits.negative_durations(m.fct_warehouse_cycle_time)


@query
def x02_plausible(m: Models) -> DataFrame:
    return limits.plausible_durations(m.fct_warehouse_cycle_time)


@query
def x02_items(m: Models) -> DataFrame:
    return limits.items_per_journey(m.stg_wms_scan_events)


@query
def x03_changes(m: Models) -> DataFrame:
    return limits.channel_changes(m.dim_outlet)


@query
def x03_noise_profile(m: Models) -> DataFrame:
    changed = m.feeds.raw["erp_cdc/outlet_master"]
    return limits.noise_profile(m.dim_outlet, hot=lambda: changes.hot_keys(changed, "outlet_code", limits.MANY_VERSIONS))


@query
def x03_one_key(m: Models) -> DataFrame:
    """The worked example: the outlet with the most versions."""
    example = limits.busiest_outlet(m.dim_outlet).scalar()
    return limits.one_outlet(m.dim_outlet, example)


@query
def x03_version1(m: Models) -> DataFrame:
    return limits.first_version_channels(m.dim_outlet)


# --- checks ------------------------------------------------------------------------------------------------------


@query
def check_dedup_counts(m: Models) -> DataFrame:
    staged = {
        "pos_transactions": m.stg_pos_transactions, "reefer_telemetry": m.stg_reefer_telemetry,
        "wms_scan_events": m.stg_wms_scan_events, "erp_cdc/outlet_master": m.stg_outlet_history,
        "erp_cdc/product_master": m.stg_product_history, "erp_cdc/sales_order_header": m.stg_sales_order_header,
    }
    # Feed by feed, so that disk holds the shuffled rows of one feed at a time.
    return reduce(DataFrame.unionByName, [kept(checks.dedup_counts({n: (m.feeds.raw[n], s)}), "counts") for n, s in staged.items()])


@query
def check_late_rate(m: Models) -> DataFrame:
    return checks.late_rate(m.stg_pos_transactions)


@query
def check_telemetry_rates(m: Models) -> DataFrame:
    return checks.telemetry_rates(m.stg_reefer_telemetry)


@query
def check_not_null(m: Models) -> DataFrame:
    return checks.null_keys(m.stg_wms_scan_events, ["order_number", "sku_code", "warehouse_code"])


@query
def check_version_ties(m: Models) -> DataFrame:
    return checks.version_ties(m.stg_outlet_history, "outlet_code")


@query
def check_extract_lag(m: Models) -> DataFrame:
    return checks.extract_lag(m.stg_sales_order_header)


@query
def check_delete_resurrection(m: Models) -> DataFrame:
    def changed(history: DataFrame, key: str) -> DataFrame:
        changed = kept(history.select(key, "op_ts", "seq", "op_type", "version_no"), "changes")
        return checks.delete_resurrection(changed, changes.validity_windows(changed, key), key)

    outlet, product = changed(m.stg_outlet_history, "outlet_code"), changed(m.stg_product_history, "sku_code")
    return outlet.select(F.lit("outlet").alias("dimension"), "*").unionByName(product.select(F.lit("product").alias("dimension"), "*"))


@query
def check_scd2_integrity(m: Models) -> DataFrame:
    windows = changes.validity_windows(kept(m.stg_product_history.select("sku_code", "op_ts", "op_type", "version_no"), "changes"), "sku_code")
    dim = kept(windows.select("sku_code", "version_no", "valid_from", "valid_to", "is_deleted", "is_current"), "windows")
    joined = asof_join(
        kept(m.fct_sales.select("sku_code", "event_ts_ist"), "moments"), dim, fact_key="sku_code", fact_ts="event_ts_ist",
        version_key="sku_code", attrs={"product_version_no": "version_no"},
    )
    return checks.scd2_integrity(dim, "sku_code", joined, "product_version_no")


@located_query
def check_stored_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product windows, stored with planted faults: every 7th version ends ten days late, every 11th ten days early."""
    m, root = Models(Feeds.from_tables(spark, sf_dir)), scratch_path(spark, "windows")
    days, number = F.expr("INTERVAL '10' DAY"), F.col("version_no")
    open_end, end = F.col("valid_to") >= F.lit("9999-01-01").cast("timestamp_ntz"), F.col("valid_to")
    faulty = m.dim_product.select("sku_code", "version_no", "valid_from", "valid_to").withColumn(
        "valid_to", F.when(open_end, end).when(number % 7 == 0, end + days).when(number % 11 == 0, end - days).otherwise(end)
    )
    windows = scans.write_table(faulty.where("valid_from < valid_to"), f"{root}/dim_product")
    moments = kept(m.stg_pos_transactions.select("sku_code", "event_ts_ist"), "moments")
    return checks.stored_windows(windows, "sku_code", moments, "event_ts_ist")


@query
def check_channel_match(m: Models) -> DataFrame:
    return checks.channel_match(m.fct_sales, m.dim_outlet)


@query
def vehicle_day_breach(m: Models) -> DataFrame:
    return checks.vehicle_day_breach(m.fct_cold_chain_readings)


@query
def stitch_by_key(m: Models) -> DataFrame:
    keys = ("order_number", "batch_id", "pallet_id", "warehouse_code")
    return reduce(DataFrame.unionByName, [limits.reverse_share(m.stg_wms_scan_events, k) for k in keys])


@query
def order_noise_profile(m: Models) -> DataFrame:
    values = ("order_value_gross_corrected", "discount_amount", "tax_amount", "order_value_net")
    return limits.order_noise_profile(kept(m.fct_orders.select(*values), "orders"))


@query
def negative_net_by_source(m: Models) -> DataFrame:
    return limits.negative_net_by_source(m.fct_orders)


@query
def canonical_agreement(m: Models) -> DataFrame:
    return checks.canonical_agreement(m.stg_sales_order_header)


@query
def check_net_nonneg(m: Models) -> DataFrame:
    return checks.negative_lines(m.fct_sales)


@query
def series_day_percentiles(m: Models) -> DataFrame:
    return checks.series_day_percentiles(m.dq_gateway_health)


@query
def diff_builds(m: Models) -> DataFrame:
    """The staged lines against a second build over the rows in another order: no row may differ."""
    raw = m.feeds.raw["pos_transactions"]
    again = staging.stg_pos_transactions(raw.hint("rebalance", F.col("sku_code")).sortWithinPartitions(F.desc("event_ts")))
    return reconcile.two_way_diff(m.stg_pos_transactions, again).agg(rows().alias("differing_rows"))


@located_query
def diff_stored_builds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two stored builds of the staged lines by month; in the second, three months have lines lost, changed or doubled.

    Rows are compared only in the months whose digests differ; ``surplus`` is how many more the first build has.
    """
    # The month is its first day: days are sorted as numbers before a write and take no formatting.
    lines = Models(Feeds.from_tables(spark, sf_dir)).stg_pos_transactions.withColumn("month", F.trunc("event_date_ist", "month"))
    root, month, line = scratch_path(spark, "builds"), F.col("month"), F.col("txn_line_no")
    lossy, repriced, twice = (F.lit(first).cast("date") for first in ("1996-03-01", "1997-07-01", "1995-02-01"))
    # Dealt by month, a month is a few files. Undealt, each task writes a file for each of its months, and the second build,
    # which reads and writes as many again, spends its time opening them.
    lines.hint("rebalance", month).write.partitionBy("month").parquet(f"{root}/first")
    stored = spark.read.schema(lines.schema).parquet(f"{root}/first")
    lost = (month == lossy) & (line == 1)
    changed = F.when((month == repriced) & (line == 2), F.col("discount_amount") + F.lit(1).cast("decimal(18,2)")).otherwise(F.col("discount_amount"))
    second = stored.where(~lost).withColumn("discount_amount", changed.cast("decimal(18,2)"))
    doubled = stored.where((month == twice) & (line == 3))
    second.unionByName(doubled).write.partitionBy("month").parquet(f"{root}/second")
    other = spark.read.schema(lines.schema).parquet(f"{root}/second")
    return reconcile.stored_diff(stored, other, "month").select(
        F.date_format(month, "yyyy-MM").alias("month"), "txn_id", "txn_line_no", as_double("discount_amount").alias("discount_amount"), "surplus"
    )


@query
def channel_ratio(m: Models) -> DataFrame:
    return finance.channel_ratio(m.rpt_finance_reconciliation)


@query
def period_coverage(m: Models) -> DataFrame:
    return checks.period_coverage(m.fct_sales, m.dim_calendar)


# --- parameters and routing --------------------------------------------------------------------------------------


@query
def as_of_date(m: Models) -> DataFrame:
    return kpi.as_of_date(m.fct_sales)


QUESTION = ("conv_id", "turn")


@located_query
def route_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.with_text(sample.feed(spark, sf_dir, "questions")).select(*QUESTION, "normalised")


@located_query
def route_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.scored(sample.feed(spark, sf_dir, "questions"), QUESTION).drop("position")


@located_query
def route_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.picked(sample.feed(spark, sf_dir, "questions"), QUESTION)


@located_query
def route_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periods the questions ask for, relative to the latest business day of the sales."""
    latest = kpi.as_of_date(Models(Feeds.from_tables(spark, sf_dir)).stg_pos_transactions).scalar()
    return routing.with_periods(sample.feed(spark, sf_dir, "questions"), QUESTION, latest)


@located_query
def fiscal_quarter_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.to_date("o_orderdate").alias("day"))
    return routing.quarter_bounds_of_days(orders, "day")
