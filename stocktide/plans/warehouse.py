"""The twenty models over a set of feeds: lazy by default, stored when a target folder is given."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import cached_property, partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stocktide.operators.changes import HotKeys, hot_keys
from stocktide.plans import dq, finance, marts, staging
from stocktide.sources import feeds as scans
from stocktide.sources import sample, schemas

# Columns by which a stored table is laid out, so that period filters skip files and row groups.
LAYOUT = {
    "stg_pos_transactions": ("ingest_date",),
    "fct_sales": ("event_date_ist",),
    "fct_cold_chain_readings": ("dt",),
    "fct_orders": ("order_date",),
}


class Frames(Mapping):
    """Frames by name, each composed when it is first asked for."""

    def __init__(self, sources: Mapping[str, Callable[[], DataFrame]]):
        self._sources, self._made = dict(sources), {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._sources[name]()
        return self._made[name]

    def __iter__(self):
        return iter(self._sources)

    def __len__(self):
        return len(self._sources)


@dataclass(frozen=True)
class Feeds:
    """Raw feeds by feed name, the same as completeness finds them where that differs, and the reference frames: uom, warehouses, carriers, legacy, manifest, calendar and
    feed_calendar, the days on which sources are expected, and feed_days, those of the feeds (by feed, if they differ)."""

    raw: Mapping[str, DataFrame]
    reference: Mapping[str, DataFrame]
    watched_raw: Mapping[str, DataFrame] | None = None

    @property
    def watched(self) -> Mapping[str, DataFrame]:
        return self.raw if self.watched_raw is None else self.watched_raw

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in self.reference:
            raise AttributeError(name)
        return self.reference[name]

    @staticmethod
    def delivered(spark: SparkSession, root: str, skip_files: tuple[str, ...] = ()) -> Feeds:
        """The delivered folder layout; fails before any work when an input is missing."""
        absent = scans.missing_inputs(spark, root)
        if absent:
            raise FileNotFoundError("inputs not found: " + ", ".join(absent))
        read = partial(partial, scans.scan_reference, spark, root)

        def calendar() -> DataFrame:
            return marts.dim_calendar(read("fiscal_calendar")())

        raw = {n: partial(scans.scan_feed, spark, root, n, skip_files=skip_files) for n in schemas.FEEDS}
        reference = {
            "uom": read("uom_conversion"), "warehouses": read("warehouse_master"), "carriers": read("carrier_master"),
            "legacy": read("legacy_finance_weekly_report"), "manifest": partial(scans.scan_manifest, spark, root),
            "calendar": calendar, "feed_calendar": calendar, "feed_days": calendar,
        }
        return Feeds(Frames(raw), Frames(reference))

    @staticmethod
    def from_tables(spark: SparkSession, sf_dir: str) -> Feeds:
        """The same shapes derived from the given tables; completeness watches scans and readings with planted gaps."""
        adapters = {
            "pos_transactions": "feed_pos", "reefer_telemetry": "feed_telemetry", "wms_scan_events": "feed_wms",
            "erp_cdc/outlet_master": "feed_outlet", "erp_cdc/product_master": "feed_product",
            "erp_cdc/sales_order_header": "feed_order",
        }
        references = {
            "uom": "ref_uom", "warehouses": "ref_warehouse", "carriers": "ref_carrier", "legacy": "ref_legacy",
            "manifest": "ref_manifest",
        }
        get = partial(partial, sample.feed, spark, sf_dir)

        def traded() -> DataFrame:
            first, last = F.min("o_orderdate"), F.date_add(F.to_date(F.max("o_orderdate")), 5)
            orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
            return marts.calendar_between(orders.agg(first.alias("first_day"), last.alias("last_day")))

        def observed() -> DataFrame:
            events = spark.read.parquet(f"{sf_dir}/events.parquet")
            return marts.calendar_between(events.agg(F.min("ts").alias("first_day"), F.max("ts").alias("last_day")))

        def expected() -> DataFrame:
            days = F.explode(F.sequence("first_day", "last_day")).alias("calendar_date")
            return sample.feed(spark, sf_dir, "ref_feed_spans").select("feed", days)

        reference = {n: get(a) for n, a in references.items()}
        gapped = {n: f"{adapters[n]}_gapped" for n in ("reefer_telemetry", "wms_scan_events")}
        return Feeds(
            Frames({n: get(a) for n, a in adapters.items()}),
            Frames({**reference, "calendar": traded, "feed_calendar": observed, "feed_days": expected}),
            Frames({n: get(a) for n, a in {**adapters, **gapped}.items()}),
        )


class Models:
    """Each model once, in dependency order by plain attribute access."""

    LAYERS = (
        ("stg_pos_transactions", "stg_reefer_telemetry", "stg_wms_scan_events", "stg_outlet_history",
         "stg_product_history", "stg_sales_order_header"),
        ("dim_outlet", "dim_product", "dim_calendar", "dim_warehouse", "dim_carrier", "fct_orders",
         "fct_cold_chain_readings", "fct_warehouse_cycle_time"),
        ("fct_sales", "dq_partition_reconciliation", "dq_feed_completeness", "dq_gateway_health"),
        ("rpt_finance_reconciliation",),
    )
    NAMES = tuple(name for layer in LAYERS for name in layer)
    VIEW = "rpt_sales_flat"

    def __init__(self, feeds: Feeds, store: str | None = None):
        self.feeds = feeds
        self.store = store
        self._hot_keys: dict[str, DataFrame | None] = {}
        self._sales_steps: list[DataFrame] = []

    def _keep(self, name: str, df: DataFrame) -> DataFrame:
        if self.store is None:
            return df
        return scans.write_table(df, f"{self.store}/{name}", LAYOUT.get(name, ()))

    def _hot(self, feed: str, key: str) -> HotKeys:
        """The hot keys of a change feed, asked for once: history and windows cut at the same keys."""
        def ask() -> DataFrame | None:
            if feed not in self._hot_keys:
                self._hot_keys[feed] = hot_keys(self.feeds.raw[feed], key)
            return self._hot_keys[feed]

        return ask

    def _model(self, name: str, build: Callable[..., DataFrame], *inputs) -> DataFrame:
        return self._keep(name, build(*inputs))

    @cached_property
    def stg_pos_transactions(self) -> DataFrame:
        return self._model("stg_pos_transactions", staging.stg_pos_transactions, self.feeds.raw["pos_transactions"])

    @cached_property
    def stg_reefer_telemetry(self) -> DataFrame:
        return self._model("stg_reefer_telemetry", staging.stg_reefer_telemetry, self.feeds.raw["reefer_telemetry"])

    @cached_property
    def stg_wms_scan_events(self) -> DataFrame:
        return self._model("stg_wms_scan_events", staging.stg_wms_scan_events, self.feeds.raw["wms_scan_events"])

    @cached_property
    def stg_outlet_history(self) -> DataFrame:
        return self._model("stg_outlet_history", staging.stg_outlet_history, self.feeds.raw["erp_cdc/outlet_master"], self._hot("erp_cdc/outlet_master", "outlet_code"))

    @cached_property
    def stg_product_history(self) -> DataFrame:
        return self._model("stg_product_history", staging.stg_product_history, self.feeds.raw["erp_cdc/product_master"], self._hot("erp_cdc/product_master", "sku_code"))

    @cached_property
    def stg_sales_order_header(self) -> DataFrame:
        raw = self.feeds.raw["erp_cdc/sales_order_header"]
        return self._model("stg_sales_order_header", staging.stg_sales_order_header, raw)

    @cached_property
    def dim_outlet(self) -> DataFrame:
        return self._model("dim_outlet", marts.dim_outlet, self.stg_outlet_history, self._hot("erp_cdc/outlet_master", "outlet_code"))

    @cached_property
    def dim_product(self) -> DataFrame:
        return self._model("dim_product", marts.dim_product, self.stg_product_history, self._hot("erp_cdc/product_master", "sku_code"))

    @cached_property
    def dim_calendar(self) -> DataFrame:
        return self._keep("dim_calendar", self.feeds.calendar)

    @cached_property
    def dim_warehouse(self) -> DataFrame:
        return self._keep("dim_warehouse", self.feeds.warehouses)

    @cached_property
    def dim_carrier(self) -> DataFrame:
        return self._keep("dim_carrier", self.feeds.carriers)

    @cached_property
    def fct_orders(self) -> DataFrame:
        return self._model("fct_orders", marts.fct_orders, self.stg_sales_order_header)

    @cached_property
    def fct_cold_chain_readings(self) -> DataFrame:
        return self._model("fct_cold_chain_readings", marts.fct_cold_chain_readings, self.stg_reefer_telemetry)

    @cached_property
    def fct_warehouse_cycle_time(self) -> DataFrame:
        return self._model("fct_warehouse_cycle_time", marts.fct_warehouse_cycle_time, self.stg_wms_scan_events)

    @cached_property
    def _versioned_sales(self) -> DataFrame:
        lines = marts.fct_sales(self.stg_pos_transactions, self.feeds.uom)
        if self.store is None:
            return marts.with_versions(lines, self.dim_outlet, self.dim_product, days_from=self.stg_pos_transactions)
        return marts.with_versions(self._sales_step(lines), self.dim_outlet, self.dim_product, days_from=self.stg_pos_transactions, step=self._sales_step)

    def _sales_step(self, df: DataFrame) -> DataFrame:
        """The frame stored until the next step has been: disk holds the shuffled rows of one join at a time."""
        kept = scans.write_table(df, f"{self.store}/_sales_{len(self._sales_steps)}")
        self._sales_steps.append(kept)
        if len(self._sales_steps) > 1:
            scans.drop_table(kept.sparkSession, f"{self.store}/_sales_{len(self._sales_steps) - 2}")
        return kept

    @cached_property
    def fct_sales(self) -> DataFrame:
        """Stored with the version keys of its dimensions. Composed lazily it has none: only the flat view reads them, and
        a plan that holds both point-in-time joins takes long to optimize even where they are pruned in the end."""
        if self.store is None:
            return marts.fct_sales(self.stg_pos_transactions, self.feeds.uom)
        kept = self._keep("fct_sales", self._versioned_sales)
        scans.drop_table(kept.sparkSession, f"{self.store}/_sales_{len(self._sales_steps) - 1}")
        return kept

    @cached_property
    def dq_partition_reconciliation(self) -> DataFrame:
        raw = self.feeds.watched
        return self._model(
            "dq_partition_reconciliation", dq.dq_partition_reconciliation, self.feeds.manifest,
            {n: raw[n] for n in schemas.MANIFEST_FEEDS}, {n: raw[n] for n in schemas.UNLISTED_FEEDS},
        )

    @cached_property
    def dq_feed_completeness(self) -> DataFrame:
        daily = dq.daily_counts(self.feeds.watched)
        return self._model("dq_feed_completeness", dq.dq_feed_completeness, daily, self.feeds.feed_days)

    @cached_property
    def watched_readings(self) -> DataFrame:
        """The readings that completeness watches: the fact, unless the feed is watched with gaps."""
        if self.feeds.watched is self.feeds.raw:
            return self.fct_cold_chain_readings
        return marts.fct_cold_chain_readings(staging.stg_reefer_telemetry(self.feeds.watched["reefer_telemetry"]))

    @cached_property
    def dq_gateway_health(self) -> DataFrame:
        return self._model(
            "dq_gateway_health", dq.dq_gateway_health, self.watched_readings, self.feeds.feed_calendar
        )

    @cached_property
    def rpt_finance_reconciliation(self) -> DataFrame:
        return self._model(
            "rpt_finance_reconciliation", finance.rpt_finance_reconciliation, self.fct_sales,
            self.feeds.raw["pos_transactions"], self.feeds.legacy,
        )

    def flat_columns(self, folder: str, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
        """The lines, stored with no more than what ``columns`` of the flat view need, and these columns of the view.

        Of the dimensions, too, no more is stored under ``folder`` than is read; each is read twice, to look for hot keys
        and to be joined. What the first of two point-in-time joins gives is stored as well, so that disk holds the
        shuffled rows of one at a time.
        """
        lines = marts.fct_sales(self.stg_pos_transactions, self.feeds.uom)
        lines = scans.write_table(lines.select(*marts.line_columns(lines, columns)), f"{folder}/lines")
        outlets, products = (
            scans.write_table(dim.select(*dict.fromkeys((key, "version_no", "valid_from", "valid_to", *attrs.values()))), f"{folder}/{key}") if attrs else dim
            for dim, key, attrs in (
                (self.dim_outlet, "outlet_code", marts.attributes_at_sale({**marts.OUTLET_AT_SALE, marts.VERSION_KEYS[0]: "version_no"}, columns)),
                (self.dim_product, "sku_code", marts.attributes_at_sale({**marts.PRODUCT_AT_SALE, marts.VERSION_KEYS[1]: "version_no"}, columns)),
            )
        )
        step = lambda df: scans.write_table(df, f"{folder}/with_products")
        return lines, marts.flat_columns(lines, outlets, products, self.feeds.calendar, self.feeds.warehouses, columns, step)

    @cached_property
    def rpt_sales_flat(self) -> DataFrame:
        """A view: never stored."""
        sales = self._versioned_sales if self.store is None else self.fct_sales
        return marts.rpt_sales_flat(
            sales, self.dim_outlet, self.dim_product, self.dim_calendar, self.dim_warehouse
        )


def build_tables(feeds: Feeds, store: str, at_once: int = 4) -> Models:
    """Build every table anew under ``store`` (a rebuild over the same folder gives the same tables) and the view.

    The tables of a layer do not depend on each other; a few jobs at a time keep the executors busy through each
    other's small stages.
    """
    models = Models(feeds, store)
    with ThreadPoolExecutor(at_once) as jobs:
        for layer in Models.LAYERS:
            list(jobs.map(partial(getattr, models), layer))
    models.rpt_sales_flat.createOrReplaceTempView(Models.VIEW)
    return models
