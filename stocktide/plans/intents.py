"""Registry of the questions the KPI library knows: data, not code.

Fixed values: intent names, match terms, KPI numbers and catalogue numbers. ``all_of`` is a list of synonym
groups that must each be hit, ``any_of`` a list of terms of which one must be hit. Matching is by substring, so
"ea" is found in "year" and "gt" inside words; that is the defined behaviour. The order of the list breaks ties.
"""

from __future__ import annotations

from dataclasses import dataclass, field

UNITS = ("unit", "units", "volume", "quantity", "qty")
ORDER = ("order", "orders")


@dataclass(frozen=True)
class Intent:
    name: str
    all_of: tuple[tuple[str, ...], ...] = ()
    any_of: tuple[str, ...] = ()
    kpi: tuple[str, ...] = ()
    period: str | None = None  # 'fiscal_quarter' or 'date_range'
    group_by: dict[str, tuple[str, ...]] = field(default_factory=dict)
    refused: str | None = None  # catalogue number of the refusal
    reason: str | None = None


INTENTS = (
    Intent(
        "gross_sales_by_channel",
        all_of=(("sales", "revenue", "turnover", "gross"), ("channel", "gt", "mt", "horeca", "ecom", "trade")),
        kpi=("KPI-01", "KPI-07"),
        period="fiscal_quarter",
    ),
    Intent(
        "sales_summary",
        all_of=(("sales", "revenue", "turnover", "gross", "net", "basket"),),
        kpi=("KPI-01", "KPI-02", "KPI-03", "KPI-06"),
        period="date_range",
        group_by={
            "month": ("month", "monthly", "by month"),
            "fiscal_quarter": ("quarter", "quarterly"),
            "channel": ("channel",),
            "category": ("category", "categories"),
            "region": ("region", "regional", "zone"),
        },
    ),
    Intent("units_in_eaches", all_of=(UNITS, ("each", "eaches", "ea")), kpi=("KPI-05",), period="date_range"),
    Intent("units_sold", all_of=(UNITS,), kpi=("KPI-04",), period="date_range"),
    Intent(
        "top_products",
        all_of=(
            ("top", "best", "biggest", "highest", "leading", "rank", "ranking", "most"),
            ("product", "products", "sku", "skus", "outlet", "outlets", "customer", "customers", "category",
             "categories", "seller", "sellers", "selling"),
        ),
        kpi=("KPI-01",),
        period="date_range",
    ),
    Intent(
        "finance_reconciliation",
        any_of=("reconcil", "reconciliation", "finance report", "weekly report", "published", "board", "legacy",
                "compare with finance", "double count", "variance"),
        kpi=("KPI-08",),
    ),
    Intent(
        "order_value_by_source",
        all_of=(ORDER, ("source", "system", "systems", "sfa", "erp", "partner", "api", "comparable", "comparability")),
        kpi=("KPI-09", "KPI-10"),
        period="date_range",
    ),
    Intent(
        "excursion_rate",
        any_of=("excursion", "temperature", "temp breach", "cold chain", "breach", "chilled", "reefer", "above band",
                "below band"),
        kpi=("KPI-11", "KPI-12"),
    ),
    Intent(
        "telemetry_completeness",
        all_of=(
            ("telemetry", "sensor", "gateway", "device", "reading", "readings"),
            ("complete", "completeness", "missing", "null", "outage", "dropout", "health"),
        ),
        kpi=("KPI-13",),
    ),
    Intent(
        "feed_completeness",
        any_of=("missing day", "missing days", "missing data", "data quality", "completeness", "feed health", "gaps",
                "gap", "reconcile manifest", "manifest", "is the data ok", "safe to publish"),
        kpi=("KPI-14",),
    ),
    Intent(
        "blocked_cycle_time",
        any_of=("cycle time", "dock to dispatch", "dock-to-dispatch", "dwell", "turnaround",
                "how long in the warehouse", "warehouse time"),
        refused="X-02",
        reason="Scans of one order do not belong to one journey: about half of the durations are negative.",
    ),
    Intent(
        "blocked_excursion_by_carrier",
        all_of=(("carrier", "carriers", "transporter", "haulier", "3pl", "bluewheel", "trident", "coldlink",
                 "eastbound", "metro milkrun"),),
        refused="X-01",
        reason="No feed names a carrier, and the route of a reading is not an assignment.",
    ),
    Intent(
        "blocked_channel_change",
        all_of=(
            ("change", "changed", "changes", "reclassif", "reclassified", "switch", "switched", "moved"),
            ("channel", "classification", "segment", "format"),
        ),
        refused="X-03",
        reason="The channel on outlet changes after the first is noise, not a reclassification.",
    ),
    Intent(
        "blocked_order_net_value",
        all_of=(ORDER, ("net value", "net", "discount", "tax", "margin")),
        refused="X-04",
        reason="Discount and tax on orders bear no relation to the order's gross value.",
    ),
    Intent(
        "blocked_trip_excursion",
        all_of=(
            ("trip", "trips", "journey", "journeys", "shipment", "shipments"),
            ("breach", "breached", "excursion", "temperature", "cold chain", "integrity"),
        ),
        refused="X-05",
        reason="Nothing in the readings marks the start or end of a trip.",
    ),
)
