"""Weekly reconciliation of three accounts of gross sales."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocktide.functions.cleaning import line_gross, renamed
from stocktide.functions.numbers import as_double, count_where, money, percent, ratio, round_to
from stocktide.operators.completeness import status
from stocktide.operators.reconcile import in_weeks

# The tolerance here, verdict names and basis labels below.
TOLERANCE = 0.05


def rpt_finance_reconciliation(sales: DataFrame, raw_pos: DataFrame, legacy: DataFrame) -> DataFrame:
    """Per (week, channel): A by event date without copies, B by arrival date with copies, C as published.

    The published ``week_ending`` is the first day of its week.
    """
    published = legacy.groupBy(F.col("week_ending").alias("week_start"), "channel").agg(
        F.sum(money("gross_sales_inr")).alias("_c_gross"),
        F.sum("units_sold").alias("legacy_published_units"),
        F.sum("basket_count").alias("legacy_published_baskets"),
    )
    weeks = legacy.select(F.col("week_ending").alias("week_start")).distinct()

    basis_a = (
        in_weeks(sales, "event_date_ist", weeks)
        .groupBy("week_start", F.col("channel_at_sale").alias("channel"))
        .agg(
            F.sum("gross_sales_amount").alias("_a_gross"),
            F.sum("qty_original").alias("our_units_as_transacted"),
            F.countDistinct("basket_id").alias("our_baskets"),
            F.count(F.lit(1)).alias("our_lines"),
        )
    )
    qty = renamed("quantity_units", "qty")
    basis_b = (
        in_weeks(raw_pos, "ingest_date", weeks)
        .groupBy("week_start", "channel")
        .agg(
            F.sum(line_gross(qty, money("unit_price"))).alias("_b_gross"),
            F.sum(qty).alias("legacy_emulated_units"),
            F.count(F.lit(1)).alias("legacy_emulated_lines"),
        )
    )
    cells = published.join(basis_a, ["week_start", "channel"], "left").join(basis_b, ["week_start", "channel"], "left")
    a, b, c = F.col("_a_gross"), F.col("_b_gross"), F.col("_c_gross")
    over = ratio(c, a) - 1
    return cells.select(
        "week_start", "channel",
        as_double(a).alias("our_gross_correct"), "our_units_as_transacted", "our_baskets", "our_lines",
        as_double(b).alias("legacy_emulated_gross"), "legacy_emulated_units", "legacy_emulated_lines",
        as_double(b - a).alias("bug_impact_gross"),
        (F.col("legacy_emulated_lines") - F.col("our_lines")).alias("duplicate_lines_counted"),
        as_double(c).alias("legacy_published_gross"), "legacy_published_units", "legacy_published_baskets",
        as_double(c - a).alias("variance_published_vs_correct"),
        round_to(F.lit(100.0) * over, 2).alias("variance_pct"),
        as_double(c - b).alias("variance_published_vs_emulated"),
        status(
            (F.abs(over) <= TOLERANCE, "RECONCILED_WITHIN_5PCT"),
            (c > a, "PUBLISHED_OVERSTATES"),
            otherwise="PUBLISHED_UNDERSTATES",
        ).alias("reconciliation_status"),
    )


def recon_bases(recon: DataFrame) -> DataFrame:
    """The three totals in crores, one row per basis, in one pass over the cells."""
    labels = (
        ("A. our correct basis (event date, deduped)", "our_gross_correct"),
        ("B. legacy method reproduced (ingest date, no dedup)", "legacy_emulated_gross"),
        ("C. as published to the board", "legacy_published_gross"),
    )
    sums = recon.agg(*[F.sum(money(c)).alias(c) for _, c in labels])
    rows = F.array(*[F.struct(F.lit(label).alias("basis"), crore(c).alias("gross_cr")) for label, c in labels])
    return sums.select(F.inline(rows))


def crore(col: str):
    return round_to(as_double(col) / F.lit(1e7), 2)


def recon_bug_impact(recon: DataFrame) -> DataFrame:
    sums = recon.agg(
        *[F.sum(money(c)).alias(c) for c in (
            "bug_impact_gross", "legacy_emulated_gross", "our_gross_correct", "legacy_published_gross")],
        F.sum("duplicate_lines_counted").alias("duplicate_lines"),
    )
    emulated, ours = F.col("legacy_emulated_gross"), F.col("our_gross_correct")
    inflation = F.try_divide(F.lit(100.0) * as_double(emulated), as_double(ours)) - F.lit(100.0)
    return sums.select(
        crore("bug_impact_gross").alias("bug_impact_cr"),
        round_to(inflation, 2).alias("bug_inflation_pct"),
        "duplicate_lines",
        as_double(F.col("legacy_published_gross") - emulated).alias("residual_unexplained_inr"),
    )


def recon_correlation(recon: DataFrame) -> DataFrame:
    return recon.agg(
        F.count(F.lit(1)).alias("cells"),
        round_to(F.corr("legacy_published_gross", "our_gross_correct"), 4).alias("corr_published_vs_actual"),
        round_to(F.corr("legacy_published_gross", "legacy_emulated_gross"), 4).alias("corr_published_vs_emulated"),
        count_where(F.col("reconciliation_status") == "RECONCILED_WITHIN_5PCT").alias("cells_within_5pct"),
        round_to(F.min("variance_pct"), 1).alias("worst_understatement_pct"),
        round_to(F.max("variance_pct"), 1).alias("worst_overstatement_pct"),
    )


def channel_ratio(recon: DataFrame) -> DataFrame:
    """Published over actual per channel: a stable multiple would point at a unit, these do not agree."""
    sums = recon.groupBy("channel").agg(
        F.sum(money("legacy_published_gross")).alias("_c"), F.sum(money("our_gross_correct")).alias("_a")
    )
    return sums.select(
        "channel", as_double("_c").alias("published_gross"), as_double("_a").alias("actual_gross"),
        round_to(ratio("_c", "_a"), 4).alias("published_to_actual"),
    )
