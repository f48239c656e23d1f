"""Routing of a table of questions to the KPI library: one projection, no join and no shuffle.

The registry is a short fixed list, so each intent becomes a score expression on the terms a question holds.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocktide.functions import fiscal
from stocktide.plans.intents import INTENTS, Intent

MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
MONTH_YEAR = rf"\b({'|'.join(MONTHS)})\w*\s+(\d{{4}})\b"
FISCAL = r"\bfy\s*(\d{2})\D{0,3}q([1-4])\b"
WHOLE_PERIOD_START = "2000-01-01"


def normalised(text: Column | str) -> Column:
    """Lower case; every run of anything but letters, digits and spaces becomes one space."""
    return F.regexp_replace(F.lower(text), "[^a-z0-9 ]+", " ")


def with_text(questions: DataFrame, text: str = "question") -> DataFrame:
    return questions.withColumn("normalised", normalised(text))


def _list(terms: Iterable[str]) -> Column:
    return F.array(*[F.lit(t) for t in terms])


def _mentions(question: Column, terms: Iterable[str]) -> Column:
    return reduce(or_, [question.contains(t) for t in terms])


def score(hits: Column, intent: Intent) -> Column:
    """Groups hit plus terms hit, or 0 when a group is missed or none of the optional terms occurs.

    ``hits`` is the list of registry terms found in the question.
    """
    needed = [F.arrays_overlap(hits, _list(group)) for group in intent.all_of]
    points = F.lit(len(needed))
    if intent.any_of:
        found = F.size(F.array_intersect(hits, _list(intent.any_of)))
        points, needed = points + found, [*needed, found > 0]
    return F.when(reduce(and_, needed), points).otherwise(0) if needed else F.lit(0)


def with_scores(questions: DataFrame, intents: Sequence[Intent]) -> DataFrame:
    """Normalised text, the registry terms it holds, and one score column per intent.

    Terms are looked up in one loop over a literal list rather than as an expression each: a projection of some
    hundred and fifty text tests would be too long a method to be compiled. The text enters that loop as a variable:
    as a column that nothing else reads it would be merged into the loop and normalised anew for each term.
    """
    terms = list(dict.fromkeys(t for i in intents for group in (*i.all_of, i.any_of) for t in group))
    in_text = F.transform(F.array("normalised"), lambda q: F.filter(_list(terms), lambda t: F.contains(q, t)))
    found = with_text(questions).withColumn("_hits", F.get(in_text, F.lit(0)))
    return found.withColumns({f"_s{i}": score(F.col("_hits"), n) for i, n in enumerate(intents)})


def scored(questions: DataFrame, keys: Sequence[str], intents: Sequence[Intent] = INTENTS) -> DataFrame:
    """One row per question and intent that matches it."""
    entries = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"), F.lit(intent.name).alias("intent"), F.col(f"_s{i}").alias("score"),
                F.lit(intent.refused is not None).alias("refused"),
            )
            for i, intent in enumerate(intents)
        ]
    )
    return with_scores(questions, intents).select(*keys, F.inline(entries)).where("score > 0")


def picked(questions: DataFrame, keys: Sequence[str], intents: Sequence[Intent] = INTENTS) -> DataFrame:
    """The intent that answers each question: refusals win, then the score, then registry order; else 'unknown'."""
    # One whole number ranks the intents: a refusal outweighs any score, a score any place in the registry.
    ranks = [
        F.when(F.col(f"_s{i}") > 0, F.col(f"_s{i}") * 1000 - i + (1_000_000 if intent.refused else 0)).otherwise(0)
        for i, intent in enumerate(intents)
    ]
    best = with_scores(questions, intents).withColumn("_rank", F.greatest(*ranks))
    place = best.withColumn(
        "_place", F.when(F.col("_rank") > 0, F.pmod(-F.col("_rank"), F.lit(1000))).otherwise(F.lit(len(intents)))
    )
    unknown = Intent("unknown")
    lookup = lambda value: F.get(F.array(*[F.lit(value(i)) for i in (*intents, unknown)]), F.col("_place"))
    chosen = place.withColumn("intent", lookup(lambda i: i.name))
    return chosen.select(
        *keys,
        "intent",
        F.get(F.array(*[F.col(f"_s{i}") for i in range(len(intents))], F.lit(0)), F.col("_place")).alias("score"),
        lookup(lambda i: i.refused is not None).alias("refused"),
        lookup(lambda i: i.refused).alias("catalogue"),
        lookup(lambda i: ", ".join(i.kpi) or None).alias("kpi"),
        lookup(lambda i: i.reason).alias("reason"),
        group_choice(F.col("normalised"), F.col("intent"), intents).alias("group_by"),
    )


def group_choice(question: Column, chosen: Column, intents: Sequence[Intent] = INTENTS) -> Column:
    """First grouping of the chosen intent, in registry order, with a term in the question."""
    chain = F.when(F.lit(False), F.lit(None).cast("string"))
    for intent in intents:
        for name, terms in intent.group_by.items():
            chain = chain.when((chosen == intent.name) & _mentions(question, terms), F.lit(name))
    return chain


def with_periods(questions: DataFrame, keys: Sequence[str], latest_day: Column) -> DataFrame:
    """Fiscal quarter and date window each question asks for, relative to the latest day in the data."""
    base = with_text(questions).withColumn("_day", latest_day)
    q, day = F.col("normalised"), F.col("_day")

    # Fiscal quarter: named in the text, else that of the latest day, stepped back if asked for and unfinished.
    named_year, named_quarter = F.regexp_extract(q, FISCAL, 1), F.regexp_extract(q, FISCAL, 2)
    named = named_year != ""
    earlier = q.contains("previous quarter") | (q.contains("last quarter") & ~q.contains("complete"))
    own_end = fiscal.quarter_end(fiscal.fiscal_end_year(day), fiscal.fiscal_quarter_no(day))
    day_inside = F.when(earlier & (day < own_end), F.add_months(day, -3)).otherwise(day)
    end_year = F.when(named, named_year.try_cast("int") + 2000).otherwise(fiscal.fiscal_end_year(day_inside))
    quarter = F.when(named, named_quarter.try_cast("int")).otherwise(fiscal.fiscal_quarter_no(day_inside))
    with_quarter = base.withColumns({"_year": end_year, "_quarter": quarter}).withColumns({
        "fiscal_year": F.concat(F.lit("FY"), F.lpad((F.col("_year") % 100).cast("string"), 2, "0")),
        "fiscal_quarter": F.concat(F.lit("Q"), F.col("_quarter").cast("string")),
        "quarter_from": fiscal.quarter_start(F.col("_year"), F.col("_quarter")),
        "quarter_to": fiscal.quarter_end(F.col("_year"), F.col("_quarter")),
    })

    month_no = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.regexp_extract(q, MONTH_YEAR, 1))
    named_month = F.make_date(F.regexp_extract(q, MONTH_YEAR, 2).try_cast("int"), month_no.cast("int"), F.lit(1))
    this_month = F.trunc(day, "month")
    last_month = F.when(day == F.last_day(day), this_month).otherwise(F.add_months(this_month, -1))
    last_january = F.add_months(F.trunc(day, "year"), -12)
    month_label = lambda d: F.concat(F.date_format(d, "MMMM"), F.lit(" "), F.year(d).cast("string"))
    back = lambda n: (F.date_sub(day, n - 1), day, F.lit(f"last {n} days"))

    rules = (
        (F.regexp_extract(q, MONTH_YEAR, 1) != "", (named_month, F.last_day(named_month), month_label(named_month))),
        (q.contains("last 7 days") | q.contains("last week"), back(7)),
        (q.contains("last 30 days"), back(30)),
        (q.contains("last 90 days"), back(90)),
        (q.contains("last month") | q.contains("previous month"), (last_month, F.last_day(last_month), month_label(last_month))),
        (q.contains("this month"), (this_month, day, month_label(day))),
        (q.contains("last year"), (
            last_january, F.date_sub(F.add_months(last_january, 12), 1),
            F.concat(F.lit("calendar "), F.year(last_january).cast("string")))),
        (q.contains("all time") | q.contains("whole period") | q.contains("everything"), (
            F.lit(WHOLE_PERIOD_START).cast("date"), day, F.lit("the whole period"))),
    )
    otherwise = (F.col("quarter_from"), F.col("quarter_to"), F.concat_ws("-", "fiscal_year", "fiscal_quarter"))
    columns = []
    for slot, name in enumerate(("date_from", "date_to", "label")):
        chain = F
        for cond, values in rules:
            chain = chain.when(cond, values[slot])
        columns.append(chain.otherwise(otherwise[slot]).alias(name))
    return with_quarter.select(*keys, "fiscal_year", "fiscal_quarter", "quarter_from", "quarter_to", *columns)


def quarter_bounds_of_days(days: DataFrame, day: str) -> DataFrame:
    """Fiscal quarter of each date with its bounds, counted."""
    end_year, quarter = fiscal.fiscal_end_year(F.col(day)), fiscal.fiscal_quarter_no(F.col(day))
    return days.groupBy(
        fiscal.fiscal_year(F.col(day)).alias("fiscal_year"), fiscal.fiscal_quarter(F.col(day)).alias("fiscal_quarter"),
        fiscal.quarter_start(end_year, quarter).alias("quarter_from"), fiscal.quarter_end(end_year, quarter).alias("quarter_to"),
    ).agg(F.count(F.lit(1)).alias("days_counted"))
