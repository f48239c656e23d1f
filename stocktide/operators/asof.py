"""Point-in-time join: the attributes that were valid for the key when the fact happened.

A fact is never paired with more than one version: facts and versions of one chunk are merged in time order and the
last version seen is carried forward. A chunk is a key, unless the key is hot (more than ``HOT_ROWS`` facts and versions):
of a hot key it is a (key, day); the version in force when it starts is found among one
row per chunk and merged in as its first row, so the facts are exchanged once. A (key, day) that holds more than its
share of all facts is cut further, into ranges of time and, within them, into parts dealt by a hash of the fact; each
range opens with the version in force at its start, and each part sees the versions of its range.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from stocktide.functions.numbers import count_where
from stocktide.operators.changes import HOT_ROWS, by_heat, hot_keys, of_keys

NO_TIME = "0001-01-01"
# A (key, day) is hot above HOT_ROWS facts and above its share of them all; so there are at most SHARE hot ones.
SHARE = 4096
RANGE_SECONDS = 60
RANGES = 25 * 3600 // RANGE_SECONDS  # the longest day has 25 hours


def asof_join(
    facts: DataFrame,
    versions: DataFrame,
    *,
    fact_key: str,
    fact_ts: str,
    version_key: str,
    attrs: Mapping[str, str],
    valid_from: str = "valid_from",
    valid_to: str | None = "valid_to",
    tie: str = "version_no",
    days_from: DataFrame | None = None,
    spread: Sequence[str] = (),
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Left join of each fact to the last version with ``valid_from <= fact_ts``; highest ``tie`` at equal times.

    That version matches only before its ``valid_to`` (NULL: open); where it is closed the fact matches nothing. Of
    overlapping versions the one that began last decides. Without ``valid_to`` versions never close.

    ``days_from`` is a cheaper frame that holds at least the keys and times of ``facts``. ``spread`` names the columns
    that spread facts without a key or a time and those of a hot (key, day) (all of them, if none is named); named, the
    other columns can be pruned. Rows equal in these columns stay together. A key with more than ``hot_rows`` facts and versions
    goes by days, and a (key, day) is hot with more than
    ``hot_rows`` facts and more than one in ``SHARE`` of all facts.
    """
    usable = versions.where(F.col(version_key).isNotNull() & F.col(valid_from).isNotNull())
    # Facts without a key or a time match nothing.
    unmatched = F.col(fact_key).isNull() | F.col(fact_ts).isNull()
    end = F.col(valid_to) if valid_to else F.lit(None).cast(versions.schema[valid_from].dataType)
    entry = F.struct(*[F.col(source).alias(out) for out, source in attrs.items()], end.alias("_to")).alias("_version")
    found, holds = F.col("_found"), F.col("_found._to").isNull() | (F.col("_at") < F.col("_found._to"))

    def matched(merged: DataFrame) -> DataFrame:
        return merged.select(*facts.columns, *[F.when(holds, found.getField(out)).alias(out) for out in attrs])

    def by_key(facts: DataFrame, usable: DataFrame) -> DataFrame:
        version, fact = 0, 1
        dealt = F.pmod(F.xxhash64(*[F.col(c) for c in (spread or facts.columns)]), F.lit(4096))
        in_time = Window.partitionBy("_key", "_part").orderBy(F.asc_nulls_first("_at"), "_kind", "_tie")
        rows = facts.select(
            "*", F.col(fact_key).alias("_key"), F.when(unmatched, dealt).otherwise(F.lit(0)).alias("_part"), F.lit(fact).alias("_kind"), F.col(fact_ts).alias("_at"),
        )
        marked = usable.select(
            F.col(version_key).alias("_key"), F.lit(0).cast("long").alias("_part"), F.lit(version).alias("_kind"), F.col(valid_from).alias("_at"),
            F.col(tie).cast("long").alias("_tie"), entry,
        )
        carried = F.last("_version", ignorenulls=True).over(in_time.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        return matched(rows.unionByName(marked, allowMissingColumns=True).withColumn("_found", carried).where(F.col("_kind") == fact))

    source = facts if days_from is None else days_from
    names = source.select(F.col(fact_key).alias("_key")).unionByName(usable.select(F.col(version_key).alias("_key")))
    hot_key = hot_keys(names.where("_key IS NOT NULL"), "_key", hot_rows)
    if hot_key is None:
        return by_key(facts, usable)
    usual = by_key(of_keys(facts, fact_key, hot_key, "left_anti"), of_keys(usable, version_key, hot_key, "left_anti"))
    facts, source = (of_keys(df, fact_key, hot_key, "left_semi") for df in (facts, source))
    usable = of_keys(usable, version_key, hot_key, "left_semi")
    header, version, fact = 0, 1, 2
    fact_day = _day(F.col(fact_key), F.col(fact_ts)).alias("_day")
    source = source.where(~unmatched)
    counted = source.groupBy(fact_day).agg(F.count(F.lit(1)).alias("_n"))
    fair = F.greatest(F.lit(float(hot_rows)), counted.agg(F.sum("_n")).scalar() / F.lit(float(SHARE)))
    sized = counted.select("_day", (F.col("_n") > fair).alias("_hot"))
    # At most SHARE rows, as each stands for more than a SHARE-th of all facts: safe to broadcast at any size.
    hot = F.broadcast(sized.where("_hot"))

    marked_versions = (
        usable.withColumn("_day", _day(F.col(version_key), F.col(valid_from)))
        .join(hot, "_day", "left")
        .select(
            "_day", "_hot",
            _range_of(_time_range(versions, valid_from)).alias("_range"),
            F.lit(version).alias("_kind"),
            F.col(valid_from).alias("_at"),
            F.col(tie).cast("long").alias("_tie"),
            entry,
        )
    )
    # One row per (key, day), or per range of a hot one: those that have facts ask, those that have versions answer
    # with their last one. The answer in force at the start of a range opens it as a header.
    asked = sized.select(
        "_day", F.when(F.col("_hot"), True).alias("_hot"), F.lit(True).alias("_asked"),
        F.explode(F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(RANGES - 1))).otherwise(F.array(F.lit(0)))).alias("_range"),
    )
    answers = marked_versions.groupBy("_day", "_range").agg(F.max(F.struct("_at", "_tie", "_version")).alias("_last"))
    # Within one range the question stands before the answer, so it only sees earlier ones.
    earlier = (
        Window.partitionBy("_day.k")
        .orderBy("_day.d", "_range", F.col("_asked").isNull())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    headers = (
        asked.unionByName(answers, allowMissingColumns=True)
        .select("_day", "_hot", "_range", "_asked", F.last("_last", ignorenulls=True).over(earlier).alias("_carried"))
        .where("_asked AND _carried IS NOT NULL")
        .select("_day", "_hot", "_range", F.lit(header).alias("_kind"), F.col("_carried._version").alias("_version"))
    )

    def in_time(*chunk: str) -> Column:
        order = (F.col("_kind") != header, F.asc_nulls_first("_at"), "_kind", "_tie")
        window = Window.partitionBy(*chunk).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return F.last("_version", ignorenulls=True).over(window)

    # The moments of hot days meet the versions; what each finds opens its chunk, one copy for each part of it.
    moments = source.withColumn("_day", fact_day).join(hot, "_day").groupBy(
        "_day", F.col(fact_ts).alias("_at"), _time_range(facts, fact_ts).alias("_range")
    ).agg(F.count(F.lit(1)).alias("_n"))
    parts = F.when(F.col("_n") > fair, F.ceil(F.col("_n") * 2 / fair).cast("int")).otherwise(1)  # of half a share each
    crowded = F.broadcast(moments.where(F.col("_n") > fair).select("_day", "_at", parts.alias("_parts")))
    openings = (
        moments.select("_day", "_at", "_range", "_n", F.lit(fact).alias("_kind"))
        .unionByName(marked_versions.where("_hot").drop("_hot"), allowMissingColumns=True)
        .unionByName(headers.where("_hot").drop("_hot"), allowMissingColumns=True)
        .withColumn("_found", in_time("_day", "_range"))
        .where((F.col("_kind") == fact) & F.col("_found").isNotNull())
        .select(
            F.lit(header).alias("_kind"), F.col("_found").alias("_version"), "_day", "_at",
            F.explode(F.sequence(F.lit(0), parts - 1)).alias("_part"),
        )
        .select("_kind", "_version", _chunk(F.col("_at"), F.col("_part")).alias("_chunk"))
    )
    dealt = F.xxhash64(*[F.col(c) for c in (spread or facts.columns)])
    salt = F.when(unmatched, F.pmod(dealt, F.lit(4096))).otherwise(F.coalesce(F.pmod(dealt, "_parts"), F.lit(0)))
    whole_day = F.lit(None).cast(facts.schema[fact_ts].dataType)
    marked_facts = (
        facts.withColumn("_day", _day(F.when(~unmatched, F.col(fact_key)), F.col(fact_ts)))
        .withColumn("_at", F.col(fact_ts))
        .join(hot, "_day", "left")
        .join(crowded, ["_day", "_at"], "left")
        .select(
            *facts.columns,
            _chunk(F.when(F.col("_hot"), F.col(fact_ts)).otherwise(whole_day), salt).alias("_chunk"),
            F.lit(fact).alias("_kind"),
            "_at",
        )
    )
    whole = _chunk(whole_day, F.lit(0)).alias("_chunk")
    return usual.unionByName(matched(
        marked_facts.unionByName(
            marked_versions.where("_hot IS NULL").select(whole, "_kind", "_at", "_tie", "_version"), allowMissingColumns=True
        )
        .unionByName(headers.where("_hot IS NULL").select(whole, "_kind", "_version"), allowMissingColumns=True)
        .unionByName(openings, allowMissingColumns=True)
        .withColumn("_found", in_time("_chunk"))
        .where(F.col("_kind") == fact)
    ))


def window_defects(
    versions: DataFrame, *, key: str, valid_from: str = "valid_from", valid_to: str = "valid_to", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Versions that begin before an earlier one has ended (``overlaps``) or after all earlier ones have (``gap``).

    Reads the stored windows as they are. One row per version. A key is windowed whole unless it has more than ``hot_rows``
    versions; of a hot one the latest end of earlier days comes from one row per (key, day).
    """
    latest, day = F.col("_latest"), _day(F.col(key), F.col(valid_from))

    def usual(rows: DataFrame) -> DataFrame:
        in_key = Window.partitionBy(key).orderBy("_date", valid_from, valid_to).rowsBetween(Window.unboundedPreceding, -1)
        return rows.withColumn("_date", day["d"]).withColumn("_latest", F.max(valid_to).over(in_key))

    def cut(rows: DataFrame) -> DataFrame:
        ends = rows.groupBy(day.alias("_day")).agg(F.max(valid_to).alias("_end"))
        by_day = Window.partitionBy("_day.k").orderBy("_day.d").rowsBetween(Window.unboundedPreceding, -1)
        before = ends.select("_day", F.max("_end").over(by_day).alias(valid_to), F.lit(0).alias("_kind")).where(F.col(valid_to).isNotNull())
        in_day = Window.partitionBy("_day").orderBy("_kind", valid_from, valid_to).rowsBetween(Window.unboundedPreceding, -1)
        both = rows.withColumn("_day", day).withColumn("_kind", F.lit(1)).unionByName(before, allowMissingColumns=True)
        return both.withColumn("_latest", F.max(valid_to).over(in_day)).where("_kind = 1")

    def marked(rows: DataFrame) -> DataFrame:
        return rows.select(
            *versions.columns,
            F.coalesce(F.col(valid_from) < latest, F.lit(False)).alias("overlaps"),
            F.coalesce(F.col(valid_from) > latest, F.lit(False)).alias("gap"),
        )

    return by_heat(versions, key, hot_keys(versions, key, hot_rows), lambda rows: marked(usual(rows)), lambda rows: marked(cut(rows)))


def moments_matched(
    facts: DataFrame, versions: DataFrame, *, fact_key: str, fact_ts: str, version_key: str,
    valid_from: str = "valid_from", valid_to: str = "valid_to", hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """For each (key, time) of the facts, how many facts it has and how many versions hold it: what a range join gives.

    Nothing is paired: a version opens at its start and closes at its end, and the open ones are a running sum. Facts and
    versions of a key with at most ``hot_rows`` of both are exchanged once, by key; of a hot one the sum is carried
    from day to day by one row per (key, day). Facts without a key or a time are held by none.
    """
    moments = facts.select(F.col(fact_key).alias("key"), F.col(fact_ts).alias("at"))
    unheld = F.col("key").isNull() | F.col("at").isNull()
    usable = versions.where(F.col(version_key).isNotNull() & (F.col(valid_from) < F.col(valid_to))).select(
        F.col(version_key).alias("key"), F.col(valid_from).alias("_from"), F.col(valid_to).alias("_to")
    )
    edges = F.array(F.struct(F.col("_from").alias("at"), F.lit(1).alias("step")), F.struct(F.col("_to").alias("at"), F.lit(-1).alias("step")))
    rows = moments.where(~unheld).unionByName(usable, allowMissingColumns=True)

    def summed(rows: DataFrame) -> DataFrame:
        """One row for each (key, time): facts, or NULL where there are none, and by how much the versions that hold it change."""
        step = F.when(F.col("_from").isNull(), F.array(F.struct("at", F.lit(None).cast("int").alias("step")))).otherwise(edges)
        each = rows.select("key", F.explode(step).alias("_e")).select("key", "_e.at", "_e.step")
        return each.groupBy("key", "at").agg(F.nullif(count_where(F.col("step").isNull()), F.lit(0)).alias("facts"), F.sum("step").alias("_step"))

    def held(summed: DataFrame, window: Window) -> DataFrame:
        running = F.sum("_step").over(window.orderBy(F.asc_nulls_first("at")).rowsBetween(Window.unboundedPreceding, Window.currentRow))
        return summed.withColumn("versions", F.coalesce(running, F.lit(0))).where("facts IS NOT NULL").select("key", "at", "facts", "versions")

    def cut(rows: DataFrame) -> DataFrame:
        both = summed(rows).withColumn("_day", _day(F.col("key"), F.col("at")))
        by_day = Window.partitionBy("_day.k").orderBy("_day.d").rowsBetween(Window.unboundedPreceding, -1)
        carried = both.groupBy("_day").agg(F.sum("_step").alias("_of_day")).select("_day", F.sum("_of_day").over(by_day).alias("_step"))
        return held(both.unionByName(carried.where("_step <> 0"), allowMissingColumns=True), Window.partitionBy("_day"))

    hot = hot_keys(rows, "key", hot_rows)
    # Dealt by key before times are summed, so that the sums and the running sum need no exchange of their own.
    known = by_heat(rows, "key", hot, lambda rows: held(summed(rows.repartition("key")), Window.partitionBy("key")), cut)
    return known.unionByName(moments.where(unheld).groupBy("key", "at").agg(F.count(F.lit(1)).alias("facts")).withColumn("versions", F.lit(0).cast("long")))


def _day(key: Column, ts: Column) -> Column:
    day = F.coalesce(F.to_date(ts), F.lit(NO_TIME).cast("date"))
    return F.struct(key.alias("k"), day.alias("d"))


def _time_range(df: DataFrame, ts: str) -> Column:
    """Number of the range in its day; never falls as time goes on, also where a zone's clocks are put back."""
    if isinstance(df.schema[ts].dataType, TimestampType):
        seconds = F.unix_seconds(ts) - F.unix_seconds(F.to_date(ts).cast(TimestampType()))
    else:
        seconds = F.hour(ts) * 3600 + F.minute(ts) * 60
    return F.floor(seconds / RANGE_SECONDS).cast("int")


def _range_of(time_range: Column) -> Column:
    return F.when(F.col("_hot").isNull(), F.lit(0)).otherwise(time_range)


def _chunk(moment: Column, part: Column) -> Column:
    return F.struct(F.col("_day.k").alias("k"), F.col("_day.d").alias("d"), moment.alias("r"), part.cast("long").alias("s"))
