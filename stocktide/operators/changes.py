"""Change-log operators: version numbers, validity windows, deletions, canonical snapshots.

Windows run over the entity where none has more than ``HOT_ROWS`` changes: rows are exchanged once, and nothing is joined.
A hot entity would be put into one task whole; its windows run over (entity, day) instead. What a day needs from its neighbours (the number of changes before it, the next
day's first change, whether the entity was ever deleted) is computed from one row per (entity, day) and travels
as an extra row of that day, sorted to its start or end, so the wide rows are exchanged once and joined to
nothing. A window over one entity sees days, never changes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stocktide.functions.cleaning import is_delete
from stocktide.operators.dedup import keep_first
from stocktide.session import releasing

OPEN_END = "9999-12-31"  # fixed value: end of a version that has not been replaced
HOT_ROWS = 200_000  # a key with more rows is hot: its windows are cut
SLOTS = 1 << 14  # in which keys are counted before hot ones are looked for


#: Asks for the hot keys when they are needed, so that composing a plan runs no job before.
HotKeys = Callable[[], "DataFrame | None"]


def hot_keys(rows: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """``_hot_key``, the keys with more than ``hot_rows`` rows (NULL may be one); None if there are none.

    A count runs at once, so that plans without hot keys need no second branch. There is at most one such key for
    ``hot_rows`` rows. Rows are counted by slots of keys, of which each task sends at most ``SLOTS``; only the keys of
    slots with as many rows are counted one by one.
    """
    slot = F.pmod(F.hash(key), F.lit(SLOTS))
    counted = lambda df, by: df.groupBy(by).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows)
    with releasing(rows.sparkSession):
        slots = [r[0] for r in counted(rows, slot.alias("_slot")).select("_slot").collect()]  # SLOTS at most
        if not slots:
            return None
        found = counted(rows.where(slot.isin(slots)), F.col(key).alias("_hot_key")).select("_hot_key")
        return None if found.isEmpty() else found


def of_keys(df: DataFrame, key: str, hot: DataFrame, how: str) -> DataFrame:
    """The rows of hot keys (``left_semi``) or of all others (``left_anti``)."""
    return df.join(F.broadcast(hot), F.col(key).eqNullSafe(F.col("_hot_key")), how)


def by_heat(df: DataFrame, key: str, hot: DataFrame | None, usual: Callable[[DataFrame], DataFrame], cut: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``cut`` of the rows of hot keys and ``usual`` of all others."""
    if hot is None:
        return usual(df)
    return usual(of_keys(df, key, hot, "left_anti")).unionByName(cut(of_keys(df, key, hot, "left_semi")))


def day_chunk(key: str, ts: str | Column) -> Column:
    """(entity, day); changes without a time come last."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.struct(F.col(key).alias("k"), F.coalesce(F.to_date(ts), F.lit(OPEN_END).cast("date")).alias("d"))


def version_history(
    raw: DataFrame, key: str, *, op_ts: str = "op_ts", seq: str = "seq", arrived: str = "extract_date",
    hot_rows: int = HOT_ROWS, hot: HotKeys | None = None,
) -> DataFrame:
    """One row per (key, seq) with ``version_no``, the position of the change among the raw rows of its key.

    Numbers count the raw rows, so a dropped copy leaves a gap. Of the copies of a (key, seq) the one that arrived
    first stays. A position is a rank by time and seq, taken before copies go; both windows share one exchange. Of a hot
    key whole rows go through the rank filter and the day window; counting needs keys and times only, and both shrink
    groups of copies before their exchange. ``hot`` gives the ``hot_keys`` where they are known already.
    """
    position = F.rank().over(Window.partitionBy(key).orderBy(F.asc_nulls_last(op_ts), F.asc_nulls_last(seq)))

    def first(rows: DataFrame) -> DataFrame:
        return keep_first(rows, [key, seq], [arrived, op_ts])

    def cut(rows: DataFrame) -> DataFrame:
        counts = rows.groupBy(key, op_ts, seq).agg(F.count(F.lit(1)).alias("_rows"))
        return numbered(first(rows), counts, key, op_ts=op_ts, seq=seq)

    return by_heat(raw, key, hot() if hot else hot_keys(raw, key, hot_rows), lambda rows: first(rows.withColumn("version_no", position.cast("long"))), cut)


def numbered(kept: DataFrame, counts: DataFrame, key: str, *, op_ts: str = "op_ts", seq: str = "seq") -> DataFrame:
    """``kept``, one row per (key, seq), with ``version_no``: one more than the raw rows before it, of which ``counts``
    has the number ``_rows`` for each (key, op_ts, seq)."""
    header, change, count = 0, 1, 2
    columns = kept.columns
    kept = kept.select(
        "*", F.lit(0).cast("long").alias("_rows"), day_chunk(key, op_ts).alias("_chunk"), F.lit(change).alias("_kind")
    )
    # After each (time, seq) stands the number of raw rows that carry it.
    counts = counts.select("*", day_chunk(key, op_ts).alias("_chunk"), F.lit(count).alias("_kind"))
    # A header opens each day with the number of raw rows on the days before it.
    earlier_days = Window.partitionBy("_chunk.k").orderBy("_chunk.d").rowsBetween(Window.unboundedPreceding, -1)
    headers = (
        counts.groupBy("_chunk")
        .agg(F.sum("_rows").alias("_n"))
        .select("_chunk", F.sum("_n").over(earlier_days).alias("_rows"), F.lit(header).alias("_kind"))
        .where("_rows IS NOT NULL")
    )
    before = F.sum("_rows").over(
        Window.partitionBy("_chunk")
        .orderBy(F.col("_kind") != header, F.asc_nulls_last(op_ts), F.asc_nulls_last(seq), "_kind")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        kept.unionByName(counts, allowMissingColumns=True)
        .unionByName(headers, allowMissingColumns=True)
        .withColumn("version_no", F.coalesce(before, F.lit(0)) + 1)
        .where(F.col("_kind") == change)
        .select(*columns, "version_no")
    )


def renumbered(
    stored: DataFrame, batch: DataFrame, counts: DataFrame, key: str, *, op_ts: str = "op_ts", seq: str = "seq",
    arrived: str = "extract_date", hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``version_history`` of what ``stored``, one row per (key, seq), and ``counts`` stand for and the raw rows of ``batch``.

    ``counts`` has how many raw rows besides those of the batch carry a (key, op_ts, seq). All three meet in one exchange
    by key; a hot key is cut by day as ever.
    """
    columns, counted = batch.columns, F.col("_rows")
    rows = (
        stored.select(*columns, F.lit(0).cast("long").alias("_rows"), F.lit(True).alias("_change"))
        .unionByName(batch.select("*", F.lit(1).cast("long").alias("_rows"), F.lit(True).alias("_change")))
        .unionByName(counts.select(key, op_ts, seq, "_rows", F.lit(False).alias("_change")), allowMissingColumns=True)
    )
    in_time = Window.partitionBy(key).orderBy(F.asc_nulls_last(op_ts), F.asc_nulls_last(seq))
    so_far = F.sum(counted).over(in_time.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    at_once = F.sum(counted).over(Window.partitionBy(key, op_ts, seq))

    def first(df: DataFrame) -> DataFrame:
        return keep_first(df, [key, seq], [arrived, op_ts])

    def usual(df: DataFrame) -> DataFrame:
        return first(df.withColumn("version_no", so_far - at_once + 1).where("_change").select(*columns, "version_no"))

    def cut(df: DataFrame) -> DataFrame:
        each = df.where(counted > 0).groupBy(key, op_ts, seq).agg(F.sum(counted).alias("_rows"))
        return numbered(first(df.where("_change").select(*columns)), each, key, op_ts=op_ts, seq=seq)

    return by_heat(rows, key, hot_keys(rows, key, hot_rows), usual, cut)


def validity_windows(
    history: DataFrame, key: str, *, op_ts: str = "op_ts", version: str = "version_no", op: str = "op_type",
    hot_rows: int = HOT_ROWS, hot: HotKeys | None = None,
) -> DataFrame:
    """Slowly changing dimension windows ``[valid_from, valid_to)``.

    Once deleted an entity stays deleted, whatever change follows; two changes at one time leave a window of
    zero length for the earlier of them. ``hot`` gives the ``hot_keys`` where they are known already.
    """
    columns = history.columns
    following = F.col("_next")
    return by_heat(
        history, key, hot() if hot else hot_keys(history, key, hot_rows), lambda rows: _next_in_key(rows, key, op_ts, version, op), lambda rows: _next_by_day(rows, key, op_ts, version, op)
    ).select(
        *columns,
        F.col("_ever_gone").alias("is_deleted"),
        F.col(op_ts).alias("valid_from"),
        F.coalesce(following, F.lit(OPEN_END).cast("timestamp_ntz")).alias("valid_to"),
        following.isNull().alias("is_last_version"),
        (following.isNull() & ~F.col("_ever_gone")).alias("is_current"),
    )


def _next_in_key(history: DataFrame, key: str, op_ts: str, version: str, op: str) -> DataFrame:
    """``_next``, the time of the next change of the key, and ``_ever_gone``; all windows share one sort by day and version."""
    in_key = Window.partitionBy(key).orderBy("_day", version)
    lead = lambda c: F.lead(c).over(in_key)
    return (
        history.withColumn("_day", day_chunk(key, op_ts)["d"])
        .withColumns({"_later": lead(op_ts), "_later_day": lead("_day")})
        .withColumn("_first", F.min(op_ts).over(Window.partitionBy(key, "_day")))
        .withColumn("_later_first", lead("_first"))
        .withColumn("_ever_gone", F.max(is_delete(op)).over(Window.partitionBy(key)))
        .withColumn("_next", F.when(F.col("_later_day") == F.col("_day"), F.col("_later")).otherwise(F.col("_later_first")))
        .select(*history.columns, "_next", "_ever_gone")
    )


def _next_by_day(history: DataFrame, key: str, op_ts: str, version: str, op: str) -> DataFrame:
    """The same from windows over (key, day)."""
    chunked = history.select("*", day_chunk(key, op_ts).alias("_chunk"), F.lit(False).alias("_is_trailer"))
    by_key = Window.partitionBy("_chunk.k")
    # A trailer closes each day with the entity's next change after the day and whether it was ever deleted.
    trailers = (
        chunked.groupBy("_chunk")
        .agg(F.min(op_ts).alias("_first"), F.max(is_delete(op)).alias("_deleted"))
        .select(
            "_chunk",
            F.lead("_first").over(by_key.orderBy("_chunk.d")).alias(op_ts),
            F.max("_deleted").over(by_key).alias("_gone"),
            F.lit(True).alias("_is_trailer"),
        )
    )
    in_day = Window.partitionBy("_chunk").orderBy("_is_trailer", version)
    return (
        chunked.unionByName(trailers, allowMissingColumns=True)
        .select(
            "*", F.lead(op_ts).over(in_day).alias("_next"),
            F.max("_gone").over(Window.partitionBy("_chunk")).alias("_ever_gone"),
        )
        .where("NOT _is_trailer")
        .select(*history.columns, "_next", "_ever_gone")
    )


def canonical_snapshot(
    history: DataFrame, key: str, *, op_ts: str = "op_ts", seq: str = "seq", op: str = "op_type"
) -> DataFrame:
    """Latest non-deleted row per key plus ``is_ever_deleted``; combines before the exchange.

    A deletion row is taken only for a key that has nothing else.
    """
    others = [c for c in history.columns if c not in (key, op_ts, seq)]
    alive = F.coalesce(F.col(op) != "D", F.lit(True))
    best = F.max(F.struct(alive.alias("_alive"), op_ts, seq, *others)).alias("_best")
    picked = history.groupBy(key).agg(best, F.max(is_delete(op)).alias("is_ever_deleted"))
    kept = [key if c == key else F.col(f"_best.{c}").alias(c) for c in history.columns]
    return picked.select(*kept, "is_ever_deleted")
