"""Steps instead of rebuilds: change batches merged into a stored history, late deliveries into the partitions they
touch, copies dropped from a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stocktide.operators.changes import renumbered
from stocktide.operators.dedup import keep_first
from stocktide.session import releasing, scratch_path
from stocktide.sources import feeds as scans

FEW_ROWS = 100_000  # a batch of so many rows is small: its keys are broadcast


def _same_keys(rows: DataFrame, keys: DataFrame, names: Sequence[str], how: str) -> DataFrame:
    """Semi or anti join by keys that may be null."""
    named = keys.select(*[F.col(n).alias(f"_k_{n}") for n in names]).distinct()
    matches = [F.col(n).eqNullSafe(F.col(f"_k_{n}")) for n in names]
    both: Column = matches[0]
    for other in matches[1:]:
        both = both & other
    return rows.join(named, both, how)


class ChangeStore:
    """The versions of a change log in a folder, kept current batch by batch.

    ``rows`` holds one numbered row per (key, seq) and is partitioned by a hash bucket of the key; ``counts`` holds how many
    raw rows of each batch carry a (key, time, seq), by batch and bucket, so that a batch only adds to it. A batch reads and
    rewrites only the buckets of its keys. One of up to ``FEW_ROWS`` rows renumbers only its keys; of a larger one the
    buckets' other keys are numbered along, which gives them the numbers they have, instead of being told apart by
    exchanges of all rows. The outcome is that of a rebuild from the whole log, however the log is cut into batches and
    in whatever order they come; applying a batch again changes nothing, so a failed step is repeated.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType, key: str, *, op_ts: str = "op_ts",
                 seq: str = "seq", arrived: str = "extract_date", buckets: int = 64):
        self.spark, self.path, self.key, self.op_ts, self.seq, self.arrived = spark, path, key, op_ts, seq, arrived
        self.columns, self.buckets = schema.fieldNames(), buckets
        version = "version_no long, _bucket int"
        self.row_schema = StructType([*schema.fields, *StructType.fromDDL(version).fields])
        count = [schema[key], schema[op_ts], schema[seq], *StructType.fromDDL("_rows long, _batch string, _bucket int").fields]
        self.count_schema = StructType(count)

    def _read(self, name: str, schema: StructType) -> DataFrame:
        where = f"{self.path}/{name}"
        if not scans.path_exists(self.spark, where):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(where)

    def history(self) -> DataFrame:
        """One row per (key, seq) with its ``version_no``, as ``version_history`` gives it for all batches together."""
        return self._read("rows", self.row_schema).drop("_bucket")

    def apply(self, batch: DataFrame, batch_id: str) -> list[int]:
        """Merge a batch of raw change rows; the buckets that were rewritten."""
        key, names = self.key, [self.key, self.op_ts, self.seq]
        bucket = F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")
        staged = scratch_path(self.spark, "changes")
        batch = scans.write_table(batch.select(*self.columns), staged)  # read many times, computed once
        with releasing(self.spark):
            touched = sorted(r[0] for r in batch.select(bucket).distinct().collect())  # at most as many as there are buckets
            if not touched:
                return []
            few = batch.count() <= FEW_ROWS
        here = F.col("_bucket").isin(touched)
        stored = self._read("rows", self.row_schema).where(here)
        counts = self._read("counts", self.count_schema).where(here & (F.col("_batch") != batch_id))
        met, counted = (_same_keys(df, batch, [key], "left_semi") if few else df for df in (stored, counts))
        merged = renumbered(met, batch, counted, key, op_ts=self.op_ts, seq=self.seq, arrived=self.arrived).withColumn("_bucket", bucket)
        if few:
            merged = _same_keys(stored, batch, [key], "left_anti").unionByName(merged)
        # The rows first: if this ends between the two, the batch is not yet counted and a repetition counts it.
        scans.replace_partitions(merged, f"{self.path}/rows", "_bucket")
        raw = batch.groupBy(*names).agg(F.count(F.lit(1)).alias("_rows"))
        raw = raw.select(*names, "_rows", F.lit(batch_id).alias("_batch"), bucket.alias("_bucket"))
        scans.replace_partitions(raw, f"{self.path}/counts", "_batch", "_bucket")
        scans.drop_table(self.spark, staged)
        return touched


def merge_late(path: str, late: DataFrame, keys: Sequence[str], order: Sequence[str], partition: str) -> list:
    """Merge late rows into a stored table of first deliveries; the partitions whose rows changed.

    The table at ``path`` has one row per key, the first by ``order``, and is partitioned by ``partition``, a column of
    the rows. A late row may be new, may lose against the stored copy, or may replace it, in another partition too. Only
    partitions that lose a row are rewritten, and one that loses its last row goes; where rows only come, they are added in
    files of their own. Of the stored rows the keys alone are exchanged, to find the rows that late ones meet.
    """
    spark, staged = late.sparkSession, scratch_path(late.sparkSession, "late")
    late = scans.write_table(late, f"{staged}/late")  # read many times, computed once
    stored, value = spark.read.schema(late.schema).parquet(path).select(*late.columns), F.col(partition)
    met = scans.write_table(_same_keys(stored.select(*keys), late, keys, "left_semi"), f"{staged}/met")
    before = scans.write_table(_same_keys(stored, met, keys, "left_semi"), f"{staged}/before")
    # Of equal rows the stored one comes first, as all columns before the mark are equal.
    both = before.withColumn("_late", F.lit(False)).unionByName(late.withColumn("_late", F.lit(True)))
    came = scans.write_table(keep_first(both, keys, order).where("_late").drop("_late"), f"{staged}/came")
    replaced = scans.write_table(_same_keys(before, came, keys, "left_semi"), f"{staged}/replaced")
    with releasing(spark):
        lost, gained = ({r[0] for r in df.select(partition).distinct().collect()} for df in (replaced, came))  # partitions of the table at most

    def within(values: set) -> Column:
        return value.isin([v for v in values if v is not None]) | (value.isNull() if None in values else F.lit(False))

    if lost:
        merged = _same_keys(stored.where(within(lost)), replaced, keys, "left_anti").unionByName(came.where(within(lost)))
        with releasing(spark):
            left = {r[0] for r in merged.select(partition).distinct().collect()}
        scans.overwrite_partitions(merged, path, partition)
        scans.drop_partitions(spark, path, partition, [v for v in lost if v not in left])
    if gained - lost:
        scans.append_partitions(came.where(within(gained - lost)), path, partition)
    scans.drop_table(spark, staged)
    return sorted(lost | gained, key=lambda v: (v is not None, v))


def stream_first(spark: SparkSession, source: str, schema: StructType, target: str, keys: Sequence[str], at: Column, within: str) -> DataFrame:
    """Rows of the files in ``source`` without the copies that come within ``within`` of event time ``at`` of each other.

    Reads what has come since the last call and stops. State and progress live beside ``target``, so a call that is
    broken off goes on where it was; state is dropped once the watermark has passed.
    """
    rows = spark.readStream.schema(schema).parquet(source).withColumn("_at", at)
    once = rows.withWatermark("_at", within).dropDuplicatesWithinWatermark(list(keys)).drop("_at")
    query = once.writeStream.format("parquet").option("path", target).option("checkpointLocation", f"{target}_progress").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(schema).parquet(target)
