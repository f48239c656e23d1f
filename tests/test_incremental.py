"""Steps against rebuilds: change batches, late deliveries, a stream with a restart."""

import datetime as dt
import os
import random
import tempfile
from collections import Counter

from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from stocktide.operators import changes, dedup
from stocktide.plans import incremental
from stocktide.plans.incremental import ChangeStore, merge_late, stream_first
from stocktide.sources import feeds as scans

CHANGES = "k string, op_type string, op_ts timestamp_ntz, seq long, extract_date date, v string"


def log(draw, n):
    day = lambda: dt.date(2025, 1, 1) + dt.timedelta(days=draw.randrange(6))
    rows = []
    for _ in range(n):
        at = dt.datetime.combine(day(), dt.time(draw.randrange(24)))
        rows.append((draw.choice(["hot", "hot", "a", "b", None]), draw.choice("IUD"), at if draw.random() < 0.95 else None, draw.randrange(12), day(), draw.choice("xyz")))
    return rows + [r for r in rows if draw.random() < 0.3]


def everything(frame):
    return Counter(tuple(r) for r in frame.collect())


def test_batches_in_any_cut_and_order_equal_a_rebuild(spark):
    draw = random.Random(6)
    rows = log(draw, 60)
    draw.shuffle(rows)
    whole = spark.createDataFrame(rows, CHANGES)
    store = ChangeStore(spark, tempfile.mkdtemp() + "/history", whole.schema, "k", buckets=4)
    assert store.history().count() == 0
    for i, part in enumerate((rows[:10], [], rows[10:25], rows[25:])):
        store.apply(spark.createDataFrame(part, CHANGES), f"batch {i}")
    want = everything(changes.version_history(whole, "k"))
    assert everything(store.history()) == want
    store.apply(spark.createDataFrame(rows[10:25], CHANGES), "batch 2")  # once more: nothing changes
    assert everything(store.history()) == want


def test_a_batch_leaves_other_buckets_alone(spark):
    rows = [(f"key {i}", "I", dt.datetime(2025, 1, 1), i, dt.date(2025, 1, 1), "x") for i in range(40)]
    frame = spark.createDataFrame(rows, CHANGES)
    path = tempfile.mkdtemp() + "/history"
    store = ChangeStore(spark, path, frame.schema, "k", buckets=8)
    assert store.apply(frame, "all") == list(range(8))
    before = {f"{d}/{f}" for d in os.listdir(f"{path}/rows") for f in _files(f"{path}/rows/{d}")}
    touched = store.apply(spark.createDataFrame([("key 3", "U", dt.datetime(2024, 1, 1), 99, dt.date(2025, 2, 1), "late")], CHANGES), "one")
    after = {f"{d}/{f}" for d in os.listdir(f"{path}/rows") for f in _files(f"{path}/rows/{d}")}
    assert len(touched) == 1 and {f.split("/")[0] for f in before ^ after} == {f"_bucket={touched[0]}"}
    assert {(r["seq"], r["version_no"]) for r in store.history().where("k = 'key 3'").collect()} == {(99, 1), (3, 2)}


def _files(folder):
    return [f for f in os.listdir(folder) if f.endswith(".parquet")] if os.path.isdir(folder) else []


def test_late_rows_rewrite_only_the_partitions_they_change(spark):
    schema = "id long, arrived int, v string, month string"
    first = [(1, 1, "a", "m1"), (2, 1, "b", "m1"), (3, 2, "c", "m2"), (4, 5, "d", "m3"), (5, 5, "e", "m4"), (None, 5, "f", "m5")]
    late = [(2, 3, "loses", "m1"), (4, 2, "wins elsewhere", "m2"), (6, 9, "new", "m6"), (6, 9, "new", "m6"), (None, 1, "wins", "m5")]
    path = tempfile.mkdtemp() + "/table"
    scans.overwrite_partitions(spark.createDataFrame(first, schema), path, "month")
    before = {d: _files(f"{path}/{d}") for d in os.listdir(path)}
    rewritten = merge_late(path, spark.createDataFrame(late, schema), ["id"], ["arrived"], "month")
    assert rewritten == ["m2", "m3", "m5", "m6"]  # m1 only has a copy that loses
    after = {d: _files(f"{path}/{d}") for d in os.listdir(path)}
    assert all(after[f"month={m}"] == before[f"month={m}"] for m in ("m1", "m4")) and "month=m3" not in after
    want = everything(dedup.keep_first(spark.createDataFrame(first + late, schema), ["id"], ["arrived"]))
    assert everything(spark.read.schema(schema).parquet(path).select("id", "arrived", "v", "month")) == want
    assert merge_late(path, spark.createDataFrame(late, schema), ["id"], ["arrived"], "month") == []


def test_stream_goes_on_after_a_stop(spark):
    schema = "id long, at timestamp_ntz, v string"
    root = tempfile.mkdtemp()
    at = F.col("at").cast(TimestampType())

    def deliver(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{root}/in")
        return everything(stream_first(spark, f"{root}/in", spark.createDataFrame([], schema).schema, f"{root}/out", ["id"], at, "2 days"))

    one = dt.datetime(2025, 3, 1)
    assert deliver([(1, one, "a"), (1, one, "a"), (2, one, "b")]) == Counter([(1, one, "a"), (2, one, "b")])
    assert deliver([(2, one, "again"), (3, one, "c")]) == Counter([(1, one, "a"), (2, one, "b"), (3, one, "c")])


def test_a_batch_is_computed_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def mark(value):
        seen.add(1)
        return value

    draw = random.Random(8)
    rows = log(draw, 40)
    marked = F.udf(mark, "string")
    batch = spark.createDataFrame(rows, CHANGES).withColumn("v", marked("v"))
    ChangeStore(spark, tempfile.mkdtemp() + "/history", batch.schema, "k", buckets=4).apply(batch, "one")
    assert seen.value == len(rows)
    lines = spark.createDataFrame([(i, i % 3, "x") for i in range(30)], "id long, part long, v string")
    path = tempfile.mkdtemp() + "/lines"
    scans.overwrite_partitions(lines, path, "part")
    merge_late(path, lines.where("id < 7").withColumn("v", marked("v")), ["id"], ["v"], "part")
    assert seen.value == len(rows) + 7


def test_a_batch_adds_its_counts_and_leaves_those_of_others(spark, monkeypatch):
    monkeypatch.setattr(incremental, "FEW_ROWS", 0)  # a large batch numbers all keys of its buckets
    draw = random.Random(9)
    rows = log(draw, 80)
    whole = spark.createDataFrame(rows, CHANGES)
    path = tempfile.mkdtemp() + "/history"
    store = ChangeStore(spark, path, whole.schema, "k", buckets=2)
    counted = lambda: {f"{d}/{f}" for d in os.listdir(f"{path}/counts") if "one" in d for b in os.listdir(f"{path}/counts/{d}") for f in _files(f"{path}/counts/{d}/{b}")}
    store.apply(spark.createDataFrame(rows[:30], CHANGES), "one")
    before = counted()
    store.apply(spark.createDataFrame(rows[30:], CHANGES), "two")
    assert before and counted() == before
    assert everything(store.history()) == everything(changes.version_history(whole, "k"))
    store.apply(spark.createDataFrame(rows[:30], CHANGES), "one")  # once more: nothing changes
    assert everything(store.history()) == everything(changes.version_history(whole, "k"))


def test_history_and_batch_meet_in_one_exchange_and_hot_keys_are_cut(spark):
    draw = random.Random(10)
    rows = log(draw, 90)
    stored = changes.version_history(spark.createDataFrame(rows[:40], CHANGES), "k").drop("version_no")
    counts = spark.createDataFrame(rows[:40], CHANGES).groupBy("k", "op_ts", "seq").agg(F.count("*").alias("_rows"))
    batch = spark.createDataFrame(rows[40:], CHANGES)
    want = everything(changes.version_history(spark.createDataFrame(rows, CHANGES), "k"))
    for hot_rows in (5, changes.HOT_ROWS):
        assert everything(changes.renumbered(stored, batch, counts, "k", hot_rows=hot_rows)) == want
    kept = [scans.write_table(df, tempfile.mkdtemp() + "/kept") for df in (stored, counts)]
    plan = changes.renumbered(kept[0], batch, kept[1], "k")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_late_rows_are_added_where_no_row_goes(spark):
    schema = "id long, arrived int, v string, month string"
    path = tempfile.mkdtemp() + "/table"
    first = [(1, 1, "a", "m1"), (2, 2, "b", "m2"), (3, 2, "c", None), (4, 2, "d", None)]
    late = [(5, 3, "new", "m1"), (2, 1, "wins", "m2"), (3, 1, "moves", "m3"), (2, 2, "b", "m2"), (6, 1, "new", None)]
    scans.overwrite_partitions(spark.createDataFrame(first, schema), path, "month")
    before = _files(f"{path}/month=m1")
    assert merge_late(path, spark.createDataFrame(late, schema), ["id"], ["arrived"], "month") == [None, "m1", "m2", "m3"]
    assert set(before) < set(_files(f"{path}/month=m1"))
    want = everything(dedup.keep_first(spark.createDataFrame(first + late, schema), ["id"], ["arrived"]))
    assert everything(spark.read.schema(schema).parquet(path).select("id", "arrived", "v", "month")) == want


def test_a_stored_step_leaves_no_shuffle_files(spark):
    import glob
    import time

    from stocktide.session import RELEASE

    spark.conf.set(RELEASE, "false")
    dirs = [str(d) for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    files = lambda: {f for d in dirs for f in glob.glob(f"{d}/*/shuffle_*.data")}
    before = files()
    try:
        scans.write_table(spark.range(1000).repartition(3, "id"), tempfile.mkdtemp() + "/step")
        assert spark.conf.get(RELEASE) == "false"
    finally:
        spark.conf.unset(RELEASE)
    for _ in range(50):
        if not files() - before:
            break
        time.sleep(0.1)
    assert not files() - before
