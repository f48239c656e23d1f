"""Operators against brute force on small fixtures, hot keys included."""

import datetime as dt
import math
import random
import statistics
import struct

import pytest
from pyspark.sql import functions as F

from stocktide.operators import asof, changes, completeness, dedup, quantiles, reconcile
from stocktide.sources import feeds as scans


def ts(day, hour=0, minute=0):
    return dt.datetime(2025, 1, 1) + dt.timedelta(days=day, hours=hour, minutes=minute)


CHANGES = "k string, op_type string, op_ts timestamp_ntz, seq long, extract_date date, v string"


def history(spark, rows):
    return spark.createDataFrame(rows, CHANGES)


def numbered_by_hand(rows):
    """Position among the raw rows of the key, then the first delivery of each (key, seq)."""
    null_last = lambda x: (x is None, x)
    out = {}
    for key in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == key), key=lambda r: (null_last(r[2]), null_last(r[3]), r[4], r[1], r[5]))
        first = {}
        for place, r in enumerate(mine, 1):
            rank = (r[4], null_last(r[2]) if r[2] is None else (False, r[2]), place)
            if r[3] not in first or rank < first[r[3]][0]:
                first[r[3]] = (rank, place, r)
        for _, place, r in first.values():
            out[(r[0], r[3])] = (place, r[5])
    return out


def test_version_numbers_match_brute_force_with_hot_key_and_copies(spark):
    rng = random.Random(3)
    rows = []
    for i in range(600):
        key = "hot" if rng.random() < 0.5 else f"k{rng.randrange(40)}"
        day = rng.randrange(12)
        rows.append((key, rng.choice("UUUD"), ts(day, rng.randrange(24)), i, (ts(day) + dt.timedelta(days=rng.randrange(3))).date(), f"v{i}"))
    for r in rng.sample(rows, 60):  # exact copies
        rows.extend([r] * rng.randrange(1, 4))
    for r in rng.sample(rows, 30):  # the same (key, seq) at another time and delivery
        rows.append((r[0], r[1], r[2] + dt.timedelta(days=2), r[3], r[4] + dt.timedelta(days=rng.randrange(-2, 3)), r[5] + "x"))
    got = {(r["k"], r["seq"]): (r["version_no"], r["v"]) for r in changes.version_history(history(spark, rows), "k").collect()}
    assert got == numbered_by_hand(rows)


def test_tied_times_give_a_window_of_zero_length(spark):
    rows = [("a", "I", ts(0), 1, ts(0).date(), "x"), ("a", "U", ts(5), 2, ts(5).date(), "y"), ("a", "U", ts(5), 900, ts(5).date(), "z")]
    dim = changes.validity_windows(changes.version_history(history(spark, rows), "k"), "k")
    got = {r["version_no"]: (r["valid_from"], r["valid_to"], r["is_current"]) for r in dim.collect()}
    assert got[1] == (ts(0), ts(5), False)
    assert got[2] == (ts(5), ts(5), False)
    assert got[3] == (ts(5), dt.datetime(9999, 12, 31), True)


def test_deleted_once_is_deleted_for_good(spark):
    rows = [
        ("back", "I", ts(0), 1, ts(0).date(), "x"), ("back", "D", ts(1), 2, ts(1).date(), "x"), ("back", "U", ts(2), 3, ts(2).date(), "y"),
        ("gone", "I", ts(0), 4, ts(0).date(), "x"), ("gone", "D", ts(3), 5, ts(3).date(), "x"),
        ("live", "I", ts(0), 6, ts(0).date(), "x"),
    ]
    h = changes.version_history(history(spark, rows), "k")
    dim = changes.validity_windows(h, "k")
    assert {r["k"]: r["n"] for r in dim.groupBy("k").agg(F.sum(F.col("is_current").cast("int")).alias("n")).collect()} == {"back": 0, "gone": 0, "live": 1}
    best = {r["k"]: (r["seq"], r["is_ever_deleted"]) for r in changes.canonical_snapshot(h, "k").collect()}
    assert best == {"back": (3, True), "gone": (4, True), "live": (6, False)}


def test_rows_without_time_or_key_are_kept(spark):
    rows = [("a", "I", ts(0), 1, ts(0).date(), "x"), ("a", "U", None, 2, ts(1).date(), "y"), (None, "I", ts(0), 3, ts(0).date(), "z"), (None, "U", ts(4), 4, ts(4).date(), "w")]
    got = {(r["k"], r["seq"]): r["version_no"] for r in changes.version_history(history(spark, rows), "k").collect()}
    assert got == {("a", 1): 1, ("a", 2): 2, (None, 3): 1, (None, 4): 2}


def asof_by_hand(facts, versions):
    out = {}
    for fid, key, at in facts:
        hits = [v for v in versions if key is not None and at is not None and v[0] == key and v[1] <= at]
        out[fid] = max(hits, key=lambda v: (v[1], v[2]))[3] if hits else None
    return out


def test_asof_join_matches_brute_force_with_and_without_ends(spark):
    rng = random.Random(11)
    versions, number = [], {}
    for _ in range(300):
        key = "hot" if rng.random() < 0.5 else f"k{rng.randrange(10)}"
        versions.append([key, ts(rng.randrange(20), rng.choice([0, 0, 6, 18]))])
    versions.sort()
    for v in versions:
        number[v[0]] = number.get(v[0], 0) + 1
        v += [number[v[0]], f"{v[0]}-{number[v[0]]}"]
    facts = [(i, "hot" if rng.random() < 0.5 else f"k{rng.randrange(12)}", ts(rng.randrange(-2, 22), rng.randrange(24))) for i in range(500)]
    facts += [(1000, None, ts(3)), (1001, "hot", None)]
    f = spark.createDataFrame(facts, "id int, key string, at timestamp_ntz")
    v = spark.createDataFrame([tuple(x) for x in versions], "k string, valid_from timestamp_ntz, version_no int, label string")
    args = dict(fact_key="key", fact_ts="at", version_key="k", attrs={"label": "label"})
    got = asof.asof_join(f, v, valid_to=None, **args).collect()
    expected = asof_by_hand(facts, versions)
    assert len(got) == len(facts)
    assert {r["id"]: r["label"] for r in got} == expected

    from pyspark.sql import Window
    nxt = F.lead("valid_from").over(Window.partitionBy("k").orderBy("version_no"))
    dim = v.withColumn("valid_to", F.coalesce(nxt, F.lit("9999-12-31").cast("timestamp_ntz")))
    assert {r["id"]: r["label"] for r in asof.asof_join(f, dim, **args).collect()} == expected


def test_asof_join_reads_the_end_of_a_version(spark):
    """A closed version matches nothing after it; of two that overlap the later one decides and nothing fans out."""
    dim = spark.createDataFrame(
        [("a", ts(1), ts(3), 1, "a1"), ("a", ts(5), None, 2, "a2"), ("b", ts(1), ts(9), 1, "b1"), ("b", ts(2), ts(4), 2, "b2")],
        "k string, valid_from timestamp_ntz, valid_to timestamp_ntz, version_no int, label string")
    facts = [(1, "a", ts(2)), (2, "a", ts(3)), (3, "a", ts(4)), (4, "a", ts(7)), (5, "b", ts(3)), (6, "b", ts(6)), (7, "b", ts(1, 5))]
    f = spark.createDataFrame(facts, "id int, key string, at timestamp_ntz")
    got = asof.asof_join(f, dim, fact_key="key", fact_ts="at", version_key="k", attrs={"label": "label"}).collect()
    assert sorted((r["id"], r["label"]) for r in got) == [(1, "a1"), (2, None), (3, None), (4, "a2"), (5, "b2"), (6, None), (7, "b1")]


def test_asof_join_splits_a_hot_key_and_day(spark):
    """Two thirds of all facts have one key and day, a half of them one time; ranges open with the version in force."""
    rng = random.Random(5)
    versions = [("hot", ts(0, 9), 1, "hot-1")]
    versions += [("hot", ts(3, rng.randrange(24), rng.randrange(60)), n, f"hot-{n}") for n in range(2, 60)]
    versions += [("hot", ts(3, 12), 60, "hot-60"), ("hot", ts(3, 12), 61, "hot-61"), ("k", ts(2), 1, "k-1")]
    facts = [(i, "hot", ts(3, 12) if i % 2 else ts(3, rng.randrange(24), rng.randrange(60))) for i in range(2000)]
    facts += [(2000 + i, rng.choice(["hot", "k", "none"]), ts(rng.randrange(6), rng.randrange(24))) for i in range(1000)]
    facts += [(5000, None, ts(3)), (5001, "hot", None)]
    f = spark.createDataFrame(facts, "id int, key string, at timestamp_ntz")
    v = spark.createDataFrame(versions, "k string, valid_from timestamp_ntz, version_no int, label string")
    args = dict(fact_key="key", fact_ts="at", version_key="k", attrs={"label": "label"}, valid_to=None)
    with_sql = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in with_sql}
    try:
        for k, value in with_sql.items():
            spark.conf.set(k, value)
        split = asof.asof_join(f, v, hot_rows=100, **args).withColumn("task", F.spark_partition_id()).collect()
        whole = asof.asof_join(f, v, hot_rows=10_000, **args).withColumn("task", F.spark_partition_id()).collect()
    finally:
        for k, value in before.items():
            spark.conf.set(k, value)
    expected = asof_by_hand(facts, versions)
    for got in (split, whole):
        assert len(got) == len(facts) and {r["id"]: r["label"] for r in got} == expected
    noon = lambda rows: {r["task"] for r in rows if r["key"] == "hot" and r["at"] == ts(3, 12)}
    assert len(noon(whole)) == 1 and len(noon(split)) > 8
    # Times with a zone: the hour that clocks show twice keeps its order.
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        zoned = lambda df, c: df.select(F.col("n"), F.timestamp_seconds(F.lit(1761433200) + F.col("n") * 600).alias(c), F.lit("a").alias("k"))
        f = zoned(spark.range(150).withColumnRenamed("id", "n"), "at")
        v = zoned(spark.range(0, 150, 7).withColumnRenamed("id", "n"), "valid_from").withColumn("version_no", F.lit(1))
        got = asof.asof_join(f, v, fact_key="k", fact_ts="at", version_key="k", attrs={"m": "n"}, valid_to=None, hot_rows=5, spread=["n"]).collect()
        assert {r["n"]: r["m"] for r in got} == {n: n // 7 * 7 for n in range(150)}
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_keep_first_is_total_and_limits_before_the_exchange(spark):
    rows = [("t", 1, dt.date(2025, 1, 2), "b"), ("t", 1, dt.date(2025, 1, 1), "z"), ("t", 1, dt.date(2025, 1, 1), "a"), ("u", 1, None, "q")]
    df = spark.createDataFrame(rows, "id string, line int, d date, v string")
    kept = dedup.keep_first(df, ["id", "line"], ["d"])
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert sorted((r["id"], r["v"]) for r in kept.collect()) == [("t", "a"), ("u", "q")]


@pytest.mark.parametrize("size", [1, 2, 7, 100, 1001])
def test_exact_percentiles_match_the_definition(spark, size):
    rng = random.Random(size)
    values = [rng.choice([rng.randrange(-5_000_000, 9_000_000), 7]) for _ in range(size)]
    df = spark.createDataFrame([("g", v) for v in values] + [("h", 1), ("h", None)], "g string, v long")
    got = {r["g"]: r for r in quantiles.exact_percentiles(df, ["g"], "v", {"m": 0.5, "lo": 0.0, "hi": 1.0}, bucket_bits=8).collect()}
    assert got["g"]["m"] == statistics.median(values)
    assert (got["g"]["lo"], got["g"]["hi"]) == (min(values), max(values))
    assert got["h"]["m"] == 1


def test_ordered_keys_are_those_of_the_bits(spark):
    rng = random.Random(5)
    values = [0.0, -0.0, 5e-324, 2.2250738585072014e-308, 1.7976931348623157e308, float("inf"), float("-inf"), 1.0]
    for e in range(-1074, 1024, 31):
        power = math.ldexp(1.0, e)
        values += [power, -power, math.nextafter(power, 0), math.nextafter(power, math.inf)]
    values += [struct.unpack("d", struct.pack("Q", rng.getrandbits(64)))[0] for _ in range(500)]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", quantiles.ordered_key(F.col("v")).alias("key")).collect()
    for r in rows:
        bits = struct.unpack("Q", struct.pack("d", abs(r["v"])))[0]
        assert r["key"] == ((2047 << 52) + 1 if math.isnan(r["v"]) else -bits if r["v"] < 0 else bits)


@pytest.mark.parametrize("digit_bits", [5, 20])
@pytest.mark.parametrize("kind", ["double", "long"])
def test_radix_percentiles_match_the_definition(spark, kind, digit_bits):
    rng = random.Random(digit_bits)
    wide = (lambda: rng.gauss(0, 1) * 10.0 ** rng.randrange(-200, 200)) if kind == "double" else (lambda: rng.randrange(-(2**63), 2**63))
    same, one = (2.5, 1.5) if kind == "double" else (7, 1)
    values = [rng.choice([wide(), same]) for _ in range(301)]
    df = spark.createDataFrame([("g", v) for v in values] + [("two", same), ("two", one), (None, one), ("none", None)], f"g string, v {kind}")
    got = {r["g"]: r for r in quantiles.radix_percentiles(df, ["g"], "v", {"lo": 0.0, "q": 0.25, "m": 0.5, "hi": 1.0}, digit_bits=digit_bits).collect()}
    ranked = sorted(values)
    assert [got["g"][c] for c in ("lo", "q", "m", "hi")] == [float(ranked[i]) for i in (0, 75, 150, 300)]
    assert (got["two"]["m"], got["two"]["q"]) == ((same + one) / 2, one + (same - one) / 4) and got[None]["m"] == one and set(got) == {"g", "two", None}
    assert quantiles.radix_percentiles(df.limit(0), ["g"], "v", {"m": 0.5}).count() == 0


def test_spine_zero_fill_and_baselines(spark):
    calendar = spark.createDataFrame([(ts(d).date(),) for d in range(5)], "calendar_date date")
    daily = spark.createDataFrame([("s", ts(0).date(), 10), ("s", ts(1).date(), 20), ("s", ts(3).date(), 30), ("s", ts(40).date(), 99)], "series string, d date, n long")
    filled = completeness.zero_filled(daily, ["series"], calendar, day="d", count="n")
    based = completeness.with_trailing_mean(completeness.with_median(filled, ["series"], "n", "m"), ["series"], "calendar_date", "n", "t")
    rows = sorted((r["calendar_date"], r["n"], r["day_absent"], r["m"], r["t"]) for r in based.collect())
    assert [r[1:] for r in rows] == [(10, False, 10.0, None), (20, False, 10.0, 10.0), (0, True, 10.0, 15.0), (30, False, 10.0, 10.0), (0, True, 10.0, 15.0)]


def test_week_lookup_is_an_equality_and_drops_other_days(spark):
    weeks = spark.createDataFrame([(dt.date(2025, 1, 1),), (dt.date(2025, 1, 8),)], "week_start date")
    df = spark.createDataFrame([(dt.date(2024, 12, 31),), (dt.date(2025, 1, 1),), (dt.date(2025, 1, 7),), (dt.date(2025, 1, 14),), (dt.date(2025, 1, 15),)], "d date")
    got = sorted((r["d"].day, r["week_start"].day) for r in reconcile.in_weeks(df, "d", weeks).collect())
    assert got == [(1, 1), (7, 1), (14, 8)]


def test_two_way_diff_counts_multiplicity(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "x int")
    b = spark.createDataFrame([(1,), (2,), (3,)], "x int")
    assert {(r["x"], r["surplus"]) for r in reconcile.two_way_diff(a, b).collect()} == {(1, 1), (3, -1)}
    assert reconcile.two_way_diff(a, a).count() == 0


def test_majority_value_breaks_ties_low(spark):
    df = spark.createDataFrame([("o", "B"), ("o", "A"), ("p", "C"), ("p", "C"), ("p", "A")], "k string, w string")
    assert {r["k"]: r["top"] for r in dedup.most_common(df, "k", "w", "top").collect()} == {"o": "A", "p": "C"}


def test_partition_digests_find_changes_that_keep_counts_and_parity(spark):
    base = [("a", 1, "x"), ("a", 2, None), ("b", 1, "x"), ("b", 2, "y"), ("c", 1, "x"), ("c", 1, "x"), ("d", None, "q"), (None, 1, "z")]
    other = [("a", 2, None), ("a", 1, "x"),  # another order
             ("b", 2, "x"), ("b", 1, "y"),  # values swapped between rows
             ("c", 2, "x"), ("c", 2, "x"),  # a pair for another pair: count and parity are the same
             (None, 1, "z"), ("e", 1, "x")]  # d is gone, e is new
    ddl = "part string, n int, v string"
    left, right = spark.createDataFrame(base, ddl), spark.createDataFrame(other, ddl)
    assert {r["part"] for r in reconcile.differing_partitions(left, right, "part").collect()} == {"b", "c", "d", "e"}
    got = {(r["part"], r["n"], r["v"]): r["surplus"] for r in reconcile.stored_diff(left, right, "part").collect()}
    assert got == {("b", 1, "x"): 1, ("b", 2, "y"): 1, ("b", 2, "x"): -1, ("b", 1, "y"): -1, ("c", 1, "x"): 2, ("c", 2, "x"): -2,
                   ("d", None, "q"): 1, ("e", 1, "x"): -1}
    # A null and a value that change places are seen.
    swapped = reconcile.differing_partitions(
        spark.createDataFrame([("a", None, "1")], "part string, u string, v string"),
        spark.createDataFrame([("a", "1", None)], "part string, u string, v string"), "part")
    assert swapped.count() == 1


def test_windows_and_moments_match_brute_force(spark):
    rng = random.Random(3)
    versions = []
    for n in range(120):
        start = ts(rng.randrange(12), rng.choice([0, 0, 7, 15]))
        versions.append((rng.choice(["hot", "hot", "a", "b"]), n, start, start + dt.timedelta(hours=rng.choice([0, 5, 24, 70]))))
    facts = [(i, rng.choice(["hot", "a", "b", "none", None]), ts(rng.randrange(-1, 14), rng.randrange(24)) if i % 40 else None) for i in range(600)]
    v = spark.createDataFrame(versions, "k string, version_no int, valid_from timestamp_ntz, valid_to timestamp_ntz")
    f = spark.createDataFrame(facts, "id int, key string, at timestamp_ntz")
    moments = asof.moments_matched(f, v, fact_key="key", fact_ts="at", version_key="k").collect()
    assert sum(r["facts"] for r in moments) == len(facts)
    for r in moments:
        holds = 0 if r["key"] is None or r["at"] is None else sum(x[0] == r["key"] and x[2] <= r["at"] < x[3] for x in versions)
        assert r["versions"] == holds, r
    got = {r["version_no"]: (r["overlaps"], r["gap"]) for r in asof.window_defects(v, key="k").collect()}
    for key in ("hot", "a", "b"):
        mine = sorted((x for x in versions if x[0] == key), key=lambda x: (x[2], x[3]))
        for i, x in enumerate(mine):
            latest = max((y[3] for y in mine[:i]), default=None)
            if not any(y[2:] == x[2:] and y[1] != x[1] for y in mine):  # equal windows may stand in either order
                assert got[x[1]] == (latest is not None and x[2] < latest, latest is not None and x[2] > latest)


def test_silent_runs_and_sparse_median_equal_the_dense_form(spark):
    rng, first = random.Random(9), dt.date(2025, 1, 1)
    daily = [(s, first + dt.timedelta(days=d), rng.randrange(1, 9)) for s in ("a", "b", "c") for d in range(-2, 23) if rng.random() < {"a": 0.9, "b": 0.6, "c": 0.2}[s]]
    daily += [("once", first + dt.timedelta(days=19), 4)]
    frame = spark.createDataFrame(daily, "s string, d date, n int")
    bounds = spark.createDataFrame([(first, first + dt.timedelta(days=19))], "first_day date, last_day date")
    runs = completeness.silent_runs(frame, ["s"], bounds, day="d").collect()
    medians = {r["s"]: r["m"] for r in completeness.sparse_median(frame, ["s"], bounds, day="d", count="n", out="m").collect()}
    days = [first + dt.timedelta(days=i) for i in range(20)]
    for s in ("a", "b", "c", "once"):
        seen = {d: n for k, d, n in daily if k == s and d in days}
        silent = [r["absent_from"] + dt.timedelta(days=i) for r in runs if r["s"] == s for i in range(r["days"])]
        assert sorted(silent) == [d for d in days if d not in seen]
        assert medians[s] == statistics.median([seen.get(d, 0) for d in days])
        ordered = sorted((r["absent_from"], r["absent_to"]) for r in runs if r["s"] == s)
        assert all((b[0] - a[1]).days > 1 for a, b in zip(ordered, ordered[1:]))


def rows_exchanged(df):
    """Rows that each exchange of a collected frame has written."""
    def nodes(p):
        if p.nodeName() == "AdaptiveSparkPlan":
            p = p.executedPlan()
        if p.nodeName().endswith("QueryStage"):
            p = p.plan()
        yield p
        for i in range(p.children().size()):
            yield from nodes(p.children().apply(i))

    found = [p.metrics().get("shuffleRecordsWritten") for p in nodes(df._jdf.queryExecution().executedPlan())]
    return [m.get().value() for m in found if m.isDefined()]


def test_versions_of_a_hot_day_are_not_copied_to_its_parts(spark):
    """600 versions and 600 facts on one day, a third of both at one moment, with a share of one fact."""
    second = lambda c: F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") * 113 % 86400)
    at = F.lit("2025-01-04").cast("timestamp_ntz") + F.make_dt_interval(secs=second("id"))
    facts = spark.range(600).select("id", F.lit("hot").alias("key"), at.alias("at"))
    versions = spark.range(600).select(F.lit("hot").alias("k"), at.alias("valid_from"), F.col("id").alias("version_no"))
    got = asof.asof_join(
        facts, versions, fact_key="key", fact_ts="at", version_key="k", attrs={"v": "version_no"}, valid_to=None, hot_rows=1, spread=["id"]
    )
    starts = [(r["valid_from"], r["version_no"]) for r in versions.collect()]
    expected = {r["id"]: max((s for s in starts if s[0] <= r["at"]), default=(None, None))[1] for r in facts.collect()}
    assert {r["id"]: r["v"] for r in got.collect()} == expected
    assert max(rows_exchanged(got)) < 6 * 600


def test_a_change_feed_is_exchanged_once_unless_a_key_is_hot(spark):
    """Numbers and windows of ordinary keys share one exchange; cut at hot keys they come out the same."""
    rng = random.Random(8)
    rows = []
    for i in range(300):
        key, day = rng.choice(["hot", "hot", "a", "b", None]), rng.randrange(6)
        rows.append((key, rng.choice("UUUUUUUD"), None if i % 50 == 0 else ts(day, rng.choice([0, 6, 6])), i, ts(day).date(), f"v{i}"))
    rows += rng.sample(rows, 40)
    rows += [(r[0], r[1], ts(9), r[3], r[4] + dt.timedelta(days=rng.choice([-1, 1])), r[5] + "x") for r in rng.sample(rows, 20)]
    h = history(spark, rows)

    def dim(hot_rows):
        return changes.validity_windows(changes.version_history(h, "k", hot_rows=hot_rows), "k", hot_rows=hot_rows)

    usual = dim(10_000)
    assert usual._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    rows_of = lambda df: sorted(map(repr, df.collect()))
    assert rows_of(usual) == rows_of(dim(60)) == rows_of(dim(0))


def test_asof_join_of_ordinary_keys_meets_versions_in_one_window(spark):
    versions = spark.createDataFrame([("a", ts(d), n, f"a{n}") for n, d in enumerate([0, 4, 4, 9])] + [("b", ts(2), 0, "b0"), (None, ts(0), 0, "no")],
                                     "k string, valid_from timestamp_ntz, version_no int, label string")
    facts = [(0, "a", ts(0)), (1, "a", ts(5)), (2, "a", ts(-1)), (3, "b", ts(8)), (4, "c", ts(8)), (5, None, ts(8)), (6, "b", None)]
    f = spark.createDataFrame(facts, "id int, key string, at timestamp_ntz")
    args = dict(fact_key="key", fact_ts="at", version_key="k", attrs={"label": "label"}, valid_to=None)
    usual = asof.asof_join(f, versions, **args)
    assert usual._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    want = {0: "a0", 1: "a2", 2: None, 3: "b0", 4: None, 5: None, 6: None}
    for hot_rows in (200_000, 4, 0):
        got = asof.asof_join(f, versions, hot_rows=hot_rows, **args).collect()
        assert len(got) == len(facts) and {r["id"]: r["label"] for r in got} == want


def test_windows_and_moments_of_hot_keys_are_those_of_ordinary_ones(spark):
    rng = random.Random(5)
    at = lambda days: ts(rng.randrange(days), rng.choice([0, 0, 7, 15])) if rng.random() < 0.95 else None
    versions = []
    for n in range(150):
        start = at(12)
        end = start + dt.timedelta(hours=rng.choice([0, 5, 24, 70])) if start else at(12)
        versions.append((rng.choice(["hot", "hot", "a", "b", None]), n, start, end))
    facts = [(rng.choice(["hot", "hot", "a", "none", None]), at(14)) for _ in range(300)]
    v = spark.createDataFrame(versions + versions[:9], "k string, version_no int, valid_from timestamp_ntz, valid_to timestamp_ntz")
    f = spark.createDataFrame(facts, "key string, at timestamp_ntz")
    names = {"fact_key": "key", "fact_ts": "at", "version_key": "k"}
    whole, parted, cut = ([sorted(map(str, df.collect())) for df in (
        asof.moments_matched(f, v, **names, hot_rows=n), asof.window_defects(v, key="k", hot_rows=n).drop("version_no"))] for n in (1000, 40, 0))
    assert whole == parted == cut and len(whole[1]) == len(versions) + 9


def test_windows_and_moments_are_exchanged_once(spark, tmp_path):
    day = F.col("id").cast("int") % 50
    rows = spark.range(400).select((F.col("id") % 7).cast("string").alias("k"), F.date_add(F.lit("2025-01-01"), day).cast("timestamp_ntz").alias("at"))
    facts = scans.write_table(rows, f"{tmp_path}/facts")
    windows = scans.write_table(rows.select("k", F.col("at").alias("valid_from"), (F.col("at") + F.expr("INTERVAL 3 DAYS")).alias("valid_to")), f"{tmp_path}/windows")
    dealt = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    assert dealt(asof.window_defects(windows, key="k")) == 1
    # one for the keys, one for the facts without a key or a time
    assert dealt(asof.moments_matched(facts, windows, fact_key="k", fact_ts="at", version_key="k")) == 2
