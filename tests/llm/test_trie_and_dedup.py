"""Prefix trie and exact duplicates against brute force, with odd rows and long or hot groups."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
TURN = "conv_id long, turn long, role string, text string"
DOC = "doc_id long, text string, lang string"


# ---- 12 prefix trie


def turn_digest(role, text):
    head = role.encode()
    got = hashlib.blake2b(len(head).to_bytes(8, "little") + head + text.encode(), digest_size=16).digest()
    return tuple(int.from_bytes(got[i : i + 8], "little", signed=True) for i in (0, 8))


def brute_trie(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, turn_digest(role or "", text or ""), role or "", text or ""))
    own = {c: [v[3:] for v in sorted(turns)] for c, turns in own.items()}
    made = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        made[c] = own.get(c - c % 20 if c >= 0 else c + (-c) % 20, [])[:h] + turns[h:]
    members, kids = defaultdict(list), defaultdict(list)
    for c, turns in made.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    leaves, saved, out = {}, {}, []
    for node in sorted(members, key=len, reverse=True):
        m = members[node]
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        saved[node] = (len(m) - 1) * words + sum(saved[k] for k in kids[node])
        leaves[node] = sum(leaves[k] for k in kids[node]) if kids[node] else 1
        ends = ",".join(str(c) for c in sorted(m) if len(made[c]) == len(node))
        out.append((min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(kids[node]), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return Counter(out)


def trie_rows(frame):
    return Counter(tuple(r[c] for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")) for r in frame.collect())


def odd_turns():
    rng = np.random.default_rng(3)
    rows = []
    for c in [*range(-25, 25), 40, 41, 59, 10**12, 10**12 + 1]:  # 59 has no conversation 40 without turns, 10**12 is far away
        for t in range(int(rng.integers(1, 9))):
            rows.append((c, t if rng.random() < 0.9 else None, ["user", None, "tool"][int(rng.integers(3))], [None, "", "a  b\tc", "é\x0b\u00a0x"][int(rng.integers(4))]))
    rows += [(60, t, "user", f"turn {t}") for t in range(90)] + [(61, t, "user", f"turn {t}") for t in range(80)] + [(62, t, "user", f"turn {t}") for t in range(40)]
    rows += [(63, 5, "user", "same")] * 7 + [(64, None, "user", "same")] * 5 + [(None, 1, "user", "no conversation")] * 3
    rows += [(c, t, "system", "common first") for c in range(200, 320) for t in range(c % 3)]
    return rows


@pytest.mark.parametrize("segment", [4096, 8, 3])
def test_trie_of_odd_turns(spark, segment):
    from stocktide.llm import prefixtrie

    rows = odd_turns()
    frame = spark.createDataFrame(rows, TURN).withColumns({n: F.lit(1) for n in ("p1", "depth", "n_convs", "segment", "conv")})
    assert trie_rows(prefixtrie.prefix_trie(frame, segment)) == brute_trie(rows)


def test_trie_of_given_table(spark):
    from stocktide.llm.prefixtrie import prefix_trie

    frame = spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text")
    assert trie_rows(prefix_trie(frame)) == brute_trie([tuple(r) for r in frame.collect()])


def test_trie_of_nothing(spark):
    from stocktide.llm.prefixtrie import prefix_trie

    assert prefix_trie(spark.createDataFrame([], TURN)).count() == 0
    assert prefix_trie(spark.createDataFrame([(None, 1, "user", "x")], TURN)).count() == 0


def test_lists_of_ids_in_several_pieces(spark):
    """A node at which very many conversations end: its list of ids is hashed piece by piece."""
    from stocktide.llm.prefixtrie import id_list_hashes

    ids = [*range(-70_000, 200_000, 7), 10**15]
    frame = spark.createDataFrame([(1, 2, 3, i) for i in reversed(ids)] + [(1, 2, 4, 5)], "p1 long, p2 long, depth long, conv long")
    got = {r["depth"]: r["ends_sha256"] for r in id_list_hashes(frame).collect()}
    assert got == {3: hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), 4: hashlib.sha256(b"5").hexdigest()}


def test_slots_are_minimal_and_verified():
    from stocktide.llm.prefixtrie import NodeTable, Slots

    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 5000).astype(np.uint64))
    slots = Slots(keys).of(keys)
    assert sorted(slots) == list(range(len(keys)))
    # Two nodes with one first digest are told apart by the second.
    p1 = np.array([7, 7, 7], np.uint64)
    table = NodeTable(p1, np.array([1, 2, 1], np.uint64), np.array([1, 1, 1]), np.array([-1, -1, -1]))
    assert table.size == 2 and table.slot[0] == table.slot[2] != table.slot[1]


def test_blocks_end_between_stretches():
    """A block never divides a segment, whatever the sizes of the batches."""
    import pyarrow as pa

    from stocktide.llm import prefixtrie

    conv = np.repeat(np.arange(40), np.arange(40) % 7 + 1)
    batches = [pa.RecordBatch.from_pydict({"conv": conv[i : i + 9], "segment": np.zeros(len(conv[i : i + 9]), np.int64)}) for i in range(0, len(conv), 9)]
    whole, prefixtrie.BLOCK = prefixtrie.BLOCK, 20
    try:
        got = [b["conv"] for b in prefixtrie._blocks(iter(batches))]
    finally:
        prefixtrie.BLOCK = whole
    assert (np.concatenate(got) == conv).all() and len(got) > 3
    assert all(a[-1] != b[0] for a, b in zip(got[:-1], got[1:], strict=True))


# ---- 13 exact duplicates


def odd_documents():
    long = "long " * 40_000
    rows = [(1, None), (2, ""), (3, " "), (4, "one two"), (5, "one two "), (6, "One two"), (7, "one two"), (8, long), (9, long), (10, long + "x"), (11, long + "y"), (12, "é"), (13, "e\u0301")]
    rows += [(100 + i, "copied " * 30) for i in range(300)] + [(500 + i, "p" * 64 + f"{i:04d}") for i in range(50)]
    return rows + [(20, "repeated"), (20, "repeated"), (20, "repeated"), (None, "only without id"), (None, "only without id"), (None, "one two"), (None, None)]


def test_exact_duplicates_of_odd_rows(spark):
    from stocktide.llm.exactdedup import exact_duplicates, without_copies

    rows = odd_documents()
    frame = spark.createDataFrame([(i, t, "en") for i, t in rows], DOC).repartition(3).withColumns({n: F.lit(1) for n in ("n", "p", "_full", "_row", "keep_id", "row", "kept")})
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    got = exact_duplicates(frame).collect()
    assert len(got) == len(rows)
    by_text, kept = defaultdict(list), Counter()
    for r in got:
        by_text[r["text_sha256"]].append(r)
        kept[r["text_sha256"]] += r["kept"]
    for text, ids in groups.items():
        found = by_text[hashlib.sha256(text.encode()).hexdigest()]
        best = max((i for i in ids if i is not None), default=None)
        assert Counter(r["doc_id"] for r in found) == Counter(ids)
        assert {(r["keep_id"], r["group_size"]) for r in found} == {(best, len(ids))}
        assert [r["doc_id"] for r in found if r["kept"]] == [best]
    stay = without_copies(frame)
    assert stay.columns == frame.columns
    assert Counter((r["doc_id"], r["text"] or "") for r in stay.collect()) == Counter((max((i for i in ids if i is not None), default=None), t) for t, ids in groups.items())
    nothing = spark.createDataFrame([], DOC)
    assert exact_duplicates(nothing).count() == 0 and without_copies(nothing).count() == 0


def test_bits_are_the_keys(spark):
    from stocktide.llm.common import bitmap_of, with_bit

    keys = spark.range(-40_000, 40_000, 13).select(F.col("id").alias("key"))
    marked = with_bit(spark.range(-60_000, 60_000).toDF("key"), F.col("key"), bitmap_of(keys, 20), 20, "there")
    assert {r["key"] for r in marked.where("there").collect()} == set(range(-40_000, 40_000, 13))


def test_lookups_with_a_hot_key(spark):
    """One key refers to most rows: it is broadcast, the rest meet in an exchange, and nothing is lost."""
    from stocktide.llm.common import looked_up

    frame = spark.range(5000).select(F.when(F.col("id") % 3 == 0, F.lit(None)).when(F.col("id") % 3 == 1, F.lit(-1)).otherwise(F.col("id")).alias("k"), "id")
    table = spark.createDataFrame([(-1, 1666, "hot"), (2, 1, "two"), (5, 1, "five")], "k long, uses long, name string")
    got = Counter(r["name"] for r in looked_up(frame, table, ["k"], "uses", 5000).collect())
    assert got == {"hot": 1667, "two": 1, "five": 1, None: 5000 - 1669}
