"""The trie of all conversations' prefixes, from minimal-perfect-hash node tables.

A node is a distinct sequence of first turns. Its digest is a prefix polynomial hash over 128-bit digests of the turns, so
that the digests of one conversation come from one running sum. A task reads whole stretches of conversations, lists the
distinct digests of a block, gives each a slot by a minimal perfect hash, verifies every row against the digest stored in
its slot, scatters its counts into flat arrays and adds them up through the array of parent slots, deepest nodes first.

What a block finds is a part of the trie; parts meet by digest. Counts of members just add up. Sums over subtrees add up
because each node's own weight is placed once: in the block of its smallest member, on whose path all its ancestors lie.
So no subtree, however large, has to come together in one task, and each exchange is combined before it leaves the task.

Long conversations are cut into segments. A segment's digest starts from the digests of the segments before it, and the
weights behind it arrive as one more row, so that segments of one conversation are worked on apart. Turns are numbered in
bins of turn values, for the same reason; turns of one conversation with equal or null turn values are one bin.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stocktide.llm.common import _arrow_schema as arrow_schema
from stocktide.llm.common import arrow_map, cut, looked_up, mix, powers, ship, to_batch, utf8, word_bounds

#: Turns of one segment and of one bin; rows of one block; conversation ids of one piece of a list of ids.
SEGMENT, BLOCK, PIECE = 4096, 1 << 18, 1 << 16
#: Rebuilding: conversations in groups of GROUP share the first turns of the group's first, HEADS - 1 at most.
GROUP, HEADS = 20, 4
_NODE = ["p1", "p2", "depth"]
_NOTHING = hashlib.sha256(b"").hexdigest()


# ---- node tables ----------------------------------------------------------------------------------------------------


class Slots:
    """Minimal perfect hash of distinct 64-bit keys: n keys get the slots 0 to n-1.

    Each level hashes the keys that are left into an array of bits; keys that are alone in their place are done, the
    others go on to the next level. A key's slot is the number of set bits before its own.
    """

    def __init__(self, keys: np.ndarray):
        self.levels, self.base, done = [], [], 0
        while len(keys):
            size = max(64, 2 * len(keys))
            at = self._place(keys, len(self.levels), size)
            alone = np.bincount(at, minlength=size) == 1
            self.levels.append(np.where(alone, np.cumsum(alone) - 1, -1) + np.where(alone, done, 0))
            done += int(alone.sum())
            keys = keys[~alone[at]]
        self.size = done

    @staticmethod
    def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix(keys ^ mix(np.array([level + 1], np.uint64))) % np.uint64(size)).astype(np.int64)

    def of(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for n, level in enumerate(self.levels):
            got = level[self._place(keys[left], n, len(level))]
            out[left] = got
            left = left[got < 0]
            if not len(left):
                break
        return out


class NodeTable:
    """Nodes of one block of prefixes: a slot per distinct (p1, p2, depth), and the slot of each node's parent."""

    def __init__(self, p1: np.ndarray, p2: np.ndarray, depth: np.ndarray, parent_row: np.ndarray):
        """`parent_row`: the row that is one turn shorter, or -1 where that isn't in the block."""
        salt = np.uint64(0)
        while True:  # distinct digests that share a key: another key
            keys = p1 if not salt else mix(p1 + salt * p2 + depth.astype(np.uint64))
            slots = Slots(np.unique(keys))
            self.slot = slots.of(keys)
            self.p1, self.p2, self.depth = (np.zeros(slots.size, a.dtype) for a in (p1, p2, depth))
            for own, all_rows in ((self.p1, p1), (self.p2, p2), (self.depth, depth)):
                own[self.slot] = all_rows
            if all((own[self.slot] == all_rows).all() for own, all_rows in ((self.p1, p1), (self.p2, p2), (self.depth, depth))):
                break
            salt += np.uint64(2654435761)
        self.size = slots.size
        self.parent = np.full(self.size, -1, np.int64)
        self.parent[self.slot] = np.where(parent_row >= 0, self.slot[np.maximum(parent_row, 0)], -1)

    def summed(self, *own: np.ndarray) -> list[np.ndarray]:
        """Sums over subtrees within the block: children before parents, level by level."""
        out = [a.copy() for a in own]
        order = np.argsort(-self.depth, kind="stable")
        for level in np.split(order, np.flatnonzero(np.diff(self.depth[order])) + 1):
            up = self.parent[level]
            level, up = level[up >= 0], up[up >= 0]
            for a in out:
                np.add.at(a, up, a[level])
        return out


# ---- conversations as numbered turns --------------------------------------------------------------------------------


def turn_rows(conversations: DataFrame) -> DataFrame:
    """(conv, turn, x1, x2, words) per row: 128 bits of a digest of (role, text), and the words of the text."""

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        data, offsets = utf8(batch.column(3))
        starts, _ = word_bounds(data, offsets)
        n_words = np.bincount(np.searchsorted(offsets, starts, "right") - 1, minlength=batch.num_rows)
        raw, at = data.tobytes(), offsets.tolist()
        digests = []
        for role, a, b in zip(batch.column(2).to_pylist(), at[:-1], at[1:], strict=True):
            head = role.encode()
            digests.append(hashlib.blake2b(len(head).to_bytes(8, "little") + head + raw[a:b], digest_size=16).digest())
        x = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
        yield {"conv": batch.column(0), "turn": batch.column(1), "x1": x[:, 0].copy(), "x2": x[:, 1].copy(), "words": n_words}

    clean = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("role", "text")])
    return arrow_map(clean, run, "conv long, turn long, x1 long, x2 long, words long")


def numbered(turns: DataFrame, segment: int = SEGMENT) -> tuple[DataFrame, DataFrame]:
    """((conv, pos, x1, x2, words), (conv, total)): positions from 1 in order of turn, nulls first, then digest."""
    binned = turns.withColumn("bin", F.floor(F.col("turn") / segment))
    counts = binned.groupBy("conv", "bin").agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("conv").orderBy(F.col("bin").asc_nulls_first())
    # One row per bin of a conversation.
    bins = cut(counts.select("conv", F.coalesce("bin", F.lit(-(1 << 62))).alias("bin"), (F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("before"), F.sum("n").over(Window.partitionBy("conv")).alias("total"), F.row_number().over(order).alias("nth")))
    within = Window.partitionBy("conv", "bin").orderBy(F.col("turn").asc_nulls_first(), "x1", "x2")
    placed = binned.withColumn("bin", F.coalesce("bin", F.lit(-(1 << 62)))).withColumn("pos", F.row_number().over(within))
    rows = placed.join(bins.select("conv", "bin", "before"), ["conv", "bin"]).select("conv", (F.col("pos") + F.col("before")).alias("pos"), "x1", "x2", "words")
    return rows, bins.where("nth = 1").select("conv", "total")


def rebuilt(rows: DataFrame, lengths: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((conv, depth, x1, x2, words), (conv, length)) of the rebuilt conversations.

    The first h turns come from conversation c - c % 20 (all it has, if fewer), then follow the own turns after the first
    h, where h is the CRC-32 of the decimal id modulo 4.
    """
    heads_of = lengths.select("conv", "total", (F.col("conv") - F.col("conv") % GROUP).alias("base"), (F.crc32(F.col("conv").cast("string")) % HEADS).alias("h"))
    base_length = lengths.select(F.col("conv").alias("base"), F.col("total").alias("base_total"))
    plan = heads_of.join(base_length, "base", "left").withColumn("k", F.least("h", F.coalesce("base_total", F.lit(0))))
    plan = cut(plan.withColumn("length", F.col("k") + F.greatest(F.col("total") - F.col("h"), F.lit(0))))
    own = rows.join(plan.select("conv", "h", "k"), "conv").where("pos > h").select("conv", (F.col("pos") - F.col("h") + F.col("k")).alias("depth"), "x1", "x2", "words")
    first = rows.where(f"conv % {GROUP} = 0 and pos < {HEADS}").withColumnRenamed("conv", "base")
    head = first.join(plan.select("conv", "base", "k"), "base").where("pos <= k").select("conv", F.col("pos").alias("depth"), "x1", "x2", "words")
    return own.unionByName(head), plan.select("conv", "length")


# ---- blocks -----------------------------------------------------------------------------------------------------------


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
    """Column arrays of about BLOCK rows, cut only between (conv, segment) stretches."""
    held, size = [], 0

    def arrays(parts: list[pa.RecordBatch]) -> dict[str, np.ndarray]:
        table = pa.Table.from_batches(parts)
        return {n: table.column(n).to_numpy() for n in table.column_names}

    for batch in batches:
        if not batch.num_rows:
            continue
        if size >= BLOCK:
            key = [batch.column(n).to_numpy() for n in ("conv", "segment")]
            last = [held[-1].column(n)[-1].as_py() for n in ("conv", "segment")]
            new = np.flatnonzero((key[0] != last[0]) | (key[1] != last[1]))
            end = int(new[0]) if len(new) else batch.num_rows
            if end:
                held.append(batch.slice(0, end))
            if end < batch.num_rows:
                yield arrays(held)
                held, size, batch = [], 0, batch.slice(end)
            else:
                continue
        held.append(batch)
        size += batch.num_rows
    if held:
        yield arrays(held)


def _running(c: dict[str, np.ndarray]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """(running polynomial sums of either digest within each segment, whether a row begins one, index of its segment)."""
    n = len(c["conv"])
    new = np.ones(n, bool)
    new[1:] = (c["conv"][1:] != c["conv"][:-1]) | (c["segment"][1:] != c["segment"][:-1])
    group = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    within = np.arange(n) - first[group]
    up, _ = powers(int(within.max(initial=0)) + 1)
    out = []
    for x in ("x1", "x2"):
        sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(c[x].view(np.uint64)) * up[within])])
        out.append(sums[1:] - sums[first][group])
    return out, new, group


def _digest(local: np.ndarray, carry: np.ndarray) -> np.ndarray:
    """Digest of a prefix from the sum within its segment and the digest at the end of the segment before (0: none)."""
    return mix(local + mix(carry))


def _prefixes(c: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(p1, p2, parent row or -1) of rows sorted by conversation, segment and depth."""
    local, new, _ = _running(c)
    p1, p2 = (_digest(s, c[k].view(np.uint64)) for s, k in zip(local, ("c1", "c2"), strict=True))
    return p1, p2, np.where(new, -1, np.arange(len(new)) - 1)


def _sharded(rows: DataFrame, *order: str) -> DataFrame:
    """Whole segments in one task, those of conversations that share their first turns together."""
    return rows.repartition(F.floor(F.col("conv") / GROUP), F.col("segment")).sortWithinPartitions("conv", "segment", "depth", *order)


def carries(rows: DataFrame) -> DataFrame:
    """(conv, segment, c1, c2): the digest at the end of the segment before, for all segments after the first."""
    ship(rows.sparkSession)
    sums = "conv long, segment long, s1 long, s2 long"
    sums_arrow = arrow_schema(rows.sparkSession, sums)
    carry = "conv long, segment long, c1 long, c2 long"
    carry_arrow = arrow_schema(rows.sparkSession, carry)

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in _blocks(batches):
            local, new, _ = _running(c)
            last = np.append(np.flatnonzero(new)[1:] - 1, len(new) - 1)
            yield to_batch({"conv": c["conv"][last], "segment": c["segment"][last], "s1": local[0][last].view(np.int64), "s2": local[1][last].view(np.int64)}, sums_arrow)

    def chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, c = None, np.zeros(2, np.uint64)
        for batch in batches:
            conv, segment, *s = (batch.column(i).to_numpy() for i in range(4))
            s = np.stack([x.view(np.uint64) for x in s], axis=1)
            out = np.zeros((len(conv), 2), np.uint64)
            for i, own in enumerate(conv):
                c = _digest(s[i], c if own == now else np.zeros(2, np.uint64))
                now, out[i] = own, c
            yield to_batch({"conv": conv, "segment": segment + 1, "c1": out[:, 0].copy().view(np.int64), "c2": out[:, 1].copy().view(np.int64)}, carry_arrow)

    ends = _sharded(rows).mapInArrow(segments, sums)
    return ends.repartition("conv").sortWithinPartitions("conv", "segment").mapInArrow(chained, carry)  # a row per segment


def segmented(rows: DataFrame, lengths: DataFrame, segment: int) -> DataFrame:
    """`rows` with the length of their conversation, their segment and its carry (c1, c2)."""
    rows = rows.join(lengths, "conv").withColumn("segment", F.floor((F.col("depth") - 1) / segment))
    zero = F.lit(0).cast("long")
    if lengths.where(F.col("length") > segment).isEmpty():
        return rows.withColumns({"c1": zero, "c2": zero})
    rows = cut(rows)
    carry = carries(rows.where(F.col("length") > segment).select("conv", "segment", "depth", "x1", "x2"))
    later = rows.where("segment > 0").join(carry, ["conv", "segment"])
    return rows.where("segment = 0").withColumns({"c1": zero, "c2": zero}).unionByName(later)


def local_nodes(rows: DataFrame) -> DataFrame:
    """Per block and node: digest, depth, its parent's digest, members, words, and the conversations that end there."""
    schema = "p1 long, p2 long, depth long, q1 long, q2 long, n_convs long, conv long, words long, ends array<long>"
    arrow = arrow_schema(rows.sparkSession, schema)
    ship(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in _blocks(batches):
            p1, p2, up = _prefixes(c)
            table = NodeTable(p1, p2, c["depth"], up)
            m, slot = table.size, table.slot
            n_convs = np.bincount(slot, minlength=m)
            smallest = np.full(m, np.iinfo(np.int64).max)
            np.minimum.at(smallest, slot, c["conv"])
            words = np.zeros(m, np.int64)
            words[slot] = c["words"]
            carry = [np.zeros(m, np.int64) for _ in range(2)]
            for own, n in zip(carry, ("c1", "c2"), strict=True):
                own[slot] = c[n]
            q = [np.where(table.parent >= 0, p[table.parent].view(np.int64), own) for p, own in zip((table.p1, table.p2), carry, strict=True)]
            ending = np.flatnonzero(c["depth"] == c["length"])
            ending = ending[np.argsort(slot[ending], kind="stable")]
            bounds = np.searchsorted(slot[ending], np.arange(m + 1)).astype(np.int32)
            ends = pa.ListArray.from_arrays(pa.array(bounds), pa.array(c["conv"][ending]))
            yield to_batch({"p1": table.p1.view(np.int64), "p2": table.p2.view(np.int64), "depth": table.depth, "q1": q[0], "q2": q[1], "n_convs": n_convs, "conv": smallest, "words": words, "ends": ends}, arrow)

    return _sharded(rows.select("conv", "segment", "depth", "length", "x1", "x2", "words", "c1", "c2")).mapInArrow(run, schema)


def local_sums(rows: DataFrame, weights: DataFrame) -> DataFrame:
    """Per block and node: the weights (saved, leaves) in its subtree that have their place in the block.

    `weights` has (conv, segment, depth, saved, leaves), each on the path of the conversation conv; it meets the rows of
    its own segment, which has at most two for each row.
    """
    schema = "p1 long, p2 long, depth long, saved long, leaves long"
    arrow = arrow_schema(rows.sparkSession, schema)
    ship(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in _blocks(batches):
            path = c["weight"] == 0
            at = (np.cumsum(path) - 1)[~path]  # a weight follows the row of its depth
            p1, p2, up = _prefixes({n: v[path] for n, v in c.items()})
            table = NodeTable(p1, p2, c["depth"][path], up)
            own = []
            for n in ("x1", "x2"):
                a = np.zeros(table.size, np.int64)
                np.add.at(a, table.slot[at], c[n][~path])
                own.append(a)
            saved, leaves = table.summed(*own)
            some = (saved != 0) | (leaves != 0)
            yield to_batch({"p1": table.p1.view(np.int64)[some], "p2": table.p2.view(np.int64)[some], "depth": table.depth[some], "saved": saved[some], "leaves": leaves[some]}, arrow)

    zero = F.lit(0).cast("long")
    path = rows.select("conv", "segment", "depth", F.lit(0).alias("weight"), "x1", "x2", "c1", "c2")
    placed = weights.select("conv", "segment", "depth", F.lit(1).alias("weight"), F.col("saved").alias("x1"), F.col("leaves").alias("x2"), zero.alias("c1"), zero.alias("c2"))
    return _sharded(path.unionByName(placed), "weight").mapInArrow(run, schema)


def placed_weights(nodes: DataFrame, lengths: DataFrame, segment: int) -> DataFrame:
    """(conv, segment, depth, saved, leaves): each node's weight at its smallest member, and in a long conversation, at
    the end of each segment, the sum of the weights it has in later segments."""
    own = nodes.select(F.col("conv_id").alias("conv"), F.floor((F.col("depth") - 1) / segment).alias("segment"), "depth", "saved", "leaves")
    long = lengths.where(F.col("length") > segment)
    if long.isEmpty():
        return own
    totals = own.join(long, "conv", "left_semi").groupBy("conv", "segment").agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves"))
    each = long.select("conv", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("length") - 1) / segment))).alias("segment"))
    behind = Window.partitionBy("conv").orderBy(F.col("segment").desc()).rowsBetween(Window.unboundedPreceding, -1)  # a row per segment
    later = each.join(totals, ["conv", "segment"], "left").select("conv", "segment", ((F.col("segment") + 1) * segment).alias("depth"), F.sum("saved").over(behind).alias("saved"), F.sum("leaves").over(behind).alias("leaves"))
    return own.unionByName(later.where("saved is not null or leaves is not null").fillna(0))


def id_list_hashes(ends: DataFrame) -> DataFrame:
    """(p1, p2, depth, ends_sha256) of (p1, p2, depth, conv): SHA-256 of the decimal ids in ascending order, comma-joined.

    Ids are sorted and joined in pieces of PIECE consecutive values; a list of several pieces is hashed as a stream.
    """
    pieces = cut(ends.groupBy(*_NODE, F.floor(F.col("conv") / PIECE).alias("piece")).agg(F.concat_ws(",", F.sort_array(F.collect_list("conv")).cast("array<string>")).alias("ids")))  # PIECE ids at most
    counts = pieces.groupBy(*_NODE).agg(F.count(F.lit(1)).alias("n"), F.min("ids").alias("ids"))
    single = counts.where("n = 1").select(*_NODE, F.sha2("ids", 256).alias("ends_sha256"))
    schema = "p1 long, p2 long, depth long, ends_sha256 string"
    arrow = arrow_schema(ends.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, running = None, None

        def done() -> pa.RecordBatch:
            return to_batch({"p1": [now[0]], "p2": [now[1]], "depth": [now[2]], "ends_sha256": [running.hexdigest()]}, arrow)

        for batch in batches:
            for row in range(batch.num_rows):
                key, ids = tuple(batch.column(i)[row].as_py() for i in range(3)), batch.column(3)[row].as_py().encode()
                if key == now:
                    running.update(b"," + ids)
                    continue
                if now is not None:
                    yield done()
                now, running = key, hashlib.sha256(ids)
        if now is not None:
            yield done()

    listed = pieces.join(counts.where("n > 1").select(*_NODE), _NODE, "left_semi").repartition(*_NODE).sortWithinPartitions(*_NODE, "piece").select(*_NODE, "ids")
    return single.unionByName(listed.mapInArrow(run, schema))


def prefix_trie(conversations: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations, the textless root included.

    conv_id is a node's smallest member, parent_conv_id its parent's (root: null); n_convs, n_children and n_leaves count
    members, children and childless nodes of the subtree; saved_tokens sums (n_convs - 1) * words of the last text over
    the subtree; ends_sha256 hashes the ids of the members that end at the node.

    Null role or text is empty. Null turns come first; equal turns are ordered by a digest of role and text, so results
    don't depend on the order of rows; repeated rows are turns of their own. Rows without conv_id belong to no
    conversation. Other columns aren't read. An empty table has no nodes.
    """
    rows, lengths = rebuilt(*numbered(cut(turn_rows(conversations)), segment))
    rows = cut(segmented(rows, lengths, segment))
    found = cut(local_nodes(rows))
    parts = found.groupBy(*_NODE).agg(F.sum("n_convs").alias("n_convs"), F.min("conv").alias("conv_id"), F.max("words").alias("words"), F.min(F.struct("q1", "q2")).alias("up"))
    parts = cut(parts.select(*_NODE, F.col("up.q1").alias("q1"), F.col("up.q2").alias("q2"), "n_convs", "conv_id", "words"))
    children = parts.groupBy(F.col("q1").alias("p1"), F.col("q2").alias("p2"), (F.col("depth") - 1).alias("depth")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = parts.join(children, _NODE, "left").withColumn("leaves", F.col("n_children").isNull().cast("long"))
    nodes = cut(nodes.withColumns({"n_children": F.coalesce("n_children", F.lit(0)), "saved": (F.col("n_convs") - 1) * F.col("words")}).drop("words"))

    sums = local_sums(rows, placed_weights(nodes, lengths, segment)).groupBy(*_NODE).agg(F.sum("saved").alias("saved_tokens"), F.sum("leaves").alias("n_leaves"))
    ends = found.select(*_NODE, F.explode("ends").alias("conv")).unionByName(lengths.where("length = 0").select(*[F.lit(0).cast("long").alias(n) for n in _NODE], "conv"))
    hashes = cut(id_list_hashes(ends))

    # The root, from what its first turns and all conversations add up to: one row.
    below = nodes.select("leaves", "saved", (F.col("depth") == 1).cast("long").alias("first"), F.lit(0).cast("long").alias("one"), F.lit(None).cast("long").alias("conv"))
    all_convs = lengths.select(*[F.lit(0).cast("long").alias(n) for n in ("leaves", "saved", "first")], F.lit(1).cast("long").alias("one"), "conv")
    root = below.unionByName(all_convs).agg(F.min("conv").alias("conv_id"), F.sum("one").alias("n_convs"), F.sum("first").alias("n_children"), F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    zero = [F.lit(0).cast("long").alias(n) for n in _NODE]
    root = cut(root.where("n_convs > 0").select(*zero, "conv_id", "n_convs", "n_children", F.greatest("n_leaves", F.lit(1).cast("long")).alias("n_leaves"), "saved_tokens"))

    names = ["conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    with_sums = nodes.join(sums, _NODE, "left").select(*_NODE, "q1", "q2", *names)
    with_root = with_sums.unionByName(root.select(*_NODE, *[F.lit(None).cast("long").alias(n) for n in ("q1", "q2")], *names))
    parents = nodes.select(F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("conv_id").alias("parent_conv_id"), "n_children").where("n_children > 0")
    parents = parents.unionByName(root.select(F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("conv_id").alias("parent_conv_id"), "n_children"))
    placed = looked_up(with_root.join(hashes, _NODE, "left"), parents, ["q1", "q2"], "n_children", nodes.count())
    return placed.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(_NOTHING)).alias("ends_sha256"))
