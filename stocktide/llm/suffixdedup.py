"""Removal of repeated passages by a hash-compared suffix sort.

A byte goes if a string of `length` bytes (200) covers it that also starts anywhere else, in any document or the same.

Method: suffixes are compared by prefix polynomial hashes. A binary search over the hashes finds how far two suffixes
agree (their common extension), so a comparison takes logarithmic steps; merge sort orders the suffixes with it, and
where neighbours agree far enough the string at both is repeated. The bytes of neighbours are then compared, so a hash
collision removes nothing.

One order over all suffixes of a corpus would be one sort over every byte, each carrying 200 bytes. The sort is
partitioned instead so that strings that can be equal meet. Every string of `length` bytes has an anchor that depends on
its content alone: the leftmost smallest hash of its GRAM-byte grams. Equal strings have equal anchors at equal places,
so a suffix has to be compared only with suffixes around occurrences of the same anchor.

1. Each task lists the anchors of its documents (about one in 77 bytes) with a hash of the stretch of all strings
   around each, and combines equal ones before the exchange: a passage in a third of all rows is one row per task.
2. A stretch that occurs twice is repeated as a whole. What is left open are anchors around which stretches differ.
3. For these, the texts give the bytes around the anchor, and the suffixes of the different stretches that share at
   least 124 bytes are sorted.
4. What is found goes back to the distinct texts, each read once, and from there to the rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stocktide.llm.common import arrow_map, cut, mix, packed_rows, powers, prefix_hash, ship, slices, to_batch, unpacked_rows, utf8
from stocktide.llm.common import _arrow_schema as arrow_schema

#: Bytes of the gram whose smallest hash is a string's anchor. A string of n bytes has n - GRAM + 1 of them.
GRAM = 49


def _sliding_min(h: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each run of w values (two scans over blocks of w)."""
    n = len(h)
    pad = -n % w
    x = np.concatenate([h, np.full(pad, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, w)
    left = np.minimum.accumulate(x, axis=1).ravel()
    right = np.minimum.accumulate(x[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[: n - w + 1], left[w - 1 : n])


def anchors(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position, row, hash) of the anchor of every string of `length` bytes within one text, each anchor once.

    The smallest gram is found by the first 31 bits of its hash, then by its place, in one sliding minimum.
    """
    w, n = length - GRAM + 1, len(data) - GRAM + 1
    if n < w:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    sums, (_, down) = prefix_hash(data), powers(len(data))
    h = mix((sums[GRAM:] - sums[:-GRAM]) * down[:n])
    place = np.uint64(33)
    low = _sliding_min((h >> place << place) | np.arange(n, dtype=np.uint64), w)
    ends = np.repeat(offsets[1:], np.diff(offsets))[: len(low)]
    low = low[np.arange(len(low)) + length <= ends]  # strings within one text
    pos = (low & np.uint64((1 << 33) - 1)).astype(np.int64)
    pos = pos[np.concatenate([[True], np.diff(pos) != 0])] if len(pos) else pos
    return pos, np.searchsorted(offsets, pos, "right") - 1, h[pos]


# ---- suffix sort of the stretches around one anchor ---------------------------------------------------------------------


class _Suffixes:
    """Prefix hashes of several byte strings, and the common extension of two suffixes in logarithmic steps."""

    def __init__(self, data: np.ndarray, ends: np.ndarray, limit: int):
        self.data, self.limit = np.concatenate([data, np.zeros(1, np.uint8)]), limit
        self.sums, (_, self.down) = prefix_hash(data), powers(len(data))
        self.ends = ends  # by byte: end of the string that holds it

    def _hash(self, at: np.ndarray, n: np.ndarray) -> np.ndarray:
        return (self.sums[at + n] - self.sums[at]) * self.down[at]

    def extension(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Bytes on which the suffixes at a and b agree, up to the limit or the end of a string."""
        most = np.minimum(np.minimum(self.ends[a] - a, self.ends[b] - b), self.limit)
        low, high = np.zeros(len(a), np.int64), most
        for _ in range(int(self.limit).bit_length()):
            mid = (low + high + 1) >> 1
            same = self._hash(a, mid) == self._hash(b, mid)
            low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
        return low

    def before(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """True where suffix a comes before b; equal ones in order of position."""
        n = self.extension(a, b)
        end_a, end_b = a + n >= self.ends[a], b + n >= self.ends[b]
        x = np.where(end_a, -1, self.data[np.minimum(a + n, len(self.data) - 1)].astype(np.int16))
        y = np.where(end_b, -1, self.data[np.minimum(b + n, len(self.data) - 1)].astype(np.int16))
        return np.where((n >= self.limit) | (x == y), a < b, x < y)

    def sort(self, at: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Merge sort of the suffixes of each group (given in order of group): all merges of one width at once."""
        size = np.bincount(group) if len(group) else np.zeros(1, np.int64)
        first = np.concatenate([[0], np.cumsum(size)])[:-1][group]
        stop = first + size[group]
        place = np.arange(len(at))
        width = 1
        while width < size.max(initial=0):
            run = (place - first) // width
            mine = first + run * width
            other = np.where(run % 2 == 0, mine + width, mine - width)
            there = other < stop
            lo, hi = np.where(there, other, 0), np.where(there, np.minimum(other + width, stop), 0)
            base = lo.copy()
            while (todo := np.flatnonzero(lo < hi)).size:
                mid = (lo[todo] + hi[todo]) >> 1
                less = self.before(at[mid], at[todo])
                lo[todo] = np.where(less, mid + 1, lo[todo])
                hi[todo] = np.where(less, hi[todo], mid)
            to = np.minimum(mine, np.where(there, other, mine)) + (place - mine) + (lo - base)
            merged = np.empty_like(at)
            merged[to] = at
            at, width = merged, 2 * width
        return at


def _classes(parts: list[bytes], group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, agree): the parts suffix-sorted within their groups (group ascending), and on how many bytes each agrees
    with the one before it in that order (-1 at the first of a group)."""
    size = np.array([len(p) for p in parts], np.int64)
    begin = np.concatenate([[0], np.cumsum(size + 1)])  # a gap byte ends each part, so that empty parts have a place
    data = np.frombuffer(b"\0".join([*parts, b""]), np.uint8)
    ends = np.repeat(begin[:-1] + size, size + 1)
    limit = int(size.max(initial=0)) + 1
    suffixes = _Suffixes(data, ends, limit)
    at = suffixes.sort(begin[:-1], group)
    order = np.searchsorted(begin, at, "right") - 1
    agree = np.full(len(at), -1, np.int64)
    same = np.flatnonzero(group[order][1:] == group[order][:-1]) + 1
    if len(same):
        n = suffixes.extension(at[same - 1], at[same])
        # The bytes themselves, against hash collisions: the first difference before the claimed length counts.
        reach, top = np.arange(limit), len(suffixes.data) - 1
        for k in range(0, len(same), 1 << 14):
            x, y, m = at[same[k : k + (1 << 14)] - 1], at[same[k : k + (1 << 14)]], n[k : k + (1 << 14)]
            differ = suffixes.data[np.minimum(x[:, None] + reach, top)] != suffixes.data[np.minimum(y[:, None] + reach, top)]
            differ &= reach < m[:, None]
            n[k : k + (1 << 14)] = np.where(differ.any(axis=1), differ.argmax(axis=1), m)
        agree[same] = n
    return order, agree


def repeated_reaches(lefts: list[bytes], rights: list[bytes], group: np.ndarray, total: int) -> tuple[np.ndarray, np.ndarray]:
    """For stretches that share a middle (one group each): the smallest and largest x with a repeated string that takes
    x bytes of the left part and total - x of the right one; -1 where there is none.

    Left parts are given from the middle outwards. Both sides are suffix-sorted once; at every x the stretches that
    agree on both sides are those in the same run of both orders.
    """
    n = len(lefts)
    size_l, size_r = (np.array([len(p) for p in parts], np.int64) for parts in (lefts, rights))
    low, high = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
    sides = [_classes(parts, group) for parts in (lefts, rights)]

    def runs(side: tuple[np.ndarray, np.ndarray], least: int) -> np.ndarray:
        order, agree = side
        out = np.empty(n, np.int64)
        out[order] = np.cumsum(agree < least)
        return out

    for x in range(total + 1):
        fits = np.flatnonzero((size_l >= x) & (size_r >= total - x))
        if len(fits) < 2:
            continue
        key = runs(sides[0], x)[fits] * (n + 1) + runs(sides[1], total - x)[fits]
        by = np.argsort(key, kind="stable")
        twin = key[by][1:] == key[by][:-1]
        hit = np.zeros(len(fits), bool)
        hit[by[1:][twin]] = hit[by[:-1][twin]] = True
        found = fits[hit]
        low[found] = np.where(low[found] < 0, x, low[found])
        high[found] = x
    return low, high


# ---- the operator ---------------------------------------------------------------------------------------------------

#: Anchors that one task combines before it sends them.
COMBINED = 1 << 21


def _keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, text, k1, k2): equal texts have equal keys of 128 bits; a null text is empty."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id"), text.alias("text"), F.xxhash64(text).alias("k1"), F.xxhash64(F.lit("second key"), text).alias("k2"))


def _stretches(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Per anchor: position, row, hash, begin and end of the stretch of all its strings, hash of the stretch."""
    pos, row, h = anchors(data, offsets, length)
    begin = np.maximum(pos - (length - GRAM), offsets[row])
    end = np.minimum(pos + length, offsets[row + 1])
    sums, (_, down) = prefix_hash(data), powers(len(data))
    near = (sums[end] - sums[begin]) * down[begin]
    near = mix(near ^ ((pos - begin) * 1000003 + (end - begin)).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return pos, row, h, begin, end, near


def _occurrences(texts: DataFrame, length: int) -> DataFrame:
    """(anchor, stretch, n, keys): occurrences of each stretch, and the texts that hold it, combined within a task."""
    ship(texts.sparkSession)
    schema = "anchor long, stretch long, n long, keys array<struct<k1: long, k2: long>>"
    arrow = arrow_schema(texts.sparkSession, schema)

    def combined(parts: list) -> pa.RecordBatch:
        h, near, k1, k2 = (np.concatenate([p[i] for p in parts]) for i in range(4))
        order = np.lexsort((k2, k1, near, h))
        h, near, k1, k2 = h[order], near[order], k1[order], k2[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (near[1:] != near[:-1])
        text = new.copy()
        text[1:] |= (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])
        first = np.flatnonzero(new)
        before = np.concatenate([[0], np.cumsum(text)])
        bounds = np.concatenate([before[first], before[-1:]])
        keys = pa.StructArray.from_arrays([pa.array(k1[text]), pa.array(k2[text])], names=["k1", "k2"])
        columns = {"anchor": h[first].view(np.int64), "stretch": near[first].view(np.int64), "n": np.diff(np.append(first, len(h))), "keys": pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), keys)}
        return to_batch(columns, arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            data, off = utf8(batch.column(0))
            k1, k2 = (batch.column(i).to_numpy() for i in (1, 2))
            for i, j in slices(off):
                _, row, h, _, _, near = _stretches(data[off[i] : off[j]], off[i : j + 1] - off[i], length)
                parts.append((h, near, k1[i + row], k2[i + row]))
                held += len(h)
            if held >= COMBINED:
                yield combined(parts)
                parts, held = [], 0
        if held:
            yield combined(parts)

    return texts.select("text", "k1", "k2").mapInArrow(run, schema)


def _open_stretches(texts: DataFrame, length: int) -> DataFrame:
    """(key_a, key_b, k1, k2, origin, left, right) of the stretches named in `open`, for strings that start early and late.

    A string holds either the 76 bytes before its anchor or the 76 after its gram; with the anchor, equal strings agree
    on these, so they are part of the key under which stretches meet. What lies to the left and right of this shared
    middle travels; origin is where the middle begins in the text.
    """
    half = (length - GRAM + 1) // 2

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        data, off = utf8(batch.column(0))
        k1, k2 = (batch.column(i).to_numpy() for i in (1, 2))
        wanted = batch.column(3)
        for i, j in slices(off):
            part, base = data[off[i] : off[j]], off[i : j + 1] - off[i]
            pos, row, h, begin, end, near = _stretches(part, base, length)
            names = np.unique(wanted.slice(i, j - i).flatten().to_numpy(zero_copy_only=False)).view(np.uint64)
            pick = np.isin(near, names)
            pos, row, h, begin, end = pos[pick], row[pick], h[pick], begin[pick], end[pick]
            sums, (_, down) = prefix_hash(part), powers(len(part))
            for early in (True, False):
                a, b = (pos - half, pos + GRAM) if early else (pos, pos - half + 1 + length)
                lo = begin if early else np.maximum(begin, pos - half + 1)
                hi = np.minimum(end, pos - half + length) if early else end
                ok = (a >= lo) & (b <= hi) & (hi - lo >= length)
                lo, hi, a, b, who = lo[ok], hi[ok], a[ok], b[ok], row[ok]
                shared = mix((sums[b] - sums[a]) * down[a] ^ np.uint64(int(early)))
                yield {
                    "key_a": h[ok].view(np.int64),
                    "key_b": shared.view(np.int64),
                    "k1": k1[i + who],
                    "k2": k2[i + who],
                    "origin": a - base[who],
                    "left": pa.array([part[x:y][::-1].tobytes() for x, y in zip(lo, a, strict=True)], pa.binary()),
                    "right": pa.array([part[x:y].tobytes() for x, y in zip(b, hi, strict=True)], pa.binary()),
                }

    schema = "key_a long, key_b long, k1 long, k2 long, origin long, left binary, right binary"
    return arrow_map(texts.select("text", "k1", "k2", "open"), run, schema)


def _sorted_out(stretches: DataFrame, length: int) -> DataFrame:
    """(k1, k2, begin, end) of the bytes of repeated strings among stretches of one key; rows come grouped and sorted."""
    ship(stretches.sparkSession)
    schema = "k1 long, k2 long, begin long, end long"
    arrow = arrow_schema(stretches.sparkSession, schema)
    total = length - GRAM - (length - GRAM + 1) // 2

    def found(rows: list) -> pa.RecordBatch:
        key_a, key_b, k1, k2, origin, left, right = (np.concatenate([r[i] for r in rows]) for i in range(7))
        new = np.concatenate([[True], (key_a[1:] != key_a[:-1]) | (key_b[1:] != key_b[:-1])])
        group = np.cumsum(new) - 1
        busy = (np.bincount(group) > 1)[group]
        k1, k2, origin, left, right, group = k1[busy], k2[busy], origin[busy], left[busy], right[busy], group[busy]
        group = np.unique(group, return_inverse=True)[1]
        low, high = repeated_reaches(left.tolist(), right.tolist(), group, total) if len(left) else (group, group)
        hit = low >= 0
        # Strings of one stretch overlap, so what they cover is one range.
        columns = {"k1": k1[hit], "k2": k2[hit], "begin": (origin - high)[hit], "end": (origin - low)[hit] + length}
        return to_batch(columns, arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        size = 0
        for batch in batches:
            columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(7)]
            if not len(columns[0]):
                continue
            held.append(columns)
            size += batch.num_rows
            if size >= 20_000:  # what is complete; the last key may go on
                a, b = columns[0], columns[1]
                last = np.flatnonzero((a != a[-1]) | (b != b[-1]))
                if len(last):
                    m = last[-1] + 1
                    yield found([*held[:-1], [c[:m] for c in columns]])
                    held, size = [[c[m:] for c in columns]], len(a) - m
        if held:
            yield found(held)

    dealt = stretches.repartition("key_a", "key_b").sortWithinPartitions("key_a", "key_b", "k1", "k2", "origin")
    return dealt.mapInArrow(run, schema)


def _kept(texts: DataFrame, length: int, with_text: bool) -> DataFrame:
    """Per distinct text: n_bytes, n_removed, n_spans, digest of what is kept, and with `with_text` the kept text."""

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        data, off = utf8(batch.column(0))
        k1, k2 = (batch.column(i).to_numpy() for i in (1, 2))
        full, ranges = batch.column(3), pc.fill_null(batch.column(4), pa.scalar([], batch.column(4).type))
        for i, j in slices(off):
            part, base = data[off[i] : off[j]], off[i : j + 1] - off[i]
            gone = np.zeros(len(part) + 1, np.int32)
            names = np.unique(full.slice(i, j - i).flatten().to_numpy(zero_copy_only=False)).view(np.uint64)
            if len(names):
                _, _, _, begin, end, near = _stretches(part, base, length)
                hit = np.isin(near, names)
                np.add.at(gone, begin[hit], 1)
                np.add.at(gone, end[hit], -1)
            own = ranges.slice(i, j - i)
            origin = np.repeat(base[:-1], own.value_lengths().to_numpy())
            for end, step in (("begin", 1), ("end", -1)):
                np.add.at(gone, own.flatten().field(end).to_numpy() + origin, step)
            gone = np.cumsum(gone[:-1]) > 0
            edge = np.concatenate([[0], np.cumsum(gone)])
            rise = gone.copy()
            rise[1:] &= ~gone[:-1]
            heads = base[:-1][base[1:] > base[:-1]]
            rise[heads] = gone[heads]
            spans = np.concatenate([[0], np.cumsum(rise)])
            kept = [part[base[r] : base[r + 1]][~gone[base[r] : base[r + 1]]].tobytes() for r in range(j - i)]
            yield {
                "k1": k1[i:j],
                "k2": k2[i:j],
                "n_bytes": np.diff(base),
                "n_removed": edge[base[1:]] - edge[base[:-1]],
                "n_spans": spans[base[1:]] - spans[base[:-1]],
                "kept_sha256": [hashlib.sha256(x).hexdigest() for x in kept],
                "kept_text": [x.decode("utf-8", "ignore") if with_text else None for x in kept],
            }

    schema = "k1 long, k2 long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_text string"
    return arrow_map(texts.select("text", "k1", "k2", "full", "ranges"), run, schema)


def _by_text(docs: DataFrame, length: int, with_text: bool) -> tuple[DataFrame, DataFrame]:
    """(rows with keys, what is kept of each distinct text)."""
    rows = _keyed(docs)
    per_anchor, per_stretch = Window.partitionBy("anchor"), Window.partitionBy("anchor", "stretch")
    seen = _occurrences(rows, length).repartition("anchor")
    seen = seen.withColumn("n", F.sum("n").over(per_stretch)).withColumn("holder", F.min(F.col("keys")[0]).over(per_stretch))
    seen = seen.select("*", (F.min("stretch").over(per_anchor) < F.max("stretch").over(per_anchor)).alias("differ"), F.min("n").over(per_anchor).alias("least"))
    seen = seen.where("differ or n > 1").select("stretch", "keys", "holder", (F.col("n") > 1).alias("is_full"), (F.col("differ") & (F.col("least") == 1)).alias("is_open"))
    named = seen.select("stretch", "holder", "is_full", "is_open", F.explode("keys").alias("key"))
    named = named.select("key.k1", "key.k2", "stretch", "is_full", (F.col("is_open") & (F.col("holder") == F.col("key"))).alias("is_open")).where("is_full or is_open")
    per_text = cut(named.groupBy("k1", "k2").agg(F.collect_set(F.when(F.col("is_full"), F.col("stretch"))).alias("full"), F.collect_set(F.when(F.col("is_open"), F.col("stretch"))).alias("open")))

    texts = rows.groupBy("k1", "k2").agg(F.min("text").alias("text"))  # used twice, exchanged once
    opened = texts.join(per_text.where(F.size("open") > 0).select("k1", "k2", "open"), ["k1", "k2"])
    sorted_out = _sorted_out(_open_stretches(opened, length), length).groupBy("k1", "k2").agg(F.collect_list(F.struct("begin", "end")).alias("ranges"))
    known = texts.join(per_text.select("k1", "k2", "full"), ["k1", "k2"], "left").join(sorted_out, ["k1", "k2"], "left")
    return rows, _kept(known, length, with_text)


def repeated_bytes(docs: DataFrame, length: int = 200) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans (maximal removed runs) and the SHA-256 of the remaining bytes.

    A null text is empty; texts below `length` bytes lose nothing. Repeated rows are copies like any other: each loses
    every byte. Rows without doc_id are treated as the rest. An empty table gives no rows.
    """
    rows, kept = _by_text(docs, length, with_text=False)
    return rows.select("doc_id", "k1", "k2").join(kept.drop("kept_text"), ["k1", "k2"]).drop("k1", "k2")


def without_repeats(docs: DataFrame, length: int = 200) -> DataFrame:
    """`docs` with repeated passages cut out of `text` and `n_chars` counted again; all rows and columns stay.

    A character of which a cut leaves only some bytes goes. A null text, or one that loses nothing, stays as it is.
    """
    _, kept = _by_text(docs, length, with_text=True)
    changed = kept.where("n_removed > 0").select(F.col("k1").alias("_k1"), F.col("k2").alias("_k2"), F.col("kept_text").alias("_kept"))
    text = F.coalesce(F.col("row")["text"], F.lit(""))
    keyed = packed_rows(docs).withColumns({"_a": F.xxhash64(text), "_b": F.xxhash64(F.lit("second key"), text)})
    joined = keyed.join(changed, (F.col("_a") == F.col("_k1")) & (F.col("_b") == F.col("_k2")), "left")
    return unpacked_rows(joined, docs, F.col("_kept"))
