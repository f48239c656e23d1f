"""Alignment of two tokenizations of the same bytes, by divide and conquer at shared cuts.

Both tokenizers cut a text into byte ranges. An interval between two shared ends is divided at the shared end nearest to
its middle, which a bisect in the other tokenizer's ends finds, and both halves are treated alike; an interval without a
shared end inside is a group. A stretch without shared ends is looked at a few times at most, so the work is
n log n in the tokens, whatever their order.

Both tokenizers always cut before a lone space between other characters (for the second one its vocabulary is asked
whether any token has a space behind another character). These are the first cuts taken: what lies between two of them is
encoded and aligned once while a cache of bounded bytes holds it.

Links that end together are counted over the whole corpus. Pairs that hold more than a 2**-20th of all links are fewer
than 2**20 and go to the tasks as a sorted array; all others meet their counts in an exchange, where no pair has more
rows than that share. The best count of each right id is a table as long as the vocabulary.
"""

from __future__ import annotations

import hashlib
import os
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocktide.llm.bpe import batches_of, byte_characters, loaded, public_vocabulary
from stocktide.llm.common import _arrow_schema as arrow_schema
from stocktide.llm.common import Growing, arrow_map, cut, ship, to_batch

#: Bytes of aligned stretches that one worker remembers, with their overhead; longer stretches are not remembered.
CACHE_BYTES, REMEMBERED = 128 << 20, 1024
#: Longest stretch in tokens that is divided together with others.
SHORT = 64
#: A pair with more than 1 / FREQUENT of all links is frequent; counted pairs that one task holds before it passes them on.
FREQUENT, HELD = 1 << 20, 1 << 22
_SAFE = re.compile(r"(?<=\S) (?=\S)")


def public_pieces() -> str:
    """Path of the default second vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def align(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Ends (index behind the last token) of the groups of two lists of ascending byte ends with the same last end."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))] if a and b else []
    while todo:
        a0, a1, b0, b1 = todo.pop()
        found = None
        if a1 - a0 > 1 and b1 - b0 > 1:
            last = a1 - 2  # the interval's own end is shared and doesn't divide it
            low = (a0 + last) // 2
            high = low + 1
            while low >= a0 or high <= last:
                if low >= a0:
                    j = bisect_left(b, a[low], b0, b1 - 1)
                    if j < b1 - 1 and b[j] == a[low]:
                        found = low + 1, j + 1
                        break
                    low = low - 1 if j > b0 else a0 - 1  # nothing of b ends before this
                if high <= last:
                    j = bisect_left(b, a[high], b0, b1 - 1)
                    if j < b1 - 1 and b[j] == a[high]:
                        found = high + 1, j + 1
                        break
                    high = high + 1 if j < b1 - 1 else last + 1  # nothing of b ends after this
        if found is None:
            out.append((a1, b1))
        else:
            todo.append((found[0], a1, found[1], b1))
            todo.append((a0, found[0], b0, found[1]))
    return out


def divide(a: np.ndarray, b: np.ndarray, a0: np.ndarray, a1: np.ndarray, b0: np.ndarray, b1: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """`align` for many short intervals at once, all on one level together: ends of all groups, in order.

    a and b ascend over all intervals; interval i holds a[a0[i]:a1[i]] and b[b0[i]:b1[i]] with the same last end.
    """
    ends = []
    while len(a0):
        more = (a1 - a0 > 1) & (b1 - b0 > 1)
        ends.append((a1[~more], b1[~more]))
        a0, a1, b0, b1 = a0[more], a1[more], b0[more], b1[more]
        at, to = np.full(len(a0), -1), np.zeros(len(a0), np.int64)
        side = [(a0 + a1 - 2) // 2, (a0 + a1 - 2) // 2 + 1]
        ahead = np.arange(len(a0))
        while len(ahead):
            for step in (0, 1):
                i = ahead[(at[ahead] < 0) & ((side[0][ahead] >= a0[ahead]) if step == 0 else (side[1][ahead] <= a1[ahead] - 2))]
                x = side[step][i]
                j = np.clip(np.searchsorted(b, a[x]), b0[i], b1[i] - 1)
                found = (j < b1[i] - 1) & (b[j] == a[x])
                at[i[found]], to[i[found]] = x[found] + 1, j[found] + 1
                over = j <= b0[i] if step == 0 else j >= b1[i] - 1  # nothing of b ends further out
                side[step][i] = np.where(over, a0[i] - 1 if step == 0 else a1[i], x - 1 if step == 0 else x + 1)
            ahead = ahead[(at[ahead] < 0) & ((side[0][ahead] >= a0[ahead]) | (side[1][ahead] <= a1[ahead] - 2))]
        whole = at < 0
        ends.append((a1[whole], b1[whole]))
        a0, a1, b0, b1, at, to = (v[~whole] for v in (a0, a1, b0, b1, at, to))
        a0, a1, b0, b1 = np.concatenate([a0, at]), np.concatenate([at, a1]), np.concatenate([b0, to]), np.concatenate([to, b1])
    return tuple(np.sort(np.concatenate([e[k] for e in ends])) if ends else np.zeros(0, np.int64) for k in (0, 1))


class Pair:
    """Two tokenizers, the bytes and decimal forms of their ids, and what they make of stretches of text."""

    def __init__(self, raw: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        size = int.from_bytes(raw[:8], "little")
        self.left = Tokenizer.from_str(raw[8 : 8 + size].decode())
        self.left.encode_special_tokens = True
        self.left.no_truncation()
        self.left.no_padding()
        self.right = sentencepiece.SentencePieceProcessor(model_proto=raw[8 + size :])
        to_byte = byte_characters()
        vocabulary = self.left.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocabulary.values(), default=-1) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = bytes(to_byte[c] for c in token) if all(c in to_byte for c in token) else token.encode()
        pieces = [self.right.id_to_piece(i) for i in range(self.right.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.right.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.a_size, self.b_size = (np.array(list(map(len, x)), np.int64) for x in (self.a_bytes, self.b_bytes))
        self.opens = np.array([x.startswith(b" ") for x in self.a_bytes])
        # Decimal ids with what may follow them, in this order: left within a group, left at its end, right likewise.
        left, right = (list(map(str, range(len(x)))) for x in (self.a_bytes, self.b_bytes))
        self.marks = [t + c for ids, signs in ((left, ",|"), (right, ",;")) for c in signs for t in ids]
        self.mark_size = np.array(list(map(len, self.marks)), np.int64)
        self.cuts = not any("▁" in p.lstrip("▁") for p in pieces)
        self.n_a, self.n_b = len(self.a_bytes), len(self.b_bytes)
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}  # -1: white space beside the cut
        self.groups: list[bytes] = []
        self.numbers = [Growing() for _ in range(4)]  # tokens of either side, groups, whether both give the bytes back
        self.links, self.links_end = Growing(), Growing()
        self.links_end.add(np.zeros(1, np.int64))
        self.held = 0

    def _left_ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids of each) of texts behind a space. Many without white space are encoded as one, which their spaces divide."""
        ids, counts = [], []
        for first in range(0, len(texts), 256):
            part = texts[first : first + 256]
            if not any(not t or " " in t or t != t.strip() for t in part):
                got = np.array(self.left.encode_batch_fast([" " + " ".join(part)], add_special_tokens=False)[0].ids, np.int64)
                begin = np.flatnonzero(self.opens[got])
                if len(begin) == len(part):
                    ids.append(got)
                    counts.append(np.diff(np.append(begin, len(got))))
                    continue
            for one in self.left.encode_batch_fast([" " + t for t in part], add_special_tokens=False):
                ids.append(np.array(one.ids, np.int64))
                counts.append([len(ids[-1])])
        return np.concatenate(ids), np.concatenate(counts)

    def measure(self, texts: list[str]) -> int:
        """Add what both tokenizers make of texts that stand between cuts; the place of the first one."""
        place = len(self.groups)
        a, a_n = self._left_ids(texts)
        right = self.right.encode(texts, num_threads=1)
        b, b_n = np.fromiter(chain.from_iterable(right), np.int64), np.array(list(map(len, right)), np.int64)
        raw = [b" " + t.encode() for t in texts]
        a1, b1 = np.cumsum(a_n), np.cumsum(b_n)
        a_end, b_end = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        end = np.cumsum(list(map(len, raw)))
        same = len(a) and len(b) and (b_n > 0).all() and (a_end[a1 - 1] == end).all() and (b_end[b1 - 1] == end).all()
        if not (same and b"".join(map(self.a_bytes.__getitem__, a.tolist())) == b"".join(map(self.b_bytes.__getitem__, b.tolist())) == b"".join(raw)):
            if len(texts) > 1:
                half = len(texts) // 2
                self.measure(texts[:half])
                self.measure(texts[half:])
            else:
                self.groups.append(b"")
                for n in self.numbers:
                    n.add(np.zeros(1, np.int64))
                self.links_end.add(self.links_end.data[self.links_end.size - 1 : self.links_end.size])
                self.held += 200
            return place
        a0, b0 = a1 - a_n, b1 - b_n
        long = np.maximum(a_n, b_n) > SHORT
        x, y = divide(a_end, b_end, a0[~long], a1[~long], b0[~long], b1[~long])
        for i in np.flatnonzero(long):
            own = np.array(align(a_end[a0[i] : a1[i]].tolist(), b_end[b0[i] : b1[i]].tolist()), np.int64)
            x, y = np.append(x, own[:, 0] + a0[i]), np.append(y, own[:, 1] + b0[i])
        x, y = np.sort(x), np.sort(y)
        n_groups = np.diff(np.searchsorted(x, np.append(0, a1), "right"))
        # Tokens in the order of the text form: a group's left ones, then its right ones.
        order = np.zeros(len(a) + len(b), np.int64)
        last_a, last_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
        last_a[x - 1], last_b[y - 1] = True, True
        order[np.arange(len(a)) + np.append(0, y)[np.cumsum(last_a) - last_a]] = a + self.n_a * last_a
        order[np.arange(len(b)) + x[np.cumsum(last_b) - last_b]] = b + 2 * self.n_a + self.n_b * last_b
        written = "".join(map(self.marks.__getitem__, order.tolist())).encode()
        stop = np.append(0, np.cumsum(self.mark_size[order])[a1 + b1 - 1]).tolist()
        self.groups += [written[i : j - 1] for i, j in zip(stop[:-1], stop[1:], strict=True)]
        for n, values in zip(self.numbers, (a_n, b_n, n_groups, np.ones(len(texts), np.int64)), strict=True):
            n.add(values)
        self.links_end.add(self.links.size + np.cumsum(n_groups))
        self.links.add(a[x - 1] * self.n_b + b[y - 1])
        self.held += 250 * len(texts) + len(written) + int(end[-1]) + 8 * len(x)
        return place

    def _learn(self, stretches: list[str]) -> None:
        for first in range(0, len(stretches), 4096):
            part = stretches[first : first + 4096]
            place = self.measure(part)
            self.known.update(zip(part, range(place, place + len(part)), strict=True))

    def stretches(self, texts: list[str]) -> list[list[int]]:
        """Places of the stretches between cuts of each text."""
        if self.held > CACHE_BYTES:
            self.forget()
        known = self.known
        cut_up = [t.split(" ") for t in texts] if self.cuts else [[t] for t in texts]
        new = [p for p in set().union(*cut_up) if p not in known]
        inner = [p for p in new if p and not p[0].isspace() and not p[-1].isspace()] if self.cuts else new
        known.update(dict.fromkeys(new, -1))
        self._learn(inner)
        out = [list(map(known.__getitem__, own)) for own in cut_up]
        odd = [i for i, own in enumerate(out) if -1 in own]
        if odd:
            cut_up = {i: _SAFE.split(texts[i]) for i in odd}
            longer = [s for s in dict.fromkeys(s for own in cut_up.values() for s in own) if known.get(s, -1) < 0]
            outer = {s for s in longer if s in known}  # stay marked as having white space beside the cut
            self._learn(longer)
            for i in odd:
                out[i] = [known[s] for s in cut_up[i]]
            known.update(dict.fromkeys(outer, -1))
            new += longer
        for s in new:
            if len(s) > REMEMBERED:
                del known[s]
        return out


def _broadcast(frame: DataFrame, left: str | None, right: str | None):
    with open(left or public_vocabulary(), "rb") as f, open(right or public_pieces(), "rb") as g:
        a, b = f.read(), g.read()
    return frame.sparkSession.sparkContext.broadcast(len(a).to_bytes(8, "little") + a + b)


def alignments(docs: DataFrame, left: str | None = None, right: str | None = None, groups: bool = False) -> DataFrame:
    """Per row: doc_id, n_a, n_b, n_groups, groups_sha256, the distinct links `keys` (left id * size of the right
    vocabulary + right id) with their `times`, and with `groups` the groups themselves as text.

    Texts that are null or empty, or that either tokenizer doesn't give back byte by byte behind a space, have no tokens.
    Rows stay as they are, with repeated or missing doc_ids too; an empty table gives no rows.
    """
    shared = _broadcast(docs, left, right)

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        pair: Pair = loaded(shared.value, Pair)
        for first, texts in batches_of(batch.column(1)):
            places = [own if text else [] for text, own in zip(texts, pair.stretches(texts), strict=True)]
            fine = pair.numbers[3].data
            for i, own in enumerate(places):
                if own and not fine[own].all():  # bytes may still agree in the whole
                    place = pair.measure([texts[i]])
                    fine = pair.numbers[3].data
                    places[i] = [place] if fine[place] else []
            texts_of = [b";".join(map(pair.groups.__getitem__, own)) for own in places]
            flat = np.fromiter(chain.from_iterable(places), np.int64)
            row = np.repeat(np.arange(len(texts)), list(map(len, places)))
            numbers = [np.bincount(row, n.data[flat], len(texts)).astype(np.int64) for n in pair.numbers[:3]]
            begin, size = pair.links_end.data[flat], pair.links_end.data[flat + 1] - pair.links_end.data[flat]
            at = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
            keys, row = pair.links.data[at], np.repeat(row, size)
            order = np.argsort(keys)
            order = order[np.argsort(row[order], kind="stable")]
            keys, row = keys[order], row[order]
            heads = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]) | (row[1:] != row[:-1]))[: len(keys)])
            bounds = np.searchsorted(row[heads], np.arange(len(texts) + 1)).astype(np.int32)
            out = {
                "doc_id": batch.column(0).slice(first, len(texts)),
                **dict(zip(("n_a", "n_b", "n_groups"), numbers, strict=True)),
                "groups_sha256": [hashlib.sha256(t).hexdigest() if t else "" for t in texts_of],
                "keys": pa.ListArray.from_arrays(pa.array(bounds), pa.array(keys[heads])),
                "times": pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.diff(np.append(heads, len(keys))))),
            }
            yield out | {"groups": [t.decode() for t in texts_of]} if groups else out

    schema = "doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, keys array<long>, times array<long>"
    return arrow_map(docs.select(F.col("doc_id").cast("long"), "text"), run, schema + (", groups string" if groups else ""))


def right_size(right: str | None = None) -> int:
    """Ids of the right vocabulary: links are left id * this + right id."""
    import sentencepiece

    return max(1, sentencepiece.SentencePieceProcessor(model_file=right or public_pieces()).get_piece_size())


def link_counts(aligned: DataFrame, n_right: int) -> DataFrame:
    """(key, n, best): links of each pair over all rows, and whether no other pair of its right id has more.

    A task adds up its rows before it sends a row per pair.
    """
    schema = "key long, n long"
    arrow = arrow_schema(aligned.sparkSession, schema)
    ship(aligned.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def added() -> tuple[np.ndarray, np.ndarray]:
            keys, at = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
            return keys, np.bincount(at, np.concatenate([n for _, n in held]), len(keys)).astype(np.int64)

        for batch in batches:
            held.append((batch.column(0).flatten().to_numpy(), batch.column(1).flatten().to_numpy()))
            size += len(held[-1][0])
            if size > HELD:
                held = [added()]
                size = len(held[0][0])
                if size > HELD // 2:
                    yield to_batch(dict(zip(("key", "n"), held[0], strict=True)), arrow)
                    held, size = [], 0
        if held:
            yield to_batch(dict(zip(("key", "n"), added(), strict=True)), arrow)

    counts = cut(aligned.select("keys", "times").mapInArrow(run, schema).groupBy("key").agg(F.sum("n").alias("n")).withColumn("right", F.col("key") % n_right))
    best = counts.groupBy("right").agg(F.max("n").alias("most"))  # a row per id of the right vocabulary at most
    return counts.join(F.broadcast(best), "right").select("key", "n", (F.col("n") == F.col("most")).alias("best"))


def aligned_links(docs: DataFrame, left: str | None = None, right: str | None = None, frequent: int = FREQUENT) -> DataFrame:
    """Per row: doc_id, n_a, n_b, n_groups, n_links, n_best (links whose pair no other pair of its right id exceeds),
    count_sum (over links, of their pair's count in the corpus), groups_sha256. See `alignments` for odd rows.
    """
    spark = docs.sparkSession
    # The row's own number is fixed by writing it.
    rows = cut(alignments(docs, left, right).withColumn("row", F.monotonically_increasing_id()))
    counts = cut(link_counts(rows, right_size(right)))
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    often = F.col("n") * frequent > total
    table = counts.where(often).toArrow()  # fewer than `frequent` rows
    order = np.argsort(table.column("key").to_numpy())
    shared = spark.sparkContext.broadcast(tuple(table.column(c).to_numpy()[order] for c in ("key", "n", "best")))

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        known, n, best = shared.value
        keys, times = batch.column(1).flatten().to_numpy(), batch.column(2).flatten().to_numpy()
        row = np.repeat(np.arange(batch.num_rows), np.diff(batch.column(1).offsets.to_numpy()))
        at = np.minimum(np.searchsorted(known, keys), max(0, len(known) - 1))
        there = known[at] == keys if len(known) else np.zeros(len(keys), bool)
        own, t, at = row[there], times[there], at[there]
        sums = [np.zeros(batch.num_rows, np.int64) for _ in range(2)]
        np.add.at(sums[0], own, t * best[at])
        np.add.at(sums[1], own, t * n[at])
        bounds = np.searchsorted(row[~there], np.arange(batch.num_rows + 1)).astype(np.int32)
        rest = [pa.ListArray.from_arrays(pa.array(bounds), pa.array(v[~there])) for v in (keys, times)]
        yield {"row": batch.column(0), "n_best": sums[0], "count_sum": sums[1], "keys": rest[0], "times": rest[1]}

    first = cut(arrow_map(rows.select("row", "keys", "times"), run, "row long, n_best long, count_sum long, keys array<long>, times array<long>"))
    rare = first.select("row", F.explode(F.arrays_zip("keys", "times")).alias("link")).select("row", F.col("link.keys").alias("key"), F.col("link.times").alias("times"))
    met = rare.join(counts.where(~often), "key").select("row", F.when(F.col("best"), F.col("times")).otherwise(0).alias("n_best"), (F.col("times") * F.col("n")).alias("count_sum"))
    sums = first.select("row", "n_best", "count_sum").unionByName(met).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    counted = rows.select("row", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256").join(sums, "row")
    return counted.select("doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), "n_best", "count_sum", "groups_sha256")
