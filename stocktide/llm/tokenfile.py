"""Token ids of a corpus as canonical length-limited Huffman code, in independent blocks with bit-offset checkpoints.

A token file is a Parquet table of blocks, so that Spark commits and reads it like any other: per block the documents it
holds, in ascending doc_id, one bit stream for each (from a byte boundary on), the bit offset of every 256th id, and the
number of ids in the blocks before it in its part. Any block is decoded without the others, and within it all checkpoint
stretches at once: one table look-up per step gives the next id and its length for every stretch.
Code lengths come from the counts of all ids (package-merge, at most 16 bits); the table of lengths is a file of its own,
bounded by the vocabulary.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stocktide.llm.bpe import OVERHEAD, REMEMBERED, broadcast_vocabulary, loaded, public_vocabulary
from stocktide.llm.common import _arrow_schema as arrow_schema
from stocktide.llm.common import Growing, arrow_map, cut, lists, mix, scratch, ship, slices, to_batch, utf8

#: Longest code in bits; ids of one stretch between checkpoints; ids of one block (a longer document is one block).
LONGEST, STRETCH, BLOCK = 16, 256, 1 << 18
#: The space in the vocabulary's spelling of bytes; pieces encoded at once.
SPACE, TOGETHER = "\u0120", 256
#: Bytes of text that are encoded at once; bytes of pieces and their ids, with overhead, that one task remembers.
TEXT_BYTES, CACHE_BYTES = 1 << 22, 96 << 20
#: Where rows without doc_id stand.
NO_ID = -(2**63)
BLOCKS = "part int, block int, before long, doc_ids array<long>, counts array<long>, checkpoints array<long>, payload binary"


def _strings(pieces: pa.Array) -> list[str]:
    """Strings without spaces, as one text that is divided again: many times faster than one by one."""
    if not len(pieces):
        return []
    whole = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(pieces)], pa.int32()), pieces), " ")
    return whole[0].as_py().split(" ")


class Library:
    """The tokenizers library with one vocabulary.

    Columns of texts are cut at lone spaces, which the vocabulary's own cutting never crosses. Distinct pieces are found
    by Arrow, exactly; those that aren't remembered go to the library, and ids of texts are gathered from the ids of
    their pieces. The memory is bounded in bytes, starts anew when full, and only saves time.
    """

    def __init__(self, raw: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(raw.decode())
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.opens = np.zeros(max(vocabulary.values(), default=0) + 1, bool)  # tokens that start with a space
        self.opens[[i for t, i in vocabulary.items() if t.startswith(SPACE)]] = True
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.forget()

    def forget(self) -> None:
        # Places of pieces behind a space, and of those that open a text; -1: white space beside the cut.
        self.known: tuple[dict[str, int], dict[str, int]] = ({}, {})
        self.ids, self.ends, self.held = Growing("<u4"), Growing(), 0
        self.ends.add([0])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids of each)."""
        got = [np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.concatenate([np.zeros(0, "<u4"), *got]), np.array(list(map(len, got)), np.int64)

    def encode_spaced(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same of pieces without spaces, each behind a space: many are encoded as one text, which the spaces divide."""
        out = []
        for first in range(0, len(pieces), TOGETHER):
            part = pieces[first : first + TOGETHER]
            ids = np.array(self.tokenizer.encode_batch_fast([" " + " ".join(part)], add_special_tokens=False)[0].ids, "<u4")
            begin = np.flatnonzero(self.opens[ids])
            if len(begin) == len(part):
                out.append((ids, np.diff(np.append(begin, len(ids)))))
            else:  # a vocabulary without tokens of its own for the space
                out.append(self.encode([" " + t for t in part]))
        return tuple(np.concatenate([o[k] for o in out]) for k in (0, 1)) if out else self.encode([])

    def _add(self, ids: np.ndarray, counts: np.ndarray) -> range:
        first = self.ends.size - 1
        self.ends.add(self.ids.size + np.cumsum(counts))
        self.ids.add(ids)
        return range(first, first + len(counts))

    def _places(self, pieces: list[str], head: bool) -> np.ndarray:
        """Places of distinct pieces; new ones are encoded."""
        known = self.known[head]
        new = [p for p in pieces if p not in known]
        inner = [p for p in new if p and not p[0].isspace() and not p[-1].isspace()]
        known.update(dict.fromkeys(new, -1))
        ids, counts = self.encode(inner) if head else self.encode_spaced(inner)
        known.update(zip(inner, self._add(ids, counts), strict=True))
        self.held += OVERHEAD * len(new) + sum(map(len, new)) + 4 * len(ids)
        out = np.fromiter(map(known.__getitem__, pieces), np.int64, len(pieces))
        for p in new:
            if len(p) > REMEMBERED:
                del known[p]
        return out

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, bounds of each); a null text is empty."""
        if self.held > CACHE_BYTES:
            self.forget()
        n = len(texts)
        texts = pc.fill_null(texts, "")
        cut_up = pc.split_pattern(texts, " ")
        bounds = cut_up.offsets.to_numpy().astype(np.int64)
        bounds -= bounds[0]
        pieces = cut_up.flatten()
        coded = pieces.dictionary_encode()
        places = self._places(_strings(coded.dictionary), False)[coded.indices.to_numpy()]
        heads = pieces.take(pa.array(bounds[:-1])).dictionary_encode()
        places[bounds[:-1]] = self._places(_strings(heads.dictionary), True)[heads.indices.to_numpy()]
        row = np.repeat(np.arange(n), np.diff(bounds))
        odd = np.zeros(n, bool)
        odd[row[places < 0]] = True
        for token in self.special:
            odd |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        ids_size, ends_size = self.ids.size, self.ends.size
        if odd.any():  # white space beside a cut, or special tokens: such texts are encoded whole
            own = np.flatnonzero(odd)
            whole = self._add(*self.encode(texts.take(pa.array(own)).to_pylist()))
            keep = ~odd[row]
            places, row = np.append(places[keep], list(whole)), np.append(row[keep], own)
            order = np.argsort(row, kind="stable")
            places, row = places[order], row[order]
        begin = self.ends.data[places]
        size = self.ends.data[places + 1] - begin
        ends = np.cumsum(size)
        ids = self.ids.data[np.repeat(begin - (ends - size), size) + np.arange(int(size.sum()))]
        self.ids.size, self.ends.size = ids_size, ends_size  # whole texts aren't remembered
        return ids, np.append(0, np.cumsum(np.bincount(row, size, n))).astype(np.int64)


def library_ids(docs: DataFrame, vocabulary: str | None = None, end_id: int = 0) -> DataFrame:
    """(doc_id, ids binary: little-endian unsigned 32-bit, counts) of every whole text with the end id appended.

    The last row of each task has no ids: `counts` holds how often its rows have each id, as 64-bit integers.
    """
    shared = broadcast_vocabulary(docs.sparkSession, vocabulary or public_vocabulary())
    schema = "doc_id long, ids binary, counts binary"
    ship(docs.sparkSession)
    arrow = arrow_schema(docs.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library, total = loaded(shared.value, Library), np.zeros(0, np.int64)
        for batch in batches:
            for i, j in slices(utf8(batch.column(1))[1], TEXT_BYTES):
                ids, bounds = library.encode_column(batch.column(1).slice(i, j - i))
                ids = np.insert(ids, bounds[1:], end_id)
                bounds = (bounds + np.arange(len(bounds))) * 4
                n = np.bincount(ids)
                total = np.pad(total, (0, max(0, len(n) - len(total))))
                total[: len(n)] += n
                raw = pa.Array.from_buffers(pa.binary(), j - i, [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(ids)])
                yield to_batch({"doc_id": batch.column(0).slice(i, j - i), "ids": raw, "counts": pa.nulls(j - i, pa.binary())}, arrow)
        library.forget()  # the worker lives on
        yield to_batch({"doc_id": pa.nulls(1, pa.int64()), "ids": pa.nulls(1, pa.binary()), "counts": [total.tobytes()]}, arrow)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


# ---- the code -----------------------------------------------------------------------------------------------------------


def code_lengths(counts: np.ndarray, longest: int = LONGEST) -> np.ndarray:
    """Lengths of an optimal prefix code with at most `longest` bits; 0 for ids that don't occur (package-merge)."""
    used = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.int64)
    if len(used) < 2:
        out[used] = 1
        return out
    while (1 << longest) < len(used):
        longest += 1
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.float64)
    is_leaf, packages = [], np.zeros(0)
    for _ in range(longest):
        both = np.concatenate([leaves, packages])
        rank = np.argsort(both, kind="stable")
        is_leaf.append(rank < len(leaves))
        row = both[rank]
        packages = row[: len(row) // 2 * 2].reshape(-1, 2).sum(axis=1)
    take = 2 * len(order) - 2
    for leaf in reversed(is_leaf):
        taken = int(leaf[:take].sum())
        out[order[:taken]] += 1
        take = 2 * (take - taken)
    return out


def canonical(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of length, then id."""
    codes = np.zeros(len(lengths), np.uint64)
    code = last = 0
    for i in np.lexsort((np.arange(len(lengths)), lengths)):
        if lengths[i]:
            code <<= int(lengths[i]) - last
            codes[i], last = code, int(lengths[i])
            code += 1
    return codes


def decode_table(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(id, length) for every value of the next `bits` bits."""
    bits = int(lengths.max(initial=1))
    ids, sizes = np.zeros(1 << bits, np.int64), np.ones(1 << bits, np.int64)
    used = np.flatnonzero(lengths)
    codes = canonical(lengths)
    start = (codes[used] << (bits - lengths[used]).astype(np.uint64)).astype(np.int64)
    order = np.argsort(start)
    span = np.repeat(used[order], 1 << (bits - lengths[used][order]))
    ids[: len(span)], sizes[: len(span)] = span, lengths[span]
    return ids, sizes, bits


def pack_bits(ids: np.ndarray, bounds: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
    """(bytes, byte offset of each text's stream, bit offset of every id); texts are ids[bounds[i]:bounds[i+1]]."""
    size = lengths[ids]
    ends = np.concatenate([[0], np.cumsum(size)])
    own = ends[bounds[1:]] - ends[bounds[:-1]]
    begin = np.concatenate([[0], np.cumsum((own + 7) // 8)])
    row = np.repeat(np.arange(len(own)), np.diff(bounds))
    at = ends[:-1] - ends[bounds[:-1]][row] + begin[row] * 8
    word = at >> 5
    value = codes[ids] << (64 - size - (at & 31)).astype(np.uint64)
    n = int(begin[-1] // 4 + 3)
    # Codes don't overlap, so adding is setting bits; sums stay below 2**32 and are exact.
    bits = np.bincount(word, (value >> np.uint64(32)).astype(np.float64), n) + np.bincount(word + 1, (value & np.uint64(0xFFFFFFFF)).astype(np.float64), n)
    return bits.astype(np.uint64).astype(">u4").tobytes()[: int(begin[-1])], begin, at


def unpack_bits(payload: bytes, starts: np.ndarray, counts: np.ndarray, table: tuple[np.ndarray, np.ndarray, int]) -> np.ndarray:
    """Ids of stretches that start at bit offsets, `counts` of each, one after the other."""
    ids, sizes, bits = table
    data = np.concatenate([np.frombuffer(payload, np.uint8), np.zeros(4, np.uint8)]).astype(np.int64)
    out = np.zeros(int(counts.sum()), np.int64)
    to = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64)
    order = np.argsort(-counts, kind="stable")
    at, to, left = starts[order].copy(), to[order], counts[order]
    for step in range(int(counts.max(initial=0))):
        live = int(np.searchsorted(-left, -step, "left"))  # stretches that have an id left
        at, to = at[:live], to[:live]
        byte = at >> 3
        window = (data[byte] << 24) | (data[byte + 1] << 16) | (data[byte + 2] << 8) | data[byte + 3]
        peek = (window >> (32 - bits - (at & 7))) & ((1 << bits) - 1)
        out[to + step] = ids[peek]
        at += sizes[peek]
    return out


# ---- writing and reading ------------------------------------------------------------------------------------------------


def id_counts(encoded: DataFrame) -> np.ndarray:
    """How often each id occurs: the sum of the tasks' counts, each as long as the vocabulary at most."""

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        for raw in batch.column(0):
            n = np.frombuffer(raw.as_py(), np.int64)
            used = np.flatnonzero(n)
            yield {"id": used, "n": n[used]}

    counted = arrow_map(encoded.where("counts is not null").select("counts"), run, "id long, n long")
    rows = counted.groupBy("id").agg(F.sum("n").alias("n")).collect()  # a row per id of the vocabulary at most
    counts = np.zeros(max([r["id"] for r in rows], default=0) + 1, np.int64)
    for r in rows:
        counts[r["id"]] = r["n"]
    return counts


def id_bounds(docs: DataFrame, n: int) -> np.ndarray:
    """n - 1 ascending doc_ids that divide the rows about evenly; a doc_id of many rows appears as often as it fills parts."""
    ids = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"))
    cuts = ids.select(F.percentile_approx("id", [i / n for i in range(1, n)], 100 * n).alias("cuts")).first()["cuts"] if n > 1 else None
    return np.sort(np.array(cuts or [], np.int64))


def part_of(ids: np.ndarray, bounds: np.ndarray, salt: np.ndarray) -> np.ndarray:
    """Part of each row, ascending with its id. Rows of one id that fills several parts are dealt over these."""
    low, high = np.searchsorted(bounds, ids, "left"), np.searchsorted(bounds, ids, "right")
    return low + (salt % (high - low + 1).astype(np.uint64)).astype(np.int64)


def write_tokens(docs: DataFrame, path: str, vocabulary: str | None = None, end_id: int = 0) -> None:
    """Write the token file of `docs` below `path`: `blocks` in ascending doc_id order and the code's `lengths`.

    A null text is empty and has the end id only. Rows without doc_id come first; repeated rows stay, in any order
    among equal ids. Rows without doc_id or of one doc_id may be any share of all rows: they are dealt over as many
    parts as they fill. An empty table gives a file without blocks.
    """
    spark = docs.sparkSession
    encoded = cut(library_ids(docs, vocabulary, end_id))
    lengths = code_lengths(id_counts(encoded))
    spark.createDataFrame([(int(i), int(lengths[i])) for i in np.flatnonzero(lengths)], "id long, bits int").coalesce(1).write.parquet(f"{path}/lengths")
    code = spark.sparkContext.broadcast((canonical(lengths), lengths))
    encoded = encoded.where("ids is not null").select("doc_id", "ids")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = id_bounds(encoded, parts)

    def coded(batch: pa.RecordBatch) -> Iterator[dict]:
        codes, sizes = code.value
        raw, offsets = utf8(batch.column(1))
        ids = pc.fill_null(batch.column(0), NO_ID).to_numpy()
        for i, j in slices(offsets):
            own, at_row = raw[offsets[i] : offsets[j]], (offsets[i : j + 1] - offsets[i]) // 4
            payload, begin, at = pack_bits(own.view("<u4"), at_row, codes, sizes)
            marks = [at[a:b:STRETCH] - begin[k] * 8 for k, (a, b) in enumerate(zip(at_row[:-1], at_row[1:], strict=True))]
            bounds_of_marks = np.concatenate([[0], np.cumsum(list(map(len, marks)))])
            yield {
                "part": part_of(ids[i:j], bounds, mix(begin[1:].astype(np.uint64) + np.arange(i, j).astype(np.uint64))),
                "doc_id": batch.column(0).slice(i, j - i),
                "n": np.diff(at_row),
                "marks": lists(np.concatenate(marks), bounds_of_marks, pa.int64()),
                "bits": [payload[a:b] for a, b in zip(begin[:-1], begin[1:], strict=True)],
            }

    dealt = arrow_map(encoded, coded, "part int, doc_id long, n long, marks array<long>, bits binary").repartitionById(parts, F.col("part")).sortWithinPartitions("part", "doc_id")
    arrow = arrow_schema(spark, BLOCKS)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, before, held, size, part = 0, 0, [], 0, None

        def block() -> pa.RecordBatch:
            rows = pa.Table.from_batches(held).combine_chunks()
            payload, begin = utf8(rows.column("bits"))
            marks = rows.column("marks").combine_chunks()
            each = np.diff(marks.offsets.to_numpy())
            placed = marks.flatten().to_numpy() + 8 * np.repeat(begin[:-1], each)
            one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
            columns = {"part": [part], "block": [number], "before": [before], "doc_ids": one(rows.column("doc_id").combine_chunks()), "counts": one(rows.column("n").combine_chunks()), "checkpoints": one(pa.array(placed)), "payload": [payload.tobytes()]}
            return to_batch(columns, arrow)

        for batch in batches:
            first = 0
            parts_here, n = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            while first < batch.num_rows:
                if part is not None and parts_here[first] != part:  # another part begins
                    if held:
                        yield block()
                    number, before, held, size = 0, 0, [], 0
                part = int(parts_here[first])
                end = int(np.searchsorted(parts_here, part, "right"))
                full = int(np.searchsorted(np.cumsum(n[first:end]) + size, BLOCK)) + first + 1
                end = min(end, full)
                held.append(batch.slice(first, end - first))
                size += int(n[first:end].sum())
                first = end
                if size >= BLOCK:
                    yield block()
                    number, before, held, size = number + 1, before + size, [], 0
        if held:
            yield block()

    dealt.mapInArrow(blocks, BLOCKS).write.parquet(f"{path}/blocks")


def _decoded(spark: SparkSession, path: str, made: Callable[[bytes], object], column: str) -> DataFrame:
    """(doc_id, start, n_tokens, and a column that `made` derives from the ids) of every document of a token file."""
    lengths_of = spark.read.parquet(f"{path}/lengths").collect()  # a row per id of the vocabulary at most
    lengths = np.zeros(max([r["id"] for r in lengths_of], default=0) + 1, np.int64)
    for r in lengths_of:
        lengths[r["id"]] = r["bits"]
    shared = spark.sparkContext.broadcast(lengths)
    stored = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    own = stored.select("part", F.aggregate("counts", F.lit(0).cast("long"), lambda a, b: a + b).alias("n")).groupBy("part").agg(F.sum("n").alias("n"))
    ahead = own.select("part", (F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))).alias("ahead"))
    # A row per part: as many as shuffle partitions when the file was written.
    placed = stored.join(F.broadcast(ahead), "part").withColumn("before", F.col("before") + F.coalesce("ahead", F.lit(0)))

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        table = decode_table(shared.value)
        for i in range(batch.num_rows):  # one block at a time
            row = batch.slice(i, 1).to_pylist()[0]
            n = np.array(row["counts"], np.int64)
            pieces = (n + STRETCH - 1) // STRETCH
            last = np.cumsum(pieces) - 1
            size = np.full(int(pieces.sum()), STRETCH, np.int64)
            size[last[n > 0]] = (n - (pieces - 1) * STRETCH)[n > 0]
            ids = unpack_bits(row["payload"], np.array(row["checkpoints"], np.int64), size, table).astype("<u4")
            ends = np.cumsum(n)
            yield {"doc_id": row["doc_ids"], "start": row["before"] + ends - n, "n_tokens": n, column.split()[0]: [made(ids[b - a : b].tobytes()) for a, b in zip(n, ends, strict=True)]}

    return arrow_map(placed.select("before", "doc_ids", "counts", "checkpoints", "payload"), run, f"doc_id long, start long, n_tokens long, {column}")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids binary) of every document of a token file; start counts the ids of all before it."""
    return _decoded(spark, path, bytes, "ids binary")


def token_digests(docs: DataFrame, vocabulary: str | None = None, end_id: int = 0) -> DataFrame:
    """Per row: doc_id, start, n_tokens and CRC-32 of its ids, from a token file written to the shared folder and read back."""
    path = scratch(docs.sparkSession, "tokens")
    write_tokens(docs, path, vocabulary, end_id)
    return _decoded(docs.sparkSession, path, zlib.crc32, "ids_crc32 long")
