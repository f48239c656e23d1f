"""Helpers shared by the operators: code shipping, stored intermediates, bounded count tables, byte-level word hashes."""

from __future__ import annotations

import io
import math
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one numpy step works on; a longer single text is one step of its own.
SLICE = 1 << 20

_POWERS: dict[str, np.ndarray] = {}
_BASE = 0x9E3779B97F4A7C15
_SHIPPED: dict[str, bool] = {}


def ship(spark: SparkSession) -> None:
    """Send this package to every executor, so that Python tasks import it wherever they run."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w") as out:
        for folder in (root, os.path.join(root, "llm")):
            for name in sorted(os.listdir(folder)):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(root)))
    path = os.path.join(tempfile.mkdtemp(prefix="ship-"), "stocktide_llm.zip")
    with open(path, "wb") as out:
        out.write(raw.getvalue())
    spark.sparkContext.addPyFile(path)
    _SHIPPED[app] = True


def shared_folder(spark: SparkSession) -> str:
    """The folder of `spark.checkpoint.dir`; a folder of our own only where none is set and the master is local."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="shared-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut(frame: DataFrame) -> DataFrame:
    """Write `frame` as Parquet in the shared folder and read it back: short lineage that survives lost executors."""
    spark = frame.sparkSession
    path = scratch(spark, "cut")
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_text(docs: DataFrame) -> DataFrame:
    """(doc_id, text) whatever other columns there are; a null text is empty."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def packed_rows(docs: DataFrame) -> DataFrame:
    """The rows as one struct column `row`: no column of theirs can clash with one that an operator adds."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def unpacked_rows(frame: DataFrame, docs: DataFrame, new_text: Column) -> DataFrame:
    """The columns of `docs` from `row`, with `text`, and n_chars if there is one, replaced where new_text isn't null."""
    row = F.col("row")
    out = {c: row[c] for c in docs.columns} | {"text": F.coalesce(new_text, row["text"])}
    if "n_chars" in docs.columns:
        out["n_chars"] = F.when(new_text.isNotNull(), F.length(new_text).cast(docs.schema["n_chars"].dataType)).otherwise(row["n_chars"])
    return frame.select(*[v.alias(k) for k, v in out.items()])


def arrow_map(frame: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """mapInArrow for a function batch -> iterable of dicts of columns; `schema` names the columns in order."""
    ship(frame.sparkSession)
    arrow = _arrow_schema(frame.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for out in fn(batch):
                yield to_batch(out, arrow)

    return frame.mapInArrow(run, schema)


def _arrow_schema(spark: SparkSession, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def to_batch(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    arrays = [columns[f.name] if isinstance(columns[f.name], pa.Array) else pa.array(columns[f.name], type=f.type) for f in schema]
    return pa.RecordBatch.from_arrays([a if a.type == f.type else a.cast(f.type) for a, f in zip(arrays, schema, strict=True)], schema=schema)


def lists(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType | None = None) -> pa.Array:
    """An Arrow list array: row i holds values[bounds[i]:bounds[i+1]]."""
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values, type=kind))


#: A row that more than 1 / HEAVY of all rows refer to is looked up by broadcast: there are fewer than HEAVY of them.
HEAVY = 1000


def looked_up(frame: DataFrame, table: DataFrame, keys: list[str], uses: str, total: int) -> DataFrame:
    """Left join of `frame` (`total` rows at most) with `table`, whose rows are unique by `keys` and say in `uses` how many
    rows of `frame` refer to them.

    Rows of the table with many uses, a bounded number, are broadcast; the others meet few rows each in an exchange, so
    that no key brings more than a thousandth of the frame to one task. Rows with null keys stay where they are.
    """
    large = F.col(uses) * HEAVY > total
    heavy, light = F.broadcast(table.where(large).drop(uses)), table.where(~large).drop(uses)
    some = frame.where(" and ".join(f"{k} is not null" for k in keys))
    none = frame.where(" or ".join(f"{k} is null" for k in keys)).select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in table.drop(*keys, uses).schema])
    rest = some.join(heavy, keys, "left_anti").join(light, keys, "left")
    return some.join(heavy, keys).unionByName(rest).unionByName(none)


# ---- bitmaps of keys ------------------------------------------------------------------------------------------------


def _slot(key: Column, bits: int) -> Column:
    return F.pmod(key, F.lit(1 << bits)) + 1


def bitmap_bits(n: int) -> int:
    """Size of a bitmap of n keys, as a power of two: about 16 bits a key, 2**27 bits (16 MB) at most."""
    return min(27, max(15, math.ceil(math.log2(16 * max(1, n)))))


def bitmap_of(keys: DataFrame, bits: int) -> DataFrame:
    """(_part, _bits) of a long column `key`: 2**bits bits in parts of 4 KB, those without a bit left out."""
    slot = _slot(F.col("key"), bits)
    return keys.groupBy(F.bitmap_bucket_number(slot).alias("_part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("_bits"))


def with_bit(frame: DataFrame, key: Column, bitmap: DataFrame, bits: int, name: str) -> DataFrame:
    """`frame` with a boolean: whether the bit of `key` is set. A false bit is certain, a true one may be another key's."""
    slot = _slot(key, bits)
    at = F.bitmap_bit_position(slot)
    byte = F.conv(F.hex(F.substring(F.col("_bits"), (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    found = frame.withColumn("_part", F.bitmap_bucket_number(slot)).join(F.broadcast(bitmap), "_part", "left")  # 2**bits bits at most
    return found.withColumn(name, F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False))).drop("_part", "_bits")


class Growing:
    """An array that grows at its end: `data` up to `size`."""

    def __init__(self, kind: str = "i8"):
        self.data, self.size = np.zeros(1 << 12, kind), 0

    def add(self, values: np.ndarray) -> None:
        while self.size + len(values) > len(self.data):
            self.data = np.concatenate([self.data, np.zeros_like(self.data)])
        self.data[self.size : self.size + len(values)] = values
        self.size += len(values)


# ---- bytes of texts ------------------------------------------------------------------------------------------------


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def slices(offsets: np.ndarray, limit: int = SLICE) -> Iterator[tuple[int, int]]:
    """Row ranges of at most `limit` bytes and 65,535 rows, one row at least."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = min(n, i + 65535, max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1))
        yield i, j
        i = j


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least n+1 of each."""
    if len(_POWERS.get("up", ())) <= n:
        size = max(n + 1, SLICE + 1)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _POWERS[name] = np.cumprod(table)
    return _POWERS["up"], _POWERS["down"]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Prefix polynomial sums: the hash of data[i:j] is (p[j] - p[i]) * down[i]."""
    up, _ = powers(len(data))
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=out[1:])
    return out


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every output bit depends on every input bit."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


#: Bytes that end a word: space and \t \n \v \f \r.
_GAP = np.zeros(256, bool)
_GAP[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_bounds(data: np.ndarray, offsets: np.ndarray, gap: np.ndarray = _GAP) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each word, in order: runs of non-gap bytes within one text."""
    if len(data) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = ~gap[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    filled = offsets[1:] > offsets[:-1]
    heads, tails = offsets[:-1][filled], offsets[1:][filled] - 1
    first[heads] = inside[heads]
    last[tails] = inside[tails]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of each word with A-Z lowered, index of its text), in order."""
    n = len(data)
    starts, ends = word_bounds(data, offsets)
    if len(starts) == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    sums, (_, down) = prefix_hash(LOWER[data]), powers(n)
    h = (sums[ends] - sums[starts]) * down[starts]
    h = mix(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return h, np.searchsorted(offsets, starts, "right") - 1


def distinct_by_row(h: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, hash) pairs sorted by row, then hash; rows are numbered below 65,536."""
    order = np.argsort(h)
    order = order[np.argsort(row[order].astype(np.uint16), kind="stable")]
    h, row = h[order], row[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    return h[keep], row[keep]


def bounds_of(row: np.ndarray, n: int) -> np.ndarray:
    """Offsets of each of n rows in a sorted row index."""
    return np.searchsorted(row, np.arange(n + 1))


# ---- count tables of a fixed size ----------------------------------------------------------------------------------

#: Counters of one chunk of a count table.
CHUNK = 1 << 12


def bucket_counts(frame: DataFrame, hashes: Callable[[pa.RecordBatch], Iterator[np.ndarray]], bits: int) -> np.ndarray:
    """Counts of hashed keys over the whole frame in a table of 2**bits counters.

    The table's size is fixed (2**bits counters of 8 bytes, for any input), and so is what reaches the driver. Keys
    that share a counter add up: with m keys per row on average a counter is too high by m / 2**bits of the rows,
    whatever their number. Each task adds up its rows first and sends only the chunks that it touched.
    """
    spark = frame.sparkSession
    ship(spark)
    size = 1 << bits

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(size, np.int64)
        for batch in batches:
            for h in hashes(batch):
                table += np.bincount((h >> np.uint64(64 - bits)).astype(np.int64), minlength=size) if len(h) > size // 8 else 0
                if len(h) <= size // 8:
                    np.add.at(table, (h >> np.uint64(64 - bits)).astype(np.int64), 1)
        yield from _chunks(table)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                got = _unpack(raw)
                total[chunk] = total[chunk] + got if chunk in total else got
        for chunk, got in total.items():
            yield pa.RecordBatch.from_pydict({"chunk": pa.array([chunk], pa.int32()), "counts": pa.array([_pack(got)], pa.binary())})

    schema = "chunk int, counts binary"
    parts = frame.mapInArrow(local, schema)
    # Two rounds: any number of map tasks meets in a bounded number of salted sums, then one sum per chunk.
    summed = parts.repartition("chunk", F.pmod(F.xxhash64(F.spark_partition_id()), F.lit(16))).mapInArrow(add, schema)
    summed = summed.repartition("chunk").mapInArrow(add, schema)
    out = np.zeros(size, np.int64)
    for row in summed.collect():  # 2**bits / CHUNK rows at most
        out[row["chunk"] * min(CHUNK, size) : (row["chunk"] + 1) * min(CHUNK, size)] += _unpack(row["counts"])
    return out


def _pack(counts: np.ndarray) -> bytes:
    kind = np.uint8 if counts.max(initial=0) < 256 else np.uint16 if counts.max() < 65536 else np.int64
    return bytes([np.dtype(kind).itemsize]) + counts.astype(kind).tobytes()


def _unpack(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, {1: np.uint8, 2: np.uint16, 8: np.int64}[raw[0]], offset=1).astype(np.int64)


def _chunks(table: np.ndarray) -> Iterator[pa.RecordBatch]:
    width = min(CHUNK, len(table))
    for k in range(len(table) // width):
        part = table[k * width : (k + 1) * width]
        if part.any():
            yield pa.RecordBatch.from_pydict({"chunk": pa.array([k], pa.int32()), "counts": pa.array([_pack(part)], pa.binary())})


# ---- connected components ------------------------------------------------------------------------------------------


def _flatten(parent: DataFrame) -> DataFrame:
    """Pointer jumping: every `up` becomes the end of its chain."""
    while True:
        ends = parent.select(F.col("node").alias("up"), F.col("up").alias("over"))
        parent = cut(parent.join(ends, "up", "left").select("node", F.coalesce("over", "up").alias("up"), F.col("over").isNotNull().alias("moved")))
        if parent.where("moved").isEmpty():
            return parent.select("node", "up")
        parent = parent.select("node", "up")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of `edges` (a, b) that isn't its component's smallest node.

    Each round hangs every node on its smallest neighbour, follows the chains to local minima and keeps only edges
    between different minima: at most half of the nodes stay, so rounds are logarithmic. Hub nodes only meet in
    `min`, which is combined before the exchange, and in joins that AQE splits.
    """
    e = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct())
    ups: list[DataFrame] = []
    while not e.isEmpty():
        parent = _flatten(e.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("up")))
        ups.append(parent)
        root_hi = parent.select(F.col("node").alias("hi"), F.col("up").alias("r_hi"))
        root_lo = parent.select(F.col("node").alias("lo"), F.col("up").alias("r_lo"))
        moved = e.join(root_hi, "hi").join(root_lo, "lo", "left").select(F.col("r_hi").alias("a"), F.coalesce("r_lo", "lo").alias("b")).where("a <> b")
        e = cut(moved.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct())
    if not ups:
        return edges.where("false").select(F.col("a").alias("node"), F.col("b").alias("component"))
    out = ups[0]
    for more in ups[1:]:
        out = out.unionByName(more)
    return (_flatten(out) if len(ups) > 1 else out).select("node", F.col("up").alias("component"))
