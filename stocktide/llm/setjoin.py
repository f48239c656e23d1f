"""N-gram Jaccard join by set-relation skipping.

Method: sets are ordered by one global order (rare shingles first) and only a prefix of each is indexed, so that two
sets above the threshold share an indexed shingle. Equal sets are one class. Two relations between sets save work:

* Index blocks. An index list is read in blocks by position and size; what can't reach the threshold from its place
  in the prefix, or from its size, is skipped inside the join.
* Symmetric differences. A set carries a parity sketch: its shingles are dealt over bits, and a bit is set where their
  number is odd. Two sets differ in at least as many shingles as their sketches differ in bits, so most pairs that share
  an indexed shingle by chance are dropped, exactly, before whole sets travel.
* Answers. In each list the set in which the shingle stands earliest (the one with fewest rare shingles of its own)
  is the pivot. Every member is compared with the pivot only, which is linear in the list. What a member's answers
  are follows from the pivot's: members linked to one pivot are in one component and need no comparison, and by the
  triangle inequality of the Jaccard distance a member at distance x of the pivot can only link to members whose
  distance to it is within 1 - threshold of x. Only pairs that this leaves open are compared one by one.

Links inside one component that the pivots have already joined are not listed; components are exact. Classes of equal
sets are numbered by what they hold, so rows that share a doc_id but not their text stay apart.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocktide.llm.common import (
    arrow_map,
    bitmap_bits,
    bitmap_of,
    bounds_of,
    bucket_counts,
    components,
    cut,
    distinct_by_row,
    id_text,
    lists,
    looked_up,
    mix,
    packed_rows,
    slices,
    utf8,
    with_bit,
    words,
)

#: Counters of the frequency table that orders the shingles: 2**20 of one byte are sent to the tasks, whatever the input.
ORDER_BITS = 20


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every k-word shingle; a text of fewer words has its whole sequence as one."""
    h, row = words(data, offsets)
    n = len(offsets) - 1
    count = np.bincount(row, minlength=n)
    first = np.concatenate([[0], np.cumsum(count)])[:-1]
    whole = np.maximum(count - k + 1, (count > 0).astype(np.int64))
    out_row = np.repeat(np.arange(n), whole)
    at = np.arange(len(out_row)) - np.repeat(np.concatenate([[0], np.cumsum(whole)])[:-1], whole) + first[out_row]
    end = (first + count)[out_row]
    acc = np.zeros(len(at), np.uint64)
    for i in range(k):
        there = at + i < end
        acc = acc * np.uint64(0x9E3779B97F4A7C15) + np.where(there, h[np.minimum(at + i, max(len(h) - 1, 0))] if len(h) else np.uint64(0), np.uint64(i + 1))
    return mix(acc), out_row


def _rows(batch: pa.RecordBatch, k: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    data, offsets = utf8(batch.column(batch.schema.get_field_index("text")))
    for i, j in slices(offsets):
        yield i, j, *shingle_hashes(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], k)


def _order_table(docs: DataFrame, k: int) -> np.ndarray:
    """One byte for each hash bucket: the logarithm of how often its shingles occur in all documents."""

    def hashes(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for _, _, h, _row in _rows(batch, k):
            yield h

    counts = bucket_counts(docs.select("text"), hashes, ORDER_BITS)
    return np.minimum(255, np.floor(4 * np.log2(1 + counts))).astype(np.uint8)


def _keys(h: np.ndarray, order: np.ndarray) -> np.ndarray:
    """A shingle's place in the global order, which is also its identity: log frequency, then 56 bits of its hash."""
    return (order[(h >> np.uint64(64 - ORDER_BITS)).astype(np.int64)].astype(np.uint64) << np.uint64(56)) | ((h * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(8))


def _signed(keys: np.ndarray) -> np.ndarray:
    """Unsigned order kept in signed longs."""
    return (keys ^ np.uint64(1 << 63)).view(np.int64)


#: Bits of the shortest and the longest parity sketch; a set of n shingles has about 2 n.
SKETCH = (256, 1 << 16)


def parity_sketches(keys: np.ndarray, row: np.ndarray, n: np.ndarray) -> pa.Array:
    """Per row: its distinct shingles dealt over a power of two of bits by hash, each bit the parity of its number."""
    bits = np.clip(1 << np.ceil(np.log2(np.maximum(1, 2 * n))).astype(np.int64), *SKETCH)
    begin = np.concatenate([[0], np.cumsum(bits)])
    place = (mix(keys ^ np.uint64(0x5BD1E995)) & (bits[row] - 1).astype(np.uint64)).astype(np.int64) + begin[row]
    odd = (np.bincount(place, minlength=int(begin[-1])) & 1).astype(np.uint8)
    raw = np.packbits(odd, bitorder="little")
    return pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer((begin // 8).astype(np.int32)), pa.py_buffer(raw)])


def sketch_distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bits in which rows of sketch bytes differ. The longer sketches are folded: bits of one place modulo the shorter add up."""
    if a.shape[1] < b.shape[1]:
        a, b = b, a
    folded = np.bitwise_xor.reduce(a.reshape(len(a), -1, b.shape[1]), axis=1)
    return np.bitwise_count(folded ^ b).sum(axis=1, dtype=np.int64)


def shingle_sets(docs: DataFrame, order, k: int, percent: int, whole: bool) -> DataFrame:
    """Per row: doc_id, text_hash, n_shingles, a 128-bit key of the set, its prefix, or with `whole` the whole set, in
    order, and without `whole` its parity sketch."""

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        table = order.value
        for i, j, h, row in _rows(batch, k):
            keys, row = distinct_by_row(_keys(h, table), row)
            m = j - i
            b = bounds_of(row, m)
            n = np.diff(b)
            one, two = mix(keys), mix(keys ^ np.uint64(0xA5A5A5A5A5A5A5A5))
            sums = [np.concatenate([[np.uint64(0)], np.cumsum(x)]) for x in (one, two)]
            got = [(s[b[1:]] - s[b[:-1]]).view(np.int64) for s in sums]
            kept = n if whole else np.where(n > 0, n - -(-percent * n // 100) + 1, 0)
            pick = np.arange(len(keys)) - b[row] < kept[row]
            yield {
                "doc_id": batch.column(0).slice(i, m),
                "text_hash": batch.column(2).slice(i, m),
                "n_shingles": n,
                "key_a": got[0],
                "key_b": got[1],
                "shingles": lists(_signed(keys[pick]), np.concatenate([[0], np.cumsum(kept)])),
                "sketch": pa.nulls(m, pa.binary()) if whole else parity_sketches(keys, row, n),
            }

    return arrow_map(docs.select("doc_id", "text", "text_hash"), run, "doc_id long, text_hash long, n_shingles long, key_a long, key_b long, shingles array<long>, sketch binary")


def _reaches(percent: int) -> F.Column:
    """What two index entries (sizes n_a and n_b, positions p_a and p_b) can reach if this is their first common shingle."""
    left = F.least(F.col("n_a") - F.col("p_a"), F.col("n_b") - F.col("p_b"))
    return (100 + percent) * left >= percent * (F.col("n_a") + F.col("n_b"))


def _sizes(percent: int) -> F.Column:
    return (100 * F.least("n_a", "n_b")) >= (percent * F.greatest("n_a", "n_b"))


def _plausible(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes that their sketches don't rule out: none that links is lost."""

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        n = batch.column(2).to_numpy() + batch.column(3).to_numpy()
        (x, at_x), (y, at_y) = utf8(batch.column(4)), utf8(batch.column(5))
        size = np.stack([np.diff(at_x), np.diff(at_y)], axis=1)
        keep = np.zeros(batch.num_rows, bool)
        for own in np.unique(size, axis=0):
            every = np.flatnonzero((size == own).all(axis=1))
            for rows in np.array_split(every, -(-len(every) * int(own.sum()) // (1 << 24))):
                a, b = (data[at[rows][:, None] + np.arange(w)] for data, at, w in ((x, at_x, own[0]), (y, at_y, own[1])))
                keep[rows] = (100 + percent) * sketch_distance(a, b) <= (100 - percent) * n[rows]
        where = pa.array(keep)
        yield {"a": batch.column(0).filter(where), "b": batch.column(1).filter(where)}

    own = classes.select("class_id", "n_shingles", "sketch")
    a, b = own.toDF("a", "n_a", "sketch_a"), own.toDF("b", "n_b", "sketch_b")
    return cut(arrow_map(pairs.join(b, "b").join(a, "a").select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b"), run, "a long, b long"))


def _verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, order, k: int, percent: int) -> DataFrame:
    """(a, b, near, n_common, n_union) of each pair of classes, from whole sets. Only texts that are asked for travel."""
    named = pairs.select(F.col("a").alias("class_id")).union(pairs.select("b")).distinct()
    wanted = cut(classes.select("class_id", F.col("first.doc_id").alias("doc_id"), F.col("first.text_hash").alias("text_hash")).join(named, "class_id", "left_semi"))
    key = F.xxhash64("doc_id", "text_hash")
    bits = bitmap_bits(wanted.count())
    some = with_bit(docs, key, bitmap_of(wanted.select(key.alias("key")), bits), bits, "wanted").where("wanted")
    texts = some.join(wanted, ["doc_id", "text_hash"]).select(F.col("class_id").alias("doc_id"), "text", "text_hash")
    sets = cut(shingle_sets(texts, order, k, percent, whole=True).select(F.col("doc_id").alias("class_id"), "shingles").dropDuplicates(["class_id"]))
    a, b = sets.toDF("a", "s_a"), sets.toDF("b", "s_b")
    both = pairs.join(b, "b").join(a, "a")
    counted = both.select("a", "b", F.size(F.array_intersect("s_a", "s_b")).cast("long").alias("n_common"), (F.size("s_a") + F.size("s_b")).alias("n_sum"))
    counted = counted.select("a", "b", "n_common", (F.col("n_sum") - F.col("n_common")).alias("n_union"))
    return cut(counted.withColumn("near", 100 * F.col("n_common") >= percent * F.col("n_union")))


def _decided(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """(doc_id, text_hash, n_shingles, component_id) of every row of (doc_id, text, text_hash)."""
    spark = docs.sparkSession
    order = spark.sparkContext.broadcast(_order_table(docs, k))
    found = cut(shingle_sets(docs, order, k, percent, whole=False))
    keys = ["key_a", "key_b", "n_shingles"]

    filled = found.where("doc_id is not null and n_shingles > 0")
    # Rows of equal sets leave each task as one. The class's number is fixed by writing it.
    classes = filled.groupBy(*keys).agg(F.min(F.struct("doc_id", "text_hash")).alias("first"), F.count(F.lit(1)).alias("n_members"), F.first("shingles").alias("shingles"), F.first("sketch").alias("sketch"))
    classes = cut(classes.withColumn("class_id", F.monotonically_increasing_id()))
    index = classes.select(F.col("class_id").alias("b"), F.col("n_shingles").alias("n_b"), F.posexplode("shingles").alias("p_b", "shingle"))

    # Pivots: the entry in which a shared shingle stands earliest.
    pivot = index.groupBy("shingle").agg(F.min(F.struct("p_b", "n_b", "b")).alias("first"), F.count(F.lit(1)).alias("entries")).where("entries > 1")
    pivot = pivot.select("shingle", F.col("first.b").alias("a"), F.col("first.n_b").alias("n_a"), F.col("first.p_b").alias("p_a"))
    shared = cut(index.join(pivot, "shingle"))
    stars = shared.where("a <> b").where(_sizes(percent) & _reaches(percent)).select("a", "b").distinct()
    star = _verified(_plausible(stars, classes, percent), classes, docs, order, k, percent)
    links = star.where("near").select("a", "b")
    joined = components(links)

    # What the pivots left open: entries of one list in different components.
    comp = joined.select(F.col("node").alias("b"), F.col("component").alias("c_b"))
    distance = star.select("a", "b", (1 - F.col("n_common") / F.col("n_union")).alias("x_b"))
    member = shared.join(comp, "b", "left").withColumn("c_b", F.coalesce("c_b", "b"))
    mixed = member.groupBy("shingle").agg((F.min("c_b") < F.max("c_b")).alias("open")).where("open").select("shingle")
    member = cut(member.join(mixed, "shingle", "left_semi").join(distance, ["a", "b"], "left").select("shingle", "b", "n_b", "p_b", "c_b", F.when(F.col("a") == F.col("b"), F.lit(0.0)).otherwise(F.col("x_b")).alias("x_b"), F.floor(F.log(F.col("n_b").cast("double")) / float(np.log(100 / percent))).alias("block")))
    other = member.select("shingle", F.col("b").alias("a"), F.col("n_b").alias("n_a"), F.col("p_b").alias("p_a"), F.col("c_b").alias("c_a"), F.col("x_b").alias("x_a"), F.explode(F.array(F.col("block") - 1, F.col("block"), F.col("block") + 1)).alias("block"))
    reach = (100 - percent) / 100 + 1e-9
    near_pivot = F.coalesce(F.abs(F.col("x_a") - F.col("x_b")) <= reach, F.lit(True))
    rest = member.join(other, ["shingle", "block"]).where((F.col("c_a") != F.col("c_b")) & (F.col("a") < F.col("b")) & _sizes(percent) & _reaches(percent) & near_pivot).select("a", "b").distinct()
    rest = rest.join(star.select("a", "b"), ["a", "b"], "left_anti").join(star.select(F.col("a").alias("b"), F.col("b").alias("a")), ["a", "b"], "left_anti")
    rest = _plausible(rest, classes, percent)
    if not rest.isEmpty():
        joined = components(links.union(_verified(rest, classes, docs, order, k, percent).where("near").select("a", "b")))

    # A component's id is the smallest doc_id of its classes.
    placed = classes.select("class_id", *keys, "n_members", "first.doc_id").join(joined, F.col("class_id") == F.col("node"), "left").withColumn("component", F.coalesce("component", "class_id"))
    placed = cut(placed.select("component", *keys, "n_members", "doc_id"))
    several = placed.groupBy("component").agg(F.min("doc_id").alias("component_id"), F.count(F.lit(1)).alias("uses")).where("uses > 1")
    class_of = looked_up(placed, several, ["component"], "uses", placed.count()).select(*keys, "n_members", F.coalesce("component_id", "doc_id").alias("component_id"))
    # Rows that belong to no class stay out of the exchange.
    rows = found.drop("shingles", "sketch").withColumn("key_a", F.when(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0), F.col("key_a")))
    out = looked_up(rows, class_of, keys, "n_members", rows.count())
    return out.select("doc_id", "text_hash", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))


def _hashed(docs: DataFrame) -> DataFrame:
    return id_text(docs).withColumn("text_hash", F.xxhash64("text"))


def jaccard_components(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row: components under 100 * |A and B| >= percent * |A or B|.

    Words are runs of bytes other than space and \\t-\\r with A-Z lowered; a set holds the distinct k-word shingles of
    the whole text. A null or empty text, or one without words, has the empty set (n_shingles 0) and links with
    nothing. Repeated rows have equal results. Rows of one doc_id with different texts are texts of their own, each
    with its own n_shingles and component. A row without doc_id keeps its n_shingles, has no component_id and links with
    nothing. An empty table gives no rows.
    """
    return _decided(_hashed(docs), k, percent).drop("text_hash")


def one_of_each(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of `docs` that stay: of each component the row with the smallest doc_id, and every row without doc_id.

    All columns stay as they are. Of rows with one doc_id and one text one stays; a row with the same doc_id and another
    text is judged by its own component.
    """
    stay = _decided(_hashed(docs), k, percent).where("doc_id = component_id").select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    rows = packed_rows(docs).withColumns({"_id": F.col("row.doc_id").cast("long"), "_hash": F.xxhash64(F.coalesce(F.col("row.text"), F.lit("")))})
    kept = rows.where("_id is not null").join(stay, ["_id", "_hash"], "left_semi").dropDuplicates(["_id", "_hash"]).select("row")
    return kept.unionByName(rows.where("_id is null").select("row")).select("row.*")
