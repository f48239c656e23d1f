"""Near-duplicate embeddings by cross-polytope hashing with multiprobe buckets.

A vector is normalised and rotated at random by fast Hadamard transforms (three rounds of sign flips and a transform).
Its hash is the nearest vertex of the cross-polytope: the largest coordinate and its sign. A table combines several such
hashes; besides its own bucket a vector looks into those that are next best, one hash changed at a time. Vectors that
meet are candidates if a 128-bit sign sketch doesn't tell them apart by far, and each candidate pair is verified by its
cosine in double precision. Equal vectors are one class, so copies don't meet in buckets.

Rotations per table follow the number of vectors (one more per factor 128), tables double with each: buckets stay
small and recall stays. Recall against brute force is measured in the tests.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocktide.llm.common import arrow_map, components, cut

#: Tables at two rotations, other buckets that a vector looks into per table, and bits in which near sketches may differ.
TABLES, PROBES, SKETCH_BITS = 12, 5, 40


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast transform along the last axis, a power of two long."""
    n, h = x.shape[-1], 1
    while h < n:
        y = x.reshape(*x.shape[:-1], n // (2 * h), 2, h)
        x = np.stack([y[..., 0, :] + y[..., 1, :], y[..., 0, :] - y[..., 1, :]], axis=-2).reshape(*x.shape[:-1], n)
        h *= 2
    return x / np.sqrt(n)


def rotated(x: np.ndarray, seed: int) -> np.ndarray:
    """A pseudo-random rotation of the rows, the same for one seed everywhere."""
    rng = np.random.default_rng(seed)
    for _ in range(3):
        x = hadamard(x * rng.choice([-1.0, 1.0], x.shape[1]))
    return x


def buckets(x: np.ndarray, tables: int, rotations: int, probes: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of each vector and table [n x tables], further buckets [n x tables x probes])."""
    n, d = x.shape
    own, more = np.zeros((n, tables), np.int64), np.zeros((n, tables, probes), np.int64)
    depth = min(d, probes + 1)
    for t in range(tables):
        code, loss = [], []
        for r in range(rotations):
            y = rotated(x, 1000 * t + r)
            top = np.argsort(-np.abs(y), axis=1, kind="stable")[:, :depth]
            value = np.take_along_axis(y, top, axis=1)
            code.append(2 * top + (value < 0))
            loss.append(np.abs(value[:, :1]) - np.abs(value))
        base = [(2 * d) ** r for r in range(rotations)]
        main = sum(c[:, 0] * b for c, b in zip(code, base, strict=True))
        own[:, t] = main
        other = np.concatenate([main[:, None] + (c[:, 1:] - c[:, :1]) * b for c, b in zip(code, base, strict=True)], axis=1)
        cost = np.concatenate([x[:, 1:] for x in loss], axis=1)
        best = np.argsort(cost, axis=1, kind="stable")[:, :probes]
        found = np.take_along_axis(other, best, axis=1)
        more[:, t, : found.shape[1]], more[:, t, found.shape[1] :] = found, main[:, None]
    return own, more


def sketch(x: np.ndarray) -> np.ndarray:
    """128 signs of rotated coordinates as two longs."""
    signs, k = [], 0
    while sum(s.shape[1] for s in signs) < 128:
        signs.append(rotated(x, 900_000 + k) > 0)
        k += 1
    return np.packbits(np.concatenate(signs, axis=1)[:, :128], axis=1).view(">u8").astype(np.uint64).view(np.int64)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _entries(classes: DataFrame, rotations: int, tables: int, probes: int) -> DataFrame:
    """(class_id, dim, spot, own, s0, s1): every bucket of a class, its own or one it looks into."""

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        sizes = np.array([len(v) for v in batch.column(1)])
        for d in np.unique(sizes):
            pick = pa.array(np.flatnonzero(sizes == d))
            x = _matrix(batch.column(1).take(pick))
            x = x / np.abs(x).max(axis=1, keepdims=True)
            x = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
            wide = np.zeros((len(x), 1 << max(1, int(d - 1).bit_length())))
            wide[:, :d] = x
            s = sketch(wide)
            own, more = buckets(wide, tables, rotations, probes)
            all_of = np.concatenate([own[:, :, None], more], axis=2) * tables + np.arange(tables)[None, :, None]
            per = tables * (1 + probes)
            ids = np.repeat(batch.column(0).take(pick).to_numpy(), per)
            yield {"class_id": ids, "dim": np.full(len(ids), d), "spot": all_of.ravel(), "own": np.tile(np.arange(1 + probes) == 0, len(x) * tables), "s0": np.repeat(s[:, 0], per), "s1": np.repeat(s[:, 1], per)}

    return arrow_map(classes.select("class_id", "embedding"), run, "class_id long, dim int, spot long, own boolean, s0 long, s1 long")


def _cosines(pairs: DataFrame) -> DataFrame:
    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        sizes = np.array([len(v) for v in batch.column(2)])
        for d in np.unique(sizes):
            pick = pa.array(np.flatnonzero(sizes == d))
            x, y = (_matrix(batch.column(i).take(pick)) for i in (2, 3))
            x, y = x / np.abs(x).max(axis=1, keepdims=True), y / np.abs(y).max(axis=1, keepdims=True)
            c = (x * y).sum(axis=1) / np.sqrt((x * x).sum(axis=1) * (y * y).sum(axis=1))
            yield {"a": batch.column(0).take(pick), "b": batch.column(1).take(pick), "cosine": c}

    return arrow_map(pairs.select("a", "b", "x", "y"), run, "a long, b long, cosine double")


def near_vectors(vectors: DataFrame, threshold: float = 0.95, tables: int = TABLES, probes: int = PROBES) -> DataFrame:
    """Per row: vec_id, n_links, component_id and kept, for links between vectors with cosine >= threshold.

    Vectors that are null, empty or zero, or hold null or non-finite components, link with nothing and are their own
    component; only vectors of one length are compared. Repeated rows are vectors of their own, linked like copies. A
    row without vec_id links with nothing, has no component_id and is kept. An empty table gives no rows.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    clean = F.col("vec_id").isNotNull() & F.coalesce(F.exists("embedding", lambda v: v != 0) & F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))), F.lit(False))
    rows = cut(rows.select("vec_id", F.when(clean, F.col("embedding")).alias("embedding"), F.when(clean, F.xxhash64("embedding")).alias("h0"), F.when(clean, F.xxhash64(F.lit("second key"), "embedding")).alias("h1")))
    classes = rows.where("h0 is not null").groupBy("h0", "h1").agg(F.min("vec_id").alias("class_id"), F.count(F.lit(1)).alias("size"))
    classes = cut(classes)
    vectors_of = rows.join(classes.select("h0", "h1", F.col("class_id").alias("vec_id")), ["h0", "h1", "vec_id"], "left_semi").select(F.col("vec_id").alias("class_id"), "embedding").dropDuplicates(["class_id"])
    vectors_of = cut(vectors_of)
    n = vectors_of.count()
    rotations = 2 + max(0, int(np.ceil(np.log(max(1, n) / 2**21) / np.log(128))))
    entries = cut(_entries(vectors_of, rotations, tables << (rotations - 2), probes))
    left = entries.where("own").select("dim", "spot", F.col("class_id").alias("a"), F.col("s0").alias("p0"), F.col("s1").alias("p1"))
    right = entries.select("dim", "spot", F.col("class_id").alias("b"), F.col("s0").alias("q0"), F.col("s1").alias("q1"))
    far = F.bit_count(F.col("p0").bitwiseXOR(F.col("q0"))) + F.bit_count(F.col("p1").bitwiseXOR(F.col("q1")))
    met = left.join(right, ["dim", "spot"]).where((F.col("a") != F.col("b")) & (far <= SKETCH_BITS))
    pairs = cut(met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    x = vectors_of.select(F.col("class_id").alias("a"), F.col("embedding").alias("x"))
    y = vectors_of.select(F.col("class_id").alias("b"), F.col("embedding").alias("y"))
    links = cut(_cosines(pairs.join(x, "a").join(y, "b")).where(F.col("cosine") >= threshold).select("a", "b"))
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    linked = both.join(classes.select(F.col("class_id").alias("b"), "size"), "b").groupBy(F.col("a").alias("class_id")).agg(F.sum("size").alias("others"))
    joined = components(links)
    info = classes.join(linked, "class_id", "left").join(joined, F.col("class_id") == F.col("node"), "left")
    info = info.select("h0", "h1", (F.col("size") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("component", "class_id").alias("component_id"))
    out = rows.drop("embedding").join(info, ["h0", "h1"], "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
