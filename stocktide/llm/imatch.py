"""Document fingerprints by I-Match over randomised lexicon subsets.

Terms count if their inverse document frequency lies in a band: neither words of every text nor one-offs. A text's
distinct terms in the band are sorted and hashed, once per lexicon subset. Subsets are drawn at random in ORDERS orders;
each order gives LEVELS nested subsets, every next one with half of the lexicon, so that for texts of any length some
subsets hold few of their terms and survive an edit. A cell of the fingerprint is the hash of one subset's terms, and
the likeness of two fingerprints is the share of equal cells among those in which either has a term.

Document frequencies are counted over all documents in a table of fixed size (2**22 counters), which is sent to the
tasks as one bit per counter: in the band or not. A shared counter adds a fraction of about 300 / 2**22 of the documents,
whatever their number, well below the band's lower end.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocktide.llm.common import _arrow_schema as arrow_schema
from stocktide.llm.common import arrow_map, bucket_counts, distinct_by_row, id_text, mix, ship, slices, to_batch, utf8, words

ORDERS, LEVELS, BITS = 16, 12, 22
#: Share of the documents that a term of the lexicon occurs in: idf from ln 10 to ln 5000.
BAND = (1 / 5000, 1 / 10)
#: Characters of text handled at once, and stretches of ascending doc_id per shuffle partition.
BATCH_CHARS, STRETCHES = 1 << 21, 4


def _terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return distinct_by_row(*words(data, offsets))


def lexicon(docs: DataFrame, band: tuple[float, float] = BAND) -> np.ndarray:
    """One bit for each counter: whether its terms' document frequency lies in the band."""

    def hashes(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        data, off = utf8(batch.column(0))
        for i, j in slices(off):
            yield _terms(data[off[i] : off[j]], off[i : j + 1] - off[i])[0]

    counts = bucket_counts(docs.select("text"), hashes, BITS)
    n = docs.count()
    return np.packbits((counts >= band[0] * n) & (counts <= max(1.0, band[1] * n)))


def fingerprints(texts: list[str], bits: np.ndarray) -> np.ndarray:
    """Cells [texts x ORDERS * LEVELS] of 16 bits; 0 where a text has no term in the subset.

    A text without a term in the band uses all its terms.
    """
    out = np.zeros((len(texts), ORDERS * LEVELS), np.uint16)
    data, off = utf8(pa.array(texts, pa.large_string()))
    for i, j in slices(off):
        h, row = _terms(data[off[i] : off[j]], off[i : j + 1] - off[i])
        n = j - i
        place = (h >> np.uint64(64 - BITS)).astype(np.int64)
        inside = (bits[place >> 3] >> (7 - (place & 7)).astype(np.uint8) & 1).astype(bool)
        has = np.bincount(row[inside], minlength=n) > 0
        pick = inside | ~has[row]
        h, row = h[pick], row[pick]
        for r in range(ORDERS):
            g = mix(h ^ np.uint64((r + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1)))
            level = np.minimum(LEVELS - 1, -np.log2(((g >> np.uint64(11)) + np.uint64(1)).astype(np.float64) * 2.0**-53)).astype(np.int64)
            key = row * LEVELS + level
            # The sum of the sorted terms' hashes stands for the hash of their list; 32-bit parts keep it exact.
            sums = np.bincount(key, (mix(g) & np.uint64(0xFFFFFFFF)).astype(np.float64), n * LEVELS).reshape(n, LEVELS)
            there = np.bincount(key, minlength=n * LEVELS).reshape(n, LEVELS)
            sums, there = (x[:, ::-1].cumsum(axis=1)[:, ::-1] for x in (sums, there))
            cells = mix(np.mod(sums, 2.0**52).astype(np.uint64) + there.astype(np.uint64)) % np.uint64(65535) + np.uint64(1)
            out[i:j, r * LEVELS : (r + 1) * LEVELS] = np.where(there > 0, cells, 0).astype(np.uint16)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal cells among those in which either fingerprint has a term; 1 for two without any."""
    either, same = (a > 0) | (b > 0), (a == b) & (a > 0)
    n = either.sum(axis=1)
    return np.where(n > 0, same.sum(axis=1) / np.maximum(n, 1), 1.0)


def document_fingerprints(docs: DataFrame, bits: np.ndarray | None = None) -> DataFrame:
    """(doc_id, fingerprint) of every row: the cells as hex. Null texts are empty; equal texts have equal fingerprints."""
    docs = id_text(docs)
    shared = docs.sparkSession.sparkContext.broadcast(lexicon(docs) if bits is None else bits)

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        cells = fingerprints([t or "" for t in batch.column(1).to_pylist()], shared.value)
        yield {"doc_id": batch.column(0), "fingerprint": [c.astype(">u2").tobytes().hex() for c in cells]}

    return arrow_map(docs, run, "doc_id long, fingerprint string")


SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def fingerprints_under_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edit, in which the last half comes from the next document's beginning.

    The next document is that of the next doc_id, after the last the first; a single document is its own next one. Rows
    without doc_id come first; rows of one doc_id follow each other in the order of their texts. A null text is empty.
    An empty table gives no rows.

    Documents are dealt in stretches of ascending doc_id; the first document of each also goes to the one before.
    """
    spark = docs.sparkSession
    docs = id_text(docs)
    ship(spark)
    ids = docs.select(F.coalesce("doc_id", F.lit(-(2**63))).alias("id"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions")) * STRETCHES
    cuts = ids.select(F.percentile_approx("id", [i / n for i in range(1, n)], 10 * n).alias("cuts")).first()["cuts"] if n > 1 else []
    bounds = np.unique(np.array(cuts or [], np.int64))

    def stretch(values: np.ndarray) -> np.ndarray:
        return np.searchsorted(bounds, values, "right")

    def firsts(batch: pa.RecordBatch) -> Iterator[dict]:
        values = batch.column(0).to_numpy()
        where = stretch(values)
        k, at = np.unique(where, return_inverse=True)
        low = np.full(len(k), 2**63 - 1, np.int64)
        np.minimum.at(low, at, values)
        yield {"stretch": k, "low": low}

    # A row per stretch: as many as shuffle partitions, times STRETCHES.
    heads = {r["stretch"]: r["low"] for r in arrow_map(ids, firsts, "stretch long, low long").groupBy("stretch").agg(F.min("low").alias("low")).collect()}
    order = sorted(heads)
    before = {heads[k]: order[i - 1] for i, k in enumerate(order) if i}  # first id of a stretch -> the stretch before it
    first, last = (heads[order[0]], order[-1]) if order else (None, None)

    def deal(batch: pa.RecordBatch) -> Iterator[dict]:
        values = np.array([-(2**63) if v is None else v for v in batch.column(0).to_pylist()], np.int64)
        where = stretch(values)
        yield {"stretch": where, "turn": np.zeros(len(values)), "id": values, "doc_id": batch.column(0), "text": batch.column(1)}
        for at, to, turn in [*((i, before[v], 1) for i, v in enumerate(values.tolist()) if v in before), *((i, last, 2) for i, v in enumerate(values.tolist()) if v == first)]:
            yield {"stretch": [to], "turn": [turn], "id": [values[at]], "doc_id": batch.column(0).slice(at, 1), "text": batch.column(1).slice(at, 1)}

    dealt = arrow_map(docs, deal, "stretch long, turn int, id long, doc_id long, text string")
    dealt = dealt.repartition("stretch").sortWithinPartitions("stretch", "turn", "id", "text")
    shared = spark.sparkContext.broadcast(lexicon(docs))
    arrow = arrow_schema(spark, SCHEMA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(rows: list[tuple]) -> pa.RecordBatch:
            """All rows but the last, each with the one after it."""
            pairs = [i for i in range(len(rows) - 1) if rows[i][1] == 0 and rows[i + 1][0] == rows[i][0]]
            texts = [r[3] for r in rows]
            edited = [texts[i][: len(texts[i]) - len(texts[i]) // 2] + texts[i + 1][: len(texts[i]) // 2] for i in pairs]
            own, new = fingerprints(texts, shared.value), fingerprints(edited, shared.value)
            at = np.array(pairs, np.int64)
            return to_batch(
                {
                    "doc_id": pa.array([rows[i][2] for i in pairs], pa.int64()),
                    "n_chars": [len(texts[i]) for i in pairs],
                    "edited_sha256": [hashlib.sha256(e.encode("utf-8", "replace")).hexdigest() for e in edited],
                    "fingerprint": [own[i].astype(">u2").tobytes().hex() for i in pairs],
                    "edited_fingerprint": [c.astype(">u2").tobytes().hex() for c in new],
                    "near_edited": likeness(own[at], new),
                    "near_next": likeness(own[at], own[at + 1]),
                },
                arrow,
            )

        held: list[tuple] = []
        size = 0
        for batch in batches:
            for row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True):
                held.append(row)
                size += len(row[3])
                if size >= BATCH_CHARS and len(held) > 1:
                    yield done(held)
                    held, size = held[-1:], len(row[3])
        if len(held) > 1:
            yield done(held)

    return dealt.mapInArrow(run, SCHEMA)
