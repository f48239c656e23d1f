"""Toxic spans and document scores by a linear-chain conditional random field.

Labels are given per document. Labelled tokens come from them: a greedy cover finds word forms (whole words, and word
beginnings, which also stand for inflected forms) that occur in toxic training documents and hardly in others, each
covering documents that no earlier one explains; tokens with such a form in a toxic document are toxic ones. The field
(two states; hashed word, beginnings and endings as features; transitions) is fitted to them by full-batch gradient with
exact forward-backward expectations. A document's tokens form one chain, whatever its length; the marginals give the
offending spans and, summed and calibrated on the training documents, the score.

The fit uses a sample of labelled documents (SAMPLE per class, chosen by a hash of doc_id), with all of their text however
long it is: word forms are counted and chains cut where the text lies, and only chosen forms and CHAINS chains of each kind
meet in one task. Scoring runs over all rows.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocktide.llm.common import LOWER, arrow_map, cut, lists, mix, powers, prefix_hash, ship, slices, utf8, word_bounds

#: Labelled documents of each class that the model is fitted on at most.
SAMPLE = 1500
#: Hashed features; tokens of one training chain; training chains of each kind at most.
FEATURES, CHAIN, CHAINS = 1 << 18, 40, 8_000
#: Bytes of word beginnings and endings that are features, and of beginnings that can label a token.
HEADS, TAILS, FORMS = (3, 4, 5, 6, 7), (3, 4, 5), (4, 5, 6, 7, 8)

#: Bytes that aren't part of a word: all of ASCII but letters, digits and apostrophe.
_NO_LETTER = np.array([b < 0x80 and not (chr(b).isalnum() or b == 0x27) for b in range(256)])


def token_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(begin, end, row, feature indices [tokens x kinds]) of every token, A-Z lowered."""
    begin, end = word_bounds(data, offsets, _NO_LETTER)
    kinds = 1 + len(HEADS) + len(TAILS)
    out = np.zeros((len(begin), kinds), np.int32)
    if len(begin):
        sums, (_, down) = prefix_hash(LOWER[data]), powers(len(data))
        for k, (kind, n) in enumerate([("w", 0), *(("h", n) for n in HEADS), *(("t", n) for n in TAILS)]):
            a = begin if kind != "t" else np.maximum(begin, end - n)
            b = end if kind != "h" else np.minimum(end, begin + n)
            h = mix(((sums[b] - sums[a]) * down[a]) ^ np.uint64((k + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1)))
            out[:, k] = (h >> np.uint64(64 - 18)).astype(np.int32)
    return begin, end, np.searchsorted(offsets, begin, "right") - 1, out


class Field:
    """Weights of the field. State 1 is toxic; state 0 has no features."""

    def __init__(self, weights: np.ndarray, steps: np.ndarray, scale: tuple[float, float]):
        self.weights, self.steps, self.scale = weights, steps, scale

    def odds(self, features: np.ndarray) -> np.ndarray:
        return np.exp(np.clip(self.weights[0] + self.weights[1:].astype(np.float32)[features].sum(axis=1, dtype=np.float64), -18, 18)) if len(features) else np.zeros(0)

    def marginals(self, odds: np.ndarray, bounds: np.ndarray, pairs: bool = False):
        """Probability of state 1 for each token of chains bounds[i]:bounds[i+1]; with `pairs` also expected transitions.

        All chains advance together, longest first; forward and backward messages are kept as odds.
        """
        size = np.diff(bounds)
        order = np.argsort(-size, kind="stable")
        first, size = bounds[:-1][order], size[order]
        stay, on, off, both = np.exp(self.steps)  # 0-0, 0-1, 1-0, 1-1
        forward, backward = np.zeros(len(odds)), np.ones(len(odds))
        longest = int(size[0]) if len(size) else 0
        live = np.searchsorted(-size, -np.arange(longest + 1), "left")  # chains longer than t
        for t in range(longest):
            at = first[: live[t]] + t
            if t:
                r = forward[at - 1]
                forward[at] = odds[at] * (on + both * r) / (stay + off * r)
            else:
                forward[at] = odds[at]
        for t in range(longest - 1, 0, -1):
            at = first[: live[t]] + t
            m = odds[at] * backward[at]
            backward[at - 1] = (off + both * m) / (stay + on * m)
        z = forward * backward
        p = z / (1 + z)
        if not pairs:
            return p
        inner = np.ones(len(odds), bool)
        inner[bounds[1:][np.diff(bounds) > 0] - 1] = False
        left = np.flatnonzero(inner)
        m = odds[left + 1] * backward[left + 1]
        joint = np.stack([np.full(len(left), stay), on * m, off * forward[left], both * forward[left] * m])
        return p, (joint / joint.sum(axis=0)).sum(axis=1)

    def score(self, p: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
        mass = np.bincount(row, np.where(p >= 0.1, p, 0), n)
        return 1 / (1 + np.exp(-(self.scale[0] + self.scale[1] * np.log1p(mass))))


# ---- fitting ------------------------------------------------------------------------------------------------------------


def _forms(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> Iterator[np.ndarray]:
    """Hashes of each form of every token: the word, then its beginnings (0 where it is shorter)."""
    sums, (_, down) = prefix_hash(LOWER[data]), powers(len(data))
    for k, n in enumerate((0, *FORMS)):
        stop = np.minimum(end, begin + n) if n else end
        h = mix(((sums[stop] - sums[begin]) * down[begin]) ^ np.uint64(k + 1))
        yield np.where(end - begin >= n, h, np.uint64(0))


def _distinct(h: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, row, first place of each hash) of the distinct pairs, sorted; a hash of 0 is none."""
    order = np.lexsort((row, h))
    h, row = h[order], row[order]
    new = np.concatenate([[True], (h[1:] != h[:-1]) | (row[1:] != row[:-1])])[: len(h)] & (h != 0)
    h, row = h[new], row[new]
    return h, row, np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])[: len(h)])


def _tokens_of(batch: pa.RecordBatch) -> Iterator[tuple]:
    """(bytes, doc, toxic, begin, end, row, features) of each slice of rows (doc, toxic, text)."""
    data, off = utf8(batch.column(2))
    doc, toxic = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
    for i, j in slices(off, 2 << 20):
        part = data[off[i] : off[j]]
        yield part, doc[i:j], toxic[i:j].astype(bool), *token_features(part, off[i : j + 1] - off[i])


def _counted(batch: pa.RecordBatch) -> Iterator[dict]:
    """Toxic and other documents that have each form, per slice."""
    for data, _, toxic, begin, end, row, _ in _tokens_of(batch):
        for k, h in enumerate(_forms(data, begin, end)):
            h, r, first = _distinct(h, row)
            if len(first):
                hits = np.add.reduceat(toxic[r].astype(np.int64), first)
                yield {"form": h[first].view(np.int64), "kind": np.full(len(first), k, np.int32), "hits": hits, "others": np.diff(np.append(first, len(h))) - hits}


def cover(documents_of: dict[int, set[int]], others: dict[int, int], length: dict[int, int], least: float, share: float) -> np.ndarray:
    """Greedy cover of the toxic documents by forms that at most one in twenty times occur in others."""
    found, open_docs, pool = set(), set().union(*documents_of.values()), dict(documents_of)
    while open_docs and pool:
        new = {f: len(d & open_docs) for f, d in pool.items()}
        pool = {f: d for f, d in pool.items() if new[f] >= least}
        if not pool:
            break
        best = max(pool, key=lambda f: (new[f], len(pool[f]), length[f], f))
        found.add(best)
        open_docs -= pool.pop(best)
    # Forms as frequent as the found ones within documents already explained: other words of the same kind.
    if found:
        usual = max(0.3 * np.median([len(documents_of[f]) for f in found]), 3 * least, 4)
        found |= {f for f, d in documents_of.items() if len(d) >= usual and others[f] * share <= 0.002 * len(d)}
    return np.array(sorted(found), np.uint64)


def _chains(batch: pa.RecordBatch, found: np.ndarray) -> Iterator[pa.Table]:
    """Chains of CHAIN tokens of each slice: whether one is toxic, a hash to choose by, the bytes and the tokens' labels."""
    for data, doc, toxic, begin, end, row, _ in _tokens_of(batch):
        if not len(begin):
            continue
        label = np.zeros(len(begin), bool)
        for h in _forms(data, begin, end):
            label |= np.isin(h, found)
        label &= toxic[row]
        bounds = np.searchsorted(row, np.arange(len(doc) + 1))
        start = np.concatenate([np.arange(a, b, CHAIN) for a, b in zip(bounds[:-1], bounds[1:], strict=True)])
        stop = np.minimum(start + CHAIN, bounds[row[start] + 1])
        count = np.concatenate([[0], np.cumsum(label)])
        has = count[stop] > count[start]
        key = mix(doc[row[start]].view(np.uint64) ^ mix((start - bounds[row[start]] + 1).astype(np.uint64)))
        chosen = np.concatenate([k[np.argsort(key[k], kind="stable")][:CHAINS] for k in (np.flatnonzero(has), np.flatnonzero(~has))])
        raw, marks = data.tobytes(), label.astype(np.uint8).tobytes()
        yield pa.table(
            {
                "has": pa.array(has[chosen]),
                "key": pa.array((key[chosen] >> np.uint64(1)).astype(np.int64)),
                "body": pa.array([raw[begin[a] : end[b - 1]] for a, b in zip(start[chosen], stop[chosen], strict=True)], pa.binary()),
                "label": pa.array([marks[a:b] for a, b in zip(start[chosen], stop[chosen], strict=True)], pa.binary()),
            }
        )


def _least_keys(table: pa.Table) -> pa.Table:
    """The CHAINS chains of each kind that come first."""
    has, key = (table.column(i).to_numpy() for i in (0, 1))
    return table.take(np.concatenate([k[np.argsort(key[k], kind="stable")][:CHAINS] for k in (np.flatnonzero(has), np.flatnonzero(~has))]))


def fit(bodies: list[bytes], labels: list[bytes], rounds: int = 60) -> Field:
    """The field, not yet calibrated, for chains of labelled tokens."""
    offsets = np.concatenate([[0], np.cumsum([len(b) for b in bodies])]).astype(np.int64)
    _, _, row, x = token_features(np.frombuffer(b"".join(bodies), np.uint8), offsets)
    y = np.frombuffer(b"".join(labels), np.uint8).astype(float)
    chains = np.searchsorted(row, np.arange(len(bodies) + 1))
    inner = np.ones(len(x), bool)
    inner[chains[1:] - 1] = False
    left = np.flatnonzero(inner)
    seen = np.bincount((2 * y[left] + y[left + 1]).astype(int), minlength=4)
    field = Field(np.zeros(FEATURES + 1), np.zeros(4), (0.0, 1.0))
    theta, first, second = np.zeros(FEATURES + 5), np.zeros(FEATURES + 5), np.zeros(FEATURES + 5)
    kinds, n = x.shape[1], max(1, len(bodies))
    for step in range(1, rounds + 1):
        field.weights, field.steps = theta[: FEATURES + 1], theta[FEATURES + 1 :]
        p, expected = field.marginals(field.odds(x), chains, pairs=True)
        gap = p - y
        grad = np.concatenate([[gap.sum()], np.bincount(x.ravel(), np.repeat(gap, kinds), FEATURES), expected - seen]) / n + 1e-5 * theta
        first, second = 0.9 * first + 0.1 * grad, 0.99 * second + 0.01 * grad * grad
        theta = theta - 0.25 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return Field(theta[: FEATURES + 1].astype(np.float32), theta[FEATURES + 1 :], (0.0, 1.0))


def calibrated(mass: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Logistic calibration by Newton steps with a little shrinkage."""
    a, b = 0.0, 1.0
    for _ in range(200):
        q = 1 / (1 + np.exp(-np.clip(a + b * mass, -30, 30)))
        w = q * (1 - q) + 1e-6
        g = np.array([(q - toxic).sum() + 1e-3 * a, ((q - toxic) * mass).sum() + 1e-1 * b])
        h = np.array([[w.sum() + 1e-3, (w * mass).sum()], [(w * mass).sum(), (w * mass * mass).sum() + 1e-1]])
        move = np.linalg.solve(h, g)
        a, b = a - np.clip(move[0], -2, 2), b - np.clip(move[1], -2, 2)
        if abs(move).max() < 1e-6:
            break
    return float(a), float(b)


def constant(mean: float) -> Field:
    """The field that gives every text the score `mean`."""
    return Field(np.zeros(FEATURES + 1, np.float32), np.zeros(4), (float(np.log((mean + 1e-6) / (1 - mean + 1e-6))), 0.0))


def held_out() -> F.Column:
    """True for documents that are never learnt from: crc32(doc_id as text) mod 5 is 0, or there is no doc_id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(True))


def _first_of_each(rows: DataFrame, column: str, values: tuple, order: list[F.Column], n: int) -> DataFrame:
    """The first n rows of each value: each task sends n rows at most, so no class comes together in one."""
    parts = [rows.where(F.col(column) == v).orderBy(*order).limit(n) for v in values]
    return parts[0].unionByName(parts[1])


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = SAMPLE) -> Field:
    """Fit on labelled, not held-out rows: `sample` of each class at most, the first by a hash of doc_id."""
    known = labels.select("doc_id", F.col(label).cast("int").alias("_label")).where("_label in (0, 1)").groupBy("doc_id").agg(F.max("_label").alias("_label")).where(~held_out())
    known = cut(known)
    chosen = _first_of_each(known, "_label", (0, 1), [F.xxhash64("doc_id"), F.col("doc_id")], sample)
    # One row per different text of a document; it is read in slices wherever it lies, so no text is too long to learn from.
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(cut(chosen)), "doc_id").distinct()  # 2 * sample rows
    texts = cut(texts.select(F.xxhash64("doc_id", "text").alias("doc"), (F.col("_label") == 1).alias("toxic"), "text"))
    count = {r["toxic"]: r["count"] for r in texts.groupBy("toxic").count().collect()}
    n_toxic, n_clean = count.get(True, 0), count.get(False, 0)
    if not n_toxic or not n_clean:
        return constant(n_toxic / max(1, n_toxic + n_clean))
    share, least = n_toxic / n_clean, max(2, 0.002 * n_toxic)
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast

    forms = arrow_map(texts, _counted, "form long, kind int, hits long, others long").groupBy("form").agg(F.max("kind").alias("kind"), F.sum("hits").alias("hits"), F.sum("others").alias("others"))
    likely = forms.where((F.col("hits") >= least) & (F.col("others") * F.lit(share) <= 0.05 * F.col("hits"))).toArrow()
    names = likely["form"].to_numpy().view(np.uint64)
    wanted = shared((np.sort(names), dict(zip(names.tolist(), likely["others"].to_pylist(), strict=True)), dict(zip(names.tolist(), likely["kind"].to_pylist(), strict=True))))

    def holders(batch: pa.RecordBatch) -> Iterator[dict]:
        for data, doc, _, begin, end, row, _ in _tokens_of(batch):
            for h in _forms(data, begin, end):
                hit = np.isin(h, wanted.value[0])
                h, r, first = _distinct(h[hit], row[hit])
                if len(first):
                    yield {"form": h[first].view(np.int64), "docs": lists(doc[r], np.append(first, len(h)))}

    def covered(table: pa.Table) -> pa.Table:
        documents_of: dict[int, set[int]] = {}
        for f, d in zip(table["form"].to_numpy().view(np.uint64).tolist(), table["docs"].to_pylist(), strict=True):
            documents_of.setdefault(f, set()).update(d)
        return pa.table({"form": pa.array(cover(documents_of, *wanted.value[1:], least, share).view(np.int64))})

    held = arrow_map(texts.where("toxic"), holders, "form long, docs array<long>")
    found = shared(np.sort(held.groupBy(F.lit(1).alias("one")).applyInArrow(covered, "form long").toArrow()["form"].to_numpy().view(np.uint64)))

    def chains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: pa.Table | None = None
        for batch in batches:
            for more in _chains(batch, found.value):
                best = _least_keys(more if best is None else pa.concat_tables([best, more]))
        if best is not None:
            yield from best.to_batches()

    every = cut(texts.mapInArrow(chains, "has boolean, key long, body binary, label binary"))  # 2 * CHAINS rows a task at most
    picked = _first_of_each(every, "has", (False, True), [F.col("key"), F.col("body")], CHAINS)

    def fitted(table: pa.Table) -> pa.Table:
        rows = sorted(zip(*(table[c].to_pylist() for c in ("key", "body", "label")), strict=True))
        return pa.table({"model": pa.array([pickle.dumps(fit([r[1] for r in rows], [r[2] for r in rows]))], pa.binary())})

    # One task fits on the chosen chains; the driver gets the weights only.
    models = picked.select("key", "body", "label").groupBy(F.lit(1).alias("one")).applyInArrow(fitted, "model binary").collect()
    if not models:
        return constant(n_toxic / (n_toxic + n_clean))
    field = pickle.loads(models[0]["model"])
    fixed = shared(field)

    def masses(batch: pa.RecordBatch) -> Iterator[dict]:
        for _, doc, toxic, _, _, row, features in _tokens_of(batch):
            p = fixed.value.marginals(fixed.value.odds(features), np.searchsorted(row, np.arange(len(doc) + 1)))
            yield {"mass": np.log1p(np.bincount(row, np.where(p >= 0.1, p, 0), len(doc))), "toxic": toxic}

    def scaled(table: pa.Table) -> pa.Table:
        mass, toxic = table["mass"].to_numpy(), table["toxic"].to_numpy()
        order = np.lexsort((toxic, mass))
        a, b = calibrated(mass[order], toxic[order])
        return pa.table({"a": [a], "b": [b]})

    scale = arrow_map(texts, masses, "mass double, toxic boolean").groupBy(F.lit(1).alias("one")).applyInArrow(scaled, "a double, b double").collect()[0]
    return Field(field.weights, field.steps, (scale["a"], scale["b"]))


def score(docs: DataFrame, field: Field) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted, and the offending spans (code points, with their probability).

    A null or empty text has the score of a text without toxic tokens and no spans. Repeated rows are scored alike; rows
    without doc_id are scored and count as held out. An empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        f = shared.value
        data, off = utf8(batch.column(1))
        for i, j in slices(off, 2 << 20):
            part, base = data[off[i] : off[j]], off[i : j + 1] - off[i]
            begin, end, row, features = token_features(part, base)
            p = f.marginals(f.odds(features), np.searchsorted(row, np.arange(j - i + 1)))
            hot = np.flatnonzero(p >= 0.5)
            spans: list[list[dict]] = [[] for _ in range(j - i)]
            if len(hot):
                points = np.concatenate([[0], np.cumsum((part & 0xC0) != 0x80)])
                runs = np.flatnonzero((np.diff(hot) > 1) | (row[hot[1:]] != row[hot[:-1]]))
                for a, b in zip(hot[np.concatenate([[0], runs + 1])], hot[np.concatenate([runs, [len(hot) - 1]])], strict=True):
                    r, origin = row[a], points[base[row[a]]]
                    spans[r].append({"start": int(points[begin[a]] - origin), "end": int(points[end[b]] - origin), "p": float(p[a : b + 1].max())})
            yield {"doc_id": batch.column(0).slice(i, j - i), "score": f.score(p, row, j - i), "spans": spans}

    out = arrow_map(docs.select("doc_id", "text"), run, "doc_id long, score double, spans array<struct<start: long, end: long, p: double>>")
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "spans")


def accepted(docs: DataFrame, field: Field) -> DataFrame:
    """The rows of `docs`, with all their columns, whose text is not predicted toxic."""
    shared = docs.sparkSession.sparkContext.broadcast(field)
    schema = docs.schema
    place = docs.columns.index("text")
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = shared.value
        for batch in batches:
            data, off = utf8(batch.column(place))
            for i, j in slices(off, 2 << 20):
                part, base = data[off[i] : off[j]], off[i : j + 1] - off[i]
                _, _, row, features = token_features(part, base)
                p = f.marginals(f.odds(features), np.searchsorted(row, np.arange(j - i + 1)))
                yield batch.slice(i, j - i).filter(pa.array(f.score(p, row, j - i) < 0.5))

    return docs.mapInArrow(run, schema)
