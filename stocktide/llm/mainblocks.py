"""Main text of web pages by a recurrent block labeller.

A page becomes its sequence of leaf blocks (text between block-level tags, without scripts, styles and comments). Each
block is a vector: hashed elements and class names of its tag path, hashed words, and a few numbers. A bidirectional
LSTM in numpy reads the whole sequence, so that every block is classified with document-wide context; the blocks it
keeps are the main text.

The model is trained here, on a bounded sample of pages (PAGES, the first by a hash of url and page_id) and on pages built from
their blocks under many templates (menus, notices, forms, side bars, comments). Labels come from semantic markup: a
block inside article or main and outside of anything marked as navigation, advert, form or comment. In training the
article mark is hidden now and then, so that words, numbers and neighbours count too.
"""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocktide.llm.common import arrow_map

#: Pages of the training sample, bytes of html that one of them may have, and blocks of a page that training reads.
PAGES, PAGE_BYTES, TRAIN_BLOCKS = 400, 200_000, 200
PATH_BUCKETS, WORD_BUCKETS, PATH_DIM, WORD_DIM, HIDDEN = 4096, 8192, 20, 12, 20

# Fixed values of HTML: elements without content, inline elements, elements whose content isn't text of the page.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
RAW = "script|style|noscript|template|svg|iframe"

_TAG = re.compile(rf"<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})(?=[\s/>])[^>]*>.*?(?:</(?P=raw)\s*>|\Z)|<!\w[^>]*>|<\?[^>]*>|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<rest2>[^>]*)>", re.S | re.I)
_MARKS = re.compile(r"\b(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
#: What marks boilerplate for the labels of training pages: elements, and parts of class names.
_OUTSIDE = set("nav header footer aside form menu button select textarea head title".split())
_OUTSIDE_MARK = re.compile(r"(?:^|[-_])(?:ads?|advert\w*|banner|promo\w*|sponsor\w*|nav\w*|menu|header|footer|sidebar|side|widget|related|share|social|comments?|respond|reply|cookie\w*|consent|notice|alert|popup|modal|newsletter|subscribe|breadcrumbs?|meta|tags?)(?:$|[-_])", re.I)
_INSIDE = ("article", "main", "articlebody", "role-main")


def tags(page: str) -> Iterator[re.Match]:
    """Tags, comments and raw elements in order, in one forward pass: behind the last '>' nothing but a comment can begin."""
    last, at = page.rfind(">"), page.find("<")
    while 0 <= at <= last:
        m = _TAG.match(page, at)
        if m:
            yield m
        at = page.find("<", m.end() if m else at + 1)
    if at >= 0 and (at := page.find("<!--", at)) >= 0:
        yield _TAG.match(page, at)


class Open:
    """The open elements: names and marks in order, how often each is open, and the innermost that isn't inline."""

    def __init__(self):
        self.names: list[str] = []
        self.described: list[str] = []
        self.block: list[int] = []  # for each element, the place of the innermost block element up to it, or -1
        self.times: dict[str, int] = {}
        self.marks: dict[str, int] = {}
        self.path: tuple[str, ...] | None = None

    def push(self, name: str, described: str) -> None:
        above = self.block[-1] if self.block else -1
        self.block.append(above if name in INLINE else len(self.names))
        self.names.append(name)
        self.described.append(described)
        self.times[name] = self.times.get(name, 0) + 1
        self.marks[described] = self.marks.get(described, 0) + 1
        self.path = None

    def pop(self) -> str:
        name, described = self.names.pop(), self.described.pop()
        self.block.pop()
        self.times[name] -= 1
        self.marks[described] -= 1
        if not self.marks[described]:
            del self.marks[described]
        self.path = None
        return name

    def end(self, name: str) -> None:
        """Close the innermost element of this name and all inside it; an end tag of nothing open is nothing."""
        if self.times.get(name):
            while self.pop() != name:
                pass

    def begin_block(self, name: str) -> None:
        """A block element ends an open paragraph; an item ends the item before it."""
        at = self.block[-1] if self.block else -1
        if at >= 0 and (self.names[at] == "p" or (self.names[at] == name and name in ("li", "dt", "dd", "option", "tr", "td", "th"))):
            while len(self.names) > at:
                self.pop()

    def described_path(self) -> tuple[str, ...]:
        """Every different open element once, then the innermost."""
        if self.path is None:
            self.path = (*self.marks, *self.described[-1:])
        return self.path


def blocks(page: str | None) -> list[tuple[tuple[str, ...], str, int]]:
    """(path, text, characters inside links) of the leaf blocks of a page, in order, without empty ones.

    A path names every different open element once, however deep, and the innermost last.
    """
    out: list[tuple[tuple[str, ...], str, int]] = []
    stack = Open()
    text: list[str] = []
    linked = at = 0
    page = page or ""

    def flush() -> None:
        nonlocal text, linked
        if text:
            words = " ".join(html.unescape("".join(text)).split())
            if words:
                out.append((stack.described_path(), words, linked))
        text, linked = [], 0

    def say(piece: str) -> None:
        nonlocal linked
        if piece:
            text.append(piece)
            if "a" in stack.names[-3:]:
                linked += len(piece)

    for m in tags(page):
        say(page[at : m.start()])
        at = m.end()
        name = (m["name"] or m["name2"] or "").lower()
        if not name:
            continue
        inline = name in INLINE
        if not inline:
            if name == "br":
                text.append("\n")
                continue
            flush()
        if m["end"] or m["end2"]:
            stack.end(name)
            continue
        if name in VOID:
            continue
        if not inline:
            stack.begin_block(name)
        if not (m["rest"] or m["rest2"] or "").endswith("/"):
            marks = " ".join("".join(x) for x in _MARKS.findall(m["rest"] or m["rest2"] or ""))
            stack.push(name, f"{name} {marks}".strip().lower())
    say(page[at:])
    flush()
    return out


def semantic_label(path: tuple[str, ...]) -> float | None:
    """1 inside an article and outside of boilerplate, 0 elsewhere; None where the page has no such marks (see `train`)."""
    parts = [p.split(" ") for p in path]
    if any(p[0] in _OUTSIDE or any(_OUTSIDE_MARK.search(c) for c in p[1:]) for p in parts):
        return 0.0
    return 1.0 if any(set(p) & set(_INSIDE) for p in parts) else 0.0


def _bucket(text: str, size: int) -> int:
    return zlib.crc32(text.encode("utf-8", "surrogatepass")) % size


def featurise(page: list[tuple[tuple[str, ...], str, int]], hide: frozenset[str] = frozenset()) -> tuple[list[list[int]], list[list[int]], np.ndarray]:
    """Path buckets, word buckets and numbers of each block."""
    paths, words, numbers = [], [], np.zeros((len(page), 6), np.float32)
    for i, (path, text, linked) in enumerate(page):
        marks = {m for p in path for m in p.split(" ")} - hide
        leaf = path[-1].split(" ")[0] if path else ""
        paths.append([_bucket(m, PATH_BUCKETS) for m in sorted(marks)] + [_bucket("leaf " + leaf, PATH_BUCKETS)])
        own = text.lower().split()
        words.append([_bucket(w, WORD_BUCKETS) for w in sorted(set(own))])
        numbers[i] = (np.log1p(len(own)) / 5, linked / max(1, len(text)), text.count(".") / max(1, len(own)), i / max(1, len(page)), float(text[-1] in ".!?…。"), np.log1p(len(page)) / 5)
    return paths, words, numbers


class Labeller:
    """Embeddings, two LSTMs and an output layer; forward and backward passes over padded batches."""

    def __init__(self, rng: np.random.Generator):
        width, h = PATH_DIM + WORD_DIM + 6, HIDDEN
        self.p = {"path": rng.normal(0, 0.1, (PATH_BUCKETS, PATH_DIM)), "word": rng.normal(0, 0.1, (WORD_BUCKETS, WORD_DIM)), "out": rng.normal(0, 0.2, 2 * h), "bias": np.zeros(1)}
        for d in "fb":
            bias = np.zeros(4 * h)
            bias[h : 2 * h] = 1  # remember at first
            self.p |= {f"x{d}": rng.normal(0, width**-0.5, (width, 4 * h)), f"h{d}": rng.normal(0, h**-0.5, (h, 4 * h)), f"b{d}": bias}
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def embed(self, pages: list) -> tuple[np.ndarray, np.ndarray, list]:
        size = np.array([len(n) for *_, n in pages])
        x, mask = np.zeros((len(pages), size.max(initial=0), PATH_DIM + WORD_DIM + 6), np.float32), np.arange(size.max(initial=0)) < size[:, None]
        index = []
        for name, k, lo in (("path", 0, 0), ("word", 1, PATH_DIM)):
            lists = [b for page in pages for b in page[k]]
            n = np.array([len(b) for b in lists], np.int64)
            flat = np.fromiter((v for b in lists for v in b), np.int64, int(n.sum()))
            row = np.repeat(np.arange(len(lists)), n)
            scale = 1 / np.maximum(1, n).astype(np.float32)
            vectors = np.zeros((len(lists), self.p[name].shape[1]), np.float32)
            for d in range(vectors.shape[1]):
                vectors[:, d] = np.bincount(row, self.p[name][flat, d], len(lists)) * scale
            x[..., lo : lo + vectors.shape[1]][mask] = vectors
            index.append((name, lo, flat, row, scale))
        x[..., -6:][mask] = np.concatenate([n for *_, n in pages]) if len(pages) else 0
        return x, mask, index

    def run(self, x: np.ndarray, mask: np.ndarray, d: str) -> tuple[np.ndarray, list]:
        h, n = HIDDEN, x.shape[1]
        hidden, cell = np.zeros((len(x), h), np.float32), np.zeros((len(x), h), np.float32)
        out, kept = np.zeros((len(x), n, h), np.float32), []
        pre = x @ self.p[f"x{d}"] + self.p[f"b{d}"]
        for t in range(n) if d == "f" else range(n - 1, -1, -1):
            z = pre[:, t] + hidden @ self.p[f"h{d}"]
            gates = 1 / (1 + np.exp(-np.clip(z[:, : 3 * h], -30, 30)))
            i, f, o, g = gates[:, :h], gates[:, h : 2 * h], gates[:, 2 * h :], np.tanh(z[:, 3 * h :])
            new = f * cell + i * g
            m = mask[:, t, None]
            kept.append((t, hidden, cell, i, f, o, g, new, m))
            cell, hidden = np.where(m, new, cell), np.where(m, o * np.tanh(new), hidden)
            out[:, t] = hidden
        return out, kept

    def forward(self, x: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, dict]:
        both, kept = [], {}
        for d in "fb":
            out, kept[d] = self.run(x, mask, d)
            both.append(out)
        both = np.concatenate(both, axis=2)
        return 1 / (1 + np.exp(-np.clip(both @ self.p["out"] + self.p["bias"], -30, 30))), both, kept

    def gradient(self, pages: list, labels: list[np.ndarray]) -> tuple[float, dict]:
        x, mask, index = self.embed(pages)
        prob, both, kept = self.forward(x, mask)
        y = np.zeros(mask.shape, np.float32)
        y[mask] = np.concatenate(labels)
        total = mask.sum()
        gap = np.where(mask, prob - y, 0) / total
        grad = {"out": np.einsum("bt,bth->h", gap, both), "bias": gap.sum(keepdims=True).ravel()[:1] * 0 + gap.sum()}
        back, dx, h = gap[..., None] * self.p["out"], np.zeros_like(x), HIDDEN
        for d, part in (("f", back[..., :h]), ("b", back[..., h:])):
            gx, gh, gb = np.zeros_like(self.p[f"x{d}"]), np.zeros_like(self.p[f"h{d}"]), np.zeros_like(self.p[f"b{d}"])
            dh, dc = np.zeros((len(x), h), np.float32), np.zeros((len(x), h), np.float32)
            for t, before, cell, i, f, o, g, new, m in reversed(kept[d]):
                dh = dh + part[:, t]
                tan = np.tanh(new)
                inner = np.where(m, dc + dh * o * (1 - tan * tan), 0)
                dz = np.concatenate([inner * g * i * (1 - i), inner * cell * f * (1 - f), np.where(m, dh * tan * o * (1 - o), 0), inner * i * (1 - g * g)], axis=1)
                gx += x[:, t].T @ dz
                gh += before.T @ dz
                gb += dz.sum(axis=0)
                dx[:, t] += dz @ self.p[f"x{d}"].T
                dh, dc = np.where(m, dz @ self.p[f"h{d}"].T, dh), np.where(m, inner * f, dc)
            grad |= {f"x{d}": gx, f"h{d}": gh, f"b{d}": gb}
        for name, lo, flat, row, scale in index:
            table = np.zeros_like(self.p[name])
            vectors = dx[..., lo : lo + table.shape[1]][mask]
            for k in range(table.shape[1]):
                table[:, k] = np.bincount(flat, vectors[row, k] * scale[row], len(table))
            grad[name] = table
        p = np.clip(prob[mask], 1e-7, 1 - 1e-7)
        return float(-(y[mask] * np.log(p) + (1 - y[mask]) * np.log(1 - p)).mean()), grad

    def keep(self, pages: list) -> list[np.ndarray]:
        """For each featurised page which blocks are main text; pages of like length share a batch."""
        size = np.array([len(n) for *_, n in pages], np.int64)
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        order = [int(i) for i in np.argsort(size, kind="stable") if size[i]]
        while order:
            n = max(1, min(len(order), 20_000 // int(size[order[-1]])))
            part, order = order[-n:], order[:-n]
            x, mask, _ = self.embed([pages[i] for i in part])
            prob = self.forward(x, mask)[0]
            for k, i in enumerate(part):
                out[i] = prob[k, : size[i]] >= 0.5
        return out


# ---- training -----------------------------------------------------------------------------------------------------------

#: Built pages: elements around boilerplate, and around the article.
_AROUND = ("nav", "header", "footer", "aside", "form", "div class=sidebar", "div class=ad", "div class=advert", "div class=cookie-notice", "div class=comments", "section class=comments", "div id=comments", "div class=menu", "ul class=menu", "div class=banner", "div class=related", "div class=newsletter", "div class=notice", "section id=comments", "ol class=comment-list", "div class=footer", "div class=header", "div id=nav", "div role=navigation")
_BODY = ("article", "main", "div class=content", "div id=content", "div class=post", "div class=article-body", "div class=entry-content", "section class=story", "div", "body")


def built_page(rng: np.random.Generator, good: list[str], bad: list[str]) -> tuple[list, np.ndarray]:
    """A page of known blocks under a drawn template."""
    page: list[tuple[tuple[str, ...], str, int]] = []
    label: list[float] = []
    root = ("html", "body")

    def any_of(values: list[str] | tuple[str, ...]) -> str:
        return values[rng.integers(len(values))]

    def outside(element: str, n: int) -> None:
        for _ in range(n):
            leaf = any_of(("li", "p", "span", "div", "label", "h3"))
            text = " ".join(any_of(bad).split()[: rng.integers(1, 30)]) if rng.random() < 0.7 else any_of(good)
            page.append(((*root, element.replace("class=", "").replace("id=", "").replace("role=", ""), leaf), text, len(text) if leaf == "li" and rng.random() < 0.8 else 0))
            label.append(0.0)

    def within(element: str, n: int) -> None:
        first = len(page)
        outside(element, n)
        deep = ("div",) if rng.random() < 0.5 else ()
        page[first:] = [((*inside, path[2], *deep, *path[3:]), text, linked) for path, text, linked in page[first:]]

    for e in rng.choice(_AROUND, rng.integers(1, 4), replace=False):
        outside(str(e), int(rng.integers(1, 8)))
    body = any_of(_BODY).replace("class=", "").replace("id=", "")
    inside = root if body == "body" else (*root, body) if rng.random() < 0.6 else (*root, "div wrapper", body)
    for k in range(int(rng.integers(1, 12))):
        leaf = "h1" if k == 0 and rng.random() < 0.7 else any_of(("p", "p", "p", "p", "h2", "li", "blockquote", "td", "pre"))
        page.append(((*inside, leaf), any_of(good), 0))
        label.append(1.0)
        if rng.random() < 0.08:
            within(any_of(("div ad", "aside", "form", "div related")), 1)
    if rng.random() < 0.35:  # reader comments at the end of the article
        within(any_of(("section comments", "div comments", "ol comments", "div comment", "section comment-list", "div replies", "section responses")), int(rng.integers(1, 5)))
    for e in rng.choice(_AROUND, rng.integers(1, 4), replace=False):
        outside(str(e), int(rng.integers(1, 8)))
    return page, np.array(label, np.float32)


def fit(pages: list[str], epochs: int = 6, seed: int = 11) -> Labeller:
    """A labeller from pages with semantic marks; pages without an article only lend their blocks."""
    rng = np.random.default_rng(seed)
    real = []
    for page in pages:
        found = blocks(page)[:TRAIN_BLOCKS]
        label = np.array([semantic_label(path) for path, *_ in found], np.float32)
        if label.any():
            real.append((found, label))
    good = [t for page, label in real for (_, t, _), y in zip(page, label, strict=True) if y] or ["The text of an article."]
    bad = [t for page, label in real for (_, t, _), y in zip(page, label, strict=True) if not y] or ["Menu"]
    good, bad = [str(g) for g in good[:4000]], [str(b) for b in bad[:4000]]
    model = Labeller(rng)
    first, second = ({k: np.zeros_like(v) for k, v in model.p.items()} for _ in range(2))
    step = 0
    hidden = frozenset({"article", "main"})
    for epoch in range(epochs):
        made = [built_page(rng, good, bad) for _ in range(max(200, len(real)))]
        items = [(featurise(page, hidden if rng.random() < 0.15 else frozenset()), label) for page, label in [*real, *made]]
        items.sort(key=lambda x: len(x[1]))
        starts = np.arange(0, len(items), 24)
        rng.shuffle(starts)
        for s in starts:
            part = items[s : s + 24]
            _, grad = model.gradient([f for f, _ in part], [y for _, y in part])
            step += 1
            rate = 0.02 * (1 - epoch / epochs) + 0.002
            for k, g in grad.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                model.p[k] = (model.p[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
    return model


def train(pages: DataFrame, sample: int = PAGES) -> Labeller:
    """Fit on `sample` pages at most, the first by a hash of url and page_id, of PAGE_BYTES at most each; these alone reach
    the driver."""
    keyed = pages.select("html", F.xxhash64("url", "page_id").alias("h"), F.octet_length("html").alias("n")).where(f"n > 0 and n < {PAGE_BYTES}")
    first = [r["h"] for r in keyed.select("h").orderBy("h").limit(sample).collect()]
    if not first:
        return fit([])
    # Whole pages leave the tasks only where they are wanted, and one of each url and page_id.
    rows = keyed.where(F.col("h") <= first[-1]).groupBy("h").agg(F.min(F.struct("n", "html")).alias("page")).collect()
    return fit([r["page"]["html"] for r in sorted(rows, key=lambda r: r["h"])])


def main_text(pages: DataFrame, model: Labeller) -> DataFrame:
    """Per row: page_id, url, text and n_chars (code points), n_blocks and n_kept.

    Character references are decoded, white space inside a block is one space, blocks are joined by one space. A null
    or empty page, and one without blocks, has the empty text. Repeated rows read alike; null ids and urls are kept. An
    empty table gives no rows.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        labeller = shared.value
        for i in range(0, batch.num_rows, 256):
            part = batch.slice(i, 256)
            found = [blocks(page) for page in part.column(2).to_pylist()]
            kept = labeller.keep([featurise(f) for f in found])
            texts = [" ".join(t for (_, t, _), k in zip(f, keep, strict=True) if k) for f, keep in zip(found, kept, strict=True)]
            yield {"page_id": part.column(0), "url": part.column(1), "text": texts, "n_chars": [len(t) for t in texts], "n_blocks": [len(f) for f in found], "n_kept": [int(k.sum()) for k in kept]}

    return arrow_map(pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html"), run, "page_id long, url string, text string, n_chars long, n_blocks long, n_kept long")
