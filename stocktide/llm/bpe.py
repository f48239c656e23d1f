"""Byte-level BPE over whole texts: an exact linear-time encoder by backtracking, and a decoder by offset table.

The vocabulary file is a parameter. The driver reads it once and broadcasts its content (its size is the vocabulary's,
whatever the input). Tokens never cross certain spaces, so texts are cut there and each distinct piece is encoded once
per task; the cache of pieces is bounded in bytes and only saves time.
"""

from __future__ import annotations

import hashlib
import json
import struct
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from stocktide.llm.common import arrow_map, slices, utf8

#: Fixed values of the vocabulary's pre-tokenizer: white space, and the words it makes.
_WHITE = r"\t-\r \x85\xa0  -     　"
_WORDS = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_WHITE}\p{{L}}\p{{N}}]+|[{_WHITE}]+(?![^{_WHITE}])|[{_WHITE}]+"
#: Bytes of pieces and their ids, with overhead, that one task remembers before it starts anew; longer pieces aren't remembered.
CACHE_BYTES, REMEMBERED, OVERHEAD = 64 << 20, 1024, 220

_LOADED: dict[bytes, object] = {}


def public_vocabulary() -> str:
    """Path of the default vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def broadcast_vocabulary(spark: SparkSession, path: str):
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def byte_characters() -> dict[str, int]:
    """The printable character that stands for each byte in a vocabulary: printable Latin-1 ones stand for themselves, the others follow from 256 on."""
    own = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    other = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(other)}


class Vocabulary:
    """Tables of one vocabulary: bytes of each token, merges, halves of each token, next shorter prefix, automaton."""

    def __init__(self, raw: bytes):
        spec = json.loads(raw)
        to_byte = byte_characters()
        plain = {token: bytes(to_byte[c] for c in token).decode("latin-1") for token in spec["model"]["vocab"]}
        self.ids = {plain[token]: i for token, i in spec["model"]["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*self.ids.values(), *self.special.values()]) + 1
        texts = [b""] * size
        for token, i in self.ids.items():
            texts[i] = token.encode("latin-1")
        for token, i in self.special.items():
            texts[i] = token.encode()
        self.text = texts
        # Offset table for decoding.
        self.offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        self.bytes = np.frombuffer(b"".join(texts), np.uint8)
        self.rank: dict[tuple[int, int], int] = {}
        self.made: dict[tuple[int, int], int] = {}
        self.halves: dict[int, tuple[int, int, int]] = {}
        for r, merge in enumerate(spec["model"]["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            pair, whole = (self.ids[plain[left]], self.ids[plain[right]]), self.ids[plain[left] + plain[right]]
            self.rank.setdefault(pair, r)
            self.made.setdefault(pair, whole)
            self.halves.setdefault(whole, (*pair, r))
        self.automaton = ahocorasick.Automaton()
        for token in self.ids:
            self.automaton.add_word(token, self.ids[token])
        self.automaton.make_automaton()
        self.shorter = {}
        for token, i in self.ids.items():
            for n in range(len(token) - 1, 0, -1):
                if (j := self.ids.get(token[:n])) is not None:
                    self.shorter[i] = j
                    break
        self.fits: dict[tuple[int, int], bool] = {}
        self.sizes = [len(t) for t in texts]
        self.split = regex.compile(_WORDS).findall
        self.words: dict[str, bytes] = {}
        self.held = 0
        self.pack = [struct.Struct(f"<{n}I").pack for n in range(24)]

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging the bytes of left and right, in order of rank, gives exactly these two tokens.

        It does unless some merge across their border would come first. Going from the last merge of either token to its
        first, every pair of parts that meets at the border is looked at: its merge, if there is one, must come later
        than the one that next changes the border. Ties go to the left, as merging does.
        """
        pair = (left, right)
        if (known := self.fits.get(pair)) is not None:
            return known
        a, b, until = left, right, (1 << 60)
        while True:
            r = self.rank.get((a, b))
            if r is not None and 2 * r < until:
                ok = False
                break
            x, y = self.halves.get(a), self.halves.get(b)
            if x is None and y is None:
                ok = True
                break
            # Undo the later of the two last merges. One of the same rank on the left of the border is done first.
            if y is None or (x is not None and x[2] > y[2]):
                a, until = x[1], 2 * x[2]
            else:
                b, until = y[0], 2 * y[2] + 1
        if len(self.fits) > 2_000_000:
            self.fits.clear()
        self.fits[pair] = ok
        return ok

    def encode_word(self, word: str) -> list[int]:
        """Tokens of one pre-token, given as Latin-1 text of its bytes."""
        n, fits, sizes, compatible = len(word), self.fits, self.sizes, self.compatible
        longest = [0] * (n + 1)
        for end, token in self.automaton.iter(word):  # of the matches that end at one place the longest comes first
            start = end + 1 - sizes[token]
            longest[start] = token + 1  # a later end is a longer match
        out: list[int] = []
        at, dead = 0, None  # dead: places from which the rest can't be encoded, made when the first is found
        token = longest[0] - 1
        while at < n:
            end = at + sizes[token]
            if dead is None or not dead[end]:
                if not out:
                    ok = True
                elif (ok := fits.get((out[-1], token))) is None:
                    ok = compatible(out[-1], token)
                if ok:
                    out.append(token)
                    at = end
                    token = longest[at] - 1
                    continue
            token = self.shorter.get(token, -1)
            while token < 0:  # go back one token and try a shorter one there
                if dead is None:
                    dead = bytearray(n + 1)
                dead[at] = 1
                token = out.pop()
                at -= sizes[token]
                token = self.shorter.get(token, -1)
        return out

    def encode_piece(self, piece: str) -> bytes:
        if piece.isascii() and piece[1:].isalpha() and piece[0] == " ":
            return self._word(piece)  # the common case: a space and letters are one word
        return b"".join(map(self._word, self.split(piece)))

    def _word(self, word: str) -> bytes:
        got = self.words.get(word)
        if got is None:
            ids = self.encode_word(word if word.isascii() else word.encode("utf-8", "surrogatepass").decode("latin-1"))
            got = self.pack[len(ids)](*ids) if len(ids) < len(self.pack) else np.array(ids, "<u4").tobytes()
            if len(word) <= REMEMBERED:
                self.words[word] = got
                self.held += OVERHEAD + len(word) + len(got)
        return got

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        if self.held > CACHE_BYTES:
            self.words, self.held = {}, 0
        return [self.encode_piece(p) for p in pieces]

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of the tokens: their places in the byte table are gathered at once."""
        begin, size = self.offsets[ids], self.offsets[ids + 1] - self.offsets[ids]
        shift = np.repeat(begin - np.concatenate([[0], np.cumsum(size)[:-1]]), size) if len(ids) else begin
        return self.bytes[np.arange(len(shift)) + shift].tobytes()


def loaded(raw: bytes, make: Callable[[bytes], object]) -> object:
    """Tables of a vocabulary, built once per worker."""
    key = hashlib.sha256(raw).digest() + make.__name__.encode()
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = make(raw)
    return _LOADED[key]


class Pieces:
    """Encodes texts by distinct pieces. A piece is a space and what follows up to the next space.

    That is exact where the characters around the cut aren't white space. Where they are, the rest of the text between
    special tokens is encoded as one piece.
    """

    def __init__(self, encode: Callable[[list[str]], list[bytes]], special: dict[str, int], encode_spaced: Callable[[list[str]], list[bytes]] | None = None):
        """`encode_spaced` encodes pieces that start with their only space and have no white space around it."""
        self.encode, self.special = encode, special
        self.encode_spaced = encode_spaced or encode
        self.split = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, bytes | None] = {}
        self.held = 0

    def _segments(self, texts: list[str]) -> list[list[str]]:
        return [[t] if self.split is None or not any(s in t for s in self.special) else self.split.split(t) for t in texts]

    def encode_texts(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        if self.held > CACHE_BYTES:
            self.forget()
        known, parts = self.known, self._segments(texts)
        cut = [[s.split(" ") for s in segments] for segments in parts]
        seen: set[str] = set().union(*(pieces for segments in cut for pieces in segments))
        new = [p for p in seen if p not in known]
        inner = [p for p in new if p and not p[0].isspace() and not p[-1].isspace()]
        known.update(dict.fromkeys(new))
        known.update(zip(inner, self.encode_spaced([" " + p for p in inner]), strict=True))
        heads = {pieces[0] for segments in cut for pieces in segments if known[pieces[0]] is not None}
        head = dict(zip(heads, self.encode(list(heads)), strict=True))
        out = []
        for text, segments, pieces in zip(texts, parts, cut, strict=True):
            found = []
            for segment, own in zip(segments, pieces, strict=True):
                got = list(map(known.__getitem__, own))
                if None in got:
                    found.append(self.encode([segment])[0] if segment else b"")
                else:
                    got[0] = head[own[0]]
                    found.append(b"".join(got))
            if len(found) == 1:
                out.append(found[0])
            else:
                marks = [self.special[m] for m in self.split.findall(text)]
                out.append(found[0] + b"".join(np.array([m], "<u4").tobytes() + f for m, f in zip(marks, found[1:], strict=True)))
        for p in new:
            if len(p) > REMEMBERED:
                del known[p]
            else:
                self.held += OVERHEAD + len(p) + len(known[p] or b"")
        return out


def batches_of(texts: pa.Array, limit: int = 1 << 21) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of about `limit` bytes; a null text is empty."""
    for i, j in slices(utf8(texts)[1], limit):
        yield i, [t or "" for t in texts.slice(i, j - i).to_pylist()]


def bpe_ids(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """(doc_id, ids array<int>) of every row's whole text. A null or empty text has no ids; repeated rows stay rows."""
    shared = broadcast_vocabulary(docs.sparkSession, vocabulary or public_vocabulary())

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        v = loaded(shared.value, Vocabulary)
        pieces = loaded_pieces(v)
        for first, texts in batches_of(batch.column(1)):
            got = pieces.encode_texts(texts)
            flat = np.frombuffer(b"".join(got), "<u4").astype(np.int32)
            yield {"doc_id": batch.column(0).slice(first, len(texts)), "ids": pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum([len(g) // 4 for g in got])]).astype(np.int32)), pa.array(flat))}

    return arrow_map(docs.select("doc_id", "text"), run, "doc_id long, ids array<int>")


def bpe_texts(encoded: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """(doc_id, text) of (doc_id, ids). Bytes that are no UTF-8 become the replacement character; null ids give ''."""
    shared = broadcast_vocabulary(encoded.sparkSession, vocabulary or public_vocabulary())

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        v = loaded(shared.value, Vocabulary)
        yield {"doc_id": batch.column(0), "text": [v.decode(np.array(i or [], np.int64)).decode("utf-8", "replace") for i in batch.column(1).to_pylist()]}

    return arrow_map(encoded.select("doc_id", "ids"), run, "doc_id long, text string")


def loaded_pieces(v: Vocabulary) -> Pieces:
    if "pieces" not in v.__dict__:
        v.pieces = Pieces(v.encode_pieces, v.special)
    return v.pieces


def round_trip(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Per row: doc_id, n_tokens, SHA-256 of the ids as little-endian unsigned 32-bit integers and of the decoded text.

    Encodes and decodes in one pass, so that ids don't travel. Null texts are empty; rows without doc_id, repeated rows
    and empty tables are treated like any others.
    """
    shared = broadcast_vocabulary(docs.sparkSession, vocabulary or public_vocabulary())

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        v = loaded(shared.value, Vocabulary)
        pieces = loaded_pieces(v)
        for first, texts in batches_of(batch.column(1)):
            got = pieces.encode_texts(texts)
            raw = [v.decode(np.frombuffer(g, "<u4").astype(np.int64)) for g in got]
            yield {
                "doc_id": batch.column(0).slice(first, len(texts)),
                "n_tokens": [len(g) // 4 for g in got],
                "ids_sha256": [hashlib.sha256(g).hexdigest() for g in got],
                "decoded_sha256": [hashlib.sha256(x.decode("utf-8", "replace").encode()).hexdigest() for x in raw],
            }

    return arrow_map(docs.select("doc_id", "text"), run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
