"""Cross-tokenizer alignment against whole-text encodings and plain set intersections of byte ends."""

import hashlib
import random
from collections import Counter, defaultdict
from itertools import accumulate

import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def brute_alignment(rows):
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    from stocktide.llm.bpe import byte_characters

    left = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    left.encode_special_tokens = True
    right = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    to_byte, counts, found = byte_characters(), Counter(), []
    for doc_id, text in rows:
        raw = (" " + (text or "")).encode()
        a = left.encode(" " + text, add_special_tokens=False).ids if text else []
        b = right.encode(text) if text else []
        a_bytes = [bytes(to_byte[c] for c in left.id_to_token(i)) for i in a]
        b_bytes = [bytes([int(right.id_to_piece(i)[3:5], 16)]) if right.is_byte(i) else right.id_to_piece(i).replace("\u2581", " ").encode() for i in b]
        if not text or b"".join(a_bytes) != raw or b"".join(b_bytes) != raw:
            found.append((doc_id, 0, 0, [], ""))
            continue
        at = {end: k + 1 for k, end in enumerate(accumulate(map(len, a_bytes)))}
        groups, links, i, j = [], [], 0, 0
        for k, end in enumerate(accumulate(map(len, b_bytes)), 1):
            if end in at:
                groups.append(",".join(map(str, a[i : at[end]])) + "|" + ",".join(map(str, b[j:k])))
                i, j = at[end], k
                links.append((a[i - 1], b[j - 1]))
        counts.update(links)
        found.append((doc_id, len(a), len(b), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    best = defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return Counter((i, n_a, n_b, len(links), len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links), h) for i, n_a, n_b, links, h in found)


def rows_of(frame):
    return Counter(tuple(r[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")) for r in frame.collect())


@pytest.mark.parametrize("frequent", [1 << 20, 200])
def test_links_of_given_and_odd_texts(spark, frequent):
    """All texts and odd ones; with few frequent pairs most links meet their counts in the exchange."""
    from stocktide.llm.crossalign import aligned_links

    odd = [None, "", " ", "  ", " a", "a ", "a  b", "\n", "a \n b", "x\u2581y", "<s> </s> <unk> <0x41> <|endoftext|>", "\u00a0 \u2003a\u0085 b", "\x00\x1f \x1c", "caf\u00e9 \u4f60\u597d \U0001f600", "don't 12345 --- ...", "word " * 4000, "z" * 9000, "tab\t\tx  y\r\n\r\nz", "\ufeffbom \ufb01 \u212b"]
    draw = random.Random(4)
    odd += ["".join(draw.choice("ab \n\t.1\u00e9\u2581\u3000'sS") for _ in range(draw.randrange(60))) for _ in range(150)]
    given = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    rows = given + [(10_000 + i, t) for i, t in enumerate(odd)] + [(7, "repeated id"), (7, "repeated id"), (None, "no id"), (None, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4).withColumns({n: F.lit(1) for n in ("row", "keys", "n", "key", "right")})
    assert rows_of(aligned_links(frame, frequent=frequent)) == brute_alignment(rows)


def test_alignment_of_nothing(spark):
    from stocktide.llm.crossalign import aligned_links, alignments

    empty = spark.createDataFrame([], "doc_id long, text string")
    assert aligned_links(empty).count() == 0 and alignments(empty, groups=True).count() == 0
    only = aligned_links(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")).collect()
    assert {(r["doc_id"], r["n_a"], r["count_sum"], r["groups_sha256"]) for r in only} == {(1, 0, 0, ""), (2, 0, 0, "")}


def test_groups_as_text(spark):
    from stocktide.llm.crossalign import alignments

    row = alignments(spark.createDataFrame([(1, "tokenizers disagree")], "doc_id long, text string"), groups=True).first()
    assert row["groups"].count(";") + 1 == row["n_groups"] and hashlib.sha256(row["groups"].encode()).hexdigest() == row["groups_sha256"]


def test_divide_and_conquer_finds_all_cuts():
    from stocktide.llm.crossalign import align

    draw = random.Random(9)
    for _ in range(2000):
        end = draw.randrange(1, 80)
        a, b = (sorted({*draw.sample(range(1, end + 1), draw.randrange(1, end + 1)), end}) for _ in range(2))
        assert align(a, b) == [(a.index(x) + 1, b.index(x) + 1) for x in a if x in set(b)]
    assert align([], []) == []


def test_long_stretches_without_cuts():
    """A quarter of a million ends that never meet, with cuts on both sides."""
    from stocktide.llm.crossalign import align

    n = 250_000
    a = [*range(1, 1001), *range(1002, 1000 + 4 * n, 4), *range(1000 + 4 * n, 2000 + 4 * n)]
    b = [*range(1, 1001), *range(1004, 1000 + 4 * n, 4), *range(1000 + 4 * n, 2000 + 4 * n)]
    assert len(align(a, b)) == 2000
