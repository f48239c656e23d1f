"""Variable-capacity best-fit packing of documents into training sequences.

Several sequence lengths are permitted and optimised together. Pieces are placed longest first into the open bin that
they fill best. Where none has room, a bin of the size with the least expected cost for this piece is opened: the size's
cost, shared between the piece and what shorter pieces can still put beside it. In the end each bin is downsized to the
smallest permitted length that holds its contents. Whole sequences of the largest length are cut off long documents
first, so no token is dropped.

Documents are packed in groups, as many as the number of documents asks for; a group has a bounded number of rows
whatever their keys, and is packed by itself.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocktide.llm.bpe import broadcast_vocabulary, loaded, public_vocabulary
from stocktide.llm.common import _arrow_schema as arrow_schema
from stocktide.llm.common import arrow_map, cut, ship, slices, to_batch, utf8
from stocktide.llm.tokenfile import TEXT_BYTES, Library

#: Permitted sequence lengths, and documents of one group on average.
LENGTHS = (512, 1024, 2048, 4096, 8192)
GROUP = 50_000
SCHEMA = "doc_id long, piece int, start long, n_tokens long, pack_group long, bin long, bin_length long, bin_offset long"


def sequence_cost(length: int) -> float:
    """Cost of one sequence: its tokens, attention that grows with their square, and a fixed part."""
    return length + length * length / 65536 + 32


def token_counts(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """(doc_id, n_tokens): BPE tokens of the whole text and one end token; a null text is empty."""
    shared = broadcast_vocabulary(docs.sparkSession, vocabulary or public_vocabulary())

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        library = loaded(shared.value, Library)
        for i, j in slices(utf8(batch.column(1))[1], TEXT_BYTES):
            _, bounds = library.encode_column(batch.column(1).slice(i, j - i))
            yield {"doc_id": batch.column(0).slice(i, j - i), "n_tokens": np.diff(bounds) + 1}

    return arrow_map(docs.select("doc_id", "text"), run, "doc_id long, n_tokens long")


def best_fit(sizes: Sequence[int], lengths: Sequence[int], cost=sequence_cost) -> tuple[list[int], list[int], list[int]]:
    """(bin of each piece, offset in it, length of each bin) for sizes in descending order, none above the largest length."""
    top = max(lengths)
    total = np.bincount(np.asarray(sizes, np.int64), minlength=top + 1) * np.arange(top + 1)
    price = sorted((c, cost(c)) for c in lengths)
    room: list[list[int]] = [[] for _ in range(top + 1)]  # bins by what they have left
    there = 0  # bit r is set if room[r] isn't empty
    used: list[int] = []
    where, offset = [], []
    shorter = np.cumsum(total)  # tokens of pieces up to each size that are still to come
    for size in sizes:
        shorter[size:] -= size
        mask = there >> size
        if mask:
            left = size + (mask & -mask).bit_length() - 1
            b = room[left].pop()
            if not room[left]:
                there ^= 1 << left
        else:
            best = None
            for c, full in price:
                if c >= size:
                    beside = min(c - size, int(shorter[min(c - size, top)]))
                    share = full * size / (size + beside)
                    if best is None or share < best[0]:
                        best = (share, c)
            b, left = len(used), best[1]
            used.append(0)
        where.append(b)
        offset.append(used[b])
        used[b] += size
        left -= size
        if left:
            room[left].append(b)
            there |= 1 << left
    return where, offset, [next(c for c, _ in price if c >= u) for u in used]


def pack(counts: DataFrame, lengths: Sequence[int] = LENGTHS) -> DataFrame:
    """Places of all pieces of (doc_id, n_tokens): a row per piece with its group, bin, bin's length and offset.

    A document above the largest length is cut into pieces of that length and a rest; each full piece is a bin of its
    own. Rows without tokens (null or 0) get one piece without tokens in bin -1 of length 0. Rows without doc_id are
    packed too; repeated rows are packed as often as they occur, ties by doc_id.
    """
    lengths = tuple(sorted(lengths))
    spark = counts.sparkSession
    ship(spark)
    counts = cut(counts.select("doc_id", F.greatest(F.coalesce("n_tokens", F.lit(0)), F.lit(0)).cast("long").alias("n_tokens")))
    groups = max(1, -(-counts.count() // GROUP))
    # Rows are dealt by their own number, so that repeated rows or rows without doc_id don't meet in one group; the table
    # is stored, so a task that runs again deals them the same way.
    key = F.xxhash64("doc_id", F.monotonically_increasing_id())
    dealt = counts.withColumn("pack_group", F.pmod(key, F.lit(groups)))
    arrow = arrow_schema(spark, SCHEMA)

    def run(table: pa.Table) -> pa.Table:
        ids = table.column("doc_id").combine_chunks()
        size, top = table.column("n_tokens").to_numpy(), lengths[-1]
        order = np.lexsort((pc.fill_null(ids, -(2**63)).to_numpy(), -size))
        ids, size = ids.take(pa.array(order)), size[order]
        pieces = np.maximum(1, -(-size // top))
        row = np.repeat(np.arange(len(size)), pieces)
        number = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        own = np.minimum(top, size[row] - number * top)
        by = np.argsort(-own, kind="stable")
        row, number, own = row[by], number[by], own[by]
        filled = int((own > 0).sum())
        where, offset, kinds = best_fit(own[:filled].tolist(), lengths)
        none = len(own) - filled
        columns = {
            "doc_id": ids.take(pa.array(row)),
            "piece": number,
            "start": number * top,
            "n_tokens": own,
            "pack_group": np.full(len(own), table.column("pack_group")[0].as_py()),
            "bin": where + [-1] * none,
            "bin_length": [kinds[b] for b in where] + [0] * none,
            "bin_offset": offset + [0] * none,
        }
        return pa.Table.from_batches([to_batch(columns, arrow)])

    return dealt.groupBy("pack_group").applyInArrow(run, SCHEMA)


def packed_documents(docs: DataFrame, lengths: Sequence[int] = LENGTHS, vocabulary: str | None = None) -> DataFrame:
    """`pack` over the token counts of whole texts. An empty table gives no rows."""
    return pack(token_counts(docs, vocabulary), lengths)
