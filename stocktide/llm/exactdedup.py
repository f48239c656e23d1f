"""Exact duplicates by progressive refinement: length, then hash of a prefix, then hash of the whole text.

Each level only passes on what it can't tell apart yet. A first scan writes two numbers per row, the length and the hash
of the first characters. Lengths that occur once end there and never enter an exchange; (length, prefix hash) groups of
one row end at the second level. What is left becomes a bitmap, and the second scan hashes whole texts only where a row's
bit is set. A bit that two groups share costs one more hash and changes no result, so the bitmap has a fixed greatest
size (16 MB) whatever the input; it is the only thing broadcast besides the classes that hold a thousandth of the rows
each, of which there can't be more than a thousand.

Texts never travel to find classes: an exchange carries lengths and hashes, combined in each task first, so that a text
that fills a third of the table leaves each task as one row. Equal SHA-256 of equally long texts counts as equal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocktide.llm.common import bitmap_bits, bitmap_of, cut, looked_up, packed_rows, with_bit

#: Characters of the prefix; bits of the bitmap of lengths.
PREFIX, LENGTH_BITS = 64, 20


def _text() -> Column:
    return F.coalesce(F.col("text"), F.lit(""))


def _length() -> Column:
    return F.octet_length(_text()).cast("long")


def _prefix_hash() -> Column:
    return F.xxhash64(F.substring(_text(), 1, PREFIX))


class Refinement:
    """What the first two levels leave open over one table of documents."""

    def __init__(self, docs: DataFrame):
        short = cut(docs.select(_length().alias("n"), _prefix_hash().alias("p")))
        lengths = short.groupBy("n").count().where("count > 1").select(F.xxhash64("n").alias("key"))
        same_length = with_bit(short, F.xxhash64("n"), bitmap_of(lengths, LENGTH_BITS), LENGTH_BITS, "open").where("open")
        groups = cut(same_length.groupBy("n", "p").count().where("count > 1").select(F.xxhash64("n", "p").alias("key")))
        self.rows = short.count()
        self.bits = bitmap_bits(groups.count())
        self.bitmap = cut(bitmap_of(groups, self.bits))

    def hashed(self, frame: DataFrame) -> DataFrame:
        """`frame`, which has a column `text`, with the full hash `_full` of the rows that are still open; null for all others."""
        marked = with_bit(frame, F.xxhash64(_length(), _prefix_hash()), self.bitmap, self.bits, "_open")
        return marked.withColumn("_full", F.when(F.col("_open"), F.struct(_length().alias("n"), F.unhex(F.sha2(_text(), 256)).alias("h")))).drop("_open")


def exact_groups(docs: DataFrame, **carry: Column) -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, and the columns `carry` computes from the row.

    Rows are equal when their texts are, byte by byte; a null text is empty. Of equal rows the one with the largest
    doc_id stays; rows without doc_id come before all others, so one of them stays (keep_id null) only where no equal
    row has an id. Of repeated rows with one doc_id exactly one stays. An empty table gives no rows; other columns,
    whatever their names, are not read.
    """
    level = Refinement(docs)
    slim = docs.select(F.col("doc_id").cast("long").alias("_id"), "text", *[c.alias(f"_c_{n}") for n, c in carry.items()])
    # The row's own number is fixed by writing it: a lost executor can't renumber rows afterwards.
    rows = cut(level.hashed(slim).drop("text").withColumn("_row", F.monotonically_increasing_id()))
    classes = rows.where("_full is not null").groupBy("_full").agg(F.max(F.struct("_id", "_row")).alias("_top"), F.count(F.lit(1)).alias("_size"))
    classes = cut(classes.where("_size > 1"))
    placed = looked_up(rows, classes.withColumn("_uses", F.col("_size")), ["_full"], "_uses", level.rows)
    alone = F.col("_size").isNull()
    return placed.select(
        F.col("_id").alias("doc_id"),
        F.when(alone, F.col("_id")).otherwise(F.col("_top._id")).alias("keep_id"),
        F.coalesce("_size", F.lit(1).cast("long")).alias("group_size"),
        (alone | (F.col("_row") == F.col("_top._row"))).alias("kept"),
        *[F.col(f"_c_{n}").alias(n) for n in carry],
    )


def without_copies(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that stay, with all their columns: of equal texts the row with the largest doc_id.

    Rows that no other row can equal pass without an exchange; of the others each task sends one row per text.
    """
    level = Refinement(docs)
    rows = level.hashed(packed_rows(docs).withColumn("text", F.col("row.text")))
    single = rows.where("_full is null").select("row")
    best = rows.where("_full is not null").groupBy("_full").agg(F.max_by("row", F.struct(F.col("row.doc_id").cast("long"))).alias("row")).select("row")
    return single.union(best).select("row.*")


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """Every row with its group and the SHA-256 of its text."""
    return exact_groups(docs, text_sha256=F.sha2(_text(), 256)).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
