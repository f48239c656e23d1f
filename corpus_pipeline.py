"""The corpus pipeline: toxic documents go, near copies go, repeated passages go, personal data is replaced, the rest is packed.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again as the next
stage's docs. All but the last keep the columns of `documents`. The last gives the places of all documents in training
sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stocktide.llm import packing, setjoin, suffixdedup, surrogates, toxicity
from stocktide.llm.common import cut, documents


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the conditional random field rejects go; it learns from the labels of rows that aren't held out."""
    field = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.accepted(docs, field)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: five-word shingles, similarity of 0.8 or more, the smallest doc_id."""
    return setjoin.one_of_each(docs, k=5, percent=80)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of passages of 200 bytes or more that also stand elsewhere go; every document stays."""
    return suffixdedup.without_repeats(docs, length=200)


def replace_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data gets surrogates."""
    return surrogates.with_surrogates(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces of all documents in sequences of several lengths."""
    return packing.packed_documents(docs)


STAGES = [("toxicity", drop_toxic), ("jaccard join", drop_near_copies), ("suffix dedup", cut_repeats), ("surrogates", replace_private), ("best-fit packing", pack)]

#: The stages aren't SQL; tests/llm compares them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`. What each keeps is written to the shared folder and read as the next one's input."""
    docs = documents(spark, sf_dir)
    for _, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir))
    return docs
