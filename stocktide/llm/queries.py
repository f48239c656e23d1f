"""One query per operator, over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stocktide.llm import bpe, crossalign, crosspolytope, exactdedup, imatch, mainblocks, packing, prefixtrie, setjoin, suffixdedup, surrogates, tokenfile, toxicity
from stocktide.llm.common import documents


def op1_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.fingerprints_under_edits(documents(spark, sf_dir))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixdedup.repeated_bytes(documents(spark, sf_dir))


def op3_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crosspolytope.near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(documents(spark, sf_dir))


def op5_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(documents(spark, sf_dir))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    field = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, field)


def op7_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = surrogates.with_surrogates(documents(spark, sf_dir))
    return out.select("doc_id", "text", F.length(F.coalesce("text", F.lit(""))).cast("long").alias("n_chars"))


def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return mainblocks.main_text(pages, mainblocks.train(pages)).select("page_id", "url", "text", "n_chars")


def op9_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfile.token_digests(documents(spark, sf_dir))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setjoin.jaccard_components(documents(spark, sf_dir), k=3, percent=90)


def op11_cross_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crossalign.aligned_links(documents(spark, sf_dir))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixtrie.prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exactdedup.exact_duplicates(documents(spark, sf_dir))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_imatch, op2_suffix_dedup, op3_cross_polytope, op4_bpe, op5_best_fit, op6_toxicity, op7_surrogates, op8_main_text, op9_token_file, op10_jaccard_join, op11_cross_align, op12_prefix_trie, op13_exact_dedup, pipeline)}

_COMPONENTS = """
reach(a, b) AS (SELECT id, id FROM node UNION SELECT r.a, e.b FROM reach r JOIN edge e ON e.a = r.b),
comp AS (SELECT a AS id, min(b) AS component_id FROM reach GROUP BY a)"""

SQL = {
    # Every pair of vectors by its cosine.
    "op3_cross_polytope": f"""
WITH RECURSIVE v AS (SELECT vec_id AS id, embedding::DOUBLE[] AS e FROM embeddings),
node AS (SELECT id FROM v),
edge AS (SELECT x.id AS a, y.id AS b FROM v x JOIN v y ON x.id <> y.id AND list_cosine_similarity(x.e, y.e) >= 0.95),{_COMPONENTS},
links AS (SELECT a AS id, count(*) AS n FROM edge GROUP BY a)
SELECT node.id AS vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, node.id = component_id AS kept
FROM node JOIN comp USING (id) LEFT JOIN links USING (id)""",
    # Every pair of documents that shares a shingle, by its whole sets.
    "op10_jaccard_join": rf"""
WITH RECURSIVE w AS (SELECT doc_id AS id, regexp_extract_all(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\t\n\x0B\f\r ]+', ' ', 'g'), '[^ ]+') AS w FROM documents),
s AS (SELECT DISTINCT id, array_to_string(w[i:i + 2], ' ') AS s FROM (SELECT id, w, unnest(range(1, greatest(1, len(w) - 2) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT id, count(*) AS n FROM s GROUP BY id),
node AS (SELECT doc_id AS id FROM documents),
edge AS (SELECT x.id AS a, y.id AS b FROM s x JOIN s y ON x.s = y.s AND x.id <> y.id JOIN n nx ON nx.id = x.id JOIN n ny ON ny.id = y.id
  GROUP BY x.id, y.id, nx.n, ny.n HAVING 100 * count(*) >= 90 * (nx.n + ny.n - count(*))),{_COMPONENTS}
SELECT node.id AS doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id FROM node JOIN comp USING (id) LEFT JOIN n USING (id)""",
    # Whole texts as window keys.
    "op13_exact_dedup": """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
}
