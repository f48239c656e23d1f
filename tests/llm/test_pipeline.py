"""The pipeline's stages one after the other, each against a plain version on its own input."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from test_corpus_operators import brute_components, repeats  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages, columns = dict(corpus_pipeline.STAGES), docs.columns
    clean = stages["toxicity"](spark, docs, SF)
    assert clean.columns == columns and 0 < clean.count() < docs.count()
    near = stages["jaccard join"](spark, clean, SF)
    found = brute_components([(r["doc_id"], r["text"]) for r in clean.collect()], 5, 80)
    assert sorted(r["doc_id"] for r in near.collect()) == sorted(i for i, (_, c) in found.items() if i == c)
    before = near.collect()
    cut = {r["doc_id"]: r for r in stages["suffix dedup"](spark, near, SF).collect()}
    for r, (_, removed, _, _) in zip(before, repeats([r["text"] for r in before]), strict=True):
        assert (cut[r["doc_id"]]["text"] == r["text"]) == (removed == 0) and cut[r["doc_id"]]["n_chars"] == len(cut[r["doc_id"]]["text"])
    placed = corpus_pipeline.run(spark, SF).toPandas()
    assert set(placed.doc_id) == set(cut)
