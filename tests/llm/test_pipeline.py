"""The pipeline's stages, each on what the one before kept."""

import corpus_pipeline
from fedspark.llm.common import materialize, read_table

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = read_table(spark, SF, "documents")
    columns, kept = docs.columns, {r["doc_id"] for r in docs.collect()}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs.count()
        docs = materialize(stage(spark, docs, SF))
        ids = {r["doc_id"] for r in docs.select("doc_id").collect()}
        assert ids <= kept, name
        kept = ids
        if k + 1 < len(corpus_pipeline.STAGES):
            assert docs.columns == columns, name
    assert docs.count() == before and set(docs.columns) >= {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"}


def test_stages_of_nothing(spark):
    docs = read_table(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF))
    assert docs.count() == 0
