"""The pipeline, stage by stage."""

import pytest

import corpus_pipeline
from tests.llm.cases import clashing_docs, no_docs, odd_docs
from tests.llm.test_overlap import brute_kept
from threadloom.llm import exact


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert [f for _, f in corpus_pipeline.STAGES] == [
        corpus_pipeline.language, corpus_pipeline.exact_dedup, corpus_pipeline.near_dedup, corpus_pipeline.mix, corpus_pipeline.pack,
    ]
    with_language = corpus_pipeline.language(spark, docs, sf)
    assert with_language.count() >= docs.filter("lang IS NOT NULL AND text RLIKE '[a-z]{3}'").count() * 0.99
    unique = corpus_pipeline.exact_dedup(spark, with_language, sf)
    assert exact.exact_groups(unique).agg({"group_size": "max"}).first()[0] == 1
    apart = corpus_pipeline.near_dedup(spark, unique, sf)
    texts = [(r.doc_id, r.text) for r in unique.collect()]
    assert {r.doc_id for r in apart.collect()} == brute_kept(texts) and len(texts) > apart.count()
    mixed = corpus_pipeline.mix(spark, apart, sf)
    assert mixed.columns == docs.columns
    packed = corpus_pipeline.pack(spark, mixed, sf)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == {r.doc_id for r in mixed.select("doc_id").distinct().collect()}
    assert packed.count() >= mixed.count()


def test_run_reads_documents(spark, sf):
    out = corpus_pipeline.run(spark, sf)
    assert {"doc_id", "piece", "sequence_id", "offset"} <= set(out.columns) and out.count() > 0


@pytest.mark.parametrize("make", [odd_docs, clashing_docs, no_docs])
def test_stages_take_odd_rows(spark, sf, make):
    docs = make(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns
        out.count()
    corpus_pipeline.pack(spark, docs, sf).count()
