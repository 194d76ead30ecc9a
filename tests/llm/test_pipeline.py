import random

import corpus_pipeline
from daybridge.llm.graph import stored
from tests.llm.helpers import SF, edge_rows, frame, sentence


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, SF), name)
        assert docs.columns == columns
        ids = [r.doc_id for r in docs.select("doc_id").collect()]
        assert len(ids) == len(set(ids)) and set(ids) <= seen
        assert len(ids) == len(seen) if name == "secret_scan" else len(ids) < len(seen)
        seen = set(ids)
    placed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r.doc_id for r in placed.select("doc_id").collect()} == seen


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), name)
        assert docs.count() == 0


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0


def test_edge_rows_pass_all_stages(spark):
    """Nulls, repeated ids and rows, blank and very long texts, columns that operators use themselves."""
    docs = frame(spark, edge_rows())
    columns, before = docs.columns, len(edge_rows())
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, SF), name)
        assert docs.columns == columns and docs.count() <= before
        before = docs.count()
    placed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert placed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


def test_near_duplicates_keep_unrelated_texts_of_one_id(spark):
    rng = random.Random(3)
    texts = [sentence(rng, 60) for _ in range(4)]
    docs = frame(spark, [(5, texts[0]), (5, texts[1]), (7, texts[2]), (7, texts[3])])
    kept = dict(corpus_pipeline.STAGES)["near_duplicates"](spark, docs, SF)
    assert sorted(r.text for r in kept.collect()) == sorted(texts)
