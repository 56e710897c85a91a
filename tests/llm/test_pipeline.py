"""The corpus pipeline, stage by stage, on a small table."""

import corpus_pipeline
from hillwarden.llm.tables import keep

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    left = [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = keep(stage(spark, docs, SF))
        assert docs.columns == columns
        left.append(docs.count())
    assert left == sorted(left, reverse=True) and 0 < left[-1] < left[0]
    assert docs.select("text").distinct().count() == left[-1]
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert pieces.select("doc_id").distinct().count() == left[-1]
