"""The registered queries of the package and the pipeline, on the smallest tables."""

import corpus_pipeline
import pytest
from compare import connect, differences
from tidemill.llm.queries import QUERIES


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, data, name):
    build, sql = QUERIES[name]
    result = build(spark, data)
    if sql:
        assert differences(result, sql, connect(data)) is None
    else:
        table, key = ("pages", "page_id") if "page_id" in result.columns else ("documents", "doc_id")
        rows = spark.read.parquet(f"{data}/{table}.parquet").select(key).collect()
        assert sorted(result.select(key).collect()) == sorted(rows)


def test_pipeline_stages(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES:
        after = corpus_pipeline.stored(stage(spark, docs, data), f"test-{name}")
        if name != "encode":
            assert after.columns == docs.columns
            assert 0 < after.count() <= before
            before, docs = after.count(), after
    assert after.count() == before and after.columns == ["doc_id", "source", "lang", "n_tokens", "ids"]


@pytest.mark.parametrize("position", range(5))
def test_stages_take_empty_tables(spark, data, position):
    docs = spark.read.parquet(f"{data}/documents.parquet").where("false")
    assert corpus_pipeline.STAGES[position][1](spark, docs, data).count() == 0
