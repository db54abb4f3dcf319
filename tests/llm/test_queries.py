"""The registered queries against their SQL, and the pipeline stage by stage."""

import pytest

import corpus_pipeline
from tests.oracle import connect, difference
from tidemark.llm.queries import ORACLE, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    assert difference(spark, connect(SF_DIR), name, SF_DIR) is None


def test_all_queries():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, seen = docs.columns, []
    docs = docs.selectExpr("*", "'x' AS lang_pred", "1 AS score", "2 AS taken", "3 AS key")
    docs = docs.unionByName(spark.createDataFrame(
        [(None, None, None, None, None), (None, "!!", "en", None, 2),
         (9001, "", "en", "s", 0)], docs.select(*columns).schema), allowMissingColumns=True)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_DIR)
        if name != "mixing":
            assert out.columns == docs.columns and out.schema.simpleString() == docs.schema.simpleString()
        docs = spark.createDataFrame(out.collect(), out.schema)
        seen.append(docs.count())
    assert seen == sorted(seen, reverse=True) and seen[-1] > 50
    assert set(columns) < set(docs.columns) and docs.filter("taken <= 0").count() == 0


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES])
def test_stages_take_empty_tables(spark, stage):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    assert stage(spark, docs, SF_DIR).count() == 0


def test_whole_pipeline(spark):
    out = corpus_pipeline.run(spark, SF_DIR)
    assert 0 < out.count() <= 200
