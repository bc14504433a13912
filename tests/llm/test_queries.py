"""Registered corpus queries: SQL side by side on the smallest tables, and the pipeline."""

from __future__ import annotations

import pytest

import corpus_pipeline
from riskloom.llm.queries import ORACLES, QUERIES
from tests.oracle import connect, differences

DIRECTORY = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(DIRECTORY)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    assert differences(QUERIES[name](spark, DIRECTORY), con, ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_a_row_for_each_input(spark, name):
    rows = QUERIES[name](spark, DIRECTORY)
    docs = spark.read.parquet(f"{DIRECTORY}/documents.parquet")
    assert sorted(r[0] for r in rows.select("doc_id").collect()) == sorted(r[0] for r in docs.select("doc_id").collect())


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{DIRECTORY}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = corpus_pipeline.stored(stage(spark, docs, DIRECTORY), "test")
        after = docs.count()
        assert 0 < after <= before
        assert i == len(corpus_pipeline.STAGES) - 1 or docs.columns == columns
        before = after
    assert docs.select("doc_id").distinct().count() == before
