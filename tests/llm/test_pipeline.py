"""Stages of the pipeline on the smallest given table: schemas, and what each stage must and must not drop."""

import os

import pytest

import corpus_pipeline
from threadloom.llm.common import store

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = store(stage(spark, docs, SF), name)
        assert docs.columns == columns
        kept.append({r.doc_id for r in docs.select("doc_id").collect()})
    assert all(b <= a for a, b in zip(kept, kept[1:])) and len(kept[-1]) > 50
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r.doc_id for r in packed} == kept[-1]


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = store(stage(spark, docs, SF), name)
    assert docs.count() == 0
