"""Columns that carry the names operators use themselves pass through unchanged."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from clickloom.llm import quality, secrets, toxicity, wordpiece
from clickloom.llm.common import set_aside

DATA = "/root/testdata/sf0.001"
NAMES = (
    "_key", "_blob", "_spans", "_n", "_odds", "_text", "_page", "_lang", "_source", "_length", "_raw", "_row",
    "_good", "_ROW", "Key", "blob", "spans", "fp", "id", "component", "_doc", "_id", "_label", "n_hit", "items",
)
NAMES = tuple({n.lower(): n for n in NAMES}.values())


@pytest.fixture(scope="module")
def odd(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    return docs.withColumns({n: F.concat(F.lit(n), F.col("doc_id").cast("string")) for n in NAMES})


def unchanged(docs, found, lost=()):
    kept = [c for c in docs.columns if c not in lost]
    assert [c for c in found.columns if c in kept] == kept
    assert all(row[n] == f"{n}{row.doc_id}" for row in found.collect() for n in NAMES if n not in lost)


def test_set_aside(spark):
    rows, back = set_aside(spark.createDataFrame([(1, 2, 3)], "_A int, _a_ int, b int"), "_a", "c")
    assert rows.columns == ["_A__", "_a_", "b"] and rows.select(*back).first().asDict() == {"_A": 1, "_a_": 2, "b": 3}


def test_operators(spark, odd):
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    unchanged(odd, wordpiece.token_counts(odd))
    unchanged(odd, secrets.secret_spans(odd), lost=("_spans",))
    unchanged(odd, quality.score(odd, labels, rounds=1), lost=("_good",))
    unchanged(odd, toxicity.Severity(np.zeros(toxicity.DIMENSIONS), (0.0, 1.0)).score(odd))


def test_stages(spark, odd):
    docs = odd
    for _, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, docs, DATA)
        assert found.columns == odd.columns
        unchanged(odd, found)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, DATA).count() >= docs.count()
