from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest
from oracle_check import connect, differences

import __spark_entry__ as entry
import corpus_pipeline
from clickloom.llm import decontaminate, secrets, simhash
from clickloom.llm.oracle import ORACLES
from clickloom.llm.queries import QUERIES

DATA = "/root/testdata/sf0.001"


def test_thirteen_queries_are_registered():
    names = entry.queries()
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert "pipeline" in names and set(ORACLES) <= set(QUERIES) <= set(names)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, name):
    assert differences(entry.queries()[name](spark, DATA), connect(DATA), ORACLES[name]) == ""


@pytest.mark.parametrize("stage", [stage for _, stage in corpus_pipeline.STAGES])
def test_stages_send_small_batches(spark, stage):
    """Whatever the session's batch size, a stage is planned and run with small ones."""
    import inspect

    key, seen = "spark.sql.execution.arrow.maxBytesPerBatch", []
    inner = inspect.unwrap(stage)
    assert inner is not stage
    old = spark.conf.get(key)
    spark.conf.set(key, "64m")
    try:
        limit = corpus_pipeline.in_small_batches(lambda session, docs, folder: seen.append(session.conf.get(key)) or docs)
        docs = spark.createDataFrame([(1, "x")], "doc_id long, text string")
        assert limit(spark, docs, "") is docs and int(seen[0].removesuffix("b")) == corpus_pipeline.BATCH_BYTES <= 4 << 20
    finally:
        spark.conf.set(key, old)


def test_library_without_the_package():
    code = (
        "import sys; sys.modules['clickloom.llm'] = None; import __spark_entry__ as e; "
        "assert 'pipeline' not in e.queries() and 'sessions' in e.queries() and set(e.oracle_sql()) == set(e.queries())"
    )
    subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).resolve().parents[2], check=True)


def test_stages_by_brute_force(spark):
    """Every stage against plain Python over what the stage before kept."""
    from .test_decontaminate import slow as slow_hits
    from .test_secrets import slow as slow_spans
    from .test_simhash import slow_components, slow_fingerprint

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "SimHash near-dedup", "benchmark decontamination", "secret scans", "packing",
    ]
    stages = [stage for _, stage in corpus_pipeline.STAGES]
    kept = stages[0](spark, docs, DATA)
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()

    kept = spark.createDataFrame(kept.collect(), docs.schema)
    before = sorted(kept.collect(), key=lambda r: r.doc_id)
    roots = slow_components([slow_fingerprint(r.text) for r in before])
    after = spark.createDataFrame(stages[1](spark, kept, DATA).collect(), docs.schema)
    assert sorted(r.doc_id for r in after.collect()) == sorted({before[i].doc_id for i in roots})

    before = sorted(after.collect(), key=lambda r: r.doc_id)
    hits = slow_hits([(r.doc_id, r.text) for r in before], items)
    clean = [r.doc_id for r, (words, hit, _) in zip(before, hits, strict=True) if not (hit > 0 and 20 * hit >= words)]
    after = spark.createDataFrame(stages[2](spark, after, DATA).collect(), docs.schema)
    assert sorted(r.doc_id for r in after.collect()) == clean

    before = {r.doc_id: r for r in after.collect()}
    masked = {r.doc_id: r for r in stages[3](spark, after, DATA).collect()}
    assert set(masked) == set(before)
    for name, row in before.items():
        if not slow_spans(row.text):
            assert masked[name] == row
        else:
            assert "[SECRET]" in masked[name].text and not slow_spans(masked[name].text) and masked[name].n_chars == len(masked[name].text)
    assert {r.doc_id for r in stages[4](spark, after, DATA).select("doc_id").collect()} == set(before)


def test_one_row_of_each_group_stays(spark, make_docs):
    """Ids that repeat with other texts, repeated rows of the least id, and rows without an id."""
    texts = [" ".join(f"{name}{i}" for i in range(60)) for name in ("fir", "oak", "elm", "ash", "yew")]
    pairs = [(1, texts[0]), (2, texts[0]), (2, texts[1]), (2, texts[1]), (3, texts[1]), (2, texts[2]), (4, texts[3]), (4, texts[3])]
    pairs += [(None, texts[3]), (None, texts[4]), (None, texts[4]), (None, texts[0])]
    docs = make_docs(pairs)
    kept = corpus_pipeline.near_duplicates(spark, docs, DATA)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=lambda r: r[1]) == sorted(
        [(1, texts[0]), (2, texts[1]), (2, texts[2]), (4, texts[3]), (None, texts[4])], key=lambda r: r[1]
    )


def test_whole_run(spark):
    rows = corpus_pipeline.run(spark, DATA)
    assert rows.filter("offset = 0").count() == rows.select("sequence_id").distinct().count() > 0
    assert rows.groupBy("sequence_id").agg({"length": "sum"}).filter("`sum(length)` > 2048").count() == 0


def test_stages_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").filter("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, DATA).count() == 0
    assert decontaminate.WINDOW == 13 and simhash.DISTANCE == 4 and secrets.KINDS == ("assign", "access", "hex")
