"""A query of each family against its SQL counterpart; `oracle_check.py` runs all of them."""

from __future__ import annotations

import os
from pathlib import Path

import pytest
from oracle_check import connect, differences

import __spark_entry__ as entry

FOLDER = os.environ.get("ORACLE_DIR", "/root/testdata/sf0.001")
FAMILIES = (
    "ingest_daily_files", "normalise_schema", "url_parts", "traffic_source", "json_validity", "purchase_payload", "events_enriched", "sessions",
    "incremental_sessions", "conversions", "attribution", "linear_attribution", "channel_summary", "user_journeys",
    "repeat_journeys", "reconciliation", "dq_results", "dq_file_verdict", "trend_anomalies", "duplicate_occurrences",
    "offending_samples", "alerts", "metric_results", "metric_zscores", "rolling_baseline", "device_conversion", "funnel_report",
)
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="needs the test tables")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_a_counterpart():
    corpus = {name for name in entry.queries() if name == "pipeline" or name.startswith("op")}
    assert set(entry.queries()) - corpus == set(entry.oracle_sql()) - corpus


@pytest.mark.parametrize("name", FAMILIES)
def test_same_rows(spark, con, name):
    assert differences(entry.queries()[name](spark, FOLDER), con, entry.oracle_sql()[name]) == ""


def test_flagship(spark):
    frame = entry.entry(spark)
    assert frame.columns == ["date", "channel", "conversions", "revenue", "attribution_model"]
    assert frame.count() > 0
