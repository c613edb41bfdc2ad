from __future__ import annotations

from dataclasses import replace

import pytest
from helpers import purchase, raw, rows
from pyspark.sql import functions as F

from clickloom import Config, QualityLimits
from clickloom.config import EXPECTED_COLUMNS
from clickloom.operators import quality as q
from clickloom.plans.validate import run_validation

CFG = Config(quality=QualityLimits(min_daily_events=1, max_daily_events=100))
DAY1, DAY2 = "events_20250301.csv", "events_20250302.csv"


def headers(spark, **files):
    table = [(f"events_{day[1:]}.csv", list(cols)) for day, cols in files.items()]
    return spark.createDataFrame(table, "source_file string, columns array<string>")


def checks(spark, cells, cols=EXPECTED_COLUMNS, cfg=CFG):
    found = run_validation(raw(spark, cells), headers(spark, d20250301=cols), cfg)["results"].collect()
    return {r.check_name: r for r in found}


def test_clean_file_passes_every_check(spark):
    got = checks(spark, [{}, purchase("1")])
    assert list(got) == list(q.CHECKS)
    assert all(r.passed for r in got.values())


@pytest.mark.parametrize(("missing", "passed"), [(1, True), (2, False)])
def test_null_rate_limit_is_inclusive(spark, missing, passed):
    cells = [{"client_id": None if i < missing else "a"} for i in range(20)]
    got = checks(spark, cells)["client_id_completeness"]
    assert (got.passed, got.affected_rows) == (passed, missing)


def test_row_checks_and_their_null_rules(spark):
    cells = [
        {"timestamp": "2025-03-01 10:00:00"}, {"timestamp": "2025-03-02T10:00:00.000Z"}, {"timestamp": None},
        {"event_name": None}, {"event_name": "odd"}, {"page_url": None}, {"page_url": "http://shop.example/"},
        {"page_url": "https://shop.example.evil/"}, {"event_data": "{"}, {"event_data": ""}, {"event_data": None},
    ]
    got = {k: (r.passed, r.affected_rows, r.severity) for k, r in checks(spark, cells).items()}
    assert got["timestamp_format"] == (False, 1, "HIGH")
    assert got["timestamp_partition"] == (False, 1, "HIGH")
    assert got["event_names"] == (False, 2, "CRITICAL")
    assert got["url_domain"] == (False, 1, "MEDIUM")
    assert got["event_data_json"] == (False, 1, "HIGH")


def test_file_name_without_date_fails_every_timestamp(spark):
    events = raw(spark, [{"source_file": "events_x.csv"}, {"source_file": "events_x.csv", "timestamp": None}])
    table = spark.createDataFrame([("events_x.csv", list(EXPECTED_COLUMNS))], "source_file string, columns array<string>")
    profile = q.file_profile(events, table, CFG).first()
    # An empty prefix is "--": no timestamp starts with it.
    assert (profile.wrong_dates, profile.file_date) == (1, "")


def test_purchase_counters(spark):
    def sale(data):
        return {"event_name": "purchase", "event_data": data}

    cells = [
        sale('{"transaction_id": "a", "revenue": 0}'), sale('{"transaction_id": "", "revenue": -1}'),
        sale('{"revenue": "x", "items": [{}]}'), sale('{"transaction_id": "b", "items": [{}, {"item_price": 1}]}'),
        sale("{"), sale(None), sale("[1]"),
    ]
    got = checks(spark, cells)["purchases"]
    assert (got.passed, got.severity, got.affected_rows) == (False, "HIGH", 7)
    assert got.details == {"zero_revenue": "1", "negative_revenue": "1", "missing_transaction_id": "2",
                           "null_item_prices": "1", "unreadable_payloads": "4"}
    quiet = checks(spark, [{}])["purchases"]
    assert (quiet.passed, quiet.severity) == (True, "MEDIUM")


def test_duplicates_in_and_across_files(spark):
    cells = [purchase("x"), purchase("x", client_id="b"), purchase("y"), purchase("y", source_file=DAY2),
             purchase(None), purchase(None), purchase("z")]
    events = raw(spark, cells)
    assert rows(q.duplicate_transactions(events, CFG)) == [(DAY1, "x", 2)]
    assert rows(q.cross_file_duplicates(events, CFG)) == [("x", 2), ("y", 2)]
    assert rows(q.duplicate_occurrences(events, CFG), "transaction_id", "source_file") == [
        ("x", DAY1), ("x", DAY1), ("y", DAY1), ("y", DAY2)]


@pytest.mark.parametrize(("n", "passed", "severity"), [(2, False, "HIGH"), (3, True, "HIGH"), (5, True, "HIGH"), (6, False, "MEDIUM")])
def test_volume_band(spark, n, passed, severity):
    cfg = replace(CFG, quality=QualityLimits(min_daily_events=3, max_daily_events=5))
    got = checks(spark, [{}] * n, cfg=cfg)["volume"]
    assert (got.passed, got.severity) == (passed, severity)


def test_funnel_orphans(spark):
    cells = [purchase("1", client_id="a"), {"client_id": "a"}, purchase("2", client_id="b")]
    assert checks(spark, cells)["funnel"].passed
    cells.append(purchase("3", client_id="c"))
    got = checks(spark, cells)["funnel"]
    assert (got.passed, got.affected_rows) == (False, 2)
    assert rows(q.orphan_purchasers(raw(spark, cells), CFG), "client_id") == [("b",), ("c",)]


def test_header_checks(spark):
    bare = [c for c in EXPECTED_COLUMNS if c != "referrer"]
    got = checks(spark, [{}], bare)
    assert not got["required_columns"].passed and not got["referrer"].passed
    assert got["required_columns"].details["missing"] == "referrer"
    renamed = checks(spark, [{}], ["clientId", *EXPECTED_COLUMNS[1:], "extra"])
    assert renamed["required_columns"].passed and renamed["client_id_completeness"].passed
    # Upper-case names satisfy the header check only; the other checks cannot find the column.
    upper = checks(spark, [{}], ["CLIENT_ID", *EXPECTED_COLUMNS[1:]])
    assert upper["required_columns"].passed and upper["client_id_completeness"].passed is None


def test_empty_file(spark):
    events = raw(spark, [{}])
    table = headers(spark, d20250301=EXPECTED_COLUMNS, d20250302=EXPECTED_COLUMNS)
    out = run_validation(events, table, CFG)
    got = {r.check_name: r.passed for r in out["results"].filter(F.col("source_file") == DAY2).collect()}
    assert got["client_id_completeness"] and not got["volume"]
    assert rows(out["totals"]) == [(2, 2, 0)]


def test_verdicts_and_quarantine(spark):
    cells = [{}, {"event_name": "odd"}, {"source_file": DAY2, "timestamp": "2025-03-02T10:00:00"}]
    events = raw(spark, cells)
    out = run_validation(events, headers(spark, d20250301=EXPECTED_COLUMNS, d20250302=EXPECTED_COLUMNS), CFG)
    assert rows(out["verdicts"]) == [
        (DAY1, False, "event_names", ""), (DAY2, True, "", "timestamp_format")]
    kept, held = q.quarantine_split(events, out["verdicts"])
    assert (kept.count(), held.count()) == (1, 2)


def test_trends(spark):
    daily = spark.createDataFrame(
        [("1", "d1", 0.02, 100.0, True), ("2", "d2", 0.06, 100.0, True), ("3", "d3", 0.19, 29.0, False), ("4", "d4", 0.2, 8.7, False)],
        "source_file string, date string, null_client_rate double, revenue double, has_referrer boolean",
    )
    got = rows(q.trend_anomalies(daily, CFG), "date", "anomaly")
    # 0.06 is exactly three times 0.02, and 8.7 is exactly 30 % of 29: neither fires.
    assert got == [("d3", "null_client_spike"), ("d3", "referrer_missing"), ("d3", "revenue_drop")]


def test_schema_changes(spark):
    table = headers(spark, d20250301=["client_id", "a"], d20250302=["clientId", "a"], d20250303=["clientId", "a"])
    assert rows(q.schema_changes(table)) == [(DAY2, "clientId", "client_id")]


def test_samples_are_the_first_in_input_order(spark):
    events = raw(spark, [{"timestamp": f"bad{i}"} for i in range(9)])
    got = q.samples(events, "bad_timestamps", "timestamp", CFG).orderBy("place").collect()
    assert [r.value for r in got] == [f"bad{i}" for i in range(5)]
