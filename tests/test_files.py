from __future__ import annotations

import csv
import json

import pytest
from helpers import rows
from pyspark.sql import functions as F

from clickloom import Config
from clickloom.operators import sessions as se
from clickloom.plans.transform import Derived, run_transformation
from clickloom.plans.validate import run_validation
from clickloom.sources.daily_files import discover_files, read_daily_files
from clickloom.sources.sinks import row_counts, store_events, write_alerts, write_table

CFG = Config()
FULL = ["client_id", "page_url", "referrer", "timestamp", "event_name", "event_data", "user_agent"]
RENAMED = ["clientId", *FULL[1:]]
BARE = ["clientId", "page_url", "timestamp", "event_name", "event_data", "user_agent"]


def write_day(path, header, lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    with path.open("w", newline="") as out:
        writer = csv.writer(out)
        writer.writerow(header)
        writer.writerows([[line.get(c, "") for c in header] for line in lines])


def sale(tid, revenue, **cells):
    data = json.dumps({"transaction_id": tid, "revenue": revenue, "items": [{"item_price": 1, "sku": "a, b"}]})
    return {"event_name": "checkout_completed", "event_data": data, **cells}


@pytest.fixture
def folder(tmp_path):
    at = "2025-03-0{}T10:00:00.000Z".format
    write_day(tmp_path / "events_20250301.csv", FULL, [
        {"client_id": "a", "page_url": "https://shop.example/?gclid=1", "referrer": "NA", "timestamp": at(1), "event_name": "page_viewed"},
        {"client_id": "NaN", "timestamp": at(1), "event_name": "page_viewed", "referrer": "https://bing.com/"},
        sale("t1", 10, client_id="a", timestamp="2025-03-01T10:20:00.000Z"),
    ])
    write_day(tmp_path / "events_20250302.csv", RENAMED, [
        {"clientId": "b", "referrer": "https://www.google.com/", "timestamp": at(2), "event_name": "page_viewed"},
        sale("t1", 10, clientId="b", timestamp=at(2)),
    ])
    # A day may also be a folder of part files.
    write_day(tmp_path / "events_20250303.csv" / "part-0.csv", BARE, [{"clientId": "a", "timestamp": at(3), "event_name": "page_viewed"}])
    write_day(tmp_path / "events_20250303.csv" / "part-1.csv", BARE, [sale("t2", 5, clientId="c", timestamp=at(3))])
    (tmp_path / "notes.csv").write_text("x\n1\n")
    return tmp_path


def test_files_with_different_headers(spark, folder):
    assert [len(v) for v in discover_files(spark, str(folder)).values()] == [1, 1, 2]
    events, headers = read_daily_files(spark, str(folder), CFG)
    assert rows(headers, "source_file") == [("events_20250301.csv",), ("events_20250302.csv",), ("events_20250303.csv",)]
    got = {(r.source_file, r.event_name, r.client_id, r.referrer) for r in events.collect()}
    assert got == {
        ("events_20250301.csv", "page_viewed", "a", None), ("events_20250301.csv", "page_viewed", None, "https://bing.com/"),
        ("events_20250301.csv", "checkout_completed", "a", None),
        ("events_20250302.csv", "page_viewed", "b", "https://www.google.com/"), ("events_20250302.csv", "checkout_completed", "b", None),
        ("events_20250303.csv", "page_viewed", "a", ""), ("events_20250303.csv", "checkout_completed", "c", ""),
    }
    assert json.loads(events.filter("event_data like '%t2%'").first().event_data)["items"][0]["sku"] == "a, b"
    with pytest.raises(FileNotFoundError):
        read_daily_files(spark, _empty(folder), CFG)


def _empty(folder):
    other = folder / "empty"
    other.mkdir()
    (other / "readme.txt").write_text("none")
    return str(other)


def test_input_order_follows_the_files(spark, tmp_path):
    lines = [{"client_id": "a", "timestamp": "2025-03-01T10:00:00.000Z", "event_name": "page_viewed", "page_url": f"https://shop.example/{i}"} for i in range(2000)]
    write_day(tmp_path / "events_20250301.csv", FULL, lines)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        events, _ = read_daily_files(spark, str(tmp_path), CFG)
        assert events.rdd.getNumPartitions() > 3
        urls = [r.page_url for r in events.orderBy("ingest_order").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert urls == [line["page_url"] for line in lines]


def test_stored_events_are_the_same(spark, folder, tmp_path_factory):
    events, _ = read_daily_files(spark, str(folder), CFG)
    back = store_events(events, str(tmp_path_factory.mktemp("raw")))
    assert back.columns == events.columns and rows(back) == rows(events)


def test_validation_of_files(spark, folder, tmp_path_factory):
    events, headers = read_daily_files(spark, str(folder), CFG, fill_referrer=False)
    events = store_events(events, str(tmp_path_factory.mktemp("raw")))
    out = run_validation(events, headers, CFG)
    failed = {(r.source_file, r.check_name) for r in out["results"].filter("not passed").collect()}
    assert ("events_20250303.csv", "referrer") in failed and ("events_20250302.csv", "referrer") not in failed
    assert rows(out["schema_changes"], "source_file", "removed") == [
        ("events_20250302.csv", "client_id"), ("events_20250303.csv", "referrer")]
    assert rows(out["cross_file_duplicates"]) == [("t1", 2)]


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_transformation_writes_and_reconciles(spark, folder, tmp_path_factory, fmt):
    target = str(tmp_path_factory.mktemp("tables"))
    out = run_transformation(spark, str(folder), target, CFG, fmt)
    assert out["events_enriched"].count() == 6
    assert rows(out["sessions"], "session_id") == [("a_1",), ("a_2",), ("b_1",), ("c_1",)]
    assert rows(out["attribution"], "transaction_id", "last_click_channel") == [("t1", "Paid Search"), ("t2", "Direct")]
    assert rows(out["user_journeys"], "client_id", "total_sessions", "channel_path") == [
        ("a", 2, "Paid Search > Direct"), ("c", 1, "Direct")]
    checks = {r.check_name: r for r in out["reconciliation"].collect()}
    assert all(r.passed for r in checks.values()) and len(checks) == 7
    assert (checks["event_count"].original, checks["event_count"].transformed) == (7.0, 6.0)
    assert (checks["revenue_total"].original, checks["revenue_total"].transformed) == (25.0, 15.0)
    if fmt == "parquet":
        assert row_counts(spark, {"sessions": f"{target}/sessions"}) == {"sessions": 4}


def test_only_the_dates_written_are_replaced(spark, folder, tmp_path_factory):
    target = str(tmp_path_factory.mktemp("merge"))
    raw, _ = read_daily_files(spark, str(folder), CFG)
    whole = Derived(raw, CFG).sessions
    write_table(whole, target, "sessions")
    write_table(whole.filter("session_date = '2025-03-02'").limit(0).unionByName(
        whole.filter("session_date = '2025-03-03'").withColumn("event_count", whole.event_count + 100)), target, "sessions", dynamic=True)
    back = spark.read.parquet(f"{target}/sessions")
    assert rows(back, "session_id", "event_count") == [("a_1", 2), ("a_2", 101), ("b_1", 2), ("c_1", 101)]


def test_alerts_as_json(spark, tmp_path):
    path = write_alerts(spark.createDataFrame([("d", "x")], "source_file string, name string"), str(tmp_path))
    assert set(spark.read.json(path).columns) == {"source_file", "name", "kind", "run", "raised_at"}


def test_a_repeated_run_leaves_one_set_of_alerts(spark, tmp_path):
    def alerts(*pairs):
        return spark.createDataFrame(list(pairs), "source_file string, name string")

    days = spark.createDataFrame([("d1",), ("d2",)], "source_file string")
    write_alerts(alerts(("d1", "x"), ("d2", "y"), ("d2", "z")), str(tmp_path), days, "r1")
    write_alerts(alerts(("d2", "y")), str(tmp_path), days.filter("source_file = 'd2'"), "r2")
    path = write_alerts(alerts(("d3", "w")), str(tmp_path), days.unionByName(spark.sql("SELECT 'd3' AS source_file")).filter("source_file <> 'd1'"), "r3")
    lines = spark.read.json(path)
    assert rows(lines.filter("kind = 'alert'"), "source_file", "name", "run") == [("d1", "x", "r1"), ("d3", "w", "r3")]
    assert rows(lines.filter("kind = 'day'"), "source_file", "run") == [("d1", "r1"), ("d2", "r3"), ("d3", "r3")]


def test_ordered_export_and_counts(spark, folder, tmp_path):
    out = run_transformation(spark, str(folder), str(tmp_path), CFG, ordered=True)
    counted = {r.table_name: r.rows for r in out["row_counts"].collect()}
    assert counted == {name: out[name].count() for name in counted} and counted["events_enriched"] == 6
    key = [(r.client_id, r.session_start) for name in sorted(p for p in (tmp_path / "sessions").rglob("part-*.parquet")) for r in spark.read.parquet(str(name)).collect()]
    assert len(key) == 4


def test_many_files_of_one_date_are_in_order(spark, tmp_path):
    rows_ = [(f"c{i * 7919 % 5000:05d}", "2025-03-01") for i in range(5000)]
    frame = spark.createDataFrame(rows_, "client_id string, session_date string").withColumn("session_start", F.lit(1))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        path = write_table(frame, str(tmp_path), "sessions", ordered=True)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = sorted((tmp_path / "sessions" / "session_date=2025-03-01").glob("part-*.parquet"))
    clients = [r.client_id for f in files for r in spark.read.parquet(str(f)).collect()]
    assert len(files) > 1 and clients == sorted(clients) and path.endswith("sessions")


def test_stored_chunks_can_be_numbered_again(spark, folder):
    raw, _ = read_daily_files(spark, str(folder), CFG)
    d = Derived(raw, CFG)
    assert rows(se.sessions(d.events, CFG), "session_id") == rows(d.sessions, "session_id")


def test_nothing_is_lost_at_the_door(spark, tmp_path):
    """Part files of one day with different headers, a line break in a cell, a bad time, a missing client."""
    at = "2025-03-01T10:00:00.000Z"
    day = tmp_path / "in" / "events_20250301.csv"
    broken = sale("t1", 5)
    broken["event_data"] = broken["event_data"].replace(", ", ",\n", 1)
    write_day(day / "part-0.csv", FULL, [
        {"client_id": "a", "referrer": "https://bing.com/", "timestamp": at, "event_name": "page_viewed"},
        {"client_id": "b", "timestamp": "yesterday", "event_name": "page_viewed"},
        {"client_id": "", "timestamp": at, "event_name": "page_viewed"},
    ])
    write_day(day / "part-1.csv", BARE, [
        {"clientId": "c", "timestamp": at, "event_name": "page_viewed"},
        {**broken, "clientId": "d", "timestamp": at},
    ])
    source = str(tmp_path / "in")
    events, headers = read_daily_files(spark, source, CFG)
    assert set(headers.first()["columns"]) == set(BARE) & set(FULL)
    by_client = {r.client_id: r for r in events.filter("corrupt_record IS NULL").collect()}
    assert by_client["c"].timestamp == at and by_client["c"].event_name == "page_viewed"

    tables = run_transformation(spark, source, str(tmp_path / "out"), CFG)
    assert rows(tables["rejects"], "reason") == [("malformed_row",), ("malformed_row",), ("unreadable_time",)]
    checks = {r.check_name: r for r in tables["reconciliation"].collect()}
    accounted = checks["rows_accounted_for"]
    assert accounted.passed and (accounted.original, accounted.transformed, accounted.note) == (6, 6, 3)

    whole = run_transformation(spark, source, str(tmp_path / "whole"), Config(multi_line=True))
    assert rows(whole["rejects"], "reason") == [("unreadable_time",)]
    assert whole["conversions"].first()["revenue"] == 5.0 and whole["sessions"].count() == 3


def test_rows_are_sorted_within_a_date(spark, folder, tmp_path):
    run_transformation(spark, str(folder), str(tmp_path / "sorted"), CFG, fmt="csv")
    for part in (tmp_path / "sorted" / "events_enriched").rglob("part-*.csv"):
        with part.open(newline="") as lines:
            clients = [line["client_id"] for line in csv.DictReader(lines)]
        assert clients == sorted(clients)


def test_lost_chunks_fail_the_check(spark, folder, tmp_path):
    from clickloom.operators.reconcile import reconciliation

    events, _ = read_daily_files(spark, str(folder), CFG)
    d = Derived(store_events(events, str(tmp_path / "raw")), CFG)
    lost = d.chunks.filter("client_id <> 'b'")
    enriched = se.assign_sessions(d.events, lost, CFG)
    checks = reconciliation(d.raw, enriched, d.sessions, d.conversions, d.attribution, CFG)
    assert {r.check_name: r.passed for r in checks.collect()}["events_sessionized"] is False
