from __future__ import annotations

import pytest
from helpers import raw, rows
from test_files import BARE, FULL, RENAMED, sale, write_day

from clickloom import Config
from clickloom.operators import quality as q
from clickloom.plans.transform import Derived
from clickloom.streaming import daily as st

CFG = Config()


def lines():
    at = "2025-03-01T10:{:02d}:00.000Z".format
    events = [{"client_id": c, "timestamp": at(m), "event_name": "page_viewed"} for c, m in (("a", 0), ("a", 30), ("b", 5), ("", 9))]
    events.append(sale("t1", 5, client_id="a", timestamp=at(31)))
    events.append(sale("t1", 5, client_id="b", timestamp=at(32)))
    events.append({"client_id": "a", "timestamp": "2025-03-01T11:02:00.001Z", "event_name": "page_viewed"})
    return events


# A day far ahead moves the watermark past all others.
CLOSING = [{"client_id": "z", "timestamp": "2025-04-01T00:00:00.000Z", "event_name": "page_viewed"}]


def run(spark, tmp_path, build, name):
    files = tmp_path / "in"
    write_day(files / "events_20250301.csv", FULL, lines())
    stream = st.read_arriving_files(spark, str(files), CFG, files_per_batch=1)
    query = build(stream).writeStream.format("memory").queryName(name).outputMode("append").option(
        "checkpointLocation", str(tmp_path / "checkpoint")).start()
    try:
        query.processAllAvailable()
        write_day(files / "events_20250401.csv", FULL, CLOSING)
        query.processAllAvailable()
    finally:
        query.stop()
    return spark.table(name)


def test_stream_sessions_equal_batch_sessions(spark, tmp_path):
    got = run(spark, tmp_path, lambda s: st.stream_sessions(s, CFG), "live_sessions")
    batch = Derived(raw(spark, [{**c, "event_data": c.get("event_data")} for c in lines()]), CFG).sessions
    columns = ("client_id", "session_start", "session_end", "event_count", "has_purchase")
    assert rows(got, *columns) == rows(batch, *columns)
    assert got.count() == 3


def test_first_arrival_of_an_id_is_kept(spark, tmp_path):
    got = run(spark, tmp_path, lambda s: st.stream_conversions(s, CFG), "live_conversions")
    assert [r.transaction_id for r in got.collect()] == ["t1"]


def test_daily_counters(spark, tmp_path):
    got = run(spark, tmp_path, lambda s: st.stream_daily_counters(s, CFG), "live_days")
    assert rows(got, "events", "null_clients", "conversions") == [(7, 1, 2)]


def test_batch_checks_run_on_every_batch(spark, tmp_path):
    files, seen = tmp_path / "in", []
    write_day(files / "events_20250301.csv", FULL, lines())
    stream = st.read_arriving_files(spark, str(files), CFG)
    query = st.each_batch(
        stream, lambda batch: seen.extend(rows(q.file_counters(batch, CFG), "source_file", "total_rows")), str(tmp_path / "c")
    ).trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert seen == [("events_20250301.csv", 7)]


def test_files_land_with_their_own_headers(spark, tmp_path):
    files, landed = tmp_path / "in", str(tmp_path / "landed")
    at = "2025-03-01T10:00:00.000Z"
    write_day(files / "events_20250301.csv", FULL, lines())
    write_day(files / "events_20250302.csv", BARE, [{"clientId": "c", "timestamp": at, "event_name": "page_viewed"}])
    (files / "notes.txt").write_text("nothing")

    def land():
        st.land_files(spark, str(files), landed, CFG, str(tmp_path / "c1")).trigger(availableNow=True).start().awaitTermination(240)

    land()
    write_day(files / "events_20250303.csv", ["timestamp", "clientId"], [{"clientId": "d", "timestamp": at}])
    land()
    stored = spark.read.parquet(f"{landed}/batch=*")
    assert rows(stored.filter("source_file > 'events_20250301.csv'"), "client_id", "timestamp", "event_name", "referrer") == [
        ("c", at, "page_viewed", ""), ("d", at, None, "")]
    assert stored.count() == 9

    query = st.stream_daily_counters(st.read_landed(spark, landed), CFG).writeStream.format("memory").queryName("landed_days").outputMode(
        "complete").option("checkpointLocation", str(tmp_path / "c2")).trigger(availableNow=True).start()
    query.awaitTermination(240)
    assert rows(spark.table("landed_days"), "events") == [(9,)]


def test_another_header_stops_a_plain_stream(spark, tmp_path):
    write_day(tmp_path / "in" / "events_20250301.csv", RENAMED[::-1], [{"clientId": "a", "event_name": "x"}])
    stream = st.read_arriving_files(spark, str(tmp_path / "in"), CFG)
    query = stream.writeStream.format("memory").queryName("wrong_header").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    with pytest.raises(Exception, match="events_20250301.csv"):
        query.awaitTermination(120)
