from __future__ import annotations

import random
from collections import defaultdict
from datetime import datetime, timedelta

from helpers import raw, rows
from pyspark.sql import functions as F

from clickloom import Config
from clickloom.operators import sessions as se
from clickloom.plans.transform import Derived

CFG = Config()
START = datetime(2025, 3, 1, 10)


def stamp(after: timedelta) -> str:
    return (START + after).strftime("%Y-%m-%dT%H:%M:%S.%f")[:-3] + "Z"


def numbers(spark, cells: list[dict], cfg=CFG) -> list[str]:
    """Session ids in input order."""
    enriched = Derived(raw(spark, cells), cfg).events_enriched
    return [r[0] for r in enriched.orderBy("ingest_order.seq").select("session_id").collect()]


def test_gap_bounds_and_missing_times(spark):
    minute = timedelta(minutes=1)
    cells = [{"timestamp": stamp(t)} for t in (
        timedelta(0), timedelta(0), 30 * minute - timedelta(milliseconds=1), 60 * minute - timedelta(milliseconds=1),
        90 * minute, 120 * minute,
    )]
    cells += [{"timestamp": None}, {"timestamp": None}, {"client_id": "b", "timestamp": None}]
    assert numbers(spark, cells) == ["a_1", "a_1", "a_1", "a_1", "a_2", "a_2", "a_3", "a_4", "b_1"]


def brute_force(cells: list[dict], gap: timedelta) -> list[str]:
    by_client = defaultdict(list)
    for i, cell in enumerate(cells):
        by_client[cell["client_id"]].append((cell["timestamp"] is None, cell["timestamp"] or "", i))
    ids = [""] * len(cells)
    for client, events in by_client.items():
        number, last = 0, None
        for missing, text, i in sorted(events):
            at = None if missing else datetime.fromisoformat(text)
            if at is None or last is None or at - last > gap:
                number += 1
            last = at
            ids[i] = f"{client}_{number}"
    return ids


def test_against_brute_force_with_one_heavy_client(spark):
    rng = random.Random(7)
    cells = []
    for _ in range(600):
        client = "bot" if rng.random() < 0.4 else f"c{rng.randrange(8)}"
        after = timedelta(minutes=rng.randrange(0, 3000), milliseconds=rng.choice([0, 0, 1, 999]))
        cells.append({"client_id": client, "timestamp": None if rng.random() < 0.03 else stamp(after)})
    assert numbers(spark, cells) == brute_force(cells, CFG.session_gap)


def test_sessions_take_the_first_known_value_per_column(spark):
    cells = [
        {"timestamp": stamp(timedelta(0)), "page_url": None},
        {"timestamp": stamp(timedelta(minutes=1)), "page_url": "https://shop.example/?gclid=1", "referrer": "https://bing.com/",
         "user_agent": "iPad Safari", "event_name": "checkout_started"},
        {"timestamp": stamp(timedelta(minutes=2)), "referrer": "https://late.example/"},
    ]
    got = Derived(raw(spark, cells), CFG).sessions.first()
    assert (got.landing_page, got.referrer, got.user_agent) == ("https://shop.example/?gclid=1", "https://bing.com/", "iPad Safari")
    assert (got.traffic_source, got.marketing_channel) == ("direct", "Direct")
    assert (got.event_count, got.session_duration_seconds) == (3, 120.0)
    assert (got.has_checkout_started, got.has_purchase) == (True, False)
    assert (got.device_type, got.browser) == ("Tablet", "Safari")


def test_incremental_update_equals_the_whole(spark):
    rng = random.Random(3)
    cells = [{"client_id": f"c{rng.randrange(5)}", "timestamp": stamp(timedelta(minutes=rng.randrange(0, 900)))} for _ in range(150)]
    whole = Derived(raw(spark, cells), CFG)
    events = whole.events
    first = F.col("ingest_order.seq") < 100
    stored = se.summarise_chunks(events.filter(first), CFG)
    late = events.filter(~first & (F.col("client_id") != "c0"))
    chunks, updated = se.incremental_sessions(stored, late, CFG)
    expected = Derived(raw(spark, [c for i, c in enumerate(cells) if i < 100 or c["client_id"] != "c0"]), CFG).sessions
    assert rows(updated, "session_id", "event_count", "session_end") == rows(
        expected.filter("client_id <> 'c0'"), "session_id", "event_count", "session_end")
    again = se.sessions_from_chunks(se.number_chunks(chunks, CFG))
    assert rows(again, "session_id", "event_count") == rows(expected, "session_id", "event_count")


def test_rejects_and_missing_clients(spark):
    from clickloom.operators.cleaning import clean_events, parse_event_time

    cells = [{"timestamp": "soon"}, {"timestamp": "12:30"}, {"timestamp": None}, {"client_id": ""}, {"client_id": None}, {}]
    events = raw(spark, cells)
    kept, rejected = parse_event_time(events, CFG)
    assert (kept.count(), rejected.count()) == (4, 2)
    assert clean_events(events, CFG).count() == 2


def test_sessions_are_built_with_two_exchanges(spark):
    """The chunk aggregate and the window each shuffle once; the sessions reuse the second."""
    frame = Derived(raw(spark, [{}]), CFG).sessions
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2
    assert "partial_min" in plan


def test_a_heavy_client_meets_in_few_rows(spark):
    """However many events a client sends, the window sees at most (time / gap) rows of it."""
    day = timedelta(days=1)
    events = Derived(raw(spark, [{"timestamp": stamp(day * i / 4000)} for i in range(4000)]), CFG).events
    assert se.summarise_chunks(events, CFG).count() == 48


def test_shared_folder(spark):
    from clickloom.session import shared_folder

    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
