from __future__ import annotations

import os

import pytest
from helpers import rows
from test_files import CFG, FULL, RENAMED, write_day

from clickloom.plans.incremental import SessionStore
from clickloom.plans.transform import Derived
from clickloom.sources.daily_files import read_daily_files


def views(day, clients, hour=10, page="x"):
    return [
        {"client_id": c, "clientId": c, "timestamp": f"2025-03-{day:02d}T{hour}:00:00.000Z", "event_name": "page_viewed", "page_url": f"https://shop.example/{page}"}
        for c in clients
    ]


def everything(frame):
    return sorted(map(repr, frame.drop("session_number").collect()))


def whole_run(spark, folder):
    return everything(Derived(read_daily_files(spark, str(folder), CFG)[0], CFG).sessions)


@pytest.fixture
def store(spark, tmp_path):
    (tmp_path / "in").mkdir()
    return SessionStore(spark, str(tmp_path / "store"), CFG)


def test_days_come_and_change(spark, store, tmp_path):
    folder = tmp_path / "in"
    write_day(folder / "events_20250301.csv", FULL, views(1, "abc", hour=23))
    write_day(folder / "events_20250302.csv" / "part-0.csv", RENAMED, views(2, "bd"))
    assert store.take_folder(str(folder)) == 1
    assert everything(store.sessions()) == whole_run(spark, folder)
    assert store.take_folder(str(folder)) == 1  # nothing new

    write_day(folder / "events_20250303.csv", FULL, views(3, "be"))
    assert store.take_folder(str(folder)) == 2
    assert everything(store.sessions()) == whole_run(spark, folder)
    assert rows(store.history(), "version", "days", "files", "clients") == [(1, 2, 2, 4), (2, 1, 1, 2)]
    assert {r.client_id for r in spark.read.parquet(f"{store.folder}/sessions/version=2").collect()} == {"b", "e"}

    # Another file for an old day: the day is read whole again, clients that it had and has are renumbered.
    write_day(folder / "events_20250302.csv" / "part-1.csv", FULL, views(2, "f"))
    assert store.take_folder(str(folder)) == 3
    assert everything(store.sessions()) == whole_run(spark, folder)

    # A day is delivered anew, without client c: c loses its session, a keeps its own.
    write_day(folder / "events_20250301.csv", FULL, views(1, "a", page="new"))
    assert store.take_folder(str(folder)) == 4
    assert everything(store.sessions()) == whole_run(spark, folder)
    assert "c" not in {r.client_id for r in store.sessions().collect()}

    before = everything(store.sessions())
    assert store.compact() == 5 and everything(store.sessions()) == before
    write_day(folder / "events_20250304.csv", FULL, views(4, "ag"))
    assert store.take_folder(str(folder)) == 6 and everything(store.sessions()) == whole_run(spark, folder)


def test_old_files_are_not_read_again(spark, store, tmp_path):
    folder = tmp_path / "in"
    write_day(folder / "events_20250301.csv", FULL, views(1, "ab"))
    store.take_folder(str(folder))
    first = whole_run(spark, folder)
    (folder / "events_20250301.csv").unlink()
    write_day(folder / "events_20250302.csv", FULL, views(2, "cd"))
    store.take_folder(str(folder))
    assert everything(store.sessions()) == sorted([*first, *whole_run(spark, folder)])


def test_a_run_that_died_leaves_no_trace(spark, store, tmp_path, monkeypatch):
    folder = tmp_path / "in"
    write_day(folder / "events_20250301.csv", FULL, views(1, "ab"))
    store.take_folder(str(folder))
    before = everything(store.sessions())
    write_day(folder / "events_20250302.csv", FULL, views(2, "bc"))

    def die(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(SessionStore, "_commit", die)
        with pytest.raises(RuntimeError):
            store.take_folder(str(folder))
    assert os.path.exists(f"{store.folder}/sessions/version=2")
    assert everything(store.sessions()) == before and rows(store.files(), "source_file") == [("events_20250301.csv",)]
    assert store.take_folder(str(folder)) == 2
    assert everything(store.sessions()) == whole_run(spark, folder)


def test_sessions_run_over_midnight_and_files(spark, store, tmp_path):
    folder = tmp_path / "in"
    late = [{"client_id": "a", "timestamp": "2025-03-01T23:50:00.000Z", "event_name": "page_viewed"}]
    early = [{"client_id": "a", "timestamp": "2025-03-02T00:10:00.000Z", "event_name": "checkout_completed"}, {"client_id": "a", "event_name": "page_viewed"}]
    write_day(folder / "events_20250301.csv", FULL, late)
    store.take_folder(str(folder))
    write_day(folder / "events_20250302.csv", FULL, early)
    store.take_folder(str(folder))
    assert everything(store.sessions()) == whole_run(spark, folder)
    assert rows(store.sessions(), "session_id", "event_count", "has_purchase") == [("a_1", 2, True), ("a_2", 0, False)]
    assert rows(store.sessions(version=1), "session_id", "event_count") == [("a_1", 1)]
