from __future__ import annotations

from test_files import CFG, FULL, RENAMED, folder, sale, write_day  # noqa: F401

from clickloom.plans.monitor import run_monitoring
from clickloom.plans.profiles import ProfileStore
from clickloom.plans.validate import run_validation
from clickloom.sources.daily_files import read_daily_files
from clickloom.sources.sinks import store_events


def whole(frame):
    return sorted(repr(sorted(r.asDict(recursive=True).items())) for r in frame.collect())


def check(spark, store, source, scratch):
    events, headers = read_daily_files(spark, str(source), CFG, fill_referrer=False)
    events = store_events(events, str(scratch))
    stored, direct = store.validation(), run_validation(events, headers, CFG)
    for name in stored:
        assert whole(stored[name]) == whole(direct[name]), name
    stored, direct = store.monitoring(), run_monitoring(events, CFG, headers)
    for name in stored:
        assert whole(stored[name].drop("channels")) == whole(direct[name].drop("channels")), name


def test_days_one_after_the_other(spark, folder, tmp_path_factory):  # noqa: F811
    store = ProfileStore(spark, str(tmp_path_factory.mktemp("profiles")), CFG)
    assert store.take_folder(str(folder)) == 1
    write_day(folder / "events_20250304.csv", RENAMED, [sale("t2", 7, clientId="z", timestamp="2025-03-04T10:00:00.000Z")])
    write_day(folder / "events_20250302.csv", FULL, [{"client_id": "b", "timestamp": "bad", "event_name": "nonsense"}])
    assert store.take_folder(str(folder)) == 2
    check(spark, store, folder, tmp_path_factory.mktemp("raw"))
    assert store.take_folder(str(folder)) == 2


def test_stored_days_need_their_files_no_more(spark, folder, tmp_path_factory):  # noqa: F811
    store = ProfileStore(spark, str(tmp_path_factory.mktemp("profiles")), CFG)
    store.take_folder(str(folder))
    (folder / "events_20250301.csv").unlink()
    write_day(folder / "events_20250304.csv", FULL, [sale("t1", 7, client_id="z", timestamp="2025-03-04T10:00:00.000Z")])
    store.take_folder(str(folder))
    assert {(r.transaction_id, r.occurrences) for r in store.validation()["cross_file_duplicates"].collect()} == {("t1", 3)}
    assert store.monitoring()["verdicts"].count() == 4
