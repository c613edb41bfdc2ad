from __future__ import annotations

import pytest
from helpers import rows
from test_files import BARE, CFG, FULL, RENAMED, folder, write_day  # noqa: F401

from clickloom.sources.catalog import column_names, data_files, day_headers, header_reader, read_catalog, scans
from clickloom.sources.daily_files import read_daily_files


def test_one_row_per_file(spark, folder):  # noqa: F811
    found = {r.path.split("/")[-1]: r for r in read_catalog(spark, str(folder)).collect()}
    assert sorted(found) == ["events_20250301.csv", "events_20250302.csv", "part-0.csv", "part-1.csv"]
    assert found["events_20250302.csv"]["columns"] == RENAMED and found["part-1.csv"]["columns"] == BARE
    assert found["part-1.csv"].source_file == "events_20250303.csv"
    assert found["part-1.csv"].length == (folder / "events_20250303.csv" / "part-1.csv").stat().st_size


def test_only_the_chosen_files(spark, folder):  # noqa: F811
    listed = data_files(spark, str(folder)).filter("source_file < 'events_20250303.csv'")
    assert rows(read_catalog(spark, str(folder), listed), "source_file") == [("events_20250301.csv",), ("events_20250302.csv",)]
    assert read_catalog(spark, str(folder), listed.filter("false")).count() == 0


def test_a_task_stops_behind_the_header():
    asked = []

    def lines():
        for i in range(100):
            asked.append(i)
            yield "f", 0, "" if i == 0 else "a,b"

    assert list(header_reader()(lines())) == [("f", "a,b")]
    assert asked == [0, 1]
    assert list(header_reader()(iter([("f", 9, "x")]))) == []


@pytest.mark.parametrize("line", ["a,b", '"a, b",c', "", "a,,b", "a,A,b", 'x,"q""q",'])
def test_names_are_those_spark_gives(spark, tmp_path, line):
    (tmp_path / "f.csv").write_text(line + "\n1\n")
    names = spark.read.options(header="true", quote='"', escape='"').csv(str(tmp_path / "f.csv")).columns
    assert column_names(line) == (names if line else [])


def test_scans_take_whole_days_where_they_can(spark, folder):  # noqa: F811
    write_day(folder / "events_20250304.csv" / "part-0.csv", FULL, [{"client_id": "x", "timestamp": "2025-03-04T10:00:00.000Z"}])
    write_day(folder / "events_20250304.csv" / "part-1.csv", RENAMED, [{"clientId": "y", "timestamp": "2025-03-04T10:00:00.000Z"}])
    (folder / "events_20250305.csv").write_text("")
    catalog = read_catalog(spark, str(folder))
    names = {k: [p.split("events_")[1] for p in v] for k, v in scans(catalog).items()}
    assert names == {
        tuple(FULL): ["20250301.csv", "20250304.csv/part-0.csv"],
        tuple(RENAMED): ["20250302.csv", "20250304.csv/part-1.csv"],
        tuple(BARE): ["20250303.csv"],
    }
    headers = {r.source_file: r["columns"] for r in day_headers(catalog).collect()}
    assert headers["events_20250304.csv"] == FULL[1:] and headers["events_20250305.csv"] == []
    events, _ = read_daily_files(spark, str(folder), CFG)
    assert events.filter("source_file = 'events_20250304.csv'").count() == 2


def test_names_with_blanks_and_long_files(spark, tmp_path):
    lines = [{"client_id": f"c{i}", "timestamp": "2025-03-01T10:00:00.000Z"} for i in range(5000)]
    write_day(tmp_path / "a folder + 100%" / "events_20250301.csv", FULL, lines)
    events, headers = read_daily_files(spark, str(tmp_path), CFG)
    assert events.count() == 5000 and headers.first()["columns"] == FULL


def test_empty_files_only(spark, tmp_path):
    (tmp_path / "events_20250301.csv").write_text("\n\n")
    events, headers = read_daily_files(spark, str(tmp_path), CFG)
    assert events.count() == 0 and rows(headers) == [("events_20250301.csv", [])]


def test_many_part_files_in_one_job(spark, tmp_path):
    day = tmp_path / "events_20250301.csv"
    day.mkdir()
    for i in range(300):
        (day / f"part-{i}.csv").write_text(",".join(FULL) + f"\nc{i},,,2025-03-01T10:00:00.000Z,page_viewed,,\n")
    events, headers = read_daily_files(spark, str(tmp_path), CFG)
    assert headers.first()["columns"] == FULL and events.select("client_id").distinct().count() == 300
    assert len(scans(read_catalog(spark, str(tmp_path)))[tuple(FULL)]) == 1
