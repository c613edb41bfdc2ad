from __future__ import annotations

from helpers import purchase, raw, rows

from clickloom import Config, MonitorLimits
from clickloom.config import EXPECTED_COLUMNS
from clickloom.operators import monitoring as m
from clickloom.operators.cleaning import normalise_schema
from clickloom.plans.monitor import run_monitoring

CFG = Config(monitor=MonitorLimits(min_daily_events=1, max_daily_events=50, min_daily_conversions=1, min_daily_revenue=10.0))


def day(n: int) -> str:
    return f"events_202503{n:02d}.csv"


def names(spark, cells, cfg=CFG, headers=None):
    found = run_monitoring(raw(spark, cells), cfg, headers)["alerts"].collect()
    return {(r.source_file, r.name) for r in found}


HEALTHY = [
    {"client_id": "d", "event_name": "checkout_started"}, {"client_id": "p", "page_url": "https://shop.example/?gclid=1"},
    {"client_id": "p", "event_name": "product_added_to_cart"}, {"client_id": "q", "event_name": "checkout_started"},
    purchase("1", 20, client_id="q"),
]


def test_a_healthy_day_is_quiet(spark):
    assert names(spark, HEALTHY) == set()
    verdict = run_monitoring(raw(spark, HEALTHY), CFG)["verdicts"]
    assert rows(verdict) == [(day(1), False)]


def test_threshold_alerts(spark):
    found = names(spark, [{"client_id": None}] * 51)
    assert {n for _, n in found} == {"high_event_volume", "null_client_rate", "low_revenue", "low_conversions"}


def test_cart_without_purchase_and_concentration(spark):
    cells = [{"client_id": f"c{i}", "event_name": "product_added_to_cart"} for i in range(5)]
    found = {n for _, n in names(spark, cells)}
    assert found == {"low_revenue", "low_conversions", "zero_conversions", "traffic_concentration", "missing_channel"}
    # A share of exactly 0.8 is no concentration.
    cells[0]["page_url"] = "https://shop.example/?gclid=1"
    found = {n for _, n in names(spark, cells)}
    assert "traffic_concentration" not in found and "missing_channel" not in found


def test_inverted_funnel(spark):
    assert "funnel_inverted" in {n for _, n in names(spark, [*HEALTHY, purchase("2", client_id="x"), purchase("3", client_id="y")])}


def test_duplicates_count_missing_ids_as_one(spark):
    cells = [purchase(None, 1), purchase(None, 2), purchase("a"), purchase("a"), purchase("a"), purchase("b"),
             {"event_name": "checkout_completed", "event_data": "{"}, {"event_name": "checkout_completed", "event_data": '{"revenue": null}'}]
    conversions = m.daily_conversions(raw(spark, cells), CFG)
    assert conversions.count() == 6
    assert rows(m.surplus_duplicates(conversions)) == [(day(1), 3)]
    found = run_monitoring(raw(spark, cells), CFG)["alerts"].filter("name = 'duplicate_transactions'").first()
    assert (found.current_value, found.threshold, found.severity) == (3.0, 0.0, "CRITICAL")


def week(spark, revenues):
    cells = []
    for n, revenue in enumerate(revenues, start=1):
        for row in HEALTHY[:-1]:
            cells.append({**row, "source_file": day(n)})
        cells.append(purchase(f"t{n}", revenue, client_id="q", source_file=day(n)))
    return cells


def test_baseline_needs_seven_days(spark):
    assert names(spark, week(spark, [20, 30, 20, 30, 20, 900])) == set()


def test_deviations_from_the_fixed_baseline(spark):
    # Days 1-7: mean 25, sample deviation 5; day 8 is exactly 2.5 deviations up, day 9 more.
    revenues = [20, 20, 20, 25, 30, 30, 30, 37.5, 37.6]
    found = names(spark, week(spark, revenues))
    assert found == {(day(8), "aov_anomaly"), (day(9), "aov_anomaly"), (day(9), "revenue_anomaly")}
    history = m.history_metrics(normalise_schema(raw(spark, week(spark, revenues)), CFG), CFG)
    baseline = m.baseline_stats(history, CFG)
    stats = {r.metric: r for r in baseline.collect()}
    assert (stats["revenue"].mean, stats["revenue"].std) == (25.0, 5.0)
    scores = m.metric_zscores(history, baseline, CFG).filter("source_file = 'events_20250309.csv' and metric = 'revenue'").first()
    assert round(scores.z_score, 6) == 2.52 and scores.is_anomaly
    rolling = m.rolling_baseline(history, CFG).filter("metric = 'revenue'").orderBy("source_file").collect()
    assert [round(r["mean"], 4) for r in rolling] == [25.0, 27.5]


def test_no_variation_scores_zero(spark):
    found = run_monitoring(raw(spark, week(spark, [20] * 8)), CFG)
    assert found["alerts"].count() == 0
    assert {r.z_score for r in found["metrics"].filter("metric_name = 'daily_revenue'").collect()} == {0.0}


def test_days_without_conversions_have_no_order_value(spark):
    got = run_monitoring(raw(spark, [{}]), CFG)["metrics"]
    assert "average_order_value" not in {r.metric_name for r in got.collect()}


def test_client_sessions_take_the_channel_of_the_first_row(spark):
    cells = [{"page_url": "https://shop.example/?fbclid=1", "timestamp": "2025-03-01T23:00:00.000Z"},
             {"page_url": "https://shop.example/?gclid=1"}, {"client_id": ""}, {"client_id": None}]
    assert rows(m.daily_client_sessions(raw(spark, cells), CFG), "session_id", "marketing_channel") == [("a_1", "Paid Social")]


def test_missing_column_alert(spark):
    bare = [c for c in EXPECTED_COLUMNS if c not in ("referrer", "user_agent")]
    table = spark.createDataFrame([(day(1), bare)], "source_file string, columns array<string>")
    assert names(spark, HEALTHY, headers=table) == {(day(1), "schema_change")}
    only_referrer = spark.createDataFrame([(day(1), [c for c in EXPECTED_COLUMNS if c != "referrer"])], table.schema)
    assert names(spark, HEALTHY, headers=only_referrer) == set()
