from __future__ import annotations

import random
from datetime import datetime, timedelta

from helpers import purchase, raw, rows

from clickloom import Config
from clickloom.operators import attribution as at
from clickloom.operators import journeys as jo
from clickloom.operators import reports
from clickloom.plans.transform import Derived

CFG = Config()
BUY = datetime(2025, 3, 10, 12)
ADS = "https://shop.example/?gclid=1"
MAIL = "https://shop.example/?utm_source=klaviyo"


def stamp(t: datetime) -> str:
    return t.strftime("%Y-%m-%dT%H:%M:%S.%f")[:-3] + "Z"


def visit(t: datetime, **row) -> dict:
    return {"timestamp": stamp(t), **row}


def test_the_lowest_client_wins_among_duplicates(spark):
    cells = [
        purchase("x", 5, client_id="b", timestamp=stamp(BUY)),
        purchase("x", 7, client_id="a", timestamp=stamp(BUY + timedelta(days=1))),
        purchase(None, 1, client_id="c"), purchase(None, 2, client_id="a"),
    ]
    d = Derived(raw(spark, cells), CFG)
    assert rows(d.conversions, "transaction_id", "client_id", "revenue") == [("x", "a", 7.0), (None, "a", 2.0)]
    early = Derived(raw(spark, cells[:2]), Config(dedupe_order="time"))
    assert rows(early.conversions, "client_id", "session_id") == [("b", "b_1")]


def test_lookback_bounds(spark):
    week, ms = timedelta(days=7), timedelta(milliseconds=1)
    cells = [
        visit(BUY - week, client_id="on", page_url=ADS), purchase("1", client_id="on", timestamp=stamp(BUY)),
        visit(BUY - week - ms, client_id="out", page_url=ADS), purchase("2", client_id="out", timestamp=stamp(BUY), page_url=MAIL),
        visit(BUY, client_id="same", referrer="https://shop.example/"), purchase("3", client_id="same", timestamp=stamp(BUY)),
    ]
    got = {r["transaction_id"]: r for r in Derived(raw(spark, cells), CFG).attribution.collect()}
    assert (got["1"].first_click_channel, got["1"].last_click_channel) == ("Paid Search", "Direct")
    assert (got["1"].touchpoint_count, got["1"].days_to_convert) == (2, 7)
    assert (got["2"].first_click_channel, got["2"].touchpoint_count) == ("Email", 1)
    # Only an internal session: nothing to credit but direct.
    assert (got["3"].first_click_source, got["3"].first_click_channel, got["3"].touchpoint_count) == ("direct", "Direct", 0)


def test_attribution_against_brute_force(spark):
    rng = random.Random(11)
    urls = [ADS, MAIL, "https://shop.example/", "https://shop.example/?utm_source=p&utm_medium=affiliate"]
    cells = []
    for i in range(300):
        client = "bot" if rng.random() < 0.4 else f"c{rng.randrange(6)}"
        when = stamp(datetime(2025, 3, 1) + timedelta(minutes=rng.randrange(40000)))
        own = "https://shop.example/" if rng.random() < 0.3 else None
        row = {"client_id": client, "timestamp": when, "page_url": rng.choice(urls), "referrer": own}
        cells.append(purchase(f"t{i}", i, **row) if rng.random() < 0.3 else row)
    d = Derived(raw(spark, cells), CFG)
    sessions = d.sessions.collect()
    bought = d.purchases.collect()
    expected = []
    for c in bought:
        touches = sorted(
            (s.session_start, s.marketing_channel) for s in sessions
            if s.client_id == c.client_id and s.marketing_channel != "Internal"
            and c.conversion_timestamp - CFG.lookback <= s.session_start <= c.conversion_timestamp
        )
        first, last = (touches[0][1], touches[-1][1]) if touches else ("Direct", "Direct")
        days = (c.conversion_timestamp - touches[0][0]).days if touches else 0
        expected.append((c.transaction_id, first, last, len(touches), days))
    got = rows(d.attribution, "transaction_id", "first_click_channel", "last_click_channel", "touchpoint_count", "days_to_convert")
    assert got == sorted(expected, key=repr)
    # Both models credit the same money, and so does the shared one.
    totals = {r[0]: r[1] for r in d.channel_summary.groupBy("attribution_model").sum("revenue").collect()}
    assert totals["first_click"] == totals["last_click"] == sum(c.revenue for c in bought)
    linear = at.linear_attribution(d.purchases, d.sessions, CFG).agg({"revenue": "sum"}).first()[0]
    assert abs(linear - totals["first_click"]) < 0.01


def test_journeys(spark):
    hours = [timedelta(hours=h) for h in range(0, 14, 2)]
    cells = [visit(BUY + h, client_id="long", page_url=MAIL if i % 2 else None) for i, h in enumerate(hours)]
    cells += [purchase("1", 9, client_id="long", timestamp=stamp(BUY + timedelta(hours=2))),
              purchase("2", 4, client_id="long", timestamp=stamp(BUY + timedelta(hours=4)))]
    cells += [visit(BUY, client_id="none")]
    d = Derived(raw(spark, cells), CFG)
    got = d.user_journeys.collect()
    assert len(got) == 1
    assert tuple(got[0])[:6] == ("long", 7, 9, 0, 2, "Direct > Email > Direct > Email > Direct")
    assert got[0].revenue == 9.0 and got[0].converted
    again = jo.repeat_journeys(d.sessions, d.conversions, CFG)
    assert rows(again, "transaction_id", "conversion_number", "sessions_so_far") == [("1", 1, 2), ("2", 2, 3)]


def test_empty_conversions_give_empty_typed_tables(spark):
    d = Derived(raw(spark, [{}]), CFG)
    assert d.channel_summary.count() == 0
    assert d.user_journeys.count() == 0
    assert rows(reports.kpi_summary(d.sessions, d.purchases)) == [(0.0, 0, 0.0, 0.0)]


def test_funnel_report(spark):
    cells = [{"client_id": c, "event_name": e} for c, e in (
        ("a", "page_viewed"), ("a", "product_added_to_cart"), ("b", "page_viewed"), ("c", "product_added_to_cart"),
        ("c", "checkout_started"), ("d", "page_viewed"))]
    got = reports.funnel_report(Derived(raw(spark, cells), CFG).sessions)
    assert [tuple(r) for r in got.orderBy("step_number").collect()] == [
        (1, "sessions", 4, 100.0, None), (2, "add_to_cart", 2, 50.0, 50.0),
        (3, "checkout_started", 1, 25.0, 50.0), (4, "purchase", 0, 0.0, 100.0)]
