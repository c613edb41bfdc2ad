from __future__ import annotations

import hashlib
import json
from datetime import datetime
from urllib.parse import parse_qs, urlparse

import pytest
from helpers import raw, rows
from pyspark.sql import functions as F

from clickloom import Config
from clickloom.functions import basics, urls
from clickloom.functions.agents import browser, device_type
from clickloom.functions.channels import with_monitor_channel, with_traffic_source
from clickloom.functions.payload import is_json, to_number, with_payload
from clickloom.operators.conversions import purchase_record

CFG = Config()

URLS = [
    "https://shop.example/p?gclid=1&utm_campaign=a+b",
    "https://shop.example/p?gclid=&utm_source=&utm_source=second&x=1#utm_source=frag",
    "https://shop.example/p#f?utm_source=no",
    "https://shop.example/p?utm_source=a%20b%2Bc&utm_medium=%zz+%41",
    "https://U:p@Shop.Example:8080/p?q?utm_source=x&utm_source=y",
    "no-scheme.example/p?utm_source=ok",
    "//host.example/p",
    "",
    "https://shop.example?utm_source=%C3%A9",
]


def test_urls_match_the_standard_library(spark):
    frame = spark.createDataFrame([(u,) for u in URLS], "u string")
    query = urls.query_string(F.col("u"))
    got = frame.select(
        "u", query, urls.authority(F.col("u")),
        *[urls.query_param(query, k) for k in ("utm_source", "utm_medium", "utm_campaign")],
        urls.has_param(query, "gclid"),
    ).collect()
    for row in got:
        parsed = urlparse(row[0])
        params = parse_qs(parsed.query)
        assert row[1] == parsed.query
        assert row[2] == parsed.netloc.lower()
        for value, key in zip(row[3:6], ("utm_source", "utm_medium", "utm_campaign"), strict=True):
            assert value == params.get(key, [None])[0], (row[0], key)
        assert row[6] == ("gclid" in params)


# page_url, referrer -> source, medium, campaign, channel, monitoring channel
TRAFFIC = [
    ("https://shop.example/?gclid=1", None, "google", "cpc", "google_ads", "Paid Search", "Paid Search"),
    ("https://shop.example/?gclid=1&utm_campaign=c&utm_source=x", None, "google", "cpc", "c", "Paid Search", "Paid Search"),
    ("https://shop.example/?gclid=", "https://www.Google.com/", "google", "organic", "", "Organic Search", "Organic Search"),
    ("https://shop.example/?utm_source=Klaviyo", None, "Klaviyo", "none", "", "Email", "Email"),
    ("https://shop.example/?utm_source=news&utm_medium=EMAIL", None, "news", "EMAIL", "", "Email", "Email"),
    ("https://shop.example/?utm_source=facebook&utm_medium=cpc", None, "facebook", "cpc", "", "Paid Search", "Paid Search"),
    ("https://shop.example/?utm_source=facebook&fbclid=1", None, "facebook", "none", "", "Other", "Paid Social"),
    ("https://shop.example/?fbclid=1", "https://www.google.com/", "facebook", "cpc", "facebook_ads", "Paid Search", "Paid Social"),
    ("https://shop.example/?utm_source=p&utm_medium=affiliate", None, "p", "affiliate", "", "Affiliate", "Affiliate"),
    ("https://shop.example/?utm_source=affiliate", None, "affiliate", "none", "", "Affiliate", "Other"),
    ("https://shop.example/", "https://bing.com/x", "bing", "organic", "", "Organic Search", "Organic Search"),
    ("https://shop.example/", "https://m.facebook.com/", "facebook", "social", "", "Other", "Organic Social"),
    ("https://shop.example/", "https://l.instagram.com/", "l.instagram.com", "referral", "", "Referral", "Organic Social"),
    ("https://shop.example/", "https://shop.example/a", "internal", "internal", "", "Internal", "Direct"),
    ("https://shop.example/", "https://source-9.example/", "affiliate", "referral", "", "Affiliate", "Affiliate"),
    ("https://shop.example/", "https://me@News.example:81/", "me@news.example:81", "referral", "", "Referral", "Referral"),
    ("https://shop.example/", "google.com", "direct", "none", "", "Direct", "Direct"),
    (None, None, "direct", "none", "", "Direct", "Direct"),
    ("https://shop.example/", "", "direct", "none", "", "Direct", "Direct"),
]


def test_classifiers(spark):
    events = raw(spark, [{"page_url": t[0], "referrer": t[1]} for t in TRAFFIC])
    both = with_monitor_channel(with_traffic_source(events, CFG), CFG).orderBy("ingest_order.seq")
    got = both.select("traffic_source", "traffic_medium", "traffic_campaign", "marketing_channel", "monitor_channel").collect()
    for case, row in zip(TRAFFIC, got, strict=True):
        assert tuple(row) == case[2:], case


def test_paid_social_can_be_put_first(spark):
    events = raw(spark, [{"page_url": "https://shop.example/?fbclid=1"}])
    assert with_traffic_source(events, Config(paid_social_first=True)).first()["marketing_channel"] == "Paid Social"


@pytest.mark.parametrize(
    ("agent", "device", "name"),
    [
        (None, "Unknown", "Unknown"),
        ("", "Desktop", "Other"),
        ("iPad Safari", "Tablet", "Safari"),
        ("Android Tablet Firefox", "Tablet", "Firefox"),
        ("Android Chrome Mobile Safari", "Mobile", "Chrome"),
        ("Windows Chrome Safari Edg/1", "Desktop", "Edge"),
        ("Macintosh Safari", "Desktop", "Safari"),
    ],
)
def test_user_agents(spark, agent, device, name):
    frame = spark.createDataFrame([(agent,)], "a string")
    assert tuple(frame.select(device_type(F.col("a")), browser(F.col("a"))).first()) == (device, name)


JSON_TEXTS = [
    "{}", "[]", "1", "null", '"a"', '{"a": 1}', '{"a": [1, {"b": null}]}', '{"a": NaN}', '{"a": 1, "a": 2}', "  {} ",
    "", " ", "{", '{"a": 1} x', "{}{}", "1,2", "1],[2", '1},{"x":2', "{'a': 1}", "abc", '{"a": }', "[1,]",
]


def test_json_validity_matches_the_standard_library(spark):
    def valid(text: str) -> bool:
        try:
            json.loads(text)
        except ValueError:
            return False
        return True

    frame = spark.createDataFrame([(t,) for t in JSON_TEXTS], "t string")
    for text, got in frame.select("t", is_json(F.col("t"))).collect():
        assert got == valid(text), text
    assert spark.sql("select cast(null as string) t").select(is_json(F.col("t"))).first()[0] is None


def test_numbers_are_read_like_python_floats(spark):
    texts = ["1", " 2.5 ", "-3e2", "1_000", ".5", "5.", "5d", "0x1", "1__0", "abc", "", "+7"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    for text, got in frame.select("t", to_number(F.col("t"))).collect():
        try:
            expected = float(text)
        except ValueError:
            expected = None
        assert got == expected, text


def reference_record(text):
    """What a purchase record must hold, by the definition of the fields."""
    try:
        data = json.loads(text)
        return (data.get("transaction_id"), float(data.get("revenue", 0)), len(data.get("items", [])),
                data.get("user_email", "")[:16])
    except Exception:
        return (None, 0.0, 0, "")


PAYLOADS = [
    '{"transaction_id": "t1", "revenue": 12.5, "items": [{"item_price": 1}, {}], "user_email": "somebody@mail.example"}',
    '{"transaction_id": "t2", "revenue": "7.25"}',
    '{"transaction_id": "t3"}',
    '{"transaction_id": "t4", "revenue": null}',
    '{"transaction_id": "t5", "revenue": "free"}',
    '{"transaction_id": "t6", "revenue": 1, "items": null}',
    '{"transaction_id": "t7", "revenue": 1, "user_email": null}',
    '{"transaction_id": "t8", "revenue": 1, "user_email": 5}',
    '{"transaction_id": "t9", "revenue": true, "items": "abc"}',
    '{"transaction_id": null, "revenue": 3}',
    '[1, 2]', '5', 'null', '{bad', '{"revenue": 1} x', "{'revenue': 1}", '{"revenue": 1, "revenue": 2}',
]


def test_purchase_records(spark):
    cfg = Config(email_output="prefix")
    events = raw(spark, [{"event_name": "checkout_completed", "event_data": p} for p in PAYLOADS])
    got = with_payload(events, cfg).select("event_data", *purchase_record(cfg).values()).collect()
    assert len(got) == len(PAYLOADS)
    for row in got:
        assert tuple(row)[1:] == reference_record(row[0]), row[0]


def test_addresses_are_digested_by_default(spark):
    events = raw(spark, [{"event_name": "checkout_completed", "event_data": PAYLOADS[0]}])
    got = with_payload(events, CFG).select(purchase_record(CFG)["user_email_hash"]).first()[0]
    assert got == hashlib.sha256(b"somebody@mail.example").hexdigest()[:16]


def test_null_item_prices(spark):
    data = '{"items": [{"item_price": null}, {"sku": 1}, {"item_price": 0}, 5]}'
    events = raw(spark, [{"event_name": "purchase", "event_data": data}, {}])
    assert rows(with_payload(events, CFG), "payload.null_item_prices") == [(2,), (None,)]


def test_days_are_whole_periods(spark):
    frame = spark.createDataFrame(
        [(datetime(2025, 3, 1, 23), datetime(2025, 3, 3, 22)), (datetime(2025, 3, 1), datetime(2025, 2, 28, 23))],
        "a timestamp, b timestamp",
    )
    days = basics.whole_days(basics.micros(F.col("b")), basics.micros(F.col("a")))
    assert [r[0] for r in frame.select(days).collect()] == [1, -1]


def test_last_items(spark):
    frame = spark.createDataFrame([([1, 2],), (list(range(7)),)], "a array<int>")
    assert [r[0] for r in frame.select(basics.last_items(F.col("a"), 5)).collect()] == [[1, 2], [2, 3, 4, 5, 6]]


def test_repeated_keys_count_with_their_last_value(spark):
    texts = [
        '{"transaction_id":"t","revenue":5,"revenue":7,"items":[{"x":1,"x":2}],"user_email":"a"}',
        '{"transaction_id":"s","transaction_id":"t","revenue":5,"items":[{"item_price":null,"item_price":2},{"item_price":1,"item_price":null}],"user_email":"a"}',
        '{"a":1,"a":2}',
        '{"a":[1],"a":[2]}',
    ]
    from clickloom.functions.payload import is_json, with_payload

    frame = spark.createDataFrame([(t, "checkout_completed") for t in texts], "event_data string, event_name string")
    got = with_payload(frame, Config()).select("payload.*", is_json(F.col("event_data")).alias("valid")).collect()
    assert [r.valid for r in got] == [True] * 4 and all(r.is_object for r in got)
    assert [(r.transaction_id, r.revenue, r.item_count, r.null_item_prices) for r in got[:2]] == [("t", 7.0, 1, 1), ("t", 5.0, 2, 1)]


def test_sums_keep_every_value(spark):
    import math

    from clickloom.functions.basics import exact_sum

    def total(*values):
        return spark.createDataFrame([(v,) for v in values], "v double").agg(exact_sum(F.col("v"))).first()[0]

    assert total(1e13, 5.0, 0.1) == 10000000000005.1
    assert total(None, None) == 0.0 and total(0.1, 0.2) == 0.3
    assert math.isnan(total(1e12, float("nan"))) and total(1.0, float("inf")) == float("inf")
    assert total(1e25, 1.0) == 1e25
    assert abs(total(3e-7, 3e-7, 3e-7) - 9e-7) < 1e-15 and total(1e9, 4e-7) == 1e9 + 4e-7


def test_own_domain_is_no_sql(spark):
    from clickloom.functions.channels import with_monitor_channel, with_traffic_source

    cfg = Config(own_domain="it's\\own")
    frame = spark.createDataFrame([("https://x/", "https://it's\\own/a")], "page_url string, referrer string")
    assert with_traffic_source(frame, cfg).count() == with_monitor_channel(frame, cfg).count() == 1
