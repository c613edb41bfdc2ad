"""Named queries over the given tables. Each takes (spark, folder) and returns a DataFrame.

Times are shown as text, and ratios are rounded, so that results compare across engines.
"""

from __future__ import annotations

import re as regex
from collections.abc import Callable
from datetime import timedelta
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from clickloom.config import Config, MonitorLimits, QualityLimits
from clickloom.functions.agents import browser, device_type
from clickloom.functions.channels import with_monitor_channel, with_traffic_source
from clickloom.functions.payload import is_json, with_payload
from clickloom.functions.urls import authority, decode, has_param, query_param, query_string
from clickloom.operators import attribution as at
from clickloom.operators import cleaning as cl
from clickloom.operators import journeys as jo
from clickloom.operators import monitoring as mo
from clickloom.operators import quality as qu
from clickloom.operators import reports as re
from clickloom.operators import sessions as se
from clickloom.operators.conversions import purchase_record, transactions
from clickloom.operators.reconcile import reconciliation
from clickloom.plans.incremental import SessionStore
from clickloom.plans.monitor import monitored_days
from clickloom.plans.profiles import ProfileStore
from clickloom.plans.transform import Derived
from clickloom.session import shared_folder
from clickloom.sources.daily_files import read_daily_files
from clickloom.sources.sinks import CSV_OUTPUT, ORDER, row_counts, write_alerts, write_table, write_tables
from clickloom.sources.event_table import HEADER, raw_clickstream, raw_headers

Query = Callable[[SparkSession, str], DataFrame]

# The given users act about twice a day, so a wide gap makes sessions of several events; the
# limits are set near the daily figures at sf 0.01, so that days fall on both sides.
CFG = Config(
    session_gap=timedelta(hours=6),
    quality=QualityLimits(min_daily_events=310, max_daily_events=350, max_orphan_rate=0.25),
    monitor=MonitorLimits(
        min_daily_events=310, max_daily_events=350, min_daily_conversions=55,
        min_daily_revenue=1000.0, max_null_client_rate=0.1, revenue_z=1.5, aov_z=1.2,
        conversions_z=1.5, events_z=1.5, max_channel_share=0.41,
    ),
)
HALF_HOUR = Config()

QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Register under the function's name; a trailing underscore is not part of it."""
    QUERIES[fn.__name__.removesuffix("_")] = fn
    return fn


# --- inputs and formatting ------------------------------------------------------------


def _raw(spark: SparkSession, folder: str) -> DataFrame:
    return raw_clickstream(spark, folder)


def _derived(spark: SparkSession, folder: str, cfg: Config = CFG) -> Derived:
    return Derived(_raw(spark, folder), cfg)


def _profile(spark: SparkSession, folder: str, checks=qu.CHECKS) -> DataFrame:
    raw = _raw(spark, folder)
    return qu.file_profile(raw, raw_headers(raw), CFG, checks)


def _results(spark: SparkSession, folder: str, checks=qu.CHECKS) -> DataFrame:
    return qu.dq_results(_profile(spark, folder, checks), CFG, checks)


def _days(spark: SparkSession, folder: str) -> DataFrame:
    raw = _raw(spark, folder)
    return monitored_days(raw, CFG, raw_headers(raw))


def _written(spark: SparkSession, folder: str) -> str:
    """The clickstream as a folder of daily files, each with the header of its day; made anew for every query."""
    path = f"{shared_folder(spark)}/daily-{uuid4().hex}"
    raw = _raw(spark, folder)
    raw = raw.join(F.broadcast(raw_headers(raw)), "source_file")  # one row a day
    for header in regex.findall("'([^']+)'", HEADER):
        names = header.split(",")
        cells = [F.lit("").alias(c) if c == "debug" else F.col("client_id" if c == "clientId" else c).alias(c) for c in names]
        part = raw.filter(F.array_join("columns", ",") == header).select(*cells, "source_file")
        part.write.mode("append").partitionBy("source_file").options(**CSV_OUTPUT).csv(path)
    return path


def _file_results(spark: SparkSession, folder: str, check: str) -> DataFrame:
    events, headers = read_daily_files(spark, _written(spark, folder), CFG, fill_referrer=False)
    return qu.dq_results(qu.file_profile(events.drop(cl.CORRUPT), headers, CFG, (check,)), CFG, (check,))


def _time(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSS").alias(column)


def _date(column: str) -> Column:
    return F.col(column).cast("string").alias(column)


def _round(column: str, digits: int = 6) -> Column:
    return F.round(F.col(column).cast("double"), digits).alias(column)


def _rounded(frame: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return frame.withColumns({c: _round(c, digits) for c in columns})


def _show_times(frame: DataFrame) -> DataFrame:
    shown = {
        f.name: _time(f.name) if f.dataType.typeName() == "timestamp" else _date(f.name)
        for f in frame.schema.fields
        if f.dataType.typeName() in ("timestamp", "date")
    }
    return frame.withColumns(shown)


# --- loading and cleaning -------------------------------------------------------------


def _header_variants(raw: DataFrame) -> list[DataFrame]:
    """The days before, between and after the two header changes."""
    day = F.substring("source_file", 14, 2).cast("int")
    old = raw.filter(day < 10)
    renamed = raw.filter((day >= 10) & (day < 26)).withColumnRenamed("client_id", "clientId")
    bare = raw.filter(day >= 26).withColumnRenamed("client_id", "clientId").drop("referrer")
    return [old, renamed, bare]


@query
def ingest_daily_files(spark: SparkSession, folder: str) -> DataFrame:
    """The clickstream written as daily CSV folders with changing headers, and read back."""
    path = f"{shared_folder(spark)}/daily-{uuid4().hex}"
    for part in _header_variants(_raw(spark, folder)):
        cells = part.drop("ingest_order", "event_id")
        cells.write.mode("append").partitionBy("source_file").options(**CSV_OUTPUT).csv(path)
    events, _ = read_daily_files(spark, path, CFG)
    return events.drop("ingest_order", cl.CORRUPT)


@query
def file_headers(spark: SparkSession, folder: str) -> DataFrame:
    """The headers that the files of each day really have, read back from what was written."""
    path = f"{shared_folder(spark)}/daily-{uuid4().hex}"
    for part in _header_variants(_raw(spark, folder)):
        cells = part.drop("ingest_order", "event_id")
        cells.write.mode("append").partitionBy("source_file").options(**CSV_OUTPUT).csv(path)
    _, headers = read_daily_files(spark, path, CFG)
    return headers.select("source_file", F.array_join("columns", ",").alias("columns"))


@query
def normalise_schema(spark: SparkSession, folder: str) -> DataFrame:
    """Three header variants, each with the columns its days really have, made alike."""
    parts = [cl.null_out_tokens(p, CFG) for p in _header_variants(_raw(spark, folder))]
    first, *rest = [cl.normalise_schema(p, CFG) for p in parts]
    for part in rest:
        first = first.unionByName(part, allowMissingColumns=True)
    return first.select(
        "source_file", "event_id", "client_id", "referrer", "event_name", cl.file_date(F.col("source_file")).alias("file_date")
    )


@query
def parse_event_time(spark: SparkSession, folder: str) -> DataFrame:
    kept, rejected = cl.parse_event_time(_raw(spark, folder), CFG)
    both = kept.withColumn("readable", F.lit(True)).unionByName(rejected.withColumn("readable", F.lit(False)))
    return _show_times(both.select("event_id", "timestamp", "event_timestamp", "event_date", "readable"))


@query
def rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Rows that no table takes in, and why."""
    return cl.rejects(_raw(spark, folder), CFG).select("event_id", "source_file", "timestamp", "reason")


@query
def drop_null_clients(spark: SparkSession, folder: str) -> DataFrame:
    return cl.drop_null_clients(_raw(spark, folder)).select("event_id", "client_id")


@query
def null_rate(spark: SparkSession, folder: str) -> DataFrame:
    profile = _profile(spark, folder, ("client_id_completeness",))
    rate = F.round(F.try_divide("null_clients", "total_rows"), 6)
    return profile.select("source_file", "total_rows", "null_clients", rate.alias("null_rate"))


# --- scalar functions -----------------------------------------------------------------


@query
def url_parts(spark: SparkSession, folder: str) -> DataFrame:
    """The given web pages' URLs taken apart."""
    url = F.col("url")
    pages = spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url")
    return pages.withColumn("query", query_string(url)).select(
        "page_id",
        "query",
        query_param(F.col("query"), "utm_source").alias("utm_source"),
        query_param(F.col("query"), "page").alias("page"),
        has_param(F.col("query"), "ref").alias("has_ref"),
        authority(url).alias("authority"),
        decode(F.regexp_extract(url, "^[^?#]*", 0)).alias("path"),
    )


@query
def traffic_source(spark: SparkSession, folder: str) -> DataFrame:
    return with_traffic_source(_raw(spark, folder), CFG).select(
        "event_id", "traffic_source", "traffic_medium", "traffic_campaign"
    )


@query
def marketing_channel(spark: SparkSession, folder: str) -> DataFrame:
    named = with_traffic_source(_raw(spark, folder), CFG)
    return named.groupBy("marketing_channel", "traffic_source", "traffic_medium").agg(
        F.count("*").alias("events")
    )


@query
def monitor_channel(spark: SparkSession, folder: str) -> DataFrame:
    return with_monitor_channel(_raw(spark, folder), CFG).select("event_id", "monitor_channel")


@query
def device_type_(spark: SparkSession, folder: str) -> DataFrame:
    agent = F.col("user_agent")
    return _raw(spark, folder).select("event_id", device_type(agent).alias("device_type"))


@query
def browser_(spark: SparkSession, folder: str) -> DataFrame:
    agent = F.col("user_agent")
    return _raw(spark, folder).select("event_id", browser(agent).alias("browser"))


@query
def json_validity(spark: SparkSession, folder: str) -> DataFrame:
    rows = _raw(spark, folder).filter("event_data is not null and event_data <> ''")
    return rows.select("event_id", is_json(F.col("event_data")).alias("valid"))


@query
def purchase_payload(spark: SparkSession, folder: str) -> DataFrame:
    rows = with_payload(_raw(spark, folder).filter(F.col("event_name") == CFG.conversion_event), CFG)
    return rows.select("event_id", *[c.alias(n) for n, c in purchase_record(CFG).items()])


# --- sessions -------------------------------------------------------------------------


@query
def sessionize(spark: SparkSession, folder: str) -> DataFrame:
    return _derived(spark, folder, HALF_HOUR).events_enriched.select("event_id", "session_id")


@query
def events_enriched(spark: SparkSession, folder: str) -> DataFrame:
    rows = _derived(spark, folder).events_enriched.drop("ingest_order", "event_id")
    return _show_times(rows)


@query
def sessions(spark: SparkSession, folder: str) -> DataFrame:
    return _show_times(_derived(spark, folder).sessions.drop("session_number"))


@query
def sessions_half_hour(spark: SparkSession, folder: str) -> DataFrame:
    rows = _derived(spark, folder, HALF_HOUR).sessions
    return _show_times(rows.select("session_id", "session_start", "session_end", "event_count", "landing_page"))


@query
def incremental_sessions(spark: SparkSession, folder: str) -> DataFrame:
    """Sessions after a second batch of days was merged into the summaries of the first."""
    events = _derived(spark, folder).events
    late = F.coalesce(F.col("event_date") >= F.lit("2024-01-16").cast("date"), F.lit(False))
    stored = se.summarise_chunks(events.filter(~late), CFG)
    _, updated = se.incremental_sessions(stored, events.filter(late), CFG)
    return _show_times(updated.drop("session_number"))


_LATE = ("events_20240127.csv", "events_20240130.csv")
_AGAIN = "events_20240112.csv"


def _fill(store, raw: DataFrame):
    """The store after it took in most days, one of them by half, and then the late days and that one whole."""
    headers = raw_headers(raw)
    late = F.col("source_file").isin(*_LATE)
    half = (F.col("source_file") != _AGAIN) | (F.col("ingest_order.seq") % 2 == 0)
    store.take_events(raw.filter(~late & half), headers.filter(~late))
    second = late | (F.col("source_file") == _AGAIN)
    store.take_events(raw.filter(second), headers.filter(second))
    return store


def _store(spark: SparkSession, folder: str) -> SessionStore:
    return _fill(SessionStore(spark, f"{shared_folder(spark)}/store-{uuid4().hex}", CFG), _raw(spark, folder))


@query
def incremental_run(spark: SparkSession, folder: str) -> DataFrame:
    """All sessions of a store after days came late and one was replaced: those of one run over everything."""
    return _show_times(_store(spark, folder).sessions().drop("session_number"))


@query
def incremental_history(spark: SparkSession, folder: str) -> DataFrame:
    """Days and clients that each run of that store touched; all other clients kept their sessions as they were."""
    return _store(spark, folder).history().select("version", "days", "clients")


def _profiles(spark: SparkSession, folder: str) -> ProfileStore:
    return _fill(ProfileStore(spark, f"{shared_folder(spark)}/profiles-{uuid4().hex}", CFG), _raw(spark, folder))


@query
def incremental_validation(spark: SparkSession, folder: str) -> DataFrame:
    """Check results of every file from profiles that were stored day by day."""
    return _rounded(_profiles(spark, folder).validation()["results"].drop("details"), "failure_rate")


@query
def incremental_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Transaction ids that occur more than once, from the transactions each stored day left."""
    return _profiles(spark, folder).validation()["cross_file_duplicates"]


@query
def incremental_alerts(spark: SparkSession, folder: str) -> DataFrame:
    """Alerts of every day from day profiles that were stored day by day."""
    return _rounded(_profiles(spark, folder).monitoring()["alerts"].drop("message"), "current_value", "threshold", digits=4)


@query
def incremental_moments(spark: SparkSession, folder: str) -> DataFrame:
    """Mean and deviation of each metric over all days, carried from run to run, replaced days taken out."""
    totals = _profiles(spark, folder).totals().withColumnRenamed("n", "days")
    return _rounded(totals, "mean", "std", digits=4)


@query
def incremental_rolling_baseline(spark: SparkSession, folder: str) -> DataFrame:
    rows = _profiles(spark, folder).monitoring()["rolling_baseline"]
    return _rounded(rows, "value", "mean", "std", digits=4)


@query
def incremental_null_rates(spark: SparkSession, folder: str) -> DataFrame:
    rows = _profiles(spark, folder).validation()["null_rate_vs_history"]
    return _rounded(rows, "null_client_rate", "past_average")


# --- conversions, attribution, journeys -----------------------------------------------


@query
def conversions(spark: SparkSession, folder: str) -> DataFrame:
    return _show_times(_derived(spark, folder).conversions.drop("ingest_order"))


@query
def lookback_touchpoints(spark: SparkSession, folder: str) -> DataFrame:
    """Each conversion with the starts and channels of its external touches."""
    d = _derived(spark, folder)
    found = at.lookback_touchpoints(d.purchases, d.sessions, CFG)
    return found.select(
        "transaction_id",
        F.size("touches").alias("touches"),
        F.array_join(F.transform("touches", lambda t: t["channel"]), ",").alias("channels"),
        F.get("touches", F.lit(0))["start_us"].alias("first_start_us"),
    )


@query
def attribution(spark: SparkSession, folder: str) -> DataFrame:
    return _show_times(_derived(spark, folder).attribution)


@query
def linear_attribution(spark: SparkSession, folder: str) -> DataFrame:
    d = _derived(spark, folder)
    return _show_times(_rounded(at.linear_attribution(d.purchases, d.sessions, CFG), "conversions", "revenue"))


@query
def channel_summary(spark: SparkSession, folder: str) -> DataFrame:
    return _show_times(_derived(spark, folder).channel_summary)


@query
def journey_sessions(spark: SparkSession, folder: str) -> DataFrame:
    d = _derived(spark, folder)
    rows = jo.journey_sessions(d.sessions, d.purchases)
    return _show_times(rows.select("client_id", "session_id", "session_start", "marketing_channel"))


@query
def user_journeys(spark: SparkSession, folder: str) -> DataFrame:
    return _derived(spark, folder).user_journeys


@query
def repeat_journeys(spark: SparkSession, folder: str) -> DataFrame:
    d = _derived(spark, folder)
    return _show_times(jo.repeat_journeys(d.sessions, d.conversions, CFG))


@query
def reconciliation_(spark: SparkSession, folder: str) -> DataFrame:
    d = _derived(spark, folder)
    rows = reconciliation(d.raw, d.events_enriched, d.sessions, d.conversions, d.attribution, CFG)
    return _rounded(rows, "original", "transformed", "note", digits=4)


# --- data quality ---------------------------------------------------------------------


@query
def daily_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(qu.daily_metrics(_profile(spark, folder, ())), "null_client_rate")


@query
def duplicate_transactions(spark: SparkSession, folder: str) -> DataFrame:
    return qu.duplicate_transactions(_raw(spark, folder), CFG)


@query
def cross_file_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return qu.cross_file_duplicates(_raw(spark, folder), CFG)


@query
def duplicate_occurrences(spark: SparkSession, folder: str) -> DataFrame:
    rows = qu.duplicate_occurrences(_raw(spark, folder), CFG)
    return rows.withColumn("revenue", F.col("revenue").try_cast("double"))


@query
def transactions_(spark: SparkSession, folder: str) -> DataFrame:
    rows = transactions(_raw(spark, folder), CFG)
    return rows.select(
        "source_file", "transaction_id", F.col("revenue").try_cast("double").alias("revenue"), "timestamp"
    )


@query
def orphan_purchasers(spark: SparkSession, folder: str) -> DataFrame:
    return qu.orphan_purchasers(_raw(spark, folder), CFG)


@query
def purchase_payload_counters(spark: SparkSession, folder: str) -> DataFrame:
    return _profile(spark, folder, ("purchases",)).select(
        "source_file", "purchase_rows", "zero_revenue", "negative_revenue",
        "missing_transaction_id", "null_item_prices", "unreadable_payloads",
    )


@query
def invalid_event_names(spark: SparkSession, folder: str) -> DataFrame:
    return qu.invalid_event_names(_raw(spark, folder), CFG)


@query
def offending_samples(spark: SparkSession, folder: str) -> DataFrame:
    """The first offending values of each file and check."""
    return qu.all_samples(_raw(spark, folder), CFG)


@query
def dq_results(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(_results(spark, folder).drop("details"), "failure_rate")


@query
def dq_details(spark: SparkSession, folder: str) -> DataFrame:
    """The details of every check as rows, samples of offending values among them; numbers apart from texts."""
    results = qu.with_samples(_results(spark, folder), qu.all_samples(_raw(spark, folder), CFG))
    rows = results.select("source_file", "check_name", F.explode("details").alias("key", "value"))
    number = F.round(F.col("value").try_cast("double"), 6)
    return rows.select("source_file", "check_name", "key", number.alias("number"), F.when(number.isNull(), F.col("value")).alias("text"))


def _single_check(check: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        rows = _results(spark, folder, (check,)).drop("details")
        return _rounded(rows, "failure_rate")

    return run


def _header_check(check: str) -> Query:
    """The same for a check of headers: files are written, and read with their own headers."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return _rounded(_file_results(spark, folder, check).drop("details"), "failure_rate")

    return run


for _check in qu.CHECKS:
    QUERIES[f"dq_{_check}"] = (_header_check if _check in ("required_columns", "referrer") else _single_check)(_check)


@query
def dq_file_verdict(spark: SparkSession, folder: str) -> DataFrame:
    return qu.file_verdicts(_results(spark, folder))


@query
def dq_batch_totals(spark: SparkSession, folder: str) -> DataFrame:
    return qu.batch_totals(qu.file_verdicts(_results(spark, folder)))


@query
def trend_anomalies(spark: SparkSession, folder: str) -> DataFrame:
    rows = qu.trend_anomalies(qu.daily_metrics(_profile(spark, folder, ())), CFG)
    return _rounded(rows, "previous_value", "current_value", digits=4)


@query
def schema_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Header changes of the files as they lie in a folder."""
    return qu.schema_changes(read_daily_files(spark, _written(spark, folder), CFG)[1])


@query
def purchase_rate_band(spark: SparkSession, folder: str) -> DataFrame:
    rows = qu.purchase_rate_band(qu.daily_metrics(_profile(spark, folder, ())), CFG)
    return _rounded(rows, "purchase_rate")


@query
def null_rate_vs_history(spark: SparkSession, folder: str) -> DataFrame:
    rows = qu.null_rate_vs_history(qu.daily_metrics(_profile(spark, folder, ())), CFG)
    return _rounded(rows, "null_client_rate", "past_average")


@query
def quarantine_split(spark: SparkSession, folder: str) -> DataFrame:
    raw = _raw(spark, folder)
    kept, held = qu.quarantine_split(raw, qu.file_verdicts(_results(spark, folder)))
    both = kept.withColumn("state", F.lit("kept")).unionByName(held.withColumn("state", F.lit("quarantined")))
    return both.groupBy("source_file", "state").agg(F.count("*").alias("events"))


# --- monitoring -----------------------------------------------------------------------


def _monitored(spark: SparkSession, folder: str) -> DataFrame:
    return cl.normalise_schema(_raw(spark, folder), CFG)


@query
def daily_conversions(spark: SparkSession, folder: str) -> DataFrame:
    return mo.daily_conversions(_monitored(spark, folder), CFG)


@query
def daily_client_sessions(spark: SparkSession, folder: str) -> DataFrame:
    return mo.daily_client_sessions(_monitored(spark, folder), CFG)


@query
def channel_share(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(mo.channel_share(mo.daily_client_sessions(_monitored(spark, folder), CFG)), "share")


@query
def funnel_rates(spark: SparkSession, folder: str) -> DataFrame:
    rates = mo.funnel_rates(mo.daily_client_sessions(_monitored(spark, folder), CFG))
    return _rounded(rates, "add_to_cart_rate", "checkout_rate", "purchase_rate")


@query
def surplus_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return mo.surplus_duplicates(mo.daily_conversions(_monitored(spark, folder), CFG))


@query
def history_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(mo.history_metrics(_monitored(spark, folder), CFG), "aov")


@query
def baseline_days(spark: SparkSession, folder: str) -> DataFrame:
    return mo.baseline_days(mo.history_metrics(_monitored(spark, folder), CFG), CFG).select("source_file", "events")


def _baseline(spark: SparkSession, folder: str) -> DataFrame:
    return mo.baseline_stats(mo.history_metrics(_monitored(spark, folder), CFG), CFG)


@query
def baseline_stats(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(_baseline(spark, folder), "mean", "std", "min", "max", digits=4)


@query
def rolling_baseline(spark: SparkSession, folder: str) -> DataFrame:
    rows = mo.rolling_baseline(mo.history_metrics(_monitored(spark, folder), CFG), CFG)
    return _rounded(rows, "value", "mean", "std", digits=4)


@query
def metric_zscores(spark: SparkSession, folder: str) -> DataFrame:
    days = mo.history_metrics(_monitored(spark, folder), CFG)
    rows = mo.metric_zscores(days, _baseline(spark, folder), CFG)
    return _rounded(rows, "value", "mean", "std", "z_score", digits=4)


def _score(metric: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        rows = mo.metric_results(_days(spark, folder), CFG).filter(F.col("metric_name") == metric)
        return _rounded(
            rows.select("source_file", "current_value", "z_score", "is_anomaly"),
            "current_value", "z_score", digits=4,
        )

    return run


QUERIES["revenue_zscore"] = _score("daily_revenue")
QUERIES["aov_zscore"] = _score("average_order_value")


@query
def metric_results(spark: SparkSession, folder: str) -> DataFrame:
    rows = mo.metric_results(_days(spark, folder), CFG)
    return _rounded(rows, "current_value", "historical_avg", "historical_std", "z_score", digits=4)


def _alerts(spark: SparkSession, folder: str) -> DataFrame:
    found = mo.alerts(_days(spark, folder), CFG).drop("message")
    return _rounded(found, "current_value", "threshold", digits=4)


@query
def alerts(spark: SparkSession, folder: str) -> DataFrame:
    return _alerts(spark, folder)


def _alerts_named(*names: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return _alerts(spark, folder).filter(F.col("name").isin(*names))

    return run


ALERT_QUERIES = {
    "alert_volume": ("low_event_volume", "high_event_volume"),
    "alert_null_rate": ("null_client_rate",),
    "alert_schema": ("schema_change",),
    "alert_revenue_floor": ("low_revenue",),
    "alert_revenue_z": ("revenue_anomaly",),
    "alert_conversions": ("low_conversions",),
    "alert_aov_z": ("aov_anomaly",),
    "alert_duplicates": ("duplicate_transactions",),
    "alert_funnel": ("funnel_inverted",),
    "alert_zero_conversions": ("zero_conversions",),
    "alert_concentration": ("traffic_concentration",),
    "alert_missing_channel": ("missing_channel",),
}
for _name, _names in ALERT_QUERIES.items():
    QUERIES[_name] = _alerts_named(*_names)


@query
def alert_schema(spark: SparkSession, folder: str) -> DataFrame:
    """Alerts on headers, from files that are written and read with their own headers."""
    events, headers = read_daily_files(spark, _written(spark, folder), CFG)
    found = mo.alerts(monitored_days(events.drop(cl.CORRUPT), CFG, headers), CFG).drop("message")
    return _rounded(found.filter("name = 'schema_change'"), "current_value", "threshold", digits=4)


@query
def alert_counts(spark: SparkSession, folder: str) -> DataFrame:
    return mo.alert_counts(mo.alerts(_days(spark, folder), CFG))


@query
def critical_verdict(spark: SparkSession, folder: str) -> DataFrame:
    days = _days(spark, folder)
    return mo.critical_verdict(days, mo.alerts(days, CFG))


# --- written tables -------------------------------------------------------------------


@query
def counts_in_flight(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of the six written tables, counted by the writing jobs and again from file footers."""
    d = _derived(spark, folder)
    path = f"{shared_folder(spark)}/tables-{uuid4().hex}"
    tables = ("events_enriched", "sessions", "conversions", "attribution", "channel_summary", "user_journeys")
    observed = write_tables({name: getattr(d, name) for name in tables}, path)
    footers = row_counts(spark, {name: f"{path}/{name}" for name in tables})
    rows = [(name, observed[name], footers[name]) for name in tables]
    return spark.createDataFrame(rows, "table_name string, observed long, in_footers long")


@query
def ordered_export(spark: SparkSession, folder: str) -> DataFrame:
    """Sessions written in ranges of date and key: whether each date's files, read by name, are in order."""
    path = f"{shared_folder(spark)}/ordered-{uuid4().hex}"
    stored = write_table(_derived(spark, folder).sessions, path, "stored")
    write_table(spark.read.parquet(stored), path, "sessions", ordered=True)
    key = F.struct(*ORDER["sessions"])
    file, place = F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("place")
    read = spark.read.parquet(f"{path}/sessions").select("session_date", key.alias("key"), file, place)
    inside = Window.partitionBy("session_date", "file").orderBy("place")  # rows of one file
    steps = read.withColumn("sorted", F.coalesce(F.lag("key").over(inside) <= F.col("key"), F.lit(True)))
    files = steps.groupBy("session_date", "file").agg(
        F.count("*").alias("sessions"), F.min("sorted").alias("sorted"), F.min("key").alias("first"), F.max("key").alias("last")
    )
    by_name = Window.partitionBy("session_date").orderBy("file")  # files of one date
    files = files.withColumn("follows", F.coalesce(F.lag("last").over(by_name) <= F.col("first"), F.lit(True)))
    dates = files.groupBy("session_date").agg(F.sum("sessions").alias("sessions"), F.min(F.col("sorted") & F.col("follows")).alias("in_order"))
    return dates.withColumn("session_date", _date("session_date"))


@query
def written_alerts(spark: SparkSession, folder: str) -> DataFrame:
    """Alerts of each day as they lie in the sink after a run was repeated."""
    path = f"{shared_folder(spark)}/alerts-{uuid4().hex}"
    days = _days(spark, folder)
    for run in ("first", "second"):
        out = write_alerts(mo.alerts(days, CFG), path, days, run)
    lines = spark.read.json(out)
    return lines.groupBy("source_file").agg(
        F.count(F.when(F.col("kind") == "alert", 1)).alias("alerts"), F.countDistinct("run").alias("runs")
    )


# --- reports --------------------------------------------------------------------------


@query
def kpi_summary(spark: SparkSession, folder: str) -> DataFrame:
    d = _derived(spark, folder)
    return re.kpi_summary(d.sessions, d.purchases)


@query
def revenue_share(spark: SparkSession, folder: str) -> DataFrame:
    return re.revenue_share(_derived(spark, folder).attribution)


@query
def channel_efficiency(spark: SparkSession, folder: str) -> DataFrame:
    return re.channel_efficiency(_derived(spark, folder).attribution)


@query
def attribution_shift(spark: SparkSession, folder: str) -> DataFrame:
    return re.attribution_shift(_derived(spark, folder).channel_summary)


@query
def funnel_report(spark: SparkSession, folder: str) -> DataFrame:
    return re.funnel_report(_derived(spark, folder).sessions)


@query
def journey_averages(spark: SparkSession, folder: str) -> DataFrame:
    return re.journey_averages(_derived(spark, folder).user_journeys)


@query
def device_conversion(spark: SparkSession, folder: str) -> DataFrame:
    return re.device_conversion(_derived(spark, folder).sessions)


@query
def weekend_conversion(spark: SparkSession, folder: str) -> DataFrame:
    return re.weekend_conversion(_derived(spark, folder).sessions)


@query
def duplicate_revenue(spark: SparkSession, folder: str) -> DataFrame:
    d = _derived(spark, folder)
    bought = d.raw.filter(F.col("event_name") == CFG.conversion_event)
    return re.duplicate_revenue(with_payload(bought, CFG), d.purchases)


@query
def daily_trend(spark: SparkSession, folder: str) -> DataFrame:
    return _show_times(re.daily_trend(_derived(spark, folder).purchases.select("event_date", "revenue")))
