"""Data-quality checks on raw files, many files in one plan.

Every check is a counter per file. Most counters come from one aggregation over the raw
events; duplicates and the funnel are reduced per (file, key) first. After that a file is a
single row, and the checks, verdicts and trends work on that small table.

`events` here are raw events with normalised names (a missing referrer is not filled in);
`headers` has one row per file: `source_file` and `columns`, the names as the file spells them.
"""

from __future__ import annotations

from functools import reduce

from collections.abc import Collection

from pyspark.sql import Column, DataFrame, Window, functions as F

from clickloom.config import Config
from clickloom.functions.basics import (
    count_if, exact_sum, flag, is_blank, not_in, passes, ratio,
)
from clickloom.functions.payload import is_json, with_payload
from clickloom.operators.cleaning import file_date
from clickloom.operators.conversions import transactions

# In the order they are run and reported.
CHECKS = (
    "required_columns", "client_id_completeness", "timestamp_format", "timestamp_partition",
    "event_names", "url_domain", "event_data_json", "purchases", "duplicates", "volume", "funnel",
    "referrer",
)
ISO_MILLIS = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d{3}Z$"


# --- row predicates -------------------------------------------------------------------


def row_tests(cfg: Config) -> dict[str, Column]:
    """For each row-level check, whether a row violates it."""
    day = file_date(F.col("source_file"))
    prefix = F.concat_ws("-", F.substring(day, 1, 4), F.substring(day, 5, 2), F.substring(day, 7, 8))
    has_data = ~is_blank(F.col("event_data"))
    return {
        "null_clients": is_blank(F.col("client_id")),
        "bad_timestamps": ~passes(F.col("timestamp").rlike(ISO_MILLIS)),
        "wrong_dates": ~passes(F.col("timestamp").startswith(prefix)),
        "bad_events": not_in(F.col("event_name"), cfg.valid_events),
        "bad_urls": ~passes(F.col("page_url").rlike(cfg.url_pattern)),
        "bad_json": F.coalesce(has_data & ~is_json(F.col("event_data")), F.lit(False)),
    }


def violations(events: DataFrame, check: str, cfg: Config) -> DataFrame:
    """The rows that violate one row-level check."""
    return events.filter(row_tests(cfg)[check])


def samples(events: DataFrame, check: str, column: str, cfg: Config) -> DataFrame:
    """The first few offending values of each file, in input order.

    A ranked limit per file, which Spark applies before the shuffle as well. Payloads are long,
    so of them fewer are shown and only their beginnings.
    """
    payload = check == "bad_json"
    size = cfg.quality.payload_sample_size if payload else cfg.quality.sample_size
    value = F.left(F.col(column), F.lit(100)) if payload else F.col(column)
    first = Window.partitionBy("source_file").orderBy("ingest_order")
    return (
        violations(events, check, cfg)
        .select("source_file", "ingest_order", value.alias("value"))
        .withColumn("place", F.row_number().over(first))
        .filter(F.col("place") <= size)
        .select("source_file", "place", "value")
    )


def all_samples(events: DataFrame, cfg: Config) -> DataFrame:
    """Samples of every check that looks at values."""
    columns = {
        "timestamp_format": ("bad_timestamps", "timestamp"),
        "timestamp_partition": ("wrong_dates", "timestamp"),
        "url_domain": ("bad_urls", "page_url"),
        "event_data_json": ("bad_json", "event_data"),
    }
    parts = [samples(events, test, c, cfg).withColumn("check_name", F.lit(name)) for name, (test, c) in columns.items()]
    return reduce(DataFrame.unionByName, parts)


def with_samples(results: DataFrame, found: DataFrame) -> DataFrame:
    """Check results whose `details` also show the `samples` of that file and check; a handful each."""
    value = F.array_join(F.sort_array(F.collect_list(F.struct("place", "value")))["value"], " | ")
    shown = found.groupBy("source_file", "check_name").agg(F.create_map(F.lit("samples"), value).alias("shown"))
    none = F.create_map().cast("map<string,string>")
    details = F.map_concat("details", F.coalesce("shown", none))
    return results.join(shown, ["source_file", "check_name"], "left").withColumn("details", details).select(results.columns)


def invalid_event_names(events: DataFrame, cfg: Config) -> DataFrame:
    """Distinct names outside the allowed set, per file."""
    return (
        violations(events, "bad_events", cfg)
        .groupBy("source_file", "event_name")
        .agg(F.count("*").alias("events"))
    )


# --- counters -------------------------------------------------------------------------


def file_counters(events: DataFrame, cfg: Config) -> DataFrame:
    """All counters that need a single look at each row, one row per file."""
    purchase = F.col("event_name").isin(*cfg.purchase_events)
    completed = F.col("event_name") == cfg.conversion_event
    pay = {f: F.col(f"payload.{f}") for f in ("is_object", "has_transaction", "revenue_given", "revenue")}
    # A price is only looked at once the revenue before it could be read.
    reads_on = pay["is_object"] & (~pay["revenue_given"] | pay["revenue"].isNotNull())
    return (
        with_payload(events, cfg)
        .groupBy("source_file")
        .agg(
            F.count("*").alias("total_rows"),
            *[count_if(test).alias(name) for name, test in row_tests(cfg).items()],
            count_if(purchase).alias("purchase_rows"),
            count_if(completed).alias("completed_rows"),
            count_if(pay["is_object"] & ~pay["has_transaction"]).alias("missing_transaction_id"),
            count_if(pay["revenue_given"] & (pay["revenue"] == 0)).alias("zero_revenue"),
            count_if(pay["revenue_given"] & (pay["revenue"] < 0)).alias("negative_revenue"),
            F.coalesce(F.sum(F.when(reads_on, F.col("payload.null_item_prices"))), F.lit(0)).alias(
                "null_item_prices"
            ),
            count_if(
                purchase
                & (~pay["is_object"] | pay["revenue"].isNull() & pay["revenue_given"]
                   | F.col("payload.item_count").isNull())
            ).alias("unreadable_payloads"),
            exact_sum(F.when(completed, pay["revenue"])).alias("revenue"),
        )
    )


def duplicate_transactions(events: DataFrame, cfg: Config) -> DataFrame:
    """Transaction ids that occur more than once in a file."""
    return (
        transactions(events, cfg)
        .filter("has_transaction")
        .groupBy("source_file", "transaction_id")
        .agg(F.count("*").alias("occurrences"))
        .filter(F.col("occurrences") > 1)
    )


def cross_file_duplicates(events: DataFrame, cfg: Config) -> DataFrame:
    """Transaction ids that occur more than once in all files together."""
    return repeated_ids(transactions(events, cfg))


def repeated_ids(found: DataFrame) -> DataFrame:
    """The same from `transactions` that were extracted before."""
    return (
        found.filter("has_transaction")
        .groupBy("transaction_id")
        .agg(F.count("*").alias("occurrences"))
        .filter(F.col("occurrences") > 1)
    )


def duplicate_occurrences(events: DataFrame, cfg: Config) -> DataFrame:
    """Every occurrence of a duplicated id as a row of its own, so that no list can grow."""
    return occurrences_of_repeated(transactions(events, cfg))


def occurrences_of_repeated(found: DataFrame) -> DataFrame:
    """The same from `transactions` that were extracted before."""
    return found.filter("has_transaction").join(repeated_ids(found), "transaction_id").select(
        "transaction_id", "occurrences", "source_file", "revenue", "timestamp"
    )


def client_funnel(events: DataFrame, cfg: Config) -> DataFrame:
    """Per file and client, whether it viewed a page and whether it purchased."""
    return (
        events.filter(F.col("client_id").isNotNull())
        .groupBy("source_file", "client_id")
        .agg(
            F.max(flag(F.col("event_name") == cfg.page_view_event)).alias("viewed"),
            F.max(flag(F.col("event_name") == cfg.conversion_event)).alias("purchased"),
        )
        .filter(F.col("purchased") == 1)
    )


def orphan_purchasers(events: DataFrame, cfg: Config) -> DataFrame:
    """Clients that purchased without a page view in the same file."""
    return client_funnel(events, cfg).filter(F.col("viewed") == 0).select("source_file", "client_id")


def file_profile(
    events: DataFrame, headers: DataFrame, cfg: Config, checks: Collection[str] = CHECKS
) -> DataFrame:
    """One wide row per file with all that `checks` need; files without rows included."""
    joined = headers.join(file_counters(events, cfg), "source_file", "left")
    if "duplicates" in checks:
        duplicates = duplicate_transactions(events, cfg).groupBy("source_file").agg(
            F.sum("occurrences").alias("duplicate_rows")
        )
        joined = joined.join(duplicates, "source_file", "left")
    if "funnel" in checks:
        funnel = client_funnel(events, cfg).groupBy("source_file").agg(
            F.count("*").alias("purchasers"), F.sum(1 - F.col("viewed")).alias("orphans")
        )
        joined = joined.join(funnel, "source_file", "left")
    counts = [c for c in joined.columns if c not in ("source_file", "columns", "revenue")]
    names = F.transform("columns", lambda c: F.replace(F.lower(c), F.lit("clientid"), F.lit("client_id")))
    expected = F.array(*[F.lit(c) for c in cfg.expected_columns])
    return joined.withColumns(
        {
            **{c: F.coalesce(F.col(c), F.lit(0)) for c in counts},
            "revenue": F.coalesce("revenue", F.lit(0.0)),
            "file_date": file_date(F.col("source_file")),
            "missing_columns": F.array_except(expected, names),
            "extra_columns": F.array_except(names, expected),
            "has_referrer": F.array_contains("columns", "referrer"),
            # As the checks read it: exact names, with the one known spelling variant.
            "usable_columns": F.transform("columns", lambda c: F.when(c == "clientId", "client_id").otherwise(c)),
        }
    )


# --- checks ---------------------------------------------------------------------------


def dq_results(profile: DataFrame, cfg: Config, checks: Collection[str] = CHECKS) -> DataFrame:
    """The checks (twelve, or those asked for) as rows: verdict, affected rows and details.

    A check whose columns a file lacks is not evaluated: `passed` is null.
    """
    lim = cfg.quality
    n = F.col("total_rows")
    null_rate = F.try_divide(F.col("null_clients"), n)
    orphan_rate = ratio(F.col("orphans"), F.col("purchasers"))
    payload_faults = (
        F.col("zero_revenue") + F.col("negative_revenue")
        + F.col("missing_transaction_id") + F.col("null_item_prices")
    )
    no_purchase = F.col("purchase_rows") == 0
    volume_low, volume_high = n < lim.min_daily_events, n > lim.max_daily_events
    zero = F.lit(0)
    specs = {
        "required_columns": ((), F.size("missing_columns") == 0, "CRITICAL", zero, {
            "missing": F.array_join("missing_columns", ","), "extra": F.array_join("extra_columns", ",")}),
        "client_id_completeness": (("client_id",), passes(null_rate <= lim.max_null_client_rate),
            "CRITICAL", F.col("null_clients"), {
            "null_rate": null_rate, "threshold": F.lit(lim.max_null_client_rate)}),
        "timestamp_format": (("timestamp",), F.col("bad_timestamps") == 0, "HIGH", F.col("bad_timestamps"), {}),
        "timestamp_partition": (("timestamp",), F.col("wrong_dates") == 0, "HIGH", F.col("wrong_dates"), {
            "expected_date": F.col("file_date")}),
        "event_names": (("event_name",), F.col("bad_events") == 0, "CRITICAL", F.col("bad_events"), {}),
        "url_domain": (("page_url",), F.col("bad_urls") == 0, "MEDIUM", F.col("bad_urls"), {}),
        "event_data_json": (("event_data",), F.col("bad_json") == 0, "HIGH", F.col("bad_json"), {}),
        "purchases": (("event_name", "event_data"), payload_faults == 0,
            F.when(no_purchase, "MEDIUM").otherwise("HIGH"),
            F.when(payload_faults > 0, F.col("purchase_rows")).otherwise(zero), {
            c: F.col(c) for c in ("zero_revenue", "negative_revenue", "missing_transaction_id",
                                  "null_item_prices", "unreadable_payloads")}),
        "duplicates": (("event_name", "event_data"), F.col("duplicate_rows") == 0, "CRITICAL",
            F.col("duplicate_rows"), {}),
        "volume": ((), ~(volume_low | volume_high),
            F.when(volume_high, "MEDIUM").otherwise("HIGH"), zero, {
            "min": F.lit(lim.min_daily_events), "max": F.lit(lim.max_daily_events)}),
        "funnel": (("event_name", "client_id"), orphan_rate <= lim.max_orphan_rate, "MEDIUM",
            F.when(orphan_rate > lim.max_orphan_rate, F.col("orphans")).otherwise(zero), {
            "orphans": F.col("orphans"), "purchasers": F.col("purchasers")}),
        "referrer": ((), F.col("has_referrer"), "CRITICAL", zero, {
            "columns": F.array_join("columns", ",")}),
    }
    rows = F.array(
        *[_check_row(i, c, *specs[c]) for i, c in enumerate(CHECKS, start=1) if c in checks]
    )
    return (
        profile.select("source_file", "file_date", "total_rows", F.explode(rows).alias("r"))
        .select("source_file", "file_date", "total_rows", "r.*")
        .withColumn("failure_rate", ratio(F.col("affected_rows"), F.col("total_rows")))
    )


def _check_row(
    number: int, name: str, needs: tuple[str, ...], ok: Column, severity: Column | str,
    affected: Column, details: dict[str, Column],
) -> Column:
    evaluated = F.lit(True)
    for column in needs:
        evaluated = evaluated & F.array_contains("usable_columns", column)
    level = F.lit(severity) if isinstance(severity, str) else severity
    pairs = [x for k, v in details.items() for x in (F.lit(k), v.cast("string"))]
    outcome = F.when(~evaluated, "not evaluated").when(ok, "ok").otherwise("failed")
    return F.struct(
        F.lit(number).alias("check_number"),
        F.lit(name).alias("check_name"),
        level.alias("severity"),
        F.when(evaluated, ok).alias("passed"),
        F.concat_ws(" ", F.lit(name), outcome, F.concat(F.lit("("), affected.cast("string"), F.lit(" rows)"))).alias("message"),
        F.when(evaluated, affected).otherwise(0).cast("long").alias("affected_rows"),
        (F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")).alias("details"),
    )


def file_verdicts(results: DataFrame) -> DataFrame:
    """A file passes when no CRITICAL check failed; failing checks are listed by severity."""
    failed = ~passes(F.col("passed"))

    def listed(severity: str) -> Column:
        hit = F.when(failed & (F.col("severity") == severity), F.struct("check_number", "check_name"))
        return F.array_join(F.sort_array(F.collect_list(hit))["check_name"], ",")

    return results.groupBy("source_file").agg(
        (F.max(flag(failed & (F.col("severity") == "CRITICAL"))) == 0).alias("passed"),
        listed("CRITICAL").alias("critical_issues"),
        listed("HIGH").alias("high_issues"),
    )


def batch_totals(verdicts: DataFrame) -> DataFrame:
    return verdicts.agg(
        F.count("*").alias("files"),
        count_if(F.col("passed")).alias("passed_files"),
        count_if(~F.col("passed")).alias("failed_files"),
    )


# --- trends over files ----------------------------------------------------------------
# The windows below run over one row per file, ordered by name; they hold as many rows as
# there are daily files.


def daily_metrics(profile: DataFrame) -> DataFrame:
    return profile.select(
        "source_file",
        F.col("file_date").alias("date"),
        F.col("total_rows").alias("total_events"),
        F.col("completed_rows").alias("purchases"),
        "revenue",
        F.try_divide(F.col("null_clients"), F.col("total_rows")).alias("null_client_rate"),
        "has_referrer",
    )


def trend_anomalies(daily: DataFrame, cfg: Config) -> DataFrame:
    """What changed sharply from one file to the next; a file can have several anomalies."""
    lim = cfg.quality
    by_file = Window.orderBy("source_file")

    def before(column: str) -> Column:
        return F.lag(column).over(by_file)

    moved = daily.select(
        "source_file", "date", "null_client_rate", "revenue", "has_referrer",
        before("null_client_rate").alias("last_rate"),
        before("revenue").alias("last_revenue"),
        before("has_referrer").alias("last_referrer"),
    )
    rate, revenue = F.col("null_client_rate"), F.col("revenue")
    spike = (rate > F.col("last_rate") * lim.null_spike_factor) & (rate > lim.max_null_client_rate)
    drop = (F.col("last_revenue") > 0) & (revenue < F.col("last_revenue") * lim.revenue_drop_factor)
    lost = F.col("last_referrer") & ~F.col("has_referrer")
    return _unfold(
        moved,
        ["source_file", "date"],
        [
            _anomaly("null_client_spike", spike, F.col("last_rate"), rate),
            _anomaly("revenue_drop", drop, F.col("last_revenue"), revenue),
            _anomaly("referrer_missing", lost, F.lit(1.0), F.lit(0.0)),
        ],
    )


def _anomaly(kind: str, fired: Column, previous: Column, current: Column) -> Column:
    return F.struct(
        F.lit(kind).alias("anomaly"),
        previous.cast("double").alias("previous_value"),
        current.cast("double").alias("current_value"),
        F.coalesce(fired, F.lit(False)).alias("fired"),
    )


def _unfold(frame: DataFrame, keys: list[str], candidates: list[Column]) -> DataFrame:
    """The candidates that fired, as rows."""
    return (
        frame.select(*keys, F.explode(F.array(*candidates)).alias("c"))
        .filter("c.fired")
        .select(*keys, "c.*")
        .drop("fired")
    )


def schema_changes(headers: DataFrame) -> DataFrame:
    """Columns that came or went from one file to the next."""
    last = F.lag("columns").over(Window.orderBy("source_file"))
    return (
        headers.withColumn("last_columns", last)
        .filter("last_columns is not null")
        .select(
            "source_file",
            F.array_join(F.array_sort(F.array_except("columns", "last_columns")), ",").alias("added"),
            F.array_join(F.array_sort(F.array_except("last_columns", "columns")), ",").alias("removed"),
        )
        .filter("added <> '' or removed <> ''")
    )


def purchase_rate_band(daily: DataFrame, cfg: Config) -> DataFrame:
    """Purchases per event of each file, and whether that lies in the expected band."""
    rate = ratio(F.col("purchases"), F.col("total_events"))
    inside = rate.between(cfg.quality.min_purchase_rate, cfg.quality.max_purchase_rate)
    return daily.select("source_file", rate.alias("purchase_rate"), inside.alias("in_band"))


def null_rate_vs_history(daily: DataFrame, cfg: Config) -> DataFrame:
    """Null-client rate of each file against the average of all files before it."""
    past = Window.orderBy("source_file").rowsBetween(Window.unboundedPreceding, -1)
    rate, average = F.col("null_client_rate"), F.col("past_average")
    return daily.withColumn("past_average", F.avg("null_client_rate").over(past)).select(
        "source_file",
        "null_client_rate",
        "past_average",
        F.coalesce(rate > average * cfg.quality.history_spike_factor, F.lit(False)).alias("spike"),
    )


def quarantine_split(events: DataFrame, verdicts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Events of files that passed, and events of files that did not."""
    failed = verdicts.filter(~F.col("passed")).select("source_file")
    return (
        events.join(failed, "source_file", "left_anti"),
        events.join(failed, "source_file", "left_semi"),
    )
