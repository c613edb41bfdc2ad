"""Daily metrics and alerts; all days are worked on at once.

`events` are raw events with normalised names and a filled referrer. Counts, conversions and
client sessions are each reduced to one row per day before they meet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from clickloom.config import Config
from clickloom.functions.basics import (
    count_if, decimal_part, exact_sum, flag, is_blank, numbered_id, other_part, ratio, whole_sum,
)
from clickloom.functions.channels import with_monitor_channel
from clickloom.functions.payload import with_payload

METRICS = ("events", "conversions", "revenue", "aov")
CORE_CHANNELS = ("Direct", "Paid Search")


def daily_conversions(events: DataFrame, cfg: Config) -> DataFrame:
    """Conversions whose revenue can be read, duplicates included."""
    chosen = with_payload(events.filter(F.col("event_name") == cfg.conversion_event), cfg)
    return chosen.filter(F.col("payload.revenue").isNotNull()).select(
        "source_file",
        F.col("payload.transaction_id").alias("transaction_id"),
        F.col("payload.revenue").alias("revenue"),
    )


def daily_client_sessions(events: DataFrame, cfg: Config) -> DataFrame:
    """One session per client and file, with the channel of its first row in input order."""
    named = with_monitor_channel(events.filter(~is_blank(F.col("client_id"))), cfg)

    def happened(event: str, name: str) -> Column:
        return (F.max(flag(F.col("event_name") == event)) == 1).alias(name)

    return (
        named.groupBy("source_file", "client_id")
        .agg(
            happened(cfg.cart_event, "has_add_to_cart"),
            happened(cfg.checkout_event, "has_checkout_started"),
            happened(cfg.conversion_event, "has_purchase"),
            F.min_by("monitor_channel", "ingest_order").alias("marketing_channel"),
        )
        .withColumn("session_id", numbered_id(F.col("client_id"), F.lit(1)))
    )


def channel_share(client_sessions: DataFrame) -> DataFrame:
    """Sessions and share of each channel per day."""
    by_day = Window.partitionBy("source_file")
    n = F.col("sessions")
    return (
        client_sessions.groupBy("source_file", "marketing_channel")
        .agg(F.count("*").alias("sessions"))
        .withColumn("share", n / F.sum(n).over(by_day))
    )


def funnel_rates(client_sessions: DataFrame) -> DataFrame:
    """Share of a day's sessions that reach each step."""
    steps = {
        "add_to_cart_rate": "has_add_to_cart",
        "checkout_rate": "has_checkout_started",
        "purchase_rate": "has_purchase",
    }
    return client_sessions.groupBy("source_file").agg(
        F.count("*").alias("sessions"),
        *[F.avg(F.col(c).cast("int")).alias(name) for name, c in steps.items()],
    )


def _channel_profile(client_sessions: DataFrame) -> DataFrame:
    """Per day: funnel rates, top channel and the channels seen.

    Sessions are counted per (day, channel) first; the second step sees a few rows a day.
    """
    flags = ("has_add_to_cart", "has_checkout_started", "has_purchase")
    per_channel = client_sessions.groupBy("source_file", "marketing_channel").agg(
        F.count("*").alias("n"), *[F.sum(F.col(c).cast("int")).alias(c) for c in flags]
    )
    top = F.max_by("marketing_channel", F.struct("n", "marketing_channel"))
    return per_channel.groupBy("source_file").agg(
        F.sum("n").alias("sessions"),
        *[(F.sum(c) / F.sum("n")).alias(c) for c in flags],
        top.alias("top_channel"),
        (F.max("n") / F.sum("n")).alias("top_share"),
        F.collect_set("marketing_channel").alias("channels"),
    )


def surplus_duplicates(conversions: DataFrame) -> DataFrame:
    """Conversions per day beyond the first of each id; those without id count as one id."""
    return (
        conversions.groupBy("source_file", "transaction_id")
        .agg(F.count("*").alias("n"))
        .groupBy("source_file")
        .agg(F.sum(F.col("n") - 1).alias("duplicates"))
    )


def daily_conversion_totals(conversions: DataFrame) -> DataFrame:
    """Conversions, revenue and surplus duplicates per day from one grouping by id."""
    per_id = conversions.groupBy("source_file", "transaction_id").agg(
        F.count("*").alias("n"),
        F.sum(decimal_part(F.col("revenue"))).alias("decimals"),
        F.sum(other_part(F.col("revenue"))).alias("others"),
    )
    return per_id.groupBy("source_file").agg(
        F.sum("n").alias("conversions"),
        whole_sum(F.sum("decimals"), F.sum("others")).alias("revenue"),
        F.sum(F.col("n") - 1).alias("duplicates"),
    )


def day_profile(events: DataFrame, cfg: Config, headers: DataFrame | None = None) -> DataFrame:
    """One wide row per day with every monitored value.

    Without `headers` every expected column counts as present.
    """
    bought = F.col("event_name") == cfg.conversion_event
    rows = with_payload(events, cfg).groupBy("source_file").agg(
        F.count("*").alias("events"),
        count_if(bought).alias("purchase_rows"),
        exact_sum(F.when(bought, F.col("payload.revenue"))).alias("purchase_revenue"),
        count_if(is_blank(F.col("client_id"))).alias("null_clients"),
        (F.max(flag(~is_blank(F.col("referrer")))) == 1).alias("has_referrer_data"),
    )
    days = rows.join(
        daily_conversion_totals(daily_conversions(events, cfg)), "source_file", "left"
    ).join(_channel_profile(daily_client_sessions(events, cfg)), "source_file", "left")
    expected = F.array(*[F.lit(c) for c in cfg.expected_columns])
    if headers is None:
        days = days.withColumn("present_columns", expected)
    else:
        names = F.transform("columns", lambda c: F.when(c == "clientId", "client_id").otherwise(c))
        # The loader has filled a missing referrer by now, so it counts as present.
        days = days.join(
            headers.select(
                "source_file",
                F.array_union(names, F.array(F.lit("referrer"))).alias("present_columns"),
            ),
            "source_file",
            "left",
        )
    return days.withColumns(
        {
            "conversions": F.coalesce("conversions", F.lit(0)),
            "revenue": F.coalesce("revenue", F.lit(0.0)),
            "duplicates": F.coalesce("duplicates", F.lit(0)),
            "sessions": F.coalesce("sessions", F.lit(0)),
            "null_client_rate": ratio(F.col("null_clients"), F.col("events")),
            "aov": F.try_divide(F.col("revenue"), F.col("conversions")),
            "missing_columns": F.array_except(expected, "present_columns"),
            "known_columns": F.size("present_columns"),
        }
    )


# --- history and baselines ------------------------------------------------------------


def history_metrics(events: DataFrame, cfg: Config) -> DataFrame:
    """Events, conversions, revenue and order value per day; all purchase rows count."""
    bought = F.col("event_name") == cfg.conversion_event
    daily = with_payload(events, cfg).groupBy("source_file").agg(
        F.count("*").alias("events"),
        count_if(bought).alias("conversions"),
        exact_sum(F.when(bought, F.col("payload.revenue"))).alias("revenue"),
    )
    return daily.withColumn("aov", ratio(F.col("revenue"), F.col("conversions")))


def history_of_days(days: DataFrame) -> DataFrame:
    """`history_metrics` from day profiles, which hold the same sums."""
    bought = F.col("purchase_rows")
    return days.select(
        "source_file",
        "events",
        bought.alias("conversions"),
        F.col("purchase_revenue").alias("revenue"),
        ratio(F.col("purchase_revenue"), bought).alias("aov"),
    )


def baseline_days(history: DataFrame, cfg: Config) -> DataFrame:
    """The first days by file name; the baseline is made of exactly these."""
    return history.orderBy("source_file").limit(cfg.monitor.baseline_days)


def metric_rows(history: DataFrame, keys: list[str]) -> DataFrame:
    """`metric, value` with the keys: a row for each metric of each day."""
    wide = history.select(*keys, *[F.col(m).cast("double").alias(m) for m in METRICS])
    return wide.unpivot(keys, list(METRICS), "metric", "value")


def baseline_stats(history: DataFrame, cfg: Config) -> DataFrame:
    """Mean, sample deviation, min and max of each metric; no rows for too short a history."""
    chosen = metric_rows(baseline_days(history, cfg), ["source_file"])
    return (
        chosen.groupBy("metric")
        .agg(
            F.avg("value").alias("mean"),
            F.stddev_samp("value").alias("std"),
            F.min("value").alias("min"),
            F.max("value").alias("max"),
            F.count("*").alias("days"),
        )
        .filter(F.col("days") >= cfg.monitor.baseline_days)
        .drop("days")
    )


def rolling_baseline(history: DataFrame, cfg: Config) -> DataFrame:
    """Mean and deviation over the days before each day. One row per day and metric."""
    before = (
        Window.partitionBy("metric").orderBy("source_file").rowsBetween(-cfg.monitor.baseline_days, -1)
    )
    return (
        metric_rows(history, ["source_file"])
        .withColumns(
            {
                "mean": F.avg("value").over(before),
                "std": F.stddev_samp("value").over(before),
                "days": F.count("value").over(before),
            }
        )
        .filter(F.col("days") >= cfg.monitor.baseline_days)
        .select("source_file", "metric", "value", "mean", "std")
    )


def z_score(value: Column, mean: Column, std: Column) -> Column:
    """Deviations from the mean; 0 when nothing varied, null without a baseline."""
    return F.when(mean.isNull() | value.isNull(), None).when(std > 0, (value - mean) / std).otherwise(0.0)


def metric_zscores(days: DataFrame, baseline: DataFrame, cfg: Config) -> DataFrame:
    """Every metric of every day against the baseline; the baseline has four rows."""
    lim = cfg.monitor
    limits = F.create_map(
        *[
            F.lit(x)
            for pair in zip(METRICS, (lim.events_z, lim.conversions_z, lim.revenue_z, lim.aov_z), strict=True)
            for x in pair
        ]
    )
    score = z_score(F.col("value"), F.col("mean"), F.col("std"))
    return (
        metric_rows(days, ["source_file"])
        .filter("value is not null")
        .join(F.broadcast(baseline), "metric")
        .select(
            "source_file", "metric", "value", "mean", "std",
            score.alias("z_score"),
            (F.abs(score) > limits[F.col("metric")]).alias("is_anomaly"),
        )
    )


def with_baseline(days: DataFrame, cfg: Config) -> DataFrame:
    """Add mean and deviation of revenue and order value over the first days.

    Null for all days when the history is shorter than the baseline. The windows run over
    the day profiles, one row per day.
    """
    ranked = days.withColumn("_day", F.row_number().over(Window.orderBy("source_file")))
    chosen = F.col("_day") <= cfg.monitor.baseline_days
    history = {
        "revenue": F.col("purchase_revenue"),
        "aov": ratio(F.col("purchase_revenue"), F.col("purchase_rows")),
    }
    every = Window.partitionBy()
    enough = F.max("_day").over(every) >= cfg.monitor.baseline_days
    stats = {
        f"{name}_{stat}": F.when(enough, fn(F.when(chosen, value)).over(every))
        for name, value in history.items()
        for stat, fn in (("mean", F.avg), ("std", F.stddev_samp))
    }
    return ranked.withColumns(stats).drop("_day")


# --- alerts ---------------------------------------------------------------------------


def alerts(days: DataFrame, cfg: Config) -> DataFrame:
    """One row per alert, from day profiles that went through `with_baseline`."""
    lim = cfg.monitor
    events, revenue, bought = F.col("events"), F.col("revenue"), F.col("conversions")
    revenue_z = z_score(revenue, F.col("revenue_mean"), F.col("revenue_std"))
    aov_z = z_score(F.col("aov"), F.col("aov_mean"), F.col("aov_std"))
    cart, checkout, paid = (F.col(c) for c in ("has_add_to_cart", "has_checkout_started", "has_purchase"))
    absent = F.array_except(F.array(*[F.lit(c) for c in CORE_CHANNELS]), "channels")
    wanted = F.when(F.col("has_referrer_data"), len(CORE_CHANNELS) + 1).otherwise(len(CORE_CHANNELS))
    table = [
        ("low_event_volume", "CRITICAL", "daily_event_count", events < lim.min_daily_events, events, lim.min_daily_events),
        ("high_event_volume", "WARNING", "daily_event_count", events > lim.max_daily_events, events, lim.max_daily_events),
        ("null_client_rate", "CRITICAL", "null_client_rate",
         F.col("null_client_rate") > lim.max_null_client_rate, F.col("null_client_rate"), lim.max_null_client_rate),
        ("schema_change", "CRITICAL", "schema_columns", F.size("missing_columns") > 0,
         F.col("known_columns"), len(cfg.expected_columns)),
        ("low_revenue", "CRITICAL", "daily_revenue", revenue < lim.min_daily_revenue, revenue, lim.min_daily_revenue),
        ("revenue_anomaly", "WARNING", "daily_revenue", F.abs(revenue_z) > lim.revenue_z, revenue, F.col("revenue_mean")),
        ("low_conversions", "CRITICAL", "daily_conversions", bought < lim.min_daily_conversions, bought, lim.min_daily_conversions),
        ("aov_anomaly", "WARNING", "aov", F.abs(aov_z) > lim.aov_z, F.col("aov"), F.col("aov_mean")),
        ("duplicate_transactions", "CRITICAL", "duplicate_transactions",
         F.col("duplicates") > lim.max_duplicate_transactions, F.col("duplicates"), lim.max_duplicate_transactions),
        ("funnel_inverted", "WARNING", "funnel_integrity", paid > checkout, paid, checkout),
        ("zero_conversions", "CRITICAL", "purchase_rate", (cart > 0) & (paid == 0), F.lit(0), lim.zero_conversion_floor),
        ("traffic_concentration", "WARNING", "channel_concentration",
         F.col("top_share") > lim.max_channel_share, F.col("top_share"), lim.max_channel_share),
        ("missing_channel", "WARNING", "channel_coverage", F.size(absent) > 0, F.size("channels"), wanted),
    ]
    rows = [_alert(i, *spec) for i, spec in enumerate(table, start=1)]
    return (
        days.select("source_file", F.explode(F.array(*rows)).alias("a"))
        .filter("a.fired")
        .select("source_file", "a.*")
        .drop("fired")
    )


def _alert(
    number: int, name: str, severity: str, metric: str, fired: Column, value: Column,
    limit: Column | float,
) -> Column:
    limit_value = (limit if isinstance(limit, Column) else F.lit(limit)).cast("double")
    value = value.cast("double")
    message = F.concat_ws(
        " ", F.lit(name), F.lit(metric), F.format_number(value, 2), F.lit("limit"), F.format_number(limit_value, 2)
    )
    return F.struct(
        F.lit(number).alias("alert_number"),
        F.lit(name).alias("name"),
        F.lit(severity).alias("severity"),
        message.alias("message"),
        F.lit(metric).alias("metric_name"),
        value.alias("current_value"),
        limit_value.alias("threshold"),
        F.coalesce(fired, F.lit(False)).alias("fired"),
    )


def alert_counts(found: DataFrame) -> DataFrame:
    return found.groupBy("source_file", "severity").agg(F.count("*").alias("alerts"))


def metric_results(days: DataFrame, cfg: Config) -> DataFrame:
    """The monitored metrics of each day with baseline and z-score where they have one."""
    lim = cfg.monitor
    none = F.lit(None).cast("double")

    def row(name: str, value: str, base: str | None = None, limit: float = 0.0) -> Column:
        mean = F.col(f"{base}_mean") if base else none
        std = F.col(f"{base}_std") if base else none
        score = z_score(F.col(value), mean, std) if base else none
        return F.struct(
            F.lit(name).alias("metric_name"),
            F.col(value).cast("double").alias("current_value"),
            mean.alias("historical_avg"),
            std.alias("historical_std"),
            score.alias("z_score"),
            F.coalesce(F.abs(score) > limit, F.lit(False)).alias("is_anomaly"),
        )

    rows = F.array(
        row("daily_event_count", "events"),
        row("null_client_rate", "null_client_rate"),
        row("daily_revenue", "revenue", "revenue", lim.revenue_z),
        row("daily_conversions", "conversions"),
        row("average_order_value", "aov", "aov", lim.aov_z),
        row("duplicate_transactions", "duplicates"),
    )
    return (
        days.select("source_file", F.explode(rows).alias("m"))
        .select("source_file", "m.*")
        .filter("current_value is not null")
    )


def critical_verdict(days: DataFrame, found: DataFrame) -> DataFrame:
    """Whether a day raised any CRITICAL alert; quiet days included."""
    worst = found.groupBy("source_file").agg(
        F.max(flag(F.col("severity") == "CRITICAL")).alias("worst")
    )
    return days.select("source_file").join(worst, "source_file", "left").select(
        "source_file", F.coalesce(F.col("worst") == 1, F.lit(False)).alias("critical")
    )
