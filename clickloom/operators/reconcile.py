"""Checks of the derived tables against the raw events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from clickloom.config import Config
from clickloom.functions.basics import count_if, exact_sum, is_blank, ratio
from clickloom.functions.payload import with_payload
from clickloom.operators.cleaning import CORRUPT, event_time, normalise_schema


def reconciliation(
    raw: DataFrame, enriched: DataFrame, sessions: DataFrame, conversions: DataFrame,
    attributed: DataFrame, cfg: Config,
) -> DataFrame:
    """Seven checks: what the source holds, what the tables hold, a figure, a verdict.

    Each table is aggregated once to one row; the checks combine those rows.
    """
    bought = F.col("event_name") == cfg.conversion_event
    source = with_payload(raw, cfg).agg(
        F.count("*").alias("raw_events"),
        count_if(bought).alias("raw_purchases"),
        exact_sum(F.when(bought, F.col("payload.revenue"))).alias("raw_revenue"),
    )
    broken = F.col(CORRUPT).isNotNull() if CORRUPT in raw.columns else F.lit(False)
    untimed = F.col("timestamp").isNotNull() & event_time(F.col("timestamp")).isNull()
    left_out = normalise_schema(raw, cfg).agg(
        count_if(broken | untimed).alias("rejected"),
        count_if(~(broken | untimed) & is_blank(F.col("client_id"))).alias("without_client"),
    )
    per_client = enriched.groupBy("client_id").agg(
        F.count("*").alias("n"), F.count("session_id").alias("placed")
    )
    events = per_client.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("events"),
        F.coalesce(F.sum("placed"), F.lit(0)).alias("placed"),
        F.count("*").alias("clients"),
    )
    bought_rows = conversions.agg(
        F.count("*").alias("orders"), exact_sum(F.col("revenue")).alias("revenue")
    )
    totals = (
        source.withColumn("l", left_out.select(F.struct("*")).scalar())
        .withColumn("e", events.select(F.struct("*")).scalar())
        .withColumn("c", bought_rows.select(F.struct("*")).scalar())
        .withColumn("n_sessions", sessions.agg(F.count("*")).scalar())
        .withColumn("n_attributed", attributed.agg(F.count("*")).scalar())
    )
    e, c = F.col("e"), F.col("c")
    rows = F.array(
        _row(1, "event_count", F.col("raw_events"), e["events"],
             F.col("raw_events") - e["events"], F.lit(True)),
        _row(2, "events_sessionized", e["events"], e["placed"],
             e["events"] - e["placed"], e["events"] == e["placed"]),
        _row(3, "conversion_count", F.col("raw_purchases"), c["orders"],
             F.col("raw_purchases") - c["orders"], c["orders"] <= F.col("raw_purchases")),
        _row(4, "revenue_total", F.col("raw_revenue"), c["revenue"],
             F.round(F.col("raw_revenue") - c["revenue"], 2), F.lit(True)),
        _row(5, "attribution_coverage", c["orders"], F.col("n_attributed"),
             F.try_divide(F.col("n_attributed") * F.lit(100.0), c["orders"]),
             F.col("n_attributed") == c["orders"]),
        _row(6, "sessions_per_client", e["clients"], F.col("n_sessions"),
             F.round(ratio(F.col("n_sessions"), e["clients"]), 4),
             F.col("n_sessions") >= e["clients"]),
        _row(7, "rows_accounted_for", F.col("raw_events"),
             e["events"] + F.col("l.without_client") + F.col("l.rejected"), F.col("l.rejected"),
             F.col("raw_events") == e["events"] + F.col("l.without_client") + F.col("l.rejected")),
    )
    return totals.select(F.inline(rows))


def _row(number: int, check: str, original: Column, derived: Column, note: Column, ok: Column) -> Column:
    return F.struct(
        F.lit(number).alias("check_number"),
        F.lit(check).alias("check_name"),
        original.cast("double").alias("original"),
        derived.cast("double").alias("transformed"),
        note.cast("double").alias("note"),
        ok.alias("passed"),
    )
