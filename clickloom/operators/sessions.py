"""Sessions without ever bringing all events of one client together.

Time is cut into chunks as wide as the session gap. Two events in one chunk are less than a
gap apart, so a chunk never spans a session break: its events can be pre-aggregated on the
map side, and only one summary row per (client, chunk) meets in the window that finds the
breaks. A client therefore has at most (observed time / gap) rows there, however many events
it sent. Chunk summaries merge again, which also gives the incremental update.

Events without a time are sessions of their own, numbered after the others in input order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from clickloom.config import Config
from clickloom.functions.agents import browser, device_type
from clickloom.functions.basics import flag, floor_div, micros, numbered_id
from clickloom.functions.channels import TRAFFIC_COLUMNS

CHUNK_KEYS = ("client_id", "chunk", "untimed")
_FLAGS = ("has_add_to_cart", "has_checkout_started", "has_purchase", "has_email_signup")
_FIRSTS = ("first_touch", "first_page", "first_referrer", "first_agent")


def with_chunk(events: DataFrame, cfg: Config) -> DataFrame:
    """Add `chunk`, and `untimed` which sets every event without a time apart."""
    ts = F.col("event_timestamp")
    return events.withColumns(
        {
            "chunk": floor_div(micros(ts), cfg.gap_us),
            "untimed": F.when(ts.isNull(), F.col("ingest_order")),
        }
    )


def summarise_chunks(events: DataFrame, cfg: Config, *more_keys: str) -> DataFrame:
    """One row per (client, chunk), and per `more_keys`: times, flags and the first known attributes."""
    order = F.struct("event_timestamp", "ingest_order")

    def first_known(value: Column, known: Column, name: str) -> Column:
        return F.min(F.when(known, F.struct(order.alias("at"), value.alias("value")))).alias(name)

    def happened(event: str, name: str) -> Column:
        return F.max(flag(F.col("event_name") == event)).alias(name)

    touch = F.struct(*TRAFFIC_COLUMNS)
    return (
        with_chunk(events, cfg)
        .groupBy(*more_keys, *CHUNK_KEYS)
        .agg(
            F.min("event_timestamp").alias("first_ts"),
            F.max("event_timestamp").alias("last_ts"),
            F.count("event_timestamp").alias("timed_events"),
            happened(cfg.cart_event, "has_add_to_cart"),
            happened(cfg.checkout_event, "has_checkout_started"),
            happened(cfg.conversion_event, "has_purchase"),
            happened(cfg.email_event, "has_email_signup"),
            first_known(touch, F.lit(True), "first_touch"),
            first_known(F.col("page_url"), F.col("page_url").isNotNull(), "first_page"),
            first_known(F.col("referrer"), F.col("referrer").isNotNull(), "first_referrer"),
            first_known(F.col("user_agent"), F.col("user_agent").isNotNull(), "first_agent"),
        )
    )


def _merged() -> list[Column]:
    return [
        F.min("first_ts").alias("first_ts"),
        F.max("last_ts").alias("last_ts"),
        F.sum("timed_events").alias("timed_events"),
        *[F.max(c).alias(c) for c in _FLAGS],
        *[F.min(c).alias(c) for c in _FIRSTS],
    ]


def merged_chunks(parts: DataFrame) -> DataFrame:
    """One summary per (client, chunk) from summaries of disjoint sets of events."""
    return parts.groupBy(*CHUNK_KEYS).agg(*_merged())


def merge_chunks(old: DataFrame, new: DataFrame) -> DataFrame:
    """Chunk summaries of the union of two disjoint sets of events."""
    return merged_chunks(old.unionByName(new))


def number_chunks(chunks: DataFrame, cfg: Config) -> DataFrame:
    """Add `session_number`, 1, 2, … per client in time order.

    A chunk opens a session when it starts more than the gap after the last event before it.
    """
    in_time = Window.partitionBy("client_id").orderBy(F.col("chunk").asc_nulls_last(), "untimed")
    idle = micros(F.col("first_ts")) - micros(F.lag("last_ts").over(in_time))
    opens = F.when(idle.isNull() | (idle > cfg.gap_us), 1).otherwise(0)
    return chunks.withColumn("_opens", opens).withColumn(
        "session_number",
        F.sum("_opens").over(in_time.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
    ).drop("_opens")


def sessions_from_chunks(numbered: DataFrame) -> DataFrame:
    """The sessions table from numbered chunks; stays in the partitioning by client."""
    merged = numbered.groupBy("client_id", "session_number").agg(*_merged())
    touch, agent = F.col("first_touch.value"), F.col("first_agent.value")
    seconds = (micros(F.col("last_ts")) - micros(F.col("first_ts"))) / F.lit(1e6)
    return merged.select(
        numbered_id(F.col("client_id"), F.col("session_number")).alias("session_id"),
        "client_id",
        F.col("first_ts").alias("session_start"),
        F.col("last_ts").alias("session_end"),
        F.col("timed_events").alias("event_count"),
        *[touch[c].alias(c) for c in TRAFFIC_COLUMNS],
        F.col("first_page.value").alias("landing_page"),
        F.col("first_referrer.value").alias("referrer"),
        agent.alias("user_agent"),
        F.to_date("first_ts").alias("session_date"),
        seconds.alias("session_duration_seconds"),
        *[(F.col(c) == 1).alias(c) for c in _FLAGS],
        device_type(agent).alias("device_type"),
        browser(agent).alias("browser"),
        "session_number",
    )


def sessions(events: DataFrame, cfg: Config) -> DataFrame:
    """One row per session of classified events."""
    return sessions_from_chunks(number_chunks(summarise_chunks(events, cfg), cfg))


def assign_sessions(events: DataFrame, numbered: DataFrame, cfg: Config) -> DataFrame:
    """Add `session_id` to events from the chunks they fall into (at most one row per key)."""
    keys = numbered.select(*CHUNK_KEYS, "session_number")
    placed = with_chunk(events, cfg).alias("e").join(
        keys.alias("k"),
        (F.col("e.client_id") == F.col("k.client_id"))
        & F.col("e.chunk").eqNullSafe(F.col("k.chunk"))
        & F.col("e.untimed").eqNullSafe(F.col("k.untimed")),
        "left",
    )
    session_id = numbered_id(F.col("e.client_id"), F.col("k.session_number"))
    return placed.select(*[F.col(f"e.{c}") for c in events.columns], session_id.alias("session_id"))


def sessionize(events: DataFrame, cfg: Config) -> DataFrame:
    """Classified events with their `session_id`."""
    return assign_sessions(events, number_chunks(summarise_chunks(events, cfg), cfg), cfg)


def incremental_sessions(
    stored_chunks: DataFrame, new_events: DataFrame, cfg: Config
) -> tuple[DataFrame, DataFrame]:
    """Stored chunk summaries brought up to date, and the sessions of the clients seen anew.

    Only those clients are numbered again; the sessions of all others stay as they are.
    """
    fresh = summarise_chunks(new_events, cfg)
    seen = fresh.select("client_id").distinct()
    reopened = merge_chunks(stored_chunks.join(seen, "client_id", "left_semi"), fresh)
    updated = sessions_from_chunks(number_chunks(reopened, cfg))
    return merge_chunks(stored_chunks, fresh), updated
