"""Purchases and their payloads."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame, functions as F

from clickloom.config import Config
from clickloom.functions.channels import TRAFFIC_COLUMNS
from clickloom.functions.payload import email_output, with_payload
from clickloom.operators.sessions import assign_sessions

CONVERSION_COLUMNS = (
    "transaction_id", "client_id", "session_id", "conversion_timestamp", "event_date", "revenue",
    "item_count", "user_email_hash", *TRAFFIC_COLUMNS, "page_url",
)

# What attribution, journeys and totals need of a purchase.
SLIM_COLUMNS = ("client_id", "event_timestamp", "event_date", "revenue", "ingest_order")


def purchase_record(cfg: Config) -> dict[str, Column]:
    """The four payload columns of a conversion. Any fault empties the whole record."""
    sound = (
        F.col("payload.revenue").isNotNull()
        & F.col("payload.item_count").isNotNull()
        & F.col("payload.user_email").isNotNull()
    )
    return {
        "transaction_id": F.when(sound, F.col("payload.transaction_id")),
        "revenue": F.when(sound, F.col("payload.revenue")).otherwise(0.0),
        "item_count": F.when(sound, F.col("payload.item_count")).otherwise(0),
        "user_email_hash": F.when(
            sound, email_output(F.col("payload.user_email"), cfg)
        ).otherwise(""),
    }


def lenient_revenue() -> Column:
    """Revenue of a payload that can be read, null for the others. Needs `payload`."""
    return F.col("payload.revenue")


def purchases(events: DataFrame, cfg: Config) -> DataFrame:
    """All conversion events with their payload columns, duplicates included."""
    selected = with_payload(events.filter(F.col("event_name") == cfg.conversion_event), cfg)
    return selected.withColumns(purchase_record(cfg)).drop("payload")


def first_purchases(
    events: DataFrame, cfg: Config, columns: Collection[str] = SLIM_COLUMNS
) -> DataFrame:
    """The first purchase of each transaction id; purchases without id count as one group.

    An aggregate rather than a window: a frequent id is reduced before the shuffle. Only
    `columns` travel with it.
    """
    time = (F.col("event_timestamp").isNull(), F.col("event_timestamp"))
    client = (F.col("client_id"),)
    order = (*client, *time) if cfg.dedupe_order == "client" else (*time, *client)
    fields = [c.alias(f"o{i}") for i, c in enumerate((*order, F.col("ingest_order")))]
    return (
        purchases(events, cfg)
        .groupBy("transaction_id")
        .agg(F.min_by(F.struct(*columns), F.struct(*fields)).alias("first"))
        .select("transaction_id", "first.*")
        .withColumnRenamed("event_timestamp", "conversion_timestamp")
    )


def conversions(events: DataFrame, numbered_chunks: DataFrame, cfg: Config) -> DataFrame:
    """The conversions table. Sessions are looked up after the duplicates are gone."""
    columns = (*SLIM_COLUMNS, "item_count", "user_email_hash", *TRAFFIC_COLUMNS, "page_url")
    first = first_purchases(events, cfg, columns).withColumnRenamed(
        "conversion_timestamp", "event_timestamp"
    )
    placed = assign_sessions(first, numbered_chunks, cfg)
    return placed.withColumnRenamed("event_timestamp", "conversion_timestamp").select(
        *CONVERSION_COLUMNS, "ingest_order"
    )


def transactions(events: DataFrame, cfg: Config) -> DataFrame:
    """Id, revenue text and time text of every purchase event whose payload can be read."""
    selected = with_payload(events.filter(F.col("event_name").isin(*cfg.purchase_events)), cfg)
    return selected.filter("payload.is_object").select(
        "source_file",
        F.col("payload.transaction_id").alias("transaction_id"),
        F.col("payload.has_transaction").alias("has_transaction"),
        F.col("payload.revenue_text").alias("revenue"),
        "timestamp",
        "ingest_order",
    )
