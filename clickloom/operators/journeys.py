"""The way of each converting client through its sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from clickloom.config import Config
from clickloom.functions.basics import floor_div, join_path, micros, whole_days


def first_conversions(conversions: DataFrame) -> DataFrame:
    """The first conversion of each client, those without a time last."""
    at = F.col("conversion_timestamp")
    order = F.struct(at.isNull().alias("untimed"), at.alias("at"), "ingest_order")
    return (
        conversions.groupBy("client_id")
        .agg(F.min_by(F.struct("conversion_timestamp", "revenue"), order).alias("first"))
        .select("client_id", "first.*")
    )


def journey_sessions(sessions: DataFrame, conversions: DataFrame) -> DataFrame:
    """All sessions of converting clients, those after the conversion included."""
    return sessions.join(conversions.select("client_id").distinct(), "client_id", "left_semi")


def user_journeys(sessions: DataFrame, conversions: DataFrame, cfg: Config) -> DataFrame:
    """One row per converting client.

    Sessions come partitioned by client, so ranking them and adding them up needs no further
    exchange. A client has at most (observed time / gap) sessions; only the handful that make
    up its path are collected.
    """
    latest = Window.partitionBy("client_id").orderBy(F.col("session_number").desc())
    step = F.struct("session_number", F.col("marketing_channel").alias("channel"))
    own = sessions.join(first_conversions(conversions), "client_id")
    journeys = (
        own.withColumn("back", F.row_number().over(latest))
        .groupBy("client_id")
        .agg(
            F.count("*").alias("total_sessions"),
            F.coalesce(F.sum("event_count"), F.lit(0)).alias("total_pageviews"),
            F.min("session_start").alias("first_visit"),
            F.size(F.collect_set("marketing_channel")).cast("long").alias("channels_touched"),
            F.sort_array(F.collect_list(F.when(F.col("back") <= cfg.path_length, step))).alias("steps"),
            F.size(F.collect_set("device_type")).cast("long").alias("devices_used"),
            F.first("conversion_timestamp").alias("conversion_timestamp"),
            F.first("revenue").alias("revenue"),
        )
    )
    converted_at = micros(F.col("conversion_timestamp"))
    return journeys.select(
        "client_id",
        "total_sessions",
        "total_pageviews",
        whole_days(converted_at, micros(F.col("first_visit"))).alias("days_from_first_visit"),
        "channels_touched",
        join_path(F.col("steps.channel")).alias("channel_path"),
        "devices_used",
        F.lit(True).alias("converted"),
        "revenue",
    )


def repeat_journeys(sessions: DataFrame, conversions: DataFrame, cfg: Config) -> DataFrame:
    """One row per timed conversion: its number for the client and the way up to it.

    Conversions are numbered within a chunk of the session gap; only the counts per
    (client, chunk) meet in the window over a client's whole history.
    """
    at = F.col("conversion_timestamp")
    located = conversions.filter(at.isNotNull()).withColumn(
        "chunk", floor_div(micros(at), cfg.gap_us)
    )
    before = Window.partitionBy("client_id").orderBy("chunk").rowsBetween(
        Window.unboundedPreceding, -1
    )
    earlier = (
        located.groupBy("client_id", "chunk")
        .agg(F.count("*").alias("bought"))
        .withColumn("bought_before", F.coalesce(F.sum("bought").over(before), F.lit(0)))
        .drop("bought")
    )
    first_visit = sessions.groupBy("client_id").agg(F.min("session_start").alias("first_visit"))
    within = Window.partitionBy("client_id", "chunk").orderBy("conversion_timestamp", "ingest_order")
    return (
        located.withColumn("place", F.row_number().over(within))
        .join(earlier.join(first_visit, "client_id"), ["client_id", "chunk"])
        .select(
            "transaction_id",
            "client_id",
            "conversion_timestamp",
            (F.col("bought_before") + F.col("place")).alias("conversion_number"),
            F.substring_index("session_id", "_", -1).cast("long").alias("sessions_so_far"),
            whole_days(micros(at), micros(F.col("first_visit"))).alias("days_from_first_visit"),
            "revenue",
        )
    )
