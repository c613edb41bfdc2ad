"""Arriving events as a stream: sessions, duplicates and daily counters.

Batch and stream agree on session bounds: a session window closes after its gap, which is
half-open, so one microsecond more keeps events exactly one gap apart together.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import DataStreamWriter

from clickloom.config import EXPECTED_COLUMNS, Config
from clickloom.functions.basics import count_if, flag, is_blank, micros
from clickloom.functions.payload import with_payload
from clickloom.operators.cleaning import CORRUPT, event_time, null_out_tokens, sound_rows
from clickloom.sources.catalog import as_data_files, read_catalog
from clickloom.sources.daily_files import TAGS, read_cataloged

_LANDED = T.StructType(
    [T.StructField(c, T.StringType()) for c in EXPECTED_COLUMNS] + TAGS.fields + [T.StructField(CORRUPT, T.StringType())]
)


def read_arriving_files(spark: SparkSession, folder: str, cfg: Config, files_per_batch: int = 16) -> DataFrame:
    """Text events of the current header from files as they arrive, with their time.

    A file with another header stops the stream with an error; `land_files` takes files of any header.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in cfg.expected_columns])
    rows = (
        spark.readStream.schema(schema)
        .options(header="true", enforceSchema="false", quote='"', escape='"', maxFilesPerTrigger=str(files_per_batch))
        .csv(folder)
    )
    tagged = rows.select("*", F.col("_metadata.file_name").alias("source_file"))
    return null_out_tokens(tagged, cfg).withColumn("event_timestamp", event_time(F.col("timestamp")))


def land_files(
    spark: SparkSession, folder: str, landed: str, cfg: Config, checkpoint: str, files_per_batch: int = 1000
) -> DataStreamWriter:
    """Arriving files, each read with its own header, as Parquet with the expected columns.

    The stream is one of file names; each batch of them is catalogued and read like a folder of daily
    files. A batch has a folder of its own and replaces it, so a repeated batch lands once.
    """
    names = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .options(recursiveFileLookup="true", maxFilesPerTrigger=str(files_per_batch))
        .load(folder)
        .select("path", "length", "modificationTime")
    )

    def land(batch: DataFrame, number: int) -> None:
        own = batch.sparkSession
        events = read_cataloged(own, read_catalog(own, folder, as_data_files(batch)), cfg)
        if CORRUPT not in events.columns:
            events = events.withColumn(CORRUPT, F.lit(None).cast("string"))
        events.select([f.name for f in _LANDED.fields]).write.mode("overwrite").parquet(f"{landed}/batch={number}")

    return names.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)


def read_landed(spark: SparkSession, landed: str, files_per_batch: int = 16) -> DataFrame:
    """What `land_files` wrote as a stream of text events with their time; rows that no header fits are left out."""
    rows = spark.readStream.schema(_LANDED).option("maxFilesPerTrigger", str(files_per_batch)).parquet(f"{landed}/batch=*")
    return sound_rows(rows).drop("ingest_order").withColumn("event_timestamp", event_time(F.col("timestamp")))


def stream_sessions(events: DataFrame, cfg: Config, late: str = "1 hour") -> DataFrame:
    """Sessions of timed events, emitted once the watermark has passed them.

    State is one row per open session. Sessions are named by client and start.
    """
    gap = f"{cfg.gap_us + 1} microseconds"
    grouped = (
        events.filter(~is_blank(F.col("client_id")))
        .withWatermark("event_timestamp", late)
        .groupBy("client_id", F.session_window("event_timestamp", gap).alias("span"))
        .agg(
            F.count("*").alias("event_count"),
            F.max(flag(F.col("event_name") == cfg.conversion_event)).alias("purchased"),
        )
    )
    end_us = micros(F.col("span.end")) - F.lit(cfg.gap_us + 1)
    return grouped.select(
        "client_id",
        F.col("span.start").alias("session_start"),
        F.timestamp_micros(end_us).alias("session_end"),
        "event_count",
        (F.col("purchased") == 1).alias("has_purchase"),
    )


def stream_conversions(events: DataFrame, cfg: Config, late: str = "1 day") -> DataFrame:
    """Conversions with an id, the first arrival of each id within the watermark."""
    bought = with_payload(events.filter(F.col("event_name") == cfg.conversion_event), cfg)
    return (
        bought.filter("payload.has_transaction")
        .select(
            F.col("payload.transaction_id").alias("transaction_id"),
            F.col("payload.revenue").alias("revenue"),
            "client_id",
            "event_timestamp",
        )
        .withWatermark("event_timestamp", late)
        .dropDuplicatesWithinWatermark(["transaction_id"])
    )


def stream_daily_counters(events: DataFrame, cfg: Config, late: str = "1 day") -> DataFrame:
    """Events, missing clients and purchases per day, emitted when a day is complete."""
    return (
        events.withWatermark("event_timestamp", late)
        .groupBy(F.window("event_timestamp", "1 day").alias("day"))
        .agg(
            F.count("*").alias("events"),
            count_if(is_blank(F.col("client_id"))).alias("null_clients"),
            count_if(F.col("event_name") == cfg.conversion_event).alias("conversions"),
        )
        .select(F.to_date("day.start").alias("date"), "events", "null_clients", "conversions")
    )


def each_batch(
    events: DataFrame, work: Callable[[DataFrame], None], checkpoint: str
) -> DataStreamWriter:
    """Apply a batch run, such as validation or monitoring, to every batch of new files.

    `work` must replace what it writes for the files it sees, since a batch may be repeated.
    """
    return events.writeStream.foreachBatch(lambda batch, _: work(batch)).option(
        "checkpointLocation", checkpoint
    )
