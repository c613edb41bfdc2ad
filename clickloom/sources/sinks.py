"""Writing the derived tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

# The date column each table is partitioned by.
DATE_COLUMNS = {
    "events_enriched": "event_date",
    "sessions": "session_date",
    "conversions": "event_date",
    "attribution": "conversion_date",
    "channel_summary": "date",
}

# Quotes doubled, spaces kept: what the reader gives back is what was written.
CSV_OUTPUT = {
    "header": "true",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
}

# The order of rows within a date, or within a table without one.
ORDER = {
    "events_enriched": ("client_id", "event_timestamp"),
    "sessions": ("client_id", "session_start"),
    "conversions": ("conversion_timestamp", "transaction_id"),
    "attribution": ("conversion_timestamp", "transaction_id"),
    "channel_summary": ("channel", "attribution_model"),
    "user_journeys": ("client_id",),
}


def write_table(
    frame: DataFrame, folder: str, name: str, fmt: str = "parquet", dynamic: bool = False, ordered: bool = False,
    observed: Observation | None = None,
) -> str:
    """Write one table, replacing it; with `dynamic` only the dates in `frame` are replaced.

    Rows are rebalanced by date, which splits a large day over several files, and sorted within
    each file; there is no order across files. With `ordered` they are cut into ranges of date and
    key instead, from sampled bounds, so that a date's files read by name are in order throughout;
    the sample costs a run of `frame`, which should be a stored one. `observed` gets the number of
    `rows` while they are written, behind the last shuffle, so that a repeated task counts once.
    """
    path = f"{folder.rstrip('/')}/{name}"
    date = DATE_COLUMNS.get(name)
    order = [c for c in (date, *ORDER.get(name, ())) if c in frame.columns]
    if ordered and order:
        rows = frame.repartitionByRange(*order)
    else:
        rows = frame.hint("rebalance", date) if date else frame
    rows = rows.sortWithinPartitions(*order) if order else rows
    if observed:
        rows = rows.observe(observed, F.count(F.lit(1)).alias("rows"))
    writer = rows.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.options(**CSV_OUTPUT)
    if date:
        writer = writer.partitionBy(date)
        if dynamic:
            writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.save(path)
    return path


def write_tables(frames: Mapping[str, DataFrame], folder: str, fmt: str = "parquet", ordered: bool = False) -> dict[str, int]:
    """Write several tables; the rows of each, counted by the job that writes it."""
    counts = {}
    for name, frame in frames.items():
        observed = Observation(name)
        write_table(frame, folder, name, fmt, ordered=ordered, observed=observed)
        counts[name] = observed.get["rows"]
    return counts


def store_events(events: DataFrame, path: str) -> DataFrame:
    """Raw events as Parquet by file, and the frame that reads them back.

    Text files are scanned once this way; later scans read the columns and days they need,
    and `ingest_order` is fixed. Each task writes the split it read, without a shuffle.
    """
    events.write.mode("overwrite").partitionBy("source_file").parquet(path)
    stored = events.sparkSession.read.schema(events.schema).parquet(path)
    return stored.select(events.columns)


def row_counts(spark: SparkSession, paths: Mapping[str, str]) -> dict[str, int]:
    """Rows per written table, from file footers."""
    return {name: spark.read.parquet(path).count() for name, path in paths.items()}


def write_alerts(found: DataFrame, folder: str, days: DataFrame | None = None, run: str = "") -> str:
    """Alerts as JSON lines for other programs, a folder per day, stamped with run and time.

    Each day's folder holds one line of kind `day` and one of kind `alert` for each alert, and is
    replaced as a whole when the run is committed: a run that is repeated, or that died and is run
    again, leaves one set for each of its days, and other days as they were. `days`, by default those
    that have alerts, are the days that were looked at (`source_file`): a day whose alerts are gone
    is replaced by its line alone.
    """
    path = f"{folder.rstrip('/')}/alerts"
    days = (found if days is None else days).select("source_file").distinct()
    marks = days.select("source_file", F.lit("day").alias("kind"))
    lines = marks.unionByName(found.withColumn("kind", F.lit("alert")), allowMissingColumns=True)
    stamped = lines.withColumns({"run": F.lit(run), "raised_at": F.current_timestamp()})
    writer = stamped.repartition("source_file").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("source_file").json(path)
    return path
