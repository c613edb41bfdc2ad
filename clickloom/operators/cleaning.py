"""From raw text columns to typed, usable events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from clickloom.config import Config
from clickloom.functions.basics import is_blank


# The text of a row that the reader could not take apart; files are read with it.
CORRUPT = "corrupt_record"


def normalise_schema(raw: DataFrame, cfg: Config, fill_referrer: bool = True) -> DataFrame:
    """Rename `clientId` (exact spelling) and add the expected columns a file lacks.

    A missing referrer becomes '' when `fill_referrer`, else null like any other column.
    """
    columns = [F.col(f"`{c}`").alias("client_id" if c == "clientId" else c) for c in raw.columns]
    named = raw.select(*columns)
    missing = [c for c in cfg.expected_columns if c not in named.columns]
    for name in missing:
        default = "" if name == "referrer" and fill_referrer else None
        named = named.withColumn(name, F.lit(default).cast("string"))
    return named


def null_out_tokens(raw: DataFrame, cfg: Config) -> DataFrame:
    """Turn the configured missing-value texts of every expected column into null."""
    present = [c for c in raw.columns if c in (*cfg.expected_columns, "clientId")]
    return raw.withColumns(
        {c: F.when(~F.col(c).isin(*cfg.null_tokens), F.col(c)) for c in present}
    )


def event_time(text: Column) -> Column:
    """Timestamp from ISO text, null when it cannot be read."""
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), text.try_cast("timestamp"))


def parse_event_time(events: DataFrame, cfg: Config) -> tuple[DataFrame, DataFrame]:
    """Add `event_timestamp` and `event_date`; rows with unreadable text go to the second frame.

    Rows without any timestamp text stay, with null time.
    """
    # As with payloads, exploding one element keeps the filters below from parsing again.
    parsed = events.withColumn(
        "event_timestamp", F.explode(F.array(event_time(F.col("timestamp"))))
    ).withColumn("event_date", F.to_date("event_timestamp"))
    unreadable = F.col("timestamp").isNotNull() & F.col("event_timestamp").isNull()
    return parsed.filter(~unreadable), parsed.filter(unreadable)


def drop_null_clients(events: DataFrame) -> DataFrame:
    return events.filter(~is_blank(F.col("client_id")))


def sound_rows(raw: DataFrame) -> DataFrame:
    """Rows that the reader could take apart."""
    return raw.filter(F.col(CORRUPT).isNull()).drop(CORRUPT) if CORRUPT in raw.columns else raw


def rejects(raw: DataFrame, cfg: Config) -> DataFrame:
    """Rows that no table takes in, as they came, with the `reason`: their cells or their time can't be read."""
    named = normalise_schema(raw, cfg)
    if CORRUPT not in named.columns:
        named = named.withColumn(CORRUPT, F.lit(None).cast("string"))
    unreadable = F.col("timestamp").isNotNull() & event_time(F.col("timestamp")).isNull()
    reason = F.when(F.col(CORRUPT).isNotNull(), "malformed_row").when(unreadable, "unreadable_time")
    return named.withColumn("reason", reason).filter("reason IS NOT NULL")


def clean_events(raw: DataFrame, cfg: Config) -> DataFrame:
    """Named, typed events that have a client; what is left out is null clients and `rejects`."""
    timed, _ = parse_event_time(normalise_schema(sound_rows(raw), cfg), cfg)
    return drop_null_clients(timed)


def file_date(source_file: Column) -> Column:
    """First run of eight digits in a file name, '' when there is none."""
    return F.regexp_extract(source_file, r"([0-9]{8})", 1)
