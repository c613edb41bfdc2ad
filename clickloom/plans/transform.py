"""From raw events to the six derived tables."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from clickloom.config import Config
from clickloom.functions.channels import with_traffic_source
from clickloom.operators import attribution as at
from clickloom.operators import sessions as se
from clickloom.operators.cleaning import clean_events, rejects
from clickloom.operators.conversions import conversions, first_purchases
from clickloom.operators.journeys import user_journeys
from clickloom.operators.reconcile import reconciliation
from clickloom.session import shared_folder
from clickloom.sources.daily_files import read_daily_files
from clickloom.sources.sinks import CSV_OUTPUT, store_events, write_tables


@dataclass(frozen=True)
class Derived:
    """The lazy tables of one set of raw events. Each is only computed when it is used."""

    raw: DataFrame
    cfg: Config

    @cached_property
    def events(self) -> DataFrame:
        return with_traffic_source(clean_events(self.raw, self.cfg), self.cfg)

    @cached_property
    def chunks(self) -> DataFrame:
        return se.number_chunks(se.summarise_chunks(self.events, self.cfg), self.cfg)

    @cached_property
    def events_enriched(self) -> DataFrame:
        return se.assign_sessions(self.events, self.chunks, self.cfg)

    @cached_property
    def sessions(self) -> DataFrame:
        return se.sessions_from_chunks(self.chunks)

    @cached_property
    def purchases(self) -> DataFrame:
        """Deduplicated conversions without their session, for uses that need none."""
        return first_purchases(self.events, self.cfg)

    @cached_property
    def conversions(self) -> DataFrame:
        return conversions(self.events, self.chunks, self.cfg)

    @cached_property
    def attribution(self) -> DataFrame:
        return at.attribution(self.purchases, self.sessions, self.cfg)

    @cached_property
    def channel_summary(self) -> DataFrame:
        return at.channel_summary(self.attribution)

    @cached_property
    def user_journeys(self) -> DataFrame:
        return user_journeys(self.sessions, self.purchases, self.cfg)


def run_transformation(
    spark: SparkSession, source: str | DataFrame, folder: str, cfg: Config, fmt: str = "parquet", ordered: bool = False
) -> dict[str, DataFrame]:
    """Write the six tables and the rejects, and return them as read back, plus row counts and the checks.

    With `ordered` the files of each date, read by name, are in order throughout (see `write_table`).

    Raw files, numbered chunks, conversions and attribution feed several tables, so each is
    written once to the shared folder and read back: later tables do not repeat the work, and
    losing an executor costs no more than the stage it ran.
    """
    work = f"{shared_folder(spark)}/transform-{uuid4().hex}"
    if isinstance(source, str):
        raw = store_events(read_daily_files(spark, source, cfg)[0], f"{work}/raw")
    else:
        raw = source

    def stored(frame: DataFrame, name: str) -> DataFrame:
        path = f"{work}/{name}"
        frame.write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)

    lazy = Derived(raw, cfg)
    chunks = stored(lazy.chunks, "chunks")
    sessions = stored(se.sessions_from_chunks(chunks), "sessions")
    bought = stored(conversions(lazy.events, chunks, cfg), "conversions")
    attributed = stored(at.attribution(bought, sessions, cfg), "attribution")
    tables = {
        "events_enriched": se.assign_sessions(lazy.events, chunks, cfg).drop("ingest_order"),
        "sessions": sessions.drop("session_number"),
        "conversions": bought.drop("ingest_order"),
        "attribution": attributed,
        "channel_summary": at.channel_summary(attributed),
        "user_journeys": user_journeys(sessions, bought, cfg),
        "rejects": rejects(raw, cfg).drop("ingest_order"),
    }
    counts = write_tables(tables, folder, fmt, ordered)
    written = {"row_counts": spark.createDataFrame(list(counts.items()), "table_name string, rows long")}
    for name, frame in tables.items():
        reader = spark.read.schema(frame.schema).format(fmt).options(**CSV_OUTPUT)
        written[name] = reader.load(f"{folder.rstrip('/')}/{name}").select(frame.columns)
    written["reconciliation"] = reconciliation(
        raw, written["events_enriched"], sessions, bought, attributed, cfg
    )
    return written
