"""Sessions kept up to date from day to day without reading old files again.

A `VersionedStore` with, besides the manifest, three tables:

    partials  chunk summaries of each day, mergeable over days
    touched   the clients whose sessions a version replaces
    sessions  all sessions of those clients

Clients neither in the new nor in the former version of the days of a run keep the rows they have.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clickloom.functions.channels import with_traffic_source
from clickloom.operators import sessions as se
from clickloom.operators.cleaning import clean_events
from clickloom.sources.store import VersionedStore


class SessionStore(VersionedStore):
    def sessions(self, version: int | None = None) -> DataFrame:
        """All sessions as of the last, or of an earlier version that was not compacted since."""
        last, base = self._last()
        last = last if version is None else version
        newest = self._read("touched", last, base).groupBy("client_id").agg(F.max("version").alias("version"))
        table = self._read("sessions", last, base)
        return table.join(newest, ["client_id", "version"], "left_semi").select([c for c in table.columns if c != "version"])

    def history(self) -> DataFrame:
        """`version, days, files, clients`: what each run read and whose sessions it replaced."""
        version, _ = self._last()
        read = self._read("files", version).groupBy("version").agg(F.countDistinct("source_file").alias("days"), F.count("path").alias("files"))
        return read.join(self._read("touched", version).groupBy("version").agg(F.count("*").alias("clients")), "version", "left")

    def _take(self, raw: DataFrame, files: DataFrame, version: int) -> int:
        events = with_traffic_source(clean_events(raw, self.cfg), self.cfg)
        parts = self._write(se.summarise_chunks(events, self.cfg, "source_file"), "partials", version)
        touched = parts.select("client_id")
        if version > 1:
            days = files.select("source_file").distinct()
            before = self._active("partials", version - 1)
            touched = touched.unionByName(before.join(days, "source_file", "left_semi").select("client_id"))
            parts = parts.unionByName(before.join(days, "source_file", "left_anti"))
        touched = self._write(touched.distinct(), "touched", version)
        chunks = se.merged_chunks(parts.join(touched, "client_id", "left_semi"))
        self._write(se.sessions_from_chunks(se.number_chunks(chunks, self.cfg)), "sessions", version)
        self._commit(version, self._last()[1])
        return version

    def compact(self) -> int:
        """Write all sessions as one version, so that reading them needs no older one."""
        version = self._last()[0] + 1
        sessions = self._write(self.sessions(), "sessions", version)
        self._write(sessions.select("client_id").distinct(), "touched", version)
        for name in ("files", "partials"):
            self._write(self._read(name, version - 1).drop("version").limit(0), name, version)
        self._commit(version, version)
        return version
