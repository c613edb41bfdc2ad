"""Validation and monitoring kept up to date from day to day without reading old files again.

A file's counters, samples and day profile depend on that file alone, so they are computed once, when
the day is taken in. What spans files works on them: trends, baselines and z-scores on one row a day,
duplicates on the transactions each day left. A `VersionedStore` with, besides the manifest, the tables
`profile`, `days`, `purchases`, `names` and `samples`, and `moments`: four rows a version that hold mean
and deviation of each metric over all days, carried on from the version before.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame

from clickloom.operators import moments as mom
from clickloom.operators import monitoring as m
from clickloom.operators import quality as q
from clickloom.operators.cleaning import normalise_schema, sound_rows
from clickloom.operators.conversions import transactions
from clickloom.plans.monitor import monitoring_tables
from clickloom.plans.validate import validation_tables
from clickloom.session import shared_folder
from clickloom.sources.catalog import day_headers
from clickloom.sources.sinks import store_events
from clickloom.sources.store import VersionedStore


class ProfileStore(VersionedStore):
    FILL_REFERRER = False

    def validation(self) -> dict[str, DataFrame]:
        """The tables of `run_validation` over all days taken in, without their events."""
        tables = validation_tables(self._active("profile"), self._active("purchases"), self._active("samples"), self.cfg)
        return tables | {"invalid_event_names": self._active("names")}

    def monitoring(self) -> dict[str, DataFrame]:
        """The tables of `run_monitoring` over all days taken in."""
        return monitoring_tables(m.with_baseline(self._active("days"), self.cfg), self.cfg)

    def totals(self) -> DataFrame:
        """`metric, n, mean, std` of every metric over all days taken in; reads the last version's four rows."""
        version, _ = self._last()
        return mom.statistics(self._read("moments", version, version))

    def _carried(self, days: DataFrame, version: int) -> DataFrame:
        """The moments before, with those of the new days and without those of the days they replace."""

        def of(some: DataFrame) -> DataFrame:
            return mom.moments(m.metric_rows(m.history_of_days(some), ["source_file"]))

        if version == 1:
            return of(days)
        former = self._active("days", version - 1).join(days.select("source_file"), "source_file", "left_semi")
        before = self._read("moments", version - 1, version - 1).drop("version")
        return mom.joined(before, of(days), without=of(former))

    def _take(self, raw: DataFrame, files: DataFrame, version: int) -> int:
        cfg = self.cfg
        # The run's own days, written once as columns: every table below reads the few it needs.
        raw = store_events(sound_rows(raw), f"{shared_folder(self.spark)}/profile-{uuid4().hex}")
        headers = day_headers(files)
        events, filled = normalise_schema(raw, cfg, fill_referrer=False), normalise_schema(raw, cfg)
        self._write(q.file_profile(events, headers, cfg), "profile", version)
        days = self._write(m.day_profile(filled, cfg, headers), "days", version)
        self._write(self._carried(days, version), "moments", version)
        self._write(transactions(events, cfg), "purchases", version)
        self._write(q.invalid_event_names(events, cfg), "names", version)
        self._write(q.all_samples(events, cfg), "samples", version)
        self._commit(version, self._last()[1])
        return version
