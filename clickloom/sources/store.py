"""A folder of tables that grows by versions, each of them there whole or not at all.

Every run writes its rows of each table to a folder of its own, `name/version=n`, and then one row to
`log`. That row is a single small file, so what a run left behind that died before it is ignored, and
overwritten by the next run. One run at a time may write; readers see the last version in the log,
whatever is being written.

`files` is the manifest: the data files a version took in. A day is replaced as a whole: if any of its
files is new or has changed, all of them are read, and rows of the day's former version do not count.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from clickloom.config import Config
from clickloom.sources.catalog import data_files, read_catalog
from clickloom.sources.daily_files import read_cataloged

LOG = "version long, base long, added timestamp"


@dataclass(frozen=True)
class VersionedStore:
    spark: SparkSession
    folder: str
    cfg: Config

    FILL_REFERRER = True

    # --- versions ---------------------------------------------------------------------

    def log(self) -> DataFrame:
        """`version, base, added`: the versions there are, and for each the first one its readers need."""
        try:
            return self.spark.read.schema(LOG).parquet(f"{self.folder}/log")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], LOG)

    def _last(self) -> tuple[int, int]:
        row = self.log().agg(F.max("version").alias("version"), F.max("base").alias("base")).first()
        return row.version or 0, row.base or 1

    def _commit(self, version: int, base: int) -> None:
        row = self.spark.range(1).select(
            F.lit(version).cast("long").alias("version"), F.lit(base).cast("long").alias("base"), F.current_timestamp().alias("added")
        )
        row.coalesce(1).write.mode("append").parquet(f"{self.folder}/log")

    def _write(self, frame: DataFrame, name: str, version: int) -> DataFrame:
        path = f"{self.folder}/{name}/version={version}"
        frame.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(frame.schema).parquet(path)

    def _read(self, name: str, last: int, first: int = 1) -> DataFrame:
        """A table over some versions, with their `version`."""
        if last < first:
            raise ValueError(f"nothing was taken into {self.folder} yet")
        table = self.spark.read.parquet(f"{self.folder}/{name}")
        return table.withColumn("version", F.col("version").cast("long")).filter(F.col("version").between(first, last))

    def _days(self, version: int) -> DataFrame:
        """`source_file, version`: the version that holds each day; one row a day."""
        return self._read("files", version).groupBy("source_file").agg(F.max("version").alias("version"))

    def _active(self, name: str, version: int | None = None) -> DataFrame:
        """The rows of a table that hold for each day as of a version, the last one by default."""
        version = self._last()[0] if version is None else version
        table = self._read(name, version)
        columns = [c for c in table.columns if c != "version"]
        return table.join(self._days(version), ["source_file", "version"], "left_semi").select(columns)

    def files(self) -> DataFrame:
        """The manifest: the files that make up each day now."""
        return self._active("files")

    # --- runs -------------------------------------------------------------------------

    def take_folder(self, folder: str) -> int:
        """Take in the days of a folder that have new or changed files; the version afterwards.

        Files that are gone from the folder stay taken in.
        """
        version, _ = self._last()
        listed = data_files(self.spark, folder)
        if version:
            known = self.files().select("path", "length", "modified")
            same = [listed[c].eqNullSafe(known[c]) for c in ("path", "length", "modified")]
            days = listed.join(known, same, "left_anti").select("source_file").distinct()
            listed = listed.join(days, "source_file", "left_semi")
        catalog = read_catalog(self.spark, folder, listed.select("path", "source_file", "length", "modified"))
        files = self._write(catalog, "files", version + 1)  # not in the log yet, so this is no more than a note
        if files.isEmpty():
            return version
        return self._take(read_cataloged(self.spark, files, self.cfg, self.FILL_REFERRER), files, version + 1)

    def take_events(self, raw: DataFrame, headers: DataFrame | None = None) -> int:
        """Take in raw events, and headers, as `read_daily_files` gives them; each of their days is replaced whole."""
        version = self._last()[0] + 1
        if headers is None:
            columns = F.array(*[F.lit(c) for c in self.cfg.expected_columns])
            headers = raw.select("source_file").distinct().withColumn("columns", columns)
        none = F.lit(None)
        files = headers.select(
            none.cast("string").alias("path"), "source_file", none.cast("long").alias("length"), none.cast("timestamp").alias("modified"), "columns"
        )
        return self._take(raw, self._write(files, "files", version), version)

    def _take(self, raw: DataFrame, files: DataFrame, version: int) -> int:
        """Write the tables of a version from its days' events and commit it."""
        raise NotImplementedError
