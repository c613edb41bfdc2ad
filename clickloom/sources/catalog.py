"""What lies in a folder of daily files: each data file with its day, size, time and header.

One job reads all headers: every task opens one file and stops behind its first lines, so the work
grows with the number of files and not with their size, and the driver starts no read of its own.
That is what the RDD is for: no DataFrame operator stops early in each partition.
"""

from __future__ import annotations

import csv
from collections.abc import Callable, Iterator
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clickloom.session import shared_folder

DAY = r"(?:^|[/=])(events_[^/]*\.csv)(?=/|$)"
# A file is a partition of its own when opening it counts as much as a whole partition.
_ONE_FILE_A_TASK = {
    "spark.sql.files.openCostInBytes": "1g",
    "spark.sql.files.maxPartitionBytes": "1g",
}


def _uniform(path: Column) -> Column:
    """Spark spells local paths with one or three slashes, depending on the reader."""
    return F.regexp_replace(path, "^file:/+", "file:///")


def _plain(uri: Column) -> Column:
    """The path of a name that Spark gives as a URI; a plus sign stands for itself there."""
    return _uniform(F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B"))))


def as_data_files(listed: DataFrame) -> DataFrame:
    """`path, source_file, length, modified` of the data files among `path, length, modificationTime`."""
    path = _uniform(F.col("path"))
    return listed.select(
        path.alias("path"), F.regexp_extract(path, DAY, 1).alias("source_file"), "length", F.col("modificationTime").alias("modified")
    ).filter("source_file <> ''")


def data_files(spark: SparkSession, folder: str) -> DataFrame:
    """`path, source_file, length, modified` of every data file below the folder; reads no content.

    Spark's scans leave files without a byte out, so names come from its listing: a day whose file
    is empty is still a day. Such a file has length 0 and no time.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    names = spark.createDataFrame([(name,) for name in listed.inputFiles()], "path string").select(_plain(F.col("path")).alias("path"))
    seen = listed.select(_uniform(F.col("path")).alias("path"), "length", "modificationTime")
    return as_data_files(names.join(seen, "path", "left").withColumn("length", F.coalesce("length", F.lit(0))))


def column_names(line: str) -> list[str]:
    """The cells of a header line, named apart as Spark does: empty ones by place, repeated ones with it."""
    cells = next(csv.reader([line]), [])
    seen = [c.lower() for c in cells]
    return [f"_c{i}" if not c else f"{c}{i}" if seen.count(c.lower()) > 1 else c for i, c in enumerate(cells)]


def header_reader() -> Callable[[Iterator[tuple]], Iterator[tuple]]:
    """A function from the `path, start of the split, line` of one file to its `path, line` with the first text.

    It asks for no line behind that one, and workers need not have this library to run it.
    """

    def first(rows: Iterator[tuple]) -> Iterator[tuple]:
        for path, start, line in rows:
            if start:  # a later split of a long file
                return
            if line.strip():
                yield path, line
                return

    return first


def read_catalog(spark: SparkSession, folder: str, files: DataFrame | None = None) -> DataFrame:
    """`path, source_file, length, modified, columns` per data file, in the order of the paths' days.

    `files`, some rows of `data_files`, leaves all others unread. A file without a line has no columns.
    """
    own = spark.newSession()  # its settings leave the caller's alone
    for key, value in _ONE_FILE_A_TASK.items():
        own.conf.set(key, value)
    listed = data_files(spark, folder) if files is None else files
    path = f"{shared_folder(spark)}/catalog-{uuid4().hex}"
    chosen = folder if files is None else [r.path for r in files.select("path").toLocalIterator()]
    lines = own.read.option("recursiveFileLookup", "true").text(chosen) if chosen else own.createDataFrame([], "value string")
    if chosen:
        lines = lines.filter(F.col("_metadata.file_path").rlike(DAY))
        lines = lines.select("_metadata.file_path", "_metadata.file_block_start", "value")
    own.createDataFrame(lines.rdd.mapPartitions(header_reader()), "path string, line string").write.parquet(path)
    found = spark.read.parquet(path).select(_plain(F.col("path")).alias("path"), "line")
    # Few: each kind of header once, however many files have it.
    kinds = [(row.line, column_names(row.line)) for row in found.select("line").distinct().collect()]
    named = found.join(spark.createDataFrame(kinds, "line string, columns array<string>"), "line").drop("line")
    none = F.array().cast("array<string>")
    return listed.join(named, "path", "left").withColumn("columns", F.coalesce("columns", none))


def day_headers(catalog: DataFrame) -> DataFrame:
    """`source_file, columns`: one row per day, the columns that all its files have, in the order of its first file."""
    days = catalog.groupBy("source_file").agg(
        F.min_by("columns", F.coalesce("path", F.lit(""))).alias("first"), F.collect_set("columns").alias("kinds")
    )
    shared = F.filter("first", lambda c: F.forall("kinds", lambda kind: F.array_contains(kind, c)))
    return days.select("source_file", shared.alias("columns"))


def scans(catalog: DataFrame) -> dict[tuple[str, ...], list[str]]:
    """Paths to read for each header: whole days where a day has one header, single files elsewhere.

    This is what a scan needs on the driver anyway, one path a day as a rule.
    """
    placed = catalog.withColumn("day", F.regexp_extract("path", r"^(.*[/=]events_[^/]*\.csv)(?=/|$)", 1))
    kinds = placed.groupBy("day").agg(F.min("columns").alias("columns"), F.max("columns").alias("other"))
    alike = kinds.filter("columns = other").select(F.col("day").alias("path"), "columns")
    mixed = placed.join(kinds.filter("columns <> other").select("day"), "day").select("path", "columns")
    paths = alike.unionByName(mixed)
    found: dict[tuple[str, ...], list[str]] = {}
    for row in sorted(paths.collect(), key=lambda row: row.path):
        if row["columns"]:
            found.setdefault(tuple(row["columns"]), []).append(row.path)
    return found
