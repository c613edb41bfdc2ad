"""Daily event files: CSV with a header that may differ from day to day.

A day is a file `events_YYYYMMDD.csv`, or a folder of that name holding part files. Spark
maps CSV columns by position, so files are scanned per header, one scan for all files that
share it.
"""

from __future__ import annotations

from collections import defaultdict
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from clickloom.config import Config
from clickloom.operators.cleaning import CORRUPT, normalise_schema, null_out_tokens
from clickloom.session import shared_folder
from clickloom.sources.catalog import DAY, data_files, day_headers, read_catalog, scans

# A header other than expected is an error, and a row of other than its cells is kept as text.
_CSV = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "enforceSchema": "false",
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": CORRUPT,
    "columnPruning": "false",
}
_ORDER = T.StructType([T.StructField("file", T.StringType()), T.StructField("block", T.LongType()), T.StructField("seq", T.LongType())])
TAGS = T.StructType([T.StructField("source_file", T.StringType()), T.StructField("ingest_order", _ORDER)])


def discover_files(spark: SparkSession, folder: str) -> dict[str, list[str]]:
    """Data files of each day, in the order of the day names. Lists names, reads nothing."""
    days: dict[str, list[str]] = defaultdict(list)
    for row in sorted(data_files(spark, folder).select("path", "source_file").collect()):
        days[row.source_file].append(row.path)
    return dict(sorted(days.items()))


def read_daily_files(
    spark: SparkSession, folder: str, cfg: Config, fill_referrer: bool = True
) -> tuple[DataFrame, DataFrame]:
    """All events of a folder as text columns, and the header table.

    `ingest_order` (file, offset of the split, row in the split) is the order of the input. It is
    only fixed once the frame is stored. Rows with other than their header's cells, such as halves
    of a cell with a line break, have their text in `corrupt_record`.
    """
    path = f"{shared_folder(spark)}/files-{uuid4().hex}"
    read_catalog(spark, folder).write.parquet(path)
    catalog = spark.read.parquet(path)
    if catalog.isEmpty():
        raise FileNotFoundError(f"no events_*.csv in {folder}")
    return read_cataloged(spark, catalog, cfg, fill_referrer), day_headers(catalog)


def read_cataloged(spark: SparkSession, catalog: DataFrame, cfg: Config, fill_referrer: bool = True) -> DataFrame:
    """All events of the files of a catalog as text columns: a scan for each different header."""
    parts = [
        normalise_schema(_scan(spark, names, paths, cfg), cfg, fill_referrer)
        for names, paths in scans(catalog).items()
    ]
    if not parts:  # every file is empty
        parts = [normalise_schema(_scan(spark, cfg.expected_columns, [], cfg), cfg, fill_referrer)]
    events = parts[0]
    for part in parts[1:]:
        events = events.unionByName(part, allowMissingColumns=True)
    return events


def _scan(spark: SparkSession, names: tuple[str, ...], files: list[str], cfg: Config) -> DataFrame:
    schema = T.StructType([T.StructField(n, T.StringType()) for n in (*names, CORRUPT)])
    reader = spark.read.schema(schema).options(**_CSV, multiLine=cfg.multi_line, recursiveFileLookup="true")
    if not files:
        return null_out_tokens(spark.createDataFrame([], T.StructType([*schema.fields, *TAGS.fields])), cfg)
    rows = reader.csv(files)
    source = F.regexp_extract("_metadata.file_path", DAY, 1)
    tagged = rows.select(
        "*",
        source.alias("source_file"),
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("seq"),
        ).alias("ingest_order"),
    )
    return null_out_tokens(tagged, cfg)
