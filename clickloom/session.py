"""Spark session with the settings the operators assume."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession

# Settings a running session accepts.
RUNTIME_SETTINGS = {
    # Timestamps are compared and printed in UTC everywhere.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A skewed join is split even when that costs one more exchange behind it.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Generated methods above this size are never compiled by the JVM, so stages with long
    # CASE chains run faster when their expressions are generated apart.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # A repeated key in a payload is no fault: the last one counts.
    "spark.sql.variant.allowDuplicateKeys": "true",
}
SETTINGS = {
    **RUNTIME_SETTINGS,
    "spark.ui.enabled": "false",
    # Do not record the Python call site of every column; plans here have hundreds of them.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


# Most bytes that a task scans, and that it gets from a shuffle unless it has a single key. Sessions sort their rows
# several times in one task, which holds about ten times the bytes it gets.
PARTITION_LIMITS = {"spark.sql.files.maxPartitionBytes": 32 << 20, "spark.sql.adaptive.advisoryPartitionSizeInBytes": 16 << 20}


def bound_partitions(spark: SparkSession) -> None:
    """Lower the session's partition sizes to `PARTITION_LIMITS`; smaller ones stay."""
    for key, limit in PARTITION_LIMITS.items():
        number, unit = re.fullmatch(r"(\d+)\s*([bkmgtp]?)\w*", spark.conf.get(key).strip().lower()).groups()
        if int(number) << 10 * "bkmgtp".index(unit or "b") > limit:
            spark.conf.set(key, str(limit))


def build_session(app: str = "clickloom", master: str | None = None, **extra: str) -> SparkSession:
    """A session with `SETTINGS`; `master` is only given for local runs and tests."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    bound_partitions(session)
    return session


def shared_folder(spark: SparkSession) -> str:
    """Folder for written intermediates: `spark.checkpoint.dir` as the cluster names it.

    Only where that is unset, a folder beside the warehouse, which every executor reaches too.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    return f"{warehouse}/_scratch/{spark.sparkContext.applicationId}"
