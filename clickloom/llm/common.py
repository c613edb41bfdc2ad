"""Helpers the corpus operators share."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.session import shared_folder

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def saved(frame: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """The frame written once to the shared folder and read back, so that nothing above it runs again."""
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid4().hex}"
    frame.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else; texts without other letters take the short way."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def sendable(frame: DataFrame, rows: int) -> DataFrame:
    """The frame, marked for broadcast if it is counted to have at most so many rows."""
    return F.broadcast(frame) if frame.limit(rows + 1).count() <= rows else frame


def set_aside(frame: DataFrame, *names: str) -> tuple[DataFrame, list[Column]]:
    """The frame with its columns of these names renamed to unused ones, and the columns that bring the old frame back."""
    used = {c.lower() for c in frame.columns} | set(names)
    kept, back = [], []
    for column in frame.columns:
        name = column
        if column.lower() in names:
            while name.lower() in used:
                name += "_"
            used.add(name.lower())
        kept.append(F.col(f"`{column}`").alias(name))
        back.append(F.col(f"`{name}`").alias(column))
    return frame.select(*kept), back
