"""A corpus from raw documents to packed training sequences, stage by stage.

Columns of any other name, also of those that the stages use themselves, pass through all but the last.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm import decontaminate, packing, quality, secrets, simhash
from clickloom.llm.common import saved, set_aside, table


BATCH_BYTES = 4 << 20  # of rows that a task sends to its Python worker at a time
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def in_small_batches(stage: Stage) -> Stage:
    """Stages share executors and Python workers, which keep what memory they once took, so none takes much."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
        return stage(spark, docs, sf_dir)

    return run


@in_small_batches
def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier finds good stay."""
    rows, back = set_aside(docs, "_good")
    scored = quality.score(rows, table(spark, sf_dir, "labels"))
    return scored.filter(F.col("_good") >= quality.KEEP).select(*back)


@in_small_batches
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group stays, that with the least id; a row without an id stays only if no row of its group has one.

    Rows count one by one: rows that repeat an id may fall into different groups, and equal rows are a group.
    """
    rows, back = set_aside(docs, "_row", "_key")
    rows = saved(rows.withColumn("_row", F.monotonically_increasing_id()), "numbered")  # written, so that a row keeps its number
    key = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "_row")
    found = simhash.near_duplicates(rows.withColumn("_key", key), id_column="_key")
    firsts = found.filter(F.col("id._row") == F.col("component._row")).select("id._row")
    return rows.join(firsts, "_row", "left_semi").select(*back)


@in_small_batches
def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a twentieth or more of their words in benchmark windows go."""
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    found = found.filter(decontaminate.is_contaminated(F.col("n_words"), F.col("n_hit"))).select(F.col("key").alias("_key"))
    return docs.join(found, decontaminate.text_key(docs["text"]) == found["_key"], "left_anti").select(*docs.columns)


@in_small_batches
def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; what is found in its text is masked and its length counted anew."""
    rows, back = set_aside(docs, "_spans")
    masked = secrets.secret_spans(rows).withColumn("text", secrets.redact(F.col("text"), F.col("_spans")))
    if "n_chars" in docs.columns:
        length = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        masked = masked.withColumn("n_chars", F.when(F.size("_spans") > 0, length).otherwise(F.col("n_chars")))
    return masked.select(*back)


@in_small_batches
def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in training sequences."""
    return packing.pack(docs).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality classifier", quality_classifier),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scans", secret_scans),
    ("packing", sequences),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written as Parquet and read back for the next one."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
