"""Secret scans over an incremental ledger of blobs.

Every version of a text is a blob named by its SHA-256. The ledger is two growing Parquet tables
in one folder: `scanned` (blob, rules) and `findings` (blob, rules, kind, start, end). A run scans
only blobs that the ledger lacks under this version of the rules, once however many rows hold
them, appends what it found, and joins findings back to every row. Findings are written before
`scanned`, so a run that dies in between leaves blobs that the next run scans again; equal
findings count once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from uuid import uuid4

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm.common import saved, sendable, set_aside
from clickloom.session import shared_folder

# Kind, pattern, the group that is measured, its least length.
RULES = (
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 8),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 16),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 32),
)
KINDS = tuple(rule[0] for rule in RULES)
VERSION = "base-1"
BROADCAST_ROWS = 300_000  # copies, or blobs with findings, that may be sent to all executors
_LEDGER = {"scanned": "blob string, rules string", "findings": "blob string, rules string, kind string, start long, end long"}
_LONG_HEX = re.compile(r"[0-9a-f]{32,}")  # a whole run of the hex rule whenever the run is long enough


def scan(text: str | None) -> list[tuple[str, int, int]]:
    """`(kind, start, end)` in code points, end exclusive, leftmost and non-overlapping for each kind.

    Matches whose measured group is too short are dropped after matching, so they still use up
    their characters. Null texts have none.
    """
    found = []
    for kind, pattern, group, least in RULES:
        if kind == "hex":
            pattern = _LONG_HEX
        for m in pattern.finditer(text or ""):
            if m.end(group) - m.start(group) >= least:
                found.append((kind, m.start(), m.end()))
    return found


def _scan_batches(version: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                (blob.as_py(), version, *span)
                for blob, text in zip(batch.column("blob"), batch.column("text"), strict=True)
                for span in scan(text.as_py())
            ]
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            kinds = [pa.string()] * 3 + [pa.int64()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["blob", "rules", "kind", "start", "end"])

    return run


def blob_of(text: Column) -> Column:
    """Content address; null counts as empty."""
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def _read(spark: SparkSession, ledger: str, name: str) -> DataFrame:
    try:
        return spark.read.schema(_LEDGER[name]).parquet(f"{ledger}/{name}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _LEDGER[name])


def update_ledger(rows: DataFrame, ledger: str, version: str = VERSION) -> DataFrame:
    """Scan what the ledger lacks of `id, blob, text` rows; returns all findings under this rule version, distinct."""
    spark = rows.sparkSession
    known = _read(spark, ledger, "scanned").filter(F.col("rules") == version).select("blob").distinct()
    # One row stands for all copies of a blob; the others, usually few, are skipped where they lie, so texts need not move.
    pairs = rows.select("blob", "id")
    chosen = saved(pairs.groupBy("blob").agg(F.min("id").alias("chosen")).join(known, "blob", "left_anti"), "unseen")
    stands = chosen.withColumnRenamed("blob", "unseen")
    copies = pairs.join(stands, F.col("blob") == F.col("unseen"), "left")
    copies = copies.filter("unseen IS NULL OR NOT id <=> chosen").select(F.col("blob").alias("_b"), F.col("id").alias("_i")).distinct()
    copies = sendable(saved(copies, "copies"), BROADCAST_ROWS)
    unseen = rows.join(copies, (F.col("blob") == F.col("_b")) & F.col("id").eqNullSafe(F.col("_i")), "left_anti").select("blob", "text")
    unseen.mapInArrow(_scan_batches(version), _LEDGER["findings"]).write.mode("append").parquet(f"{ledger}/findings")
    chosen.select("blob", F.lit(version).alias("rules")).write.mode("append").parquet(f"{ledger}/scanned")
    return _read(spark, ledger, "findings").filter(F.col("rules") == version).select("blob", "kind", "start", "end").distinct()


def spans_by_blob(findings: DataFrame) -> DataFrame:
    """`blob, spans`: the spans of a blob in order of start, then kind as listed."""
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    one = F.struct("start", order.alias("rank"), "kind", "end")
    return findings.groupBy("blob").agg(F.sort_array(F.collect_set(one)).alias("spans"))


def secret_spans(docs: DataFrame, ledger: str | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of `docs` with a column `_spans`, the array of `start, rank, kind, end` found in the text.

    Without a ledger folder the run starts an empty one. Null and empty texts have no spans, rows
    with equal texts (repeated rows, null ids) have equal spans, other columns of any name pass
    through, but for a column `_spans`, which is replaced, and an empty table gives no rows.
    """
    ledger = ledger or f"{shared_folder(docs.sparkSession)}/ledger-{uuid4().hex}"
    rows = docs.select(F.col(id_column).alias("id"), blob_of(F.col(text_column)).alias("blob"), F.coalesce(text_column, F.lit("")).alias("text"))
    spans = saved(spans_by_blob(update_ledger(rows, ledger)), "spans").select(F.col("blob").alias("_blob"), F.col("spans").alias("_spans"))
    none = F.array().cast(spans.schema["_spans"].dataType)
    kept, back = set_aside(docs.drop("_spans"), "_key", "_blob")
    keyed = kept.withColumn("_key", blob_of(F.col(text_column)))  # a column, so that a join need not move texts nobody asks for
    found = keyed.join(sendable(spans, BROADCAST_ROWS), F.col("_key") == F.col("_blob"), "left")
    return found.select(*back, F.coalesce("_spans", none).alias("_spans"))


def redact(text: Column, spans: Column, mask: str = "[SECRET]") -> Column:
    """The text with every stretch that spans cover replaced by the mask; a text without spans stays as it is."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(done: Column, span: Column) -> Column:
        kept = F.substring(text, (done["at"] + 1).cast("int"), F.greatest(span["start"] - done["at"], F.lit(0)).cast("int"))
        out = F.when(span["start"] >= done["at"], F.concat(done["out"], kept, F.lit(mask))).otherwise(done["out"])
        return F.struct(F.greatest(done["at"], span["end"]).alias("at"), out.alias("out"))

    def finish(done: Column) -> Column:
        return F.concat(done["out"], F.substring(text, (done["at"] + 1).cast("int"), F.char_length(text)))

    return F.when(F.size(spans) > 0, F.aggregate(spans, start, step, finish)).otherwise(text)


def joined(spans: Column) -> Column:
    """`kind:start:end` of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
