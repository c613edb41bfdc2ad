"""The named queries of this package: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm import decontaminate, embeddings, katz, mixing, packing, phrases, preferences, prefix_trie, quality, secrets, simhash, toxicity, wordpiece
from clickloom.llm.common import table
from clickloom.llm.oracle import ORACLES


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Expected severity of every document."""
    docs = table(spark, folder, "documents")
    found = toxicity.fit_labels(docs, table(spark, folder, "labels")).score(docs.select("doc_id", "text"))
    return found.select(
        "doc_id",
        F.col("_severity").alias("expected_severity"),
        F.col("_grade").alias("grade"),
        F.col("_toxic").alias("p_toxic"),
        (F.col("_toxic") >= 0.5).alias("toxic"),
    )


def op2_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def op3_preferences(spark: SparkSession, folder: str) -> DataFrame:
    """Every answered conversation against one that leaves it for another's answer, with the shared turns as prompt."""
    return preferences.format_answers(table(spark, folder, "conversations"))


def op4_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark words of every document, and the verdict."""
    found = decontaminate.report(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        decontaminate.is_contaminated(F.col("n_words"), F.col("n_hit")).alias("contaminated"),
    )


def op5_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Spans of every document, counted by kind and as digests."""
    found = secrets.secret_spans(table(spark, folder, "documents"))

    def count(kind: str):
        return F.size(F.filter("_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    spans = secrets.joined(F.col("_spans"))
    return found.select("doc_id", *map(count, secrets.KINDS), F.sha2(spans, 256).alias("base_sha256"), spans.alias("spans"))


def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Every piece of every document and its place in a sequence."""
    pieces = packing.pack(table(spark, folder, "documents"))
    return pieces.select(
        F.col("id").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op7_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Probability of every document to be good, and the verdict."""
    found = quality.score(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return found.select("doc_id", F.col("_good").alias("quality"), (F.col("_good") >= quality.KEEP).alias("keep"))


def op8_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    """Links and component of every vector."""
    found = embeddings.near_duplicates(table(spark, folder, "embeddings"))
    component = F.col("component").alias("component_id")
    return found.select(F.col("id").alias("vec_id"), "n_links", component, (F.col("id") == F.col("component")).alias("kept"))


def op9_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Words and greedy longest-match pieces of every document."""
    found = wordpiece.token_counts(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.col("_n_words").alias("n_words"), F.col("_n_tokens").alias("n_tokens"))


def op10_katz(spark: SparkSession, folder: str) -> DataFrame:
    """Katz and additive scores of every document, learned from four in five of them."""
    found = katz.scores(table(spark, folder, "documents"), "crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 5 = 1")
    return found.withColumnRenamed("id", "doc_id")


def op11_phrases(spark: SparkSession, folder: str) -> DataFrame:
    """The strongest collocations of each language."""
    return phrases.collocations(table(spark, folder, "documents"))


def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    """Every distinct conversation prefix with the totals of its subtree."""
    return prefix_trie.prefix_trie(table(spark, folder, "conversations")).drop("key")


def op13_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """How many words of every document the mix takes."""
    return mixing.mix(table(spark, folder, "documents")).select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_simhash": op2_simhash,
    "op3_preferences": op3_preferences,
    "op4_decontaminate": op4_decontaminate,
    "op5_secrets": op5_secrets,
    "op6_packing": op6_packing,
    "op7_quality": op7_quality,
    "op8_embeddings": op8_embeddings,
    "op9_token_counts": op9_token_counts,
    "op10_katz": op10_katz,
    "op11_phrases": op11_phrases,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_mixing": op13_mixing,
}
