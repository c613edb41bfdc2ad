"""Benchmark decontamination by winnowing, in DataFrame functions only.

Every run of `window` words of an item is guaranteed to share a fingerprint with a text that
holds it: fingerprints are the least `gram`-word hash of each `window - gram + 1` neighbours, so
both sides pick the same gram inside a shared span. Shared fingerprints are extended to whole
windows, and a window only counts when its words are the same, not their hashes.

An item of fewer words than a window is a window itself. Winnowing guarantees nothing for it, so
its first gram is looked up among all grams of the texts, once for each gram length that occurs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import lower_ascii, saved, sendable

WINDOW, GRAM = 13, 5
BROADCAST_ROWS = 200_000  # fingerprints, windows or text keys that may be sent to all executors
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Runs of a-z, 0-9 and characters beyond ASCII, after lowering A-Z; null has none."""
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def _gram(array: Column, at: Column, size: int) -> Column:
    return F.xxhash64(*(F.get(array, at + i) for i in range(size)))


def _grams(array: Column, count: Column, size: int) -> Column:
    """Hash of each run of `size` words."""
    return F.when(count >= size, F.transform(F.sequence(F.lit(0), count - size), lambda i: _gram(array, i, size))).otherwise(
        F.array().cast("array<bigint>")
    )


def _least(hashes: Column, span: int) -> Column:
    """Distinct minima of every `span` neighbours; `hashes` must be a plain column, it is used often."""
    at = F.sequence(F.lit(0), F.size(hashes) - span)
    return F.array_distinct(F.transform(at, lambda i: F.least(*(F.get(hashes, i + j) for j in range(span)))))


def _one(column: Column) -> Column:
    """Keeps Catalyst from copying a costly expression into each of its uses."""
    return F.explode(F.array(column))


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM, text_column: str = "text", item_column: str = "item_id"
) -> DataFrame:
    """`key, n_words, n_hit, items` for every distinct text with a hit word; `key` is `text_key(text)`.

    `items` is the sorted array of the ids (as strings) whose windows occur. Null and wordless
    texts and items have no windows; repeated items count once and an item without an id marks
    words but is not listed. An empty table on either side gives no rows.
    """
    # The benchmark: its windows, and the fingerprints that lead to them.
    item = benchmark.select(F.col(item_column).cast("string").alias("item"), _one(words(F.col(text_column))).alias("w"))
    item = item.withColumn("n", F.size("w")).filter("n > 0")
    item = item.withColumn("length", F.least("n", F.lit(window))).withColumn("size", F.least("length", F.lit(gram)))
    starts = F.sequence(F.lit(1), F.col("n") - F.col("length") + 1)
    windows = item.select("item", "length", "w", F.explode(starts).alias("s"))
    windows = saved(windows.select("length", F.array_join(F.slice("w", F.col("s"), F.col("length")), " ").alias("window"), "item").distinct(), "windows")
    whole, short = item.filter(F.col("length") == window), item.filter(F.col("length") < window)
    marks = whole.select(_one(_grams(F.col("w"), F.col("n"), gram)).alias("g"))
    marks = marks.select(F.lit(window).alias("length"), F.explode(_least(F.col("g"), window - gram + 1)).alias("h"))
    lengths = sorted(r["length"] for r in short.select("length").distinct().collect())  # fewer than `window` numbers
    sizes = sorted({min(length, gram) for length in lengths})
    for size in sizes:
        marks = marks.unionByName(short.filter(F.col("size") == size).select("length", _gram(F.col("w"), F.lit(0), size).alias("h")))
    marks = saved(marks.distinct(), "marks")

    # Every text once: its word count and its fingerprints.
    texts = docs.select(text_key(F.col(text_column)).alias("key"), F.col(text_column).alias("text"))
    parsed = texts.select("key", _one(words(F.col("text"))).alias("w")).withColumn("n", F.size("w"))
    parsed = parsed.select("key", "n", "w", _one(_grams(F.col("w"), F.col("n"), gram)).alias("g"))
    looked = [F.when(F.col("n") >= window, _least(F.col("g"), window - gram + 1)).otherwise(F.array().cast("array<bigint>"))]
    looked += [F.array_distinct(F.col("g") if size == gram else _grams(F.col("w"), F.col("n"), size)) for size in sizes]
    marked = parsed.select("key", F.explode(F.flatten(F.array(*looked))).alias("h"))
    hits = marked.join(sendable(marks, BROADCAST_ROWS), "h").groupBy("key").agg(F.collect_set(F.struct("length", "h")).alias("marks"))
    hits = saved(hits, "hits")

    # Extension: the windows around shared fingerprints, compared word by word.
    keys = sendable(hits.select("key"), BROADCAST_ROWS)
    found = texts.join(keys, "key", "left_semi").dropDuplicates(["key"]).join(hits, "key")
    found = found.select("key", "marks", _one(words(F.col("text"))).alias("w")).withColumn("n", F.size("w"))

    def starts(length: int) -> Column:
        """Windows of the length that hold one of its marks, as places of their first words."""
        size, back = (gram, window - gram) if length == window else (min(length, gram), 0)
        marks = F.transform(F.filter("marks", lambda m: m["length"] == length), lambda m: m["h"])
        at = F.filter(F.sequence(F.lit(0), F.col("n") - size), lambda i: F.array_contains(marks, _gram(F.col("w"), i, size)))
        near = F.array_distinct(F.flatten(F.transform(at, lambda p: F.sequence(F.greatest(p - back, F.lit(0)), p))))
        near = F.transform(F.filter(near, lambda s: s + length <= F.col("n")), lambda s: F.struct(F.lit(length).alias("length"), s.alias("s")))
        marked = F.exists("marks", lambda m: m["length"] == length)
        return F.when(marked & (F.col("n") >= length), near).otherwise(F.array().cast("array<struct<length:int,s:int>>"))

    spans = found.select("key", "n", "w", F.explode(F.flatten(F.array(*map(starts, [window, *lengths])))).alias("x"))
    spans = spans.select("key", "n", "x.length", "x.s", F.array_join(F.slice("w", F.col("x.s") + 1, F.col("x.length")), " ").alias("window"))
    spans = spans.join(sendable(windows, BROADCAST_ROWS), ["length", "window"])
    covered = F.array_distinct(F.flatten(F.transform(F.collect_set(F.struct("s", "length")), lambda x: F.sequence(x["s"], x["s"] + x["length"] - 1))))
    return spans.groupBy("key", F.col("n").cast("long").alias("n_words")).agg(
        F.size(covered).cast("long").alias("n_hit"), F.sort_array(F.collect_set("item")).alias("items")
    )


def text_key(text: Column) -> Column:
    """Equal texts have equal keys; null counts as empty."""
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def is_contaminated(n_words: Column, n_hit: Column) -> Column:
    """At least one hit word and at least one word in twenty hit."""
    return (n_hit > 0) & (F.lit(20) * n_hit >= n_words)


def report(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """`id, n_words, n_hit, items` for every row; rows with equal texts (null ids too) get equal figures."""
    found = contamination(docs, benchmark, text_column=text_column).select("key", "n_hit", "items")
    rows = docs.select(F.col(id_column).alias("id"), text_key(F.col(text_column)).alias("key"), F.size(words(F.col(text_column))).cast("long").alias("n_words"))
    return rows.join(found, "key", "left").select(
        "id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items")
    )
