"""Mix sources to target weights, exactly and repeatably, in DataFrame functions only.

Every document has a hash-random key; documents are range-sorted by it within their source, and what
stands before a document in words is a distributed prefix sum: running sums within ranges of keys, plus
the sums of the ranges before. A source's budget is whole epochs of all its documents and then the
documents up to the exact word where the budget ends.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.common import saved

WEIGHTS, EPOCHS = (1, 2, 3), 3
RANGE_DIGITS = 3  # hexadecimal digits of a key that name its range: 4,096 ranges for each source
COPIES = 65_536  # equal rows that one task unfolds
WORD = r"[^\x20\x09-\x0D]+"


def _order(source: str) -> list[Column]:
    return [F.asc_nulls_last(source)]


def _ranked(sources: DataFrame) -> DataFrame:
    """The sources with `rank` from 0 in order, null last: a place within a range, plus the sources before that range."""
    parts = saved(sources.repartitionByRange(*_order("source")).withColumn("part", F.spark_partition_id()), "sources")
    # One row for each partition of the range shuffle.
    before = parts.groupBy("part").count().select("part", (F.sum("count").over(Window.orderBy("part")) - F.col("count")).alias("before"))
    place = F.row_number().over(Window.partitionBy("part").orderBy(*_order("source"))) - 1
    return parts.withColumn("place", place).join(before, "part").withColumn("rank", F.col("place") + F.col("before")).drop("part", "place", "before")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """`source, source_size, target, budget` from `source, source_size`; budget is the target in whole words.

    Sources in code point order, null last, weigh `weights` in turn and share the sum of all sizes. A share
    above `epochs` times its source's size stops there, and the excess goes to the others by weight until
    no share is above. A source without words has target 0.
    """
    whole = "decimal(38,0)"
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = _ranked(sizes).select("source", "source_size", weight.cast(whole).alias("weight"), (F.col("source_size") * epochs).cast(whole).alias("most"))
    ranked = saved(ranked, "ranked")
    words, heavy = ranked.agg(F.sum("source_size"), F.sum("weight").cast("long")).first()
    left, spare = words or 0, heavy or 1  # every source below its limit gets `left / spare` for each unit of weight

    def above(left: int, spare: int) -> Column:
        return F.col("most") * F.lit(spare).cast(whole) < F.lit(left).cast(whole) * F.col("weight")

    while words:
        stopped = F.when(above(left, spare), F.col("most")).otherwise(0)
        used, rest = ranked.agg(F.sum(stopped).cast("long"), F.sum(F.when(~above(left, spare), F.col("weight"))).cast("long")).first()
        if (words - used, rest) == (left, spare):
            break
        left, spare = words - used, rest
    share = F.lit(left).cast(whole) * F.col("weight")
    over = above(left, spare)
    return ranked.select(
        "source",
        "source_size",
        F.when(over, F.col("most").cast("double")).otherwise(share.cast("double") / F.lit(float(spare))).alias("target"),
        F.when(over, F.col("most").cast("long")).otherwise(F.call_function("div", share, F.lit(spare).cast(whole))).alias("budget"),
    )


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    epochs: int = EPOCHS,
    id_column: str = "doc_id",
    source_column: str = "source",
    text_column: str = "text",
) -> DataFrame:
    """`id, source, size, source_size, target, epochs, taken` of every row: it is taken `epochs` times whole, and `taken` words in all.

    Null and empty texts have no words and are taken for none; rows without a source are a source of their
    own; repeated rows each count and are told apart by number; null ids are ids like others. Other columns
    are ignored, an empty table gives no rows. The order depends on ids, sizes and copies alone, so reruns agree.
    """
    size = F.regexp_count(F.coalesce(F.col(text_column), F.lit("")), F.lit(WORD)).cast("long")
    rows = docs.select(F.col(source_column).alias("source"), F.col(id_column).alias("id"), size.alias("size"))
    # Rows that agree in all three are interchangeable: they are counted before they move, and unfolded in blocks.
    entries = saved(rows.groupBy("source", "id", "size").agg(F.count("*").alias("n")), "entries")
    sources = targets(entries.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size")), weights, epochs)

    last = F.col("n") - 1
    blocks = entries.withColumn("first", F.explode(F.sequence(F.lit(0).cast("long"), last, F.lit(COPIES).cast("long")))).repartition("source", "id", "size", "first")
    copies = blocks.withColumn("copy", F.explode(F.sequence("first", F.least(last, F.col("first") + COPIES - 1))))
    name = F.concat(F.coalesce(F.concat(F.lit("="), F.col("id").cast("string")), F.lit("null")), F.lit(":"), F.col("size"), F.lit(":"), F.col("copy"))
    keyed = copies.select("source", "id", "size", "copy", F.md5(name.cast("binary")).alias("key"))
    keyed = keyed.withColumn("range", F.substring("key", 1, RANGE_DIGITS))

    sorted_range = Window.partitionBy("source", "range").orderBy("key", "id", "size", "copy").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = saved(keyed.withColumn("within", F.sum("size").over(sorted_range) - F.col("size")).drop("key", "copy"), "placed")
    totals = placed.groupBy("source", "range").agg(F.sum("size").alias("total"))
    running = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, Window.currentRow)  # at most 4,096 rows a source
    offsets = totals.select("source", "range", (F.sum("total").over(running) - F.col("total")).alias("offset"))
    offsets = offsets.join(sources.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    offsets = offsets.select(F.col("source").alias("s"), F.col("range").alias("r"), "offset", "source_size", "target", "budget")

    found = placed.join(offsets, F.col("source").eqNullSafe(F.col("s")) & (F.col("range") == F.col("r")))
    passes = F.when(F.col("source_size") > 0, F.call_function("div", F.col("budget"), F.col("source_size"))).otherwise(0)
    rest = F.col("budget") - F.col("epochs") * F.col("source_size") - F.col("offset") - F.col("within")
    part = F.least(F.greatest(rest, F.lit(0)), F.col("size"))
    found = found.withColumn("epochs", passes)
    found = found.withColumn("taken", F.col("epochs") * F.col("size") + part)
    # A part that is the whole document is one more epoch of it.
    more = F.when((F.col("size") > 0) & (part == F.col("size")), 1).otherwise(0)
    return found.select("id", "source", "size", "source_size", "target", (F.col("epochs") + more).alias("epochs"), "taken")
