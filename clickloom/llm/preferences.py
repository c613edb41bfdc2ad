"""Preference data from pairs of conversations, in DataFrame functions only.

The turns that the chosen and the rejected conversation share from the start are the prompt and are
rendered once; what follows is each side's completion, with the spans that count for the loss.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ASSISTANT = "assistant"
BLOCK = 512  # ids of one block, within which the next conversation is looked up


def _turns(turns: DataFrame, key: str) -> DataFrame:
    """One row per conversation: its distinct turns in order of turn, role and text."""
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return turns.filter(F.col(key).isNotNull()).groupBy(key).agg(F.sort_array(F.collect_set(turn)).alias("turns"))


def rendered(turn: Column) -> Column:
    return F.concat(F.lit("<|"), turn["role"], F.lit("|>\n"), turn["text"], F.lit("<|end|>\n"))


def _text(turns: Column) -> Column:
    return F.array_join(F.transform(turns, rendered), "")


def _loss_spans(turns: Column) -> Column:
    """`start:end` of each assistant turn's text and end mark in the rendered turns, in code points, end exclusive."""
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans"))

    def step(done: Column, turn: Column) -> Column:
        end = done["at"] + F.char_length(rendered(turn))
        start = done["at"] + F.char_length(turn["role"]) + 5
        span = F.concat_ws(":", start, end - 1)
        own = F.when(turn["role"] == ASSISTANT, F.array(span)).otherwise(F.array().cast("array<string>"))
        return F.struct(end.alias("at"), F.concat(done["spans"], own).alias("spans"))

    return F.aggregate(turns, empty, step, lambda done: F.array_join(done["spans"], ","))


def format_pairs(chosen: DataFrame, rejected: DataFrame, key: str) -> DataFrame:
    """`key, n_shared, prompt, chosen, rejected, chosen_mask, rejected_mask` for every key on both sides.

    Both sides are turns `key, turn, role, text`. Rows of a null key are dropped, repeated turns count
    once, null roles and texts are empty, and turns of one number are ordered by role and text. Equal
    conversations are all prompt; a key that only one side has, or an empty side, gives no row.
    """
    return _formatted(_turns(chosen, key).withColumnRenamed("turns", "a").join(_turns(rejected, key).withColumnRenamed("turns", "b"), key), key)


def _formatted(both: DataFrame, key: str) -> DataFrame:
    """The pairs of `key, a, b`, two arrays of turns in order."""
    same = F.zip_with("a", "b", lambda x, y: (x["role"] == y["role"]) & (x["text"] == y["text"]))
    shared = F.array_position(F.transform(same, lambda s: F.coalesce(s, F.lit(False))), False) - 1
    both = both.withColumn("n_shared", F.when(shared < 0, F.size("a")).otherwise(shared).cast("int"))

    def rest(side: str) -> Column:
        return F.slice(F.col(side), F.col("n_shared") + 1, F.greatest(F.size(side), F.lit(1)))

    return both.select(
        key,
        "n_shared",
        _text(F.slice("a", F.lit(1), F.col("n_shared"))).alias("prompt"),
        _text(rest("a")).alias("chosen"),
        _text(rest("b")).alias("rejected"),
        _loss_spans(rest("a")).alias("chosen_mask"),
        _loss_spans(rest("b")).alias("rejected_mask"),
    )


def _next_answers(answers: DataFrame) -> DataFrame:
    """`conv_id, other`: the `text` of the next conversation by id; behind the last one comes the first.

    Ids meet in blocks of at most `BLOCK`; only the first text of each block crosses them.
    """
    block = F.floor(F.col("conv_id") / BLOCK)
    blocked = answers.select("conv_id", "text", block.alias("block"))
    firsts = blocked.groupBy("block").agg(F.min_by("text", "conv_id").alias("first"))
    in_order = Window.orderBy("block")  # one row a block
    after = F.coalesce(F.lead("first").over(in_order), F.first("first").over(in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    own = F.lead("text").over(Window.partitionBy("block").orderBy("conv_id"))
    return blocked.withColumn("own", own).join(firsts.select("block", after.alias("after")), "block").select("conv_id", F.coalesce("own", "after").alias("other"))


def _answered(turns: DataFrame) -> DataFrame:
    """`conv_id, a, b`: a conversation up to its last answer, and up to one of its answers with another's in its place."""
    whole = _turns(turns.select("conv_id", "turn", "role", "text"), "conv_id")
    whole = whole.withColumn("answers", F.filter("turns", lambda t: (t["role"] == ASSISTANT) & t["turn"].isNotNull())).filter(F.size("answers") > 0)
    chosen = F.pmod(F.col("conv_id"), F.size("answers")).cast("int") + 1
    whole = whole.withColumns({"last": F.try_element_at("answers", F.lit(-1)), "left": F.try_element_at("answers", chosen)})
    other = _next_answers(whole.select("conv_id", F.col("last.text").alias("text")))

    def side(at: str, text: str):
        before = F.filter("turns", lambda t: t["turn"] < F.col(f"{at}.turn"))
        return F.concat(before, F.array(F.struct(F.col(f"{at}.turn").alias("turn"), F.lit(ASSISTANT).alias("role"), F.col(text).alias("text"))))

    return whole.join(other, "conv_id").select("conv_id", side("last", "last.text").alias("a"), side("left", "other").alias("b"))


def swapped_answers(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs from plain conversations `conv_id, turn, role, text`: the own course is chosen over another's answer.

    The chosen side is a conversation up to its last assistant turn. The rejected side leaves it at its
    assistant turn number `conv_id` modulo their number, counted from 0: the last assistant turn of the
    next conversation by id that has one stands there, and the side ends. Behind the last conversation
    comes the first, and one alone stands against itself. Conversations without an answer are not in the
    result; turns without a number come before no answer and are none.
    """
    both = _answered(turns)
    return both.select("conv_id", F.inline("a")), both.select("conv_id", F.inline("b"))


def format_answers(turns: DataFrame) -> DataFrame:
    """`format_pairs` of `swapped_answers`, without taking the pairs apart in between."""
    return _formatted(_answered(turns), "conv_id")
