from __future__ import annotations

from clickloom.llm import preferences

from .conftest import SMALL

TURNS = "pair long, turn long, role string, text string, turns string, a string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], TURNS)


def test_shared_prefix_and_masks(spark):
    chosen = [(1, 0, "user", "Hé"), (1, 1, "assistant", "yes"), (1, 2, "user", "more"), (2, 0, "user", "q"), (3, 0, None, None), (None, 0, "user", "x")]
    rejected = [(1, 0, "user", "Hé"), (1, 0, "user", "Hé"), (1, 1, "assistant", "no"), (2, 0, "user", "q"), (3, 0, "", ""), (3, 1, "assistant", ""), (4, 0, "user", "z")]
    rows = {r.pair: r for r in preferences.format_pairs(frame(spark, chosen), frame(spark, rejected), "pair").collect()}
    assert set(rows) == {1, 2, 3}
    one = rows[1]
    assert (one.n_shared, one.prompt) == (1, "<|user|>\nHé<|end|>\n")
    assert one.chosen == "<|assistant|>\nyes<|end|>\n<|user|>\nmore<|end|>\n" and one.rejected == "<|assistant|>\nno<|end|>\n"
    start, end = map(int, one.chosen_mask.split(":"))
    assert one.chosen[start:end] == "yes<|end|>" and one.rejected[slice(*map(int, one.rejected_mask.split(":")))] == "no<|end|>"
    assert (rows[2].n_shared, rows[2].chosen, rows[2].rejected, rows[2].chosen_mask) == (1, "", "", "")
    assert (rows[3].n_shared, rows[3].chosen, rows[3].rejected) == (1, "", "<|assistant|>\n<|end|>\n")


def test_swapped_answers(spark):
    rows = [(0, 0, "user", "a"), (0, 1, "assistant", "b"), (0, 2, "user", "tail"), (1, 0, "user", "c"), (1, 1, "assistant", "d"), (2, 0, "user", "alone"), (4, 0, "assistant", "e")]
    turns = frame(spark, rows).withColumnRenamed("pair", "conv_id")
    found = {r.conv_id: r for r in preferences.format_answers(turns).collect()}
    assert set(found) == {0, 1, 4}
    assert found[0].prompt == "<|user|>\na<|end|>\n" and "d" in found[0].rejected and "b" in found[0].chosen
    assert found[1].rejected == "<|assistant|>\ne<|end|>\n" and found[4].rejected == "<|assistant|>\nb<|end|>\n"
    assert preferences.format_answers(turns.filter("false")).count() == 0


def test_sides_part_at_any_answer(spark):
    long = [(c, t, "user" if t % 2 == 0 else "assistant", f"{c}-{t}") for c in (3, 4, 5, 70_000) for t in range(8)]
    found = {r.conv_id: r for r in preferences.format_answers(frame(spark, long).withColumnRenamed("pair", "conv_id")).collect()}
    assert {c: r.n_shared for c, r in found.items()} == {3: 7, 4: 1, 5: 3, 70_000: 1}
    assert found[4].rejected == "<|assistant|>\n5-7<|end|>\n" and found[5].rejected == "<|assistant|>\n70000-7<|end|>\n"
    assert found[70_000].rejected == "<|assistant|>\n3-7<|end|>\n" and found[4].chosen.count("<|end|>") == 7
    alone = preferences.format_answers(frame(spark, [r for r in long if r[0] == 3]).withColumnRenamed("pair", "conv_id")).first()
    assert (alone.n_shared, alone.chosen, alone.rejected) == (8, "", "")


def test_same_without_broadcast(spark):
    """Joins of large tables shuffle both sides; results stay the same."""
    turns = spark.read.parquet(f"{SMALL}/conversations.parquet")
    whole = sorted(map(repr, preferences.format_answers(turns).collect()))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert sorted(map(repr, preferences.format_answers(turns).collect())) == whole
        assert sorted(map(repr, preferences.format_pairs(*preferences.swapped_answers(turns), "conv_id").collect())) == whole
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
