from __future__ import annotations

import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

from clickloom.llm import mixing

COLUMNS = "doc_id long, text string, source string, size long, key string, range string, n long, copy long"


def slow_targets(sizes):
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, stopped = sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in stopped]
        left = total - sum(3 * sizes[s] for s in stopped)
        share = {s: Fraction(left * weight[s], sum(weight[f] for f in free)) for s in free}
        above = {s for s in free if share[s] > 3 * sizes[s]}
        if not above:
            return {s: share.get(s, Fraction(3 * sizes[s])) for s in names}
        stopped |= above


def run(spark, rows):
    docs = spark.createDataFrame([(i, t, s, 1, "x", "x", 1, 1) for i, t, s in rows], COLUMNS).repartition(3)
    return [r.asDict() for r in mixing.mix(docs).collect()]


def check(spark, rows):
    got = run(spark, rows)
    size = {(i, t): len(re.findall(mixing.WORD, t or "")) for i, t, _ in rows}
    assert Counter((r["id"], r["source"], r["size"]) for r in got) == Counter((i, s, size[i, t]) for i, t, s in rows)
    sizes = defaultdict(int)
    for i, t, s in rows:
        sizes[s] += size[i, t]
    goal, taken = slow_targets(sizes), defaultdict(int)
    for r in got:
        assert r["source_size"] == sizes[r["source"]]
        assert abs(r["target"] - goal[r["source"]]) <= 1e-9 * max(1, r["target"])
        assert r["epochs"] * r["size"] <= r["taken"] <= min(3, r["epochs"] + 1) * r["size"]
        taken[r["source"]] += r["taken"]
    assert all(taken[s] == int(goal[s]) for s in goal)
    for s in goal:  # at most one document of a source ends in its middle, and no document is two epochs ahead
        own = [r for r in got if r["source"] == s and r["size"]]
        assert sum(r["taken"] % r["size"] > 0 for r in own) <= 1
        assert not own or max(r["epochs"] for r in own) - min(r["epochs"] for r in own) <= 1
    return got


def rows_of(seed):
    random.seed(seed)
    names = ["b", "a", "Ä", None, "", "zz", "中", "empty"]
    rows = [(i, " wé" * random.randint(0, 30), random.choice(names[:-1] * 2 + ["zz"] * 9)) for i in range(300)]
    rows += [(i, None, "empty") for i in range(9)] + [(None, "x y", "tiny"), (None, None, None)]
    return rows + [(7, "copy of one", "b")] * 70 + rows[:5]


def test_against_brute_force(spark):
    for seed in (1, 2):
        check(spark, rows_of(seed))


def test_reruns_agree(spark):
    def one(rows):
        return sorted(repr(sorted(r.items())) for r in run(spark, rows))

    rows = rows_of(3)
    first = one(rows)
    random.shuffle(rows)
    assert one(rows) == first


def test_blocks_of_copies(spark, monkeypatch):
    monkeypatch.setattr(mixing, "COPIES", 8)
    check(spark, [(1, "a b c", "s")] * 50 + [(2, "d", "s"), (3, "e " * 40, "t")])


def test_odd_rows(spark):
    long = "word " * 30_000
    check(spark, [(1, long, "a"), (2, "b c", "b"), (3, "\x0b\x0c", "c")])
    assert [r["taken"] for r in check(spark, [(1, None, None), (2, "", "a")])] == [0, 0]
    empty = spark.createDataFrame([], COLUMNS)
    assert mixing.mix(empty).count() == 0


def test_no_python_on_the_way(spark):
    docs = spark.createDataFrame([(1, "a", "s")], "doc_id long, text string, source string")
    plan = mixing.mix(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "RDD" not in plan.replace("LogicalRDD", "").replace("ExistingRDD", "")
