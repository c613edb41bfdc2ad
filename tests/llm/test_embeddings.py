from __future__ import annotations

import numpy as np
import pytest

from clickloom.llm import embeddings


def slow(rows):
    fine = {}
    for n, (_, v) in enumerate(rows):
        if v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            a = np.array(v, float) / np.abs(np.array(v, float)).max()
            fine[n] = a / np.linalg.norm(a)
    links = {n: {m for m in fine if m != n and n in fine and len(fine[n]) == len(fine[m]) and fine[n] @ fine[m] >= 0.95} for n in range(len(rows))}
    out = []
    for n, (name, _) in enumerate(rows):
        seen, todo = {n}, [n]
        while todo:
            for m in links[todo.pop()] - seen:
                seen.add(m)
                todo.append(m)
        names = [rows[m][0] for m in seen if rows[m][0] is not None]
        out.append((name, len(links[n]), min(names) if names else None))
    return sorted(out, key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", 2) for i, v in rows], "vec_id long, embedding array<float>, label int, c string, links int")


@pytest.mark.parametrize("group", [2048, 16])
def test_against_brute_force(spark, monkeypatch, group):
    monkeypatch.setattr(embeddings, "GROUP", group)
    monkeypatch.setattr(embeddings, "LEAF", 32)
    rng = np.random.default_rng(group)
    rows = []
    for _ in range(25):
        centre = rng.standard_normal(8)
        for _ in range(rng.choice([1, 2, 30])):
            rows.append((len(rows), [float(np.float32(x)) for x in centre + 0.1 * rng.standard_normal(8)]))
    rows += [(len(rows) + i, rows[0][1]) for i in range(40)] + [(None, rows[0][1]), rows[1], (5000, [-x for x in rows[0][1]])]
    rows += [(6000 + i, v) for i, v in enumerate([None, [], [0.0] * 8, [1.0] * 7 + [None], [1.0] * 7 + [float("nan")], [float("inf")] * 8, [1.0] * 5])]
    rows += [(7000 + i, [1.0, float(i % 3), 0.1 * (i % 2), 0.0, 1.0]) for i in range(60)] + [(8000 + i, [float(i) - 3]) for i in range(7)]
    got = sorted(((r.id, r.n_links, r.component) for r in embeddings.near_duplicates(frame(spark, rows)).collect()), key=repr)
    expected = slow(rows)
    found, there = sum(r[1] for r in got), sum(r[1] for r in expected)
    assert 0.9 * there <= found <= there
    if found == there:
        assert got == expected


def test_few_rows(spark):
    assert embeddings.near_duplicates(frame(spark, [])).count() == 0
    rows = embeddings.near_duplicates(frame(spark, [(3, [1e30, 0.0]), (2, [1e-30, 0.0]), (1, None)])).collect()
    assert sorted((r.id, r.n_links, r.component) for r in rows) == [(1, 0, 1), (2, 1, 2), (3, 1, 2)]


@pytest.mark.parametrize("depth", [9, 12, 17])
def test_links_of_a_large_group_meet_at_depth(depth):
    """A third of the rows in one group as wide as a linked pair: the trees of a production run must not part its links."""
    rng = np.random.default_rng(3)
    centre = rng.standard_normal(64) / 8

    def drawn(n, group):
        rows = rng.standard_normal((n, 64)) / 8
        rows[:group] = centre + 0.21 * rows[:group]
        return rows / np.linalg.norm(rows, axis=1, keepdims=True)

    forest = embeddings.Forest(drawn(embeddings.SAMPLE, embeddings.SAMPLE // 3), depth)
    a, b = drawn(1000, 1000), drawn(1000, 1000)
    linked = (a * b).sum(axis=1) >= embeddings.COSINE
    places = [forest.leaves(x[linked]) for x in (a, b)]
    (i, x), (j, y) = places
    met = {row for row, _ in set(zip(i.tolist(), x.tolist(), strict=True)) & set(zip(j.tolist(), y.tolist(), strict=True))}
    assert linked.sum() > 500 and len(met) >= 0.98 * linked.sum()
