from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash

from clickloom.llm import simhash


def slow_fingerprint(text, size=4):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    shingles = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(fps, distance=4):
    names = list(range(len(fps)))

    def find(i):
        while names[i] != i:
            i = names[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= distance:
                a, b = find(i), find(j)
                names[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def test_fingerprint():
    for text in (None, "", " \t", "One", "a b c", "a b c d a b c d a b", "ÉCOLE École x y z", "A\x0bB\x0cC D\x1cE"):
        assert simhash.fingerprint(text) == slow_fingerprint(text)


def test_masks_cover_every_close_pair():
    masks = [np.int64(m).astype(np.uint64) for m in simhash._masks(4, 6)]
    assert len(masks) == 15
    for _ in range(300):
        flipped = np.uint64(sum(1 << b for b in random.sample(range(64), 4)))
        assert any(flipped & m == 0 for m in masks)


@pytest.mark.parametrize("bucket", [4096, 8])
def test_links_against_brute_force(spark, bucket):
    random.seed(bucket)
    values = []
    for _ in range(12):
        centre = random.getrandbits(64)
        for _ in range(random.choice([1, 3, 40])):
            values.append(centre ^ sum(1 << b for b in random.sample(range(64), random.randint(0, 4))))
    values = sorted(set(values))
    signed = [int(np.uint64(v).astype(np.int64)) for v in values]
    found = simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long"), bucket=bucket).collect()
    place = {v: i for i, v in enumerate(signed)}
    groups = list(range(len(values)))
    for row in found:
        assert (values[place[row.a]] ^ values[place[row.b]]).bit_count() <= 4
        old, new = groups[place[row.a]], groups[place[row.b]]
        groups = [new if g == old else g for g in groups]
    expected = slow_components(values)
    assert len(set(groups)) == len(set(expected))
    assert len(set(zip(groups, expected, strict=True))) == len(set(expected))


def test_odd_rows(spark, make_docs, odd_docs):
    rows = simhash.near_duplicates(make_docs(odd_docs)).collect()
    assert len(rows) == len(odd_docs)
    named = {r.id: r for r in rows if r.id is not None}
    assert named[1].fp == named[2].fp == named[3].fp == 0 and {named[i].component for i in (1, 2, 3)} == {1}
    assert named[4].component == named[5].component == 4 and named[6].component == 6
    assert sorted(r.component for r in rows if r.id is None) == [1, 4]
    assert simhash.near_duplicates(make_docs(odd_docs).filter("false")).count() == 0
    only = simhash.near_duplicates(make_docs([(None, "a b c d e")])).first()
    assert only.component is None
