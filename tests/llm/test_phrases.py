from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from clickloom.llm import phrases

LEAST, TOP = 5, 40


def slow(rows, longest=5):
    found, total = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate({c: c + 32 for c in range(65, 91)})):
            words = tuple(re.findall(r"[^\x20\x09]+", piece))
            total[lang] += len(words)
            for size in range(1, longest + 1):
                found.update((lang, words[i : i + size]) for i in range(len(words) - size + 1))
    often = {key: n for key, n in found.items() if n >= LEAST}

    def inside(short, long):
        return any(long[i : i + len(short)] == short for i in range(len(long) - len(short) + 1))

    out = {}
    for (lang, words), a in often.items():
        if len(words) < 2 or any(g == lang and len(w) > len(words) and n >= a and inside(words, w) for (g, w), n in often.items()):
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = found[lang, words[:k]], found[lang, words[k:]]
            cuts.append((1000 * a * total[lang] // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), left, right))
    rows = []
    for lang, own in out.items():
        for rank, (score, a, phrase, left, right) in enumerate(sorted(own)[:TOP], 1):
            rows.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(rows)


def check(spark, rows, **options):
    docs = spark.createDataFrame([(lang, text, "x", "x", 1) for lang, text in rows], "lang string, text string, chunk string, phrase string, times long")
    got = phrases.collocations(docs.repartition(3), LEAST, top=TOP, **options).collect()
    assert sorted(tuple(r) for r in got) == slow(rows)


@pytest.mark.parametrize("chunk", [1, 3, 32])
def test_against_brute_force(spark, chunk):
    random.seed(chunk)
    words = [f"w{i}" for i in range(12)] + ["Größe", "naïve", " x", "\x1c", "中文"]
    rows = []
    for _ in range(60):
        text = "".join(random.choice(words) + random.choice([" "] * 8 + ["\t ", ". ", ",", "\n", " ; ", "?!"]) for _ in range(random.randint(0, 60)))
        rows.append((random.choice(["en", "de", None, ""]), text.upper() if random.random() < 0.2 else text))
    rows += [("en", "a b c d e f g " * 9), ("en", rows[0][1]), ("de", " same" * 50)] + [("fr", "copy of one text, copied often and whole")] * 20
    check(spark, rows, chunk=chunk)


def test_odd_rows(spark):
    long = " ".join(f"t{i % 97} u{i % 13}" for i in range(30_000))
    check(spark, [("en", None), (None, ""), ("en", " . ,\n"), ("en", "One two."), (None, "x " * 9), ("en", long), ("en", "y" * 100_000), ("en", "z." * 40)])
    empty = spark.createDataFrame([], "lang string, text string")
    assert phrases.collocations(empty).count() == 0


def test_hash_collisions_change_nothing(spark, monkeypatch):
    """Phrases with equal hashes are told apart by their second hash."""
    tokens = phrases.Tokens(b"a b a c . a b")
    tokens.hashes[:] = 7
    whole = {w: n for w, n in phrases._occurrences(tokens, tokens.starts >= 0, tokens.starts * 0 + 1, 2, 0, lambda h: h >= 0)}
    assert whole == {b"a b": 2, b"b a": 1, b"a c": 1}


def test_filter_has_no_false_negatives(spark):
    frequent = spark.range(5000).select(F.lit("en").alias("lang"), F.concat(F.lit("p"), "id", F.lit(" q")).cast("binary").alias("phrase"))
    test = phrases.Filter(frequent, bits=16).tester()
    seed = phrases._seed("en")
    hashes = [phrases.window_hashes(phrases.Tokens(b"p%d q" % i).hashes, 2, seed)[0] for i in range(5000)]
    assert test(phrases.np.array(hashes)).all()
