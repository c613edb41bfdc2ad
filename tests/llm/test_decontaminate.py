from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

from clickloom.llm import decontaminate


def slow(docs, items, window=13):
    def split(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))

    out = []
    for _, text in docs:
        words, hit, names = split(text), set(), set()
        for name, item in items:
            own = split(item)
            size = min(window, len(own))
            for s in range(len(own) - size + 1 if own else 0):
                for p in range(len(words) - size + 1):
                    if words[p : p + size] == own[s : s + size]:
                        hit.update(range(p, p + size))
                        names |= {str(name)} if name is not None else set()
        out.append((len(words), len(hit), sorted(names)))
    return out


def check(spark, make_docs, docs, items):
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("w", F.lit(1)).withColumn("h", F.lit(1))
    rows = decontaminate.report(make_docs(docs), bench).collect()
    got = sorted((r.n_words, r.n_hit, list(r["items"])) for r in rows)
    assert got == sorted(slow(docs, items))


def test_against_brute_force(spark, make_docs):
    random.seed(5)
    few, many = [f"w{i}" for i in range(3)], [f"v{i}" for i in range(400)]
    items = [(i, " ".join(random.choice(many) for _ in range(random.choice([1, 3, 5, 7, 12, 13, 14, 30])))) for i in range(25)]
    items += [(90, " ".join(random.choice(few) for _ in range(16))), (91, "same " * 14), (91, "same " * 14), (92, ""), (93, None), (None, items[-1][1])]
    docs = []
    for i in range(60):
        words = [random.choice(many + few) for _ in range(random.randint(0, 60))]
        for _ in range(random.randint(0, 3)):
            own = (random.choice(items)[1] or "").split()
            start = random.randint(0, max(0, len(own) - 13))
            words[random.randint(0, len(words)) :] = own[start : start + random.choice([11, 13, 40])] + words[:9]
        docs.append((i, ", ".join(words).upper() if i % 3 else " ".join(words)))
    docs += [(100, "same " * 40), (101, " ".join(few * 20)), (None, docs[0][1]), (102, None), (103, "")]
    check(spark, make_docs, docs, items)


def test_odd_rows(spark, make_docs, odd_docs):
    text = next(t for i, t in odd_docs if i == 5)
    long = next(t for i, t in odd_docs if i == 6)
    check(spark, make_docs, odd_docs, [(1, text), (2, " ".join(long.split()[5000:5020])), (3, "fox")])
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.report(make_docs(odd_docs), empty).filter("n_hit > 0").count() == 0
    assert decontaminate.report(make_docs(odd_docs).filter("false"), empty).count() == 0


def test_same_without_broadcast(spark, make_docs, odd_docs, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    text = next(t for i, t in odd_docs if i == 5)
    check(spark, make_docs, odd_docs, [(1, text), (2, "lazy dog")])
