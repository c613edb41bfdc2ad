from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickloom.llm import quality, toxicity

DATA = "/root/testdata/sf0.01"


def tables(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")


def test_quality_on_held_out_labels(spark):
    docs, labels = tables(spark)
    model = quality.train(docs, labels.filter("doc_id % 3 <> 0"), rounds=2)
    rows = model.good(quality.views(docs)).join(labels.filter("doc_id % 3 = 0"), "doc_id").select("quality", "_good").collect()
    assert sum((r._good >= 0.5) == (r.quality == 1) for r in rows) >= 0.97 * len(rows)


def test_every_confident_document_is_a_pseudo_label(spark, monkeypatch):
    """More unlabelled rows than any pool: each one that a view is sure of is learned from."""
    docs, labels = tables(spark)
    labels, known = labels.filter("doc_id % 3 = 0"), docs.join(labels.filter("doc_id % 3 = 0"), "doc_id").count()
    others = docs.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(30)))).withColumn("doc_id", F.lit(None).cast("long")).drop("copy")
    sizes, fit = [], quality._fit
    monkeypatch.setattr(quality, "_fit", lambda rows, view: sizes.append(rows.count()) or fit(rows, view))
    quality.train(docs.unionByName(others), labels, rounds=1)
    assert len(sizes) == 4 and sizes[0] <= known and max(sizes[2:]) > 10_000


def test_toxicity_on_held_out_labels(spark):
    docs, labels = tables(spark)
    model = toxicity.fit_labels(docs, labels.filter("doc_id % 3 <> 0"))
    assert list(model.thresholds) == sorted(model.thresholds)
    rows = model.score(docs).join(labels.filter("doc_id % 3 = 0"), "doc_id").select("toxic", "_toxic", "_severity", "_grade").collect()
    assert sum((r._toxic >= 0.5) == (r.toxic == 1) for r in rows) >= 0.95 * len(rows)
    assert all(0 <= r._severity <= 2 and r._grade in (0, 1, 2) for r in rows)
    assert min(r._severity for r in rows if r._grade == 2) > max(r._severity for r in rows if r._grade == 0)


def test_odd_rows(spark, make_docs, odd_docs):
    docs = make_docs(odd_docs)
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (3, 1, 0), (4, 1, 0), (4, 0, 1), (5, None, None), (6, 1, 0), (None, 0, 1), (7, 5, 5)], "doc_id long, quality int, toxic int")
    for rows in (quality.score(docs, labels, rounds=1), toxicity.fit_labels(docs, labels).score(docs)):
        assert rows.columns[: len(docs.columns)] == docs.columns and rows.count() == len(odd_docs)
    assert all(0 <= r._good <= 1 for r in quality.score(docs, labels, rounds=1).collect())


def test_labels_of_one_class_or_none(spark, make_docs, odd_docs):
    docs = make_docs(odd_docs)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    bad = spark.createDataFrame([(4, 0, 1), (6, 0, 1)], "doc_id long, quality int, toxic int")
    assert {r._good for r in quality.score(docs, none).collect()} == {1.0}
    assert {r._good for r in quality.score(docs, bad).collect()} == {0.0}
    assert {r._severity for r in toxicity.fit_labels(docs, none).score(docs).collect()} == {0.0}
    assert toxicity.fit_labels(docs, none).score(docs.filter("false")).count() == 0
    assert quality.score(docs.filter("false"), none).count() == 0


def test_text_features():
    assert quality.text_features(None) == quality.text_features(" \n") == [0.0] * 13
    assert len(quality.text_features("a")) == 13 and toxicity.features(None) == []


def test_missing_threshold(spark):
    rows = spark.createDataFrame([(0, [1, 2]), (0, [1]), (1, [3]), (1, [3, 4])], "_grade int, _x array<int>")
    model = toxicity.train(rows, np.ones(toxicity.DIMENSIONS), grades=4)
    assert model.thresholds[1:] == (50.0, 50.0) and model.thresholds[0] < 50
    assert rows.select(F.size("_x")).count() == 4


def loss(rows, weights, cuts, values):
    """The contract's likelihood as written: probabilities of grades as differences, row by row."""
    total = toxicity.PENALTY / 2 * sum(w * w for w in weights)
    for level, f in rows:
        odds = sum(weights[i] * values[i] for i in f)
        below = [0.0, *(1 / (1 + math.exp(odds - c)) for c in cuts), 1.0]
        gap = below[level + 1] - below[level]
        total -= (math.log(gap) if gap > 0 else -math.inf) / len(rows)
    return total


@pytest.mark.parametrize("levels", [2, 3, 4])
def test_fit_is_the_maximum_of_the_likelihood(spark, levels):
    draw = random.Random(levels)
    values = np.array([1.0, 0.5, -2.0, 1.5, 3.0])
    rows = []
    for _ in range(300):
        f = sorted(draw.sample(range(5), draw.randint(0, 4)))
        rows.append((min(levels - 1, max(0, int(sum(values[i] for i in f) / 2 + draw.gauss(1, 1)))), f))
    counts = [sum(r[0] == k for r in rows) for k in range(levels)]
    weights, cuts = toxicity.fit_ordinal(spark.createDataFrame(rows, "_level int, _f array<int>").repartition(3), counts, values)
    assert list(cuts) == sorted(set(cuts)) and len(cuts) == levels - 1
    least, found = loss(rows, weights, cuts, values), np.concatenate([weights, cuts])
    for i in range(len(found)):
        for by in (-0.02, 0.02):
            moved = found.copy()
            moved[i] += by
            assert loss(rows, moved[:5], moved[5:], values) > least
    for _ in range(50):
        moved = found + np.array([draw.gauss(0, 0.1) for _ in found])
        assert loss(rows, moved[:5], moved[5:], values) > least


def test_gradient_is_the_slope():
    values, level, sizes, f = np.array([1.0, -2.0, 0.5]), np.array([0, 2, 1, 1]), np.array([2, 0, 1, 3]), np.array([0, 1, 2, 0, 1, 2])
    point = np.array([0.3, -0.2, 1.1, -0.4, 0.9])
    slope = toxicity.batch_gradient(point, values, level, sizes, f)[:-1]
    for i in range(len(point)):
        near = np.eye(len(point))[i] * 1e-6
        up, down = (toxicity.batch_gradient(point + d, values, level, sizes, f)[-1] for d in (near, -near))
        assert abs((up - down) / 2e-6 - slope[i]) < 1e-6


def test_a_grade_without_labels_shares_the_next_threshold(spark):
    rows = spark.createDataFrame([(0, [1, 2]), (0, [1]), (3, [3]), (3, [3, 4])], "_grade int, _x array<int>")
    low, mid, high = toxicity.train(rows, np.ones(toxicity.DIMENSIONS), grades=4).thresholds
    assert low == mid == high and abs(low) < 50


def test_scores_as_the_formula_says(spark, make_docs, odd_docs):
    weights = np.zeros(toxicity.DIMENSIONS, np.float32)
    weights[toxicity.features("the quick")] = 0.25
    model = toxicity.Severity(weights, (0.5, 1.5))
    docs = make_docs(odd_docs).withColumns({"_odds": F.lit("mine"), "_Severity": F.lit("old")})
    found = model.score(docs)
    assert found.columns == [*docs.columns[:-1], "_severity", "_grade", "_toxic"]
    for row in found.collect():
        odds = float(weights[toxicity.features(row.text)].sum(dtype=np.float64))
        passed = [1 / (1 + math.exp(t - odds)) for t in model.thresholds]
        assert row._odds == "mine" and row._grade == sum(p > 0.5 for p in passed)
        assert abs(row._severity - sum(passed)) < 1e-12 and abs(row._toxic - passed[0]) < 1e-12


def test_pseudo_labels_weigh_the_same_in_a_table_of_any_size(spark):
    seen = spark.createDataFrame([(1.0, 0)] * 6 + [(0.0, 1)] * 2, "_label double, x int")
    for copies in (1, 50):
        sure = spark.createDataFrame([(1.0, 2)] * 4 * copies + [(0.0, 3)] * copies, "_label double, x int")
        rows = quality.pseudo_labelled(seen, sure, "x", given=0.5).groupBy("x").agg(F.sum("_weight").alias("w")).collect()
        assert {r.x: round(r.w, 9) for r in rows} == {0: 6.0, 1: 2.0, 2: 3.0, 3: 1.0}
    assert quality.pseudo_labelled(seen, sure.filter("x = 2"), "x").filter("_label = 0").agg(F.sum("_weight")).first()[0] == 2.0


def test_views_share_nothing(spark, make_docs):
    """The page view sees no text, the text view no page."""
    docs = make_docs([(1, "a"), (2, "b " * 5000), (3, None)]).withColumns({"lang": F.lit("en"), "source": F.lit("s")})
    other = docs.withColumns({"lang": F.lit(None).cast("string"), "source": F.lit("t")})
    assert quality.views(docs).select("_page").distinct().count() == 1
    assert quality.views(docs).unionByName(quality.views(other)).select("_text").distinct().count() == 3


def test_good_as_the_formula_says(spark):
    """Calibrated log-odds of both views, added over the prior, from weights worked out by hand."""
    docs, labels = tables(spark)
    docs = docs.limit(300).withColumns({"_raw": F.lit("mine"), "_Page": F.lit(1)})
    model = quality.train(docs, labels, rounds=1)
    found = quality.score(docs, labels, rounds=1)
    assert found.columns == [*docs.columns, "_good"] and {(r._raw, r._Page) for r in found.collect()} == {("mine", 1)}
    rows = model.good(quality.views(docs.drop("_raw", "_Page"))).select("_text", "_page", "_good").collect()
    for row in rows:
        odds = -math.log(model.prior / (1 - model.prior))
        for fitted, x, (slope, shift) in zip((model.text, model.page), (row._text, row._page), model.calibration, strict=True):
            odds += slope * (float(fitted.coefficients.dot(x)) + fitted.intercept) + shift
        assert abs(row._good - 1 / (1 + math.exp(-odds))) < 1e-9
