"""Quality classifier by co-training of two views: what a text is like, and what is known about its page.

Each view has its own logistic regression. In every round each model scores all unlabelled documents
and hands every one that it is confident about to the other view's training set; only the labelled
rows are sampled. However many pseudo-labels there are, together they weigh a fixed share of what
the labelled rows weigh, so labels keep their say in a table of any size. Afterwards each view is
calibrated on labelled rows that neither saw, and the calibrated log-odds of the views are summed
over the common prior. A view that knows nothing calibrates to the prior and so adds nothing.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import pandas as pd
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import FeatureHasher
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import saved, set_aside

LABELLED = 20_000  # bound of the labelled sample
ROUNDS, CONFIDENT, GIVEN = 3, 0.98, 0.5  # rounds, least confidence of a pseudo-label, weight of all of them for 1 of all labels
HASHED = 256
KEEP = 0.5  # documents below are rejected
_UPPER, _DIGITS, _MARKS = bytes(range(65, 91)), bytes(range(48, 58)), bytes([*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)])
_PLAIN = b".,'-"
_ODD = bytes(set(_MARKS) - set(_PLAIN))


def text_features(text: str | None) -> list[float]:
    """Shape of a text, as shares of its bytes and words; null and empty texts are all zero."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.lower().split()
    if not words:
        return [0.0] * 13
    size, count = len(data), len(words)

    def share(of: bytes) -> float:
        return 1 - len(data.translate(None, of)) / size

    distinct = len(set(words))
    repeated = sum(map(bytes.__eq__, words, words[1:])) / count
    pairs = len(set(zip(words, words[1:], strict=False))) / max(1, count - 1)
    lines = data.split(b"\n")
    return [
        1.0, share(_UPPER), share(_DIGITS), share(_ODD), share(_PLAIN), share(b"|"),
        distinct / count, distinct / math.sqrt(count) / 10, repeated, pairs,
        (size - count) / count / 10, len(set(lines)) / len(lines), math.log2(size + 1) / 10,
    ]


def views(docs: DataFrame, text_column: str = "text", lang_column: str = "lang", source_column: str = "source") -> DataFrame:
    """The rows with the vectors `_text` and `_page` of the two views; null metadata counts as empty.

    The page view knows language, source and both together, and nothing about the text.
    """

    @F.pandas_udf("array<double>")
    def text_view(texts: pd.Series) -> pd.Series:
        return texts.map(text_features)

    lang, source = (F.coalesce(F.col(c), F.lit("")) for c in (lang_column, source_column))
    parts = docs.withColumns({"_text": array_to_vector(text_view(F.col(text_column))), "_lang": lang, "_source": source})
    parts = parts.withColumn("_both", F.concat_ws("\x1f", "_lang", "_source"))
    hasher = FeatureHasher(inputCols=["_lang", "_source", "_both"], outputCol="_page", numFeatures=HASHED)
    return hasher.transform(parts).drop("_lang", "_source", "_both")


@dataclass(frozen=True)
class CoTrained:
    """Both models with their calibration; `None` models stand for labels of one class only."""

    text: LogisticRegressionModel | None
    page: LogisticRegressionModel | None
    calibration: tuple[tuple[float, float], tuple[float, float]]
    prior: float

    def good(self, rows: DataFrame) -> DataFrame:
        """Rows of `views` with `_good`, the probability that a document is good."""
        if self.text is None:
            return rows.withColumn("_good", F.lit(self.prior))
        odds = F.lit(0.0)
        for model, name, (slope, shift) in zip((self.text, self.page), ("_text", "_page"), self.calibration, strict=True):
            rows = _scored(model, rows, name)
            odds = odds + F.lit(slope) * F.col(f"{name}_odds") + F.lit(shift)
        odds = odds - F.lit(math.log(self.prior / (1 - self.prior)))
        return rows.withColumn("_good", 1 / (1 + F.exp(-odds))).drop("_text_odds", "_page_odds")


def _scored(model: LogisticRegressionModel, rows: DataFrame, view: str) -> DataFrame:
    """Adds the view's log-odds."""
    model = model.setFeaturesCol(view).setRawPredictionCol("_raw").setProbabilityCol("").setPredictionCol("")
    scored = model.transform(rows).withColumn(f"{view}_odds", F.element_at(vector_to_array("_raw"), 2))
    return scored.drop("_raw")


def _fit(rows: DataFrame, view: str) -> LogisticRegressionModel:
    """Fit on rows with `_label` and `_weight`."""
    regression = LogisticRegression(featuresCol=view, labelCol="_label", weightCol="_weight", regParam=1e-3, maxIter=50)
    return regression.fit(rows.select(view, "_label", "_weight"))


def pseudo_labelled(seen: DataFrame, sure: DataFrame, view: str, given: float = GIVEN) -> DataFrame:
    """Labelled rows of weight 1 and `sure` rows, each `_label` of which weighs `given` times its weight among the labelled rows.

    So neither the size of the table nor a view that is surer of one label shifts the balance of the labels.
    """
    labels = (0.0, 1.0)
    truth, found = ({r["_label"]: r["count"] for r in rows.groupBy("_label").count().collect()} for rows in (seen, sure))
    weight = F.lit(0.0)
    for label in labels:
        weight = F.when(F.col("_label") == label, given * truth.get(label, 0) / max(1, found.get(label, 0))).otherwise(weight)
    return seen.select("_label", view, F.lit(1.0).alias("_weight")).unionByName(sure.select("_label", view, weight.alias("_weight")))


def _calibrate(model: LogisticRegressionModel, held: DataFrame, view: str) -> tuple[float, float]:
    """Slope and shift that turn the model's log-odds into those seen on rows it has not met."""
    rows = _scored(model, held, view).select(array_to_vector(F.array(f"{view}_odds")).alias("x"), "_label")
    fitted = LogisticRegression(featuresCol="x", labelCol="_label", regParam=1e-3, standardization=True).fit(rows)
    return float(fitted.coefficients[0]), float(fitted.intercept)


def _sample(rows: DataFrame, bound: int, key: Column) -> DataFrame:
    """At most `bound` rows (by expectation a little fewer), the same ones in every run."""
    share = min(1.0, 0.95 * bound / max(1, rows.count()))
    return rows.filter(F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(1_000_000)) < int(share * 1_000_000))


def train(
    docs: DataFrame,
    labels: DataFrame,
    labelled: int = LABELLED,
    rounds: int = ROUNDS,
    id_column: str = "doc_id",
    label_column: str = "quality",
) -> CoTrained:
    """Co-train on about `labelled` labelled rows at most and all rows without a sampled label.

    Labels other than 0 and 1 and labels of null ids are ignored, of repeated labels of an id the
    lower counts. Without labels of both classes the model knows the prior only, or 1.0 without any.
    """
    truth = labels.filter(F.col(label_column).isin(0, 1)).groupBy(F.col(id_column).alias("_id")).agg(F.min(label_column).cast("double").alias("_label"))
    truth = _sample(truth.filter("_id IS NOT NULL"), labelled, F.col("_id"))
    docs = docs.select(F.col(id_column).alias("_doc"), "text", "lang", "source")
    rows = docs.join(F.broadcast(truth), F.col("_doc") == F.col("_id"), "left")  # `labelled` ids at most
    rows = saved(views(rows).select("_id", "_label", "_text", "_page"), "views")
    others = rows.filter("_label IS NULL").select("_text", "_page")
    known = saved(rows.filter("_label IS NOT NULL").withColumn("_row", F.monotonically_increasing_id()), "labelled")
    if known.count() > labelled:  # ids that repeat
        known = _sample(known, labelled, F.col("_row"))
    counts = {r["_label"]: r["count"] for r in known.groupBy("_label").count().collect()}
    if set(counts) != {0.0, 1.0}:
        return CoTrained(None, None, ((0.0, 0.0), (0.0, 0.0)), 0.0 if set(counts) == {0.0} else 1.0)
    prior = counts[1.0] / sum(counts.values())

    fold = F.pmod(F.xxhash64("_id", F.lit("fold")), F.lit(4))
    held, seen = known.filter(fold == 0), known.filter(fold != 0)
    if held.select("_label").distinct().count() < 2 or seen.select("_label").distinct().count() < 2:
        held = seen = known
    models = {view: _fit(seen.withColumn("_weight", F.lit(1.0)), view) for view in ("_text", "_page")}
    limit = math.log(CONFIDENT / (1 - CONFIDENT))
    for _ in range(rounds):
        # All that a view is sure of now is what the other learns from next.
        given = {}
        for view, other in (("_text", "_page"), ("_page", "_text")):
            slope, shift = _calibrate(models[view], held, view)
            sure = _scored(models[view], others, view).withColumn("_odds", F.lit(slope) * F.col(f"{view}_odds") + F.lit(shift))
            sure = sure.filter(F.abs("_odds") >= limit).withColumn("_label", (F.col("_odds") > 0).cast("double"))
            given[other] = pseudo_labelled(seen, sure, other)
        models = {view: _fit(rows, view) for view, rows in given.items()}
    calibration = tuple(_calibrate(models[view], held, view) for view in ("_text", "_page"))
    return CoTrained(models["_text"], models["_page"], calibration, prior)


def score(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of `docs` with `_good`, the probability that the document is good.

    Every row is scored, repeated rows, null ids and null texts too; an empty table gives no rows. A column `_good` is replaced.
    """
    model = train(docs, labels, **options)
    rows, back = set_aside(docs.drop("_good"), "_text", "_page", "_lang", "_source", "_both", "_raw", "_text_odds", "_page_odds")
    return model.good(views(rows)).select(*back, "_good")
