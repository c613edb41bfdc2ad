"""Toxicity grades by cumulative-link ordinal regression over sparse text features.

P(grade > k | text) = sigmoid(w . x - theta_k): one weight vector for all thresholds, and the
expected severity is the sum of these probabilities. Weights and thresholds maximise the likelihood
of the grades themselves, P(grade = k) = sigmoid(theta_k - w . x) - sigmoid(theta_(k-1) - w . x).
Its logarithm is a sum of three terms,

    log sigmoid(theta_k - w . x) + log sigmoid(w . x - theta_(k-1)) + log(1 - exp(theta_(k-1) - theta_k)),

of which the last has no text in it and keeps the thresholds in order: it is minus infinity where
two of them meet. The sum is concave, so the maximum is the only one. Every step adds up gradients
in one Spark job over the labelled rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import saved, set_aside

GRADES = 3  # none, some, severe
LABELLED = 20_000  # bound of the labelled sample
DIMENSIONS = 1 << 18
STEMS = (4, 5)
LEAST_ROWS, LEAST_RATIO, MARKER = 5, 1.0, 3.0
PENALTY, STEPS, MEMORY = 4e-4, 60, 10  # of the squared weights; most steps of the search, and steps it remembers
TASKS = 16  # most tasks of a step, each sending one gradient to the driver
FAR = 50.0  # a threshold beyond all labels
_WORD = re.compile(r"[^\W_]+")


def features(text: str | None) -> list[int]:
    """Hashed distinct words in lower case (letters and digits) and their first letters, which hold an unseen word's stem.

    Null and empty texts have none.
    """
    words = set(_WORD.findall((text or "").lower()))
    terms = words.union(*({w[:n] + "*" for w in words} for n in STEMS))
    return sorted({zlib.crc32(t.encode("utf-8", "surrogatepass")) % DIMENSIONS for t in terms})


def feature_column(text: Column) -> Column:
    @F.pandas_udf("array<int>")
    def hashed(texts: pd.Series) -> pd.Series:
        return texts.map(features)

    return hashed(text)


def log_ratios(rows: DataFrame) -> np.ndarray:
    """For each feature of labelled rows `_toxic, _x`: log of how much more frequent it is in toxic rows; 0 if rare or even."""
    sizes = rows.agg(F.sum("_toxic").alias("bad"), F.count("*").alias("all")).first()
    bad, clean = (sizes["bad"] or 0) + 1, sizes["all"] - (sizes["bad"] or 0) + 1
    counts = rows.select("_toxic", F.explode("_x").alias("f")).groupBy("f").agg(F.sum("_toxic").alias("t"), F.count("*").alias("n"))
    odds = F.log((F.col("t") + 0.5) / bad) - F.log((F.col("n") - F.col("t") + 0.5) / clean)
    found = counts.filter(F.col("n") >= LEAST_ROWS).select("f", odds.alias("r")).filter(F.abs("r") >= LEAST_RATIO).toPandas()  # DIMENSIONS rows at most
    ratios = np.zeros(DIMENSIONS)
    ratios[found["f"].to_numpy(np.int64)] = found["r"]
    return ratios


def severity_grades(rows: DataFrame, ratios: np.ndarray) -> DataFrame:
    """Adds `_grade` to labelled rows `_toxic, _x`: 0 if not toxic, else 1, or 2 for the half with more markers.

    The labels only say whether a text is toxic. Markers are features e^`MARKER` times as frequent in toxic rows.
    """
    marker = ratios >= MARKER

    @F.pandas_udf("long")
    def markers(x: pd.Series) -> pd.Series:
        return x.map(lambda f: int(marker[f].sum()))

    rows = rows.withColumn("_n", markers("_x"))
    middle = rows.filter("_toxic = 1").agg(F.expr("percentile_approx(_n, 0.5)")).first()[0]
    severe = F.coalesce(F.col("_n") > F.lit(middle), F.lit(False)).cast("int")
    return rows.withColumn("_grade", F.when(F.col("_toxic") == 1, 1 + severe).otherwise(0)).drop("_n")


@dataclass(frozen=True)
class Severity:
    """Shared weights and the thresholds; without labels on both sides of a threshold there are none, and severity is a constant."""

    weights: np.ndarray | None
    thresholds: tuple[float, ...]
    constant: float = 0.0

    def score(self, docs: DataFrame, text_column: str = "text") -> DataFrame:
        """The rows with `_severity` (expected grade), `_grade` (thresholds more likely passed than not) and `_toxic` (P(grade > 0)).

        Every row is scored, repeated rows and null ids too; null and empty texts have no features and
        get what the thresholds say. An empty table gives no rows. Columns of the three names are replaced.
        """
        docs = docs.drop("_severity", "_grade", "_toxic")
        if self.weights is None:
            known = {"_severity": F.lit(self.constant), "_grade": F.lit(int(self.constant)), "_toxic": F.lit(float(self.constant > 0))}
            return docs.withColumns(known)
        sent = docs.sparkSession.sparkContext.broadcast(self.weights.astype(np.float32))  # DIMENSIONS numbers

        @F.pandas_udf("double")
        def weighed(texts: pd.Series) -> pd.Series:
            weights = sent.value
            return texts.map(lambda t: float(weights[features(t)].sum(dtype=np.float64)))

        text = F.col(text_column)
        docs, back = set_aside(docs, "_odds")
        rows = docs.withColumn("_odds", weighed(text))
        passed = [1 / (1 + F.exp(F.lit(t) - F.col("_odds"))) for t in self.thresholds]
        return rows.select(
            *back,
            sum(passed, F.lit(0.0)).alias("_severity"),
            sum(((p > 0.5).cast("int") for p in passed), F.lit(0)).alias("_grade"),
            passed[0].alias("_toxic"),
        )


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(x / 2))


def batch_gradient(point: np.ndarray, values: np.ndarray, level: np.ndarray, sizes: np.ndarray, f: np.ndarray) -> np.ndarray:
    """Negated log-likelihood of some rows, without the term of the thresholds alone, behind its gradient.

    `point` is the weight of each feature, then the thresholds; the rows' features `f` lie one behind the other, `sizes` a row.
    """
    width, count = len(values), len(level)
    row = np.repeat(np.arange(count), sizes)
    odds = np.bincount(row, weights=(point[:width] * values)[f], minlength=count)
    cuts = np.concatenate([[-np.inf], point[width:], [np.inf]])
    above, below = cuts[level + 1] - odds, cuts[level] - odds
    up, down = _sigmoid(-above), _sigmoid(below)
    by_feature = np.bincount(f, weights=(up - down)[row], minlength=width) * values
    levels = len(cuts) - 1
    by_cut = np.bincount(level, weights=down, minlength=levels)[1:] - np.bincount(level, weights=up, minlength=levels)[:-1]
    return np.concatenate([by_feature, by_cut, [(np.logaddexp(0, -above) + np.logaddexp(0, below)).sum()]])


def minimum(value_and_slope: Callable[[np.ndarray], tuple[float, np.ndarray]], point: np.ndarray) -> np.ndarray:
    """Minimum of a convex function by L-BFGS with halved steps; infinite values are stepped back from."""
    value, slope = value_and_slope(point)
    moves: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(STEPS):
        step, kept = -slope, []
        for moved, turned in reversed(moves):
            share = moved @ step / (moved @ turned)
            step = step - share * turned
            kept.append(share)
        if moves:
            moved, turned = moves[-1]
            step = step * (moved @ turned / (turned @ turned))
        for (moved, turned), share in zip(moves, reversed(kept), strict=True):
            step = step + (share - turned @ step / (moved @ turned)) * moved
        expected, length = slope @ step, 1.0
        while length > 1e-9:
            there = point + length * step
            value_there, slope_there = value_and_slope(there)
            if value_there <= value + 1e-4 * length * expected:
                break
            length /= 2
        else:
            return point
        if (slope_there - slope) @ (there - point) > 1e-14:
            moves = [*moves, (there - point, slope_there - slope)][-MEMORY:]
        gained = value - value_there
        point, value, slope = there, value_there, slope_there
        if gained <= 1e-7 * max(abs(value), 1e-3):
            break
    return point


def fit_ordinal(rows: DataFrame, counts: list[int], values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds of rows `_level` (0, 1, …, `counts` of them, none 0) and `_f` (indices into `values`)."""
    rows, width, size = rows.coalesce(TASKS), len(values), sum(counts)
    inner = np.array(counts[1:-1], float)

    def value_and_slope(point: np.ndarray) -> tuple[float, np.ndarray]:
        gaps = np.diff(point[width:])
        if (gaps <= 0).any():
            return np.inf, point

        def gradient(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(len(point) + 1)
            for batch in batches:
                lists = batch.column("_f")
                sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
                total += batch_gradient(point, values, batch.column("_level").to_numpy(), sizes, lists.flatten().to_numpy())
            yield pa.record_batch([pa.array([total.tobytes()], pa.binary())], ["sums"])

        sums = sum(np.frombuffer(r["sums"]) for r in rows.mapInArrow(gradient, "sums binary").collect())  # TASKS rows at most
        slope, value = sums[:-1] / size, sums[-1] / size
        value += PENALTY / 2 * (point[:width] @ point[:width]) - inner @ np.log(-np.expm1(-gaps)) / size
        slope[:width] += PENALTY * point[:width]
        pressed = inner / np.expm1(gaps) / size
        slope[width:] += np.concatenate([pressed, [0.0]]) - np.concatenate([[0.0], pressed])
        return value, slope

    passed = 1 - np.cumsum(counts)[:-1] / size
    found = minimum(value_and_slope, np.concatenate([np.zeros(width), np.log(1 - passed) - np.log(passed)]))
    return found[:width], found[width:]


def train(rows: DataFrame, ratios: np.ndarray, grades: int = GRADES) -> Severity:
    """Fit on rows `_grade, _x`, each feature with its log ratio as value; grades outside 0 .. grades - 1 are ignored.

    A grade that no label has passes with the next one that some have: its threshold is the same.
    """
    used = np.flatnonzero(ratios)
    place = np.full(DIMENSIONS, -1, np.int32)
    place[used] = np.arange(len(used))

    @F.pandas_udf("array<int>")
    def placed(x: pd.Series) -> pd.Series:
        return x.map(lambda f: (p := place[np.asarray(f, np.int64)])[p >= 0])

    rows = rows.filter(F.col("_grade").between(0, grades - 1))
    counts = {r["_grade"]: r["count"] for r in rows.groupBy("_grade").count().collect()}
    seen = sorted(counts)
    if len(seen) < 2:
        return Severity(None, (), float(seen[0]) if seen else 0.0)
    level = F.element_at(F.create_map(*(F.lit(n) for pair in zip(seen, range(len(seen)), strict=True) for n in pair)), F.col("_grade"))
    graded = saved(rows.select(level.alias("_level"), placed("_x").alias("_f")), "graded")
    weights, cuts = fit_ordinal(graded, [counts[g] for g in seen], ratios[used])
    cuts = [-FAR, *map(float, cuts), FAR]
    whole = np.zeros(DIMENSIONS)
    whole[used] = weights * ratios[used]
    return Severity(whole, tuple(cuts[sum(g <= k for g in seen)] for k in range(grades - 1)))


def fit_labels(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, id_column: str = "doc_id", label_column: str = "toxic") -> Severity:
    """Fit on at most `labelled` documents with a 0/1 label; labels that are neither, or of null ids, are ignored.

    Of repeated labels of an id the higher counts, of repeated documents each is a row. The sampled
    labels go to every task, so texts stay where they are.
    """
    truth = labels.filter(F.col(label_column).isin(0, 1)).groupBy(F.col(id_column).alias("_id")).agg(F.max(label_column).cast("int").alias("_toxic"))
    truth = truth.filter("_id IS NOT NULL")
    share = min(1.0, 0.95 * labelled / max(1, truth.count()))
    truth = truth.filter(F.pmod(F.xxhash64("_id", F.lit("sample")), F.lit(1_000_000)) < int(share * 1_000_000))
    texts = docs.select(F.col(id_column).alias("_doc"), F.col("text").alias("_text"))
    rows = texts.join(F.broadcast(truth), F.col("_doc") == F.col("_id")).select("_toxic", feature_column(F.col("_text")).alias("_x"))
    rows = saved(rows, "labelled")
    ratios = log_ratios(rows)
    return train(severity_grades(rows, ratios), ratios)
