"""Quality classifier: a linear support vector machine on naive Bayes weights (operator 10).

A text is its set of byte trigrams, one blank added at either end. Each trigram weighs its
log-count ratio between the classes; a linear hinge-loss model on these vectors, each of
length one, is fitted by dual coordinate descent, and a logistic curve turns margins into
probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from storelens.llm.common import fold, ship

BITS = 18
# Rows of each class that the model is fitted on; a documented bound, chosen by id hash.
SAMPLE_ROWS = 4000
KEEP_AT = 0.7


def indicators(text: str | None) -> np.ndarray:
    """Sorted numbers of the trigrams that occur in a text."""
    data = np.frombuffer(b" " + (text or "").encode() + b"  ", dtype=np.uint8).astype(np.uint32)
    grams = (data[:-2] << np.uint32(16)) | (data[1:-1] << np.uint32(8)) | data[2:]
    seen = np.zeros(1 << BITS, dtype=bool)
    seen[(grams * np.uint32(2654435761)) >> np.uint32(32 - BITS)] = True
    return np.flatnonzero(seen).astype(np.int32)


@dataclass
class Model:
    """score = 1 / (1 + exp(-(slope * margin + shift))), margin = sum(weight) / norm + bias."""

    weight: np.ndarray
    square: np.ndarray
    bias: float
    slope: float
    shift: float

    @property
    def learnt(self) -> bool:
        """False if every text has the same score."""
        return bool(self.square.any())

    def margin(self, features: np.ndarray) -> float:
        norm = np.sqrt(self.square[features].sum(dtype=np.float64))
        total = self.weight[features].sum(dtype=np.float64)
        return (total / norm if norm > 0 else 0.0) + self.bias

    def score(self, text: str | None) -> float:
        z = self.slope * self.margin(indicators(text)) + self.shift
        return float(1.0 / (1.0 + np.exp(-np.clip(z, -700, 700))))


def _constant(share: float) -> Model:
    none = np.zeros(1 << BITS, dtype=np.float32)
    share = min(max(share, 1e-6), 1 - 1e-6)
    return Model(none, none, 0.0, 0.0, float(np.log(share / (1 - share))))


def _descend(rows: list[np.ndarray], values: list[np.ndarray], sign: np.ndarray, cost: float, rounds: int):
    """Dual coordinate descent for min |w|^2 / 2 + cost * sum(hinge); a constant feature is the bias."""
    weight, bias = np.zeros(1 << BITS), 0.0
    alpha = np.zeros(len(rows))
    norm = np.array([(v @ v) + 1.0 for v in values])
    order = np.random.default_rng(7)
    for _ in range(rounds):
        largest = 0.0
        for i in order.permutation(len(rows)):
            slope = sign[i] * (weight[rows[i]] @ values[i] + bias) - 1.0
            step = min(max(alpha[i] - slope / norm[i], 0.0), cost) - alpha[i]
            if step:
                alpha[i] += step
                weight[rows[i]] += step * sign[i] * values[i]
                bias += step * sign[i]
                largest = max(largest, abs(step))
        if largest < 1e-4:
            break
    return weight, bias


def _platt(margin: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve by Newton steps, with smoothed targets."""
    good, bad = label.sum(), (1 - label).sum()
    target = np.where(label == 1, (good + 1) / (good + 2), 1 / (bad + 2))
    x = np.stack([margin, np.ones_like(margin)], axis=1)
    beta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ (target - p))
        beta = beta + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1])


def train(rows: list[np.ndarray], label: np.ndarray, cost: float = 1.0, rounds: int = 30) -> Model:
    """Fits on indicator rows with labels 0 and 1. With one class only, every score is its share."""
    if len(label) == 0:
        return _constant(0.5)
    if label.min() == label.max():
        return _constant(float(label.mean()))
    counts = np.ones((2, 1 << BITS))
    for row, y in zip(rows, label):
        counts[y, row] += 1
    ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    values = [ratio[row] / max(np.sqrt(ratio[row] @ ratio[row]), 1e-12) for row in rows]
    sign = np.where(label == 1, 1.0, -1.0)
    # Margins for the curve come from a model that has not seen the rows.
    half = np.arange(len(rows)) % 2 == 0
    margin = np.zeros(len(rows))
    for part in (half, ~half):
        chosen = np.flatnonzero(part)
        if len(np.unique(label[chosen])) < 2:
            half = None
            break
        w, b = _descend([rows[i] for i in chosen], [values[i] for i in chosen], sign[chosen], cost, rounds)
        for i in np.flatnonzero(~part):
            margin[i] = w[rows[i]] @ values[i] + b
    weight, bias = _descend(rows, values, sign, cost, rounds)
    if half is None:
        margin = np.array([weight[r] @ v + bias for r, v in zip(rows, values)])
    slope, shift = _platt(margin, label)
    return Model(
        (weight * ratio).astype(np.float32), (ratio * ratio).astype(np.float32), bias, slope, shift
    )


def sample_labels(labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """Up to so many labelled ids of each class outside the held-out fold, in hash order.

    An id whose labels disagree is left out, and so are null ids and other labels than 0 and 1.
    """
    one = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & (fold("doc_id", 4) != 2))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.max("quality").alias("most"))
        .filter(F.col("quality") == F.col("most"))
    )
    ranked = Window.partitionBy("quality").orderBy(F.xxhash64("doc_id"), "doc_id")
    return one.withColumn("place", F.row_number().over(ranked)).filter(F.col("place") <= rows)


def fit(documents: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def features(texts: pd.Series) -> pd.Series:
        return texts.map(indicators)

    ship(documents.sparkSession)
    chosen = sample_labels(labels.select("doc_id", "quality"), rows)
    texts = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # At most 2 * rows ids, so that the texts of the rest need not move.
    found = texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "quality", features("text").alias("grams"))
    got = found.toArrow().sort_by([("doc_id", "ascending")])
    rows_ = [np.asarray(x.values) for x in got["grams"]]
    return train(rows_, got["quality"].to_numpy().astype(np.int64))


def scorer(model: Model) -> Column:
    """Column of scores of the column `text`; null counts as empty."""

    @F.pandas_udf(T.DoubleType())
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([model.score(text) for text in texts], dtype="float64")

    return score(F.coalesce("text", F.lit("")))


def quality_scores(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Every document with score and predicted; further columns stay.

    Null and empty texts score as the text without trigrams. Repeated rows are scored each.
    Columns score and predicted of the input are replaced. Without labels every score is 0.5.
    """
    return judge(documents, fit(documents, labels))


def judge(documents: DataFrame, model: Model) -> DataFrame:
    """Every document with score and predicted by a fitted model."""
    scored = documents.withColumn("score", scorer(model))
    return scored.withColumn("predicted", (F.col("score") >= KEEP_AT).cast("int"))
