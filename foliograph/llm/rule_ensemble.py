"""Quality classifier: a sparse ensemble of rules over text statistics, compiled into Spark expressions.

Trees are grown on resampled labelled rows; every path from a root becomes a conjunctive rule. A logistic model with
an L1 penalty weights the rules (proximal gradient), most of which get no weight. The rest become one column
expression, so scoring runs inside the executors' generated code.

Learns from a bounded sample (``labelled.SAMPLE``) of rows outside the held-out fold. Null and empty texts are scored
by their statistics, all 0. With no labels, or of one kind only, every score is the share of label 1, or 0.5.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliograph.llm._common import crc_bucket, table
from foliograph.llm.labelled import condition, sample
from foliograph.llm.text_stats import with_statistics
from foliograph.llm.trees import Test, grow, holds, paths

TREES, DEPTH, LEAST, PENALTY, STEPS = 24, 3, 8, 0.002, 1500
CUT = 0.3


@dataclass
class Ensemble:
    bias: float
    rules: list[tuple[tuple[Test, ...], float]]

    def score(self) -> Column:
        z = F.lit(float(self.bias))
        for tests, weight in self.rules:
            z = z + F.when(condition(tests), F.lit(float(weight))).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def learn(x: np.ndarray, y: np.ndarray, seed: int = 9) -> Ensemble:
    if not len(y) or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.5
        share = min(max(share, 0.01), 0.99)
        return Ensemble(float(np.log(share / (1 - share))), [])
    draw = np.random.default_rng(seed)
    balance = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    found: dict[bytes, tuple[Test, ...]] = {}
    for _ in range(TREES):
        rows = draw.choice(len(y), min(len(y), 2000), replace=False)
        columns = draw.choice(x.shape[1], max(2, x.shape[1] // 2), replace=False)
        for tests in paths(grow(x[rows], y[rows], balance[rows], DEPTH, LEAST, columns)):
            found.setdefault(holds(x, tests).tobytes(), tests)  # rules that cover the same rows count once
    tests = list(found.values())
    weights, bias = lasso(np.stack([holds(x, t) for t in tests], 1).astype(float), y)
    return Ensemble(bias, [(t, float(w)) for t, w in zip(tests, weights) if w])


def lasso(r: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and bias of the L1-penalised logistic model, by accelerated proximal gradient steps."""
    n, k = r.shape
    rate = 4.0 * n / (np.linalg.norm(np.c_[r, np.ones(n)], 2) ** 2)
    w, b = np.zeros(k), float(np.log(y.mean() / (1 - y.mean())))
    w1, b1, t = w.copy(), b, 1.0
    for _ in range(STEPS):
        e = 1 / (1 + np.exp(-(r @ w1 + b1))) - y
        w0, b0 = w, b
        w = w1 - rate * (r.T @ e) / n
        w = np.sign(w) * np.maximum(np.abs(w) - rate * PENALTY, 0)
        b = b1 - rate * e.mean()
        t0, t = t, (1 + np.sqrt(1 + 4 * t * t)) / 2
        w1, b1 = w + (t0 - 1) / t * (w - w0), b + (t0 - 1) / t * (b - b0)
    return w, float(b)


def score(docs: DataFrame, model: Ensemble) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    held = F.coalesce(crc_bucket(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out")
    scored = with_statistics(docs.select("doc_id", "text")).select("doc_id", held, model.score().alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= CUT).cast("int"))


def fit(docs: DataFrame, labels: DataFrame) -> Ensemble:
    x, y = sample(docs, labels, among=crc_bucket(F.col("doc_id"), 5) != 0)
    return learn(x, y)


def op9_quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, fit(docs, table(spark, sf_dir, "labels")))
