"""Quality rules: learned decision lists, emitted as ordered Spark conditional expressions.

Sequential covering: a conjunction of threshold tests over text statistics is grown on two thirds of the rows by
information gain until it covers rejected texts only, pruned on the other third from its last test backwards, and
taken into the list if it is precise there; what it covers leaves the rows, and the next one is grown. The list
ends when no precise rule is left; texts that no rule covers are kept.

Statistics and verdicts are DataFrame expressions without Python and without a shuffle of texts. A null or empty
text has no words and fails the base rules. Labels that are null or missing teach nothing; without labels of both
kinds the list is empty. Rows that occur again are judged alike; other columns are left aside.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliograph.llm._common import table
from foliograph.llm.labelled import condition, sample
from foliograph.llm.text_stats import with_statistics
from foliograph.llm.trees import Test, cuts, holds

BASE_FAILED = "n_words < 10 OR 100 * n_repeat_words > 20 * n_words"
#: Share of rejected texts that a rule must reach on the rows it was not grown on.
PRECISION = 0.9
MOST_RULES, MOST_TESTS, LEAST_COVERED = 24, 4, 4


def grow_rule(x: np.ndarray, y: np.ndarray) -> tuple[Test, ...]:
    """Tests that together cover rows with y = 1 and few others; each is the one of highest information gain."""
    tests: tuple[Test, ...] = ()
    inside = np.ones(len(y), bool)
    while len(tests) < MOST_TESTS and (y[inside] == 0).any():
        xs, ys = x[inside], y[inside]
        before, best = np.log2(ys.mean()), (1e-9, None)
        for c in range(x.shape[1]):
            for t in cuts(xs[:, c], 64):
                high = xs[:, c] > t
                for greater, got in ((True, high), (False, ~high)):
                    p = ys[got].sum()
                    if p >= LEAST_COVERED and (gain := p * (np.log2(p / got.sum()) - before)) > best[0]:
                        best = (gain, (c, greater, float(t)))
        if best[1] is None:
            break
        tests = (*tests, best[1])
        inside &= holds(x, (best[1],))
    return tests


def prune_rule(tests: tuple[Test, ...], x: np.ndarray, y: np.ndarray) -> tuple[tuple[Test, ...], float]:
    """The beginning of the tests with the best (right - wrong) / covered on other rows; its precision there."""
    best = ((), -1.0, 0.0)
    for k in range(len(tests), 0, -1):
        got = y[holds(x, tests[:k])]
        if len(got) and (worth := (2 * got.sum() - len(got)) / (len(got) + 1)) > best[1]:
            best = (tests[:k], worth, got.mean())
    return best[0], best[2]


def learn(x: np.ndarray, kept: np.ndarray, seed: int = 5) -> list[tuple[Test, ...]]:
    """Ordered rejection rules from statistics and labels (1: keep)."""
    y = 1.0 - kept
    rules: list[tuple[Test, ...]] = []
    draw = np.random.default_rng(seed)
    while len(rules) < MOST_RULES and y.sum() >= 2 * LEAST_COVERED:
        third = draw.random(len(y)) < 1 / 3
        if not y[~third].sum() or y[~third].mean() == 1 or not third.any():
            break
        tests, precision = prune_rule(grow_rule(x[~third], y[~third]), x[third], y[third])
        got = holds(x, tests) if tests else np.zeros(len(y), bool)
        if not tests or precision < PRECISION or y[got].mean() < PRECISION or got.sum() < LEAST_COVERED:
            break
        rules.append(tests)
        x, y = x[~got], y[~got]
    return rules


def verdict(rules: list[tuple[Test, ...]]) -> Column:
    """The list as one ordered conditional expression: false at the first rule that holds, else true."""
    if not rules:
        return F.lit(True)
    case = F
    for tests in rules:
        case = case.when(condition(tests), F.lit(False))
    return case.otherwise(F.lit(True))


def fit(docs: DataFrame, labels: DataFrame) -> list[tuple[Test, ...]]:
    """Rules from a bounded sample of the labelled documents that the base rules pass."""
    x, kept = sample(docs, labels, where=f"NOT ({BASE_FAILED})")
    return learn(x, kept) if len(kept) else []


def judge(docs: DataFrame, rules: list[tuple[Test, ...]], *columns: str) -> DataFrame:
    """(doc_id, *columns, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept)."""
    others = [c for c in columns if c not in ("doc_id", "text")]
    stats = with_statistics(docs.select("doc_id", "text", *others)).withColumn("base_failed", F.expr(BASE_FAILED))
    return stats.select(
        "doc_id", *columns, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & verdict(rules)).alias("kept")
    )


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return judge(docs, fit(docs, table(spark, sf_dir, "labels")))
