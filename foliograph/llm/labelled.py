"""A bounded sample of labelled texts with their statistics, for the classifiers that learn from labels."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliograph.llm.text_stats import RATIOS, with_statistics

#: Most rows that a classifier is fitted on.
SAMPLE = 6000


def sample(docs: DataFrame, labels: DataFrame, label: str = "quality", among: Column | None = None, most: int = SAMPLE, where: str = "true") -> tuple[np.ndarray, np.ndarray]:
    """(statistics, labels) of at most ``most`` labelled documents, those whose ids have the smallest hashes.

    A document with several labels counts with the lowest. Only the ids of the sample, ``most`` at most, are
    broadcast; nothing but text statistics goes to a classifier. ``where`` picks rows by their statistics.
    """
    ids = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & (F.lit(True) if among is None else among))
    ids = ids.groupBy("doc_id").agg(F.min(F.col(label).cast("int")).alias("_label"))
    ids = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    texts = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
    rows = with_statistics(texts).where(where).select(*RATIOS, "_label", "doc_id").dropDuplicates(["doc_id"]).toPandas().sort_values("doc_id")
    return rows[RATIOS].to_numpy(float), (rows["_label"].to_numpy() > 0).astype(float)


def condition(tests) -> Column:
    """A conjunction of threshold tests as one Spark expression."""
    out = None
    for c, greater, t in tests:
        one = F.col(RATIOS[c]) > F.lit(float(t)) if greater else F.col(RATIOS[c]) <= F.lit(float(t))
        out = one if out is None else out & one
    return out
