"""Extracted spans held against annotated ones, one to one, by the rules of their label.

Spans of a position label match if they overlap at all, others if they overlap enough. Spans of a grouped label are
matched within their group first; what is left of both sides is then matched across groups. Greedy choice is sequential,
so the spans of one case and label, a handful, travel as two lists; cases are independent of each other.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice
from operator import itemgetter

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Labels of a place in a case, and labels whose spans come in numbered groups.
POSITIONS = ["start_of_case", "start_syllabus", "start_decision", "end_decision", "start_opinion", "end_opinion", "end_of_case"]
GROUPED = ["case_number", "parties"]


Span = tuple  # (grp, s, e)


def _greedy(truth: list[Span], free: list[Span], least: float, grouped: bool = False) -> Iterator[tuple[Span, Span | None, float]]:
    """Each span of truth takes the best free guess, of its group if ``grouped``; ``free`` is left with the others."""
    for a in truth:
        grp, s, e = a
        best, top = None, 0.0
        for k, (g, s2, e2) in enumerate(free):
            both = (e if e < e2 else e2) - (s if s > s2 else s2)
            if both > 0 and not (grouped and g != grp):
                iou = both / (e - s + e2 - s2 - both)
                if iou > top and iou >= least:
                    best, top = k, iou
        yield a, free.pop(best) if best is not None else None, top


def matched(truth: list[Span], guess: list[Span], label: str, least: float) -> Iterator[tuple[Span | None, Span | None, float]]:
    """(truth, guess, overlap); without a guess for what was missed, without truth for what is extra."""
    start = itemgetter(1)
    free = list(guess)
    if label in GROUPED:
        groups: dict = {}  # in the order in which they come first
        for a in truth:
            groups.setdefault(a[0], []).append(a)
        inner = list(_greedy([a for own in groups.values() for a in own], free, least, True))
        yield from (m for m in inner if m[1] is not None)
        truth = [a for a, b, _ in inner if b is None]
    free.sort(key=start)
    yield from _greedy(sorted(truth, key=start), free, 0.0 if label in POSITIONS else least)
    yield from ((None, b, 0.0) for b in free)


def _lists(batch: pa.RecordBatch, side: str) -> Iterator[list[Span]]:
    """The spans of a side, row by row, from its lists of numbers."""
    columns = [batch.column(f"{side}{c}") for c in ("grp", "s", "e")]
    flat = zip(*(x.to_pylist() if x.null_count or not pa.types.is_integer(x.type) else x.to_numpy().tolist() for x in (c.flatten() for c in columns)))
    for n in pc.list_value_length(columns[0]).to_numpy(zero_copy_only=False).tolist():
        yield list(islice(flat, n))


def matches(truth: DataFrame, guess: DataFrame, keys: list[str], least: float = 0.8) -> DataFrame:
    """(*keys, label, s, e, s2, e2, iou) of spans (*keys, label, ord, grp, s, e); s is null for extra ones, s2 for missed ones.

    Both sides are grouped together, so spans that are dealt by one of the keys aren't shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, numbers = [], []
            for k, (label, t, g) in enumerate(zip(batch.column("label").to_pylist(), _lists(batch, "t_"), _lists(batch, "g_"))):
                for a, b, iou in matched(t, g, label, least):
                    row.append(k)
                    numbers.append((*(a[1:] if a else (None, None)), *(b[1:] if b else (None, None)), round(iou, 4)))
            at = pa.array(row, pa.int64())
            columns = list(zip(*numbers)) or [()] * 5
            made = [pa.array(c, t) for c, t in zip(columns, [*[pa.int64()] * 4, pa.float64()])]
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(at) for c in (*keys, "label")), *made], [*keys, "label", "s", "e", "s2", "e2", "iou"])

    kinds = ", ".join(f"`{k}` {truth.schema[k].dataType.simpleString()}" for k in keys)
    span = F.struct("ord", "grp", F.col("s").cast("long").alias("s"), F.col("e").cast("long").alias("e"))
    columns = [*keys, "label", span.alias("span")]
    both = truth.select(*columns, F.lit(True).alias("true_")).union(guess.select(*columns, F.lit(False).alias("true_")))
    # a null in a key fits nothing: such spans stay apart by side
    apart = F.when(F.exists(F.array(*[F.col(c).isNull() for c in (*keys, "label")]), lambda x: x), F.col("true_")).alias("apart")
    listed = both.groupBy(*keys, "label", apart).agg(*[F.sort_array(F.collect_list(F.when(F.col("true_") == side, F.col("span")))).alias(to) for to, side in (("t", True), ("g", False))])
    part = lambda side, c: F.transform(side, lambda x: x[c]).alias(f"{side}_{c}")
    sent = listed.select(*keys, "label", *[part(side, c) for side in "tg" for c in ("grp", "s", "e")])
    return sent.mapInArrow(run, f"{kinds}, label string, s long, e long, s2 long, e2 long, iou double")


def label_scores(found: DataFrame, by: list[str]) -> DataFrame:
    """(*by, tp, fp, fn, precision, recall, f1) of ``matches``; 0 where there is nothing to divide by."""
    hit, extra = F.col("s").isNotNull() & F.col("s2").isNotNull(), F.col("s").isNull()
    n = found.groupBy(*by).agg(F.count_if(hit).alias("tp"), F.count_if(extra).alias("fp"), F.count_if(F.col("s2").isNull()).alias("fn"))
    share = lambda a, b: F.coalesce(F.round(F.col(a) / F.nullif(b, F.lit(0)), 4), F.lit(0.0))
    tp, fp, fn = (F.col(c) for c in ("tp", "fp", "fn"))
    return n.withColumns({"precision": share("tp", tp + fp), "recall": share("tp", tp + fn), "f1": F.coalesce(F.round(2 * tp / F.nullif(2 * tp + fp + fn, F.lit(0)), 4), F.lit(0.0))})
