"""Keyed records: repair by group statistics, before/after comparison, merge, incremental gates, span scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def upper_median(values: DataFrame, by: str, value: str, least: int = 3) -> DataFrame:
    """(by, median): element floor(n / 2) of the sorted values counted from 0; null below ``least`` values.

    Ranked by a window within the group, so a group is never gathered into one array.
    """
    w = Window.partitionBy(by)
    ranked = values.where(F.col(value).isNotNull()).select(by, value, F.row_number().over(w.orderBy(value)).alias("r"), F.count("*").over(w).alias("n"))
    return ranked.groupBy(by).agg(F.max(F.when((F.col("r") == F.floor(F.col("n") / 2) + 1) & (F.col("n") >= least), F.col(value))).alias("median"))


def outliers(rows: DataFrame, by: str, date: str, days: int = 730) -> DataFrame:
    """``rows`` with their group's upper median date and ``is_outlier``, more than ``days`` away from it."""
    return rows.join(upper_median(rows, by, date), by, "left").withColumn("is_outlier", F.coalesce(F.abs(F.datediff(date, "median")) > days, F.lit(False)))


def last_per_key(rows: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The last row of each key in the given order."""
    w = Window.partitionBy(*keys).orderBy(*[F.desc(o) for o in order])
    return rows.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def merge_keyed(previous: DataFrame, current: DataFrame, keys: list[str], method: str = "method") -> DataFrame:
    """Current rows, but earlier 'llm' rows win over them, and earlier 'regex' rows fill keys that neither has.

    Keys compare null-safely; ``previous`` has an ``ord`` that picks the first of repeated fillers.
    """

    def lacking(a: DataFrame, b: DataFrame) -> DataFrame:
        other = b.select(*[F.col(k).alias(f"_{k}") for k in keys]).distinct()
        return a.join(other, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys], "left_anti")

    columns = current.columns
    llm = previous.where(F.col(method) == "llm").select(columns)
    w = Window.partitionBy(*keys).orderBy("ord")
    filler = previous.where(F.col(method) != "llm").withColumn("_rn", F.row_number().over(w)).where("_rn = 1").select(columns)
    kept = lacking(current, llm)
    return kept.union(llm).union(lacking(filler, kept.union(llm)))


def reprocess_reason(force: Column, status: Column, old_mtime: Column, mtime: Column) -> Column:
    """Why an input is processed again, in order of the tests; 'up_to_date' if it isn't."""
    return F.when(force, "forced").when(status.isNull(), "missing").when(status != "done", "not_done").when(old_mtime != mtime, "changed").otherwise("up_to_date")


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """``new`` and the rows of ``old`` with other keys."""
    return new.unionByName(old.join(new.select(key).distinct(), key, "left_anti"))


def four_way(before: DataFrame, after: DataFrame) -> DataFrame:
    """Spans (case_id, label, s, e) told apart: exact, label_changed (same place), removed, added; a row each.

    Spans are distinct within a side; a span with several partners of another label counts once per side. Both sides go
    through two windows that have the case among their keys: if they are dealt by case they aren't shuffled.
    """
    on, place = ["case_id", "label", "s", "e"], ["case_id", "s", "e"]
    known = lambda keys: F.forall(F.array(*[F.col(k).isNotNull() for k in keys]), lambda x: x)  # noqa: E731  null fits nothing
    held = lambda test, keys: known(keys) & F.max(test).over(Window.partitionBy(*keys))
    both = before.select(*on, F.lit(True).alias("old")).union(after.select(*on, F.lit(False).alias("old")))
    told = both.withColumn("exact", held(F.col("old"), on) & held(~F.col("old"), on))
    told = told.withColumns({"has_gone": held(~F.col("exact") & F.col("old"), place), "has_new": held(~F.col("exact") & ~F.col("old"), place)})
    kind = F.when(F.col("old"), F.when(F.col("exact"), "exact").when(F.col("has_new"), "label_changed").otherwise("removed")).when(~F.col("exact") & ~F.col("has_gone"), "added")
    return told.select(*on, kind.alias("kind")).where("kind IS NOT NULL")


def iou(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    """Intersection over union of half-open spans; 0 for empty or invalid ones."""
    inter = F.greatest(F.least(a1, b1) - F.greatest(a0, b0), F.lit(0))
    union = F.greatest(a1 - a0, F.lit(0)) + F.greatest(b1 - b0, F.lit(0)) - inter
    return F.coalesce(F.when((a1 > a0) & (b1 > b0), inter / F.nullif(union, F.lit(0))), F.lit(0.0))


def prf(tp: Column, fp: Column, fn: Column) -> dict[str, Column]:
    """precision, recall and f1 to four places, 0 where undefined."""
    safe = lambda a, b: F.coalesce(a / F.nullif(b, F.lit(0)), F.lit(0.0))
    return {"precision": F.round(safe(tp, tp + fp), 4), "recall": F.round(safe(tp, tp + fn), 4), "f1": F.round(safe(2 * tp, 2 * tp + fp + fn), 4)}
