"""What became of spans between two versions of a case's annotations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliograph.operators.records import four_way

#: Fixed value: characters that the start of an adjusted span may move.
NEAR = 200


def five_way(before: DataFrame, after: DataFrame, near: int = NEAR) -> DataFrame:
    """(case_id, label, s, e, s2, e2, kind) of spans (case_id, label, s, e), distinct within a side.

    As ``four_way``, and of what is removed and added with one label the nearest starts are one adjusted span: removed
    ones take, in order of place, the nearest free added one within ``near`` characters, the first of equals. s2 and e2
    are the new place. The lists are those of one case and label.
    """
    told = four_way(before, after)
    place = F.struct(F.col("s").cast("long").alias("s"), F.col("e").cast("long").alias("e"))
    same = F.struct(place["s"].alias("s"), place["e"].alias("e"), place["s"].alias("s2"), place["e"].alias("e2"), F.col("kind").alias("kind"))
    lists = [F.sort_array(F.collect_list(F.when(F.col("kind") == k, place))).alias(k) for k in ("removed", "added")]
    sides = told.groupBy("case_id", "label").agg(*lists, F.collect_list(F.when(~F.col("kind").isin("removed", "added"), same)).alias("kept"))
    empty = F.expr("CAST(array() AS array<struct<s: bigint, e: bigint, s2: bigint, e2: bigint>>)")

    def take(state, span):
        gap = lambda x: F.abs(x["s"] - span["s"])
        best = F.array_min(F.transform(F.filter(state["free"], lambda x: gap(x) <= near), lambda x: F.struct(gap(x).alias("gap"), x["s"].alias("s"), x["e"].alias("e"))))
        left = F.filter(state["free"], lambda x: best.isNull() | (x["s"] != best["s"]) | (x["e"] != best["e"]))
        row = F.struct(span["s"].alias("s"), span["e"].alias("e"), best["s"].alias("s2"), best["e"].alias("e2"))
        return F.struct(left.alias("free"), F.array_append(state["out"], row).alias("out"))

    walked = sides.select("case_id", "label", "kept", F.aggregate("removed", F.struct(F.col("added").alias("free"), empty.alias("out")), take).alias("w"))
    own = F.transform("w.out", lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["s2"].alias("s2"), x["e2"].alias("e2"), F.when(x["s2"].isNull(), "removed").otherwise("span_adjusted").alias("kind")))
    none = F.lit(None).cast("long")
    new = F.transform("w.free", lambda x: F.struct(none.alias("s"), none.alias("e"), x["s"].alias("s2"), x["e"].alias("e2"), F.lit("added").alias("kind")))
    # a row for each list first: a list made inside the generator would be made again for each of its rows
    return walked.select("case_id", "label", F.explode(F.array("kept", own, new)).alias("rows")).select("case_id", "label", F.inline("rows"))
