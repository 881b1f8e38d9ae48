"""Repairs at the boundaries of cases: displaced endings, stranded brackets, votes past an end, parties before a header.

``lines`` have the volume's key, line_no, line and is_noise; boundaries have the key, start_line and end_line. A case
looks at a fixed number of lines around its boundary, which it reaches by an equality join on line numbers.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliograph.functions.patterns import LINES

#: Lines looked back at for a division, lines after a recovered bracket that belong to it, lines of votes past an end,
#: lines before a header.
BACK, OWN, PAST, BEFORE = 8, 10, 15, 9
#: A party's role at the end of a line, misread letters included.
ROLE_AT_END = r"(?i)(?:respond.n.s?|p.titioners?|plaintiffs?|defendants?|appellants?|appellees?|accused)\s*[.,;]*\s*$"
VOTED = r"(?i)(?:concur|dissent)"


def _names_any(line: Column, surnames: list[str]) -> Column:
    return F.upper(line).rlike("|".join(re.escape(s.upper()) for s in surnames))


def _near(lines: DataFrame, cases: DataFrame, key: str, first: Column, last: Column) -> DataFrame:
    """Lines that aren't noise with numbers from ``first`` to ``last`` of each case.

    Lines that are made of a small table look small to the optimiser, so joins of lines are asked for by merging.
    """
    asked = cases.where(last >= first).withColumn("line_no", F.explode(F.sequence(first, last)))
    return asked.join(lines.where("NOT is_noise").select(key, "line_no", "line").hint("merge"), [key, "line_no"])


def stranded_brackets(lines: DataFrame, boundaries: DataFrame, key: str) -> DataFrame:
    """(key, start_line, end_line, bracket_line): the boundaries and those recovered from brackets outside all of them.

    A bracket counts if a line that names a division or the bench stands among the eight lines before it, with no line
    of more than 80 characters between. A recovered case owns the ten lines from its bracket on, so that a second bracket there
    makes no case. Where a volume gets new cases every case ends before the next one, else all stay as they were.
    """
    by_line = Window.partitionBy(key).orderBy("line_no")
    ends = boundaries.select(key, F.col("start_line").alias("line_no"), "end_line")
    text = F.trim("line")
    kind = F.when(F.upper("line").rlike("DIVIS|BANC"), 1).when(F.length(text) > 80, 0)
    seen = F.when(~F.col("is_noise") & (text != "") & kind.isNotNull(), F.struct("line_no", kind.alias("is_division")))
    marked = lines.join(ends.hint("merge"), [key, "line_no"], "left").select(
        key, "line_no", F.max("line_no").over(Window.partitionBy(key)).alias("total"), (~F.col("is_noise") & F.col("line").rlike(LINES["bracket"])).alias("bracket"),
        F.coalesce(F.max("end_line").over(by_line.rowsBetween(Window.unboundedPreceding, Window.currentRow)) >= F.col("line_no"), F.lit(False)).alias("covered"),
        F.last(seen, ignorenulls=True).over(by_line.rowsBetween(Window.unboundedPreceding, -1)).alias("seen"),
    )
    found = marked.where("bracket AND NOT covered AND seen.is_division = 1").where(F.col("line_no") - F.col("seen.line_no") <= BACK)
    listed = found.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("line_no", F.col("seen.line_no").alias("start_line")))).alias("f"), F.first("total").alias("total"))  # a volume's stranded ones, few
    empty = F.array().cast("array<struct<line_no:int,start_line:int>>")
    owned = lambda kept, x: F.coalesce(F.try_element_at(kept, F.lit(-1))["line_no"] + OWN > x["line_no"], F.lit(False))
    kept = F.aggregate("f", empty, lambda kept, x: F.when(owned(kept, x), kept).otherwise(F.concat(kept, F.array(F.struct(x["line_no"].cast("int").alias("line_no"), x["start_line"].cast("int").alias("start_line"))))))
    new = listed.select(key, "total", F.inline(kept)).select(key, "start_line", F.lit(None).cast("int").alias("end_line"), F.col("line_no").alias("bracket_line"), "total")
    old = boundaries.select(key, "start_line", "end_line", F.lit(None).cast("int").alias("bracket_line"), F.lit(None).cast("int").alias("total"))
    total = F.max("total").over(Window.partitionBy(key))
    following = F.lead("start_line").over(Window.partitionBy(key).orderBy("start_line", "bracket_line")) - 1
    end = F.when(total.isNull(), F.col("end_line")).otherwise(F.coalesce(following, total))
    return old.unionByName(new).select(key, "start_line", end.alias("end_line"), "bracket_line")


def votes_past_end(lines: DataFrame, cases: DataFrame, key: str, surnames: list[str]) -> DataFrame:
    """(key, start_line, line_no, line): lines after a case's end that go on with its votes.

    ``cases`` have last_vote, the last line of their votes. Votes that say what was voted and don't end in a comma or
    "and" are complete. Else lines that name a member follow, past blanks, divisions and brackets, up to one that says
    what was voted or before one that names nobody.
    """
    last = F.rtrim("last_vote")
    complete = last.rlike(VOTED) & ~last.rlike(r"(?i)(?:,| and)$")
    open_cases = cases.where(F.col("last_vote").isNotNull() & ~complete).select(key, "start_line", "end_line")
    near = _near(lines, open_cases, key, F.col("end_line") + 1, F.col("end_line") + PAST)
    rows = near.where((F.trim("line") != "") & ~F.trim("line").rlike(LINES["division"]) & ~F.col("line").rlike(LINES["bracket"]))
    rows = rows.withColumn("named", _names_any(F.col("line"), surnames))
    w = Window.partitionBy(key, "start_line").orderBy("line_no")
    rows = rows.withColumns({
        "stopped": F.max(~F.col("named")).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        "ended": F.coalesce(F.max(F.col("line").rlike(VOTED)).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(False)),
    })
    return rows.where("NOT stopped AND NOT ended").select(key, "start_line", "line_no", "line")


def parties_before_header(lines: DataFrame, cases: DataFrame, key: str, surnames: list[str]) -> DataFrame:
    """(key, start_line, new_start, first_text) of cases whose parties stand before their division line.

    Upwards from the header, up to nine lines: the end of the case before, votes of members or three blanks in a row
    above some text stop it. One of the lines taken must end in a party's role.
    """
    near = _near(lines, cases.select(key, "start_line"), key, F.greatest(F.col("start_line") - BEFORE, F.lit(1)), F.col("start_line") - 1)
    blank = F.trim("line") == ""
    up = Window.partitionBy(key, "start_line").orderBy(F.desc("line_no"))
    to_here = up.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = near.withColumns({"blank": blank, "texts": F.sum(F.when(blank, 0).otherwise(1)).over(to_here)})
    run = F.count_if("blank").over(Window.partitionBy(key, "start_line", "texts").orderBy(F.desc("line_no")).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    stop = (~F.col("blank") & (F.col("line").rlike(LINES["so_ordered"]) | (F.col("line").rlike(LINES["vote"]) & _names_any(F.col("line"), surnames)))) | (F.col("blank") & (F.col("texts") > 0) & (run >= 3))
    taken = rows.withColumn("stop", stop).withColumn("stopped", F.max("stop").over(to_here)).where("NOT stopped AND NOT blank")
    found = taken.groupBy(key, "start_line").agg(F.min("line_no").alias("new_start"), F.trim(F.min_by("line", "line_no")).alias("first_text"), F.max(F.col("line").rlike(ROLE_AT_END)).alias("role"))
    return found.where("role").drop("role")


def annotation_scores(annotations: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """The best extracted field of each annotation: the first exact one, else the first that overlaps, else the first.

    Both have the key, ord (order in the case), label, grp (may be null), text, s and e. An annotation with a group
    takes fields of that group only. Exact means the same trimmed text and overlap. No field leaves ``detected`` false.
    """
    a = annotations.select(key, "ord", "label", "grp", F.trim("text").alias("text"), "s", "e")
    b = found.select(F.col(key).alias("_key"), F.col("ord").alias("_ord"), F.col("label").alias("_label"), F.col("grp").alias("_grp"), F.trim("text").alias("_text"), F.col("s").alias("_s"), F.col("e").alias("_e"))
    meet = (F.col("s") < F.col("_e")) & (F.col("_s") < F.col("e"))
    rank = F.when(meet & (F.col("text") == F.col("_text")), 0).when(meet, 1).otherwise(2)
    pairs = a.join(b, (F.col(key) == F.col("_key")) & (F.col("label") == F.col("_label")) & (F.col("grp").isNull() | (F.col("grp") == F.col("_grp"))), "left")
    best = pairs.groupBy(key, "ord", "label").agg(F.min(F.when(F.col("_ord").isNotNull(), F.struct(rank.alias("rank"), "_ord"))).alias("b"))
    rank = F.col("b.rank")
    return best.select(key, "ord", "label", F.col("b._ord").alias("found_ord"), F.coalesce(rank == 0, F.lit(False)).alias("exact"), F.coalesce(rank <= 1, F.lit(False)).alias("overlap"), rank.isNotNull().alias("detected"))


#: Lines from the next case's start in which a displaced ending is looked for.
AHEAD = 40
#: What lines of votes and footnotes behind an order look like.
VOTES_BEHIND = r"(?i)\b(?:concur|dissent|on\s+(?:official\s+)?leave|(?:took|1ook|look)\s+no\s+part)\b"
NOTES_BEHIND = r"^\s*[*\d]+\s"


def displaced_endings(lines: DataFrame, boundaries: DataFrame, key: str) -> DataFrame:
    """(key, start_line, end_line): a case takes in the ending that stands at the head of the next case.

    In the first lines of the next case, up to its syllabus, counsel or document's type, the last order or closing counts,
    with the votes and footnotes behind an order. The next case keeps its start, as its header stands before that.
    """
    following = F.lead("start_line").over(Window.partitionBy(key).orderBy("start_line"))
    ends = F.lead("end_line").over(Window.partitionBy(key).orderBy("start_line"))
    cases = boundaries.select(key, "start_line", "end_line", following.alias("next"), ends.alias("next_end"))
    near = _near(lines, cases.where("next IS NOT NULL"), key, F.col("next"), F.least(F.col("next_end"), F.col("next") + AHEAD))
    line = F.col("line")
    stops = line.rlike(LINES["syllabus"]) | line.rlike(LINES["counsel"]) | line.rlike(LINES["doc_type"])
    behind = line.rlike(VOTES_BEHIND) | line.rlike(NOTES_BEHIND)
    found = near.where(~line.rlike(r"^\s*$")).select(key, "start_line", F.struct("line_no", stops.alias("stop"), line.rlike(LINES["so_ordered"]).alias("order"), line.rlike(LINES["wherefore"]).alias("closing"), behind.alias("behind")).alias("x"))
    # as many lines as are looked at, for each case
    listed = found.groupBy(key, "start_line").agg(F.collect_list("x").alias("xs"))
    stop = F.array_min(F.transform(F.filter("xs", lambda x: x["stop"]), lambda x: x["line_no"]))
    listed = listed.withColumn("xs", F.filter("xs", lambda x: stop.isNull() | (x["line_no"] < stop)))
    order = F.array_min(F.transform(F.filter("xs", lambda x: x["order"]), lambda x: x["line_no"]))
    taken = F.filter("xs", lambda x: x["order"] | x["closing"] | (x["behind"] & (x["line_no"] > order)))
    moved = listed.select(key, "start_line", F.array_max(F.transform(taken, lambda x: x["line_no"])).alias("moved"))
    return boundaries.join(moved.hint("merge"), [key, "start_line"], "left").select(key, "start_line", F.coalesce("moved", "end_line").cast("int").alias("end_line"))
