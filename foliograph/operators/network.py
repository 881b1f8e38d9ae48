"""Graphs of joint participation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliograph.operators import steps
from foliograph.operators.steps import dealt


def joint_pairs(participation: DataFrame, role: str, least: int = 1, rows: int = 0) -> DataFrame:
    """(case_id, a, b) with a < b for each pair of elements with ``role`` in a case of ``least`` such elements.

    Cases are bounded by the size of the court; elements keep a position so that repeated ones count again. Pairs are
    many times the elements, so the number of tasks isn't made smaller by the elements' size. ``rows`` is how many elements
    are dealt by case already, if they are.
    """
    own = participation.where(F.col("role") == role)
    if rows <= steps.ROWS:
        own = own.repartition(int(participation.sparkSession.conf.get("spark.sql.shuffle.partitions")), "case_id")
    listed = own.groupBy("case_id").agg(F.sort_array(F.collect_list("member")).alias("m")).where(F.size("m") >= least)
    x = listed.select("case_id", F.posexplode("m").alias("i", "a"), "m")
    return x.select("case_id", "a", F.explode(F.slice("m", F.col("i") + 2, F.size("m"))).alias("b")).where("a <> b")


def edges(participation: DataFrame, rows: int = 0) -> DataFrame:
    """Weighted edges (source < target): joint majorities, and joint dissents of two or more."""
    both = joint_pairs(participation, "majority", 1, rows).union(joint_pairs(participation, "dissent", 2, rows))
    return weighted(both, rows)


def weighted(pairs: DataFrame, rows: int = 0) -> DataFrame:
    """Pairs (a, b), of ``rows`` elements, as edges; of four elements to a case there are 1.5 pairs for each."""
    ends = pairs.select(F.col("a").alias("source"), F.col("b").alias("target"))
    return dealt(ends, 2 * rows, "source", "target").groupBy("source", "target").agg(F.count("*").alias("weight"))


def degrees(links: DataFrame) -> DataFrame:
    """(node, degree, weighted_degree)"""
    ends = links.select(F.col("source").alias("node"), "weight").union(links.select("target", "weight"))
    return ends.groupBy("node").agg(F.count("*").alias("degree"), F.sum("weight").alias("weighted_degree"))


def summary(links: DataFrame) -> DataFrame:
    """One row: nodes, edges, total_weight, density = 2E / (N (N - 1))."""
    nodes = links.select("source").union(links.select("target")).distinct().agg(F.count("*").alias("nodes"))
    one = links.agg(F.count("*").alias("edges"), F.sum("weight").alias("total_weight")).crossJoin(nodes)  # two single rows
    return one.withColumn("density", F.coalesce(F.round(2 * F.col("edges") / F.nullif(F.col("nodes") * (F.col("nodes") - 1), F.lit(0)), 6), F.lit(0.0)))


def adjacency(links: DataFrame) -> DataFrame:
    """Both directions of every edge, for a pivot or a matrix sink: (row, column, weight)."""
    return links.select(F.col("source").alias("row"), F.col("target").alias("column"), "weight").union(links.select("target", "source", "weight"))


def span_pairs(participation: DataFrame, span: tuple[str, ...]) -> DataFrame:
    """(*span, source, target): a row for each pair of a case, names that a list has twice as loops.

    ``span`` says in which windows a case is.
    """
    def pairs(role: str, least: int) -> DataFrame:
        listed = participation.where(F.col("role") == role).groupBy("case_id", *span).agg(F.sort_array(F.collect_list("member")).alias("m")).where(F.size("m") >= least)
        x = listed.select(*span, F.posexplode("m").alias("i", "source"), "m")
        return x.select(*span, "source", F.explode(F.slice("m", F.col("i") + 2, F.size("m"))).alias("target"))

    return pairs("majority", 1).union(pairs("dissent", 2))


def window_edges(participation: DataFrame, span: tuple[str, ...], unfold, rows: int = 0) -> DataFrame:
    """(k, source, target, weight): edges of each window's cases, names that a list has twice as loops.

    ``span`` says in which windows a case is; pairs are counted by it first, and ``unfold`` makes rows by window of counts.
    Pairs of ``rows`` elements are dealt by their ends, where both counts are made.
    """
    both = dealt(span_pairs(participation, span), 2 * rows, "source", "target")
    counts = both.groupBy(*span, "source", "target").agg(F.count("*").alias("n"))
    return unfold(counts).groupBy("k", "source", "target").agg(F.sum("n").alias("weight"))


#: Names that are nobody's.
NOBODY = ["LLM_TEST_MARKER", "Per curiam", "PER CURIAM", ""]


def case_blocs(cases: DataFrame, no_part_dissents: bool = False, other_dissents: bool = False) -> DataFrame:
    """(case_id, rule, names): who voted together in each case of (case_id, ponente, concurring, dissenting, no_part, other).

    The author belongs to the majority, unless it is the whole court or nobody is named; lists keep repeated names.
    """
    some = lambda c: F.filter(F.transform(F.coalesce(F.col(c), F.array().cast("array<string>")), lambda x: F.trim(x)), lambda x: ~x.isin(*NOBODY))
    author = F.trim(F.coalesce("ponente", F.lit("")))
    majority = F.concat(some("concurring"), F.when(~author.isin(*NOBODY), F.array(author)).otherwise(F.array().cast("array<string>")))
    dissent = F.concat(some("dissenting"), *[some(c) for c, on in (("no_part", no_part_dissents), ("other", other_dissents)) if on])
    sides = F.array(F.struct(F.lit("majority").alias("rule"), majority.alias("names")), F.struct(F.lit("dissent").alias("rule"), dissent.alias("names")))
    return cases.select("case_id", F.inline(sides))


def ruled_edges(blocs: DataFrame, joins: DataFrame, rows: int = 0) -> DataFrame:
    """(source, target, weight, majority, dissent, joins): edges with what they come from, source before target.

    Pairs within the majority, pairs of two dissenters or more, and who joins whose dissent (case_id, joiner, target), in
    one generation of pairs. A bench bounds the names of a case; edges of ``rows`` names are dealt by their ends.
    """
    x = blocs.where((F.col("rule") == "majority") | (F.size("names") >= 2)).select("rule", F.posexplode("names").alias("i", "a"), "names")
    pairs = x.select("rule", "a", F.explode(F.slice("names", F.col("i") + 2, F.size("names"))).alias("b"))
    both = pairs.unionByName(joins.select(F.lit("joins").alias("rule"), F.col("joiner").alias("a"), F.col("target").alias("b"))).where("a <> b")
    ends = dealt(both.select("rule", F.least("a", "b").alias("source"), F.greatest("a", "b").alias("target")), 2 * rows, "source", "target")
    return ends.groupBy("source", "target").agg(F.count("*").alias("weight"), *[F.count_if(F.col("rule") == r).alias(r) for r in ("majority", "dissent", "joins")])


def case_counts(blocs: DataFrame) -> DataFrame:
    """(node, case_count): how often each name stands in a bloc."""
    return blocs.select(F.explode("names").alias("node")).groupBy("node").agg(F.count("*").alias("case_count"))


def edge_statistics(cases: DataFrame, blocs: DataFrame, joins: DataFrame) -> DataFrame:
    """One row: cases, those without an author and of the whole court, edges added by each rule (repeats included)."""
    n = F.size("names")
    named = F.size(F.array_distinct("names"))
    loops = F.aggregate(F.array_distinct("names"), F.lit(0).cast("long"), lambda t, y: t + (F.size(F.filter("names", lambda z: z == y)) * (F.size(F.filter("names", lambda z: z == y)) - 1) / 2).cast("long"))
    added = F.when((F.col("rule") == "majority") | (n >= 2), (n * (n - 1) / 2).cast("long") - F.when(named < n, loops).otherwise(0))
    rules = blocs.agg(*[F.coalesce(F.sum(F.when(F.col("rule") == r, added)), F.lit(0)).alias(f"{r}_edges") for r in ("majority", "dissent")])
    author = F.trim(F.coalesce("ponente", F.lit("")))
    first = cases.agg(F.count("*").alias("n_cases"), F.count_if(author == "").alias("empty_ponente"), F.count_if(author.isin("", "Per curiam", "PER CURIAM")).alias("per_curiam_cases"))
    return first.crossJoin(rules).crossJoin(joins.agg(F.count_if(F.col("joiner") != F.col("target")).alias("join_edges")))  # single rows
