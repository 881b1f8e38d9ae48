"""Names resolved to persons by tiers; the first tier that finds one counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _words(name: Column) -> Column:
    """Different words of a name in capitals, without commas and suffixes."""
    return F.array_distinct(F.filter(F.split(F.regexp_replace(F.regexp_replace(F.upper(name), ",", " "), r"\b[JS]R\.", " "), r"\s+"), lambda x: x != ""))


def resolved(nodes: DataFrame, persons: DataFrame, aliases: DataFrame, least: int = 4) -> DataFrame:
    """(node, person, tier): tier 0 the exact name, 1 an alias, 2 all words of the node, 3 its last word if it is unique.

    ``persons`` has ord and person, ``aliases`` alias and target, a part of a person's name. All tiers are equality
    joins on names or words, so no node is held against every person; of several persons the first one counts. Nodes
    that no tier finds have tier null.
    """
    known = persons.select("ord", "person", _words(F.col("person")).alias("words"))
    word = known.select("ord", "person", "words", F.explode("words").alias("word"))
    asked = nodes.select("node").distinct().withColumns({"up": F.upper(F.trim("node")), "tokens": _words(F.col("node"))})
    first = lambda df, tier: df.groupBy("node").agg(F.min_by("person", "ord").alias("person")).withColumn("tier", F.lit(tier))
    exact = first(asked.join(known, F.col("node") == F.col("person")), 0)
    named = aliases.select(F.upper("alias").alias("up"), F.lower("target").alias("target"), F.element_at(_words(F.col("target")), -1).alias("word"))
    alias = first(asked.join(named, "up").join(word, "word").where(F.contains(F.lower("person"), F.col("target"))), 1)
    subset = asked.select("node", "tokens", F.get("tokens", 0).alias("word")).join(word, "word").where(F.size(F.array_except("tokens", "words")) == 0)
    alone = word.groupBy("word").agg(F.count("*").alias("n"), F.min("ord").alias("ord"), F.first("person").alias("person")).where("n = 1")
    last = asked.select("node", F.element_at(F.when(F.size("tokens") > 0, F.col("tokens")), -1).alias("word")).where(F.length("word") >= least).join(alone, "word")
    found = exact.union(alias).union(first(subset, 2)).union(first(last, 3))
    best = found.groupBy("node").agg(F.min_by("person", "tier").alias("person"), F.min("tier").alias("tier"))
    return asked.select("node").join(best, "node", "left")
