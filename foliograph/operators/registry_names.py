"""Names in vote statements against a registry, and registry names against persons.

A registry is a list of names in capitals, in order. A token is matched by tiers: alias, exact name, name without its
suffix, unique last word of a compound name, name with a suffix added, else the most similar name. Only different tokens
are matched, by joins; which of single, pair and parts of a token counts is then read off per clause in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliograph.operators.records_text import NO_VOTERS, best_match, clauses_in
from foliograph.operators.steps import tabled

SUFFIX = r",?\s*(?:JR|SR)\.?\s*$"
#: Similarity below which a token is nobody's.
LEAST = 0.75


def registry_keys(registry: DataFrame) -> DataFrame:
    """(key, name): what names a registry entry exactly; ``registry`` is (ord, name).

    Of entries with one key the last in order has it. Last words count where they are of one compound name only, have
    three letters and are no key otherwise.
    """
    names = registry.select("ord", F.upper(F.trim("name")).alias("name"))
    base = names.select("ord", "name", F.trim(F.regexp_replace("name", SUFFIX, "")).alias("key")).where("key <> '' AND key <> name")
    given = names.select("ord", "name", F.col("name").alias("key")).unionByName(base)
    exact = given.groupBy("key").agg(F.max_by("name", F.struct("ord", F.col("key") != F.col("name"))).alias("name"))
    words = F.split("name", r"\s+")
    last = names.where(F.size(words) >= 2).select("name", F.regexp_replace(F.element_at(words, -1), r"[.,]+$", "").alias("key")).where(F.length("key") >= 3)
    alone = last.groupBy("key").agg(F.count("*").alias("n"), F.first("name").alias("name")).where("n = 1").select("key", "name")
    return exact.unionByName(alone.join(exact, "key", "left_anti"))


def matched(tokens: DataFrame, registry: DataFrame, aliases: DataFrame | None = None, least: float = LEAST) -> DataFrame:
    """(token, name, score) of each different token that some entry of the registry (ord, name) fits; aliases: (alias, name)."""
    keys = tabled(registry_keys(registry))
    asked = tokens.select(F.trim("token").alias("token")).distinct().where(F.length("token") >= 2).withColumn("up", F.upper("token"))
    tiers = [asked.join(keys, F.col("up") == F.col("key")).select("token", "name", F.lit(1).alias("tier"))]
    tiers += [asked.join(keys, F.concat("up", F.lit(s)) == F.col("key")).select("token", "name", F.lit(k).alias("tier")) for k, s in ((2, ", JR."), (3, ", SR."))]
    if aliases is not None:
        meant = aliases.select(F.upper("alias").alias("up"), F.upper("name").alias("key"))
        tiers.append(asked.join(meant, "up").join(keys, "key").select("token", "name", F.lit(0).alias("tier")))
    exact = tiers[0]
    for t in tiers[1:]:
        exact = exact.unionByName(t)
    exact = exact.groupBy("token").agg(F.min_by("name", "tier").alias("name")).withColumn("score", F.lit(1.0))
    # an entry is as similar as its better form, with or without its suffix; of equals the first in order counts
    names = registry.select("ord", F.upper(F.trim("name")).alias("entry"))
    forms = names.select("ord", "entry", F.col("entry").alias("name")).union(names.select("ord", "entry", F.trim(F.regexp_replace("entry", SUFFIX, "")).alias("name")))
    forms = tabled(forms.where("name <> ''").groupBy("name").agg(F.min(F.struct("ord", "entry")).alias("x")).select("name", F.col("x.ord").alias("ord"), F.col("x.entry").alias("entry")))
    near = best_match(asked.join(exact, "token", "left_anti").select("token"), forms, least=least, order="ord")
    return exact.unionByName(near.join(forms.select("name", "entry"), "name").select("token", F.col("entry").alias("name"), "score"))


def picked(clauses: DataFrame, keys: list[str], registry: DataFrame, aliases: DataFrame | None = None, least: float = LEAST) -> DataFrame:
    """(*keys, pos, name, unmatched) of clauses (*keys, tokens): names in order, and tokens that name nobody.

    Read from the left: a token and its next one together if that fits as well as the token alone, else the token, else
    its words one by one; what then is no name but looks like one is unmatched.
    """
    token = clauses.select(*keys, F.posexplode("tokens").alias("at_", "token"), F.col("tokens"))
    following = F.get("tokens", F.col("at_") + 1)
    parts = F.filter(F.transform(F.split("token", r"\s+"), lambda x: F.regexp_replace(x, r"^[\s.,;:\-*'\"]+|[\s.,;:\-*'\"]+$", "")), lambda x: (F.length(x) >= 2) & ~x.isin(*NO_VOTERS))
    token = tabled(token.select(*keys, "at_", "token", F.concat_ws(" ", "token", following).alias("pair"), following.isNotNull().alias("paired"), F.when(F.size(F.split("token", r"\s+")) >= 2, parts).otherwise(F.array().cast("array<string>")).alias("parts")))
    every = token.select("token").union(token.where("paired").select("pair")).union(token.select(F.explode("parts")))
    found = tabled(matched(every, registry, aliases, least))
    single = found.select("token", F.struct("name", "score").alias("single"))
    double = found.select(F.col("token").alias("pair"), F.struct("name", "score").alias("double"))
    part = token.select(*keys, "at_", F.posexplode("parts").alias("j", "word")).join(found.select(F.col("token").alias("word"), "name"), "word").groupBy(*keys, "at_").agg(F.transform(F.sort_array(F.collect_list(F.struct("j", "name"))), lambda x: x["name"]).alias("of_parts"))
    read = token.join(single, "token", "left").join(double, "pair", "left").join(part, [*keys, "at_"], "left")
    together = F.col("paired") & F.col("double").isNotNull() & (F.col("double.score") >= F.coalesce("single.score", F.lit(0.0)))
    none = F.array().cast("array<string>")
    names = F.when(together, F.array("double.name")).when(F.col("single").isNotNull(), F.array("single.name")).otherwise(F.coalesce("of_parts", none))
    noise = F.upper("token").isin(*[x.upper() for x in NO_VOTERS])
    left = (F.size(names) == 0) & F.col("token").rlike("[A-Z]") & (F.length("token") >= 3) & ~noise
    line = F.struct("at_", F.coalesce(together, F.lit(False)).alias("two"), names.alias("names"), F.when(left, F.col("token")).alias("unmatched"))
    # a clause is a list of names in one sentence; the choice for a token depends on whether the one before took it in
    listed = read.groupBy(*keys).agg(F.sort_array(F.collect_list(line)).alias("xs"))
    start = F.struct(F.lit(False).alias("skip"), F.slice("xs", 1, 0).alias("out"))
    walk = F.aggregate("xs", start, lambda a, x: F.struct((~a["skip"] & x["two"]).alias("skip"), F.when(a["skip"], a["out"]).otherwise(F.concat(a["out"], F.array(x))).alias("out")))
    kept = listed.select(*keys, F.explode(walk["out"]).alias("x"))
    named = kept.select(*keys, F.col("x.at_").alias("at_"), F.posexplode("x.names").alias("j", "name"))
    lost = kept.where("x.unmatched IS NOT NULL").select(*keys, (F.col("x.at_") * 1000).alias("pos"), F.col("x.unmatched").alias("name"), F.lit(True).alias("unmatched"))
    return named.select(*keys, (F.col("at_") * 1000 + F.col("j")).alias("pos"), "name", F.lit(False).alias("unmatched")).unionByName(lost)


def named_votes(statements: DataFrame, key: str, raw: str, registry: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """(key, category, name) of vote statements, names as the registry has them; category "unmatched" for the rest."""
    found = picked(clauses_in(statements, key, raw), [key, "category", "i", "part"], registry, aliases)
    return found.select(key, F.when(F.col("unmatched"), "unmatched").otherwise(F.col("category")).alias("category"), "name").distinct()


def _words(name: Column) -> Column:
    return F.filter(F.split(F.upper(F.regexp_replace(F.regexp_replace(name, r"[.,\-]", " "), r"(?i)\b[JS]R\b", " ")), r"\s+"), lambda x: x != "")


def registry_persons(registry: DataFrame, persons: DataFrame, overrides: DataFrame | None = None) -> DataFrame:
    """(name, person): the persons that each registry name can mean.

    All words of the name are words of the person's, single letters begin one of them, and a name with "Jr." needs a
    person with it. Names with more words come first, then those earlier in the list; a person that a name alone can
    mean isn't meant by later ones. ``overrides`` (name, person) stand for the rule and claim all their persons.

    ``registry`` is (ord, name), ``persons`` has person. Pairs meet on the name's longest word; claims are settled in
    rounds, in each of which every name is settled that no earlier open one shares a person with.
    """
    junior = lambda c: c.rlike(r"(?i)\bjr\b")
    names = registry.select("ord", "name", _words(F.col("name")).alias("words"), junior(F.col("name")).alias("jr"))
    rank = F.struct((-F.size("words")).alias("few"), "ord")
    longest = F.array_max(F.transform(F.filter("words", lambda x: F.length(x) > 1), lambda x: F.struct(F.length(x).alias("n"), x.alias("w"))))["w"]
    known = persons.select("person", F.array_distinct(F.concat(_words(F.col("person")), F.split(F.upper("person"), r"\s+"))).alias("own"), _words(F.col("person")).alias("first"), junior(F.col("person")).alias("is_jr")).distinct()
    met = names.withColumn("word", longest).join(known.withColumn("word", F.explode("own")), "word")
    fits = F.forall("words", lambda x: F.when(F.length(x) == 1, F.exists("first", lambda y: y.startswith(x))).otherwise(F.array_contains("own", x)))
    pairs = met.where(fits & (~F.col("jr") | F.col("is_jr"))).select(rank.alias("rank"), "name", "person", F.lit(False).alias("fixed"))
    if overrides is not None:
        fixed = overrides.join(persons.select("person").distinct(), "person").join(names, "name").select(rank.alias("rank"), "name", "person", F.lit(True).alias("fixed"))
        pairs = pairs.join(fixed.select("name"), "name", "left_anti").unionByName(fixed)
    open_, out = tabled(pairs.distinct()), None
    while not open_.isEmpty():
        first = open_.groupBy("person").agg(F.min("rank").alias("least"))
        ready = open_.join(first, "person").groupBy("name").agg(F.min(F.col("rank") == F.col("least")).alias("ready"), F.count("*").alias("n"), F.max("fixed").alias("all")).where("ready")
        done = tabled(open_.join(ready, "name").select("name", "person", ((F.col("n") == 1) | F.col("all")).alias("claims")))
        out = done.select("name", "person") if out is None else out.unionByName(done.select("name", "person"))
        rest = open_.join(done.select("name").distinct(), "name", "left_anti")
        claimed = done.where("claims").select("person", F.lit(True).alias("claimed")).distinct()
        open_ = tabled(rest.join(claimed, "person", "left").where("fixed OR claimed IS NULL").select("rank", "name", "person", "fixed"))
    return out if out is not None else pairs.select("name", "person")
