"""Records in running text: vote statements, fuzzy names, digit repair."""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliograph.functions import repair

def vote_category(verb: Column) -> Column:
    """Category of what is said about voters, by the first of ordered tests."""
    s = F.lower(verb)
    return (
        F.when((s.contains("separate") | s.contains("opinion")) & ~s.contains("joins"), F.when(s.contains("dissenting") & ~s.contains("concurring"), "dissenting").otherwise("other"))
        .when(s.contains("joins"), "other").when(s.contains("dissent"), "dissenting").when(s.contains("inhibit"), "no_part").when(s.rlike("no.*part"), "no_part")
        .when(s.contains("business"), "on_leave").when(s.contains("leave"), "on_leave").otherwise("concurring")
    )


#: What is said about voters, with misread forms; longer ones first.
SAID = (
    r"(?i)\b(?:(?:took|1ook|look)\s+no\s+part|no\s+part|on\s+official\s+business|on\s+(?:official\s+)?leave"
    r"|(?:see\s+)?separate\s+(?:concurring\s+(?:and\s+dissenting\s+)?)?(?:dissenting\s+)?opinion\w*|(?:see\s+)?separate\s+concurr\w+|(?:see\s+)?separate\s+dissent\w+"
    r"|joins?\s+(?:the\s+|an?\s+)?(?:opinion|concurr\w+|dissent\w+)\s+of|inhibit\w*|concur\w*|dissent\w*)"
)
#: Tokens that are no names.
NO_VOTERS = [
    "JJ", "CJ", "Jr", "Jr.", "Sr", "Sr.", "III", "II", "IV", "Acting", "Chairman", "Chief", "Justice", "Associate", "Ponente", "ponente", "PONENTE", "OPINION", "Opinion", "CONCURRING",
    "DISSENTING", "SEPARATE", "Acting C.J", "Acting CJ", "S.A.J", "S.A", "Senior Associate Justice", "Chairperson", "JJ/", "J//", "JA/", "C./", "C.F", "Wife", "However", "Please sce",
]


def voters(clause: Column) -> Column:
    """Names in a clause, in order: titles and remarks in brackets go, initials and suffixes stay with their names."""
    t = F.regexp_replace(clause, r"(?i),?\s*\b(?:JJ|C\.?\s*/?\s*J|J/J|J)\s*[.,](?!\s*[A-Z]\.)(?!\s+Lopez)", ",")
    t = F.regexp_replace(F.regexp_replace(t, r"\s*\([^)}]*[)}]\s*", " "), r"(?i)\b(?:please\s+see|maintain|reserve|reiterate|following\s|in\s+the\s+result).*$", "")
    t = F.regexp_replace(t, r"\s*,?\s*\b([JS]r)\s*[.,]\s*", " $1, ")
    parts = F.transform(F.split(t, r"\s*[,;][\s.\-]*(?:and\s+)?|\s+and\s+|\s*&\s*|\.\s+(?=[A-Z][a-z])(?<![A-Z]\.\s)"), lambda p: F.regexp_replace(p, r"^[\s.,;:\-*'\"]+|[\s.,;:\-*'\"]+$", ""))
    parts = F.transform(parts, lambda p: F.regexp_replace(F.regexp_replace(p, r"^(?:and|but)\s+", ""), r"\s+([JS]r)$", ", $1."))
    return F.filter(parts, lambda p: (F.length(p) >= 2) & ~p.isin(*NO_VOTERS))


def clauses_in(statements: DataFrame, key: str, raw: str) -> DataFrame:
    """(key, i, part, category, tokens): what stands before each verb (part 0), and behind "joins ... of" (part 1)."""
    t = repair.concur(F.coalesce(F.col(raw), F.lit("")))
    verbs, clauses = F.regexp_extract_all(t, F.lit(f"({SAID})"), F.lit(1)), F.split(t, SAID, -1)
    each = F.transform(verbs, lambda v, i: F.struct(vote_category(v).alias("category"), i.alias("i"), voters(F.get(clauses, i)).alias("before"), F.when(F.lower(v).rlike(r"^joins?\s"), voters(F.get(clauses, i + 1))).alias("after")))
    said = statements.select(key, F.inline(each))
    return said.select(key, "i", "category", F.posexplode(F.array("before", "after")).alias("part", "tokens")).where("tokens IS NOT NULL")


def votes_in(statements: DataFrame, key: str, raw: str) -> DataFrame:
    """(key, category, pos, name): the names before each verb get its category, those after "joins ... of" 'other', too.

    A name that a category has twice stays once, where it stands first.
    """
    said = clauses_in(statements, key, raw)
    placed = said.select(key, "category", "i", "part", F.posexplode("tokens").alias("j", "name")).groupBy(key, "category", "name").agg(F.min(F.struct("i", "part", "j")).alias("at"))
    return placed.select(key, "category", (F.col("at.i") * 1000 + F.col("at.part") * 500 + F.col("at.j")).alias("pos"), "name")


#: How one says that somebody joins another's dissent.
JOINS = r"(?i)(?:joins?|1 join|concurs? (?:in|with)|agrees? with)\s+(?:the\s+)?(?:dissent(?:ing)?|concurring and dissenting|separate)\s*(?:opinion\s*)?of\s+(?:(?:Mme\.\s*)?(?:Justice|J\.?)\s+)?"
POSSESSIVE = r"(?i)(?:(?:Justice|J\.?)\s+)?([A-Z][\w\-]+(?:,?\s*(?:Jr|Sr)\.?)?)['’]s?\s+(?:dissent|concurring and dissenting|separate)"
TARGET = r"^([A-Z][\w\-]+(?:,?\s*(?:Jr|Sr)\.?)?)"


def joined_dissents(statements: DataFrame, key: str, raw: str) -> DataFrame:
    """(key, joiner, target): who joins whose dissent, by "joins the dissent of X" and "X's dissent"; different pairs."""
    s = F.explode(F.split(F.coalesce(F.col(raw), F.lit("")), r"(?<=[.;])\s+(?=[A-Z])"))
    parts = statements.select(key, s.alias("s"))
    said = parts.select(key, F.get(F.split("s", JOINS), 0).alias("before"), F.regexp_extract(F.get(F.split("s", JOINS), 1), TARGET, 1).alias("target")).where(F.col("s").rlike(JOINS))
    owned = parts.where(F.col("s").rlike(POSSESSIVE)).select(key, F.get(F.split("s", POSSESSIVE), 0).alias("before"), F.regexp_extract("s", POSSESSIVE, 1).alias("target"))
    owned = owned.withColumn("before", F.regexp_replace("before", r"(?i)\b(?:joins?|concurs?|agrees?)\b.*$", ""))
    both = said.union(owned).select(key, F.explode(voters(F.col("before"))).alias("joiner"), F.regexp_replace("target", r"[.,]+$", "").alias("target"))
    return both.where("target <> '' AND joiner <> target").distinct()


def best_match(tokens: DataFrame, registry: DataFrame, token: str = "token", name: str = "name", least: float = 0.75, order: str | None = None) -> DataFrame:
    """(token, name, score): the most similar registered name of each distinct token, or none below ``least``.

    Of names that are equally similar the first by the column ``order`` counts, else the first in the alphabet.
    Exact names go by a join. The others are compared with names that share two neighbouring letters only: texts of
    more than eight letters together that reach 0.75 do (else at least a letter stands between any two that match);
    shorter ones meet by single letters. Lengths and letters in common bound the ratio before it is computed.
    """
    distinct = tokens.select(F.upper(F.trim(token)).alias("up"), F.col(token)).distinct()
    key = F.upper(F.trim(name))
    names = registry.select(F.col(name), key.alias("key"), (F.col(order) if order else key).alias("tie")).dropDuplicates(["key"])
    exact = distinct.join(names, F.col("up") == F.col("key")).select(token, name, F.lit(1.0).alias("score"))
    rest = distinct.join(names, F.col("up") == F.col("key"), "left_anti").select("up").distinct()

    def grams(df: DataFrame, c: str) -> DataFrame:
        n = F.length(c)
        pairs = F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.substring(F.col(c), i, F.lit(2)))
        return df.select(c, F.explode(F.array_distinct(F.concat(pairs, F.when(n <= 7, F.filter(F.split(c, ""), lambda x: x != "")).otherwise(F.array().cast("array<string>"))))).alias("gram"))

    a, b = F.length("up"), F.length("key")
    letters = F.array_distinct(F.filter(F.split("up", ""), lambda x: x != ""))
    shared = F.aggregate(letters, F.lit(0), lambda t, x: t + F.least(F.length("up") - F.length(F.replace(F.col("up"), x, F.lit(""))), F.length("key") - F.length(F.replace(F.col("key"), x, F.lit("")))))
    pairs = grams(rest, "up").join(grams(names.select("key"), "key"), "gram").where((2 * F.least(a, b)) >= least * (a + b)).select("up", "key").distinct().where(2 * shared >= least * (a + b))

    @F.pandas_udf("double")
    def ratio(up: pd.Series, key: pd.Series) -> pd.Series:
        return pd.Series([SequenceMatcher(None, k, u).ratio() for u, k in zip(up, key)], dtype=float)

    top = pairs.withColumn("score", ratio("up", "key")).where(F.col("score") >= least).join(names.select("key", "tie"), "key").groupBy("up").agg(F.min_by(F.struct("key", "score"), F.struct(-F.col("score"), "tie")).alias("m"))
    found = distinct.join(top, "up").select(token, F.col("m.key").alias("key"), F.col("m.score").alias("score"))
    return exact.union(found.join(names, "key").select(token, name, "score"))


#: Digits that scanning takes for each other, likelier ones first.
CONFUSED = {"0": "689", "1": "74", "3": "85", "4": "1", "5": "368", "6": "058", "7": "1", "8": "360", "9": "03"}


def repaired_dates(rows: DataFrame, date: str, centre: str, days: int = 730) -> Column:
    """Of all dates that one confused digit makes of an ISO date the nearest to ``centre`` within ``days``, else null."""
    text = F.date_format(date, "yyyy-MM-dd")
    swaps = F.create_map(*[F.lit(x) for k, v in CONFUSED.items() for x in (k, v)])
    place = F.array(*map(F.lit, (1, 2, 3, 4, 6, 7, 9, 10)))
    made = F.flatten(F.transform(place, lambda i: F.transform(F.split(F.coalesce(F.try_element_at(swaps, F.substring(text, i, F.lit(1))), F.lit("")), ""), lambda d: F.concat(F.substring(text, F.lit(1), i - 1), d, F.substring(text, i + 1, F.lit(10))))))
    near = F.filter(F.transform(made, lambda s: F.struct(F.abs(F.datediff(s.try_cast("date"), F.col(centre))).alias("gap"), s.try_cast("date").alias("d"))), lambda x: x["gap"] <= days)
    return F.array_min(near)["d"]


def greedy_spans(truth: DataFrame, guess: DataFrame, keys: list[str], least: float = 0.8) -> DataFrame:
    """One-to-one matches of spans within a key: truth in order of start takes the best free guess of enough overlap.

    Greedy choice is sequential, so the spans of a key (a case and label, a handful) travel as two sorted lists.
    """

    def match(t: list[dict], g: list[dict]) -> Iterator[tuple]:
        free = list(g)
        for a in t:
            best, top = None, 0.0
            for b in free:
                inter = max(0, min(a["e"], b["e"]) - max(a["s"], b["s"]))
                union = a["e"] - a["s"] + b["e"] - b["s"] - inter
                if inter and inter / union > top:
                    best, top = b, inter / union
            if best is not None and top >= least:
                free.remove(best)
                yield a["s"], a["e"], best["s"], best["e"], top

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [(*key, *m) for *key, t, g in batch.itertuples(index=False) for m in match(t, g)]
            yield pd.DataFrame(out, columns=[*keys, "s", "e", "s2", "e2", "iou"])

    listed = lambda df, to: df.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(F.col("s").cast("long").alias("s"), F.col("e").cast("long").alias("e")))).alias(to))
    kinds = ", ".join(f"{k} {truth.schema[k].dataType.simpleString()}" for k in keys)
    return listed(truth, "_t").join(listed(guess, "_g"), keys).select(*keys, "_t", "_g").mapInPandas(run, f"{kinds}, s long, e long, s2 long, e2 long, iou double")
