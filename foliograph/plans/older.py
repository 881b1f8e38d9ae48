"""Queries over case texts that are read by the older family of patterns."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliograph.operators import first_regex, span_changes, span_scores
from foliograph.operators.steps import dealt
from foliograph.plans.base import PRELUDE, cases, n_votes, table
from foliograph.plans.registry import query

TEXTS = PRELUDE + """, x AS (SELECT case_id, strftime(d, '%B %-d, %Y') AS day, 'Customer ' || party || ', petitioner, vs. STATE, respondent.' AS who, case_id % 3 = 1 AS short, case_id % 5 = 0 AS split FROM cases),
t AS (SELECT *, 'EN BANC DIVISION' || chr(10) || '[G.R. No. ' || case_id || '. ' || day || ']' || chr(10) || who || chr(10) || CASE WHEN short THEN 'RESOLUTION' ELSE 'SYLLABUS' || chr(10) || 'Of things ' || (case_id % 17) || '.' || chr(10) || 'DECISION' END
      || chr(10) || 'CRUZ, J.:' || chr(10) || 'The reasons.' || chr(10) || 'SO ORDERED.' || CASE WHEN split THEN chr(10) || 'DISSENTING OPINION' || chr(10) || 'YAP, C.J.:' || chr(10) || 'No.' ELSE '' END AS text FROM x)
"""


def case_texts(spark, sf_dir):
    """(case_id, text): a short text for each case; every third has no syllabus, every fifth a separate opinion."""
    number, one = F.col("case_id").cast("string"), lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    middle = F.when(F.col("case_id") % 3 == 1, "RESOLUTION").otherwise(one("SYLLABUS\nOf things ", (F.col("case_id") % 17).cast("string"), ".\nDECISION"))
    opinion = F.when(F.col("case_id") % 5 == 0, "\nDISSENTING OPINION\nYAP, C.J.:\nNo.").otherwise("")
    text = one("EN BANC DIVISION\n[G.R. No. ", number, ". ", F.date_format("date", "MMMM d, yyyy"), "]\nCustomer ", F.col("party").cast("string"), ", petitioner, vs. STATE, respondent.\n", middle, "\nCRUZ, J.:\nThe reasons.\nSO ORDERED.", opinion)
    return cases(spark, sf_dir).select("case_id", text.alias("text"))


@query(
    "str21_first_matches",
    TEXTS + """SELECT case_id, 'case_number' AS label, 'G.R. No. ' || case_id AS text, strpos(text, 'G.R.') - 1 AS start_char, strpos(text, 'G.R.') - 1 + 9 + length(CAST(case_id AS VARCHAR)) AS end_char FROM t
    UNION ALL SELECT case_id, 'date', day, strpos(text, day) - 1, strpos(text, day) - 1 + length(day) FROM t UNION ALL SELECT case_id, 'division', 'EN BANC DIVISION', 0, 16 FROM t
    UNION ALL SELECT case_id, 'doc_type', CASE WHEN short THEN 'RESOLUTION' ELSE 'DECISION' END, 0, 0 FROM t""",
)
def str21(spark, sf_dir):
    return first_regex.fields(case_texts(spark, sf_dir), "case_id").select("case_id", "label", "text", "start_char", "end_char")


@query(
    "str22_subfields",
    TEXTS + """SELECT case_id, who AS parties_raw, NOT short AS has_syllabus, NOT short AS has_decision, short AS has_resolution, true AS has_so_ordered, CASE WHEN short THEN '' ELSE 'Of things ' || (case_id % 17) || '.' END AS syllabus_raw,
    CASE WHEN short THEN 'RESOLUTION' ELSE 'DECISION' END AS doc_type, 'CRUZ' AS ponente_name, 'J.' AS ponente_title, CASE WHEN split THEN 'DISSENTING OPINION: YAP' ELSE '' END AS opinions FROM t""",
)
def str22(spark, sf_dir):
    found = first_regex.subfields(case_texts(spark, sf_dir), "case_id")
    listed = F.array_join(F.transform("opinions", lambda x: F.concat(x["type"], F.lit(": "), x["author"])), "; ")
    return found.select("case_id", "parties_raw", "has_syllabus", "has_decision", "has_resolution", "has_so_ordered", "syllabus_raw", "doc_type", "ponente_name", "ponente_title", listed.alias("opinions"))


SPANS = """WITH r AS (SELECT l_orderkey AS case_id, l_linenumber AS ln, min(l_partkey) % 45 AS d, min(l_returnflag) AS flag FROM lineitem GROUP BY 1, 2),
x AS (SELECT *, unnest(['start_of_case', 'date', 'parties']) AS label FROM r), m AS (SELECT *, flag <> 'R' AS guessed, flag <> 'R' AND (label = 'start_of_case' OR d <= 5) AS hit FROM x)
SELECT label, count(*) FILTER (hit) AS tp, count(*) FILTER (guessed AND NOT hit) AS fp, count(*) FILTER (NOT hit) AS fn, round(count(*) FILTER (hit) / count(*) FILTER (guessed), 4) AS precision,
round(count(*) FILTER (hit) / count(*), 4) AS recall, round(2 * count(*) FILTER (hit) / (count(*) + count(*) FILTER (guessed)), 4) AS f1 FROM m GROUP BY 1"""


@query("fsm10_label_scores", SPANS)
def fsm10_labels(spark, sf_dir):
    """Spans of lines against ones that are moved, for a place, a text and a grouped label whose even groups are misnumbered."""
    lines = dealt(table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("case_id"), F.col("l_linenumber").alias("ord"), "l_partkey", "l_returnflag"), n_votes(spark, sf_dir), "case_id")
    rows = lines.groupBy("case_id", "ord").agg((F.min("l_partkey") % 45).alias("d"), F.min("l_returnflag").alias("flag"))
    rows = rows.withColumns({"label": F.explode(F.array(*map(F.lit, ("start_of_case", "date", "parties")))), "s": F.col("ord").cast("long") * 100})
    truth = rows.select("case_id", "label", "ord", F.col("ord").alias("grp"), "s", (F.col("s") + 50).alias("e"))
    group = F.when(F.col("ord") % 2 == 0, F.col("ord") + 1).otherwise(F.col("ord"))
    guess = rows.where("flag <> 'R'").select("case_id", "label", "ord", group.alias("grp"), (F.col("s") + F.col("d")).alias("s"), (F.col("s") + F.col("d") + 50).alias("e"))
    return span_scores.label_scores(span_scores.matches(truth, guess, ["case_id"]), ["label"])


@query(
    "set6_five_way_diff",
    """WITH r AS (SELECT l_orderkey AS case_id, l_linenumber AS ln, min(l_partkey) % 300 AS d, min(l_returnflag) AS flag FROM lineitem GROUP BY 1, 2),
    k AS (SELECT unnest(CASE WHEN flag = 'A' THEN ['removed'] WHEN flag = 'N' OR d = 0 THEN ['exact'] WHEN d <= 200 THEN ['span_adjusted'] ELSE ['removed', 'added'] END) AS kind FROM r) SELECT kind, count(*) AS n FROM k GROUP BY 1""",
)
def set6_five(spark, sf_dir):
    """Spans of lines that stay, go, or move by up to 299 characters."""
    lines = dealt(table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("case_id"), F.col("l_linenumber").alias("label"), "l_partkey", "l_returnflag"), n_votes(spark, sf_dir), "case_id")
    rows = lines.groupBy("case_id", "label").agg((F.min("l_partkey") % 300).alias("d"), F.min("l_returnflag").alias("flag"))
    place = lambda s: [s.alias("s"), (s + 50).alias("e")]
    start = F.col("label").cast("long") * 1000
    before = rows.select("case_id", "label", *place(start))
    after = rows.where("flag <> 'A'").select("case_id", "label", *place(start + F.when(F.col("flag") == "R", F.col("d")).otherwise(0)))
    return span_changes.five_way(before, after).groupBy("kind").agg(F.count("*").alias("n"))
