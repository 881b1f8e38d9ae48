"""Queries over rendered volumes whose boundaries, votes and parties are known, and over spans and excerpts.

A customer stands for a volume, an order for a block of lines in it; which lines a block has follows from its number.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from foliograph.functions import brackets
from foliograph.operators import boundaries
from foliograph.operators.records_text import best_match
from foliograph.plans.base import table
from foliograph.plans.registry import query
from foliograph.plans.text import LINES, doc_lines

SURNAMES = ["Cruz", "Reyes", "Puno"]
BLOCKS = "WITH b AS (SELECT o_custkey AS vol, o_orderkey AS o, row_number() OVER w - 1 AS i, lead(o_orderkey) OVER w AS nxt, lag(o_orderkey) OVER w AS prv, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey))"


def blocks(spark, sf_dir):
    w = Window.partitionBy("o_custkey").orderBy("o_orderkey")  # a customer's orders
    return table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("vol"), F.col("o_orderkey").alias("o"), (F.row_number().over(w) - 1).alias("i"))


def rendered(rows, texts):
    """The lines of blocks, numbered through a volume."""
    each = rows.select("vol", "i", F.posexplode(F.array(*[t if not isinstance(t, str) else F.lit(t) for t in texts])).alias("j", "line"))
    return each.select("vol", (F.col("i") * len(texts) + F.col("j") + 1).alias("line_no"), "line", F.lit(False).alias("is_noise"))


def by(mod, texts, other=""):
    """The text of a block by its number modulo ``mod``."""
    out = F.lit(other)
    for k, t in texts.items():
        out = F.when(F.col("o") % mod == k, t).otherwise(out)
    return out


@query(
    "fsm3_str11_stranded_brackets",
    BLOCKS + """, c AS (SELECT vol, o, CAST(20 * i + 1 AS BIGINT) AS start_line, CAST(20 * i + 20 AS BIGINT) AS own_end, o % 4 AS k, 20 * n AS total FROM b WHERE o % 4 <> 2),
    t AS (SELECT *, bool_or(k IN (1, 3)) OVER (PARTITION BY vol) AS any_new, lead(start_line) OVER (PARTITION BY vol ORDER BY start_line) AS nxt FROM c)
    SELECT vol, start_line, CASE WHEN any_new THEN coalesce(nxt - 1, total) ELSE own_end END AS end_line, CASE WHEN k <> 0 THEN start_line + 2 END AS bracket_line, CASE WHEN k <> 0 THEN 'G.R. No. ' || o END AS number FROM t""",
)
def fsm3(spark, sf_dir):
    """Blocks 0 of 4 are known, 1 stranded, 2 stranded behind a long line, 3 stranded with a second bracket."""
    rows = blocks(spark, sf_dir)
    bracket = F.concat(F.lit("[G.R. No. "), F.col("o"), F.lit(". May 3, 1999]"))
    texts = ["SECOND DIVISION", by(4, {2: "x" * 90}), bracket, *["text"] * 5, by(4, {3: bracket}, "text"), *["text"] * 11]
    lines = rendered(rows, texts)
    known = rows.where("o % 4 = 0").select("vol", (F.col("i") * 20 + 1).alias("start_line"), (F.col("i") * 20 + 20).alias("end_line"))
    found = boundaries.stranded_brackets(lines, known, "vol")
    text = lines.select("vol", F.col("line_no").alias("bracket_line"), "line").hint("merge")
    number = brackets.bracket_number(F.col("line"), F.lit("May 3, 1999"))
    return found.join(text, ["vol", "bracket_line"], "left").select("vol", "start_line", "end_line", "bracket_line", number.alias("number"))


@query(
    "str12_bracket_dates",
    """WITH l AS (SELECT o_orderkey AS o, CASE WHEN o_orderkey % 3 = 2 THEN '[G.R. No. ' || o_orderkey || ', with no date at all' || ']' ELSE '[G.R. No. ' || o_orderkey || '. May 3, 1999]' END AS line FROM orders)
    SELECT o, CASE WHEN o % 3 = 2 THEN 'G.R. No. ' || o || ', with no date at all' ELSE 'G.R. No. ' || o END AS number, CAST(CASE WHEN o % 3 = 2 THEN length(line) - 21 ELSE strpos(line, 'May') - 1 END AS INTEGER) AS col,
    CASE WHEN o % 3 = 2 THEN trim(substr(line, length(line) - 20, 20)) ELSE 'May 3, 1999' END AS date_text FROM l""",
)
def str12(spark, sf_dir):
    """Dates in brackets as they were read, under another reading, and where there is none."""
    o = F.col("o_orderkey")
    line = F.concat(F.lit("[G.R. No. "), o, F.when(o % 3 == 2, ", with no date at all").otherwise(". May 3, 1999"), F.lit("]"))
    asked = F.when(o % 3 == 0, "May 3, 1999").otherwise("Mav 3, 1999")
    rows = table(spark, sf_dir, "orders").select(o.alias("o"), brackets.bracket_number(line, asked).alias("number"), brackets.bracket_date(line, asked).alias("d"))
    return rows.select("o", "number", "d.col", F.col("d.text").alias("date_text"))


@query(
    "fsm5_votes_past_end",
    BLOCKS + """, a AS (SELECT *, CASE WHEN o % 3 = 0 THEN 0 WHEN nxt % 4 = 0 THEN 1 WHEN nxt % 4 = 1 AND nxt % 5 = 0 THEN 2 WHEN nxt % 4 = 1 THEN 1 ELSE 0 END AS added FROM b)
    SELECT vol, CAST(6 * i + 1 AS BIGINT) AS start_line, added, CAST(6 * i + 8 + added AS BIGINT) AS last_line FROM a WHERE added > 0""",
)
def fsm5(spark, sf_dir):
    """Votes cut in two by the header of the next case."""
    rows = blocks(spark, sf_dir)
    vote = by(3, {0: "Cruz, J., concur.", 1: "Cruz, Reyes,", 2: "Cruz, JJ., concur and"})
    texts = ["FIRST DIVISION", "[G.R. No. 5. May 3, 1999]", by(4, {0: "Reyes, JJ., concur.", 1: "Reyes, Puno,"}, "text"), by(5, {0: "Puno, JJ., concur."}, "text"), "text", vote]
    cases = rows.select("vol", (F.col("i") * 6 + 1).alias("start_line"), (F.col("i") * 6 + 6).alias("end_line"), vote.alias("last_vote"))
    found = boundaries.votes_past_end(rendered(rows, texts), cases, "vol", SURNAMES)
    return found.groupBy("vol", "start_line").agg(F.count("*").alias("added"), F.max("line_no").alias("last_line"))


@query(
    "fsm6_parties_before_header",
    BLOCKS + " SELECT vol, CAST(8 * i + 1 AS BIGINT) AS start_line, CAST(8 * i - 3 AS BIGINT) AS new_start, 'JUAN CRUZ, petitioner,' AS first_text FROM b WHERE prv % 4 IN (0, 1)",
)
def fsm6(spark, sf_dir):
    """Parties above the division line, with blanks and names of the case between."""
    rows = blocks(spark, sf_dir)
    party = "JUAN CRUZ, petitioner,"
    texts = ["EN BANC", "[G.R. No. 5. May 3, 1999]", "text", "SO ORDERED.", by(4, {0: party, 1: party, 3: "text"}), by(4, {0: "Cruz vs. Court", 3: "text"}), by(4, {3: "text"}), by(4, {2: party[:9]})]
    cases = rows.select("vol", (F.col("i") * 8 + 1).alias("start_line"))
    return boundaries.parties_before_header(rendered(rows, texts), cases, "vol", SURNAMES)


SPANS = "SELECT l_orderkey AS case_id, l_linenumber AS ord, min(l_returnflag) AS label, CASE WHEN l_linenumber % 2 = 0 THEN l_linenumber END AS grp, min(l_linestatus) AS text, {s} AS s, {s} + 20 AS e FROM lineitem"


@query(
    "fsm11_annotation_scores",
    f"""WITH a AS ({SPANS.format(s='min(l_partkey) % 60')} GROUP BY 1, 2), f AS ({SPANS.format(s='min(l_suppkey) % 60')} WHERE l_linenumber % 3 <> 0 GROUP BY 1, 2),
    p AS (SELECT a.case_id, a.ord, a.label, f.ord AS found_ord, CASE WHEN f.ord IS NULL THEN 3 WHEN a.s < f.e AND f.s < a.e AND a.text = f.text THEN 0 WHEN a.s < f.e AND f.s < a.e THEN 1 ELSE 2 END AS r
      FROM a LEFT JOIN f ON a.case_id = f.case_id AND a.label = f.label AND (a.grp IS NULL OR a.grp = f.grp)),
    q AS (SELECT *, row_number() OVER (PARTITION BY case_id, ord ORDER BY r, found_ord) AS rn FROM p)
    SELECT case_id, ord, label, found_ord, r = 0 AS exact, r <= 1 AS overlap, r < 3 AS detected FROM q WHERE rn = 1""",
)
def fsm11(spark, sf_dir):
    """Annotations held against extracted fields, one by one; the lines of an order that share a number are one."""
    kept = [F.min(c).alias(c) for c in ("l_returnflag", "l_linestatus", "l_partkey", "l_suppkey")]
    rows = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("case_id"), F.col("l_linenumber").alias("ord")).agg(*kept)
    spans = lambda c: rows.select("case_id", "ord", F.col("l_returnflag").alias("label"), F.when(F.col("ord") % 2 == 0, F.col("ord")).alias("grp"), F.col("l_linestatus").alias("text"), (F.col(c) % 60).alias("s"), (F.col(c) % 60 + 20).alias("e"))
    return boundaries.annotation_scores(spans("l_partkey"), spans("l_suppkey").where("ord % 3 <> 0"), "case_id")


@query(
    "jn8_str7_ponente",
    """SELECT n_name AS given, CASE WHEN length(n_name) >= 7 THEN n_name END AS ponente FROM (SELECT n_name, n_nationkey FROM nation) WHERE n_nationkey % 3 <> 0
    UNION ALL SELECT n_name, 'PER CURIAM' FROM nation WHERE n_nationkey % 3 = 0""",
)
def jn8(spark, sf_dir):
    """Misread names of judges put right by similarity of 0.85 or more; PER CURIAM in any spelling of its spaces and case."""
    names = table(spark, sf_dir, "nation").select(F.col("n_name").alias("name"), F.col("n_nationkey").alias("k"))
    read = names.select(F.col("name").alias("given"), F.when(F.col("k") % 3 == 0, " Per  curiam:").otherwise(F.concat(F.lit("@"), F.expr("substring(name, 2)"))).alias("token"))
    whole = F.upper("token").rlike(r"^\s*PER\s+CURIAM\W*$")
    found = best_match(read.where(~whole), names, least=0.85).select("token", "name")
    return read.join(found, "token", "left").select("given", F.when(whole, "PER CURIAM").otherwise(F.col("name")).alias("ponente"))


@query(
    "off7_spans_of_texts",
    LINES + """, a AS (SELECT doc_id, line_no, start_char, line, CASE WHEN line_no % 2 = 0 THEN substr(line, 5, 60) ELSE '@@' || substr(line, 1, 10) END AS t FROM lines WHERE length(line) > 8)
    SELECT doc_id, line_no, start_char + greatest(strpos(line, substr(t, 1, 40)) - 1, 0) AS s, start_char + greatest(strpos(line, substr(t, 1, 40)) - 1, 0) + length(t) AS e FROM a""",
)
def off7(spark, sf_dir):
    """Spans of texts found in their line by their first forty characters, else from the line's start."""
    text = F.expr("CASE WHEN line_no % 2 = 0 THEN substring(line, 5, 60) ELSE '@@' || substring(line, 1, 10) END")
    rows = doc_lines(spark, sf_dir).where(F.length("line") > 8).withColumn("t", text)
    start = F.col("start_char") + F.greatest(F.position(F.substring("t", 1, 40), F.col("line")) - 1, F.lit(0))
    return rows.select("doc_id", "line_no", start.alias("s"), (start + F.length("t")).alias("e"))


@query(
    "snk14_excerpts",
    LINES + """, a AS (SELECT doc_id, line_no FROM lines WHERE line_no % 7 = 1)
    SELECT a.doc_id, a.line_no, md5(string_agg(l.line, chr(10) ORDER BY l.line_no)) AS excerpt_md5, count(*) AS n FROM a JOIN lines l ON l.doc_id = a.doc_id AND l.line_no BETWEEN a.line_no - 5 AND a.line_no + 5 GROUP BY ALL""",
)
def snk14(spark, sf_dir):
    """Annotated lines with five lines before and after them."""
    w = Window.partitionBy("doc_id").orderBy("line_no").rowsBetween(-5, 5)
    rows = doc_lines(spark, sf_dir).withColumn("around", F.collect_list("line").over(w)).where("line_no % 7 = 1")
    return rows.select("doc_id", "line_no", F.md5(F.array_join("around", "\n")).alias("excerpt_md5"), F.size("around").cast("long").alias("n"))


@query("srt6_src17_first_volumes", "SELECT year(o_orderdate) * 100 + month(o_orderdate) AS volume, count(*) AS n FROM orders GROUP BY 1 ORDER BY 1 LIMIT 10")
def srt6(spark, sf_dir):
    """Decisions of the first ten volumes; the limit is the report's."""
    d = F.col("o_orderdate")
    return table(spark, sf_dir, "orders").groupBy((F.year(d) * 100 + F.month(d)).alias("volume")).agg(F.count("*").alias("n")).orderBy("volume").limit(10)
