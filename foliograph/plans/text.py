"""Queries over the line model and text repair."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliograph.functions import repair
from foliograph.operators import lines as model
from foliograph.plans.base import PRELUDE, cases, table
from foliograph.plans.registry import query

LINES = """WITH cut AS (SELECT doc_id, string_split(regexp_replace(replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10)), '\\n$', ''), chr(10)) AS ls FROM documents),
l0 AS (SELECT doc_id, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS line_no FROM cut),
lines AS (SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, line, CAST(coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start_char FROM l0)
"""
TITLE, FIXED = "upper(line) = line AND length(line) < 400", "line LIKE '%License%' OR line LIKE '%|%'"


def doc_lines(spark, sf_dir):
    return model.lines(table(spark, sf_dir, "documents"), "doc_id")


@query("src9_off1_line_model", LINES + "SELECT doc_id, line_no, start_char, length(line) AS n_chars, md5(line) AS line_md5 FROM lines")
def src9(spark, sf_dir):
    return doc_lines(spark, sf_dir).select("doc_id", "line_no", "start_char", F.length("line").cast("long").alias("n_chars"), F.md5("line").alias("line_md5"))


@query(
    "src10_indexed_lines",
    """WITH t AS (SELECT doc_id, replace(replace(replace(coalesce(text, ''), '. ', chr(10) || '--- Page ' || (doc_id % 90 + 1) || ' ---' || chr(13) || chr(10)), chr(13) || chr(10), chr(10)), chr(13), chr(10)) || chr(10) AS x FROM documents),
    l AS (SELECT doc_id, unnest(string_split(x, chr(10))) AS line, unnest(range(0, len(string_split(x, chr(10))))) AS line_no FROM t),
    m AS (SELECT *, CASE WHEN regexp_matches(line, '^--- Page [0-9]+ ---$') THEN CAST(regexp_extract(line, '[0-9]+') AS INTEGER) END AS marker FROM l)
    SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, md5(line) AS line_md5, coalesce(last_value(marker IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS page FROM m""",
)
def src10(spark, sf_dir):
    """Documents with a page marker after each sentence: lines from 0 with their page, the last empty one included."""
    marked = F.concat(F.replace(F.coalesce("text", F.lit("")), F.lit(". "), F.concat(F.lit("\n--- Page "), (F.col("doc_id") % 90 + 1).cast("string"), F.lit(" ---\r\n"))), F.lit("\n"))
    rows = model.indexed_lines(table(spark, sf_dir, "documents").select("doc_id", marked.alias("text")), "doc_id")
    return rows.select("doc_id", "line_no", F.md5("line").alias("line_md5"), "page")


POINTS = "SELECT doc_id, CAST(o AS BIGINT) AS char FROM documents, (VALUES (0), (57), (400), (1000000)) t(o)"


@query("off2_char_to_line", LINES + f", p AS ({POINTS}) SELECT p.doc_id, char, max(line_no) AS line_no FROM p JOIN lines ON lines.doc_id = p.doc_id AND start_char <= char GROUP BY ALL")
def off2(spark, sf_dir):
    points = table(spark, sf_dir, "documents").select("doc_id", F.explode(F.array(*[F.lit(o).cast("long") for o in (0, 57, 400, 1000000)])).alias("char"))
    return model.line_of(points, doc_lines(spark, sf_dir), "doc_id")


@query(
    "off4_page_of_line",
    LINES + """, m AS (SELECT *, CASE WHEN line LIKE '%License%' THEN line_no END AS marker FROM lines)
    SELECT doc_id, line_no, coalesce(last_value(marker IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS page FROM m""",
)
def off4(spark, sf_dir):
    """A line that names a licence stands for a page marker; its number is the page's."""
    rows = model.with_page(doc_lines(spark, sf_dir), "doc_id", F.when(F.col("line").contains("License"), F.col("line_no")))
    return rows.select("doc_id", "line_no", "page")


@query(
    "flt1_flt3_noise_mask",
    LINES + f""", k AS (SELECT *, trim(line) = '' AS blank, trim(line) <> '' AND ({FIXED}) AS fixed FROM lines),
    t AS (SELECT *, NOT blank AND NOT fixed AND ({TITLE}) AS title FROM k),
    i AS (SELECT *, sum(CASE WHEN NOT blank AND NOT title THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY line_no) AS island FROM t),
    s AS (SELECT *, fixed OR (title AND coalesce(bool_or(CASE WHEN NOT title AND NOT blank THEN fixed END) OVER (PARTITION BY doc_id, island), false)) AS second FROM i),
    n AS (SELECT *, CASE WHEN NOT blank THEN second END AS mark FROM s)
    SELECT doc_id, line_no, second OR (blank AND coalesce(last_value(mark IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
      AND first_value(mark IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), false)) AS is_noise FROM n""",
)
def flt1(spark, sf_dir):
    rows = model.noise_mask(doc_lines(spark, sf_dir), "doc_id", F.expr(FIXED), F.expr(TITLE))
    return rows.select("doc_id", "line_no", "is_noise")


@query(
    "flt13_near_misses",
    LINES + """, h AS (SELECT doc_id, line_no, left(line, 120) AS excerpt, CASE WHEN line LIKE '%[%' OR line LIKE '%{%' THEN 'bracket' WHEN line LIKE '%=%' THEN 'assignment' WHEN line LIKE '%@%' THEN 'address' END AS kind
      FROM lines WHERE length(line) <= 200)
    SELECT doc_id, line_no, excerpt, kind FROM h WHERE kind IS NOT NULL""",
)
def flt13(spark, sf_dir):
    """Lines of up to 200 characters by the first pattern that they match."""
    line = F.col("line")
    kind = F.when(line.contains("[") | line.contains("{"), "bracket").when(line.contains("="), "assignment").when(line.contains("@"), "address")
    return doc_lines(spark, sf_dir).where(F.length("line") <= 200).select("doc_id", "line_no", F.left("line", F.lit(120)).alias("excerpt"), kind.alias("kind")).where("kind IS NOT NULL")


@query(
    "src1_src2_page_links",
    """WITH a AS (SELECT page_id, url, unnest(regexp_extract_all(html, '<a[^>]*href="([^"]*)"', 1)) AS href FROM pages)
    SELECT page_id, href, CASE WHEN href LIKE '/%' THEN regexp_extract(url, '^(https?://[^/]+)', 1) || href WHEN href NOT LIKE 'http%' THEN regexp_extract(url, '^(https?://[^/]+)', 1) || '/' || href ELSE href END AS link, count(*) AS n
    FROM a GROUP BY ALL""",
)
def src1(spark, sf_dir):
    base = F.regexp_extract("url", "^(https?://[^/]+)", 1)
    href = F.col("href")
    link = F.when(href.startswith("/"), F.concat(base, href)).when(~href.startswith("http"), F.concat(base, F.lit("/"), href)).otherwise(href)
    found = table(spark, sf_dir, "pages").select("page_id", "url", F.explode(F.regexp_extract_all("html", F.lit('<a[^>]*href="([^"]*)"'), F.lit(1))).alias("href"))
    return found.groupBy("page_id", "href", link.alias("link")).agg(F.count("*").alias("n"))


DIVISIONS = ["FIRST DIVISLON", "SECOND DIVISIION", "EN BANC", "THIRD DIVISON"]
RENDERED = "concat('Case No. ', case_id, '. ', date_format(date, 'MMMM d'), '. ', year(date))"


@query(
    "str5_dt1_date_round_trip",
    PRELUDE + "SELECT case_id, d AS parsed, least(day(d), CASE WHEN month(d) = 2 THEN 28 ELSE 31 END) AS clamped_day FROM cases",
)
def str5(spark, sf_dir):
    """Dates rendered with a misread full stop, repaired and parsed back; the oracle is the source column."""
    text = F.regexp_extract(repair.date_text(F.expr(RENDERED)), r"([A-Z][a-z]+ \d{1,2}, \d{4})$", 1)
    return cases(spark, sf_dir).select("case_id", repair.flexible_date(text).alias("parsed"), F.dayofmonth(repair.clamped_date(text)).cast("long").alias("clamped_day"))


@query(
    "str6_division_repair",
    PRELUDE + "SELECT CASE case_id % 4 WHEN 0 THEN 'FIRST DIVISION' WHEN 1 THEN 'SECOND DIVISION' WHEN 2 THEN 'EN BANC' ELSE 'THIRD DIVISION' END AS fixed, count(*) AS n FROM cases GROUP BY 1",
)
def str6(spark, sf_dir):
    misread = F.element_at(F.array(*map(F.lit, DIVISIONS)), (F.col("case_id") % 4 + 1).cast("int"))
    return cases(spark, sf_dir).groupBy(repair.division(misread).alias("fixed")).agg(F.count("*").alias("n"))
