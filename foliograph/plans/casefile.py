"""Queries over case rows: their fields, filters, look-ups, orders and counts.

A case stands in for a row of the wide case table: its number is the order key, its volume lies between 226 and 1000.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from foliograph.functions import fields, repair
from foliograph.operators.windows import bounds, windows
from foliograph.plans.base import PRELUDE, WINDOW, cases, table, votes
from foliograph.plans.registry import query
from foliograph.plans.text import LINES, doc_lines

#: Volumes spread over the whole range of eras.
SPREAD = PRELUDE + ", sp AS (SELECT cases.*, 200 + case_id % 800 AS vol FROM cases)"


def spread(spark, sf_dir):
    return cases(spark, sf_dir).withColumn("vol", 200 + F.col("case_id") % 800)


@query(
    "jn2_validation_era",
    SPREAD + """ SELECT CASE WHEN vol BETWEEN 121 AND 260 THEN 'ERA-1 (121-260)' WHEN vol <= 500 THEN 'ERA-2 (261-500)' WHEN vol <= 660 THEN 'ERA-3 (501-660)' WHEN vol <= 850 THEN 'ERA-4 (661-850)'
    WHEN vol <= 999 THEN 'ERA-5 (851-999)' ELSE 'Other (' || vol || ')' END AS era, count(*) AS n FROM sp GROUP BY 1""",
)
def jn2(spark, sf_dir):
    """The eras of the validation reports, which differ from those of the patterns."""
    return spread(spark, sf_dir).groupBy(fields.validation_era(F.col("vol")).alias("era")).agg(F.count("*").alias("n"))


@query(
    "jn3_era_fallback",
    SPREAD + """, e AS (SELECT DISTINCT vol, CASE WHEN vol BETWEEN 121 AND 260 THEN 1 WHEN vol BETWEEN 261 AND 500 THEN 2 WHEN vol BETWEEN 501 AND 700 THEN 3 WHEN vol BETWEEN 701 AND 900 THEN 4 WHEN vol BETWEEN 901 AND 999 THEN 5 ELSE 1 END AS m FROM sp)
    SELECT vol, string_agg('era' || i, ',' ORDER BY abs(i - m), i < m) AS eras FROM e, range(1, 6) t(i) GROUP BY 1""",
)
def jn3(spark, sf_dir):
    """The order in which eras' patterns are tried: its own, then right and left of it."""
    vols = spread(spark, sf_dir).select("vol").distinct()
    return vols.select("vol", F.array_join(fields.era_order(F.col("vol")), ",").alias("eras"))


@query(
    "dt3_dt4_year_from_volume",
    SPREAD + """, y AS (SELECT case_id, d, vol, CASE WHEN vol <= 500 THEN 1986 + (vol - 226) / 274.0 * 19 WHEN vol <= 700 THEN 2005 + (vol - 500) / 200.0 * 9 WHEN vol <= 961 THEN 2014 + (vol - 700) / 261.0 * 10 ELSE 2024 END AS yr FROM sp)
    SELECT case_id, make_date(CAST(trunc(yr) AS BIGINT), 6, 15) AS estimate, CASE WHEN abs(year(d) - trunc(yr)) > 5 THEN make_date(CAST(trunc(yr) AS BIGINT), 6, 15) ELSE d END AS sane FROM y""",
)
def dt3(spark, sf_dir):
    """Dates estimated from volumes, in place of those more than five years off."""
    estimate = fields.date_of_volume(F.col("vol"))
    sane = F.when(F.abs(F.year("date") - F.year(estimate)) > 5, estimate).otherwise(F.col("date"))
    return spread(spark, sf_dir).select("case_id", estimate.alias("estimate"), sane.alias("sane"))


PREFIXES = ["", "73978-80. ", "L-12 ", "[x] "]


@query("dt5_date_prefix", PRELUDE + "SELECT case_id, monthname(d) || ' ' || day(d) || ', ' || year(d) AS date_text, trim((['', '73978-80. ', 'L-12 ', '[x] '])[CAST(case_id % 4 + 1 AS INTEGER)]) AS prefix FROM cases")
def dt5(spark, sf_dir):
    """Whatever stands before the first month name or leading numeric date is cut off and kept."""
    prefix = F.element_at(F.array(*map(F.lit, PREFIXES)), (F.col("case_id") % 4 + 1).cast("int"))
    parts = fields.date_prefix(F.concat(prefix, F.date_format("date", "MMMM d, yyyy")))
    return cases(spark, sf_dir).select("case_id", parts["date"].alias("date_text"), parts["prefix"].alias("prefix"))


@query(
    "dt8_agg16_longest_term",
    "SELECT l_suppkey AS member, min_by(l_partkey % 7, (-(l_quantity * 365 + l_linenumber), l_orderkey, l_linenumber, l_partkey)) AS appointer, CAST(max(l_quantity * 365 + l_linenumber) AS BIGINT) AS days FROM lineitem GROUP BY 1",
)
def dt8(spark, sf_dir):
    """Lengths such as '18 years 302 days' in days; the appointer of the longest term, the first on ties."""
    text = F.concat(F.col("l_quantity").cast("int"), F.lit(" years "), F.col("l_linenumber"), F.lit(" days"))
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("member"), (F.col("l_partkey") % 7).alias("a"), fields.term_days(text).alias("days"), "l_orderkey", "l_linenumber", "l_partkey")
    return rows.groupBy("member").agg(F.min_by("a", F.struct((-F.col("days")).alias("d"), "l_orderkey", "l_linenumber", "l_partkey")).alias("appointer"), F.max("days").alias("days"))


@query("dt9_date_validity", PRELUDE + "SELECT CASE case_id % 3 WHEN 0 THEN 1.0 WHEN 1 THEN 0.5 ELSE 0.0 END AS score, count(*) AS n FROM cases GROUP BY 1")
def dt9(spark, sf_dir):
    """Whole dates, dates in brackets, and what is no date."""
    d = F.date_format("date", "MMMM d, yyyy")
    text = F.when(F.col("case_id") % 3 == 0, d).when(F.col("case_id") % 3 == 1, F.concat(F.lit("["), d, F.lit("]"))).otherwise(F.concat(F.lit("x"), d))
    return cases(spark, sf_dir).groupBy(fields.date_validity(text).alias("score")).agg(F.count("*").alias("n"))


@query("dt10_window_label", PRELUDE + "SELECT k, strftime(window_start, '%Y-%m') || ' to ' || strftime(window_end, '%Y-%m') AS label FROM win")
def dt10(spark, sf_dir):
    w = windows(bounds(cases(spark, sf_dir)), WINDOW)
    return w.select("k", F.concat(F.date_format("window_start", "yyyy-MM"), F.lit(" to "), F.date_format("window_end", "yyyy-MM")).alias("label"))


@query(
    "dt11_term_midpoint",
    PRELUDE + """, t AS (SELECT member, min(d) AS s, max(d) AS e FROM votes GROUP BY 1), c AS (SELECT member, s, greatest(s, DATE '1996-01-01') AS a, least(e, DATE '2000-01-01') AS b FROM t)
    SELECT member, CASE WHEN b < a THEN s ELSE a + CAST(datediff('day', a, b) // 2 AS INTEGER) END AS midpoint FROM c""",
)
def dt11(spark, sf_dir):
    """Terms clamped to a visible range and their middle; the start of those outside."""
    terms = votes(spark, sf_dir).groupBy("member").agg(F.min("date").alias("s"), F.max("date").alias("e"))
    return terms.select("member", fields.visible_midpoint(F.col("s"), F.col("e"), F.lit("1996-01-01").cast("date"), F.lit("2000-01-01").cast("date")).alias("midpoint"))


@query(
    "agg15_terms",
    PRELUDE + """, r AS (SELECT member, d AS s, CASE WHEN case_id % 5 = 0 AND member % 3 = 0 THEN NULL ELSE d + 30 END AS e FROM votes)
    SELECT member, min(s) AS first_day, max(e) AS last_known, CASE WHEN bool_or(e IS NULL) THEN NULL ELSE max(e) END AS last_day FROM r GROUP BY 1""",
)
def agg15(spark, sf_dir):
    """Both readings of an open end: left out of the maximum, or still in office."""
    end = F.when((F.col("case_id") % 5 == 0) & (F.col("member") % 3 == 0), F.lit(None)).otherwise(F.date_add("date", 30))
    rows = votes(spark, sf_dir).select("member", F.col("date").alias("s"), end.alias("e"))
    still = F.when(F.max(F.col("e").isNull()), F.lit(None)).otherwise(F.max("e"))
    return rows.groupBy("member").agg(F.min("s").alias("first_day"), F.max("e").alias("last_known"), still.alias("last_day"))


DIVISIONS = ["En Banc", "first divison", "SECON DIVISION", "3rd division", " special ", "Other"]


@query("str10_division_names", PRELUDE + "SELECT (['EN BANC', 'FIRST DIVISION', 'SECOND DIVISION', 'THIRD DIVISION', 'SPECIAL DIVISION', 'OTHER'])[CAST(case_id % 6 + 1 AS INTEGER)] AS division, count(*) AS n FROM cases GROUP BY 1")
def str10(spark, sf_dir):
    raw = F.element_at(F.array(*map(F.lit, DIVISIONS)), (F.col("case_id") % 6 + 1).cast("int"))
    return cases(spark, sf_dir).groupBy(fields.division_name(raw).alias("division")).agg(F.count("*").alias("n"))


@query("str13_set5_name_lists", PRELUDE + "SELECT case_id, count(*) AS n_names, md5(string_agg('M' || member, '|' ORDER BY role DESC, member)) AS digest FROM votes GROUP BY 1")
def str13(spark, sf_dir):
    """Lists joined by semicolons with names that are none, split, cleaned and put one after the other as a bag."""
    name = F.concat(F.lit("M"), F.col("member"))
    said = votes(spark, sf_dir).groupBy("case_id").agg(*[F.concat(F.lit(" Per curiam;; "), F.array_join(F.transform(F.sort_array(F.collect_list(F.when(F.col("role") == r, F.struct("member", name.alias("s"))))), lambda x: x["s"]), "; ")).alias(r) for r in ("majority", "dissent")])
    both = F.concat(fields.names_in(F.col("majority")), fields.names_in(F.col("dissent")))
    return said.select("case_id", F.size(both).cast("long").alias("n_names"), F.md5(F.array_join(both, "|")).alias("digest"))


@query("str16_jn18_case_number_lookup", PRELUDE + "SELECT case_id, CASE WHEN case_id % 5 = 0 THEN 'not found' ELSE 'ok' END AS outcome FROM cases")
def str16(spark, sf_dir):
    """Asked case numbers, spelled otherwise, against known ones in lower case with single spaces; the last repeated one counts."""
    c = cases(spark, sf_dir).select("case_id")
    known = c.where("case_id % 5 <> 0").select(fields.case_number_key(F.concat(F.lit("G.R. No. "), "case_id")).alias("key"), F.col("case_id").alias("found"))
    known = known.groupBy("key").agg(F.max("found").alias("found"))
    asked = c.select("case_id", fields.case_number_key(F.concat(F.lit("  g.r.   NO. "), "case_id", F.lit(" "))).alias("key"))
    return asked.join(known, "key", "left").select("case_id", F.when(F.col("found").isNull(), "not found").otherwise("ok").alias("outcome"))


GIVEN = ["Andres Reyes Jr.", "J. B. L. Reyes", "Roberto A. Abad", "Jose Abad Santos", "Vicente Abad Santos", "Priscilla Baltazar-Padilla", "Juan Cruz III"]
SURNAMES = ["Reyes, Jr.", "Reyes", "Abad", "Abad Santos", "Abad Santos", "Baltazar-Padilla", "Cruz, Iii."]


@query("prj6_display_name", PRELUDE + f"SELECT ({SURNAMES})[CAST(case_id % 7 + 1 AS INTEGER)] AS display, count(*) AS n FROM cases GROUP BY 1")
def prj6(spark, sf_dir):
    name = F.element_at(F.array(*map(F.lit, GIVEN)), (F.col("case_id") % 7 + 1).cast("int"))
    return cases(spark, sf_dir).groupBy(fields.display_name(name).alias("display")).agg(F.count("*").alias("n"))


@query("prj7_prefixed_duplicates", "SELECT c_custkey, CASE WHEN count(*) OVER (PARTITION BY c_nationkey) > 1 THEN left(c_mktsegment, 1) || '. ' ELSE '' END || 'N' || c_nationkey AS label FROM customer")
def prj7(spark, sf_dir):
    """Names that several share get a first letter; the counts are joined back, so no window gathers a name's rows."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", F.concat(F.lit("N"), "c_nationkey").alias("short"))
    n = c.groupBy("short").agg(F.count("*").alias("n"))
    return c.join(n, "short").select("c_custkey", F.concat(F.when(F.col("n") > 1, F.concat(F.left("c_mktsegment", F.lit(1)), F.lit(". "))).otherwise(""), "short").alias("label"))


@query("prj8_log_metrics", PRELUDE + "SELECT case_id, case_id AS total_cases, case_id % 7 AS llm_calls, CAST(case_id % 100 AS DOUBLE) / 4 AS llm_cost FROM cases")
def prj8(spark, sf_dir):
    log = F.concat(F.lit("Total cases: "), "case_id", F.lit("\nLLM calls:  "), F.col("case_id") % 7, F.lit("\nLLM cost: $"), (F.col("case_id") % 100).cast("double") / 4)
    got = fields.log_metrics(log)
    return cases(spark, sf_dir).select("case_id", got["total_cases"].cast("long").alias("total_cases"), got["llm_calls"].cast("long").alias("llm_calls"), got["llm_cost"].alias("llm_cost"))


@query("prj4_prj5_case_ids", PRELUDE + "SELECT case_id AS number, 'vol' || volume || '_case_' || (row_number() OVER (PARTITION BY volume ORDER BY case_id) - 1) AS case_id FROM cases")
def prj5(spark, sf_dir):
    """Volume number from a file's name and the case's place in its volume."""
    name = F.concat(F.lit("Volume_"), F.col("volume").cast("string"))
    place = F.row_number().over(Window.partitionBy("volume").orderBy("case_id")) - 1
    return cases(spark, sf_dir).select(F.col("case_id").alias("number"), F.concat(F.lit("vol"), fields.volume_number(name), F.lit("_case_"), place).alias("case_id"))


@query(
    "prj1_snk6_case_rows",
    PRELUDE + """, n AS (SELECT case_id, count(*) AS n_notes, string_agg('G.R. ' || l_linenumber, '; ' ORDER BY l_linenumber, l_partkey, l_suppkey) AS numbers, min_by(l_shipmode, (l_linenumber, l_partkey, l_suppkey)) AS first_text
      FROM cases JOIN (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag AS l_shipmode FROM lineitem) ON l_orderkey = case_id GROUP BY 1)
    SELECT case_id, numbers, first_text AS division, n_notes FROM n WHERE trim(numbers) <> ''""",
)
def prj1(spark, sf_dir):
    """Nested spans to one wide row a case: first text of some labels, all case numbers in order; rows without one go."""
    spans = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("case_id"), F.struct("l_linenumber", "l_partkey", "l_suppkey").alias("at"), F.concat(F.lit("G.R. "), "l_linenumber").alias("number"), "l_returnflag")
    rows = spans.groupBy("case_id").agg(F.sort_array(F.collect_list(F.struct("at", "number"))).alias("ns"), F.min_by("l_returnflag", "at").alias("division"), F.count("*").alias("n_notes"))
    numbers = F.array_join(F.transform("ns", lambda x: x["number"]), "; ")
    return rows.select("case_id", numbers.alias("numbers"), "division", "n_notes").where(F.trim("numbers") != "")


@query("flt6_flt7_flt8_load_cases", PRELUDE + "SELECT division, count(*) AS n FROM cases JOIN (SELECT case_id, bool_or(role = 'dissent') AS dis FROM votes GROUP BY 1) USING (case_id) WHERE price >= 20000 AND division IN ('F', 'O') AND d >= DATE '1995-06-01' AND dis AND case_id % 11 <> 0 GROUP BY 1")
def flt6(spark, sf_dir):
    """Confidence, division, date, dissent and a case number that isn't blank, in that order."""
    dissents = votes(spark, sf_dir).groupBy("case_id").agg(F.max(F.col("role") == "dissent").alias("dis"))
    number = F.when(F.col("case_id") % 11 == 0, F.lit(" ")).otherwise(F.col("case_id").cast("string"))
    kept = cases(spark, sf_dir).where((F.col("price") >= 20000) & F.col("division").isin("F", "O") & (F.col("date") >= F.lit("1995-06-01").cast("date"))).withColumn("number", number)
    return kept.join(dissents, "case_id").where("dis").where(F.trim("number") != "").where(~F.col("number").isin(*fields.NO_NAMES)).groupBy("division").agg(F.count("*").alias("n"))


@query(
    "flt9_term_overlaps_window",
    PRELUDE + """, t AS (SELECT member, CASE WHEN member % 7 = 0 THEN NULL ELSE min(d) END AS s, CASE WHEN member % 5 = 0 THEN NULL ELSE min(d) + 400 END AS e FROM votes GROUP BY member)
    SELECT k, count(*) AS n FROM t, win WHERE coalesce(s <= window_end + 365, true) AND coalesce(e >= window_start - 365, true) GROUP BY 1""",
)
def flt9(spark, sf_dir):
    """Members whose term meets the window with a year's grace; an unknown side never excludes."""
    first = votes(spark, sf_dir).groupBy("member").agg(F.min("date").alias("d"))
    t = first.select("member", F.when(F.col("member") % 7 != 0, F.col("d")).alias("s"), F.when(F.col("member") % 5 != 0, F.date_add("d", 400)).alias("e"))
    w = windows(bounds(cases(spark, sf_dir)), WINDOW)  # as many rows as windows
    return t.join(F.broadcast(w), fields.in_term(F.col("s"), F.col("e"), F.col("window_start"), F.col("window_end"))).groupBy("k").agg(F.count("*").alias("n"))


@query("off3_off6_line_col", LINES + ", a AS (SELECT doc_id, 2 AS line_no, 7 AS col FROM documents) SELECT a.doc_id, start_char + least(col, length(line)) AS char, coalesce(line, '') AS line FROM a LEFT JOIN lines ON lines.doc_id = a.doc_id AND lines.line_no = a.line_no")
def off3(spark, sf_dir):
    """(line, column) to an offset, the column clamped to the line; lines outside are empty."""
    asked = table(spark, sf_dir, "documents").select("doc_id", F.lit(2).alias("line_no"), F.lit(7).alias("col"))
    return asked.join(doc_lines(spark, sf_dir), ["doc_id", "line_no"], "left").select("doc_id", (F.col("start_char") + F.least("col", F.length("line"))).alias("char"), F.coalesce("line", F.lit("")).alias("line"))


@query("off8_off9_excerpts", "SELECT doc_id, replace(substring(text, 51, 150), chr(10), '\\n') AS context, CASE WHEN length(text) > 200 THEN left(text, 200) || '...' ELSE text END AS short FROM documents")
def off8(spark, sf_dir):
    """A hundred characters around a span, and texts shortened to two hundred: the limit is the feature."""
    return table(spark, sf_dir, "documents").select("doc_id", F.replace(F.substring("text", 51, 150), F.lit("\n"), F.lit("\\n")).alias("context"), F.when(F.length("text") > 200, F.concat(F.left("text", F.lit(200)), F.lit("..."))).otherwise(F.col("text")).alias("short"))


@query("flt4_content_lines", LINES + "SELECT doc_id, count(*) AS n, sum(length(line)) AS chars FROM lines WHERE line_no BETWEEN 2 AND 5 AND trim(line) <> '' GROUP BY 1")
def flt4(spark, sf_dir):
    """Lines of an inclusive range that are not noise."""
    rows = doc_lines(spark, sf_dir).where(F.col("line_no").between(2, 5) & (F.trim("line") != ""))
    return rows.groupBy("doc_id").agg(F.count("*").alias("n"), F.sum(F.length("line")).alias("chars"))


@query(
    "flt12_blank_pages",
    """WITH p AS (SELECT conv_id, turn, row_number() OVER w AS page, count(*) OVER (PARTITION BY conv_id) AS n, length(trim(text)) < 40 AS blank FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
    SELECT conv_id, page FROM p WHERE blank AND page > 1 AND page < n""",
)
def flt12(spark, sf_dir):
    """Pages between markers with next to no text, but for the first ones and the last."""
    w = Window.partitionBy("conv_id")
    p = table(spark, sf_dir, "conversations").select("conv_id", F.row_number().over(w.orderBy("turn")).alias("page"), F.count("*").over(w).alias("n"), (F.length(F.trim("text")) < 40).alias("blank"))
    return p.where("blank AND page > 1 AND page < n").select("conv_id", "page")


@query(
    "agg39_snk22_patched_pages",
    """WITH p AS (SELECT conv_id, turn, text, CASE WHEN turn % 2 = 0 THEN 'patched ' || text ELSE 'x' END AS patch FROM conversations)
    SELECT conv_id, count(*) AS pages, count(*) FILTER (length(trim(patch)) >= 10) AS patched, md5(string_agg(CASE WHEN length(trim(patch)) >= 10 THEN patch ELSE text END, chr(10) ORDER BY turn)) AS digest FROM p GROUP BY 1""",
)
def agg39(spark, sf_dir):
    """Pages with patches of ten characters or more put in, joined in page order; a report of how many."""
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    patches = c.select("conv_id", "turn", F.when(F.col("turn") % 2 == 0, F.concat(F.lit("patched "), "text")).otherwise("x").alias("patch"))
    good = F.length(F.trim("patch")) >= 10
    both = c.join(patches, ["conv_id", "turn"], "left").select("conv_id", "turn", F.coalesce(good, F.lit(False)).alias("ok"), F.when(good, F.col("patch")).otherwise(F.col("text")).alias("t"))
    pages = both.groupBy("conv_id").agg(F.count("*").alias("pages"), F.count_if("ok").alias("patched"), F.array_sort(F.collect_list(F.struct("turn", "t"))).alias("ts"))  # a document's pages
    return pages.select("conv_id", "pages", "patched", F.md5(F.array_join(F.transform("ts", lambda x: x["t"]), "\n")).alias("digest"))


@query("jn20_manifest_defaults", "SELECT doc_id, coalesce(quality, -1) AS quality, CASE WHEN labels.doc_id IS NULL THEN 'unknown' ELSE 'listed' END AS status FROM documents LEFT JOIN labels USING (doc_id)")
def jn20(spark, sf_dir):
    d, m = table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels").select("doc_id", "quality", F.lit("listed").alias("status"))
    return d.join(m, "doc_id", "left").select("doc_id", F.coalesce("quality", F.lit(-1)).alias("quality"), F.coalesce("status", F.lit("unknown")).alias("status"))


@query("jn21_added_removed", "SELECT coalesce(b.doc_id, a.doc_id) AS doc_id, CASE WHEN a.doc_id IS NULL THEN 'removed' WHEN b.doc_id IS NULL THEN 'added' ELSE 'both' END AS side FROM (SELECT doc_id FROM documents WHERE lang <> 'fr') b FULL JOIN (SELECT doc_id FROM documents WHERE lang <> 'de') a USING (doc_id)")
def jn21(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    b, a = d.where("lang <> 'fr'").select("doc_id", F.lit(1).alias("b")), d.where("lang <> 'de'").select("doc_id", F.lit(1).alias("a"))
    return b.join(a, "doc_id", "full").select("doc_id", F.when(F.col("a").isNull(), "removed").when(F.col("b").isNull(), "added").otherwise("both").alias("side"))


@query(
    "jn22_enclosing_case",
    PRELUDE + """, c AS (SELECT volume, case_id, row_number() OVER (PARTITION BY volume ORDER BY case_id) * 10 AS sl FROM cases), a AS (SELECT DISTINCT volume, t.line FROM cases, (VALUES (5), (10), (57), (1000000)) t(line))
    SELECT a.volume, line, max_by(case_id, sl) AS case_id FROM a LEFT JOIN c ON c.volume = a.volume AND sl <= line GROUP BY ALL""",
)
def jn22(spark, sf_dir):
    """The case that a line is in: the last one that starts at or before it (as-of, in one sorted window a volume)."""
    starts = cases(spark, sf_dir).select("volume", "case_id", (F.row_number().over(Window.partitionBy("volume").orderBy("case_id")) * 10).alias("at"))
    asked = cases(spark, sf_dir).select("volume").distinct().withColumn("at", F.explode(F.array(*map(F.lit, (5, 10, 57, 1000000)))))
    both = starts.withColumn("asked", F.lit(0)).unionByName(asked.withColumn("case_id", F.lit(None).cast("long")).withColumn("asked", F.lit(1)))
    w = Window.partitionBy("volume").orderBy("at", "asked").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return both.withColumn("case_id", F.last("case_id", ignorenulls=True).over(w)).where("asked = 1").select("volume", F.col("at").alias("line"), "case_id")


@query("jn17_lost_cases", PRELUDE + ", lost AS (SELECT case_id FROM cases WHERE division = 'P') SELECT case_id, EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = case_id AND l_returnflag = 'R') AS has_type FROM lost ORDER BY case_id LIMIT 50")
def jn17(spark, sf_dir):
    """Why cases went missing, for the first fifty of them: the limit is the feature."""
    typed = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("case_id")).distinct().withColumn("has_type", F.lit(True))
    lost = cases(spark, sf_dir).where("division = 'P'").select("case_id").orderBy("case_id").limit(50)
    return lost.join(typed, "case_id", "left").select("case_id", F.coalesce("has_type", F.lit(False)).alias("has_type"))


@query(
    "set3_missing_labels",
    """WITH m AS (SELECT o_orderkey AS case_id, label FROM orders, (VALUES ('A'), ('N'), ('R')) t(label) WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = label))
    SELECT o_orderkey AS case_id, '[' || coalesce(string_agg(label, ', ' ORDER BY label), '') || ']' AS missing FROM orders LEFT JOIN m ON case_id = o_orderkey GROUP BY 1""",
)
def set3(spark, sf_dir):
    """Required labels that a case lacks."""
    have = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("case_id")).agg(F.collect_set("l_returnflag").alias("have"))
    missing = F.sort_array(F.array_except(F.array(*map(F.lit, "ANR")), F.coalesce("have", F.array().cast("array<string>"))))
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("case_id")).join(have, "case_id", "left").select("case_id", F.concat(F.lit("["), F.array_join(missing, ", "), F.lit("]")).alias("missing"))


@query("set7_snk9_registry", "SELECT upper(c_mktsegment) AS key, count(*) AS n FROM customer GROUP BY 1 UNION ALL SELECT 'NEW ONE', 1")
def set7(spark, sf_dir):
    """Names added to a registry: those that it has not, in whatever spelling."""
    current = table(spark, sf_dir, "customer").groupBy(F.upper("c_mktsegment").alias("key")).agg(F.count("*").alias("n"))
    new = table(spark, sf_dir, "customer").select(F.initcap(F.lower("c_mktsegment")).alias("name")).distinct().union(spark.createDataFrame([("New One",)], "name string"))
    return current.union(new.select(F.upper("name").alias("key")).join(current, "key", "left_anti").select("key", F.lit(1).cast("long")))


@query("set8_src10_first_links", "WITH a AS (SELECT page_id, unnest(regexp_extract_all(html, '<a[^>]*href=\"([^\"]*)\"', 1)) AS href, generate_subscripts(regexp_extract_all(html, '<a[^>]*href=\"([^\"]*)\"', 1), 1) AS i FROM pages) SELECT page_id, href, min(i) AS first_place FROM a GROUP BY 1, 2")
def set8(spark, sf_dir):
    """Different links in the order in which they first stand."""
    a = table(spark, sf_dir, "pages").select("page_id", F.posexplode(F.regexp_extract_all("html", F.lit('<a[^>]*href="([^"]*)"'), F.lit(1))).alias("i", "href"))
    return a.groupBy("page_id", "href").agg((F.min("i") + 1).alias("first_place"))


@query("set10_hold_out", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT min(doc_id) FROM documents GROUP BY source)")
def set10(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id").join(d.groupBy("source").agg(F.min("doc_id").alias("doc_id")).select("doc_id"), "doc_id", "left_anti")


@query("srt3_srt4_case_order", PRELUDE + "SELECT case_id, d AS date, volume FROM cases ORDER BY volume, d, case_id")
def srt3(spark, sf_dir):
    """Rows by volume (none as 0), then date: a global order, by ranges rather than in one task."""
    return cases(spark, sf_dir).select("case_id", "date", "volume").orderBy(F.coalesce("volume", F.lit(0)), "date", "case_id")


@query("srt5_natural_order", PRELUDE + ", x AS (SELECT 'vol' || volume || '_case_' || (case_id % 1000) AS id, volume, case_id % 1000 AS n, case_id FROM cases) SELECT id, case_id FROM x ORDER BY volume, n, case_id LIMIT 100")
def srt5(spark, sf_dir):
    """The first hundred in natural order, digits as numbers: the limit is the feature."""
    x = cases(spark, sf_dir).select(F.concat(F.lit("vol"), "volume", F.lit("_case_"), F.col("case_id") % 1000).alias("id"), "case_id")
    return x.orderBy(*fields.natural_order(F.col("id")), "case_id").limit(100).select("id", "case_id")


@query("srt7_friction_and_alliance", PRELUDE + ", m AS (SELECT member, count(*) FILTER (role = 'dissent') AS x FROM votes GROUP BY 1) SELECT 'low' AS side, member, x FROM (SELECT * FROM m ORDER BY x, member LIMIT 10) UNION ALL SELECT 'high', member, x FROM (SELECT * FROM m ORDER BY x DESC, member DESC LIMIT 10)")
def srt7(spark, sf_dir):
    """Both ends of a ranking, ten each: the limit is the feature."""
    m = votes(spark, sf_dir).groupBy("member").agg(F.count_if(F.col("role") == "dissent").alias("x"))
    return m.orderBy("x", "member").limit(10).select(F.lit("low").alias("side"), "member", "x").union(m.orderBy(F.desc("x"), F.desc("member")).limit(10).select(F.lit("high"), "member", "x"))


@query("srt8_largest_groups", PRELUDE + "SELECT bloc, count(*) AS n FROM members GROUP BY 1 ORDER BY n DESC, bloc LIMIT 8")
def srt8(spark, sf_dir):
    from foliograph.plans.base import members

    return members(spark, sf_dir).groupBy("bloc").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "bloc").limit(8)


@query("srt11_known_order", "SELECT c_mktsegment AS name, CASE c_mktsegment WHEN 'MACHINERY' THEN 0 WHEN 'BUILDING' THEN 1 ELSE 999 END AS ord, count(*) AS n FROM customer GROUP BY 1, 2 ORDER BY ord, name")
def srt11(spark, sf_dir):
    """Names in a known order, the unknown ones by the alphabet after them."""
    known = spark.createDataFrame([("MACHINERY", 0), ("BUILDING", 1)], "name string, o int")
    n = table(spark, sf_dir, "customer").groupBy(F.col("c_mktsegment").alias("name")).agg(F.count("*").alias("n"))
    return n.join(F.broadcast(known), "name", "left").select("name", F.coalesce("o", F.lit(999)).alias("ord"), "n").orderBy("ord", "name")


@query("srt10_capped_report", LINES + ", h AS (SELECT doc_id, line_no, row_number() OVER (ORDER BY doc_id, line_no) AS rn, count(*) OVER () AS n FROM lines WHERE line LIKE '%=%') SELECT doc_id, line_no, '' AS note FROM h WHERE rn <= 30 UNION ALL SELECT NULL, NULL, 'and ' || (max(n) - 30) || ' more' FROM h HAVING max(n) > 30")
def srt10(spark, sf_dir):
    """Thirty near misses and how many more there are: the cap is the feature."""
    h = doc_lines(spark, sf_dir).where(F.col("line").contains("=")).select("doc_id", "line_no")
    more = h.agg(F.count("*").alias("n")).where("n > 30").select(F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("int").alias("line_no"), F.concat(F.lit("and "), F.col("n") - 30, F.lit(" more")).alias("note"))
    return h.orderBy("doc_id", "line_no").limit(30).withColumn("note", F.lit("")).union(more)


@query("agg3_row_statistics", PRELUDE + "SELECT volume, count(*) AS n_rows, count(*) FILTER (division = 'F') AS corrected, count(*) FILTER (division = 'P') AS warned, count(*) FILTER (price < 20000) AS unmatched FROM cases GROUP BY 1")
def agg3(spark, sf_dir):
    return cases(spark, sf_dir).groupBy("volume").agg(F.count("*").alias("n_rows"), F.count_if(F.col("division") == "F").alias("corrected"), F.count_if(F.col("division") == "P").alias("warned"), F.count_if(F.col("price") < 20000).alias("unmatched"))


@query("agg7_snk4_label_counts", "SELECT l_returnflag AS label, l_linestatus AS rule, count(*) AS n FROM lineitem GROUP BY 1, 2 ORDER BY 1, 2")
def agg7(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_returnflag").alias("label"), F.col("l_linestatus").alias("rule")).agg(F.count("*").alias("n")).orderBy("label", "rule")


@query(
    "agg8_snk5_batch_totals",
    PRELUDE + """, v AS (SELECT volume, count(*) AS n, CAST(count(*) % 5 AS BIGINT) AS calls FROM cases GROUP BY 1), r AS (SELECT *, sum(calls) OVER (ORDER BY volume) AS cumulative FROM v)
    SELECT count(*) AS volumes, sum(n) AS total_cases, sum(calls) AS llm_calls, sum(cumulative) AS summed_budget, max(cumulative) AS spent FROM r""",
)
def agg8(spark, sf_dir):
    """Totals of a batch; the sum of running budgets counts calls more than once, so what was really spent is there, too."""
    v = cases(spark, sf_dir).groupBy("volume").agg(F.count("*").alias("n"), (F.count("*") % 5).alias("calls"))
    r = v.withColumn("cumulative", F.sum("calls").over(Window.orderBy("volume")))  # one row a volume
    return r.agg(F.count("*").alias("volumes"), F.sum("n").alias("total_cases"), F.sum("calls").alias("llm_calls"), F.sum("cumulative").alias("summed_budget"), F.max("cumulative").alias("spent"))


SEVERITY = "CASE WHEN n = 0 THEN 'warning' WHEN {x} >= 0.75 THEN 'ok' WHEN {x} >= 0.6 THEN 'warning' ELSE 'critical' END"


@query("agg9_agg13_severity", PRELUDE + ", c AS (SELECT volume, count(*) AS n, round(CAST(count(*) FILTER (price >= 120000) AS DOUBLE) / count(*), 4) AS x FROM cases GROUP BY 1), s AS (SELECT volume, x, " + SEVERITY.format(x="x") + " AS severity FROM c) SELECT volume, x AS mean, severity, CASE WHEN (SELECT bool_or(severity = 'critical') FROM s) THEN 'critical' WHEN (SELECT bool_or(severity = 'warning') FROM s) THEN 'warning' ELSE 'ok' END AS worst FROM s")
def agg9(spark, sf_dir):
    """Mean confidence of each volume in bands, and the worst band of all."""
    c = cases(spark, sf_dir).groupBy("volume").agg(F.count("*").alias("n"), F.round(F.count_if(F.col("price") >= 120000) / F.count("*"), 4).alias("mean"))
    s = c.select("volume", "mean", F.expr(SEVERITY.format(x="mean")).alias("severity"))
    worst = s.agg(F.max(F.struct(F.expr("CASE severity WHEN 'critical' THEN 2 WHEN 'warning' THEN 1 ELSE 0 END").alias("o"), "severity"))["severity"].alias("worst"))
    return s.crossJoin(F.broadcast(worst))  # a single row


@query(
    "agg18_case_evaluation",
    """WITH s AS (SELECT source AS label, n_chars > 800 AS detected, quality = 1 AS expected, n_chars > 800 AND quality = 1 AND doc_id % 3 <> 0 AS exact FROM documents JOIN labels USING (doc_id)),
    c AS (SELECT label, count(*) FILTER (detected) AS detected, count(*) FILTER (expected) AS expected, count(*) FILTER (exact) AS exact FROM s GROUP BY 1), u AS (SELECT * FROM c UNION ALL SELECT 'OVERALL', sum(detected), sum(expected), sum(exact) FROM c)
    SELECT label, detected, expected, exact, round(coalesce(exact / nullif(detected, 0), 0), 4) AS precision, round(coalesce(exact / nullif(expected, 0), 0), 4) AS recall FROM u""",
)
def agg18(spark, sf_dir):
    """Exact matches over what was detected and over what was expected, by label and overall."""
    s = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("label"), (F.col("n_chars") > 800).alias("d")).join(table(spark, sf_dir, "labels").select("doc_id", (F.col("quality") == 1).alias("e")), "doc_id")
    c = s.groupBy("label").agg(F.count_if("d").alias("detected"), F.count_if("e").alias("expected"), F.count_if(F.col("d") & F.col("e") & (F.col("doc_id") % 3 != 0)).alias("exact"))
    u = c.union(c.agg(F.lit("OVERALL"), *[F.sum(x) for x in ("detected", "expected", "exact")]))
    share = lambda by: F.round(F.coalesce(F.col("exact") / F.nullif(F.col(by), F.lit(0)), F.lit(0.0)), 4)
    return u.withColumns({"precision": share("detected"), "recall": share("expected")})


@query("agg32_window_by_combo", PRELUDE + ", n AS (SELECT k, division, count(*) AS c FROM cases JOIN win ON d >= window_start AND d < window_end GROUP BY ALL) SELECT k, coalesce(sum(c) FILTER (division = 'F'), 0)::BIGINT AS full_cases, coalesce(sum(c) FILTER (division = 'O'), 0)::BIGINT AS open_cases FROM n GROUP BY 1")
def agg32(spark, sf_dir):
    from foliograph.operators.windows import assign

    c = cases(spark, sf_dir)
    placed = assign(c.select("date", "division"), bounds(c), WINDOW)
    return placed.groupBy("k").pivot("division", ["F", "O"]).count().fillna(0).select("k", F.col("F").alias("full_cases"), F.col("O").alias("open_cases"))


@query("agg36_correction_summary", "SELECT l_returnflag AS kind, l_linenumber AS label, count(*) AS n, count(*) FILTER (l_quantity < 10) AS minor FROM lineitem GROUP BY 1, 2")
def agg36(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_returnflag").alias("kind"), F.col("l_linenumber").alias("label")).agg(F.count("*").alias("n"), F.count_if(F.col("l_quantity") < 10).alias("minor"))


@query(
    "agg38_test_scorecard",
    PRELUDE + """, g AS (SELECT case_id, volume, case_id * 10 AS at, d FROM cases), p AS (SELECT case_id * 10 + case_id % 6 AS at, volume, CASE WHEN case_id % 9 = 0 THEN d + 1 ELSE d END AS d FROM cases WHERE case_id % 13 <> 0)
    SELECT g.volume, count(*) AS n, count(p.at) AS found, count(*) FILTER (p.d = g.d) AS right_date FROM g LEFT JOIN p ON p.volume = g.volume AND p.at // 10 = g.at // 10 AND abs(p.at - g.at) <= 3 GROUP BY 1""",
)
def agg38(spark, sf_dir):
    """Boundaries found within three lines, and how many of them have the right date; places meet by blocks of ten lines."""
    c = cases(spark, sf_dir)
    at = F.col("case_id") * 10
    g = c.select("volume", at.alias("at"), F.floor(at / 10).alias("block"), "date")
    q = at + F.col("case_id") % 6
    p = c.where("case_id % 13 <> 0").select("volume", q.alias("p_at"), F.floor(q / 10).alias("block"), F.when(F.col("case_id") % 9 == 0, F.date_add("date", 1)).otherwise(F.col("date")).alias("p_date"))
    near = p.join(g, ["volume", "block"], "right").withColumn("hit", F.coalesce(F.abs(F.col("p_at") - F.col("at")) <= 3, F.lit(False)))
    return near.groupBy("volume").agg(F.count("*").alias("n"), F.count_if("hit").alias("found"), F.count_if(F.col("hit") & (F.col("date") == F.col("p_date"))).alias("right_date"))


@query("agg41_build_counters", PRELUDE + "SELECT count(*) AS votes_seen, count(*) FILTER (role = 'dissent') AS dissents, count(DISTINCT member) AS nodes, count(DISTINCT case_id) FILTER (role = 'majority') AS majority_cases FROM votes")
def agg41(spark, sf_dir):
    return votes(spark, sf_dir).agg(F.count("*").alias("votes_seen"), F.count_if(F.col("role") == "dissent").alias("dissents"), F.countDistinct("member").alias("nodes"), F.countDistinct(F.when(F.col("role") == "majority", F.col("case_id"))).alias("majority_cases"))


CHECKS = {"parties_length": "price > 50000", "votes_length": "case_id % 3 > 0", "ponente_known": "case_id % 4 > 0", "date_valid": "case_id % 50 > 0", "ordering_correct": "case_id % 17 > 0"}


@query(
    "flt16_map1_labels_to_redo",
    PRELUDE + ", f AS (" + " UNION ALL ".join(f"SELECT case_id, '{k}' AS chk FROM cases WHERE NOT ({v})" for k, v in CHECKS.items()) + """),
    l AS (SELECT case_id, unnest(CASE chk WHEN 'parties_length' THEN ['parties'] WHEN 'votes_length' THEN ['votes'] WHEN 'ponente_known' THEN ['ponente'] WHEN 'date_valid' THEN ['date']
      ELSE ['case_number', 'date', 'division', 'parties', 'start_syllabus', 'end_syllabus', 'counsel', 'ponente', 'doc_type', 'votes'] END) AS label FROM f)
    SELECT case_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM l GROUP BY 1""",
)
def flt16(spark, sf_dir):
    """A map of checks to scores; the labels of the failed ones are to be extracted again."""
    checks = F.map_from_arrays(F.array(*map(F.lit, CHECKS)), F.array(*[F.when(F.expr(v), 1.0).otherwise(0.0) for v in CHECKS.values()]))
    redo = cases(spark, sf_dir).select("case_id", fields.labels_to_redo(checks).alias("labels")).where(F.size("labels") > 0)
    return redo.select("case_id", F.array_join("labels", ",").alias("labels"))


@query("inc2_manifest_upsert", "SELECT coalesce(n.doc_id, o.doc_id) AS doc_id, CASE WHEN n.doc_id IS NULL THEN o.status ELSE 'done' END AS status FROM (SELECT doc_id, 'failed' AS status FROM documents WHERE lang = 'en') o FULL JOIN (SELECT doc_id FROM documents WHERE n_chars > 500) n USING (doc_id)")
def inc2(spark, sf_dir):
    from foliograph.operators import records

    d = table(spark, sf_dir, "documents")
    return records.upsert(d.where("lang = 'en'").select("doc_id", F.lit("failed").alias("status")), d.where("n_chars > 500").select("doc_id", F.lit("done").alias("status")), "doc_id")


@query("inc3_manifest_reset", "SELECT doc_id, CASE WHEN doc_id BETWEEN 100 AND 200 AND lang <> 'fr' AND n_chars > 300 THEN 'pending' ELSE 'done' END AS status FROM documents")
def inc3(spark, sf_dir):
    """Entries of a range that are done and not scanned go back to the queue."""
    back = F.col("doc_id").between(100, 200) & (F.col("lang") != "fr") & (F.col("n_chars") > 300)
    return table(spark, sf_dir, "documents").select("doc_id", F.when(back, "pending").otherwise("done").alias("status"))


@query("inc6_offset_shift", "SELECT l_orderkey AS case_id, l_linenumber AS label, 1000 + l_linenumber * 10 AS start_char, 1000 + l_linenumber * 10 + CAST(l_quantity AS BIGINT) - 5 AS end_char, l_partkey, l_suppkey FROM lineitem WHERE CAST(l_quantity AS BIGINT) - 5 > 0 AND l_returnflag <> 'A'")
def inc6(spark, sf_dir):
    """Labels with offsets in the case, moved to the volume; empty spans and unknown labels go."""
    s, e = F.col("l_linenumber") * 10, F.col("l_linenumber") * 10 + F.col("l_quantity").cast("long") - 5
    known = table(spark, sf_dir, "lineitem").where((e > s) & (F.col("l_returnflag") != "A"))
    return known.select(F.col("l_orderkey").alias("case_id"), F.col("l_linenumber").alias("label"), (s + 1000).alias("start_char"), (e + 1000).alias("end_char"), "l_partkey", "l_suppkey")


@query(
    "inc7_replace_labels",
    """WITH old AS (SELECT l_orderkey AS case_id, l_linenumber AS label, l_partkey AS span FROM lineitem WHERE l_returnflag <> 'A'), new AS (SELECT l_orderkey AS case_id, l_linenumber AS label, l_partkey + 1 AS span FROM lineitem WHERE l_returnflag = 'R' OR l_linenumber = 1)
    SELECT * FROM new UNION ALL SELECT * FROM old WHERE (case_id, label) NOT IN (SELECT (case_id, label) FROM new)""",
)
def inc7(spark, sf_dir):
    """Labels that were extracted again take the place of all earlier spans of that label."""
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("case_id"), F.col("l_linenumber").alias("label"), F.col("l_partkey").alias("span"), "l_returnflag")
    new = rows.where("l_returnflag = 'R' OR label = 1").select("case_id", "label", (F.col("span") + 1).alias("span"))
    old = rows.where("l_returnflag <> 'A'").select("case_id", "label", "span")
    return new.union(old.join(new.select("case_id", "label").distinct(), ["case_id", "label"], "left_anti"))


@query(
    "win11_near_starts",
    """WITH s AS (SELECT l_orderkey AS case_id, l_linenumber AS place, l_linenumber - lag(l_linenumber) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS gap FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag <> 'N'))
    SELECT case_id, place FROM s WHERE gap IS NULL OR gap > 3""",
)
def win11(spark, sf_dir):
    """Starts within three lines of the one before are dropped."""
    s = table(spark, sf_dir, "lineitem").where("l_returnflag <> 'N'").select(F.col("l_orderkey").alias("case_id"), F.col("l_linenumber").alias("place")).distinct()
    gap = F.col("place") - F.lag("place").over(Window.partitionBy("case_id").orderBy("place"))
    return s.withColumn("gap", gap).where("gap IS NULL OR gap > 3").select("case_id", "place")


@query("mth2_half_even", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(round_even(CAST(l_quantity AS DECIMAL(18, 5)) / 32, 4) AS DOUBLE) AS rate FROM lineitem")
def mth2(spark, sf_dir):
    """Rates rounded half to even on exact decimals."""
    exact = F.col("l_quantity").cast("decimal(18,5)") / F.lit(32).cast("decimal(4,0)")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.bround(exact, 4).cast("double").alias("rate"))


@query("str2_division_line", PRELUDE + "SELECT trim(' .,;:' || division || '- ''', ' .,;:''-') AS division, count(*) AS n FROM cases GROUP BY 1")
def str2(spark, sf_dir):
    return cases(spark, sf_dir).groupBy(F.btrim(F.concat(F.lit(" .,;:"), "division", F.lit("- '")), F.lit(" .,;:'-")).alias("division")).agg(F.count("*").alias("n"))


SAID = ["G.R. No, {}", "SECOND DIVISIION", "SOORDERED,", "May 30. 19{}", "PER  CURIAM,", "[986", "(9B6", "[976"]
MENDED = ["G.R. No. {}", "SECOND DIVISION", "SO ORDERED.", "May 30, 19{}", "PER CURIAM", "1986", "1986", "[976"]


@query(
    "str4_str9_repairs",
    PRELUDE + ", x AS (SELECT case_id, CASE case_id % 8 " + " ".join(f"WHEN {k} THEN replace('{m}', '{{}}', CAST(case_id % 90 + 10 AS VARCHAR))" for k, m in enumerate(MENDED)) + " END AS fixed FROM cases) SELECT case_id, fixed, case_id % 8 <> 7 AS changed FROM x",
)
def str9(spark, sf_dir):
    """Repairs by label: case number, division, end mark, date, ponente; whether the text changed is kept."""
    k = (F.col("case_id") % 8).cast("int")
    said = F.replace(F.element_at(F.array(*map(F.lit, SAID)), k + 1), F.lit("{}"), (F.col("case_id") % 90 + 10).cast("string"))
    label = F.element_at(F.array(*map(F.lit, ("case_number", "division", "end_decision", "date", "ponente", "date", "date", "date"))), k + 1)
    fixed = repair.by_label(label, said)
    return cases(spark, sf_dir).select("case_id", fixed.alias("fixed"), (fixed != said).alias("changed"))


@query("str3_title_case", PRELUDE + "SELECT (['Gutierrez, Jr.', 'Melencio-Herrera', 'Carpio Morales'])[CAST(case_id % 3 + 1 AS INTEGER)] AS name, count(*) AS n FROM cases GROUP BY 1")
def str3(spark, sf_dir):
    raw = F.element_at(F.array(*map(F.lit, ("GUTIERREZ, JR.", "MELENCIO-HERRERA", "CARPIO MORALES"))), (F.col("case_id") % 3 + 1).cast("int"))
    return cases(spark, sf_dir).groupBy(repair.title_case(raw).alias("name")).agg(F.count("*").alias("n"))


MISREAD = ["concur", "con- cur", "con cur", "_concur", *"coneur concue concuf soncur concor coricur conour concut conrur concui".split(), "recur"]


@query("str14_str15_concur", PRELUDE + f"SELECT case_id, CASE WHEN case_id % {len(MISREAD)} = {len(MISREAD) - 1} THEN 'they recur here' WHEN case_id % {len(MISREAD)} = 3 THEN 'they  concur here' ELSE 'they concur here' END AS said FROM cases")
def str15(spark, sf_dir):
    raw = F.concat(F.lit("they  \n "), F.element_at(F.array(*map(F.lit, MISREAD)), (F.col("case_id") % len(MISREAD) + 1).cast("int")), F.lit(" here"))
    return cases(spark, sf_dir).select("case_id", repair.concur(raw).alias("said"))
