"""Queries over headline defects, lookups, harvests, labels, pages and snapshots."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from foliograph.operators import names
from foliograph.operators.steps import dealt
from foliograph.operators.windows import SPAN, unfolded
from foliograph.plans.base import PRELUDE, cases, members, n_votes, table, votes
from foliograph.plans.court import placed, spanned
from foliograph.plans.registry import query
from foliograph.plans.text import LINES, doc_lines


@query(
    "agg2_headline_defects",
    """WITH r AS (SELECT 'before' AS side, text FROM documents UNION ALL SELECT 'after', replace(text, '#', '') FROM documents)
    SELECT side, count(*) AS total, count(*) FILTER (trim(text) = '') AS blank, count(*) FILTER (length(text) > 1000) AS over_1k, count(*) FILTER (length(text) > 5000) AS over_5k, count(*) FILTER (text LIKE '%#%') AS marked FROM r GROUP BY 1""",
)
def agg2(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("text")
    both = docs.select(F.lit("before").alias("side"), "text").union(docs.select(F.lit("after"), F.replace("text", F.lit("#"), F.lit(""))))
    n = F.length("text")
    return both.groupBy("side").agg(F.count("*").alias("total"), F.count_if(F.trim("text") == "").alias("blank"), F.count_if(n > 1000).alias("over_1k"), F.count_if(n > 5000).alias("over_5k"), F.count_if(F.contains("text", F.lit("#"))).alias("marked"))


@query("agg5_length_buckets", "SELECT lang, count(*) FILTER (length(text) < 100) AS short, count(*) FILTER (length(text) BETWEEN 100 AND 999) AS medium, count(*) FILTER (length(text) >= 1000) AS long FROM documents GROUP BY 1")
def agg5(spark, sf_dir):
    bucket = F.when(F.length("text") < 100, "short").when(F.length("text") < 1000, "medium").otherwise("long")
    return table(spark, sf_dir, "documents").select("lang", bucket.alias("b")).groupBy("lang").pivot("b", ["short", "medium", "long"]).count().fillna(0)


@query("agg6_worst_volumes", PRELUDE + "SELECT volume, count(*) FILTER (price < 50000) AS missing, count(*) AS total FROM cases GROUP BY 1 ORDER BY missing DESC, volume LIMIT 20")
def agg6(spark, sf_dir):
    """The twenty volumes with most defects: the limit is the feature."""
    return cases(spark, sf_dir).groupBy("volume").agg(F.count_if(F.col("price") < 50000).alias("missing"), F.count("*").alias("total")).orderBy(F.desc("missing"), "volume").limit(20)


@query(
    "agg10_missing_labels",
    """WITH h AS (SELECT o_orderkey, list_distinct(list(l_linestatus || l_returnflag)) AS have FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1),
    m AS (SELECT unnest(['OA', 'ON', 'OR', 'FA']) AS label, have FROM h) SELECT label, count(*) FILTER (NOT coalesce(list_contains(have, label), false)) AS n_missing, count(*) AS n FROM m GROUP BY 1""",
)
def agg10(spark, sf_dir):
    """How many cases lack each required label."""
    have = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.collect_set(F.concat("l_linestatus", "l_returnflag")).alias("have"))
    needed = F.array(*map(F.lit, ("OA", "ON", "OR", "FA")))
    each = table(spark, sf_dir, "orders").select("o_orderkey").join(have, "o_orderkey", "left").select(F.coalesce("have", F.array().cast("array<string>")).alias("have"), F.explode(needed).alias("label"))
    return each.groupBy("label").agg(F.count_if(~F.array_contains(F.col("have"), F.col("label"))).alias("n_missing"), F.count("*").alias("n"))


@query(
    "agg31_repeat_participants",
    PRELUDE + """, w AS (SELECT DISTINCT k, member, role FROM placed)
    SELECT member, count(*) AS frequency, string_agg(DISTINCT role, '; ' ORDER BY role) AS roles, min(k) AS first_window, max(k) AS last_window FROM w GROUP BY 1""",
)
def agg31(spark, sf_dir):
    """Frequency, kinds and windows of each member, as a summary over snapshots."""
    w = placed(spark, sf_dir).select("k", "member", "role").distinct()
    return w.groupBy("member").agg(F.count("*").alias("frequency"), F.array_join(F.sort_array(F.collect_set("role")), "; ").alias("roles"), F.min("k").alias("first_window"), F.max("k").alias("last_window"))


@query("agg37_status_dashboard", "SELECT coalesce(lang, 'TOTAL') AS lang, count(*) FILTER (quality = 1) AS good, count(*) FILTER (quality = 0) AS bad, count(*) FILTER (quality IS NULL) AS open FROM documents LEFT JOIN labels USING (doc_id) GROUP BY ROLLUP (lang)")
def agg37(spark, sf_dir):
    """Status counts per group with a total row; a rollup is right for plain sums."""
    q = F.col("quality")
    joined = table(spark, sf_dir, "documents").select("doc_id", "lang").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return joined.rollup("lang").agg(F.count_if(q == 1).alias("good"), F.count_if(q == 0).alias("bad"), F.count_if(q.isNull()).alias("open")).withColumn("lang", F.coalesce("lang", F.lit("TOTAL")))


@query("agg40_harvest", "SELECT upper(c_name) AS key, min_by(c_name, c_custkey) AS name, count(*) AS n FROM customer WHERE c_acctbal > 0 AND length(c_name) >= 3 GROUP BY 1")
def agg40(spark, sf_dir):
    """Names of confident records without regard to case; the first spelling stays."""
    good = table(spark, sf_dir, "customer").where("c_acctbal > 0 AND length(c_name) >= 3")
    return good.groupBy(F.upper("c_name").alias("key")).agg(F.min_by("c_name", "c_custkey").alias("name"), F.count("*").alias("n"))


@query(
    "jn9_tiered_resolution",
    """SELECT CASE s_suppkey % 5 WHEN 0 THEN 'Given' || s_suppkey || ' Middle Sur' || s_suppkey WHEN 1 THEN 'Nick' || s_suppkey WHEN 2 THEN 'SUR' || s_suppkey || ', GIVEN' || s_suppkey WHEN 3 THEN 'X. Sur' || s_suppkey ELSE 'Nobody' || s_suppkey END AS node,
    CASE WHEN s_suppkey % 5 < 4 THEN 'Given' || s_suppkey || ' Middle Sur' || s_suppkey END AS person, CASE WHEN s_suppkey % 5 < 4 THEN s_suppkey % 5 END AS tier FROM supplier""",
)
def jn9(spark, sf_dir):
    """Names as cases spell them to persons: in full, by an alias, by their words in any order, by a unique last word."""
    k = F.col("s_suppkey").cast("string")
    s = table(spark, sf_dir, "supplier").select("s_suppkey")
    full = F.concat(F.lit("Given"), k, F.lit(" Middle Sur"), k)
    forms = F.array(full, F.concat(F.lit("Nick"), k), F.concat(F.lit("SUR"), k, F.lit(", GIVEN"), k), F.concat(F.lit("X. Sur"), k), F.concat(F.lit("Nobody"), k))
    nodes = s.select(F.element_at(forms, (F.col("s_suppkey") % 5 + 1).cast("int")).alias("node"))
    aliases = s.select(F.concat(F.lit("NICK"), k).alias("alias"), F.concat(F.lit("Sur"), k).alias("target"))
    return names.resolved(nodes, s.select(F.col("s_suppkey").alias("ord"), full.alias("person")), aliases)


@query("jn18_lookup", PRELUDE + ", q AS (SELECT DISTINCT l_partkey AS asked FROM lineitem) SELECT asked, case_id, CASE WHEN case_id IS NULL THEN 'not found' ELSE 'ok' END AS outcome FROM q LEFT JOIN cases ON case_id = asked")
def jn18(spark, sf_dir):
    """Asked keys with what was found, or the reason why not."""
    asked = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("asked")).distinct()
    found = asked.join(cases(spark, sf_dir).select("case_id"), F.col("asked") == F.col("case_id"), "left")
    return found.select("asked", "case_id", F.when(F.col("case_id").isNull(), "not found").otherwise("ok").alias("outcome"))


@query("jn13_nearest_case", PRELUDE + ", b AS (SELECT party, case_id, volume * 100 + day(d) AS at FROM cases) SELECT a.case_id, min_by(b.case_id, (abs(a.at - b.at), b.case_id)) AS nearest FROM b a JOIN b ON a.party = b.party AND a.case_id <> b.case_id GROUP BY 1")
def jn13(spark, sf_dir):
    """For each case of a party the nearest other one, the first on ties: of equal places the smallest ids, before and after."""
    b = cases(spark, sf_dir).select("party", "case_id", (F.col("volume") * 100 + F.dayofmonth("date")).alias("at"))
    first = b.groupBy("party", "at").agg(F.min("case_id").alias("o1"))
    second = b.join(first, ["party", "at"]).where("case_id <> o1").groupBy("party", "at").agg(F.min("case_id").alias("o2"))
    w = Window.partitionBy("party").orderBy("at")
    near = first.join(second, ["party", "at"], "left").withColumns({"b": F.lag(F.struct("at", F.col("o1").alias("o"))).over(w), "a": F.lead(F.struct("at", F.col("o1").alias("o"))).over(w)})
    own = F.when(F.col("case_id") == F.col("o1"), F.col("o2")).otherwise(F.col("o1"))
    same = F.when(own.isNotNull(), F.struct(F.lit(0).cast("long").alias("gap"), own.alias("o")))
    option = lambda c: F.when(F.col(c).isNotNull(), F.struct(F.abs(F.col("at") - F.col(f"{c}.at")).cast("long").alias("gap"), F.col(f"{c}.o").alias("o")))
    best = F.array_min(F.array_compact(F.array(same, option("b"), option("a"))))["o"]
    return b.join(near, ["party", "at"]).select("case_id", best.alias("nearest")).where("nearest IS NOT NULL")


@query("flt14_overflow", "SELECT doc_id, length(text) AS n, lang, count(*) OVER (PARTITION BY lang) AS n_in_lang FROM documents WHERE length(text) > 3000")
def flt14(spark, sf_dir):
    """Texts over a length with the number of them in their group; counts are joined back, not windowed."""
    long = table(spark, sf_dir, "documents").select("doc_id", F.length("text").cast("long").alias("n"), "lang").where("n > 3000")
    counts = long.groupBy(F.col("lang").alias("of")).agg(F.count("*").alias("n_in_lang"))
    return long.join(counts, F.col("lang").eqNullSafe(F.col("of"))).select("doc_id", "n", "lang", "n_in_lang")


@query("flt15_matched_lines", "SELECT DISTINCT l_orderkey AS case_id, unnest(CASE WHEN l_returnflag = 'R' THEN range(l_linenumber, l_linenumber + 4) ELSE [CAST(l_linenumber AS BIGINT), l_linenumber + 3] END) AS line FROM lineitem")
def flt15(spark, sf_dir):
    """Lines that labels cover: whole spans of some labels, first and last lines of the others."""
    n = F.col("l_linenumber").cast("long")
    covered = F.when(F.col("l_returnflag") == "R", F.sequence(n, n + 3)).otherwise(F.array(n, n + 3))
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("case_id"), F.explode(covered).alias("line")).distinct()


@query("win5_end_lines", PRELUDE + "SELECT volume, case_id, lead(case_id) OVER (PARTITION BY volume ORDER BY case_id) - 1 AS last_before_next FROM cases")
def win5(spark, sf_dir):
    return cases(spark, sf_dir).select("volume", "case_id", (F.lead("case_id").over(Window.partitionBy("volume").orderBy("case_id")) - 1).alias("last_before_next"))


@query(
    "win6_order_check",
    """WITH g AS (SELECT l_orderkey AS case_id, l_linenumber AS pos, min(l_suppkey) AS ord FROM lineitem GROUP BY 1, 2), k AS (SELECT case_id, ord < lag(ord) OVER (PARTITION BY case_id ORDER BY pos) AS down FROM g)
    SELECT case_id, count(*) FILTER (down) AS n_out_of_order FROM k GROUP BY 1""",
)
def win6(spark, sf_dir):
    """Positions whose lowest label precedes that of the position before."""
    g = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("case_id"), F.col("l_linenumber").alias("at")).agg(F.min("l_suppkey").alias("ord"))
    down = F.col("ord") < F.lag("ord").over(Window.partitionBy("case_id").orderBy("at"))
    return g.withColumn("down", down).groupBy("case_id").agg(F.count_if("down").alias("n_out_of_order"))


@query("win10_first_gap", LINES + ", s AS (SELECT doc_id, line_no, line_no - coalesce(lag(line_no) OVER (PARTITION BY doc_id ORDER BY line_no), line_no) AS gap FROM lines WHERE length(line) > 60), c AS (SELECT *, max(gap) OVER (PARTITION BY doc_id ORDER BY line_no) AS worst FROM s) SELECT doc_id, line_no FROM c WHERE worst <= 5")
def win10(spark, sf_dir):
    """Long lines up to the first gap of more than five lines."""
    w = Window.partitionBy("doc_id").orderBy("line_no")
    s = doc_lines(spark, sf_dir).where(F.length("line") > 60).select("doc_id", "line_no")
    s = s.withColumn("gap", F.col("line_no") - F.coalesce(F.lag("line_no").over(w), F.col("line_no")))
    return s.withColumn("worst", F.max("gap").over(w)).where("worst <= 5").select("doc_id", "line_no")


@query(
    "win8_stability",
    PRELUDE + """, c AS (SELECT k, member, CASE WHEN count(*) FILTER (role = 'dissent') * 4 >= count(*) THEN 'x' ELSE any_value(bloc) END AS com FROM placed GROUP BY 1, 2),
    s AS (SELECT a.k, a.member, a.com AS cur, b.com AS prev FROM c a JOIN c b ON b.k = a.k - 1 AND b.member = a.member),
    n AS (SELECT k, cur, prev, count(*) AS met FROM s GROUP BY ALL), x AS (SELECT k, cur, sum(met) AS n_cur FROM n GROUP BY ALL), y AS (SELECT k, prev, sum(met) AS n_prev FROM n GROUP BY ALL),
    j AS (SELECT k, cur, max(met / (n_cur + n_prev - met)) AS best FROM n JOIN x USING (k, cur) JOIN y USING (k, prev) GROUP BY ALL)
    SELECT k, round(avg(best), 4) AS stability FROM j GROUP BY 1""",
)
def win8(spark, sf_dir):
    """Mean over communities of the best Jaccard with one of the window before, over members of both."""
    # dealt by member, by which counts by span, those by window and the window before are all found
    v = dealt(spanned(spark, sf_dir).select("member", "role", "bloc", *SPAN), n_votes(spark, sf_dir), "member")
    counts = v.groupBy("member", *SPAN).agg(F.count("*").alias("n"), F.count_if(F.col("role") == "dissent").alias("d"), F.first("bloc").alias("bloc"))
    com = F.when(F.sum("d") * 4 >= F.sum("n"), "x").otherwise(F.first("bloc"))
    c = unfolded(counts).groupBy("k", "member").agg(com.alias("com"))
    w = Window.partitionBy("member").orderBy("k")
    shared = c.where("member IS NOT NULL").select("k", F.col("com").alias("cur"), F.lag("k").over(w).alias("k_prev"), F.lag("com").over(w).alias("prev")).where("k_prev = k - 1")
    n = shared.groupBy("k", "cur", "prev").agg(F.count("*").alias("both"))
    n = n.withColumns({f"n_{c}": F.sum("both").over(Window.partitionBy("k", c)) for c in ("cur", "prev")}).where("cur IS NOT NULL AND prev IS NOT NULL")
    best = n.groupBy("k", "cur").agg(F.max(F.col("both") / (F.col("n_cur") + F.col("n_prev") - F.col("both"))).alias("best"))
    return best.groupBy("k").agg(F.round(F.avg("best"), 4).alias("stability"))


@query("fsm16_cross_bloc_cases", PRELUDE + "SELECT case_id, role, count(DISTINCT bloc) AS n_blocs FROM votes GROUP BY ALL HAVING count(DISTINCT bloc) >= 2")
def fsm16(spark, sf_dir):
    """Cases whose majority or dissent spans two communities or more."""
    return votes(spark, sf_dir).groupBy("case_id", "role").agg(F.countDistinct("bloc").alias("n_blocs")).where("n_blocs >= 2")


@query("agg34_community_table", PRELUDE + "SELECT bloc, string_agg(CAST(member AS VARCHAR), '; ' ORDER BY member) AS members, count(*) AS n FROM members GROUP BY 1")
def agg34(spark, sf_dir):
    """Members of each community, in order; the dimension of members is small."""
    m = members(spark, sf_dir).groupBy("bloc").agg(F.sort_array(F.collect_list("member")).alias("m"))
    return m.select("bloc", F.array_join(F.transform("m", lambda x: x.cast("string")), "; ").alias("members"), F.size("m").cast("long").alias("n"))


@query(
    "srt9_stratified_sample",
    "SELECT bucket, id FROM (SELECT o_orderpriority AS bucket, o_orderkey AS id, row_number() OVER (PARTITION BY o_orderpriority ORDER BY md5(o_orderkey || ':42'), o_orderkey) AS rn FROM orders) WHERE rn = 1 OR rn % 100 = 0",
)
def srt9(spark, sf_dir):
    """A sample (which is the feature): of each stratum the first in a seeded random order, then every hundredth."""
    w = Window.partitionBy("bucket").orderBy(F.md5(F.concat(F.col("id").cast("string"), F.lit(":42"))), "id")
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("bucket"), F.col("o_orderkey").alias("id"))
    return rows.withColumn("rn", F.row_number().over(w)).where("rn = 1 OR rn % 100 = 0").select("bucket", "id")


@query("mth5_budget_gate", PRELUDE + "SELECT case_id, cost, sum(cost) OVER (PARTITION BY volume ORDER BY case_id) AS spent, sum(cost) OVER (PARTITION BY volume ORDER BY case_id) <= 100000 AS allowed FROM (SELECT volume, case_id, CAST(floor(price / 4) AS BIGINT) + 500 AS cost FROM cases)")
def mth5(spark, sf_dir):
    """Estimated cost of calls against a budget per volume, in order."""
    w = Window.partitionBy("volume").orderBy("case_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    c = cases(spark, sf_dir).select("volume", "case_id", (F.floor(F.col("price") / 4).cast("long") + 500).alias("cost")).withColumn("spent", F.sum("cost").over(w))
    return c.select("case_id", "cost", "spent", (F.col("spent") <= 100000).alias("allowed"))


@query(
    "src5_searchable_probe",
    """WITH t AS (SELECT conv_id, turn, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS i, count(*) OVER (PARTITION BY conv_id) AS n FROM conversations),
    p AS (SELECT DISTINCT conv_id, i, length(trim(text)) >= 50 AS ok FROM t JOIN range(0, 5) s(k) ON i = (k * n) // 5)
    SELECT conv_id, count(*) AS sampled, count(*) FILTER (ok) * 2 > count(*) AS searchable FROM p GROUP BY 1""",
)
def src5(spark, sf_dir):
    """Five evenly spaced pages decide whether a text is readable: more than half have fifty characters."""
    w = Window.partitionBy("conv_id")
    t = table(spark, sf_dir, "conversations").select("conv_id", "text", (F.row_number().over(w.orderBy("turn")) - 1).alias("i"), F.count("*").over(w).alias("n"))
    picks = F.array(*[F.floor(F.col("n") * k / 5).cast("int") for k in range(5)])
    p = t.where(F.array_contains(picks, F.col("i"))).withColumn("ok", F.length(F.trim("text")) >= 50)
    return p.groupBy("conv_id").agg(F.count("*").alias("sampled"), (F.count_if("ok") * 2 > F.count("*")).alias("searchable"))


@query("src6_block_order", "SELECT conv_id, md5(string_agg(role || ': ' || text, chr(10) || chr(10) ORDER BY turn)) AS digest, count(*) AS n FROM conversations WHERE trim(text) <> '' GROUP BY 1")
def src6(spark, sf_dir):
    """Blocks joined in page order; a document's blocks are bounded by the document."""
    b = table(spark, sf_dir, "conversations").where(F.trim("text") != "").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", F.concat("role", F.lit(": "), "text").alias("b")))).alias("bs"))
    return b.select("conv_id", F.md5(F.array_join(F.transform("bs", lambda x: x["b"]), "\n\n")).alias("digest"), F.size("bs").cast("long").alias("n"))


@query("prj2_prj3_fields", "SELECT page_id, TRY_CAST(nullif(regexp_extract(url, '(\\d+)', 1), '') AS INTEGER) AS first_number, TRY_CAST(nullif(regexp_extract(url, 'page=(\\d+)', 1), '') AS DOUBLE) AS page FROM pages")
def prj2(spark, sf_dir):
    """Numbers parsed out of text; null where there is none."""
    return table(spark, sf_dir, "pages").select("page_id", F.regexp_extract("url", r"(\d+)", 1).try_cast("int").alias("first_number"), F.regexp_extract("url", r"page=(\d+)", 1).try_cast("double").alias("page"))


@query("inc4_resume", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def inc4(spark, sf_dir):
    """What is left to do: everything without a result yet."""
    return table(spark, sf_dir, "documents").select("doc_id").join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_anti")


@query("events_by_day", "SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def events_by_day(spark, sf_dir):
    """Events per day and type, as the stream's windows count them."""
    return table(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("day"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))
