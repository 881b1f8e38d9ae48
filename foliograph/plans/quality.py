"""Queries over repair by groups, comparison, merge, increments and scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliograph.functions import fields
from foliograph.operators import records
from foliograph.operators.steps import dealt
from foliograph.plans.base import PRELUDE, cases, n_votes, table, votes
from foliograph.plans.registry import query


def skewed(spark, sf_dir):
    """Cases whose date is three years off for every 97th one, as a misread digit would make it."""
    bad = F.col("case_id") % 97 == 0
    return cases(spark, sf_dir).withColumn("date", F.when(bad, F.date_add("date", 1100)).otherwise(F.col("date")))


SKEWED = PRELUDE + ", sk AS (SELECT case_id, volume, CASE WHEN case_id % 97 = 0 THEN d + 1100 ELSE d END AS d FROM cases)"
MEDIAN = SKEWED + """, md AS (SELECT volume, CASE WHEN n >= 3 THEN (list_sort(ds))[n // 2 + 1] END AS median FROM (SELECT volume, list(d) AS ds, count(d) AS n FROM sk GROUP BY 1))"""


@query("agg14_upper_median_date", MEDIAN + " SELECT volume, median FROM md")
def agg14(spark, sf_dir):
    return records.upper_median(skewed(spark, sf_dir), "volume", "date")


@query("dt7_date_outliers", MEDIAN + " SELECT case_id, d AS date, median, coalesce(abs(datediff('day', median, d)) > 730, false) AS is_outlier FROM sk JOIN md USING (volume)")
def dt7(spark, sf_dir):
    return records.outliers(skewed(spark, sf_dir), "volume", "date").select("case_id", "date", "median", "is_outlier")


@query(
    "jn1_era_of_volume",
    PRELUDE + """, sp AS (SELECT 200 + case_id % 820 AS vol FROM cases) SELECT CASE WHEN vol BETWEEN 121 AND 260 THEN 'era1' WHEN vol BETWEEN 261 AND 500 THEN 'era2' WHEN vol BETWEEN 501 AND 700 THEN 'era3' WHEN vol BETWEEN 701 AND 900 THEN 'era4'
    WHEN vol BETWEEN 901 AND 999 THEN 'era5' ELSE 'era1' END AS era, count(*) AS n_cases, count(DISTINCT vol) AS n_volumes FROM sp GROUP BY 1""",
)
def jn1(spark, sf_dir):
    """Volumes to eras by inclusive ranges; era1 where none fits."""
    vol = cases(spark, sf_dir).select((200 + F.col("case_id") % 820).alias("vol"))
    return vol.groupBy(fields.era(F.col("vol")).alias("era")).agg(F.count("*").alias("n_cases"), F.countDistinct("vol").alias("n_volumes"))


@query(
    "agg4_era_metrics",
    PRELUDE + """, x AS (SELECT volume, price, CASE WHEN volume < 246 THEN 'early' ELSE 'late' END AS era FROM cases),
    e AS (SELECT era, count(*) AS n_cases, count(DISTINCT volume) AS volumes, count(*) FILTER (price < 50000) AS low, sum(price) AS total FROM x GROUP BY 1)
    SELECT era, n_cases, volumes, low, round(total / n_cases, 2) AS mean_price FROM e UNION ALL SELECT 'TOTAL', sum(n_cases), sum(volumes), sum(low), round(sum(total) / sum(n_cases), 2) FROM e""",
)
def agg4(spark, sf_dir):
    """Per-era metrics and a TOTAL row that adds up the eras' rows (not a rollup: volumes add)."""
    era = F.when(F.col("volume") < 246, "early").otherwise("late").alias("era")
    e = cases(spark, sf_dir).groupBy(era).agg(F.count("*").alias("n_cases"), F.countDistinct("volume").alias("volumes"), F.count_if(F.col("price") < 50000).alias("low"), F.sum("price").alias("total"))
    total = e.agg(F.lit("TOTAL").alias("era"), *[F.sum(c).alias(c) for c in ("n_cases", "volumes", "low", "total")])
    return e.union(total).withColumn("mean_price", F.round(F.col("total") / F.col("n_cases"), 2)).drop("total")


@query(
    "jn16_before_after_by_volume",
    PRELUDE + """, b AS (SELECT volume, count(*) AS n FROM cases WHERE division <> 'P' GROUP BY 1), a AS (SELECT volume, count(*) AS n FROM cases WHERE priority <> '5-LOW' GROUP BY 1)
    SELECT volume, coalesce(b.n, 0) AS before_n, coalesce(a.n, 0) AS after_n, coalesce(a.n, 0) - coalesce(b.n, 0) AS change FROM b FULL JOIN a USING (volume)""",
)
def jn16(spark, sf_dir):
    c = cases(spark, sf_dir)
    b = c.where("division <> 'P'").groupBy("volume").agg(F.count("*").alias("b"))
    a = c.where("priority <> '5-LOW'").groupBy("volume").agg(F.count("*").alias("a"))
    both = b.join(a, "volume", "full").select("volume", F.coalesce("b", F.lit(0)).alias("before_n"), F.coalesce("a", F.lit(0)).alias("after_n"))
    return both.withColumn("change", F.col("after_n") - F.col("before_n"))


@query("jn15_last_duplicate", PRELUDE + "SELECT party, volume, max_by(case_id, (d, case_id)) AS case_id FROM cases GROUP BY ALL")
def jn15(spark, sf_dir):
    """The last of repeated (party, volume) keys."""
    return records.last_per_key(cases(spark, sf_dir).select("party", "volume", "date", "case_id"), ["party", "volume"], ["date", "case_id"]).select("party", "volume", "case_id")


@query(
    "agg11_length_outliers",
    """SELECT doc_id, n_chars FROM (SELECT doc_id, n_chars, lang, avg(n_chars) OVER w AS m, stddev_samp(n_chars) OVER w AS s, count(*) OVER w AS n FROM documents WINDOW w AS (PARTITION BY lang)) WHERE n >= 5 AND n_chars > m + 3 * s""",
)
def agg11(spark, sf_dir):
    """Values above mean + 3 sample deviations of their group of five or more; statistics are joined back."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    stats = docs.groupBy(F.col("lang").alias("of")).agg(F.avg("n_chars").alias("m"), F.stddev_samp("n_chars").alias("s"), F.count("*").alias("n")).where("n >= 5")
    return docs.join(stats, F.col("lang").eqNullSafe(F.col("of"))).where("n_chars > m + 3 * s").select("doc_id", "n_chars")


@query(
    "agg12_histogram",
    PRELUDE + """, b AS (SELECT CASE WHEN price < 50000 THEN 0 WHEN price < 150000 THEN 1 WHEN price < 300000 THEN 2 ELSE 3 END AS bucket FROM cases)
    SELECT CAST(t.i AS INTEGER) AS bucket, count(b.bucket) AS n FROM range(0, 5) t(i) LEFT JOIN b ON b.bucket = t.i GROUP BY 1""",
)
def agg12(spark, sf_dir):
    """Counts per bucket with empty ones filled in."""
    bucket = F.when(F.col("price") < 50000, 0).when(F.col("price") < 150000, 1).when(F.col("price") < 300000, 2).otherwise(3)
    counts = cases(spark, sf_dir).groupBy(bucket.alias("bucket")).agg(F.count("*").alias("c"))
    return spark.range(5).select(F.col("id").cast("int").alias("bucket")).join(counts, "bucket", "left").select("bucket", F.coalesce("c", F.lit(0)).alias("n"))


@query(
    "agg17_label_scores",
    """WITH s AS (SELECT lang, n_chars > 1500 AS guess, quality = 1 AS truth FROM documents JOIN labels USING (doc_id)),
    c AS (SELECT lang, count(*) FILTER (guess AND truth) AS tp, count(*) FILTER (guess AND NOT truth) AS fp, count(*) FILTER (NOT guess AND truth) AS fn FROM s GROUP BY 1),
    u AS (SELECT * FROM c UNION ALL SELECT 'micro', sum(tp), sum(fp), sum(fn) FROM c)
    SELECT lang AS label, tp, fp, fn, round(coalesce(tp / nullif(tp + fp, 0), 0), 4) AS precision, round(coalesce(tp / nullif(tp + fn, 0), 0), 4) AS recall, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 4) AS f1 FROM u""",
)
def agg17(spark, sf_dir):
    s = table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("label"), (F.col("n_chars") > 1500).alias("guess")).join(table(spark, sf_dir, "labels").select("doc_id", (F.col("quality") == 1).alias("truth")), "doc_id")
    g, t = F.col("guess"), F.col("truth")
    c = s.groupBy("label").agg(F.count_if(g & t).alias("tp"), F.count_if(g & ~t).alias("fp"), F.count_if(~g & t).alias("fn"))
    both = c.union(c.agg(F.lit("micro").alias("label"), *[F.sum(x).alias(x) for x in ("tp", "fp", "fn")]))
    return both.withColumns(records.prf(F.col("tp"), F.col("fp"), F.col("fn")))


@query(
    "set4_keyed_merge",
    PRELUDE + """, prev AS (SELECT case_id, volume AS label, CASE WHEN priority = '1-URGENT' THEN 'llm' ELSE 'regex' END AS method, price FROM cases WHERE division <> 'O'),
    cur AS (SELECT case_id, volume AS label, 'regex' AS method, price + 1 AS price FROM cases WHERE priority <> '5-LOW')
    SELECT coalesce(c.case_id, p.case_id) AS case_id, coalesce(c.label, p.label) AS label, CASE WHEN p.method = 'llm' OR c.method IS NULL THEN p.method ELSE c.method END AS method,
    CASE WHEN p.method = 'llm' OR c.method IS NULL THEN p.price ELSE c.price END AS price FROM cur c FULL JOIN prev p ON c.case_id = p.case_id AND c.label = p.label""",
)
def set4(spark, sf_dir):
    """Closed cases are the earlier result, all but the low-priority ones the current one; urgent ones came from 'llm'."""
    label, method = F.col("volume").alias("label"), F.when(F.col("priority") == "1-URGENT", "llm").otherwise("regex").alias("method")
    c = cases(spark, sf_dir)
    previous = c.where("division <> 'O'").select("case_id", label, method, "price", F.lit(1).alias("ord"))
    current = c.where("priority <> '5-LOW'").select("case_id", label, F.lit("regex").alias("method"), (F.col("price") + 1).alias("price"))
    return records.merge_keyed(previous, current, ["case_id", "label"])


@query(
    "inc1_reprocess_reasons",
    """WITH m AS (SELECT doc_id, CASE WHEN lang = 'fr' THEN 'failed' ELSE 'done' END AS status, CASE WHEN lang = 'de' THEN n_chars + 1 ELSE n_chars END AS mtime FROM documents WHERE lang <> 'es')
    SELECT CASE WHEN status IS NULL THEN 'missing' WHEN status <> 'done' THEN 'not_done' WHEN m.mtime <> n_chars THEN 'changed' ELSE 'up_to_date' END AS reason, count(*) AS n FROM documents LEFT JOIN m USING (doc_id) GROUP BY 1""",
)
def inc1(spark, sf_dir):
    """The gate of incremental runs over a manifest; sizes stand for modification times, languages for what happened."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    status = F.when(F.col("lang") == "fr", "failed").otherwise("done").alias("status")
    manifest = docs.where("lang <> 'es'").select("doc_id", status, F.when(F.col("lang") == "de", F.col("n_chars") + 1).otherwise(F.col("n_chars")).alias("mtime"))
    reason = records.reprocess_reason(F.lit(False), F.col("status"), F.col("mtime"), F.col("n_chars"))
    return docs.join(manifest, "doc_id", "left").groupBy(reason.alias("reason")).agg(F.count("*").alias("n"))


@query("snk2_upsert", "SELECT doc_id, CASE WHEN lang IN ('de', 'fr') THEN 'new' ELSE 'old' END AS version FROM documents WHERE lang <> 'es'")
def snk2(spark, sf_dir):
    """German documents are in both tables."""
    ids = table(spark, sf_dir, "documents").select("doc_id", "lang")
    old, new = (ids.where(F.col("lang").isin(*langs)).select("doc_id", F.lit(v).alias("version")) for v, langs in (("old", ("en", "de")), ("new", ("de", "fr"))))
    return records.upsert(old, new, "doc_id")


@query(
    "set6_four_way_diff",
    """WITH spans AS (SELECT DISTINCT l_orderkey AS case_id, l_linenumber AS label, l_linenumber * 10 AS s, l_linenumber * 10 + CAST(l_quantity AS INTEGER) AS e, l_returnflag AS f FROM lineitem),
    b AS (SELECT DISTINCT case_id, label, s, e FROM spans WHERE f <> 'A'), a AS (SELECT DISTINCT case_id, CASE WHEN label >= 4 THEN label + 100 ELSE label END AS label, s, e FROM spans WHERE f <> 'N'),
    k AS (SELECT CASE WHEN a.label IS NULL THEN 'removed' WHEN b.label IS NULL THEN 'added' WHEN a.label = b.label THEN 'exact' ELSE 'label_changed' END AS kind FROM b FULL JOIN a ON a.case_id = b.case_id AND a.s = b.s AND a.e = b.e)
    SELECT kind, count(*) AS n FROM k GROUP BY 1""",
)
def set6(spark, sf_dir):
    start = (F.col("l_linenumber") * 10).alias("s")
    label = F.col("l_linenumber").alias("label")
    lines = dealt(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag"), n_votes(spark, sf_dir), "l_orderkey")
    place = [F.col("l_orderkey").alias("case_id"), start, (F.col("l_linenumber") * 10 + F.col("l_quantity").cast("int")).alias("e")]
    before = lines.where("l_returnflag <> 'A'").select(label, *place).distinct()
    after = lines.where("l_returnflag <> 'N'").select(F.when(F.col("l_linenumber") >= 4, F.col("l_linenumber") + 100).otherwise(F.col("l_linenumber")).alias("label"), *place).distinct()
    return records.four_way(before, after).groupBy("kind").agg(F.count("*").alias("n"))


@query(
    "mth1_iou",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN least(l_linenumber * 3 + l_quantity, 40.0) > greatest(l_linenumber * 3, 10) THEN
    (least(l_linenumber * 3 + l_quantity, 40.0) - greatest(l_linenumber * 3, 10)) / (l_quantity + 30 - (least(l_linenumber * 3 + l_quantity, 40.0) - greatest(l_linenumber * 3, 10))) ELSE 0.0 END AS iou FROM lineitem""",
)
def mth1(spark, sf_dir):
    s = F.col("l_linenumber") * 3
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", records.iou(s, s + F.col("l_quantity"), F.lit(10), F.lit(40.0)).alias("iou"))


@query(
    "mth4_overlap_check",
    PRELUDE + """, sp AS (SELECT DISTINCT l_orderkey AS case_id, l_linenumber * 8 AS s, l_linenumber * 8 + CAST(l_quantity AS INTEGER) AS e FROM lineitem)
    SELECT a.case_id, count(*) AS n_overlaps FROM sp a JOIN sp b ON a.case_id = b.case_id AND (a.s, a.e) < (b.s, b.e) AND a.s < b.e AND b.s < a.e GROUP BY 1""",
)
def mth4(spark, sf_dir):
    """Pairs of different spans of a case that overlap; a case has as many spans as lines."""
    s = (F.col("l_linenumber") * 8).alias("s")
    sp = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("case_id"), s, (F.col("l_linenumber") * 8 + F.col("l_quantity").cast("int")).alias("e")).distinct()
    a, b = sp, sp.select("case_id", F.col("s").alias("s2"), F.col("e").alias("e2"))
    return a.join(b, "case_id").where("struct(s, e) < struct(s2, e2) AND s < e2 AND s2 < e").groupBy("case_id").agg(F.count("*").alias("n_overlaps"))


@query(
    "jn7_member_in_office",
    PRELUDE + """, t AS (SELECT member, member // 3 AS name, min(d) AS s, max(d) AS e FROM votes GROUP BY ALL), c AS (SELECT DISTINCT case_id, d, member // 3 AS name FROM votes),
    r AS (SELECT case_id, c.name, member, row_number() OVER (PARTITION BY case_id, c.name ORDER BY (s - 365 <= d AND d <= e + 730) DESC, s DESC, member) AS rn FROM c JOIN t ON t.name = c.name)
    SELECT case_id, name, member FROM r WHERE rn = 1""",
)
def jn7(spark, sf_dir):
    """As-of disambiguation: of the members who share a name the one in office, else the latest."""
    name = F.floor(F.col("member") / 3).alias("name")
    v = votes(spark, sf_dir)
    terms = v.groupBy("member").agg(F.min("date").alias("s"), F.max("date").alias("e")).select("member", name, "s", "e")
    asked = v.select("case_id", "date", name).distinct()
    in_office = (F.date_sub("s", 365) <= F.col("date")) & (F.col("date") <= F.date_add("e", 730))
    # the best candidate is a grouped minimum, which is combined before its shuffle
    best = F.min_by("member", F.struct((~in_office).alias("out"), (-F.unix_date("s")).alias("late"), "member"))
    # dealt by name on both sides, where the groups by case and name are, too
    n = n_votes(spark, sf_dir)
    return dealt(asked, n, "name").join(dealt(terms, n, "name"), "name").groupBy("case_id", "name").agg(best.alias("member"))
