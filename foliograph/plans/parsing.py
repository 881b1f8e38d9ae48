"""Render-then-parse queries: the tables are written out as court text, parsed, and held against themselves."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from foliograph.functions import fields
from foliograph.operators import boundaries, case_scan, records, records_text, registry_names, sections
from foliograph.plans.base import PRELUDE, cases, table, votes
from foliograph.plans.registry import query


def numbered(rendered):
    """(volume, line_no, line) of cases with their lines (volume, case_id, parts): a case's first number comes from the
    sizes of those before it, so that only cases are sorted, not lines."""
    n = F.size("parts")
    before = F.sum(n).over(Window.partitionBy("volume").orderBy("case_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - n
    # a step of its own: beside a generator a window would run over its rows
    placed = rendered.withColumn("before", before)
    return placed.select("volume", "before", F.posexplode("parts").alias("i", "line")).select("volume", (F.col("before") + F.col("i") + 1).cast("int").alias("line_no"), "line")


def volume_lines(spark, sf_dir):
    """(volume, line_no, line): every case of a month as a few lines of court text, one after the other."""
    c = cases(spark, sf_dir)
    parts = F.array(
        F.element_at(F.array(*map(F.lit, ("FIRST DIVISION", "EN BANC", "SECOND DIVISIION.", "THIRD DIVISON"))), F.pmod(F.col("party"), F.lit(4)).cast("int") + 1), F.lit(""),
        F.concat(F.lit("[G.R. No. "), F.col("case_id").cast("string"), F.lit(". "), F.date_format("date", "MMMM d, yyyy"), F.lit("]")),
        F.concat(F.lit("Customer "), F.col("party").cast("string"), F.lit(", petitioner, vs. STATE, respondent.")), F.lit("DECISION"), *[F.lit(f"Line {k} of the reasoning.") for k in range(8)], F.lit("SO ORDERED."),
    )
    return numbered(c.select("volume", "case_id", parts.alias("parts")))


@query("fsm1_str11_case_boundaries", PRELUDE + "SELECT volume, case_id, d AS date, CAST((row_number() OVER (PARTITION BY volume ORDER BY case_id) - 1) * 14 + 1 AS INTEGER) AS start_line FROM cases")
def fsm1(spark, sf_dir):
    found = case_scan.boundaries(case_scan.classified(volume_lines(spark, sf_dir)))
    number, when = case_scan.bracket_parts(F.element_at("brackets", 1))
    return found.select("volume", number.try_cast("long").alias("case_id"), F.try_to_timestamp(when, F.lit("MMMM d, yyyy")).cast("date").alias("date"), "start_line")


def vote_statements(spark, sf_dir):
    """(case_id, raw): the votes of a case in one sentence with a verb for each side, then who joins whose dissent."""
    name = F.concat(F.lit("Member"), F.col("member").cast("string"))
    v = votes(spark, sf_dir).select("case_id", "role", "member", name.alias("name")).distinct()
    lists = v.groupBy("case_id").agg(*[F.transform(F.sort_array(F.collect_list(F.when(F.col("role") == r, F.struct("member", "name")))), lambda x: x["name"]).alias(r) for r in ("majority", "dissent")])
    both = F.array_compact(F.array(*[F.when(F.size(r) > 0, F.concat(F.array_join(r, ", "), F.lit(f", JJ., {verb}"))) for r, verb in (("majority", "con- cur"), ("dissent", "dissent"))]))
    others = F.slice("dissent", 2, 100)
    joins = F.when(F.size("dissent") > 1, F.concat(F.lit(" "), F.array_join(others, " and "), F.lit(", JJ., join the dissenting opinion of Justice "), F.get("dissent", 0), F.lit("."))).otherwise("")
    return lists.select("case_id", F.concat(F.array_join(both, " and "), F.lit(".")).alias("raw"), joins.alias("joins"))


@query("fsm7_vote_statements", PRELUDE + "SELECT DISTINCT case_id, CASE role WHEN 'dissent' THEN 'dissenting' ELSE 'concurring' END AS category, 'Member' || member AS name FROM votes")
def fsm7(spark, sf_dir):
    return records_text.votes_in(vote_statements(spark, sf_dir), "case_id", "raw").select("case_id", "category", "name").distinct()


@query(
    "fsm9_joined_dissents",
    PRELUDE + ", d AS (SELECT DISTINCT case_id, member FROM votes WHERE role = 'dissent') SELECT d.case_id, 'Member' || d.member AS joiner, 'Member' || t.member AS target FROM d JOIN (SELECT case_id, min(member) AS member FROM d GROUP BY 1) t ON t.case_id = d.case_id AND t.member < d.member",
)
def fsm9(spark, sf_dir):
    """Who joins whose dissent, parsed from the text; these pairs are the third kind of edge."""
    return records_text.joined_dissents(vote_statements(spark, sf_dir), "case_id", "joins")


def nation_statements(spark, sf_dir):
    """(case_id, raw): the nations of each side as misread names, every third list with two of them run together."""
    v = votes(spark, sf_dir).select("case_id", "role", "member")
    nations = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("member"), F.col("s_nationkey").alias("n_nationkey")).join(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"), "n_nationkey")
    said = F.when((F.length("n_name") >= 7) & ((F.col("case_id") + F.col("n_nationkey")) % 4 == 1), F.concat(F.lit("X"), F.expr("substring(n_name, 2)"))).otherwise(F.initcap("n_name"))
    named = v.join(nations, "member").select("case_id", "role", "n_nationkey", said.alias("said")).distinct()
    lists = named.groupBy("case_id").agg(*[F.transform(F.sort_array(F.collect_list(F.when(F.col("role") == r, F.struct("n_nationkey", "said")))), lambda x: x["said"]).alias(r) for r in ("majority", "dissent")])
    run = lambda c: F.when((F.col("case_id") % 3 == 0) & (F.size(c) >= 2), F.concat(F.get(c, 0), F.lit(" "), F.array_join(F.slice(c, 2, 100), ", "))).otherwise(F.array_join(c, ", "))
    stranger = F.when(F.col("case_id") % 5 == 0, ", Zzyzx").otherwise("")
    parts = F.array_compact(F.array(F.when(F.size("majority") > 0, F.concat(run("majority"), stranger, F.lit(", JJ., concur"))), F.when(F.size("dissent") > 0, F.concat(run("dissent"), F.lit(", JJ., dissent")))))
    return lists.select("case_id", F.concat(F.array_join(parts, " and "), F.lit(".")).alias("raw"))


@query(
    "fsm8_registry_names",
    PRELUDE + """, n AS (SELECT s_suppkey AS member, upper(n_name) AS name FROM supplier JOIN nation ON s_nationkey = n_nationkey)
    SELECT DISTINCT case_id, CASE role WHEN 'dissent' THEN 'dissenting' ELSE 'concurring' END AS category, name FROM votes JOIN n USING (member)
    UNION ALL SELECT DISTINCT case_id, 'unmatched', 'Zzyzx' FROM votes WHERE role = 'majority' AND case_id % 5 = 0""",
)
def fsm8(spark, sf_dir):
    """Names of votes as a registry has them: misread, run together, of two words, and one that nobody has."""
    registry = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("ord"), F.col("n_name").alias("name"))
    return registry_names.named_votes(nation_statements(spark, sf_dir), "case_id", "raw", registry)


@query(
    "jn5_registry_persons",
    """WITH p AS (SELECT n_name, s_suppkey, min(s_suppkey) OVER (PARTITION BY n_name) AS head FROM supplier JOIN nation ON s_nationkey = n_nationkey)
    SELECT n_name || CASE WHEN s_suppkey = head THEN ', JR.' ELSE '' END AS name, 'P' || s_suppkey || ' ' || n_name || CASE WHEN s_suppkey = head THEN ', Jr.' ELSE '' END AS person FROM p""",
)
def jn5(spark, sf_dir):
    """Registry names with and without "Jr." to persons: the one junior of a nation is claimed by the name that needs one."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    own = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").alias("n_nationkey")).join(nation, "n_nationkey")
    head = own.groupBy("n_nationkey").agg(F.min("s_suppkey").alias("head"))
    junior = F.when(F.col("s_suppkey") == F.col("head"), ", Jr.").otherwise("")
    persons = own.join(head, "n_nationkey").select(F.concat(F.lit("P"), F.col("s_suppkey").cast("string"), F.lit(" "), "n_name", junior).alias("person"))
    names = nation.select("n_nationkey", F.explode(F.array(F.concat("n_name", F.lit(", JR.")), F.col("n_name"))).alias("name"))
    registry = names.select((F.col("n_nationkey") * 2 + F.when(F.col("name").endswith("JR."), 0).otherwise(1)).alias("ord"), "name")
    return registry_names.registry_persons(registry, persons)


@query(
    "jn10_str17_surnames",
    PRELUDE + """, t AS (SELECT member, bloc, 'Name' || (member % 7) AS surname FROM members), asked AS (SELECT case_id, bloc, 'Name' || (member % 7) AS surname FROM votes)
    SELECT asked.case_id, asked.bloc, asked.surname, min(t.member) AS member FROM asked JOIN t ON t.bloc = asked.bloc AND t.surname = asked.surname GROUP BY ALL""",
)
def jn10(spark, sf_dir):
    """Names as cases spell them to members: same appointer and same last word, suffixes apart; the first one counts."""
    from foliograph.plans.base import members

    surname = F.concat(F.lit("Name"), F.col("member") % 7)
    known = members(spark, sf_dir).select("bloc", "member", fields.surname_key(F.concat(F.lit("A. B. "), surname, F.lit(", Jr."))).alias("key")).groupBy("bloc", "key").agg(F.min("member").alias("member"))
    asked = votes(spark, sf_dir).select("case_id", "bloc", surname.alias("surname")).distinct().withColumn("key", fields.surname_key(F.upper("surname")))
    return asked.join(known, ["bloc", "key"]).select("case_id", "bloc", "surname", "member")


@query("jn6_fuzzy_names", "SELECT r_name AS name, left(r_name, length(r_name) - 1) || 'X' AS token FROM region UNION ALL SELECT r_name, lower(r_name) FROM region")
def jn6(spark, sf_dir):
    """Region names in lower case (exact tier) and with a wrong last letter (similarity tier) find their names."""
    names = table(spark, sf_dir, "region").select(F.col("r_name").alias("name"))
    wrong = names.select(F.expr("concat(left(name, length(name) - 1), 'X')").alias("token"))
    return records_text.best_match(wrong.union(names.select(F.lower("name"))), names).select("name", "token")


@query("dt6_digit_repair", PRELUDE + "SELECT case_id, d AS date FROM cases WHERE year(d) IN (1998, 1995)")
def dt6(spark, sf_dir):
    """Years with a confused last digit (1998 as 1990, 1995 as 1998) are repaired by the volume's median date."""
    c = cases(spark, sf_dir)
    medians = records.upper_median(c, "volume", "date", 1)
    broken = c.where(F.year("date").isin(1998, 1995)).withColumn("seen", F.when(F.year("date") == 1998, F.add_months("date", -60)).otherwise(F.add_months("date", -24)))
    broken = broken.where(F.dayofmonth("seen") == F.dayofmonth("date"))
    return broken.join(medians, "volume").select("case_id", records_text.repaired_dates(broken, "seen", "median").alias("date"))


@query(
    "mth3_confidence",
    PRELUDE + """, k AS (SELECT case_id, count(*) AS n, count(DISTINCT member) AS nm, bool_or(role = 'dissent') AS dis FROM votes GROUP BY 1),
    sp AS (SELECT DISTINCT l_orderkey AS case_id, l_linenumber * 20 AS s, l_linenumber * 20 + CAST(l_quantity AS BIGINT) AS e FROM lineitem),
    o AS (SELECT case_id, bool_or(s < coalesce(before, 0)) AS overlap FROM (SELECT *, max(e) OVER (PARTITION BY case_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM sp) GROUP BY 1)
    SELECT cases.case_id, round(0.3 * CASE WHEN n IS NOT NULL THEN 1 ELSE 0 END + 0.1 * CASE WHEN price > 20000 THEN 1 ELSE 0.5 END + 0.1 * CASE WHEN n BETWEEN 2 AND 6 THEN 1 ELSE 0 END + 0.1 * CASE WHEN dis THEN 0.5 ELSE 1 END
    + 0.2 * CASE WHEN nm = n THEN 1 ELSE 0.5 END + 0.1 * CASE WHEN overlap THEN 0 ELSE 1 END + 0.1 * CASE cases.case_id % 3 WHEN 0 THEN 1 WHEN 1 THEN 0.5 ELSE 0 END, 3) AS score FROM cases LEFT JOIN k USING (case_id) LEFT JOIN o USING (case_id)""",
)
def mth3(spark, sf_dir):
    """Seven weighted checks of a case in one score, among them spans that overlap and a date that doesn't read as one."""
    k = votes(spark, sf_dir).groupBy("case_id").agg(F.count("*").alias("n"), F.countDistinct("member").alias("nm"), F.max(F.col("role") == "dissent").alias("dis"))
    s = F.col("l_linenumber") * 20
    sp = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("case_id"), s.alias("s"), (s + F.col("l_quantity").cast("long")).alias("e")).distinct()
    before = F.max("e").over(Window.partitionBy("case_id").orderBy("s", "e").rowsBetween(Window.unboundedPreceding, -1))
    o = sp.withColumn("before", before).groupBy("case_id").agg(F.max(F.col("s") < F.coalesce("before", F.lit(0))).alias("overlap"))
    d = F.date_format("date", "MMMM d, yyyy")
    said = F.when(F.col("case_id") % 3 == 0, d).when(F.col("case_id") % 3 == 1, F.concat(F.lit("("), d, F.lit(")"))).otherwise("n.d.")
    part = lambda test, yes, no: F.when(test, F.lit(float(yes))).otherwise(F.lit(float(no)))
    checks = [
        (0.3, part(F.col("n").isNotNull(), 1, 0)), (0.1, part(F.col("price") > 20000, 1, 0.5)), (0.1, part(F.col("n").between(2, 6), 1, 0)), (0.1, part(F.col("dis"), 0.5, 1)),
        (0.2, part(F.col("nm") == F.col("n"), 1, 0.5)), (0.1, part(F.col("overlap"), 0, 1)), (0.1, fields.date_validity(said)),
    ]
    rows = cases(spark, sf_dir).join(k, "case_id", "left").join(o, "case_id", "left")
    return rows.select("case_id", F.round(sum((w * c for w, c in checks), F.lit(0.0)), 3).alias("score"))


@query("fsm10_greedy_spans")
def fsm10(spark, sf_dir):
    """Spans of lines matched with themselves moved by one: greedy, so without a SQL twin; tests check it by hand."""
    s, e = F.col("l_linenumber").cast("long") * 40, F.col("l_linenumber").cast("long") * 40 + F.col("l_quantity").cast("long") + 5
    truth = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("case_id"), s.alias("s"), e.alias("e"))
    return records_text.greedy_spans(truth, truth.withColumns({"s": F.col("s") + 1, "e": F.col("e") + 1}), ["case_id"])


@query(
    "win7_entered_exited",
    PRELUDE + """, m AS (SELECT DISTINCT k, member FROM placed WHERE role = 'dissent' AND bloc <> 'ASIA')
    SELECT win.k, (SELECT count(*) FROM m WHERE m.k = win.k AND member NOT IN (SELECT member FROM m p WHERE p.k = win.k - 1)) AS entered,
    (SELECT count(*) FROM m WHERE m.k = win.k - 1 AND member NOT IN (SELECT member FROM m p WHERE p.k = win.k)) AS exited FROM win""",
)
def win7(spark, sf_dir):
    """Members who enter or leave the set of dissenters between windows, by anti joins with the shifted set."""
    from foliograph.operators.windows import bounds, windows
    from foliograph.plans.base import WINDOW
    from foliograph.plans.court import placed

    m = placed(spark, sf_dir).where("role = 'dissent' AND bloc <> 'ASIA'").select("k", "member").distinct()
    before = m.select((F.col("k") + 1).alias("k"), "member")
    entered = m.join(before, ["k", "member"], "left_anti").groupBy("k").agg(F.count("*").alias("x"))
    exited = before.join(m, ["k", "member"], "left_anti").groupBy("k").agg(F.count("*").alias("y"))
    w = windows(bounds(cases(spark, sf_dir)), WINDOW).select("k")
    return w.join(entered, "k", "left").join(exited, "k", "left").select("k", F.coalesce("x", F.lit(0)).alias("entered"), F.coalesce("y", F.lit(0)).alias("exited"))


@query("agg16_argmax_first", "SELECT l_suppkey AS member, min_by(l_partkey, (-l_quantity, l_partkey)) AS part FROM lineitem GROUP BY 1")
def agg16(spark, sf_dir):
    """The value with the largest measure, the first one on ties."""
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("member")).agg(F.min_by("l_partkey", F.struct(-F.col("l_quantity"), "l_partkey")).alias("part"))


@query("agg1_table_summary", "SELECT count(*) AS n, count(*) FILTER (lang = 'en') AS n_english, CAST(sum(n_chars) AS BIGINT) AS declared, CAST(coalesce(sum(length(text)), 0) AS BIGINT) AS counted FROM documents")
def agg1(spark, sf_dir):
    return table(spark, sf_dir, "documents").agg(F.count("*").alias("n"), F.count_if(F.col("lang") == "en").alias("n_english"), F.sum("n_chars").alias("declared"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("counted"))


@query("str1_clean_text", """SELECT doc_id, md5(trim(regexp_replace(regexp_replace(regexp_replace(text, '\\n{3,}', chr(10) || chr(10), 'g'), '(?m)[ \\t]+$', '', 'g'), ' {2,}', ' ', 'g'), ' ' || chr(10) || chr(9))) AS cleaned FROM documents""")
def str1(spark, sf_dir):
    """Runs of blank lines and spaces shortened, line ends and the text's ends trimmed; by digest."""
    t = F.regexp_replace(F.regexp_replace(F.regexp_replace("text", "\n{3,}", "\n\n"), r"(?m)[ \t]+$", ""), " {2,}", " ")
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(F.btrim(t, F.lit(" \n\t"))).alias("cleaned"))


def case_lines(spark, sf_dir):
    """(volume, case_id, line_no, line): cases with all their sections as court text, the body of two to four lines."""
    body = F.transform(F.sequence(F.lit(1), (F.col("case_id") % 3 + 2).cast("int")), lambda k: F.concat(F.lit("Reason "), k.cast("string"), F.lit(" of the court for what it holds.")))
    head = F.array(
        F.lit("FIRST DIVISION"), F.lit(""), F.concat(F.lit("[G.R. No. "), F.col("case_id").cast("string"), F.lit(". "), F.date_format("date", "MMMM d, yyyy"), F.lit("]")), F.lit("--- Page 7 ---"),
        F.concat(F.lit("CUSTOMER "), F.col("party").cast("string"), F.lit(", petitioner,")), F.lit("vs. THE STATE, respondent."), F.lit(""), F.lit("SYLLABUS"), F.lit("1. RULE; what it says."), F.lit("2. OTHER RULE; what it says."),
        F.lit(""), F.lit("APPEARANCES OF COUNSEL"), F.lit("Law Office for petitioner."), F.lit("The Solicitor for respondent."), F.lit(""), F.lit("D E C I S I O N"), F.lit(""), F.lit("CRUZ, J.:"), F.lit(""),
    )
    tail = F.array(F.lit("WHEREFORE, the petition is granted."), F.lit("SO ORDERED."), F.lit(""), F.lit("Yap (Chairman), Reyes and Paras, JJ., concur."), F.lit("Feria, J., on leave."), F.lit(""))
    opinion = F.when(F.col("case_id") % 4 == 0, F.array(F.lit("SARMIENTO, J., dissenting:"), F.lit(""), F.lit("I hold otherwise."), F.lit("For these reasons."), F.lit("And so I dissent."), F.lit(""), F.lit("PADILLA, J., concurring:"), F.lit("I agree."))).otherwise(F.array().cast("array<string>"))
    each = cases(spark, sf_dir).select("volume", "case_id", F.posexplode(F.concat(head, body, tail, opinion)).alias("i", "line"))
    return each.select("volume", "case_id", (F.col("i") + 1).alias("line_no"), "line")


@query(
    "fsm4_case_sections",
    PRELUDE + """, b AS (SELECT case_id, CAST(case_id % 3 + 2 AS INTEGER) AS m FROM cases), f AS (SELECT * FROM (VALUES ('division', 1, 1), ('case_number', 3, 3), ('parties', 5, 6), ('syllabus', 9, 10), ('counsel', 13, 14), ('doc_type', 16, 16), ('ponente', 18, 18)) t(label, a, z))
    SELECT case_id, label, a AS start_line, z AS end_line FROM b, f UNION ALL SELECT case_id, 'decision', 20, 21 + m FROM b UNION ALL SELECT case_id, 'votes', 23 + m, 24 + m FROM b
    UNION ALL SELECT case_id, 'opinion', 26 + m, 30 + m FROM b WHERE case_id % 4 = 0 UNION ALL SELECT case_id, 'opinion', 32 + m, 33 + m FROM b WHERE case_id % 4 = 0""",
)
def fsm4(spark, sf_dir):
    """Sections of cases found again in their text."""
    return sections.sections(case_lines(spark, sf_dir)).select("case_id", "label", "start_line", "end_line")


@query("fsm2_displaced_endings", PRELUDE + "SELECT volume, case_id, 10 + CASE WHEN case_id % 3 = 0 THEN 5 ELSE 0 END AS end_line FROM cases WHERE case_id % 2 = 0 AND volume IS NOT NULL QUALIFY row_number() OVER (PARTITION BY volume ORDER BY case_id) = 1")
def fsm2(spark, sf_dir):
    """The first even case of each volume ends at line 10 without an order; where one follows at line 15 it is taken in."""
    first = cases(spark, sf_dir).where("case_id % 2 = 0").groupBy("volume").agg(F.min("case_id").alias("case_id"))
    ends = first.select("volume", "case_id", F.lit(1).alias("start_line"), F.lit(10).alias("end_line"))
    marks = F.when(F.col("case_id") % 3 == 0, F.array(F.struct(F.lit(15).alias("line_no"), F.lit("SO ORDERED.").alias("line")), F.struct(F.lit(20).alias("line_no"), F.lit("DECISION").alias("line")))).otherwise(F.array(F.struct(F.lit(12).alias("line_no"), F.lit("DECISION").alias("line")), F.struct(F.lit(30).alias("line_no"), F.lit("SO ORDERED.").alias("line"))))
    following = ends.withColumns({"start_line": F.lit(11), "end_line": F.lit(60)})
    lines = first.select("volume", F.inline(marks)).withColumn("is_noise", F.lit(False))
    found = boundaries.displaced_endings(lines, ends.union(following).select("volume", "start_line", "end_line"), "volume")
    return ends.drop("end_line").join(found, ["volume", "start_line"]).select("volume", "case_id", "end_line")


DISPLACED = """, x AS (SELECT volume, case_id, d, case_id % 3 = 0 AND lead(case_id) OVER w IS NOT NULL AS late, lag(case_id % 3 = 0, 1, false) OVER w AS after_late FROM cases WINDOW w AS (PARTITION BY volume ORDER BY case_id)),
n AS (SELECT *, 13 + 3 * CAST(after_late AS INTEGER) + 3 * CAST(NOT late AS INTEGER) AS n FROM x), p AS (SELECT *, sum(n) OVER (PARTITION BY volume ORDER BY case_id) AS upto FROM n)
SELECT volume, case_id, CAST(upto - n + 1 AS INTEGER) AS start_line, CAST(upto + CASE WHEN late THEN 6 ELSE 0 END AS INTEGER) AS end_line FROM p"""


@query("fsm2_displaced_in_volumes", PRELUDE + DISPLACED)
def fsm2_volumes(spark, sf_dir):
    """Volumes of many cases in which every third one but the last ends behind the next one's header: scanned, then mended."""
    w = Window.partitionBy("volume").orderBy("case_id")
    late = F.col("case_id") % 3 == 0
    c = cases(spark, sf_dir).withColumns({"late": late & F.lead("case_id").over(w).isNotNull(), "after": F.lag(late, 1, False).over(w)})
    ending = [F.lit("WHEREFORE, the petition is denied."), F.lit("SO ORDERED."), F.lit("Cruz and Yap, JJ., concur.")]
    head = [F.lit("EN BANC"), F.lit(""), F.concat(F.lit("[G.R. No. "), F.col("case_id").cast("string"), F.lit(". "), F.date_format("date", "MMMM d, yyyy"), F.lit("]"))]
    body = [F.lit("Doe, petitioner, vs. STATE, respondent."), F.lit("DECISION"), *[F.lit(f"Line {k} of the reasoning.") for k in range(8)]]
    none = F.array().cast("array<string>")
    parts = F.concat(F.array(*head), F.when(F.col("after"), F.array(*ending)).otherwise(none), F.array(*body), F.when(F.col("late"), none).otherwise(F.array(*ending)))
    lines = case_scan.classified(numbered(c.select("volume", "case_id", parts.alias("parts"))))
    found = case_scan.boundaries(lines)
    mended = boundaries.displaced_endings(lines.withColumn("is_noise", F.lit(False)), found, "volume")
    number = case_scan.bracket_parts(F.element_at("brackets", 1))[0].cast("long")
    return found.select("volume", "start_line", number.alias("case_id")).join(mended.hint("merge"), ["volume", "start_line"]).select("volume", "case_id", "start_line", "end_line")
