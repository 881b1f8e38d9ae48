"""Queries over sliding windows and members: rates, affinity, blocs, drift, agreement, the court as a whole."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliograph.operators import behaviour
from foliograph.operators.windows import SPAN, assign, bounds, centre, spans, unfolded, windows
from foliograph.plans.base import PRELUDE, WINDOW, cases, members, n_votes, votes
from foliograph.plans.registry import query


def placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign(votes(spark, sf_dir), bounds(cases(spark, sf_dir)), WINDOW)


def spanned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Votes with the windows that they are in, not yet a row for each."""
    return spans(votes(spark, sf_dir), bounds(cases(spark, sf_dir)), WINDOW)


def by_window(counts: DataFrame) -> DataFrame:
    """Counts by span as rows by window, with its centre."""
    return unfolded(counts).withColumn("window_center", centre(WINDOW))


@query("win1_sliding_windows", PRELUDE + "SELECT k, window_start, window_end, window_center FROM win")
def win1(spark, sf_dir):
    return windows(bounds(cases(spark, sf_dir)), WINDOW)


@query("win2_window_assignment", PRELUDE + "SELECT k, count(*) AS n_votes, count(DISTINCT case_id) AS n_cases FROM placed GROUP BY k")
def win2(spark, sf_dir):
    return placed(spark, sf_dir).groupBy("k").agg(F.count("*").alias("n_votes"), F.countDistinct("case_id").alias("n_cases"))


@query(
    "agg20_dissent_rate_timeline",
    PRELUDE + """SELECT window_center, member, bloc, count(*) AS cases_participated, count(*) FILTER (role = 'dissent') AS dissent_count,
    round(count(*) FILTER (role = 'dissent') / count(*), 4) AS dissent_rate FROM placed GROUP BY ALL""",
)
def agg20(spark, sf_dir):
    return behaviour.dissent_rates_by_span(spanned(spark, sf_dir), SPAN, by_window, ("window_center",))


CO_DISSENT = """, dis AS (SELECT {by} case_id, member FROM {rows} WHERE role = 'dissent'),
tot AS (SELECT {by} member, count(*) AS n FROM dis GROUP BY ALL HAVING count(*) >= {least}),
sets AS (SELECT DISTINCT * FROM dis),
co AS (SELECT {abys} a.member AS member_a, b.member AS member_b, count(*) AS co FROM sets a JOIN sets b ON a.case_id = b.case_id {on} AND a.member < b.member GROUP BY ALL)
SELECT {abys} a.member AS member_a, b.member AS member_b, a.n AS dissents_a, b.n AS dissents_b, CAST(coalesce(co, 0) AS BIGINT) AS co_dissent_count,
round(coalesce(co, 0) / least(a.n, b.n), 4) AS co_dissent_rate
FROM tot a JOIN tot b ON a.member < b.member {on} LEFT JOIN co ON co.member_a = a.member AND co.member_b = b.member {onco}"""


@query("agg21_dissent_affinity", PRELUDE + CO_DISSENT.format(by="", rows="votes", least=5, abys="", on="", onco=""))
def agg21(spark, sf_dir):
    return behaviour.co_dissent(votes(spark, sf_dir), 5)


@query("agg26_dissent_affinity_windowed", PRELUDE + CO_DISSENT.format(by="k,", rows="placed", least=2, abys="a.k,", on="AND a.k = b.k", onco="AND co.k = a.k"))
def agg26(spark, sf_dir):
    return behaviour.co_dissent(spanned(spark, sf_dir), 2, ("k",), SPAN, unfolded)


@query(
    "agg22_dissent_against",
    PRELUDE + """, tot AS (SELECT member AS dissenter, count(*) AS total_dissents FROM votes WHERE role = 'dissent' GROUP BY ALL HAVING count(*) >= 5)
    SELECT dissenter, m.member AS target, count(*) AS dissent_against_count, any_value(total_dissents) AS total_dissents, round(count(*) / any_value(total_dissents), 4) AS dissent_against_rate
    FROM votes x JOIN tot ON x.member = dissenter AND x.role = 'dissent' JOIN votes m ON m.case_id = x.case_id AND m.role = 'majority' GROUP BY dissenter, m.member""",
)
def agg22(spark, sf_dir):
    return behaviour.dissent_against(votes(spark, sf_dir), 5)


BLOCS = PRELUDE + """, side AS (SELECT k, case_id, bloc, count(*) FILTER (role = 'majority') >= count(*) FILTER (role = 'dissent') AS up FROM placed GROUP BY ALL),
part AS (SELECT k, window_center, case_id, member, bloc, bool_or(role = 'majority') AS maj FROM placed GROUP BY ALL),
j AS (SELECT part.*, up FROM part JOIN side USING (k, case_id, bloc))
"""


@query(
    "agg23_bloc_deviation",
    BLOCS + """SELECT window_center, member, bloc, count(*) AS cases_in_window, count(*) FILTER (maj = up) AS with_bloc, count(*) FILTER (maj <> up) AS against_bloc,
    round(count(*) FILTER (maj = up) / count(*), 4) AS bloc_agreement_rate, round(count(*) FILTER (maj <> up) / count(*), 4) AS deviation_score FROM j GROUP BY ALL""",
)
def agg23(spark, sf_dir):
    return behaviour.bloc_deviation(by_window(behaviour.positions_by_span(spanned(spark, sf_dir), SPAN)), ("window_center",))


@query(
    "agg24_temporal_drift",
    BLOCS + """SELECT window_center, member, bloc, count(*) AS cases_in_window, round(count(*) FILTER (maj) / count(*), 4) AS alignment_with_court,
    round(count(*) FILTER (maj = up) / count(*), 4) AS alignment_with_own_bloc, round(count(*) FILTER (NOT maj) / count(*), 4) AS dissent_rate FROM j GROUP BY ALL""",
)
def agg24(spark, sf_dir):
    return behaviour.drift(by_window(behaviour.positions_by_span(spanned(spark, sf_dir), SPAN)), ("window_center",))


def rounded_sql(a: str, b: str) -> str:
    return f"sign({a}) * CAST((abs({a}) * 20000::HUGEINT + {b}) // ({b} * 2::HUGEINT) AS DOUBLE) / 10000"


AGREEMENT = """, s AS (SELECT {by} case_id, member, bloc, bool_or(role = 'majority') AS maj, bool_or(role = 'dissent') AS dis FROM {rows} GROUP BY ALL),
r AS (SELECT {by} member, count(*) FILTER (dis) AS d, count(*) AS t FROM s GROUP BY ALL),
q AS (SELECT {abys} a.member AS member_a, b.member AS member_b, a.bloc AS bloc_a, b.bloc AS bloc_b, count(*) AS n, count(*) FILTER (a.maj = b.maj) AS agreements
      FROM s a JOIN s b ON a.case_id = b.case_id {on} AND a.member < b.member GROUP BY ALL HAVING count(*) >= {least}),
f AS (SELECT q.*, (ra.t - ra.d) * (rb.t - rb.d) AS e, ra.t * rb.t AS f FROM q JOIN r ra ON ra.member = member_a {ona} JOIN r rb ON rb.member = member_b {onb})
SELECT {fby} member_a, member_b, n AS cases_both_participated, agreements, """ + rounded_sql("agreements", "n") + " AS observed_agreement, " + rounded_sql("e", "f") + """ AS expected_agreement,
""" + rounded_sql("(agreements * f - e * n)", "(n * f)") + " AS affinity_score, bloc_a = bloc_b AND bloc_a <> 'Unknown' AS same_bloc FROM f"


@query("agg25_agreement_normalized", PRELUDE + AGREEMENT.format(by="", rows="votes", abys="", on="", least=20, fby="", ona="", onb=""))
def agg25(spark, sf_dir):
    return behaviour.agreement(votes(spark, sf_dir), 20, rows=n_votes(spark, sf_dir))


@query("agg27_agreement_windowed", PRELUDE + AGREEMENT.format(by="k,", rows="placed", abys="a.k,", on="AND a.k = b.k", least=5, fby="k,", ona="AND ra.k = q.k", onb="AND rb.k = q.k"))
def agg27(spark, sf_dir):
    return behaviour.agreement(spanned(spark, sf_dir), 5, ("k",), SPAN, unfolded, n_votes(spark, sf_dir))


COMBOS = {"all": "true", "full": "division = 'F'", "open": "division = 'O'", "urgent": "priority = '1-URGENT'"}
COMBO_SQL = " UNION ALL ".join(f"SELECT '{name}' AS combo, case_id, d, dissenting FROM c WHERE {rule}" for name, rule in COMBOS.items())


@query(
    "agg28_court_dissent_rate",
    PRELUDE + f""", c AS (SELECT cases.*, coalesce(dis, false) AS dissenting FROM cases LEFT JOIN (SELECT case_id, bool_or(role = 'dissent') AS dis FROM votes GROUP BY 1) USING (case_id)),
    x AS ({COMBO_SQL}),
    n AS (SELECT combo, k, count(*) AS total, count(*) FILTER (dissenting) AS dis FROM x JOIN win ON d >= window_start AND d < window_end GROUP BY ALL)
    SELECT g.combo, window_center, window_start, window_end, coalesce(total, 0) AS total_cases, coalesce(dis, 0) AS dissent_cases, coalesce(round(dis / nullif(total, 0), 4), 0.0) AS dissent_rate
    FROM (SELECT * FROM win, (VALUES {", ".join(f"('{c}')" for c in COMBOS)}) t(combo)) g LEFT JOIN n ON n.combo = g.combo AND n.k = g.k""",
)
def agg28(spark, sf_dir):
    limits = bounds(cases(spark, sf_dir))
    dissents = votes(spark, sf_dir).groupBy("case_id").agg(F.max(F.col("role") == "dissent").alias("dis"))
    rows = cases(spark, sf_dir).join(dissents, "case_id", "left").withColumn("dissenting", F.coalesce("dis", F.lit(False)))
    combo = F.array_compact(F.array(*[F.when(F.expr(rule), F.lit(name)) for name, rule in COMBOS.items()]))
    counts = spans(rows.withColumn("combo", F.explode(combo)).select("combo", "date", "dissenting"), limits, WINDOW).groupBy("combo", *SPAN).agg(F.count("*").alias("n"), F.count_if("dissenting").alias("d"))
    grid = windows(limits, WINDOW).withColumn("combo", F.explode(F.array(*map(F.lit, COMBOS))))
    return behaviour.court_rates(grid, unfolded(counts)).drop("k")


@query(
    "agg29_corpus_summary",
    PRELUDE + """SELECT count(*) AS n_cases, count(*) FILTER (dis) AS n_with_dissent, count(*) FILTER (division = 'F') AS n_full, min(d) AS first_date, max(d) AS last_date,
    (SELECT count(DISTINCT member) FROM votes) AS n_members FROM cases LEFT JOIN (SELECT case_id, bool_or(role = 'dissent') AS dis FROM votes GROUP BY 1) USING (case_id)""",
)
def agg29(spark, sf_dir):
    dissents = votes(spark, sf_dir).groupBy("case_id").agg(F.max(F.col("role") == "dissent").alias("dis"))
    total = votes(spark, sf_dir).agg(F.countDistinct("member").alias("n_members"))
    one = cases(spark, sf_dir).join(dissents, "case_id", "left").agg(
        F.count("*").alias("n_cases"), F.count_if("dis").alias("n_with_dissent"), F.count_if(F.col("division") == "F").alias("n_full"), F.min("date").alias("first_date"), F.max("date").alias("last_date")
    )
    return one.crossJoin(total)  # two single rows


BLOC_NAMES = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]


@query(
    "agg33_appointee_composition",
    PRELUDE + """, t AS (SELECT member, bloc, min(d) AS s, max(d) AS e FROM votes GROUP BY ALL)
    SELECT window_center, """ + ", ".join(f"count(*) FILTER (bloc = '{b}') AS {b.lower().replace(' ', '_')}" for b in BLOC_NAMES) + " FROM win JOIN t ON s < window_end AND e > window_start GROUP BY ALL",
)
def agg33(spark, sf_dir):
    """Members in office per window and bloc; a term is the span of a member's votes."""
    terms = votes(spark, sf_dir).groupBy("member", "bloc").agg(F.min("date").alias("s"), F.max("date").alias("e"))
    w = windows(bounds(cases(spark, sf_dir)), WINDOW)
    met = terms.join(F.broadcast(w), (F.col("s") < F.col("window_end")) & (F.col("e") > F.col("window_start")))
    got = met.groupBy("window_center").pivot("bloc", BLOC_NAMES).count().fillna(0)
    return got.select("window_center", *[F.col(f"`{b}`").alias(b.lower().replace(" ", "_")) for b in BLOC_NAMES])


@query(
    "jn24_closest_window",
    PRELUDE + f"""SELECT day, min_by(k, abs(datediff('day', day, window_center)) * 10000 + k) AS k FROM (SELECT DISTINCT d AS day FROM cases), win
    WHERE abs(datediff('day', day, window_center)) <= {WINDOW.step} GROUP BY day""",
)
def jn24(spark, sf_dir):
    """For each day the window whose centre is nearest, within one step."""
    days = cases(spark, sf_dir).select(F.col("date").alias("day")).distinct()
    w = windows(bounds(cases(spark, sf_dir)), WINDOW)
    gap = F.abs(F.datediff("day", "window_center"))
    return days.join(F.broadcast(w), gap <= WINDOW.step).groupBy("day").agg(F.min_by("k", F.struct(gap, "k")).alias("k"))
