"""Queries over the graph of joint votes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliograph.operators import communities, network
from foliograph.operators.steps import tabled
from foliograph.operators.windows import SPAN, assign, bounds, spans, unfolded
from foliograph.plans.base import MEMBERS, PRELUDE, WINDOW, cases, members, n_votes, votes
from foliograph.plans.registry import query

EDGES = PRELUDE + """, ord AS (SELECT case_id, member, role, row_number() OVER (PARTITION BY case_id, role ORDER BY member) AS i, count(*) OVER (PARTITION BY case_id, role) AS n FROM votes),
edges AS (SELECT least(a.member, b.member) AS source, greatest(a.member, b.member) AS target, count(*) AS weight FROM ord a JOIN ord b ON a.case_id = b.case_id AND a.role = b.role AND a.i < b.i
          WHERE a.member <> b.member AND (a.role = 'majority' OR a.n >= 2) GROUP BY ALL)
"""


@query("agg19_covoting_edges", EDGES + "SELECT source, target, weight FROM edges")
def agg19(spark, sf_dir):
    return network.edges(votes(spark, sf_dir), n_votes(spark, sf_dir))


RULED = PRELUDE + """, mv AS (SELECT case_id, 'M' || member AS name, role, member FROM votes),
au AS (SELECT case_id, CASE WHEN case_id % 7 <> 0 AND case_id % 11 <> 0 THEN min_by(name, member) FILTER (role = 'majority') END AS author FROM mv GROUP BY 1),
en AS (SELECT case_id, role, name, member FROM mv JOIN (SELECT case_id, min(member) FILTER (role = 'majority') AS head FROM mv GROUP BY 1) USING (case_id) WHERE role = 'dissent' OR member <> head
       UNION ALL SELECT case_id, 'majority', author, -1 FROM au WHERE author IS NOT NULL),
el AS (SELECT *, row_number() OVER (PARTITION BY case_id, role ORDER BY member, name) AS i, count(*) OVER (PARTITION BY case_id, role) AS n FROM en),
dj AS (SELECT DISTINCT d.case_id, d.name AS joiner, t.name AS target FROM mv d JOIN (SELECT case_id, min_by(name, member) AS name FROM mv WHERE role = 'dissent' GROUP BY 1) t ON d.case_id = t.case_id AND d.role = 'dissent' AND d.name <> t.name)
"""


def ruled_cases(spark, sf_dir):
    """Case rows with names: the majority's first member is the author, of some cases the whole court or nobody is."""
    v = votes(spark, sf_dir).select("case_id", "role", F.struct("member", F.concat(F.lit("M"), F.col("member").cast("string")).alias("name")).alias("m"))
    sides = v.groupBy("case_id").agg(*[F.sort_array(F.collect_list(F.when(F.col("role") == r, F.col("m")))).alias(r) for r in ("majority", "dissent")])
    head, names = F.get("majority", 0), lambda c: F.transform(c, lambda x: x["name"])
    author = F.when(F.col("case_id") % 7 == 0, "PER CURIAM").when(F.col("case_id") % 11 == 0, None).otherwise(head["name"])
    rest = F.filter("majority", lambda x: x["member"] != head["member"])
    none = F.array().cast("array<string>")
    return sides.select("case_id", author.alias("ponente"), names(rest).alias("concurring"), names("dissent").alias("dissenting"), none.alias("no_part"), none.alias("other"))


def dissent_joins(spark, sf_dir):
    d = ruled_cases(spark, sf_dir).select("case_id", F.get("dissenting", 0).alias("target"), F.explode(F.array_distinct("dissenting")).alias("joiner"))
    return d.where("joiner <> target").select("case_id", "joiner", "target")


@query(
    "agg19_edges_by_rule",
    RULED + """, p AS (SELECT a.role AS rule, a.name AS a, b.name AS b FROM el a JOIN el b ON a.case_id = b.case_id AND a.role = b.role AND a.i < b.i WHERE a.name <> b.name UNION ALL SELECT 'joins', joiner, target FROM dj)
    SELECT least(a, b) AS source, greatest(a, b) AS target, count(*) AS weight, count(*) FILTER (rule = 'majority') AS majority, count(*) FILTER (rule = 'dissent') AS dissent, count(*) FILTER (rule = 'joins') AS joins FROM p GROUP BY 1, 2""",
)
def agg19_rules(spark, sf_dir):
    """Edges by all three rules, with the author in the majority and what each edge comes from."""
    return network.ruled_edges(network.case_blocs(ruled_cases(spark, sf_dir)), dissent_joins(spark, sf_dir), n_votes(spark, sf_dir))


@query("agg19_case_counts", RULED + "SELECT name AS node, count(*) AS case_count FROM en GROUP BY 1")
def agg19_counts(spark, sf_dir):
    return network.case_counts(network.case_blocs(ruled_cases(spark, sf_dir)))


@query(
    "agg19_statistics",
    RULED + """, p AS (SELECT a.role AS rule FROM el a JOIN el b ON a.case_id = b.case_id AND a.role = b.role AND a.i < b.i WHERE a.name <> b.name)
    SELECT count(*) AS n_cases, count(*) FILTER (case_id % 7 <> 0 AND author IS NULL) AS empty_ponente, count(*) FILTER (author IS NULL) AS per_curiam_cases,
    (SELECT count(*) FROM p WHERE rule = 'majority') AS majority_edges, (SELECT count(*) FROM p WHERE rule = 'dissent') AS dissent_edges, (SELECT count(*) FROM dj) AS join_edges FROM au""",
)
def agg19_statistics(spark, sf_dir):
    rows = ruled_cases(spark, sf_dir)
    return network.edge_statistics(rows, network.case_blocs(rows), dissent_joins(spark, sf_dir))


@query(
    "sj1_majority_pairs",
    PRELUDE + "SELECT a.member AS source, b.member AS target, count(*) AS weight FROM (SELECT DISTINCT case_id, member FROM votes) a JOIN (SELECT DISTINCT case_id, member FROM votes) b ON a.case_id = b.case_id AND a.member < b.member GROUP BY ALL",
)
def sj1(spark, sf_dir):
    """Pairs of distinct members of a case, whatever their roles."""
    v = votes(spark, sf_dir).select("case_id", "member", F.lit("any").alias("role")).distinct()
    n = n_votes(spark, sf_dir)
    return network.weighted(network.joint_pairs(v, "any", rows=n), n)


@query(
    "agg30_graph_summary",
    EDGES + """SELECT (SELECT count(*) FROM (SELECT source FROM edges UNION SELECT target FROM edges)) AS nodes, count(*) AS edges, sum(weight) AS total_weight,
    round(2 * count(*) / (SELECT count(*) * (count(*) - 1) FROM (SELECT source FROM edges UNION SELECT target FROM edges)), 6) AS density FROM edges""",
)
def agg30(spark, sf_dir):
    return network.summary(network.edges(votes(spark, sf_dir), n_votes(spark, sf_dir)))


@query("agg30_weighted_degree", EDGES + "SELECT node, count(*) AS degree, sum(weight) AS weighted_degree FROM (SELECT source AS node, weight FROM edges UNION ALL SELECT target, weight FROM edges) GROUP BY node")
def agg30_degree(spark, sf_dir):
    return network.degrees(network.edges(votes(spark, sf_dir), n_votes(spark, sf_dir)))


@query("srt1_top_pairs", EDGES + "SELECT source, target, weight FROM edges ORDER BY weight DESC, source, target LIMIT 20")
def srt1(spark, sf_dir):
    """The twenty heaviest edges: the limit is the feature."""
    return network.edges(votes(spark, sf_dir), n_votes(spark, sf_dir)).orderBy(F.desc("weight"), "source", "target").limit(20)


@query("snk11_adjacency", EDGES + 'SELECT source AS "row", target AS "column", weight FROM edges UNION ALL SELECT target, source, weight FROM edges')
def snk11(spark, sf_dir):
    return network.adjacency(network.edges(votes(spark, sf_dir), n_votes(spark, sf_dir)))


FILTERS = [("volume", "volume >= 240"), ("division", "lower(division) LIKE '%f%'"), ("dissent", "coalesce(n_dissents, 0) > 0"), ("confidence", "price >= 50000")]


@query(
    "flt5_skip_counters",
    PRELUDE + ", x AS (SELECT cases.*, n_dissents FROM cases LEFT JOIN (SELECT case_id, count(*) FILTER (role = 'dissent') AS n_dissents FROM votes GROUP BY 1) USING (case_id)) SELECT CASE "
    + " ".join(f"WHEN NOT ({rule}) THEN '{name}'" for name, rule in FILTERS) + " ELSE 'kept' END AS first_failed, count(*) AS n FROM x GROUP BY 1",
)
def flt5(spark, sf_dir):
    """Cases by the first filter that they fail, in one pass."""
    n = votes(spark, sf_dir).groupBy("case_id").agg(F.count_if(F.col("role") == "dissent").alias("n_dissents"))
    first = F
    for name, rule in FILTERS:
        first = first.when(~F.expr(rule), F.lit(name))
    return cases(spark, sf_dir).join(n, "case_id", "left").groupBy(first.otherwise("kept").alias("first_failed")).agg(F.count("*").alias("n"))


@query(
    "fsm14_window_edges",
    PRELUDE + """, ord AS (SELECT k, case_id, member, role, row_number() OVER (PARTITION BY k, case_id, role ORDER BY member) AS i, count(*) OVER (PARTITION BY k, case_id, role) AS n FROM placed)
    SELECT a.k, least(a.member, b.member) AS source, greatest(a.member, b.member) AS target, count(*) AS weight FROM ord a JOIN ord b ON a.k = b.k AND a.case_id = b.case_id AND a.role = b.role AND a.i < b.i WHERE a.role = 'majority' OR a.n >= 2 GROUP BY ALL""",
)
def fsm14(spark, sf_dir):
    """The graph of each window, loops included."""
    return network.window_edges(spans(votes(spark, sf_dir), bounds(cases(spark, sf_dir)), WINDOW), SPAN, unfolded, n_votes(spark, sf_dir))


@query("agg35_symmetric_matrix", EDGES + "SELECT s AS row_member, sum(weight) FILTER (t % 3 = 0) AS thirds, count(*) AS filled FROM (SELECT source AS s, target AS t, weight FROM edges UNION ALL SELECT target, source, weight FROM edges) GROUP BY 1")
def agg35(spark, sf_dir):
    """Both halves of a symmetric matrix, summed by row over a class of columns; no entry is none."""
    both = network.adjacency(network.edges(votes(spark, sf_dir), n_votes(spark, sf_dir)))
    return both.groupBy(F.col("row").alias("row_member")).agg(F.sum(F.when(F.col("column") % 3 == 0, F.col("weight"))).alias("thirds"), F.count("*").alias("filled"))


def placed_votes(spark, sf_dir):
    """Votes with a row per window; what snapshots are made of."""
    return assign(votes(spark, sf_dir).select("case_id", "member", "role", "date", "bloc"), bounds(cases(spark, sf_dir)), WINDOW)


#: (session, folder) -> the written table of ``snapshots``
_SNAPSHOTS: dict[tuple[str, str], DataFrame] = {}


#: Links of all windows' graphs for each vote, about, in both directions.
LINKS = 7


def snapshots(spark, sf_dir):
    """(k, node, community, track, step): who belongs to which community of each window's graph, and to which track.

    The table is written once a session and folder; all queries on communities read it.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _SNAPSHOTS:
        # pairs aren't counted by window first: they are added up where they are dealt by their nodes
        n, pairs = n_votes(spark, sf_dir), network.span_pairs(spans(votes(spark, sf_dir), bounds(cases(spark, sf_dir)), WINDOW), SPAN)
        found = communities.communities(pairs.withColumn("weight", F.lit(1)), LINKS * n, ("first", "last"))
        _SNAPSHOTS[key] = tabled(communities.tracked(tabled(found)))
    return _SNAPSHOTS[key]


def known(spark, sf_dir):
    """(k, node, track, step) of ``snapshots``, broadcast to the votes where the members are: they have a row per window."""
    found = snapshots(spark, sf_dir).select("k", "node", "track", "step")
    return F.broadcast(found) if members(spark, sf_dir).count() <= MEMBERS else found


@query("fsm13_communities")
def fsm13(spark, sf_dir):
    """Communities of each window's graph by modularity (no SQL twin: iterative; tested against a sequential optimum)."""
    return snapshots(spark, sf_dir).select("k", "node", "community")


@query("fsm12_tracked_communities")
def fsm12(spark, sf_dir):
    """Communities of each window with the tracks that join them from window to window (no SQL twin: greedy, in order)."""
    return snapshots(spark, sf_dir).groupBy("step", "k", "track", "community").agg(F.count("*").alias("n_members"))


@query("jn23_member_communities")
def jn23(spark, sf_dir):
    """Per case and window the tracks of those that voted; members outside the window's graph are dropped."""
    voted = placed_votes(spark, sf_dir).select("k", "case_id", "role", F.col("member").alias("node")).distinct()
    return voted.join(known(spark, sf_dir), ["k", "node"]).groupBy("step", "case_id", "role").agg(F.array_join(F.sort_array(F.collect_set("track")).cast("array<string>"), ", ").alias("tracks"), F.count("*").alias("n"))


@query("win8_snapshot_stability")
def win8_snapshots(spark, sf_dir):
    """Stability of detected communities and what entered and exited, by step."""
    found = snapshots(spark, sf_dir)
    moved = communities.transitions(found).groupBy("step").pivot("change", ["entered", "exited"]).count()
    return communities.stability(found).join(moved, "step", "left").na.fill(0, ["entered", "exited"])


@query("fsm16_cross_community_cases")
def fsm16_cases(spark, sf_dir):
    """Cases of each window whose majority or dissent spans detected communities."""
    return communities.cross_community_cases(placed_votes(spark, sf_dir).select("k", "case_id", "member", "role"), known(spark, sf_dir))


@query("agg31_cross_community_summary")
def agg31_summary(spark, sf_dir):
    """In how many windows, and how, each case crossed communities."""
    return communities.cross_community_summary(fsm16_cases(spark, sf_dir))


@query("agg34_detected_community_table")
def agg34_detected(spark, sf_dir):
    """Members of each detected community by appointing bloc."""
    return communities.community_table(snapshots(spark, sf_dir), members(spark, sf_dir).select(F.col("member").alias("node"), "bloc"))
