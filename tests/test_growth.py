"""Steps that grow with the tables: what they shuffle, broadcast and hand to Python."""

import random
import re

import pytest

from pyspark.sql import functions as F

from foliograph.operators import behaviour, boundaries, network, sections, steps
from foliograph.plans import base, checks, court, evidence, graph, older, parsing, quality, registry  # noqa: F401

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_pairs_without_shared_cases_are_not_shuffled(spark, monkeypatch):
    """Pairs come from blocks of members, in any number of blocks, with and without windows."""
    monkeypatch.setattr(behaviour, "BLOCK", 3, raising=False)
    draw = random.Random(3)
    rows = [(k, case, draw.randrange(25), draw.choice(["majority", "dissent"])) for k in range(2) for case in range(30) for _ in range(4)]
    rows += [(0, 99, None, "dissent"), (0, 99, 30, "dissent"), (0, 100, 30, "dissent")]
    df = spark.createDataFrame(rows, "k int, case_id int, member int, role string")
    for by in ((), ("k",)):
        want = {}
        for k in (range(2) if by else [None]):
            own = [r for r in rows if r[3] == "dissent" and r[2] is not None and k in (None, r[0])]
            n, sets = {}, {}
            for w, case, m, _ in own:
                n[m] = n.get(m, 0) + 1
                sets.setdefault(m, set()).add(case)
            some = sorted(m for m in n if n[m] >= 2)
            want |= {(*([k] if by else []), a, b): (n[a], n[b], len(sets[a] & sets[b])) for a in some for b in some if a < b}
        got = behaviour.co_dissent(df, 2, by)
        assert {(*(r[c] for c in by), r.member_a, r.member_b): (r.dissents_a, r.dissents_b, r.co_dissent_count) for r in got.collect()} == want
        assert any(x[2] == 0 for x in want.values())
    # no join makes all pairs: each member's come out of a row for a block
    assert not any("member_a" in x for x in plan(behaviour.co_dissent(df, 2)).splitlines() if "NestedLoop" in x or "CartesianProduct" in x)


def test_lines_are_not_broadcast(spark):
    """Rendered lines look as small as the table that they come from, however many they are."""
    rows = evidence.blocks(spark, SF)
    lines = evidence.rendered(rows, ["SECOND DIVISION", "", "[G.R. No. 5. May 3, 1999]", *["text"] * 17])
    known = rows.select("vol", (F.col("i") * 20 + 1).alias("start_line"), (F.col("i") * 20 + 20).alias("end_line"))
    for df in (evidence.fsm3(spark, SF), boundaries.displaced_endings(lines, known, "vol"), evidence.fsm6(spark, SF)):
        assert "BroadcastHashJoin" not in plan(df)


def test_cases_are_numbered_before_their_lines_are_made(spark):
    got = plan(parsing.volume_lines(spark, SF))
    assert got.index("Generate") < got.index("Window")  # the plan is printed from its end


def test_sections_are_read_by_rows(spark):
    """No grouped function, whose cost is that of a pandas frame for each case."""
    df = sections.sections(parsing.case_lines(spark, SF))
    assert "FlatMapGroupsInPandas" not in plan(df)
    some = spark.createDataFrame([(None, None, 1, "FIRST DIVISION"), (None, None, 2, None), (7, 1, 2, "EN BANC"), (7, 1, 1, "--- Page 7 ---"), (7, 2, 1, "--- Page 8 ---")], "volume int, case_id long, line_no int, line string")
    assert sorted((tuple(r) for r in sections.sections(some).collect()), key=str) == [(7, 1, "division", 2, 2), (None, None, "division", 1, 1)]


def test_pairs_of_cases_are_made_in_many_tasks(spark):
    """Elements are few where their pairs are many: their tasks aren't merged."""
    rows = spark.createDataFrame([(case, m, "majority") for case in range(40) for m in range(3)], "case_id int, member int, role string")
    pairs = network.joint_pairs(rows, "majority")
    assert pairs.rdd.getNumPartitions() == 4 and pairs.count() == 120


def test_tasks_of_votes_grow_with_lines(spark, monkeypatch):
    """Votes are dealt by case, in tasks of so many lines; the results stay."""
    few = sorted(map(tuple, checks.fsm16(spark, SF).collect()))
    monkeypatch.setattr(steps, "ROWS", 500)
    got = checks.fsm16(spark, SF)
    tasks = -(-spark.read.parquet(f"{SF}/lineitem.parquet").count() // 500)
    assert tasks > 4 and plan(got).count(f", {tasks}), REPARTITION_BY_NUM") == 2, plan(got)
    assert sorted(map(tuple, got.collect())) == few


def dealings(df, to):
    """Shuffles into so many tasks, and those into as many as the session has."""
    text = plan(df)
    return text.count(f", {to}), REPARTITION_BY_NUM"), text.count("ENSURE_REQUIREMENTS")


def test_pairs_of_agreement_are_dealt(spark, monkeypatch):
    """Votes stay where they were dealt by case, and pairs are dealt in tasks of so many; the results stay."""
    want = sorted(map(tuple, court.agg25(spark, SF).collect()))
    monkeypatch.setattr(steps, "ROWS", 500)
    df = court.agg25(spark, SF)
    tasks = -(-2 * base.n_votes(spark, SF) // 500)
    assert dealings(df, tasks)[0] == 1
    assert sorted(map(tuple, df.collect())) == want
    monkeypatch.setattr(base, "MEMBERS", 5)
    assert sorted(map(tuple, court.agg25(spark, SF).collect())) == want


@pytest.mark.parametrize(
    "name,times",
    [("fsm7_vote_statements", 0), ("agg19_edges_by_rule", 2), ("agg19_covoting_edges", 2), ("sj1_majority_pairs", 2), ("fsm14_window_edges", 2), ("agg27_agreement_windowed", 2), ("jn7_member_in_office", 1), ("win8_stability", 1), ("set6_five_way_diff", 1), ("set6_four_way_diff", 1), ("fsm10_label_scores", 1)],
)
def test_what_votes_make_is_dealt(spark, monkeypatch, name, times):
    """Once votes are dealt, no shuffle into a set number of tasks has their rows or their pairs; the results stay."""
    query = registry.QUERIES[name]
    want = sorted(map(tuple, query(spark, SF).collect()), key=str)
    monkeypatch.setattr(steps, "ROWS", 500)
    df, n = query(spark, SF), base.n_votes(spark, SF)
    if times:
        assert dealings(df, -(-times * n // 500))[0], plan(df)
    keyed = re.findall(r"hashpartitioning\(([^,]*),.*ENSURE_REQUIREMENTS", plan(df))
    # members, nations and windows are few; rows of cases and their pairs aren't
    assert not [k for k in keyed if k.startswith(("case_id", "source", "member_a", "a#"))], plan(df)
    assert sorted(map(tuple, df.collect()), key=str) == want


def test_pairs_without_shared_cases_cost_little(spark):
    """Such pairs are runs of places: none is looked up in a set of those taken, and no rate of theirs is rounded."""
    rows = [(case, draw % 11, "dissent") for case, draw in enumerate(range(60))] + [(case, 3, "dissent") for case in range(9)]
    got = behaviour.co_dissent(spark.createDataFrame(rows, "case_id int, member int, role string"), 2)
    text = got._jdf.queryExecution().optimizedPlan().toString()
    assert "array_except" not in text and text.count("round(") == 1, text
    assert got.count() == 55 and {r.co_dissent_rate for r in got.where("co_dissent_count = 0").collect()} == {0.0}


def test_dissents_of_windows_are_paired_once(spark):
    """Pairs are counted by span and become rows by window as counts; the results are those of a row for each window."""
    draw = random.Random(4)
    spans = [(case, draw.randrange(3)) for case in range(40)]
    rows = [(lo, lo + case % 3, case, draw.randrange(9), "dissent") for case, lo in spans for _ in range(3)]
    df = spark.createDataFrame(rows, "first int, last int, case_id int, member int, role string")
    unfold = lambda x: x.withColumn("k", F.explode(F.sequence("first", "last")))
    got = behaviour.co_dissent(df, 2, ("k",), ("first", "last"), unfold)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, behaviour.co_dissent(unfold(df), 2, ("k",)).collect()))


@pytest.mark.parametrize("name", ["jn23_member_communities", "fsm16_cross_community_cases", "agg31_cross_community_summary"])
def test_votes_meet_communities_where_they_lie(spark, monkeypatch, name):
    """Votes stay dealt by case where they get their members' tracks; the results stay."""
    want = sorted(map(tuple, registry.QUERIES[name](spark, SF).collect()))
    monkeypatch.setattr(steps, "ROWS", 500)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # here all tables are small
    try:
        df = registry.QUERIES[name](spark, SF)
        assert not re.findall(r"hashpartitioning\((?:k|step|case_id|node|member)#.*ENSURE_REQUIREMENTS", plan(df).split("BroadcastExchange")[0]), plan(df)
        assert sorted(map(tuple, df.collect())) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
