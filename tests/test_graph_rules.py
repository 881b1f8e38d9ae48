"""Edges by rule against plain loops."""

import random
from collections import Counter
from itertools import combinations

import pytest

from foliograph.operators import network

KINDS = "case_id int, ponente string, concurring array<string>, dissenting array<string>, no_part array<string>, other array<string>"


def plain(cases, joins, no_part, other):
    edges, counts, added = {}, Counter(), Counter()

    def put(a, b, rule):
        if a != b:
            edges.setdefault((min(a, b), max(a, b)), Counter())[rule] += 1
            added[rule] += 1

    for _, author, concurring, dissenting, away, rest in cases:
        clean = lambda names: [n.strip() for n in names or () if n.strip() not in network.NOBODY]
        bench = clean(concurring) + clean([author or ""])
        against = clean(dissenting) + clean(away) * no_part + clean(rest) * other
        counts.update(bench + against)
        for a, b in combinations(bench, 2):
            put(a, b, "majority")
        for a, b in combinations(against, 2):
            put(a, b, "dissent")
    for _, a, b in joins:
        put(a, b, "joins")
    return edges, counts, added


@pytest.mark.parametrize("no_part,other", [(False, False), (True, False), (True, True)])
def test_edges_by_rule(spark, no_part, other):
    draw = random.Random(12)
    names = ["Cruz", "Yap", " Abad", "Reyes", "Per curiam", "", "Plana"]
    some = lambda n: [draw.choice(names) for _ in range(draw.randint(0, n))]
    cases = [(k, draw.choice([*names, None, "PER CURIAM"]), some(5), some(3), some(2), draw.choice([None, some(2)])) for k in range(60)]
    joins = [(k, draw.choice(["Cruz", "Yap"]), draw.choice(["Yap", "Plana"])) for k in range(20)]
    df, joined = spark.createDataFrame(cases, KINDS), spark.createDataFrame(joins, "case_id int, joiner string, target string")
    blocs = network.case_blocs(df, no_part, other)
    edges, counts, added = plain(cases, joins, no_part, other)
    got = {(r.source, r.target): (r.weight, r.majority, r.dissent, r.joins) for r in network.ruled_edges(blocs, joined).collect()}
    assert got == {e: (sum(c.values()), c["majority"], c["dissent"], c["joins"]) for e, c in edges.items()}
    assert {r.node: r.case_count for r in network.case_counts(blocs).collect()} == counts
    row = network.edge_statistics(df, blocs, joined).first()
    assert (row.majority_edges, row.dissent_edges, row.join_edges) == (added["majority"], added["dissent"], added["joins"])
    assert row.empty_ponente == sum(not (c[1] or "").strip() for c in cases) and row.n_cases == 60
