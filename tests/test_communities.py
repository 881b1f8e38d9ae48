"""Communities by modularity, their tracks, and what is read off them, against plain sequential versions."""

import random
from collections import Counter, defaultdict

import pytest

from foliograph.operators import communities
from foliograph.plans import graph

EDGES = "k int, source int, target int, weight long"


def sequential(edges, seed):
    """Modularity that moves of one node at a time, in a seeded order, and contraction reach."""
    draw, graph = random.Random(seed), defaultdict(Counter)
    for a, b, w in edges:
        graph[a][b] += w
        graph[b][a] += w
    total = sum(sum(x.values()) for x in graph.values())
    while True:
        own, degree = {n: n for n in graph}, {n: sum(graph[n].values()) for n in graph}
        held, moved_once = dict(degree), False
        while True:
            order, moved = list(graph), False
            draw.shuffle(order)
            for n in order:
                near = Counter()
                for m, w in graph[n].items():
                    if m != n:
                        near[own[m]] += w
                held[own[n]] -= degree[n]
                best = max([own[n], *near], key=lambda c: (near[c] - degree[n] * held[c] / total, c == own[n]))
                held[best] += degree[n]
                moved |= best != own[n]
                own[n] = best
            moved_once |= moved
            if not moved:
                break
        smaller = defaultdict(Counter)
        for a in graph:
            for b, w in graph[a].items():
                smaller[own[a]][own[b]] += w
        graph = smaller
        if not moved_once:
            return sum(graph[c][c] / total - (sum(graph[c].values()) / total) ** 2 for c in graph)


@pytest.fixture(scope="module")
def graphs():
    draw, rows = random.Random(5), []
    for k, (inside, outside) in enumerate(((0.4, 0.03), (0.3, 0.15))):
        group = [draw.randrange(5) for _ in range(70)]
        rows += [(k, a, b, draw.randint(1, 4)) for a in range(70) for b in range(a + 1, 70) if draw.random() < (inside if group[a] == group[b] else outside)]
    return rows


def test_modularity_is_near_a_sequential_optimum(spark, graphs):
    odd = [(8, 1, 2, 1), (9, 5, 5, 3), (10, 7, 8, 0), (10, None, 8, 1), (None, 1, 2, 1), (11, 3, 1, 1), (11, 1, 3, 1), (11, 3, 3, 2)]
    df = spark.createDataFrame(graphs + odd, EDGES)
    found = communities.communities(df).cache()
    quality = {r.k: r.q for r in communities.modularity(spark.createDataFrame(graphs, EDGES), found).collect()}
    for k in (0, 1):
        own = [e[1:] for e in graphs if e[0] == k]
        assert quality[k] >= 0.95 * max(sequential(own, s) for s in range(3))
    got = defaultdict(dict)
    for r in found.collect():
        got[r.k][r.node] = r.community
    assert got[8] == {1: 1, 2: 1} and got[9] == {5: 5} and 10 not in got and None not in got and got[11] == {1: 1, 3: 1}
    assert all(min(n for n in nodes if nodes[n] == c) == c for nodes in got.values() for c in nodes.values())
    assert len(set(got[0].values())) >= 2


def test_no_edges(spark):
    assert communities.communities(spark.createDataFrame([], EDGES)).count() == 0


@pytest.fixture(scope="module")
def members(spark):
    draw, rows = random.Random(7), []
    for k in (2, 3, 5, 6, 9):
        nodes = draw.sample(range(40), 25)
        label = {n: min((n + draw.choice([0, 0, 0, 7])) % 5, n) for n in nodes}
        rows += [(k, n, label[n]) for n in nodes]
    return rows


def plain_tracks(rows):
    groups = defaultdict(lambda: defaultdict(set))
    for k, node, c in rows:
        groups[k][c].add(node)
    out, last, fresh = {}, {}, 0
    for step, k in enumerate(sorted(groups)):
        names = sorted(groups[k])
        ranked = sorted(((len(groups[k][c] & nodes) / len(groups[k][c] | nodes), -i, -t) for i, c in enumerate(names) for t, nodes in last.items() if groups[k][c] & nodes), reverse=True)
        got = {}
        for _, i, t in ranked:
            if names[-i] not in got and -t not in got.values():
                got[names[-i]] = -t
        for c in names:
            if c not in got:
                got[c], fresh = fresh, fresh + 1
        out |= {(k, n): (got[c], step) for c in names for n in groups[k][c]}
        last = {got[c]: groups[k][c] for c in names}
    return out


def test_tracks_stability_and_transitions(spark, members):
    df = spark.createDataFrame(members, "k int, node int, community int")
    tracked = communities.tracked(df).cache()
    want = plain_tracks(members)
    assert {(r.k, r.node): (r.track, r.step) for r in tracked.collect()} == want
    steps = defaultdict(dict)
    for (_, node), (track, step) in want.items():
        steps[step][node] = track
    got = {r.step: r.stability for r in communities.stability(tracked).collect()}
    moved = {(r.step, r.node, r.change) for r in communities.transitions(tracked).collect()}
    for step, now in steps.items():
        before = steps.get(step - 1, {})
        shared = now.keys() & before.keys()
        sets = lambda x: [{n for n in shared if x[n] == t} for t in {x[n] for n in shared}]
        best = [max(len(a & b) / len(a | b) for b in sets(before)) for a in sets(now)]
        assert got[step] == (pytest.approx(sum(best) / len(best), abs=1e-4) if len(shared) > 1 else None)
        assert {(n, c) for s, n, c in moved if s == step} == {(n, "entered") for n in now.keys() - before.keys()} | {(n, "exited") for n in before.keys() - now.keys()}


def test_cases_across_communities(spark, members):
    draw = random.Random(8)
    tracked = communities.tracked(spark.createDataFrame(members, "k int, node int, community int")).cache()
    votes = [(k, case, draw.randrange(45), draw.choice(["majority", "majority", "dissent"])) for k in (2, 3, 4, 9) for case in range(30) for _ in range(5)]
    of = plain_tracks(members)
    want, sides = {}, defaultdict(set)
    for k, case, member, role in votes:
        if (k, member) in of:
            track, step = of[k, member]
            sides[step, case, role].add(track)
    for step, case in {x[:2] for x in sides}:
        m, d = len(sides[step, case, "majority"]), len(sides[step, case, "dissent"])
        if max(m, d) > 1:
            want[step, case] = ("both" if min(m, d) > 1 else "majority" if m > 1 else "dissent", m, d)
    crossed = communities.cross_community_cases(spark.createDataFrame(votes, "k int, case_id int, member int, role string"), tracked).cache()
    assert {(r.step, r.case_id): (r.cross_type, r.n_majority, r.n_dissent) for r in crossed.collect()} == want
    summary = {r.case_id: (r.frequency, r.cross_types, r.steps) for r in communities.cross_community_summary(crossed).collect()}
    for case in {c for _, c in want}:
        own = sorted(s for s, c in want if c == case)
        types = sorted({want[s, case][0] for s in own})
        assert summary[case] == (len(own), ", ".join(types), ", ".join(sorted(map(str, own))))
    blocs = spark.createDataFrame([(n, "even" if n % 2 == 0 else "odd") for n in range(30)], "node int, bloc string")
    table = {(r.step, r.track, r.bloc): r.members for r in communities.community_table(tracked, blocs).collect()}
    for (step, track, bloc), listed in table.items():
        own = sorted(n for (_, n), (t, s) in of.items() if (t, s) == (track, step) and ("Unknown" if n >= 30 else ("odd" if n % 2 else "even")) == bloc)
        assert listed == "; ".join(map(str, own))


def test_rounds_write_nodes_not_links(spark, graphs, monkeypatch):
    """Links are written once, in one direction; what a round writes is a row a node, or the links between communities."""
    sizes, write = [], communities.tabled
    monkeypatch.setattr(communities, "tabled", lambda df: (lambda t: sizes.append(t.count()) or t)(write(df)))
    found = communities.communities(spark.createDataFrame(graphs, EDGES))
    assert found.count() == 140
    assert max(sizes) < 2 * len(graphs)


def test_large_graphs_move_in_rounds(spark, graphs, monkeypatch):
    """Graphs that aren't one group, their links in several packs: by rounds only, and by rounds until they are small."""
    own = {k: [e[1:] for e in graphs if e[0] == k] for k in (0, 1)}
    most = {k: max(sequential(own[k], s) for s in range(3)) for k in own}
    monkeypatch.setattr(communities, "PACK", 300, raising=False)
    for few in (0, 1000):
        monkeypatch.setattr(communities, "FEW", few, raising=False)
        found = communities.communities(spark.createDataFrame(graphs, EDGES)).cache()
        quality = {r.k: r.q for r in communities.modularity(spark.createDataFrame(graphs, EDGES), found).collect()}
        assert found.count() == 140 and all(quality[k] >= 0.9 * most[k] for k in own)


def test_links_of_a_run_of_graphs(spark, graphs):
    """A link of all graphs from the first to the last is the same as a row for each; parallel ones add up."""
    runs = [(min(k, 1), 1 + k, a, b, 1) for k, a, b, w in graphs for _ in range(w)]
    rows = [(k, a, b, w) for lo, hi, a, b, w in runs for k in range(lo, hi + 1)]
    got = communities.communities(spark.createDataFrame(runs, "lo int, hi int, source int, target int, weight long"), by=("lo", "hi"))
    assert set(map(tuple, got.collect())) == set(map(tuple, communities.communities(spark.createDataFrame(rows, EDGES)).collect()))


def test_rounds_shuffle_no_links(spark, graphs, monkeypatch):
    """Links are dealt once; a round reads their packs and shuffles what is wanted for a graph's nodes, as bytes."""
    monkeypatch.setattr(communities, "FEW", 0)
    plans, write = [], communities.tabled
    monkeypatch.setattr(communities, "tabled", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or write(df))
    communities.communities(spark.createDataFrame(graphs, EDGES)).count()
    rounds = [p for p in plans if "asked(" in p]
    assert len(rounds) > 5 and all("BroadcastHashJoin" in p for p in rounds)


def test_windows_pairs_are_the_windows_edges(spark):
    """What communities are made of by spans is the graph of each window."""
    sf = "/root/testdata/sf0.001"
    by_edges = communities.communities(graph.fsm14(spark, sf))
    assert set(map(tuple, graph.fsm13(spark, sf).collect())) == set(map(tuple, by_edges.collect()))
