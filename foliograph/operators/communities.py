"""Communities of weighted graphs by modularity, many graphs in one job, and what follows from them window by window.

Modularity compares the weight inside communities with what the nodes' degrees alone would give. Every node starts as a
community. A small graph is one group, in which nodes move one at a time to the neighbouring community that gains most. Of
a large one a seeded share of the nodes moves at once in a round, and the graph keeps a round only if its modularity rose.
After a few rounds, or when no share moves to a gain, communities are contracted to nodes of a smaller weighted graph, and
it begins anew, until that gains next to nothing.

A round is one pass over the links. They lie in packs, a node's links in one, as bytes; what a graph's nodes need (a few
numbers each) is one row, which is broadcast to the packs of its links. So the links of a graph never have to fit into one
task, and neither they nor sums of them by node and community are shuffled in a round.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from foliograph.operators.steps import tabled

#: Rises of modularity below the first don't count; rounds and contractions go on while the graph rises by more than the second.
LEAST, WORTH = 1e-7, 1e-3
#: Single nodes are visited again while a visit to all of them brings more.
SWEEP = 1e-4
#: Shares of the nodes that move in a round: the next smaller one is tried where the last brought nothing.
SHARES = (2, 3, 6)
#: Rounds on the whole graph before its communities are contracted, and at most when they have been merged.
ROUNDS, MORE = 3, 12
#: Links (in both directions) and nodes up to which a graph is one group.
FEW, SOME = 4_000_000, 50_000
#: Seeded orders in which its nodes are visited, fewer if they have more links than the second in all; one at least.
ORDERS, VISITED = 8, 1_000_000
#: Links of a pack, about.
PACK = 1_000_000
#: A table of all nodes and communities of a pack is summed up if it is so many times its links at most.
DENSE = 8

#: The columns of a graph's row besides k: its weight, and of its nodes seed, degree, loop, the communities of a round and
#: those kept, with the weight to the own community and the community wanted; ``at`` has the node that each first node is in.
STATE = "total double, at binary, seed binary, degree binary, loop binary, c binary, kept binary, own binary, wanted binary, q double, tried int, gained double, turn int, done boolean"
COLUMNS = [column.split()[0] for column in STATE.split(", ")]
KINDS = {"node": "i8", "at": "i4", "seed": "i8", "degree": "f8", "loop": "f8", "c": "i4", "kept": "i4", "own": "f8", "wanted": "i4"}


def _rows(batches) -> Iterator[dict]:
    """Rows of Arrow batches one at a time, lists of numbers as arrays."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            yield {name: np.frombuffer(x, KINDS[name]) if name in KINDS and x is not None else x for name, x in row.items()}


def _batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    """Rows as a batch, arrays as bytes."""
    plain = [{name: x.astype(KINDS[name]).tobytes() if name in KINDS and isinstance(x, np.ndarray) else x for name, x in row.items()} for row in rows]
    return pa.RecordBatch.from_pylist(plain, schema)


def _sums(row: np.ndarray, label: np.ndarray, weight: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, label, sum of weight) for each pair that occurs, in their order; weights are above zero."""
    used = np.unique(label) if len(label) < 1000 else np.flatnonzero(np.bincount(label))
    if rows * len(used) <= DENSE * len(row):
        short = np.zeros(used[-1] + 1 if len(used) else 0, "i8")
        short[used] = np.arange(len(used))
        sums = np.bincount(row * len(used) + short[label], weight, rows * len(used))
        at = np.flatnonzero(sums)
        return at // max(len(used), 1), used[at % max(len(used), 1)], sums[at]
    width = int(used[-1]) + 1
    key = row.astype("i8") * width + label
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return key[first] // width, key[first] % width, np.add.reduceat(weight[order], first)


def _wanted(row: np.ndarray, label: np.ndarray, weight: np.ndarray, mine: np.ndarray, degree: np.ndarray, held: np.ndarray, total: float):
    """For nodes with communities ``mine``: the weight to the own community, and the community wanted.

    The one that gains most is wanted, the smallest of those, or the own one if none gains more. ``held`` has the degrees
    of all communities; links are (row, label, weight), from the node at ``row`` to a community.
    """
    r, c, w = _sums(row, label, weight, len(mine))
    same = c == mine[r]
    own, wanted = np.zeros(len(mine)), mine.copy()
    own[r[same]] = w[same]
    stays = np.round(own - degree * (held[mine] - degree) / total, 9)
    r, c, w = r[~same], c[~same], w[~same]
    if len(r):
        worth = np.round(w - degree[r] * held[c] / total, 9)
        first = np.flatnonzero(np.concatenate([[True], r[1:] != r[:-1]]))
        top = np.repeat(np.maximum.reduceat(worth, first), np.diff(np.append(first, len(r))))
        best = np.flatnonzero((worth == top) & (worth > stays[r]))[::-1]
        wanted[r[best]] = c[best]  # of equal ones the last that is set, the smallest, stays
    return own, wanted


def _quality(c, own, loop, degree, total) -> float:
    """Modularity of a graph."""
    held = np.bincount(c, degree)
    return float((own.sum() + loop.sum()) / total - (held * held).sum() / (total * total))


def _mixed(x: np.ndarray) -> np.ndarray:
    """Unsigned numbers whose bits are mixed."""
    for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(by)
    return x ^ (x >> np.uint64(31))


def _moves(seed: np.ndarray, turn: int, share: int) -> np.ndarray:
    """Which nodes move: a seeded share of them."""
    return _mixed(seed.view("u8") + np.uint64((turn + 1) * 0x9E3779B97F4A7C15 % 2**64)) % np.uint64(share) == 0


def _visited(a: np.ndarray, b: np.ndarray, w: np.ndarray, degree: np.ndarray, total: float, own: np.ndarray, draw: np.random.Generator) -> np.ndarray:
    """Communities after single nodes, in a seeded order, have moved from ``own`` for as long as that gains."""
    n = len(degree)
    order = np.argsort(a, kind="stable")
    near, weight, starts = b[order], w[order], np.searchsorted(a[order], np.arange(n + 1)).tolist()
    own, held, rise = own.copy(), np.bincount(own, degree, n), math.inf
    while rise > SWEEP:
        rise = 0.0
        for u in draw.permutation(n).tolist():
            lo, hi = starts[u], starts[u + 1]
            if lo == hi:
                continue
            mine, d = own[u], degree[u]
            labels, held[mine] = own[near[lo:hi]], held[mine] - d
            if n <= DENSE * (hi - lo):
                sums = np.bincount(labels, weight[lo:hi], n)
                worth = sums - held * (d / total)
                stays, worth[sums == 0] = worth[mine], -math.inf
                to = best = worth.argmax()
            else:
                labels, at = np.unique(labels, return_inverse=True)
                sums = np.bincount(at, weight[lo:hi])
                worth = sums - held[labels] * (d / total)
                i = labels.searchsorted(mine)
                stays = worth[i] if i < len(labels) and labels[i] == mine else -held[mine] * (d / total)
                best = worth.argmax()
                to = labels[best]
            if worth[best] > stays + 1e-9:
                rise += 2 * (worth[best] - stays) / total
                own[u] = mine = to
            held[mine] += d
    return own


def _single_moves(a: np.ndarray, b: np.ndarray, w: np.ndarray, degree: np.ndarray, loop: np.ndarray, total: float) -> np.ndarray:
    """Communities of a small graph: nodes move one at a time until that gains little, then communities are its nodes.

    From what is found nodes move again, while that gains; of a few seeded orders the best counts.
    """
    best, most = np.arange(len(degree)), -math.inf
    for seed in range(max(1, min(ORDERS, VISITED // (len(a) + 1)))):
        draw, found, rise, before = np.random.default_rng(seed), np.arange(len(degree)), math.inf, -1.0
        while rise > WORTH:
            ends, weights, degrees, own = (a, b), w, degree, found
            while True:
                own = _visited(*ends, weights, degrees, total, own, draw)
                names, own = np.unique(own, return_inverse=True)
                found = own if len(degrees) == len(degree) else own[found]
                if len(names) == len(degrees):
                    break
                x, y, weights = _sums(own[ends[0]], own[ends[1]], weights, len(names))
                ends, weights, degrees, own = (x[x != y], y[x != y]), weights[x != y], np.bincount(own, degrees), np.arange(len(names))
            q = _quality(found, w[found[a] == found[b]], loop, degree, total)
            rise, before = q - before, q
            if q > most:
                best, most = found, q
    return best


def _settled(packs: DataFrame, state: DataFrame, rounds: int) -> DataFrame:
    """Rows of graphs after rounds of moves from their communities c; at most ``rounds``, or what its nodes call for if none."""
    def asked(batches):
        for batch in batches:
            for x in _rows([batch]):
                near, counts = np.frombuffer(x["near"], "i4"), np.frombuffer(x["counts"], "i4")
                u = np.frombuffer(x["nodes"], "i4")
                row = np.repeat(np.arange(len(u)), counts)
                own, wanted = _wanted(row, x["c"][near], np.frombuffer(x["weights"], "f8"), x["c"][u], x["degree"][u], np.bincount(x["c"], x["degree"]), x["total"])
                part = {"k": x["k"], "nodes": x["nodes"], "own": own, "wanted": wanted}
                yield _batch([part], pa.schema([batch.schema.field("k"), ("nodes", pa.binary()), ("own", pa.binary()), ("wanted", pa.binary())]))

    def stepped(batches):
        for batch in batches:
            schema = pa.schema([f for f in batch.schema if f.name != "parts"])
            for x in _rows([batch]):
                own, wanted = np.zeros(len(x["c"])), x["c"].copy()
                for part in x.pop("parts") or []:
                    u = np.frombuffer(part["nodes"], "i4")
                    own[u], wanted[u] = np.frombuffer(part["own"], "f8"), np.frombuffer(part["wanted"], "i4")
                q = _quality(x["c"], own, x["loop"], x["degree"], x["total"])
                rise = q - x["q"] if x["turn"] else math.inf
                if rise > LEAST:
                    x |= {"kept": x["c"], "own": own, "wanted": wanted, "q": q}
                if x["turn"]:
                    x["gained"] += max(rise, 0.0)
                    x["tried"] += rise <= WORTH
                most = rounds or 4 + math.ceil(math.log2(len(own) + 2))
                x["done"] = x["tried"] == len(SHARES) or x["turn"] == most
                if not x["done"]:
                    x["c"] = np.where(_moves(x["seed"], x["turn"], SHARES[x["tried"]]), x["wanted"], x["kept"])
                x["turn"] += 1
                yield _batch([x], schema)

    while state.where("NOT done").limit(1).count():
        open_ = state.where("NOT done")
        near = packs.join(F.broadcast(open_.select("k", "total", "c", "degree")), "k")
        parts = near.mapInArrow(asked, "k long, nodes binary, own binary, wanted binary").groupBy("k").agg(F.collect_list(F.struct("nodes", "own", "wanted")).alias("parts"))
        new = open_.join(parts, "k", "left").select(*state.columns, "parts").mapInArrow(stepped, state.schema)
        state = tabled(new.unionByName(state.where("done")))
    return state


def _gathered(links: DataFrame, rows: int, by: tuple[str, str]) -> DataFrame:
    """(k, part, nodes, counts, near, weights, degree, loop): links (a, b, w) added up, by graph and node.

    ``by`` names the first and the last graph that a link is in; ``rows`` is how many links there are in all. A loop is there
    once, other links in both directions. A node's links are dealt to one task; a row has what a task has of a graph.
    """
    tasks = max(-(-rows // PACK), 1)

    def gathered(batches):
        batches = [batch for batch in batches if batch.num_rows]
        if not batches:
            return
        table = pa.Table.from_batches(batches)
        a, b, w, first, last = (table[x].to_numpy() for x in ("a", "b", "w", "first", "last"))
        (nodes, at), (others, to) = np.unique(a, return_inverse=True), np.unique(b, return_inverse=True)
        order = np.argsort(at * len(others) + to)
        low, count = int(first.min()), (last - first + 1)[order]
        at, to, w, k = (np.repeat(x[order], count) for x in (at, to, w, first))
        k += np.arange(len(k)) - np.repeat(np.cumsum(count) - count, count)
        graph = k - low
        order = np.argsort(graph.astype("u2") if graph.max() < 2**16 else graph, kind="stable")  # small numbers are sorted by digits
        k, at, to = k[order], at[order], to[order]
        new = np.flatnonzero(np.concatenate([[True], (k[1:] != k[:-1]) | (at[1:] != at[:-1]) | (to[1:] != to[:-1])]))
        k, at, near, w = k[new], at[new], others[to[new]], np.add.reduceat(w[order], new)
        bounds = np.append(np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])), len(k))
        part = TaskContext.get().partitionId()
        for lo, hi in zip(bounds, bounds[1:]):
            own, v, weight = nodes[at[lo:hi]], near[lo:hi], w[lo:hi]
            u, place = np.unique(own, return_inverse=True)
            loops, degree = own == v, np.bincount(place, weight)
            loop = np.bincount(place[loops], 2 * weight[loops], len(u))
            lists = (u, np.bincount(place[~loops], minlength=len(u)).astype("i4"), v[~loops], weight[~loops], degree + loop / 2, loop)
            yield pa.RecordBatch.from_arrays([pa.array([k[lo]]), pa.array([part]), *(pa.array([x.tobytes()], pa.binary()) for x in lists)], ["k", "part", "nodes", "counts", "near", "weights", "degree", "loop"])

    longs = [F.col(x).cast("long").alias(y) for x, y in (("a", "a"), ("b", "b"), (by[0], "first"), (by[1], "last"))]
    return links.select(*longs, "w").repartition(tasks, "a").mapInArrow(gathered, "k long, part long, nodes binary, counts binary, near binary, weights binary, degree binary, loop binary")


def _counts(gathered: DataFrame) -> dict[int, int]:
    """How many links, in both directions, each graph has; a row per graph."""
    return {r["k"]: r["n"] for r in gathered.groupBy("k").agg(F.sum(F.octet_length("near") / 8).cast("long").alias("n")).collect()}


def _numbers(level: DataFrame) -> DataFrame:
    """(k, node) of graphs whose nodes are numbers."""
    def numbers(batches):
        for x in _rows(batches):
            yield _batch([{"k": x["k"], "node": np.arange(len(x["c"]))}], pa.schema([("k", pa.int64()), ("node", pa.binary())]))

    return level.select("k", "c").mapInArrow(numbers, "k long, node binary")


def _packs(gathered: DataFrame, counts: dict, nodes: DataFrame) -> DataFrame:
    """(k, nodes, counts, near, weights): what was gathered of each graph in packs of about ``PACK`` links.

    Ends become the places of nodes in ``nodes`` (k, node); ``counts`` has the links of each graph.
    """
    def packed(batches):
        for batch in batches:
            for x in _rows([batch]):
                lists = [np.concatenate([np.frombuffer(part[name], t) for part in x["parts"]]) for name, t in (("nodes", "i8"), ("counts", "i4"), ("near", "i8"), ("weights", "f8"))]
                lists[0], lists[2] = (x["node"].searchsorted(ends).astype("i4") for ends in (lists[0], lists[2]))
                yield pa.RecordBatch.from_arrays([pa.array([x["k"]]), *(pa.array([y.tobytes()], pa.binary()) for y in lists)], ["k", "nodes", "counts", "near", "weights"])

    total = sum(counts.values())
    tasks = max(-(-total // PACK), 1)
    packs = F.lit(1)
    for k, n in counts.items():
        if n > PACK:  # few graphs are
            packs = F.when(F.col("k") == k, F.lit(-(-n // PACK))).otherwise(packs)
    dealt = gathered.withColumn("part", F.pmod("part", packs)).select("k", "part", F.struct("nodes", "counts", "near", "weights").alias("p"))
    parts = dealt.repartition(tasks, "k", "part").groupBy("k", "part").agg(F.collect_list("p").alias("parts"))
    return parts.join(F.broadcast(nodes), "k").select("k", "node", "parts").mapInArrow(packed, "k long, nodes binary, counts binary, near binary, weights binary").persist(StorageLevel.DISK_ONLY)


def _begun(row: dict, degree: np.ndarray, loop: np.ndarray, seed: np.ndarray, at: np.ndarray, c: np.ndarray) -> dict:
    """A graph's row before its first round."""
    return row | {"at": at, "seed": seed, "degree": degree, "loop": loop, "c": c, "kept": c, "own": np.zeros(len(c)), "wanted": c, "q": 0.0, "tried": 0, "gained": 0.0, "turn": 0, "done": False}


def _contracted(packs: DataFrame, state: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows and links (k, a, b, w) of the graphs whose nodes are the communities kept of ``state``; ``gained`` stays.

    Links are summed up in each pack only.
    """
    def nodes(batches):
        for batch in batches:
            for x in _rows([batch]):
                names, first, rank = np.unique(x["kept"], return_index=True, return_inverse=True)
                degree, loop = np.bincount(rank, x["degree"]), np.bincount(rank, x["loop"] + x["own"])
                yield _batch([_begun(x, degree, loop, x["seed"][first], rank[x["at"]], np.arange(len(names))) | {"gained": x["gained"]}], batch.schema)

    def links(batches):
        for x in _rows(batches):
            rank = np.unique(x["kept"], return_inverse=True)[1]
            u, counts, near = (np.frombuffer(x[name], "i4") for name in ("nodes", "counts", "near"))
            names, own = np.unique(rank[u], return_inverse=True)
            a, b, w = _sums(np.repeat(own, counts), rank[near], np.frombuffer(x["weights"], "f8"), len(names))
            a, b, w = names[a][names[a] != b], b[names[a] != b], w[names[a] != b]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(a), x["k"])), pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(w, pa.float64())], ["k", "a", "b", "w"])

    near = packs.join(F.broadcast(state.select("k", "kept")), "k").mapInArrow(links, "k long, a int, b int, w double")
    return tabled(state.mapInArrow(nodes, state.schema)), tabled(near)


def _together(packs: DataFrame, graphs: DataFrame) -> DataFrame:
    """(k, c): communities of the first nodes of small graphs, each with its packs in one row."""
    def alone(batches):
        for batch in batches:
            for x in _rows([batch]):
                ends = [[np.frombuffer(part[name], t) for part in x["parts"] or []] for name, t in (("nodes", "i4"), ("counts", "i4"), ("near", "i4"), ("weights", "f8"))]
                u, counts, near, weights = (np.concatenate(lists) if lists else np.zeros(0, "i4") for lists in ends)
                c = _single_moves(np.repeat(u, counts), near, weights, x["degree"], x["loop"], x["total"])[x["at"]]
                yield _batch([{"k": x["k"], "c": c}], pa.schema([batch.schema.field("k"), ("c", pa.binary())]))

    # a group's row is small beside the work on it: a number of tasks that isn't made smaller by the rows' size
    tasks = packs.sparkSession.sparkContext.defaultParallelism
    parts = packs.repartition(tasks, "k").groupBy("k").agg(F.collect_list(F.struct("nodes", "counts", "near", "weights")).alias("parts"))
    both = graphs.repartition(tasks, "k").join(parts, "k", "left")
    return both.select("k", "at", "degree", "loop", "total", "parts").mapInArrow(alone, "k long, c binary")


def _merged(packs: DataFrame, state: DataFrame) -> DataFrame:
    """(k, c): communities of the first nodes, once those kept of ``state`` have been merged as long as that gains."""
    found, first, held = [], True, []
    while True:
        level, links = _contracted(packs, state)
        size = F.octet_length("c") / 4
        near = tabled(_gathered(links, links.count(), ("k", "k")))
        counts = _counts(near)
        before = {r["k"]: r["n"] for r in state.select("k", size.alias("n")).collect()}
        sizes = {r["k"]: (r["n"], r["gained"]) for r in level.select("k", size.alias("n"), "gained").collect()}
        packs = _packs(near, counts, _numbers(level))
        held.append(packs)
        small = [k for k, (n, _) in sizes.items() if n <= SOME and counts.get(k, 0) <= FEW]
        ended = [k for k, (n, gained) in sizes.items() if k not in small and (n == before[k] or not first and gained <= WORTH)]
        rest = [k for k in sizes if k not in small and k not in ended]
        some = F.col("k").isin(small)
        found.append(tabled(_together(packs.where(some), level.where(some)).unionByName(level.where(F.col("k").isin(ended)).select("k", F.col("at").alias("c")))))
        if not rest:
            break
        state, first = _settled(packs, level.where(F.col("k").isin(rest)).withColumn("gained", F.lit(0.0)), 0), False
    for packs in held:
        packs.unpersist()
    return reduce(DataFrame.unionByName, found)


def communities(links: DataFrame, rows: int = 0, by: tuple[str, str] = ("k", "k")) -> DataFrame:
    """(k, node, community) of (k, source, target, weight): one graph per k; a community is known by its smallest node.

    With ``by`` a link is in all graphs from the first to the last that these columns name; ``rows`` is about how many links
    all graphs have, in both directions, for the number of tasks; they are counted if it isn't given. Nodes and graphs are integers. Edges are undirected; parallel ones add up, loops count for their node. A node without weight
    to others is a community of its own. Null ends, and weights of zero or less, are left out.
    """
    kind = links.schema[by[0]].dataType
    some = links.select(*by, F.col("source").cast("long").alias("a"), F.col("target").cast("long").alias("b"), F.col("weight").cast("double").alias("w"))
    some = some.where("a IS NOT NULL AND b IS NOT NULL AND w > 0").dropna(subset=list(by)).withColumn("ends", F.expr("CASE WHEN a = b THEN array(struct(a, b)) ELSE array(struct(a, b), struct(b AS a, a AS b)) END"))
    near = tabled(_gathered(some.select(*by, "w", F.inline("ends")), rows or 2 * links.count(), by))

    def begun(batches):
        for batch in batches:
            for x in _rows([batch]):
                node, degree, loop = (np.concatenate([np.frombuffer(part[name], t) for part in x["parts"]]) for name, t in (("nodes", "i8"), ("degree", "f8"), ("loop", "f8")))
                order = np.argsort(node)
                node, degree, loop, at = node[order], degree[order], loop[order], np.arange(len(node))
                row = _begun({"k": x["k"], "node": node, "total": float(degree.sum())}, degree, loop, _mixed(_mixed(node.view("u8")) + np.uint64(x["k"] % 2**64)).view("i8"), at, at)
                yield _batch([row], schema)

    wide = f"k long, node binary, {STATE}"
    schema = to_arrow_schema(StructType.fromDDL(wide))
    graphs = tabled(near.groupBy("k").agg(F.collect_list(F.struct("nodes", "degree", "loop")).alias("parts")).mapInArrow(begun, wide))
    counts = _counts(near)
    sizes = {r["k"]: r["n"] for r in graphs.select("k", (F.octet_length("node") / 8).alias("n")).collect()}  # a row per graph
    large = [k for k, n in sizes.items() if n > SOME or counts.get(k, 0) > FEW]
    packs = _packs(near, counts, graphs.select("k", "node"))
    is_large = F.col("k").isin(large)
    found = tabled(_together(packs.where(~is_large), graphs.where(~is_large)))
    if large:
        first = graphs.where(is_large)
        more = first.select("k", "c")
        for rounds in (ROUNDS, MORE):  # single nodes move once more after communities have merged
            state = _settled(packs, tabled(first.drop("node", "c").join(more, "k").select("k", *COLUMNS)), rounds)
            more = _merged(packs, state)
        found = found.unionByName(more)
    packs.unpersist()

    def named(batches):
        for batch in batches:
            for x in _rows([batch]):
                node = x["node"]
                _, first, at = np.unique(x["c"], return_index=True, return_inverse=True)  # nodes are in their order
                k = pa.array(np.full(len(node), x["k"]))
                yield pa.RecordBatch.from_arrays([k, pa.array(node), pa.array(node[first][at])], ["k", "node", "community"])

    return found.join(graphs.select("k", "node"), "k").mapInArrow(named, "k long, node long, community long").withColumn("k", F.col("k").cast(kind))


def modularity(links: DataFrame, members: DataFrame) -> DataFrame:
    """(k, q): modularity of the communities (k, node, community) in the graphs (k, source, target, weight)."""
    ends = [members.select("k", F.col("node").alias(end), F.col("community").alias(f"c_{end}")) for end in ("source", "target")]
    named = links.join(ends[0], ["k", "source"]).join(ends[1], ["k", "target"])
    parts = named.select("k", F.col("c_source").alias("c"), "weight").unionByName(named.select("k", F.col("c_target").alias("c"), "weight")).groupBy("k", "c").agg(F.sum("weight").alias("d"))
    squares = parts.groupBy("k").agg(F.sum(F.col("d") * F.col("d")).alias("squares"), (F.sum("d") / 2).alias("m"))
    inside = named.groupBy("k").agg(F.sum(F.when(F.col("c_source") == F.col("c_target"), F.col("weight")).otherwise(0)).alias("inside"))
    return inside.join(squares, "k").select("k", (F.col("inside") / F.col("m") - F.col("squares") / (4 * F.col("m") * F.col("m"))).alias("q"))


def tracked(members: DataFrame) -> DataFrame:
    """(k, node, community, track, step): members with the track that their community shares with earlier ones.

    Windows without a member don't count: the others are numbered from 0 as ``step``. Of two neighbouring steps the pairs
    of communities with the highest Jaccard come first; a community without a partner begins a track.

    Overlaps are joined and counted by Spark. What the driver orders is a row per pair of communities of neighbouring
    steps that share a member: it grows with windows and communities, not with members or cases.
    """
    numbered = members.select("k").distinct().collect()  # a row per window
    steps = {k: i for i, k in enumerate(sorted(r["k"] for r in numbered))}
    spark = members.sparkSession
    kind = members.schema["k"].dataType.simpleString()
    order = spark.createDataFrame(list(steps.items()), f"k {kind}, step int")
    placed = members.join(F.broadcast(order), "k")
    sizes = placed.groupBy("step", "community").agg(F.count("*").alias("n"))
    before = placed.select((F.col("step") + 1).alias("step"), "node", F.col("community").alias("old"))
    both = placed.join(before, ["step", "node"]).groupBy("step", "community", "old").agg(F.count("*").alias("both"))
    both = both.join(sizes, ["step", "community"]).join(sizes.select((F.col("step") + 1).alias("step"), F.col("community").alias("old"), F.col("n").alias("m")), ["step", "old"])
    pairs: dict[int, list] = {}
    for r in both.select("step", "community", "old", (F.col("both") / (F.col("n") + F.col("m") - F.col("both"))).alias("j")).collect():
        pairs.setdefault(r["step"], []).append(r)
    named: dict[int, list] = {}
    for r in sizes.select("step", "community").collect():
        named.setdefault(r["step"], []).append(r["community"])
    out, track, fresh = [], {}, 0
    for step in sorted(named):
        names, got = sorted(named[step]), {}
        place = {c: i for i, c in enumerate(names)}
        for r in sorted(pairs.get(step, []), key=lambda r: (-r["j"], -place[r["community"]], -track[r["old"]])):
            if r["community"] not in got and track[r["old"]] not in got.values():
                got[r["community"]] = track[r["old"]]
        for c in names:
            if c not in got:
                got[c], fresh = fresh, fresh + 1
        out += [(step, c, t) for c, t in got.items()]
        track = got
    tracks = spark.createDataFrame(out, f"step int, community {members.schema['community'].dataType.simpleString()}, track int")
    return placed.join(tracks, ["step", "community"]).select("k", "node", "community", "track", "step")


def stability(members: DataFrame) -> DataFrame:
    """(step, stability) of ``tracked`` members: mean over communities of the best Jaccard with one of the step before.

    Only nodes of both steps count; null for the first step and where fewer than two nodes are in both.
    """
    before = members.select((F.col("step") + 1).alias("step"), "node", F.col("track").alias("old"))
    n = members.join(before, ["step", "node"]).groupBy("step", "track", "old").agg(F.count("*").alias("both"))
    n = n.join(n.groupBy("step", "track").agg(F.sum("both").alias("now")), ["step", "track"]).join(n.groupBy("step", "old").agg(F.sum("both").alias("then")), ["step", "old"])
    best = n.groupBy("step", "track").agg(F.max(F.col("both") / (F.col("now") + F.col("then") - F.col("both"))).alias("best"), F.first("now").alias("now"))
    mean = best.groupBy("step").agg(F.when(F.sum("now") >= 2, F.round(F.avg("best"), 4)).alias("stability"))
    return members.select("step").distinct().join(mean, "step", "left")


def transitions(members: DataFrame) -> DataFrame:
    """(step, node, change): nodes that entered or exited since the step before."""
    now = members.select("step", "node")
    last = F.broadcast(members.agg(F.max("step").alias("last")))  # one row
    moved = now.select((F.col("step") + 1).alias("step"), "node")
    entered = now.join(moved, ["step", "node"], "left_anti").withColumn("change", F.lit("entered"))
    exited = moved.join(now, ["step", "node"], "left_anti").join(last, F.col("step") <= F.col("last")).select("step", "node", F.lit("exited").alias("change"))
    return entered.unionByName(exited)


def cross_community_cases(placed: DataFrame, members: DataFrame) -> DataFrame:
    """(step, case_id, cross_type, n_majority, n_dissent): cases of a window whose majority or dissent spans communities.

    ``placed`` is (k, case_id, member, role), ``members`` is ``tracked``; voters outside the window's graph don't count. Where
    ``placed`` is dealt by case and ``members`` is broadcast, nothing else is shuffled.
    """
    named = placed.join(members.select("k", F.col("node").alias("member"), "track", "step"), ["k", "member"])
    tracks = named.select("step", "case_id", "role", "track").distinct()
    sides = tracks.groupBy("step", "case_id").agg(*(F.count_if(F.col("role") == r).alias(f"n_{r}") for r in ("majority", "dissent")))
    crossed = F.when((F.col("n_majority") >= 2) & (F.col("n_dissent") >= 2), "both").when(F.col("n_majority") >= 2, "majority").when(F.col("n_dissent") >= 2, "dissent")
    return sides.select("step", "case_id", crossed.alias("cross_type"), "n_majority", "n_dissent").where("cross_type IS NOT NULL")


def cross_community_summary(crossed: DataFrame) -> DataFrame:
    """(case_id, frequency, cross_types, steps): in how many windows, how and in which a case crossed communities."""
    steps = F.array_join(F.sort_array(F.collect_set("step")).cast("array<string>"), ", ")
    return crossed.groupBy("case_id").agg(F.count("*").alias("frequency"), F.array_join(F.sort_array(F.collect_set("cross_type")), ", ").alias("cross_types"), steps.alias("steps"))


def community_table(members: DataFrame, blocs: DataFrame) -> DataFrame:
    """(step, track, bloc, members, n): members of each community by appointing bloc; ``blocs`` is (node, bloc).

    The list is of nodes of one window, community and bloc; it is the report that is asked for.
    """
    named = members.join(blocs, "node", "left").withColumn("bloc", F.coalesce("bloc", F.lit("Unknown")))
    listed = F.array_join(F.sort_array(F.collect_list("node")).cast("array<string>"), "; ")
    return named.groupBy("step", "track", "bloc").agg(listed.alias("members"), F.count("*").alias("n"))
