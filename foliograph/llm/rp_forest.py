"""Embedding near-duplicates by a forest of random-projection trees with spill overlap.

Every tree splits the vectors again and again at the median of a random projection; a vector within the overlap of
a cut goes to both sides, so that close vectors rarely part, and several trees see to the rest. Vectors are compared
by cosine, in double precision, only within leaves. A pair that meets in several leaves counts in the first of them
alone, so links are counted without ever being listed; a leaf passes on counts and one edge per vector and linked
part, which are then united.

The upper splits are fitted on a bounded sample. Leaves that are still too large are split further by distributed
medians as long as that helps; what no cut divides is compared in blocks. Equal vectors become one beforehand, with
their number. Vectors of different lengths are never compared.

Vectors are told apart by what they hold, so different ones may share an id; each row has its own result.
A vector that is null, zero, or holds a null or non-finite component links with nothing, as does one with a null id:
n_links 0, its own component, kept. Other columns are left aside.
"""

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliograph.llm._common import components, durable, table

COSINE = 0.95
TREES, LEAF = 4, 600
#: Vectors that the upper splits are fitted on, at most; a fitted leaf has this many of them at least.
SAMPLE, LEAST = 8192, 48
#: Half-width of the overlap, as a share of a linked pair's typical distance along a random direction.
OVERLAP = 0.6
#: Vectors of a leaf that one task compares with as many others.
BLOCK = 1500
DEEPER = 40

Tree = tuple | None  # (direction, cut, low, high)


def overlap(dim: int, cosine: float) -> float:
    return OVERLAP * float(np.sqrt(2 - 2 * cosine) / np.sqrt(dim))


def grow(sample: np.ndarray, margin: float, leaf: int, draw: np.random.Generator) -> Tree:
    if len(sample) < 2 * leaf:
        return None
    direction = draw.standard_normal(sample.shape[1])
    direction /= np.linalg.norm(direction)
    along = sample @ direction
    cut = float(np.median(along))
    low, high = along < cut + margin, along >= cut - margin
    if max(low.sum(), high.sum()) > 0.9 * len(sample):
        return None
    return direction, cut, grow(sample[low], margin, leaf, draw), grow(sample[high], margin, leaf, draw)


def leaves(tree: Tree, x: np.ndarray, margin: float, rows: np.ndarray | None = None, node: int = 1) -> Iterator[tuple[int, np.ndarray]]:
    """(leaf, rows of ``x`` in it); a row is in several leaves if cuts pass near it."""
    rows = np.arange(len(x)) if rows is None else rows
    if tree is None or not len(rows):
        yield node, rows
        return
    direction, cut, low, high = tree
    along = x[rows] @ direction
    yield from leaves(low, x, margin, rows[along < cut + margin], 2 * node)
    yield from leaves(high, x, margin, rows[along >= cut - margin], 2 * node + 1)


def unit(vectors) -> np.ndarray:
    x = np.stack([np.asarray(v, np.float64) for v in vectors])
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _distinct(vectors: DataFrame, key: str, vector: str) -> tuple[DataFrame, DataFrame]:
    """(rows that can link: id, k1, k2; different vectors: k1, k2, id, n, v). k1, k2: 128 bits of the vector.

    Vectors of floats travel as floats; they are compared as doubles.
    """
    kind = "float" if vectors.schema[vector].dataType.simpleString() == "array<float>" else "double"
    v = F.col(vector).cast(f"array<{kind}>")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = vectors.select(F.col(key).cast("long").alias("id"), v.alias("v")).where(F.col("id").isNotNull() & F.col("v").isNotNull())
    rows = rows.where(finite & F.exists("v", lambda x: x != 0))
    rows = rows.withColumn("v", F.transform("v", lambda x: x + F.lit(0).cast(kind))).withColumns({ "k1": F.xxhash64(F.lit(1), "v"), "k2": F.xxhash64(F.lit(2), "v")})
    reps = rows.groupBy("k1", "k2").agg(F.min("id").alias("id"), F.count("*").alias("n"), F.first("v").alias("v"))
    return rows.select("id", "k1", "k2"), reps


def _planted(reps: DataFrame, cosine: float, trees: int, leaf: int, sample: int) -> DataFrame:
    """(rep, n, v, home): each vector once per leaf that holds it, over all trees."""
    spark = reps.sparkSession
    picked = reps.orderBy(F.xxhash64("k1"), "k1", "k2").select("v").limit(sample).collect()
    total = max(1, reps.count())
    by_dim: dict[int, list] = {}
    for r in picked:
        by_dim.setdefault(len(r["v"]), []).append(r["v"])
    part = max(LEAST, int(leaf * len(picked) / total)) if total > len(picked) else leaf
    draw = np.random.default_rng(17)
    forest = {d: [grow(unit(v), overlap(d, cosine), part, draw) for _ in range(trees)] for d, v in sorted(by_dim.items())}
    shared = spark.sparkContext.broadcast(forest)  # sample / LEAST cuts a tree at most

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, rows in batch.groupby(batch["v"].map(len)):
                x = unit(rows["v"])
                for t, tree in enumerate(shared.value.get(dim, [None])):
                    for node, at in leaves(tree, x, overlap(dim, cosine)):
                        if len(at):
                            yield rows.iloc[at].assign(home=f"{dim}.{t}.{node}")

    return reps.select("rep", "n", "v").mapInPandas(run, f"rep long, n long, v {reps.schema['v'].dataType.simpleString()}, home string")


def _projection(turn: int):
    """Place of each vector along the random direction that this turn has for its length."""

    def along(vectors: pd.Series) -> pd.Series:
        out = np.empty(len(vectors))
        for dim, at in pd.Series(range(len(vectors))).groupby(vectors.map(len).to_numpy()):
            d = np.random.default_rng([turn, dim]).standard_normal(dim)
            out[at.to_numpy()] = unit(vectors.iloc[at.to_numpy()]) @ (d / np.linalg.norm(d))
        return pd.Series(out)

    return F.pandas_udf(along, "double")


def _split_deeper(rows: DataFrame, cosine: float, leaf: int) -> DataFrame:
    """Splits leaves of more than four times the wanted size at distributed medians, as long as that helps."""
    rows = durable(rows)
    done = []
    for turn in range(DEEPER):
        sizes = durable(rows.groupBy("home").agg(F.count("*").alias("size")))
        large = sizes.where(F.col("size") > 4 * leaf)
        if large.isEmpty():
            break
        split = rows.join(large, "home")
        split = durable(split.withColumn("p", _projection(turn)("v")))
        cut = split.groupBy("home").agg(F.percentile_approx("p", 0.5, 1000).alias("cut"))
        margin = F.lit(OVERLAP * float(np.sqrt(2 - 2 * cosine))) / F.sqrt(F.size("v"))
        sides = F.array_compact(F.array(F.when(F.col("p") < F.col("cut") + margin, F.lit("0")), F.when(F.col("p") >= F.col("cut") - margin, F.lit("1"))))
        split = split.join(cut, "home").select("rep", "n", "v", "home", "size", F.explode(sides).alias("side"))
        split = durable(split.withColumn("child", F.concat("home", F.lit("/"), "side")))
        child = split.groupBy("home", "size", "child").agg(F.count("*").alias("got")).groupBy("home").agg((F.max("got") < 0.9 * F.first("size")).alias("helps"))
        judged = split.join(child, "home")
        done.append(rows.join(large, "home", "left_anti").select("rep", "n", "v", "home"))
        done.append(judged.where("NOT helps").select("rep", "n", "v", "home").dropDuplicates(["rep", "home"]))
        rows = durable(judged.where("helps").select("rep", "n", "v", F.col("child").alias("home")))
    return reduce(DataFrame.union, done, rows)


def compare(group: pd.DataFrame, cosine: float) -> pd.DataFrame:
    """Links within one leaf, or between two blocks of it: (rep, links counted here, smallest linked id here)."""
    group = group.drop_duplicates(["rep", "side"])
    home, low, high = group["home"].iloc[0], group["low"].iloc[0], group["high"].iloc[0]
    a = group[group["side"] == low].sort_values("rep")
    b = a if low == high else group[group["side"] == high].sort_values("rep")
    if not len(a) or not len(b):
        return pd.DataFrame({"rep": [], "links": [], "to": []})
    x = unit(a["v"])
    y = x if b is a else unit(b["v"])
    linked = x @ y.T >= cosine
    if b is a:
        np.fill_diagonal(linked, False)
    i, j = np.nonzero(linked)
    counted = linked
    if len(i):
        # a pair that also meets in a home before this one is counted there
        counted = linked.copy()
        before: dict[str, tuple[list[int], list[int]]] = {}
        for side, (rows, used) in enumerate(((a, np.unique(i)), (b, np.unique(j)))):
            homes = rows["homes"].to_numpy()
            for k in used:
                for h in homes[k]:
                    if h < home:
                        before.setdefault(h, ([], []))[side].append(k)
        for p, q in before.values():
            if p and q:
                counted[np.ix_(p, q)] = False
    ra, rb = a["rep"].to_numpy(), b["rep"].to_numpy()
    na, nb = a["n"].to_numpy(), b["n"].to_numpy()
    out = [pd.DataFrame({"rep": ra, "links": counted @ nb, "to": np.where(linked.any(1), rb[linked.argmax(1)], ra)})]
    if b is not a:
        out.append(pd.DataFrame({"rep": rb, "links": counted.T @ na, "to": np.where(linked.any(0), ra[linked.argmax(0)], rb)}))
    # the first linked id alone can leave a part in pieces; a forest over the links joins them
    root = {r: r for r in np.r_[ra, rb].tolist()}

    def top(r):
        while root[r] != r:
            root[r] = root[root[r]]
            r = root[r]
        return r

    more = []
    for o in out:
        for r, t in zip(o["rep"].tolist(), o["to"].tolist()):
            r, t = top(r), top(t)
            if r != t:
                root[max(r, t)] = min(r, t)
    tops_a, tops_b = np.array([top(r) for r in ra.tolist()]), np.array([top(r) for r in rb.tolist()])
    for k, m in zip(*np.nonzero(linked & (tops_a[:, None] != tops_b[None, :]))):
        r, t = top(ra[k].item()), top(rb[m].item())
        if r != t:
            root[max(r, t)] = min(r, t)
            more.append((ra[k].item(), 0, rb[m].item()))
    out.append(pd.DataFrame(more, columns=["rep", "links", "to"]))
    got = pd.concat(out)
    return got[(got["links"] > 0) | (got["to"] != got["rep"])].astype("int64")


def near_vectors(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", cosine: float = COSINE, trees: int = TREES, leaf: int = LEAF, sample: int = SAMPLE, block: int = BLOCK) -> DataFrame:
    """(key, n_links, component_id, kept) for each row of ``vectors``."""
    rows, reps = _distinct(vectors, key, vector)
    reps = durable(reps.withColumn("rep", F.monotonically_increasing_id()))  # as written, a vector keeps its number
    placed = _split_deeper(_planted(reps, cosine, trees, leaf, sample), cosine, leaf)
    placed = durable(placed.withColumn("home", F.xxhash64("home")))
    homes = placed.groupBy("rep").agg(F.collect_set("home").alias("homes"))  # a vector's leaves: bounded by the trees' depth
    sizes = placed.groupBy("home").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    tasks = placed.join(homes, "rep").join(sizes, "home")
    mine = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    tasks = tasks.withColumn("side", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tasks = tasks.select("home", F.least("side", "other").alias("low"), F.greatest("side", "other").alias("high"), "side", "rep", "n", "v", "homes")
    found = durable(tasks.groupBy("home", "low", "high").applyInPandas(lambda g: compare(g, cosine), "rep long, links long, to long"))
    parts = components(found.where("rep <> to").select("rep", "to"))
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    each = reps.drop("v").join(links, "rep", "left").join(parts, F.col("rep") == F.col("node"), "left").withColumn("part", F.coalesce("component", "rep"))
    each = each.join(each.groupBy("part").agg(F.min("id").alias("component_id")), "part")
    each = each.select("k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).cast("long").alias("n_links"), "component_id")
    linked = rows.join(each, ["k1", "k2"]).select("id", "n_links", "component_id")
    v = F.col(vector).cast("array<double>")
    able = F.col(key).isNotNull() & v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(v, lambda x: x != 0.0)
    alone = vectors.where(~F.coalesce(able, F.lit(False))).select(F.col(key).cast("long").alias("id"), F.lit(0).cast("long").alias("n_links"), F.col(key).cast("long").alias("component_id"))
    return linked.union(alone).select(F.col("id").alias(key), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def op1_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))
