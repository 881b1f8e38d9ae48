"""Trie of conversation prefixes, with leaf counts and savings rolled up by pointer jumping.

A node is a distinct sequence of first turns and is known by its digest; an edge leads from its digest to its parent's.
Rolled-up values take a number of rounds that grows with the logarithm of the depth: in round k every node that has an
ancestor 2^k above it adds what it holds so far to that ancestor, then points to the one 2^(k+1) above.

No step needs a whole conversation or a whole node in one task. Turns are ranked by a range partition of all rows and
the offsets of its parts; digests of prefixes are made in chunks of ``CHUNK`` turns, and those of whole chunks are joined
by doubling as well. The ids that end at a node are joined in spans of ``SPAN`` ids, so at most as many at once; the text
that is hashed for a node is read span by span by one task, since SHA-256 has no parts.

Cases: rows without a conversation id are left aside; null roles and texts are empty; turns that tie are ordered by role,
then by the digest of role and text; repeated rows are turns each. Other columns, whatever their names, are left aside.
An empty table has no node.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliograph.llm._common import stored, joined_unevenly, table

#: Turns whose digests are made together, ids of conversations that are joined together.
CHUNK, SPAN = 64, 4096
#: The most turns that a conversation takes from another one.
SHARED = 5
ROOT = b""


def _hash(*parts: bytes) -> bytes:
    return hashlib.blake2b(b"".join(parts), digest_size=16).digest()


def ranked(turns: DataFrame) -> DataFrame:
    """(conv, pos, turn_digest, size) of (conv, turn, role, text): each turn's place in its conversation, from 0.

    All rows are dealt by range, so a conversation of any length is spread; within a part the place is a running count.
    A conversation that begins in an earlier part gets that count as offset; at most one does in each part.
    """
    sized = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
    slim = turns.select("conv", "turn", "role", F.unhex(F.sha2(sized, 256)).substr(1, 16).alias("turn_digest"), F.char_length("text").cast("long").alias("size"))
    # equal rows may be many: they are told apart by chance, from a seed
    dealt = slim.withColumn("chance", F.rand(13))
    order = ["conv", "turn", "role", "turn_digest", "chance"]
    spread = dealt.repartitionByRange(int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions")), *order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        from pyspark import TaskContext

        part, last, count = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            conv = batch.column(0).to_numpy()
            if not len(conv):
                continue
            index = np.arange(len(conv))
            starts = np.append(True, conv[1:] != conv[:-1])
            place = index - np.maximum.accumulate(np.where(starts, index, 0))
            if conv[0] == last:
                place[: np.argmin(conv == last) or len(conv)] += count
            last, count = conv[-1], int(place[-1]) + 1
            columns = [batch.column(0), pa.array(np.full(len(conv), part)), pa.array(place), batch.column(3), batch.column(4)]
            yield pa.RecordBatch.from_arrays(columns, ["conv", "part", "place", "turn_digest", "size"])

    placed = stored(spread.mapInArrow(run, "conv long, part long, place long, turn_digest binary, size long"))
    sizes = placed.groupBy("conv", "part").agg(F.count("*").alias("n"))
    parted = sizes.join(sizes.groupBy("conv").agg(F.count("*").alias("parts")).where("parts > 1").select("conv"), "conv", "left_semi")
    pairs = parted.select("conv", "part", "n").join(parted.select("conv", F.col("part").alias("later")), "conv").where("part < later")
    offsets = pairs.groupBy("conv", F.col("later").alias("part")).agg(F.sum("n").alias("offset"))
    return placed.join(F.broadcast(offsets), ["conv", "part"], "left").select("conv", (F.col("place") + F.coalesce("offset", F.lit(0))).alias("pos"), "turn_digest", "size")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns, conversations) once each conversation c begins with the first h turns of c - c % 100 in place of its own.

    h is crc32 of c's decimal text, modulo 6. Turns are (conv, p, turn_digest, size) with p from 1; conversations are
    (conv, n) with n = 0 where no turn is left.
    """
    own = stored(ranked(turns))
    base, h = F.col("conv") - F.col("conv") % 100, F.crc32(F.col("conv").cast("string").cast("binary")) % (SHARED + 1)
    sizes = stored(own.groupBy("conv").agg(F.count("*").alias("own")).withColumns({"base": base, "h": h}))
    heads = own.where(F.col("pos") < SHARED).where("conv % 100 = 0").select(F.col("conv").alias("base"), "pos", "turn_digest", "size")
    lead = sizes.where("conv <> base").join(heads, "base").where("pos < h").select("conv", (F.col("pos") + 1).alias("p"), "turn_digest", "size")
    base_sizes = sizes.where("conv = base").select("base", F.col("own").alias("of_base"))
    convs = sizes.join(base_sizes, "base", "left").withColumn("taken", F.least("h", F.coalesce("of_base", F.lit(0))))
    convs = stored(convs.select("conv", "own", "h", "taken", (F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("n")))
    kept = own.where((F.col("conv") % 100 == 0) | (F.col("pos") >= h))
    kept = joined_unevenly(kept, convs.select("conv", "taken", "h"), "conv", convs.select("conv", "own"))
    p = F.when(F.col("conv") % 100 == 0, F.col("pos") + 1).otherwise(F.col("pos") - F.col("h") + F.col("taken") + 1)
    n = F.when(F.col("conv") % 100 == 0, F.col("own")).otherwise(F.col("n"))
    return lead.unionByName(kept.select("conv", p.alias("p"), "turn_digest", "size")), convs.select("conv", n.alias("n"))


def chunked(turns: DataFrame) -> DataFrame:
    """(conv, j, turns, whole, before, last): chunks of each conversation with the digest of all that is before them.

    ``turns`` holds (p, turn_digest, size) in order; ``whole`` is the chunk's own digest if it is full.
    """
    grouped = turns.groupBy("conv", F.floor((F.col("p") - 1) / CHUNK).alias("j")).agg(F.sort_array(F.collect_list(F.struct("p", "turn_digest", "size"))).alias("turns"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = []
            for turns in batch.column(2).to_pylist():
                digest = ROOT
                for turn in turns if len(turns) == CHUNK else ():
                    digest = _hash(digest, turn["turn_digest"])
                whole.append(digest or None)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(whole, pa.binary())], [*batch.schema.names, "whole"])

    kind = grouped.schema["turns"].dataType.simpleString()
    chunks = stored(grouped.mapInArrow(run, f"conv long, j long, turns {kind}, whole binary"))
    # doubling: after round k, ``through`` is the digest of the last 2^k chunks up to j, or of all of them if they are fewer
    through = stored(chunks.where("whole IS NOT NULL").select("conv", "j", F.col("whole").alias("through")))
    most, step = through.agg(F.max("j")).first()[0], 1
    while most is not None and step <= most:
        before = through.select("conv", (F.col("j") + step).alias("j"), F.col("through").alias("before"))
        both = F.unhex(F.md5(F.concat("before", "through")))
        through = stored(through.join(before, ["conv", "j"], "left").select("conv", "j", F.when(F.col("before").isNull(), F.col("through")).otherwise(both).alias("through")))
        step *= 2
    before = through.select("conv", (F.col("j") + 1).alias("j"), F.col("through").alias("before"))
    last_of = chunks.where("whole IS NOT NULL").select("conv", (F.col("j") + 1).alias("j"), F.col("whole").alias("whole_before"))
    earlier = through.select("conv", (F.col("j") + 2).alias("j"), F.col("through").alias("before_that"))
    known = before.join(last_of, ["conv", "j"]).join(earlier, ["conv", "j"], "left")
    return chunks.drop("whole").join(known, ["conv", "j"], "left")


def members(turns: DataFrame) -> DataFrame:
    """(conv, depth, node, parent, size): the nodes that each conversation runs through, below the root."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {"conv": [], "depth": [], "node": [], "parent": [], "size": []}
            for row in batch.to_pylist():
                before, inner = row["before"], ROOT
                named = (lambda x, y: _hash(x, y) if x else y)
                parent = named(row["before_that"], row["whole_before"]) if before else ROOT
                for turn in row["turns"]:
                    inner = _hash(inner, turn["turn_digest"])
                    node = named(before, inner)
                    for c, x in zip(out, (row["conv"], turn["p"], node, parent, turn["size"])):
                        out[c].append(x)
                    parent = node
            yield pa.RecordBatch.from_pydict(out, pa.schema([("conv", pa.int64()), ("depth", pa.int64()), ("node", pa.binary()), ("parent", pa.binary()), ("size", pa.int64())]))

    return chunked(turns).mapInArrow(run, "conv long, depth long, node binary, parent binary, size long")


def digests_of_ends(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256) of (node, conv): SHA-256 of the ids that end at a node, ascending, joined by commas."""
    spans = ends.groupBy("node", F.floor(F.col("conv") / SPAN).alias("span")).agg(F.array_join(F.sort_array(F.collect_list("conv")).cast("array<string>"), ",").alias("ids"))
    ordered = spans.repartition("node").sortWithinPartitions("node", "span")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node = state = None
        for batch in batches:
            nodes, found = [], []
            for own, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if own == node:
                    state.update(b"," + ids.encode())
                    continue
                if state:
                    nodes.append(node)
                    found.append(state.hexdigest())
                node, state = own, hashlib.sha256(ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(found, pa.string())], ["node", "ends_sha256"])
        if state:
            yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([state.hexdigest()])], ["node", "ends_sha256"])

    return ordered.mapInArrow(run, "node binary, ends_sha256 string")


def rolled_up(nodes: DataFrame, values: list[str]) -> DataFrame:
    """(node, *values) summed over each node's subtree, of (node, parent, depth, *values); the root has no parent.

    Each round keeps only the nodes that still have an ancestor so far above, and writes what they add to it.
    """
    sums = [F.sum(v).alias(v) for v in values]
    live = stored(nodes.where("parent IS NOT NULL").select("node", F.col("parent").alias("to"), "depth", *values))
    added, reach = [nodes.select("node", *values)], 1
    while not live.isEmpty():
        given = stored(live.groupBy("to").agg(*sums, F.count("*").alias("givers")))
        added.append(given.select(F.col("to").alias("node"), *values))
        # what a node got in this round it hands on in the next ones, to the ancestor twice as far away
        got = given.select(F.col("to").alias("node"), *(F.col(v).alias(f"got_{v}") for v in values))
        far = live.where(F.col("depth") >= 2 * reach)
        up = live.select(F.col("node").alias("to"), F.col("to").alias("next"))
        far = joined_unevenly(far, up, "to", given.select("to", "givers"))
        far = far.join(got, "node", "left").select("node", F.col("next").alias("to"), "depth", *((F.col(v) + F.coalesce(f"got_{v}", F.lit(0))).alias(v) for v in values))
        live, reach = stored(far), reach * 2
    total = added[0]
    for more in added[1:]:
        total = total.unionByName(more)
    return total.groupBy("node").agg(*sums)


def trie(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    slim = df.select(F.col(conv).cast("long").alias("conv"), F.col(turn).alias("turn"), *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((role, "role"), (text, "text"))))
    turns, convs = rebuilt(slim.where("conv IS NOT NULL"))
    convs, rows = stored(convs), stored(members(turns))
    root = F.lit(ROOT)
    top = convs.agg(F.min("conv").alias("conv"), F.lit(0).cast("long").alias("depth"), F.count("*").alias("n_convs"), F.lit(0).cast("long").alias("size"))
    top = top.where("n_convs > 0").select(root.alias("node"), F.lit(None).cast("binary").alias("parent"), "conv", "depth", "n_convs", "size")
    below = rows.groupBy("node").agg(F.min("parent").alias("parent"), F.min("conv").alias("conv"), F.min("depth").alias("depth"), F.count("*").alias("n_convs"), F.min("size").alias("size"))
    nodes = stored(top.unionByName(below))
    children = stored(nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children")))
    nodes = nodes.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    leaf, saved = F.when(F.col("n_children") == 0, 1).otherwise(0), (F.col("n_convs") - 1) * F.col("size")
    nodes = stored(nodes.withColumns({"n_leaves": leaf.cast("long"), "saved_tokens": saved}))
    sums = rolled_up(nodes, ["n_leaves", "saved_tokens"])
    up = nodes.select(F.col("node").alias("parent"), F.col("conv").alias("parent_conv_id"))
    parents = joined_unevenly(nodes.where("parent IS NOT NULL").select("node", "parent"), up, "parent", children.select(F.col("node").alias("parent"), "n_children")).select("node", "parent_conv_id")
    ended = convs.where("n > 0").join(rows, (convs.conv == rows.conv) & (F.col("n") == F.col("depth"))).select("node", convs.conv)
    ends = digests_of_ends(ended.unionByName(convs.where("n = 0").select(root.alias("node"), "conv")))
    found = nodes.select("node", F.col("conv").alias("conv_id"), "depth", "n_convs", "n_children").join(sums, "node").join(parents, "node", "left").join(ends, "node", "left")
    nothing = hashlib.sha256(b"").hexdigest()
    return found.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(table(spark, sf_dir, "conversations"))
