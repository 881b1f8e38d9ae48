"""Variable-capacity best-fit packing of documents into training sequences.

Several sequence lengths are permitted, each at a cost. A document longer than the largest is cut, at words, into
pieces of that length and a rest. Pieces are packed by best fit, longest first: each goes to the open bin with the
least room that still takes it; if there is none, a bin of the size that costs least per word opens, so one shard holds
bins of several sizes. What a size costs per word depends on how such bins fill with the pieces that are there, so
packing is repeated: each pass opens bins by the costs that the one before had with pieces of that share of a bin,
the first ones with one size throughout. The cheapest pass stays, after each bin has been cut down to the smallest
permitted length that its contents need.

Packing is done in shards of about ``SHARD`` pieces that a hash of the piece deals out, so no task grows with the
input and no key can make one large; a shard of thousands of pieces fills its bins as well as the whole would, but
for its last few. Lengths are words here; any column of lengths will do.

A null or wordless document has one piece of length 0 and no bin. Rows that occur again are packed again. Rows with
a null id are packed like others. Other columns are left aside.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliograph.llm._common import durable, table, words

LENGTHS = (256, 512, 1024, 2048)
SHARD = 20_000


def cost(length: int) -> float:
    """What a sequence costs: its length, attention that grows with its square, and a fixed overhead."""
    return length + length * length / 8192 + 16


#: Passes that open bins by the costs of the pass before; shares of a bin that the opening piece may take.
PASSES, SHARES = 5, 8


def _one_pass(sizes: Sequence[int], opened: Callable[[int], int]) -> tuple[list[int], list[int], list[tuple[int, int]]]:
    """(bin of each piece, contents of each bin, (length, first piece) of each bin when it was opened)"""
    of, used, first = [], [], []
    free: dict[int, list[int]] = {}  # room -> bins with just so much
    mask = 0  # bit r: there is a bin with room r
    for size in sizes:
        fits = mask >> size
        if fits:
            left = size + ((fits & -fits).bit_length() - 1)
            b = free[left].pop()
            if not free[left]:
                mask &= ~(1 << left)
        else:
            left = opened(size)
            b = len(used)
            used.append(0)
            first.append((left, size))
        of.append(b)
        used[b] += size
        if left > size:
            if not free.setdefault(left - size, []):
                mask |= 1 << (left - size)
            free[left - size].append(b)
    return of, used, first


def best_fit(sizes: Sequence[int], lengths: Sequence[int] = LENGTHS) -> tuple[list[int], list[int], list[int]]:
    """(bin of each piece, its place in the bin, final length of each bin) for pieces in the given order.

    Pieces must come longest first and be no longer than the largest permitted length.
    """
    lengths = sorted(lengths)
    fitting = lambda size: next(x for x in lengths if x >= size)
    best: tuple[float, list[int], list[int]] | None = None
    known: dict[tuple[int, int], list[float]] = {}  # (length, share of the first piece) -> [cost, words] of such bins

    def per_word(length: int, size: int) -> float:
        spent, words_ = known.get((length, size * SHARES // length), (0.0, 0))
        return spent / words_ if words_ else cost(length) / max(size, 0.97 * length)

    def cheapest(size: int) -> int:
        return min((x for x in lengths if x >= size), key=lambda x: (per_word(x, size), x))

    ways = [lambda size, p=p: max(p, fitting(size)) for p in lengths] + [cheapest] * PASSES
    for way in ways:
        of, used, first = _one_pass(sizes, way)
        final = [fitting(u) for u in used]
        total = sum(map(cost, final))
        if best is None or total < best[0]:
            best = (total, of, final)
        for (length, size), u, f in zip(first, used, final):
            got = known.setdefault((length, size * SHARES // length), [0.0, 0])
            got[0] += cost(f)
            got[1] += u
    _, of, final = best
    place, at = [], [0] * len(final)
    for size, b in zip(sizes, of):
        place.append(at[b])
        at[b] += size
    return of, place, final


def pieces(docs: DataFrame, key: str, length: str, largest: int) -> DataFrame:
    """(key, piece, start, size): each document cut to pieces of ``largest`` and a rest."""
    n = F.col(length)
    cut = F.transform(
        F.sequence(F.lit(0), F.greatest(F.ceil(n / largest).cast("int") - 1, F.lit(0))),
        lambda i: F.struct(i.alias("piece"), (i * largest).cast("long").alias("start"), F.least(n - i.cast("long") * largest, F.lit(largest)).cast("int").alias("size")),
    )
    return docs.select(key, F.inline(cut))


def pack(docs: DataFrame, key: str = "doc_id", length: str = "n_words", lengths: Sequence[int] = LENGTHS, shard: int = SHARD) -> DataFrame:
    """(key, piece, start, size, shard, bin, bin_length, bin_start) for each piece of each row of ``docs``."""
    largest = max(lengths)
    cut = pieces(durable(docs.select(key, length)), key, length, largest)  # lengths are counted once
    shards = max(1, -(-cut.count() // shard))
    worded = cut.where("size > 0").withColumn("shard", F.pmod(F.xxhash64(key, "piece", "size"), F.lit(shards)).cast("int"))

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["size", key, "piece", "start"], ascending=[False, True, True, True], kind="stable").reset_index(drop=True)
        of, place, final = best_fit(group["size"].tolist(), lengths)
        return group.assign(bin=of, bin_length=[final[b] for b in of], bin_start=place)

    kind = docs.schema[key].dataType.simpleString()
    packed = worded.groupBy("shard").applyInPandas(run, f"{key} {kind}, piece int, start long, size int, shard int, bin int, bin_length int, bin_start int")
    alone = cut.where("size <= 0").select(key, "piece", "start", "size", *[F.lit(None).cast("int").alias(c) for c in ("shard", "bin", "bin_length", "bin_start")])
    return packed.union(alone)


def measured(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_words) of each document; 0 for a null text."""
    return docs.select(key, F.size(words(F.col(text).cast("string"))).cast("long").alias("n_words"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(measured(table(spark, sf_dir, "documents")))
