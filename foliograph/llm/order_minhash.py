"""Near-duplicate texts by Order MinHash, candidates verified by banded alignment.

A text is the sequence of its five-word shingles, each labelled with its number of occurrence. A sketch takes the
``PICKED`` shingles that one hash function puts lowest and lists them in text order; texts that agree in any of
``SKETCHES`` sketches share a bucket, so both what they hold and its order count. Two texts are near-duplicates if
the aligned shingles reach ``SIMILARITY`` of all: L / (n + m - L) for the longest common subsequence L. The alignment
runs in the band that this threshold leaves, bit-parallel.

Texts with the same words become one before anything else, by a grouped minimum. A bucket of up to ``FEW`` texts
compares all of them, a larger one its members with its leader only, the one that is in the most and largest buckets.
What the links found so far join is a part. A larger bucket whose members are all in one part is done. All members of
the others, those that matched the leader as well as those that didn't, are dealt anew by ``AGAIN`` sketches of twice
as many shingles, which only more similar texts share, and so on until no larger bucket holds several parts; sketches
of whole texts are the last, which different texts don't share. A text makes a fixed number of rows a deal, and no
deal lists the pairs of a large bucket. Large buckets of the first deal that still hold several parts are then settled
exactly: all pairs of their texts from different parts meet that share one of their rarest shingles where texts so
similar have to (``_met``). So texts that share a bucket are compared or in one class, whatever the bucket's size.

Texts of one to four words have one shingle, all their words. A null or wordless text is in a class of its own, as is
any row with a null id. Rows that occur again fall in one class; different texts with one id are told apart. Other
columns are left aside.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliograph.llm._common import components, durable, table, words

SHINGLE, SIMILARITY = 5, 0.8
SKETCHES, PICKED = 20, 4
#: Sketches of a text that is dealt anew.
AGAIN = 16
#: Members of a bucket up to which all of them are compared; larger ones have a leader.
FEW = 32
#: Counters of shingles, by which rare ones come first; when these are many more, the order is less sharp but as exact.
CELLS = 1 << 20

_ODD = np.uint64(0x9E3779B97F4A7C15)
_ODD2 = np.uint64(0xC2B2AE3D27D4EB4F)


def mix(z: np.ndarray) -> np.ndarray:
    z = (z ^ (z >> np.uint64(31))) * _ODD
    z = (z ^ (z >> np.uint64(29))) * _ODD2
    return z ^ (z >> np.uint64(32))


@lru_cache(1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    base = 0xD1342543DE82EF95
    inverse = pow(base, -1, 1 << 64)
    with np.errstate(over="ignore"):
        return tuple(np.cumprod(np.r_[np.uint64(1), np.full(n - 1, b, np.uint64)], dtype=np.uint64) for b in (base, inverse))


def word_hashes(words: list[bytes]) -> np.ndarray:
    """32-bit hash of each word (kept as uint64), a slice of about a megabyte at a time."""
    out, at = [], 0
    while at < len(words):
        some = words[at : at + 100_000]
        at += len(some)
        flat = np.frombuffer(b" ".join(some), np.uint8).astype(np.uint64) + np.uint64(1)
        size = np.fromiter(map(len, some), np.int64, len(some))
        end = np.cumsum(size + 1) - 1
        start = end - size
        powers, inverses = _powers(1 << max(16, int(len(flat)).bit_length()))
        total = np.r_[np.uint64(0), np.cumsum(flat * powers[: len(flat)], dtype=np.uint64)]
        out.append(mix((total[end] - total[start]) * inverses[start] + size.astype(np.uint64)) & np.uint64(0xFFFFFFFF))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def shingles(hashes: np.ndarray) -> np.ndarray:
    """64-bit hash of each run of five words; of all words if there are fewer."""
    n = len(hashes)
    if n == 0:
        return hashes
    width = min(SHINGLE, n)
    z = np.zeros(n - width + 1, np.uint64)
    for k in range(width):
        z = mix(z + hashes[k : n - width + 1 + k] + np.uint64(k + 1))
    return z


def labelled_by_occurrence(kmers: np.ndarray) -> np.ndarray:
    """Hashes of the shingles with the number of times that each came before."""
    n = len(kmers)
    order = np.argsort(kmers, kind="stable")
    ranked = kmers[order]
    first = np.r_[True, ranked[1:] != ranked[:-1]]
    begins = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    occurrence = np.empty(n, np.uint64)
    occurrence[order] = (np.arange(n) - begins).astype(np.uint64)
    return mix(kmers + occurrence * _ODD2)


def sketches(labelled: np.ndarray, number: int = SKETCHES, picked: int = PICKED) -> np.ndarray:
    """``number`` hashes, each of the ``picked`` lowest labelled shingles of one hash function in text order."""
    n = len(labelled)
    first = (picked - PICKED) * 1000 + 1
    seeds = mix(np.arange(first, first + number, dtype=np.uint64) * _ODD)
    out = np.empty(number, np.uint64)
    step = max(1, 400_000 // n)
    for s in range(0, number, step):
        z = mix(labelled[None, :] ^ seeds[s : s + step, None])
        if n > picked:
            at = np.sort(np.argpartition(z, picked - 1, axis=1)[:, :picked], axis=1)
        else:
            at = np.broadcast_to(np.arange(n), (len(z), n))
        got = seeds[s : s + step].copy()
        for k in range(at.shape[1]):
            got = mix(got + labelled[at[:, k]])
        out[s : s + step] = got
    return out


def aligned(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> float:
    """L / (n + m - L), where L is the longest alignment inside the band that similarity ``least`` allows.

    Exact if it reaches ``least``; otherwise at most the true value, which is then below ``least``, too.
    """
    n, m = len(a), len(b)
    if not n or not m:
        return 0.0
    if min(n, m) < least * max(n, m):
        return min(n, m) / max(n, m)
    k = min(n, m)
    same = a[:k] == b[:k]
    head = k if same.all() else int(np.argmin(same))
    k -= head
    same = a[n - k :][::-1] == b[m - k :][::-1]
    tail = k if same.all() else int(np.argmin(same))
    x, y = a[head : n - tail].tolist(), b[head : m - tail].tolist()
    band = int((n + m) * (1 - least) / (1 + least)) + 1  # insertions and deletions that ``least`` allows
    where: dict[int, list[int]] = {}
    for j, s in enumerate(y):
        where.setdefault(s, []).append(j)
    common, lo, hi, row = head + tail, 0, min(len(y), band + 1), 0
    row = (1 << hi) - 1  # bit j - lo: 1 unless the alignment grows at column j
    for i, s in enumerate(x):
        if i + band + 1 <= len(y) and hi < i + band + 1:
            row |= 1 << (hi - lo)
            hi += 1
        if i > band and lo < hi:
            common += 1 - (row & 1)
            row >>= 1
            lo += 1
        hit = 0
        for j in where.get(s, ()):
            if lo <= j < hi:
                hit |= 1 << (j - lo)
        if hit:
            both = row & hit
            row = ((row + both) | (row - both)) & ((1 << (hi - lo)) - 1)
    common += (hi - lo) - row.bit_count()
    return common / (n + m - common)


def _sketched(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(id, same, n, sketches): digest of the words, number of shingles, sketches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            same, n, sk = [], [], []
            for t in batch.column(1).to_pylist():
                w = t.encode("utf-8", "surrogatepass").split()  # bytes.split() cuts where words end here
                k = shingles(word_hashes(w))
                same.append(hashlib.md5(b" ".join(w)).digest())
                n.append(len(k))
                sk.append(sketches(labelled_by_occurrence(k)).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(same, pa.binary()), pa.array(n, pa.int32()), pa.array(sk, pa.list_(pa.int64()))], ["id", "same", "n", "sketches"])

    worded = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("t")).where("id IS NOT NULL AND t RLIKE '[^\\\\x20\\\\x09-\\\\x0D]'")
    return worded.mapInArrow(run, "id long, same binary, n int, sketches array<long>")


def _prints(docs: DataFrame, key: str, text: str, wanted: DataFrame) -> DataFrame:
    """(u, print): 32-bit word hashes of the texts that ``wanted`` (id, same, u) names, each once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w = [t.encode("utf-8", "surrogatepass").split() for t in batch.column(1).to_pylist()]
            same = [hashlib.md5(b" ".join(x)).digest() for x in w]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(same, pa.binary()), pa.array([word_hashes(x).astype(np.uint32).tobytes() for x in w], pa.binary())], ["id", "same", "print"])

    texts = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("t")).where("id IS NOT NULL AND t IS NOT NULL")
    printed = texts.join(wanted.select("id").distinct(), "id", "left_semi").mapInArrow(run, "id long, same binary, print binary")
    return printed.join(wanted, ["id", "same"]).select("u", "print").dropDuplicates(["u"])


def _kmers(print_: pa.Scalar) -> np.ndarray:
    return shingles(np.frombuffer(print_.as_buffer(), np.uint32).astype(np.uint64))


def _with_prints(spokes: DataFrame, prints: DataFrame) -> DataFrame:
    """(c, u, ..., pc, pu): the pairs of a leader and a member with the prints of both."""
    return spokes.join(prints.select("u", F.col("print").alias("pu")), "u").join(prints.select(F.col("u").alias("c"), F.col("print").alias("pc")), "c")


def _similar(spokes: DataFrame, prints: DataFrame) -> DataFrame:
    """The pairs (c, u) that are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, leader = None, None
        for batch in batches:
            c, u, pc, pu = (batch.column(k) for k in range(4))
            keep = []
            for i in range(batch.num_rows):
                if last != c[i].as_py():
                    last, leader = c[i].as_py(), _kmers(pc[i])
                keep.append(aligned(leader, _kmers(pu[i])) >= SIMILARITY)
            yield pa.RecordBatch.from_arrays([c, u], ["c", "u"]).filter(pa.array(keep, pa.bool_()))

    return _with_prints(spokes.select("c", "u"), prints).select("c", "u", "pc", "pu").mapInArrow(run, "c long, u long")


def _sketched_again(texts: DataFrame, prints: DataFrame, picked: int) -> DataFrame:
    """Rows (h, u): ``AGAIN`` sketches of ``picked`` shingles for each of ``texts`` (u)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [sketches(labelled_by_occurrence(_kmers(p)), AGAIN, picked).view(np.int64) for p in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got, pa.list_(pa.int64()))], ["u", "hs"])

    again = texts.join(prints, "u").select("u", "print").mapInArrow(run, "u long, hs array<long>")
    return again.select(F.explode("hs").alias("h"), "u").distinct()


def _met(texts: DataFrame, prints: DataFrame) -> DataFrame:
    """(c, u): all pairs of ``texts`` (u, part) from different parts that can reach ``SIMILARITY``; exact.

    Such texts of n and m shingles have L >= 4 (n + m) / 9 labelled shingles in common. In any one order of shingles the
    first common one has L of each text's from there on, so it is within the first fifth of both. Rare ones come first,
    so texts that differ more than that hardly meet.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(CELLS, np.int64)
        for batch in batches:
            for p in batch.column(0):
                np.add.at(n, labelled_by_occurrence(_kmers(p)) % np.uint64(CELLS), 1)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at])], ["cell", "n"])

    held = durable(texts.join(prints, "u").select("u", "part", "print"))
    found = held.select("print").mapInArrow(counted, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    often = np.zeros(CELLS, np.int64)
    often[found["cell"].to_numpy()] = found["n"].to_numpy()

    def rarest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for u, part, p in zip(*batch.columns):
                k = labelled_by_occurrence(_kmers(p))
                n = len(k)
                some = n - (8 * n + 9) // 10 + 1
                first = k[np.lexsort((k, often[k % np.uint64(CELLS)]))[:some]]
                same = [pa.array(np.full(some, x.as_py())) for x in (u, part)]
                yield pa.RecordBatch.from_arrays([pa.array(first.view(np.int64)), *same, pa.array(np.full(some, n)), pa.array(n - np.arange(some))], ["t", "u", "part", "n", "left"])

    rows = held.mapInArrow(rarest, "t long, u long, part long, n long, left long")
    x, y = rows.alias("x"), rows.alias("y")
    # the whole condition stands in the join: pairs that can't be similar enough never are rows
    fit = F.expr("x.t = y.t AND x.part < y.part AND 10 * least(x.n, y.n) >= 8 * greatest(x.n, y.n) AND 9 * least(x.left, y.left) >= 4 * (x.n + y.n)")
    return x.join(y, fit).select(F.col("x.u").alias("c"), F.col("y.u").alias("u")).distinct()


def _mixed(parted: DataFrame) -> DataFrame:
    """Rows (h, u, part) of buckets with several parts."""
    several = parted.groupBy("h").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).where("lo <> hi").select("h")
    return parted.join(several, "h", "left_semi")


def _with_part(rows: DataFrame, node: str, joined: DataFrame, part: str) -> DataFrame:
    """``rows`` with the part that ``node`` is in: its component, or itself if it has no link."""
    return rows.join(joined.withColumnsRenamed({"node": node, "component": part}), node, "left").withColumn(part, F.coalesce(part, node))


def _buckets(rows: DataFrame, heavy: DataFrame) -> DataFrame:
    """(h, c, size): leader and size of each bucket (h, u) of two or more; of buckets with the same members one stays."""
    mark = [F.count("*").alias("size"), F.sum(F.xxhash64("u").cast("decimal(38,0)")).alias("m1"), F.bit_xor(F.xxhash64(F.lit(1), "u")).alias("m2")]
    found = rows.join(heavy.select("u", "weight"), "u").groupBy("h").agg(*mark, F.max(F.struct("weight", "u"))["u"].alias("c")).where("size > 1")
    return found.groupBy("size", "m1", "m2", "c").agg(F.min("h").alias("h")).select("h", "c", "size")


def _all_of_few(members: DataFrame) -> DataFrame:
    """(c, u): all pairs of buckets with up to ``FEW`` members, so fewer than ``FEW`` for each."""
    m = F.col("m")
    pairs = F.flatten(F.transform(m, lambda x, i: F.transform(F.slice(m, i + 2, F.size(m)), lambda y: F.struct(x.alias("c"), y.alias("u")))))
    return members.groupBy("h").agg(F.sort_array(F.collect_list("u")).alias("m")).select(F.inline(pairs)).distinct()


def _linked(texts: DataFrame, docs: DataFrame, key: str, text: str) -> DataFrame:
    """Parts (node, component) of the different texts (id, same, u, n, sketches)."""
    rows = texts.select(F.explode("sketches").alias("h"), "u", "n")
    sizes = rows.groupBy("h").agg(F.count("*").alias("size")).where("size > 1")
    rows = durable(rows.join(sizes, "h"), True)
    heavy = durable(rows.groupBy("u").agg(F.sum("size").alias("weight"), F.first("n").alias("n")), True)
    prints = durable(_prints(docs, key, text, texts.join(heavy.select("u"), "u", "left_semi").select("id", "same", "u")))
    rows, joined, held, picked = rows.select("h", "u"), None, None, PICKED
    while True:
        members = durable(rows.join(_buckets(rows, heavy), "h"), True)
        led = members.where((F.col("size") > FEW) & (F.col("u") != F.col("c"))).select("c", "u")
        spokes = led.union(_all_of_few(members.where(F.col("size") <= FEW))).distinct()
        asked = spokes.join(heavy.select("u", "n"), "u").join(heavy.select(F.col("u").alias("c"), F.col("n").alias("k")), "c").where("10 * least(n, k) >= 8 * greatest(n, k)")
        if joined is not None:  # links inside one part add nothing to the classes
            asked = _with_part(_with_part(asked.select("c", "u"), "c", joined, "p"), "u", joined, "q").where("p <> q")
        got = durable(_similar(asked, prints), True)
        if joined is None:
            joined = durable(components(got), True)
        elif not got.isEmpty():
            joined = durable(components(joined.union(got)), True)
        parted = _with_part(members.where(F.col("size") > FEW), "u", joined, "part")
        mixed = durable(_mixed(parted).select("h", "u"), True)
        if held is None:
            held = mixed
        opened = durable(mixed.select("u").distinct(), True)
        if opened.isEmpty():
            break
        picked *= 2
        rows = durable(_sketched_again(opened, prints, picked), True)
    left = durable(_mixed(_with_part(held, "u", joined, "part")).select("u", "part").distinct(), True)
    if left.isEmpty():
        return joined
    got = durable(_similar(_met(left, prints), prints), True)
    return joined if got.isEmpty() else durable(components(joined.union(got)), True)


def _classes(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(id, same, class_id, first) for each row with an id and a word; first: it holds the text that leads its class."""
    base = durable(_sketched(docs, key, text))
    texts = base.groupBy("same").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("sketches").alias("sketches"))
    texts = durable(texts.withColumn("u", F.monotonically_increasing_id()))  # as written, a text keeps its number
    parted = _with_part(texts.select("id", "same", "u"), "u", _linked(texts, docs, key, text), "part")
    leads = parted.groupBy("part").agg(F.min(F.struct("id", "same")).alias("lead"))
    known = parted.join(leads, "part").select("same", F.col("lead.id").alias("class_id"), F.col("lead.same").alias("lead"))
    return base.select("id", "same").join(known, "same").select("id", "same", "class_id", (F.col("same") == F.col("lead")).alias("first"))


WORDED = "t RLIKE '[^\\\\x20\\\\x09-\\\\x0D]'"


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, class_id, kept) for each row: the smallest id of its class, and whether that is its own."""
    linked = _classes(docs, key, text).select("id", "class_id")
    alone = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("t")).where(f"id IS NULL OR t IS NULL OR NOT {WORDED}").select("id", F.col("id").alias("class_id"))
    return linked.union(alone).select(F.col("id").alias(key), "class_id", F.col("id").eqNullSafe(F.col("class_id")).alias("kept"))


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: one of each class, that with the smallest id; of rows with that id the one that
    leads the class. Rows with a null id or no word all stay."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    worded = F.col(key).cast("long").isNotNull() & F.coalesce(F.col(text).cast("string").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    found = durable(_classes(docs, key, text))
    by_id = found.where("first AND id = class_id").select("id", "same").distinct().join(found.groupBy("id").agg(F.count("*").alias("rows")), "id")
    rows = docs.where(worded).select(*columns, F.col(key).cast("long").alias("_om_id"))
    once = rows.join(by_id.where("rows = 1").select(F.col("id").alias("_om_id")), "_om_id", "left_semi")
    again = rows.withColumn("_om_same", F.unhex(F.md5(F.array_join(words(F.col(text).cast("string")), " "))))
    again = again.join(by_id.where("rows > 1").select(F.col("id").alias("_om_id"), F.col("same").alias("_om_same")), ["_om_id", "_om_same"], "left_semi").dropDuplicates(["_om_id", "_om_same"])
    return once.select(*columns).union(again.select(*columns)).union(docs.where(~worded).select(*columns))


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
