"""Tokens of two tokenizers aligned by their bytes, and how often which pair of ids ends together in the corpus.

The tokens of one side (B) are intervals that lie end to end: their sorted ends are a static index. Each token of the
other side (A) stabs it twice by bisection and so gets the list of B tokens that it overlaps. A gap between two A tokens
that no B token spans is a border of groups; there the last token of each side end together and are linked.

Texts are cut before each space or newline after a character that isn't white space: neither vocabulary has a token across
such a place (``Sides`` refuses one that has). Different pieces are encoded and aligned in batches, laid end to end on one axis;
a worker remembers pieces (bounded, ``REMEMBERED``), which only saves time. A text in which some piece's tokens don't give
back its bytes is encoded whole, and has no tokens if they differ then too.

The counts of pairs are corpus-wide: the links of every document are written to the shared folder once, summed by pair,
and joined back. Pairs that many documents hold are at most ``HEAVY`` and broadcast, all others are joined by a shuffle.

Cases: null and empty texts have no tokens: zeros and an empty ``groups``. Repeated rows count each time and give repeated
results. Columns other than key and text, whatever their names, are left aside; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import os
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliograph.llm._common import joined_unevenly, stored, table

SIDE_A, SIDE_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Pieces after which a worker lets go of those that it hasn't met since it last did, and the longest one that it keeps.
REMEMBERED, LONGEST = 250_000, 48
#: Characters of new pieces that are encoded at once, and of texts that are aligned at once, about.
BATCH_BYTES, SLICE = 1 << 16, 1 << 21
#: A place where both tokenizers end a token.
BREAK = re.compile(r"(?<=\S)(?=[ \n])")
#: U+2581 is the second tokenizer's space; a text that holds it never gives its bytes back.
BLOCK = "▁"


def overlaps(starts, ends, index_starts, index_ends):
    """(first, last) interval of the index that each interval overlaps; both lists are sorted and without empty intervals."""
    import numpy as np

    return np.searchsorted(index_ends, starts, "right"), np.searchsorted(index_starts, ends, "left") - 1


class Sides:
    """Both tokenizers with the bytes of their tokens."""

    def __init__(self, a: str, b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks already use the cores
        import numpy as np
        import public_tokenizers
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        from foliograph.llm.bpe_dp import byte_symbols

        a, b = (x if "/" in x else public_tokenizers.path(x) for x in (a, b))
        self.a = Tokenizer.from_file(a)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b)
        with open(a, encoding="utf-8") as f:
            spec = json.load(f)
        byte_of = {s: n for n, s in byte_symbols().items()}
        self.bytes_a = [b""] * self.a.get_vocab_size()
        for s, i in self.a.get_vocab().items():
            self.bytes_a[i] = bytes(byte_of[x] for x in s) if all(x in byte_of for x in s) else s.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(re.search(f"[^{BLOCK}]{BLOCK}|\n", p) for p in pieces):
            raise ValueError(f"{b}: a token reaches across a space, so texts can't be cut there")
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(BLOCK, " ").encode() for i, p in enumerate(pieces)]
        self.size_a, self.size_b = (np.array([len(x) for x in side]) for side in (self.bytes_a, self.bytes_b))
        self.space = self.b.piece_to_id(BLOCK)
        # where merges rank as their tokens' ids do, another library reads the same vocabulary several times faster
        vocabulary, special = spec["model"]["vocab"], {x["content"] for x in spec["added_tokens"]}
        ranks = [vocabulary["".join(m) if isinstance(m, list) else m.replace(" ", "")] for m in spec["model"]["merges"]]
        self.fast = None
        if spec["normalizer"] is None and spec["pre_tokenizer"] == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True} and ranks == sorted(ranks):
            self.fast = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={self.bytes_a[i]: i for s, i in vocabulary.items() if s not in special}, special_tokens={})
        self.decimal = [str(i) for i in range(max(len(self.bytes_a), len(self.bytes_b)))]
        #: piece -> (tokens of A, tokens of B, groups as text, linked pairs); None if the bytes differ
        self.met: dict[str, tuple[int, int, str, tuple[int, ...]] | None] = {}
        self.old = self.met.copy()

    def encoded(self, pieces: list[str]) -> tuple[list[list[int]], list[list[int]], list[bool]]:
        """Ids of both sides of each piece, and whether they give its bytes back; none where they don't."""
        import numpy as np

        left = [x.ids for x in self.a.encode_batch_fast(pieces, add_special_tokens=False)]
        # the second tokenizer puts a space before what it gets: the piece's own, or one that is dropped again
        right = self.b.encode([p[1:] if p[0] == " " else p for p in pieces], num_threads=1)
        right = [[self.space] if p == " " else y if p[0] == " " else y[1:] if y[0] == self.space else [] for p, y in zip(pieces, right)]
        whole = [p.encode() for p in pieces]
        good = [True] * len(pieces)
        for side, parts in ((left, self.bytes_a), (right, self.bytes_b)):
            flat = list(chain.from_iterable(side))
            ends = np.cumsum([0, *map(len, side)])
            sizes = np.append(0, np.cumsum([len(parts[i]) for i in flat]))[ends]
            if b"".join(map(parts.__getitem__, flat)) != b"".join(whole) or not np.array_equal(np.diff(sizes), list(map(len, whole))):
                good = [g and w == b"".join(map(parts.__getitem__, x)) for g, w, x in zip(good, whole, side)]
        if not all(good):
            left, right = ([x if ok else [] for x, ok in zip(side, good)] for side in (left, right))
        return left, right, good

    def aligned_ids(self, a, b, stops_a: list[int], stops_b: list[int]) -> list[tuple[int, int, str, tuple[int, ...]]]:
        """Groups and links of pieces that lie end to end on one axis of bytes, from the ids of all their tokens.

        ``stops_a`` and ``stops_b`` number the tokens up to each piece's end.
        """
        import numpy as np

        ends_a, ends_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        first, last = overlaps(ends_a - self.size_a[a], ends_a, ends_b - self.size_b[b], ends_b)
        # a gap that no token of B spans: the next token's list begins after this one's ends
        cut = np.flatnonzero(np.append(last[:-1] < first[1:], True)) if len(a) else np.array([], "int64")
        pair = ((a[cut] << 32) | b[last[cut]]).tolist()
        upto = np.searchsorted(cut, np.array([0, *stops_a]) - 1, "right").tolist()  # groups before each piece
        stop_a, stop_b = [0, *(cut + 1).tolist()], [0, *(last[cut] + 1).tolist()]
        ids_a, ids_b = (list(map(self.decimal.__getitem__, x.tolist())) for x in (a, b))
        groups = [f"{i}|{j}" for i, j in zip(map(ids_a.__getitem__, stop_a[:-1]), map(ids_b.__getitem__, stop_b[:-1]))]
        several = np.flatnonzero((np.diff(stop_a) > 1) | (np.diff(stop_b) > 1)) if len(cut) else []
        for k in map(int, several):
            groups[k] = f"{','.join(ids_a[stop_a[k] : stop_a[k + 1]])}|{','.join(ids_b[stop_b[k] : stop_b[k + 1]])}"
        lengths = (np.diff([0, *stops]).tolist() for stops in (stops_a, stops_b))
        return [(n, m, ";".join(groups[i:j]), tuple(pair[i:j])) for n, m, i, j in zip(*lengths, upto, upto[1:])]

    def align_each(self, pieces: list[str]) -> list[tuple[int, int, str, tuple[int, ...]] | None]:
        """Alignments of pieces that are encoded one by one; None where the tokens don't give their bytes back."""
        import numpy as np

        left, right, good = self.encoded(pieces)
        a, b = (np.array(list(chain.from_iterable(side)), "int64") for side in (left, right))
        stops = (np.cumsum([len(x) for x in side]).tolist() for side in (left, right))
        return [x if ok else None for x, ok in zip(self.aligned_ids(a, b, *stops), good)]

    def align(self, pieces: list[str]) -> list[tuple[int, int, str, tuple[int, ...]] | None]:
        """Alignments of pieces. Those that end in no white space are encoded as one text, which breaks between them."""
        import numpy as np

        solid, rest = [" ."], []
        for p in pieces:
            (rest if p[-1].isspace() else solid).append(p)
        found: dict[str, tuple | None] = dict(zip(rest, self.align_each(rest))) if rest else {}
        text = "".join(solid)
        whole = text.encode()
        a = self.fast.encode_ordinary(text) if self.fast else self.a.encode(text, add_special_tokens=False).ids
        b = self.b.encode(text[1:], num_threads=1)
        same = b"".join(map(self.bytes_a.__getitem__, a)) == whole == b"".join(map(self.bytes_b.__getitem__, b))
        a, b = np.array(a, "int64"), np.array(b, "int64")
        ends = np.cumsum(list(map(len, solid)) if text.isascii() else [len(p.encode()) for p in solid])
        stops = [np.searchsorted(np.cumsum(size[x]), ends) for size, x in ((self.size_a, a), (self.size_b, b))] if same else []
        if same and all(np.array_equal(np.cumsum(size[x])[k], ends) for size, x, k in ((self.size_a, a, stops[0]), (self.size_b, b, stops[1]))):
            found.update(zip(solid, self.aligned_ids(a, b, *((k + 1).tolist() for k in stops))))
        else:
            found.update(zip(solid, self.align_each(solid)))
        return [found[p] for p in pieces]

    def learn(self, texts: list[list[str]]) -> None:
        """Put the alignments of all pieces of some texts into ``met``."""
        wanted = set().union(*texts) - self.met.keys()
        self.met.update((p, self.old[p]) for p in wanted & self.old.keys())
        new = list(wanted - self.old.keys())
        at = 0
        while at < len(new):
            end, size = at, 0
            while end < len(new) and size < BATCH_BYTES:
                size += len(new[end]) + 8
                end += 1
            self.met.update(zip(new[at:end], self.align(new[at:end])))
            at = end

    def aligned(self, texts: list[str | None]) -> list[tuple[int, int, str, dict[int, int]]]:
        """(tokens of A, tokens of B, groups, links by pair) of each whole text."""
        cut = [BREAK.split(" " + t) if t and BLOCK not in t else [] for t in texts]
        self.learn(cut)
        out = []
        for text, pieces in zip(texts, cut):
            parts = [self.met[p] for p in pieces]
            if None in parts:
                parts = self.align([" " + text])
            if not parts or parts[0] is None:
                out.append((0, 0, "", {}))
                continue
            out.append((sum([x[0] for x in parts]), sum([x[1] for x in parts]), ";".join([x[2] for x in parts]), Counter(chain.from_iterable([x[3] for x in parts]))))
        if len(self.met) > REMEMBERED:  # what is met again soon is kept
            self.met, self.old = {}, self.met
        elif long := [p for p in set().union(*cut) if len(p) > LONGEST]:
            for p in long:
                del self.met[p]
        return out


@lru_cache(2)
def sides(a: str, b: str) -> Sides:
    return Sides(a, b)


def align(df: DataFrame, key: str = "doc_id", text: str = "text", a: str = SIDE_A, b: str = SIDE_B) -> DataFrame:
    """(row, key, n_a, n_b, groups, links) of every row of ``df``.

    ``row`` numbers the rows of this result; write it before it is used twice. ``groups`` has the ids of each group,
    "a1,a2|b1;a3|b2,b3"; ``links`` has each pair of ids that end together (A's shifted left by 32 bits, plus B's) with its
    number.
    """
    slim = df.select(F.col(key).alias("key_"), F.col(text).cast("string").alias("text_"))
    kind = slim.schema["key_"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import gc

        import numpy as np
        from pyspark import TaskContext

        gc.disable()  # millions of small tuples without a cycle: looking for cycles takes a sixth of the time
        at, own = TaskContext.get().partitionId() << 33, sides(a, b)
        link = pa.struct([("pair", pa.int64()), ("n", pa.int64())])
        for batch in batches:
            texts = batch.column(1).to_pylist()
            k = 0
            while k < len(texts):
                some, size = [], 0
                while k + len(some) < len(texts) and size < SLICE:
                    some.append(texts[k + len(some)])
                    size += len(some[-1] or "")
                got = own.aligned(some)
                offsets = pa.array(np.cumsum([0] + [len(x[3]) for x in got]), pa.int32())
                flat = pa.StructArray.from_arrays([pa.array([p for x in got for p in x[3]], pa.int64()), pa.array([n for x in got for n in x[3].values()], pa.int64())], fields=list(link))
                columns = [pa.array(range(at, at + len(got)), pa.int64()), batch.column(0).slice(k, len(some))]
                columns += [pa.array([x[i] for x in got], t) for i, t in ((0, pa.int64()), (1, pa.int64()), (2, pa.string()))]
                yield pa.RecordBatch.from_arrays([*columns, pa.ListArray.from_arrays(offsets, flat)], ["row", "key_", "n_a", "n_b", "groups", "links"])
                at, k = at + len(got), k + len(some)
        gc.enable()

    return slim.mapInArrow(run, f"row long, key_ {kind}, n_a long, n_b long, groups string, links array<struct<pair: long, n: long>>").withColumnRenamed("key_", key)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, count, held, best): links of each pair in all rows, rows that hold it, whether no pair of its B id has more."""
    counts = stored(aligned.select(F.explode("links").alias("l")).groupBy("l.pair").agg(F.sum("l.n").alias("count"), F.count("*").alias("held")))
    side = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))
    most = counts.groupBy(side.alias("b")).agg(F.max("count").alias("most"))
    return counts.withColumn("b", side).join(most, "b").select("pair", "count", "held", (F.col("count") == F.col("most")).alias("best"))


def scored(aligned: DataFrame) -> DataFrame:
    """``aligned`` (as written) with n_groups, n_links, n_best and count_sum in place of its links."""
    counts = stored(pair_counts(aligned))
    links = aligned.select("row", F.explode("links").alias("l")).select("row", "l.pair", "l.n")
    found = joined_unevenly(links, counts, "pair", counts.select("pair", "held"))
    sums = found.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("count")).alias("count_sum"))
    n_links = F.aggregate("links", F.lit(0).cast("long"), lambda x, l: x + l["n"])
    rows = aligned.withColumn("n_links", n_links).drop("links").join(sums, "row", "left")
    return rows.withColumn("n_groups", F.col("n_links")).withColumns({c: F.coalesce(c, F.lit(0).cast("long")) for c in ("n_best", "count_sum")})


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = align(table(spark, sf_dir, "documents"))
    # of the groups only the digest is asked for here
    aligned = aligned.withColumn("groups_sha256", F.when(F.col("groups") == "", "").otherwise(F.sha2(F.col("groups"), 256))).drop("groups")
    return scored(stored(aligned)).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
