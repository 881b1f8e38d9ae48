"""BPE encoding and decoding by dynamic programming over prefixes.

Byte-pair merging has one fixed point for a word, so each prefix of the word has exactly one last token. For every
prefix the tokens that are suffixes of it come from an automaton over the vocabulary; a token ``t`` is the last one
if the last token of the rest stands beside it unmerged (the pair is compatible). Back-pointers then give the ids.
No merge is ever replayed over the word.

Texts are cut at spaces and newlines first: no special string, normalisation or pre-token reaches across one. A
worker remembers the ids of the pieces it has met (bounded, see ``REMEMBERED``); this only saves time.

Nulls and empty texts have no ids: n_tokens 0 and the digests of nothing. Other columns of the input, whatever
their names, are left aside; repeated rows give repeated results.
"""

from __future__ import annotations

import hashlib
import json
import struct
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliograph.llm._common import table

VOCABULARY = "word_bpe_49k.json"
#: Pieces that a worker keeps before it starts anew, and the longest one that it keeps.
REMEMBERED, LONGEST = 400_000, 64
#: Code points that the tokenizer's white-space class holds.
SPACES = r"\t-\r \x85\xa0  -     　"
#: Distance between a symbol and the same symbol at a word's end.
END = 0x10000


def byte_symbols() -> dict[int, str]:
    """Byte-level alphabet: printable Latin-1 stands for itself, every other byte for the next free code from 256."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class PrefixCodec:
    """Encoder and decoder of one vocabulary file with word ends (lower-casing, white space dropped)."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.names = {i: s for s, i in spec["model"]["vocab"].items()}
        self.names |= {x["id"]: x["content"] for x in spec["added_tokens"]}
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        ids = {self._inner(s): i for s, i in spec["model"]["vocab"].items()}
        self.length = {i: len(s) for s, i in ids.items()}
        #: token -> (left part, right part, rank of its merge); a symbol has none
        self.parts: dict[int, tuple[int, int, int]] = {}
        self.merged: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (x, y) in enumerate(spec["model"]["merges"]):
            left, right = ids[self._inner(x)], ids[self._inner(y)]
            whole = ids[self._inner(x)[:] + self._inner(y)]
            self.parts[whole] = (left, right, rank)
            self.merged[left, right] = (whole, rank)
        self.ids = ids
        self.starts = {s[:k] for s in ids for k in range(1, len(s) + 1)}
        #: Suffix automaton over the vocabulary, made as far as texts lead: the state of a prefix is the longest suffix
        #: of it that begins a token; (transitions by symbol, tokens that are suffixes of the state, longest first, the
        #: state's symbols, its failure link: the state of its longest shorter suffix)
        self.root = ({}, (), "", None)
        self.states: dict[str, tuple] = {"": self.root}
        self.symbols = {chr(b): s for b, s in byte_symbols().items()}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.pre = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{SPACES}\p{{L}}\p{{N}}]+")
        self.compatible: dict[tuple[int, int], bool] = {}
        #: pre-token -> ids
        self.met: dict[str, list[int]] = {}
        self.plain = {b: s for b, s in byte_symbols().items() if b < 128 and s != chr(b)}
        self.seen: dict[str, tuple[bytes, str, int]] = {}

    @staticmethod
    def _inner(token: str) -> str:
        """A token as a string of symbols, where a symbol at a word's end is one of its own."""
        return token[:-5] + chr(ord(token[-5]) + END) if token.endswith("</w>") and len(token) > 4 and token[:-4] else token

    def _compatible(self, a: int, b: int) -> bool:
        """Whether merging leaves tokens a and b beside each other as they are.

        Only the border can differ, between a's right-hand parts and b's left-hand ones. Going back in time, undo
        the younger of the two that meet at the border; a merge across it that ranks before what was undone last
        would have come first.
        """
        before = 1 << 60  # rank of the merge that was undone last
        left_last = False  # it was on the left side: of two equal ranks the left-hand one comes first
        while True:
            across = self.merged.get((a, b))
            if across and (across[1] < before or across[1] == before and not left_last):
                return False
            pa_, pb_ = self.parts.get(a), self.parts.get(b)
            if pa_ is None and pb_ is None:
                return True
            if pb_ is None or pa_ is not None and pa_[2] > pb_[2]:
                a, before, left_last = pa_[1], pa_[2], True
            else:
                b, before, left_last = pb_[0], pb_[2], False

    def _step(self, state: tuple | None, symbol: str) -> tuple:
        """The state after ``symbol``; goes down the failure links to the first state that some token continues with it."""
        at = state
        while at is not None and symbol not in at[0] and at[2] + symbol not in self.starts:
            at = at[3]
        if at is None:
            to = self.root
        elif symbol in at[0]:
            to = at[0][symbol]
        else:
            symbols = at[2] + symbol
            if symbols not in self.states:
                link = self.root if at is self.root else self._step(at[3], symbol)
                own = self.ids.get(symbols)
                self.states[symbols] = ({}, (((own, self.length[own]),) if own is not None else ()) + link[1], symbols, link)
            to = self.states[symbols]
        state[0][symbol] = to
        return to

    def word(self, symbols: str) -> list[int]:
        """Ids of one pre-token, given as byte symbols."""
        s = symbols[:-1] + chr(ord(symbols[-1]) + END)
        last: list[int | None] = [None] * (len(s) + 1)
        verdicts, length = self.compatible, self.length
        state, end = self.root, 0
        for symbol in s:
            end += 1
            state = state[0].get(symbol) or self._step(state, symbol)
            for token, size in state[1]:
                if size == end:
                    last[end] = token
                    break
                left = last[end - size]
                if left is None:
                    continue
                fits = verdicts.get((left, token))
                if fits is None:
                    if len(verdicts) >= REMEMBERED:
                        verdicts.clear()
                    fits = verdicts[left, token] = self._compatible(left, token)
                if fits:
                    last[end] = token
                    break
        out, end = [], len(s)
        while end:
            out.append(last[end])
            end -= self.length[last[end]]
        return out[::-1]

    def piece(self, text: str) -> list[int]:
        """Ids of any text."""
        out: list[int] = []
        for part in self.cut.split(text) if self.cut and "<" in text else [text]:
            if part in self.special:
                out.append(self.special[part])
                continue
            if not part.isascii():
                part = unicodedata.normalize("NFC", part)
            part = "".join(map(str.lower, part)) if "Σ" in part else part.lower()
            for w in self.pre.findall(part):
                ids = self.met.get(w)
                if ids is None:
                    if len(self.met) >= REMEMBERED:
                        self.met.clear()
                    s = w.translate(self.plain) if w.isascii() else "".join(map(self.symbols.__getitem__, w.encode("utf-8", "surrogatepass").decode("latin-1")))
                    ids = self.word(s)
                    if len(w) <= LONGEST:
                        self.met[w] = ids
                out += ids
        return out

    def known(self, piece: str) -> tuple[bytes, str, int]:
        """(ids as little-endian 32-bit integers, their text, their number) of a piece between spaces."""
        if len(self.seen) >= REMEMBERED:
            self.seen.clear()
        ids = self.piece(piece)
        got = (struct.pack(f"<{len(ids)}I", *ids), self.decode(ids), len(ids))
        if len(piece) <= LONGEST:
            self.seen[piece] = got
        return got

    def decode(self, ids: list[int]) -> str:
        """The vocabulary has no decoder of its own: its tokens' names, a space between each two."""
        return " ".join(map(self.names.__getitem__, ids))

    def encode(self, text: str | None) -> tuple[bytes, str, int]:
        """(ids as bytes, decoded text, number of ids) of a whole text."""
        seen, known = self.seen.get, self.known
        got = [seen(p) or known(p) for p in (text or "").replace("\n", " ").split(" ") if p]
        return b"".join([g[0] for g in got]), " ".join([g[1] for g in got if g[2]]), sum([g[2] for g in got])


@lru_cache(2)
def codec(name: str) -> PrefixCodec:
    """The worker's codec; ``name`` is a file of the public tokenizers or a path."""
    if "/" in name:
        return PrefixCodec(name)
    import public_tokenizers

    return PrefixCodec(public_tokenizers.path(name))


def encode(df: DataFrame, text: str = "text", vocabulary: str = VOCABULARY, ids: str = "ids") -> DataFrame:
    """``df`` with the column ``ids`` (array<int>) of token ids added; null and empty texts get an empty array."""

    @F.pandas_udf("array<int>")
    def run(texts):
        import numpy as np

        c = codec(vocabulary)
        return texts.map(lambda t: np.frombuffer(c.encode(t)[0], "<u4").astype("int32"), na_action=None)

    return df.withColumn(ids, run(F.coalesce(F.col(text), F.lit(""))))


def decode(df: DataFrame, ids: str = "ids", vocabulary: str = VOCABULARY, text: str = "decoded") -> DataFrame:
    """``df`` with the text of its ids added; null where ids are null."""

    @F.pandas_udf("string")
    def run(values):
        c = codec(vocabulary)
        return values.map(lambda v: None if v is None else c.decode([int(i) for i in v]), na_action=None)

    return df.withColumn(text, run(F.col(ids)))


def digests(df: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256): encoding and decoding of every whole text in one pass."""
    slim = df.select(F.col(key).alias(key), F.col(text).cast("string").alias("text_"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(vocabulary)
        for batch in batches:
            n, a, b = [], [], []
            for t in batch.column(1).to_pylist():
                ids, decoded, count = c.encode(t)
                n.append(count)
                a.append(hashlib.sha256(ids).hexdigest())
                b.append(hashlib.sha256(decoded.encode("utf-8", "surrogatepass")).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())], [key, "n_tokens", "ids_sha256", "decoded_sha256"])

    return slim.mapInArrow(run, f"{key} {slim.schema[key].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op10_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))
