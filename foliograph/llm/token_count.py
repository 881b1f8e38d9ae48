"""Token counts by batch encoding in Arrow functions that return lengths only.

Texts are cut at spaces and newlines, which no token, pre-token, special string or normalisation of the vocabulary
reaches across; a text of any length goes through in slices of about ``SLICE`` characters that end at such a place.
The different pieces of a slice that the worker has no count for are encoded in batches of about ``BATCH_BYTES``
bytes each, so one batch never holds much more than another; only lengths are kept.

The cuts are safe for ``word_bpe_49k.json`` (word ends, white space dropped); a vocabulary that reaches across spaces
is refused. A null or empty text has no tokens and no bytes. Columns of the input other than key and text are left aside,
repeated rows give repeated results.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliograph.llm._common import table

VOCABULARY = "word_bpe_49k.json"
BATCH_BYTES = 1 << 18
SLICE = 1 << 20
#: Counts that a worker keeps before it starts anew, and the longest piece that it keeps one of; saves time only.
REMEMBERED, LONGEST = 1_000_000, 64


@lru_cache(2)
def tokenizer(name: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks already use the cores
    from tokenizers import Tokenizer

    if "/" not in name:
        import public_tokenizers

        name = public_tokenizers.path(name)
    t = Tokenizer.from_file(name)
    t.no_truncation()
    t.no_padding()
    a, b = "one", "two"
    if [x for s in (a, b) for x in t.encode(s, add_special_tokens=False).ids] != t.encode(f"{a} \n{b}", add_special_tokens=False).ids:
        raise ValueError(f"{name}: tokens reach across spaces, so texts can't be cut there")
    return t


@lru_cache(2)
def counts(name: str) -> dict[str, int]:
    return {}


def slices(text: str) -> Iterator[list[str]]:
    """Pieces between spaces and newlines, a slice of the text at a time."""
    if len(text) <= SLICE:
        yield text.replace("\n", " ").split(" ")
        return
    text, at = text.replace("\n", " "), 0
    while at < len(text):
        end = text.find(" ", at + SLICE)
        end = len(text) if end < 0 else end
        yield text[at:end].split(" ")
        at = end


def batches_by_bytes(pieces: list[str]) -> Iterator[list[str]]:
    batch, size = [], 0
    for p in pieces:
        batch.append(p)
        size += len(p) * 2
        if size >= BATCH_BYTES:
            yield batch
            batch, size = [], 0
    if batch:
        yield batch


def count_texts(texts: list[str | None], name: str) -> list[int]:
    """Number of tokens of each text."""
    encode, known = tokenizer(name).encode_batch_fast, counts(name)
    known[""] = 0
    total = [0] * len(texts)
    held: list[tuple[int, list[str]]] = []
    size = 0

    def settle() -> None:
        new = list({p for _, ps in held for p in ps} - known.keys())
        for batch in batches_by_bytes(new):
            known.update(zip(batch, map(len, encode(batch, add_special_tokens=False))))
        for i, ps in held:
            total[i] += sum(map(known.__getitem__, ps))
        for p in new:
            if len(p) > LONGEST:
                del known[p]
        if len(known) > REMEMBERED:
            known.clear()
            known[""] = 0
        held.clear()

    for i, text in enumerate(texts):
        for pieces in slices(text or ""):
            held.append((i, pieces))
            size += sum(map(len, pieces)) if len(pieces) < 3 else 6 * len(pieces)
            if size >= SLICE:
                settle()
                size = 0
    settle()
    return total


def token_counts(df: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY, limit: int = 2048) -> DataFrame:
    """(key, n_bytes, n_tokens, over_limit) of every whole text."""
    slim = df.select(F.col(key).alias(key), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text_"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc

        for batch in batches:
            texts = batch.column(1)
            n = pa.array(count_texts(texts.to_pylist(), vocabulary), pa.int64())
            sizes = pc.cast(pc.binary_length(texts), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), sizes, n, pc.greater(n, limit)], [key, "n_bytes", "n_tokens", "over_limit"])

    return slim.mapInArrow(run, f"{key} {slim.schema[key].dataType.simpleString()}, n_bytes long, n_tokens long, over_limit boolean")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))
