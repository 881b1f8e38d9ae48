"""Language identification by compression.

One zstandard raw-content dictionary per language holds text of that language. A text is coded once with each; the
language whose dictionary gives the fewest bytes is chosen, and the choice is rejected if the next best one comes
within a narrow margin. Whole texts are coded, in parts cut at spaces so that the dictionary matters throughout.

Dictionaries come from a bounded sample of labelled documents (``DOCUMENTS``); nothing but text enters a prediction. A text that is
null or has no letter is ``und`` with score 0 and rejected. If nothing was learned every text is. Copies of a row
are judged alike; columns other than those asked for are left aside.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliograph.llm._common import crc_bucket, table, words

#: Labelled documents per language that a dictionary is made of, at most; and the most bytes it takes from them.
DOCUMENTS, DICTIONARY_BYTES = 240, 96_000
#: Passages taken from each of them, evenly spread over the whole text.
PASSAGES = 4
PART = 6_000
#: Effort of the coder; narrow choices are coded again with the second, which finds shorter matches.
LEVEL, SECOND_LEVEL = 9, 19
#: A choice is rejected if the runner-up needs less than this share of bytes more, the second time too.
NARROW = 0.002


def learn(docs: DataFrame, among: Column | None = None) -> dict[str, bytes]:
    """Language -> dictionary, from a sample of the labelled documents; every language of theirs is learned.

    Documents are taken whose id hashes below a share that gives about ``DOCUMENTS`` per language, in one pass, repeated
    rows once. Of each, ``PASSAGES`` runs of words go to the driver, so it gets ``DICTIONARY_BYTES`` per language, about.
    """
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & (F.lit(True) if among is None else among))
    sizes = known.groupBy("lang").count().collect()
    if not sizes:
        return {}
    place = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1_000_000))
    share = F.create_map(*[F.lit(v) for r in sizes for v in (r["lang"], min(1_000_000, -(-DOCUMENTS * 1_000_000 // r["count"])))])
    each = DICTIONARY_BYTES // DOCUMENTS * 4
    w, n = F.col("w"), F.size("w")
    run = max(1, each // PASSAGES // 6)  # words
    spread = F.transform(F.sequence(F.lit(0), F.lit(PASSAGES - 1)), lambda k: F.array_join(F.slice(w, F.floor(k * F.greatest(n - run, F.lit(0)) / (PASSAGES - 1)).cast("int") + 1, F.lit(run)), " "))
    taken = F.when(n <= run * PASSAGES, F.array_join(w, " ")).otherwise(F.array_join(spread, " "))
    picked = known.where(place < F.element_at(share, F.col("lang"))).select("lang", place.alias("place"), F.col("doc_id").cast("string").alias("id"), F.xxhash64("text").alias("same"), words(F.lower("text")).alias("w"))
    picked = picked.withColumn("text", taken).groupBy("lang", "place", "id", "same").agg(F.first("text").alias("text"))
    first = picked.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("place", "id", "same"))).where(F.col("rank") <= DOCUMENTS)
    out: dict[str, list[bytes]] = {}
    for r in sorted(first.select("lang", "rank", "text").collect(), key=lambda r: (r["lang"], r["rank"])):
        out.setdefault(r["lang"], []).append(_clean(r["text"]).encode("utf-8", "surrogatepass")[: 2 * each])
    return {lang: b"\n".join(parts)[-DICTIONARY_BYTES:] for lang, parts in out.items()}


def _clean(text: str) -> str:
    """Letters and single spaces: what is common to all languages tells nothing."""
    return " ".join("".join(c if c.isalpha() else " " for c in text).split())


class Compressors:
    def __init__(self, dictionaries: dict[str, bytes]):
        import zstandard

        self.langs = sorted(dictionaries)

        def coder(lang: str, level: int):
            d = zstandard.ZstdCompressionDict(dictionaries[lang] or b" ", dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=level)
            return zstandard.ZstdCompressor(dict_data=d, level=level, write_content_size=False, write_checksum=False, write_dict_id=False).compress

        self.code, self.again = ([coder(x, level) for x in self.langs] for level in (LEVEL, SECOND_LEVEL))

    def sizes(self, text: str, coders: list) -> list[int]:
        """Bytes that the whole text takes with each dictionary, in parts cut at spaces."""
        size, at = [0] * len(coders), 0
        while at < len(text):
            end = text.find(" ", at + PART)
            end = len(text) if end < 0 or len(text) - end < PART // 4 else end
            part = text[at:end].encode("utf-8", "surrogatepass")
            for k, code in enumerate(coders):
                size[k] += len(code(part))
            at = end
        return size

    def judge(self, text: str | None) -> tuple[str, float, bool]:
        """(language, score, rejected)"""
        text = text or ""
        if not self.langs or not any(map(str.isalpha, text)):
            return "und", 0.0, True
        if text.isascii():
            text = " ".join(re.sub(r"[^a-z]+", " ", text.lower()).split())
        else:
            text = " ".join(re.sub(r"[\W\d_]+", " ", text.lower()).split())
        if len(self.langs) == 1:
            return self.langs[0], 1.0, False
        for coders in (self.code, self.again):
            size = self.sizes(text, coders)
            order = sorted(range(len(size)), key=lambda k: (size[k], self.langs[k]))
            margin = (size[order[1]] - size[order[0]]) / max(size[order[1]], 1)
            if margin >= NARROW:
                break
        return self.langs[order[0]], min(1.0, 0.5 + 2 * margin), margin < NARROW


def identify(docs: DataFrame, dictionaries: dict[str, bytes], *columns: str, text: str = "text") -> DataFrame:
    """(*columns, lang_pred, score, rejected) of every document."""
    slim = docs.select(*columns, F.col(text).cast("string").alias("_text"))
    shared = docs.sparkSession.sparkContext.broadcast(dictionaries)  # DICTIONARY_BYTES per language at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Compressors(shared.value).judge
        for batch in batches:
            got = [judge(t) for t in batch.column(batch.num_columns - 1).to_pylist()]
            added = [pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64()), pa.array([g[2] for g in got], pa.bool_())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *added], [*columns, "lang_pred", "score", "rejected"])

    kinds = ", ".join(f"`{c}` {slim.schema[c].dataType.simpleString()}" for c in columns)
    return slim.mapInArrow(run, f"{kinds}, lang_pred string, score double, rejected boolean")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = F.coalesce(crc_bucket(F.col("doc_id"), 4) == 2, F.lit(False))
    found = identify(docs, learn(docs, ~held), "doc_id")
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score", "rejected")
