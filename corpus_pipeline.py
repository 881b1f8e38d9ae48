"""From raw documents to packed training sequences, in five stages.

Each stage works on all that its predecessor kept, which it reads back from Parquet; all but the last return the
columns of ``documents``. Cases: a document that is null, empty or without a letter goes in the first stage; short
ones (under ten words) go by the base rules of the second; extra columns are dropped; an empty table stays empty.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliograph.llm import decision_list, language_id, order_minhash, packing, pii
from foliograph.llm._common import shared_folder, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def identify_language(spark: SparkSession, docs: DataFrame | None, sf_dir: str) -> DataFrame:
    """Documents whose language compression tells; learned from the labelled ones."""
    docs = (docs if docs is not None else table(spark, sf_dir, "documents")).select(COLUMNS)
    judged = language_id.identify(docs, language_id.learn(docs), *COLUMNS)
    return judged.where("NOT rejected").select(COLUMNS)


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the learned decision list."""
    rules = decision_list.fit(docs, table(spark, sf_dir, "labels"))
    return decision_list.judge(docs, rules, "text", "lang", "source", "n_chars").where("kept").select(COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates, that with the smallest id."""
    return order_minhash.one_of_each(docs.select(COLUMNS))


def replace_private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Surrogates for personal data and secrets; n_chars follows the text."""
    return pii.with_surrogates(docs.select(COLUMNS)).withColumn("n_chars", F.char_length("text").cast("long")).select(COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their bins and places."""
    return packing.pack(packing.measured(docs))


STAGES = [
    ("language ID", identify_language),
    ("quality rules", apply_quality_rules),
    ("MinHash near-dedup", drop_near_duplicates),
    ("PII", replace_private_data),
    ("best-fit packing", pack),
]

#: SQL expresses none of the learned or sketched stages; tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written to the shared folder and read back as the next one's input."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
