"""What several operators of this subpackage share: words, durable tables, connected parts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of code points outside space and U+0009..U+000D.
WORD = r"[^\x20\x09-\x0D]+"
BLANK = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """array<string> of the words of ``text``; empty for a null or blank text."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\f\r"))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, BLANK))


def crc_bucket(key: Column, modulus: int) -> Column:
    """crc32 of the key as text, modulo ``modulus``; null for a null key."""
    return F.crc32(key.cast("string").cast("binary")) % modulus


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names.

    Only a session on one machine may do without that setting; it gets a temporary folder of its own.
    """
    sc = spark.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoint-"))
    return sc._jsc.sc().getCheckpointDir().get()


#: Rows of a written step that one task reads, about, where a step is known to be small.
ROWS = 100_000


def durable(df: DataFrame, small: bool = False) -> DataFrame:
    """Cut the lineage with a checkpoint in the shared folder.

    ``small`` counts the rows and lets as few tasks read them as they need, so that steps of many rounds don't make
    thousands of tiny files. Executors delete the shuffle files of earlier steps once the driver has collected what
    referred to them; asking for that here keeps a job of many rounds from holding the files of all of them.
    """
    shared_folder(df.sparkSession)
    cut = df.checkpoint(eager=True)
    df.sparkSession.sparkContext._jvm.System.gc()
    return cut.coalesce(1 + cut.count() // ROWS) if small else cut


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once, as Parquet, to the shared folder and read back; for tables of which later steps read some columns."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Keys that may count as heavy, so a bound on the rows that are broadcast for them.
HEAVY = 20_000


def joined_unevenly(left: DataFrame, right: DataFrame, key: str, counts: DataFrame) -> DataFrame:
    """Inner join of ``left`` with ``right``, which has one row a key, when some keys hold a large share of ``left``.

    ``counts`` is (key, rows of ``left``). Keys with more than the total / HEAVY rows are heavy; there are fewer than HEAVY
    of them, so their rows of ``right`` are broadcast. The others are joined by a shuffle, where none has many rows.
    """
    held = counts.columns[1]
    total = counts.agg(F.sum(held)).first()[0] or 0
    heavy = counts.where(F.col(held) > total / HEAVY).select(key)
    some = F.broadcast(right.join(F.broadcast(heavy), key, "left_semi"))
    rest = left.join(F.broadcast(heavy), key, "left_anti").join(right.join(F.broadcast(heavy), key, "left_anti"), key)
    return left.join(some, key).unionByName(rest)


def components(edges: DataFrame) -> DataFrame:
    """Connected parts of the undirected graph ``edges`` (its first two columns).

    Alternates large-star and small-star contractions until nothing moves. Every step is a grouped minimum, which
    is combined before its shuffle, and a join with it, so a node of any degree is dealt with in parts. Returns
    (node, component): one row per node that has an edge to another node; component is its part's smallest node.
    """
    a, b = (F.col(c) for c in edges.columns[:2])
    now = durable(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), True)
    mark = _mark(now)
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least)
        now = durable(small.where("u <> v").distinct(), True)
        last, mark = mark, _mark(now)
        if mark == last:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select("v", "v").distinct())


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
