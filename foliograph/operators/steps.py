"""Steps of iterative jobs, written to the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; only a session on one machine may have none, and gets a temporary one."""
    sc = spark.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoint-"))
    return sc._jsc.sc().getCheckpointDir().get()


def written(df: DataFrame) -> DataFrame:
    """Cut the lineage with a checkpoint in ``spark.checkpoint.dir``."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def tabled(df: DataFrame) -> DataFrame:
    """Cut the lineage with a Parquet table in the same folder.

    A checkpoint keeps what the optimiser knows of its rows; over many rounds that grows until planning outlasts the
    work. A table that was read back has none of it.
    """
    path = f"{shared_folder(df.sparkSession)}/step-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows that a task is dealt, about, where they or what is made of them is sorted or grouped.
ROWS = 250_000


def dealt(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df`` by ``keys`` in as many tasks as ``rows`` need, at ``ROWS`` a task; as it is if one task will do.

    With a set number of tasks, or one that comes of the bytes read, a task's sorts and maps would grow with the tables.
    """
    if rows <= ROWS:
        return df
    return df.repartition(max(-(-rows // ROWS), df.sparkSession.sparkContext.defaultParallelism), *keys)
