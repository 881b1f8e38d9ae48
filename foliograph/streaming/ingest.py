"""Incremental ingestion of volumes as a stream of files; its checkpoint takes the place of a manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from foliograph.operators.lines import lines


def new_volumes(spark: SparkSession, path: str, files_per_batch: int = 100) -> DataFrame:
    """(volume_name, text) of files as they appear."""
    read = spark.readStream.schema("value STRING").option("wholetext", True).option("maxFilesPerTrigger", files_per_batch).text(path)
    return read.select(F.regexp_extract("_metadata.file_name", r"([^/]+?)(?:\.txt)?$", 1).alias("volume_name"), F.col("value").alias("text"))


def ingest_lines(spark: SparkSession, path: str, out: str, checkpoint: str) -> StreamingQuery:
    """Lines of new volumes appended to Parquet, each file once; stops when all files that are there are in."""
    rows = lines(new_volumes(spark, path), "volume_name")
    return rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, ts: str = "ts", width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Events per window and type with a bound on lateness; works on streams and tables alike."""
    return events.withWatermark(ts, late).groupBy(F.window(ts, width), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
