"""Sinks: partitioned text and CSV, prediction JSON, edge lists, versioned archives."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def prediction_json(cases: DataFrame, path: str, threshold: float = 0.7) -> None:
    """One JSON object per volume: its cases, those of high confidence first, in their order."""
    c = F.struct(F.coalesce(F.col("confidence") < threshold, F.lit(True)).alias("low"), "case_no", "case_id", "status", "notes", "spans")
    volumes = cases.groupBy("volume_name").agg(F.sort_array(F.collect_list(c)).alias("cs"))  # a volume is a book, bounded in size
    out = volumes.select(
        F.lit(2).alias("format_version"), "volume_name", F.size("cs").alias("total_cases"),
        F.transform("cs", lambda x: F.struct(x["case_id"].alias("case_id"), x["spans"].alias("annotations"), x["status"].alias("status"), x["notes"].alias("notes"))).alias("cases"),
    )
    out.write.mode("overwrite").json(path)


def text_by_volume(lines: DataFrame, path: str) -> None:
    lines.repartition("volume").sortWithinPartitions("volume", "line_no").select("volume", "line").write.mode("overwrite").partitionBy("volume").text(path)


def edge_list(edges: DataFrame, path: str) -> None:
    """CSV by falling weight, then names; a global order, written in ranges rather than by one task."""
    edges.orderBy(F.desc("weight"), "source", "target").write.mode("overwrite").option("header", True).csv(path)


def steps(rows: DataFrame, path: str, step: str = "step") -> DataFrame:
    """CSV in a folder per step; returns the number of rows of each."""
    rows.write.mode("overwrite").partitionBy(step).option("header", True).csv(path)
    return rows.groupBy(step).agg(F.count("*").alias("rows"))


def archive(rows: DataFrame, path: str, run: str) -> None:
    """A new version beside the earlier ones; a run that exists already is an error, not overwritten."""
    rows.write.mode("errorifexists").parquet(f"{path}/run_ts={run}")


#: Columns of the table of cases, in their order; lists are joined.
CASE_COLUMNS = ["volume", "case_number", "division", "date", "ponente", "votes_raw", "concurring", "dissenting", "no_part", "on_leave", "other_votes", "unmatched_tokens", "confidence", "date_original", "date_warning"]


def case_csv(rows: DataFrame, path: str) -> None:
    """The wide table of cases by volume (none counts as 0), lists joined by "; ", as CSV with a header."""
    kinds = dict(rows.dtypes)
    joined = [F.array_join(c, "; ").alias(c) if kinds[c].startswith("array") else F.col(c).cast("string").alias(c) for c in CASE_COLUMNS]
    by = F.coalesce(F.col("volume").try_cast("int"), F.lit(0))
    rows.where(F.trim("case_number") != "").orderBy(by, "case_number").select(*joined).write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').csv(path)


def registry_json(names: DataFrame, path: str, description: str, name: str = "name") -> None:
    """{description, justices}: different names in the order of their capitals; a registry is a few hundred names."""
    first = names.groupBy(F.upper(F.trim(name)).alias("key")).agg(F.min(F.trim(name)).alias("n"))
    one = first.agg(F.transform(F.sort_array(F.collect_list(F.struct("key", "n"))), lambda x: x["n"]).alias("justices"))
    one.select(F.lit(description).alias("description"), "justices").coalesce(1).write.mode("overwrite").json(path)


def summary_json(counts: DataFrame, path: str) -> None:
    """A report of one row or a few as JSON lines in one file: statistics, corrections by kind, results of look-ups."""
    counts.coalesce(1).write.mode("overwrite").json(path)


def excerpts_markdown(spans: DataFrame, lines: DataFrame, path: str, around: int = 5) -> None:
    """One Markdown section a span with the lines around it; spans have volume, case_id, label, start_line, end_line."""
    near = spans.withColumn("line_no", F.explode(F.sequence(F.col("start_line") - around, F.col("end_line") + around))).join(lines.select("volume", "line_no", "line"), ["volume", "line_no"])
    body = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("line_no", "line"))), lambda x: F.concat(F.lit("> "), x["line"])), "\n")
    text = near.groupBy("volume", "case_id", "label", "start_line").agg(body.alias("body"))
    text.select("volume", F.concat(F.lit("## "), "case_id", F.lit(": "), "label", F.lit("\n\n"), "body", F.lit("\n")).alias("value")).repartition("volume").write.mode("overwrite").partitionBy("volume").text(path)
