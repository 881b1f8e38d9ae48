"""Sources: text volumes, prediction JSON, case CSV, registries and dimensions; schemas are explicit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliograph.functions import fields, repair

SPAN = "label STRING, text STRING, `group` INT, start_char INT, end_char INT, start_page INT, end_page INT, detection_method STRING"
CASE = f"case_id STRING, annotations ARRAY<STRUCT<{', '.join(x.replace(' ', ': ', 1) for x in SPAN.split(', '))}>>, status STRING, notes STRING"
CASE_TYPE = CASE.replace("case_id STRING", "case_id: STRING").replace(", annotations ", ", annotations: ").replace(", status ", ", status: ").replace(", notes ", ", notes: ")
LISTED = f"format_version INT, status STRING, volumes ARRAY<STRUCT<volume_name: STRING, total_cases: INT, cases: ARRAY<STRUCT<{CASE_TYPE}>>>>, _corrupt_record STRING"
MAPPED = f"format_version INT, volumes MAP<STRING, STRUCT<volume: STRING, cases: ARRAY<STRUCT<{CASE_TYPE}>>>>, _corrupt_record STRING"
CASE_CSV = "volume STRING, case_number STRING, division STRING, date STRING, ponente STRING, votes_raw STRING, concurring STRING, dissenting STRING, no_part STRING, on_leave STRING, other_votes STRING, unmatched_tokens STRING, confidence STRING, date_original STRING, date_warning STRING"


def volumes(spark: SparkSession, path: str) -> DataFrame:
    """(volume_name, vol_num, text, mtime) of ``Volume_<n>.txt`` and the like; of several spellings the first wins."""
    # the metadata column escapes file names as in a URL
    name = F.regexp_extract(F.url_decode(F.replace("_metadata.file_name", F.lit("+"), F.lit("%2B"))), r"([^/]+?)(?:\.txt)?$", 1)
    files = spark.read.text(path, wholetext=True).select(name.alias("volume_name"), F.col("value").alias("text"), F.col("_metadata.file_modification_time").alias("mtime"))
    number = F.regexp_extract("volume_name", r"(\d+)", 1).try_cast("int")
    rank = F.when(F.col("volume_name").startswith("Volume_"), 0).when(F.col("volume_name").startswith("Volume "), 1).otherwise(2)
    best = files.withColumns({"vol_num": number, "rank": rank})
    first = best.groupBy(F.col("vol_num").alias("num")).agg(F.min(F.struct("rank", "volume_name"))["volume_name"].alias("first"))
    return best.join(first, F.col("vol_num").eqNullSafe(F.col("num")) & (F.col("first") == F.col("volume_name"))).select("volume_name", "vol_num", "text", "mtime")


def predictions(spark: SparkSession, path: str, mapped: bool = False) -> DataFrame:
    """(volume_name, case_no, case_id, status, notes, spans) of prediction files, with volumes as a list or as a map.

    Files that don't parse are left out; ``broken_files`` lists them.
    """
    read = spark.read.schema(MAPPED if mapped else LISTED).option("multiLine", True).option("mode", "PERMISSIVE").json(path).where("_corrupt_record IS NULL")
    if mapped:
        each = read.select(F.explode("volumes").alias("volume_name", "v")).select("volume_name", "v.cases")
    else:
        each = read.select(F.inline("volumes")).select("volume_name", "cases")
    return each.select("volume_name", F.posexplode("cases").alias("case_no", "c")).select("volume_name", "case_no", "c.case_id", "c.status", "c.notes", F.col("c.annotations").alias("spans"))


def broken_files(spark: SparkSession, path: str) -> DataFrame:
    read = spark.read.schema(LISTED).option("multiLine", True).option("mode", "PERMISSIVE").json(path).withColumn("file", F.col("_metadata.file_name"))
    return read.cache().where("_corrupt_record IS NOT NULL").select("file")


def case_csv(spark: SparkSession, path: str) -> DataFrame:
    """The wide table of cases; a byte order mark at the start of a file is dropped, lists become arrays."""
    rows = spark.read.schema(CASE_CSV).option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').csv(path)
    listed = {c: F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), ";"), lambda x: F.trim(x)), lambda x: x != "") for c in ("concurring", "dissenting", "no_part", "on_leave", "other_votes", "unmatched_tokens")}
    return rows.withColumns({"volume": F.regexp_replace("volume", "^﻿", ""), "confidence": F.col("confidence").try_cast("double"), **listed})


def confidence_in(notes: Column) -> Column:
    """Confidence written in a case's notes, null where there is none."""
    return F.regexp_extract(notes, r"confidence:\s*([\d.]+)", 1).try_cast("double")


def pasted(spark: SparkSession, lines: DataFrame) -> DataFrame:
    """(volume, case_number) of pasted tab-separated lines; malformed ones are left out."""
    part = F.split("value", "\t")
    return lines.where(F.size(part) >= 2).select(F.regexp_extract(part[0], r"(\d+)", 1).try_cast("int").alias("volume"), F.trim(part[1]).alias("case_number")).where("volume IS NOT NULL AND case_number <> ''")


def registry(spark: SparkSession, path: str) -> DataFrame:
    """(ord, name) of a registry {description, justices}; none for a file that is missing or doesn't parse."""
    read = spark.read.schema("description STRING, justices ARRAY<STRING>, _corrupt_record STRING").option("multiLine", True).option("ignoreMissingFiles", True)
    return read.json(path).where("_corrupt_record IS NULL").select(F.posexplode("justices").alias("ord", "name"))


TERMS_CSV = "`No.` STRING, Name STRING, `Birth Year` STRING, `Death Year` STRING, Position STRING, Succeeded STRING, `Tenure Start` STRING, `Tenure End` STRING, `Tenure Length` STRING, `Appointed By` STRING"


def terms(spark: SparkSession, path: str) -> DataFrame:
    """(name, position, start, end, days, appointed_by) of a CSV of terms of office; end is null for incumbents."""
    rows = spark.read.schema(TERMS_CSV).option("header", True).option("quote", '"').option("escape", '"').csv(path)
    return rows.select(
        F.trim("Name").alias("name"), "Position", repair.flexible_date(F.col("`Tenure Start`")).alias("start"), repair.flexible_date(F.col("`Tenure End`")).alias("end"),
        fields.term_days(F.col("`Tenure Length`")).alias("days"), F.col("`Appointed By`").alias("appointed_by"),
    ).withColumnRenamed("Position", "position")


def scans(spark: SparkSession, path: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """(name, volume, length, mtime) of scanned files that are not searchable copies, of an inclusive range of volumes."""
    name = F.element_at(F.split("path", "/"), -1)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").load(path).select(F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B"))).alias("name"), "length", F.col("modificationTime").alias("mtime"))
    files = files.where(~F.col("name").contains("_searchable")).withColumn("volume", fields.volume_number(F.col("name")))
    ranged = F.lit(True)
    if first is not None:
        ranged &= F.col("volume") >= first
    if last is not None:
        ranged &= F.col("volume") <= last
    return files.where(ranged).select("name", "volume", "length", "mtime")
