"""The line model of a text: numbered lines with offsets, pages and a noise mask."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def lines(docs: DataFrame, key: str, text: str = "text", keep_trailing: bool = False) -> DataFrame:
    """(key, line_no from 1, start_char from 0, line): CR and CRLF become LF, one trailing LF goes.

    Offsets are prefix sums inside the document's own array, so no window and no shuffle is needed.
    """
    t = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), "\r\n?", "\n")
    if not keep_trailing:
        t = F.regexp_replace(t, "\n\\z", "")
    split = docs.select(F.col(key), F.split(t, "\n", -1).alias("ls"))
    ends = F.aggregate(
        "ls",
        F.struct(F.array().cast("array<bigint>").alias("starts"), F.lit(0).cast("bigint").alias("at")),
        lambda a, x: F.struct(F.array_append(a["starts"], a["at"]).alias("starts"), (a["at"] + F.length(x) + 1).alias("at")),
    )["starts"]
    zipped = F.transform(F.arrays_zip(F.col("ls").alias("ls"), F.col("starts").alias("starts")), lambda x, i: F.struct((i + 1).alias("line_no"), x["starts"].alias("start_char"), x["ls"].alias("line")))
    return split.withColumn("starts", ends).select(key, F.inline(zipped))


def with_page(rows: DataFrame, key: str, marker: Column) -> DataFrame:
    """``page``: number of the nearest marker at or before the line, else 0. ``marker`` is null on other lines."""
    w = Window.partitionBy(key).orderBy("line_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn("page", F.coalesce(F.last(marker, ignorenulls=True).over(w), F.lit(0)))


#: Fixed value: a page marker in a volume's text.
PAGE = r"^--- Page (\d+) ---$"


def indexed_lines(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, line_no from 0, line, page): as ``lines``, but the empty line after a last newline stays; page 0 before a marker."""
    rows = lines(docs, key, text, keep_trailing=True)
    marker = F.when(F.col("line").rlike(PAGE), F.regexp_extract("line", PAGE, 1).try_cast("int"))
    return with_page(rows, key, marker).select(key, (F.col("line_no") - 1).alias("line_no"), "line", "page")


def line_of(points: DataFrame, rows: DataFrame, key: str, offset: str = "char") -> DataFrame:
    """As-of join: the last line that starts at or before each offset; offsets outside are clamped.

    Offsets and line starts meet in one sorted window per document instead of a range join.
    """
    a = rows.select(key, F.col("start_char").alias("at"), F.lit(0).alias("kind"), F.col("line_no").alias("found"))
    b = points.select(key, F.greatest(F.col(offset), F.lit(0)).cast("bigint").alias("at"), F.lit(1).alias("kind"), F.lit(None).cast("int").alias("found"), F.col(offset).alias("asked"))
    w = Window.partitionBy(key).orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return a.withColumn("asked", F.lit(None).cast(dict(points.dtypes)[offset])).unionByName(b).withColumn("line_no", F.last("found", ignorenulls=True).over(w)).where("kind = 1").select(key, F.col("asked").alias(offset), "line_no")


def noise_mask(rows: DataFrame, key: str, always: Column, short_title: Column) -> DataFrame:
    """``is_noise`` in three passes: fixed patterns; short titles after noise (cascading); blanks between noise.

    A run of short titles is noise if and only if the non-blank line before the run is, which is a gaps-and-islands
    window over the non-blank lines.
    """
    blank = F.trim("line") == ""
    rows = rows.withColumns({"_blank": blank, "_fixed": ~blank & always, "_title": ~blank & ~always & short_title})
    solid = Window.partitionBy(key).orderBy("line_no")
    island = F.sum(F.when(~F.col("_blank") & ~F.col("_title"), 1).otherwise(0)).over(solid.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = rows.withColumn("_island", island)
    head = F.max(F.when(~F.col("_title") & ~F.col("_blank"), F.col("_fixed"))).over(Window.partitionBy(key, "_island"))
    rows = rows.withColumn("_second", F.col("_fixed") | (F.col("_title") & F.coalesce(head, F.lit(False))))
    mark = F.when(~F.col("_blank"), F.col("_second"))
    before = F.last(mark, ignorenulls=True).over(solid.rowsBetween(Window.unboundedPreceding, -1))
    after = F.first(mark, ignorenulls=True).over(solid.rowsBetween(1, Window.unboundedFollowing))
    third = F.col("_second") | (F.col("_blank") & F.coalesce(before & after, F.lit(False)))
    return rows.withColumn("is_noise", third).drop("_blank", "_fixed", "_title", "_island", "_second")
