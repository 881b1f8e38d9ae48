"""Sliding date windows [start, start + width), anchored at the earliest date."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Sliding:
    """Window width and step in days."""

    width: int = 1095
    step: int = 182

    @classmethod
    def of(cls, years: float, months: float) -> "Sliding":
        return cls(int(years * 365.25), int(months * 30.44))


def bounds(df: DataFrame, date: str = "date") -> DataFrame:
    """One row (lo, hi): earliest and latest date."""
    return df.agg(F.min(date).alias("lo"), F.max(date).alias("hi"))


def last_window(spec: Sliding) -> Column:
    """Number of the last window: it still starts so that lo + k * step + width <= hi + step."""
    return F.floor((F.datediff("hi", "lo") + spec.step - spec.width) / spec.step).cast("int")


def windows(limits: DataFrame, spec: Sliding) -> DataFrame:
    """(k, window_start, window_end, window_center) from one row of ``bounds``; none if the span is too short."""
    k = F.explode(F.when(last_window(spec) >= 0, F.sequence(F.lit(0), last_window(spec))).otherwise(F.array().cast("array<int>")))
    days = F.col("k") * spec.step
    return limits.select("lo", k.alias("k")).select(
        "k",
        F.date_add("lo", days).alias("window_start"),
        F.date_add("lo", days + spec.width).alias("window_end"),
        F.date_add("lo", days + spec.width // 2).alias("window_center"),
    )


#: Which windows a date falls in; dates between two edges of windows have the same ones, so counts are summed by these.
SPAN = ("lo", "first", "last")


def spans(df: DataFrame, limits: DataFrame, spec: Sliding, date: str = "date") -> DataFrame:
    """``df`` with the numbers of the first and last window of each row's date, by arithmetic; without rows in none.

    There are about two such pairs a window, however many dates there are.
    """
    o = F.datediff(F.col(date), F.col("lo"))
    first = F.greatest(F.lit(0), F.floor((o - spec.width) / spec.step).cast("int") + 1)
    last = F.least(last_window(spec), F.floor(o / spec.step).cast("int"))
    # a single row of limits: its broadcast doesn't grow with the data
    return df.crossJoin(F.broadcast(limits)).withColumns({"first": first, "last": last}).where("last >= first").drop("hi")


def unfolded(df: DataFrame) -> DataFrame:
    """A row for each window of a row of ``spans``; meant for what is counted by ``SPAN`` already."""
    return df.withColumn("k", F.explode(F.sequence("first", "last"))).drop("first", "last")


def centre(spec: Sliding) -> Column:
    """The middle of window k, from the earliest date."""
    return F.date_add("lo", F.col("k") * spec.step + spec.width // 2)


def assign(df: DataFrame, limits: DataFrame, spec: Sliding, date: str = "date") -> DataFrame:
    """``df`` with a row per window that its date falls in; the windows' numbers come from arithmetic, without a range join."""
    return unfolded(spans(df, limits, spec, date)).drop("lo")
