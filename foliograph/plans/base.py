"""The driver's tables seen as cases, votes and members.

An order is a case, its lines are votes, a supplier is a member of the court whose region is the appointing bloc. A
line that was returned ('R') is a dissent, any other a vote with the majority. The SQL twins start from ``PRELUDE``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliograph.operators.steps import dealt
from foliograph.operators.windows import Sliding

WINDOW = Sliding.of(3, 6)

PRELUDE = f"""
WITH cases AS (SELECT o_orderkey AS case_id, CAST(o_orderdate AS DATE) AS d, o_custkey AS party, o_orderstatus AS division,
                      o_orderpriority AS priority, 226 + (year(o_orderdate) - 1995) * 12 + month(o_orderdate) - 1 AS volume, o_totalprice AS price FROM orders),
members AS (SELECT s_suppkey AS member, r_name AS bloc FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
votes AS (SELECT l_orderkey AS case_id, l_suppkey AS member, CASE WHEN l_returnflag = 'R' THEN 'dissent' ELSE 'majority' END AS role, d, bloc
          FROM lineitem JOIN cases ON l_orderkey = case_id JOIN members ON l_suppkey = member),
limits AS (SELECT min(d) AS lo, max(d) AS hi FROM cases),
win AS (SELECT CAST(k AS INTEGER) AS k, lo + CAST(k * {WINDOW.step} AS INTEGER) AS window_start, lo + CAST(k * {WINDOW.step} + {WINDOW.width} AS INTEGER) AS window_end,
               lo + CAST(k * {WINDOW.step} + {WINDOW.width // 2} AS INTEGER) AS window_center
        FROM limits, range(0, 2000) AS t(k) WHERE lo + CAST(k * {WINDOW.step} + {WINDOW.width} AS INTEGER) <= hi + {WINDOW.step}),
placed AS (SELECT k, window_center, votes.* FROM votes JOIN win ON d >= window_start AND d < window_end)
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    date = F.to_date("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("case_id"), date.alias("date"), F.col("o_custkey").alias("party"), F.col("o_orderstatus").alias("division"), F.col("o_orderpriority").alias("priority"),
        (226 + (F.year(date) - 1995) * 12 + F.month(date) - 1).alias("volume"), F.col("o_totalprice").alias("price"),
    )


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    supplier = table(spark, sf_dir, "supplier")
    return supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).join(region, nation.n_regionkey == region.r_regionkey).select(F.col("s_suppkey").alias("member"), F.col("r_name").alias("bloc"))


def n_votes(spark: SparkSession, sf_dir: str) -> int:
    """How many lines there are, from the files' footers."""
    return table(spark, sf_dir, "lineitem").count()


#: Members up to which they are broadcast to the votes, about 60 MB of them.
MEMBERS = 1_000_000


def votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with their members and cases, dealt by case; they stay so, since what comes last is a join by case.

    The optimiser can't tell how few members there are, and would shuffle lines by member after they are dealt.
    """
    role = F.when(F.col("l_returnflag") == "R", "dissent").otherwise("majority").alias("role")
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("case_id"), F.col("l_suppkey").alias("member"), role)
    n, court = n_votes(spark, sf_dir), members(spark, sf_dir)
    if table(spark, sf_dir, "supplier").count() <= MEMBERS:
        named = dealt(lines, n, "case_id").join(F.broadcast(court), "member")
    else:
        named = dealt(dealt(lines, n, "member").join(dealt(court, n, "member"), "member"), n, "case_id")
    return named.join(dealt(cases(spark, sf_dir).select("case_id", "date"), n, "case_id"), "case_id").select("member", "case_id", "role", "date", "bloc")
