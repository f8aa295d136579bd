"""The query register and the stand-in tables the queries share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesloom.operators.series import daily_panel
from seriesloom.sources.readers import read_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a function under its own name, with check SQL when there is one."""

    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def panel(spark: SparkSession, d: str) -> DataFrame:
    """Daily table per nation from orders: value ``cap`` and three features.

    Orders are summed per customer and day before they meet the customers, so one very busy customer
    is a few thousand rows in the join. Money is summed in whole cents, which is exact.
    """
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    orders = read_table(spark, d, "orders").select(
        F.col("o_custkey").alias("c_custkey"), F.col("o_orderdate").cast("date").alias("date"), cents.alias("cents"), "o_totalprice"
    )
    per_customer = orders.groupBy("c_custkey", "date").agg(
        F.count("*").alias("n"), F.sum("cents").alias("cents"), F.max("o_totalprice").alias("top")
    )
    customers = read_table(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("series"))
    measures = {"n_orders": F.sum("n"), "cents": F.sum("cents"), "max_price": F.max("top")}
    daily = daily_panel(per_customer.join(customers, "c_custkey"), "series", "date", measures)
    return daily.select(
        "series", "date", (F.col("cents") / 100.0).alias("cap"), "n_orders",
        (F.col("cents") / F.col("n_orders") / 100.0).alias("avg_price"), "max_price",
    )


PANEL = """panel AS (
  SELECT series, date, cents / 100e0 AS cap, n_orders, cents / n_orders / 100e0 AS avg_price, max_price
  FROM (SELECT c_nationkey AS series, CAST(o_orderdate AS DATE) AS date, CAST(count(*) AS BIGINT) AS n_orders,
               CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents, max(o_totalprice) AS max_price
        FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2))"""


def dated_documents(spark: SparkSession, d: str) -> DataFrame:
    """Documents with a publication day; some days have none."""
    day = F.date_add(F.lit("1995-01-01").cast("date"), F.pmod(F.col("doc_id") * 7, F.lit(2404)).cast("int"))
    return read_table(spark, d, "documents").withColumn("date", day)


DATED = "dated AS (SELECT *, DATE '1995-01-01' + CAST((doc_id * 7) % 2404 AS INTEGER) AS date FROM documents)"


def daily_score(spark: SparkSession, d: str) -> DataFrame:
    """One score per day with documents: their mean length."""
    return dated_documents(spark, d).groupBy("date").agg(F.avg("n_chars").alias("score"))


SCORED = "scored AS (SELECT date, avg(n_chars) AS score FROM dated GROUP BY date)"

# Unicode white space for the check engine, whose \s is ASCII only.
SPACES = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
