"""Logical inputs of the pipeline mapped onto the driver's test tables.

Each function reads the whole table (only the needed columns) and renames it to
the logical schema of §1.4, so every registered query grows with its tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterlens.operators.joins import bounded_broadcast
from quarterlens.operators.partitioning import spread
from quarterlens.sources.tables import read_table


def documents(spark: SparkSession, sf: str) -> DataFrame:
    """MD&A texts: (doc_id, text)."""
    return spread(read_table(spark, sf, "documents", ["doc_id", "text"]), ["doc_id"])


def prices(spark: SparkSession, sf: str) -> DataFrame:
    """Tick prices: purchases as (ticker, ts, close, event_id)."""
    e = read_table(spark, sf, "events", ["event_id", "ts", "user_id", "event_type", "value"])
    return (e.filter(F.col("event_type") == "purchase")
            .select(F.col("user_id").alias("ticker"), "ts", F.col("value").alias("close"),
                    "event_id"))


def earnings(spark: SparkSession, sf: str) -> DataFrame:
    """Earnings announcements: signups as (event_id, ticker, earnings_ts)."""
    e = read_table(spark, sf, "events", ["event_id", "ts", "user_id", "event_type"])
    return (e.filter(F.col("event_type") == "signup")
            .select("event_id", F.col("user_id").alias("ticker"), F.col("ts").alias("earnings_ts")))


def views(spark: SparkSession, sf: str) -> DataFrame:
    """Lookup requests: views as (event_id, ticker, ts)."""
    e = read_table(spark, sf, "events", ["event_id", "ts", "user_id", "event_type"])
    return (e.filter(F.col("event_type") == "view")
            .select("event_id", F.col("user_id").alias("ticker"), "ts"))


def membership(spark: SparkSession, sf: str) -> DataFrame:
    """Index snapshots (date, ticker): each order is 'customer listed on that day'."""
    o = read_table(spark, sf, "orders", ["o_orderdate", "o_custkey"])
    return o.select(F.to_date("o_orderdate").alias("date"),
                    F.col("o_custkey").cast("string").alias("ticker"))


def company_info(spark: SparkSession, sf: str) -> DataFrame:
    """Company facts per ticker (customer key): names, shares outstanding, sector, industry.

    The long name is missing for debtors so the ``N/A`` default is exercised.
    """
    c = read_table(spark, sf, "customer", ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"])
    n = read_table(spark, sf, "nation", ["n_nationkey", "n_name"])
    j = c.join(bounded_broadcast(n), c["c_nationkey"] == n["n_nationkey"], "left")  # 25 nations
    return j.select(F.col("c_custkey").alias("ticker"), F.col("c_name").alias("short_name"),
                    F.when(F.col("c_acctbal") > 0, F.col("c_name")).alias("long_name"),
                    (F.abs("c_acctbal") * 1000 + 1).alias("shares_outstanding"),
                    F.col("c_mktsegment").alias("sector"), F.col("n_name").alias("industry"))


def sectors(spark: SparkSession, sf: str) -> DataFrame:
    """Sector per ticker (customer key)."""
    c = read_table(spark, sf, "customer", ["c_custkey", "c_mktsegment"])
    return c.select(F.col("c_custkey").alias("ticker"), F.col("c_mktsegment").alias("sector"))


def order_prices(spark: SparkSession, sf: str) -> DataFrame:
    """Order totals as a price feed: (ticker = customer key as text, ts, close, event_id)."""
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_orderdate", "o_totalprice"])
    return o.select(F.col("o_custkey").cast("string").alias("ticker"), F.col("o_orderdate").alias("ts"),
                    F.col("o_totalprice").alias("close"), F.col("o_orderkey").alias("event_id"))
