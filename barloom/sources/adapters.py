"""Views of the star-schema tables as market data: listings, bars, a benchmark series."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """listing, market, ticker: one row a nation."""
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(F.col("n_nationkey").alias("listing"), F.col("r_name").alias("market"), F.col("n_name").alias("ticker"))


def _order_volumes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum("l_quantity").alias("quantity"))


def raw_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars without listing names: orders of one nation on one day, first and last by order key."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", F.to_date("o_orderdate").alias("trading_date"))
    nations = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("listing"))
    rows = orders.join(nations, "o_custkey").join(_order_volumes(spark, sf_dir), "o_orderkey", "left")
    return rows.groupBy("listing", "trading_date").agg(
        F.min_by("o_totalprice", "o_orderkey").alias("open"),
        F.max("o_totalprice").alias("high"),
        F.min("o_totalprice").alias("low"),
        F.max_by("o_totalprice", "o_orderkey").alias("close"),
        F.sum("quantity").alias("volume"),
    )


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars with listing names; ``volume`` is null where no line item is known."""
    return raw_bars(spark, sf_dir).join(listings(spark, sf_dir), "listing").select("listing", "market", "ticker", "trading_date", "open", "high", "low", "close", "volume")


def benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """trading_date, bench_close: last order of each day; days of a month with remainder 3 of 7 are missing."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", F.to_date("o_orderdate").alias("trading_date"))
    return orders.where(F.dayofmonth("trading_date") % 7 != 3).groupBy("trading_date").agg(F.max_by("o_totalprice", "o_orderkey").alias("bench_close"))


#: The same views for the SQL oracle.
BARS_SQL = """
listings AS (SELECT n_nationkey AS listing, r_name AS market, n_name AS ticker FROM nation JOIN region ON n_regionkey = r_regionkey),
volumes AS (SELECT l_orderkey, sum(l_quantity) AS quantity FROM lineitem GROUP BY 1),
raw_bars AS (
  SELECT c_nationkey AS listing, CAST(o_orderdate AS DATE) AS trading_date, min_by(o_totalprice, o_orderkey) AS open, max(o_totalprice) AS high,
         min(o_totalprice) AS low, max_by(o_totalprice, o_orderkey) AS close, sum(quantity) AS volume
  FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN volumes ON l_orderkey = o_orderkey GROUP BY 1, 2),
bars AS (SELECT listing, market, ticker, trading_date, open, high, low, close, volume FROM raw_bars JOIN listings USING (listing)),
bench AS (
  SELECT CAST(o_orderdate AS DATE) AS trading_date, max_by(o_totalprice, o_orderkey) AS bench_close
  FROM orders WHERE day(o_orderdate) % 7 <> 3 GROUP BY 1)
"""
