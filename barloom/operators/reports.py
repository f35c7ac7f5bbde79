"""Market reports over daily rows: breadth, movers, volume leaders, anomalies.

``day_rows`` gives each bar with its return and instrument; every report takes
such rows (all dates, or those of one) and ranks within (trading_date, market).
Thresholds are parameters; the defaults are the standard report's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import distance, ratio
from .indicators import series

TOP = 12
ANOMALIES = 40
DAY = ["trading_date", "market", "ticker", "close", "volume", "ret"]


def instrument(listing: Column) -> Column:
    """Instrument type of the adapters' listings: some are funds, some unclassified."""
    return F.when(listing % 5 == 4, "ETF").when(listing % 7 == 3, "").otherwise("EQUITY")


def day_rows(bars: DataFrame) -> DataFrame:
    return bars.withColumns({"ret": F.round(distance(F.col("close"), F.lag("close", 1).over(series())), 8), "instrument": instrument(F.col("listing"))})


def equities(rows: DataFrame) -> DataFrame:
    return rows.where(F.upper(F.coalesce("instrument", F.lit(""))) == "EQUITY")


def _ranked(rows: DataFrame, *order: Column, top: int = TOP) -> DataFrame:
    by = Window.partitionBy("trading_date", "market").orderBy(*order)
    return rows.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= top)


def universe(rows: DataFrame) -> DataFrame:
    kind = F.upper(F.trim(F.coalesce("instrument", F.lit(""))))
    return rows.groupBy("trading_date").agg(
        F.count("*").alias("total"),
        F.count(F.when(kind == "EQUITY", 1)).alias("equities"),
        F.count(F.when((kind != "EQUITY") & (kind != ""), 1)).alias("others"),
        F.count(F.when(kind == "", 1)).alias("unclassified"),
    )


def breadth(rows: DataFrame, markets: DataFrame) -> DataFrame:
    """One row for each date and market of ``markets`` (market), zero where no bar is."""
    r = F.col("ret")
    found = rows.groupBy("trading_date", "market").agg(
        F.count("*").alias("n"), F.count(r).alias("comparable"), F.count(F.when(r > 0, 1)).alias("advancers"), F.count(F.when(r < 0, 1)).alias("decliners"),
        F.count(F.when(r == 0, 1)).alias("unchanged"), F.count(F.when(r.isNull(), 1)).alias("missing"), F.sum("volume").alias("volume"), F.round(F.avg(r), 6).alias("avg_return"),
    )
    # as many rows as there are dates and markets; the markets are one row
    named = F.broadcast(markets.agg(F.array_sort(F.collect_set("market")).alias("markets")))
    every = rows.select("trading_date").distinct().crossJoin(named).select("trading_date", F.explode("markets").alias("market"))
    counts = ["n", "comparable", "advancers", "decliners", "unchanged", "missing"]
    return every.join(found, ["trading_date", "market"], "left").select("trading_date", "market", *[F.coalesce(c, F.lit(0)).alias(c) for c in counts], F.coalesce("volume", F.lit(0.0)).alias("volume"), "avg_return")


def move_bucket(r: Column) -> Column:
    return (
        F.when(r <= -0.10, 1).when(r <= -0.05, 2).when(r <= -0.02, 3).when(r < 0, 4).when(r == 0, 5)
        .when(r < 0.02, 6).when(r < 0.05, 7).when(r < 0.10, 8).otherwise(9)
    )


def move_buckets(rows: DataFrame, markets: list[str]) -> DataFrame:
    return rows.where("ret IS NOT NULL").groupBy(move_bucket(F.col("ret")).alias("bucket")).pivot("market", markets).count().na.fill(0)


def movers(rows: DataFrame, rising: bool) -> DataFrame:
    kept = rows.where(F.col("ret") > 0 if rising else F.col("ret") < 0)
    return _ranked(kept, F.col("ret").desc() if rising else F.col("ret").asc(), F.col("ticker"))


def volume_leaders(rows: DataFrame) -> DataFrame:
    return _ranked(rows.where("volume IS NOT NULL"), F.col("volume").desc(), F.col("ticker"))


def low_volume(rows: DataFrame) -> DataFrame:
    return _ranked(rows.where("close > 0 AND volume > 0"), F.col("volume").asc(), F.col("ticker"))


def high_volume_low_move(rows: DataFrame, most: float = 0.005) -> DataFrame:
    kept = rows.where((F.col("close") > 0) & (F.abs("ret") <= most))
    return _ranked(kept, F.col("volume").desc_nulls_last(), F.abs("ret"), F.col("ticker"))


def unconfirmed_moves(rows: DataFrame, least: float = 0.05, quantile: float = 0.2) -> DataFrame:
    """Large moves on volume at or below the date's low quantile; twelve a date."""
    kept = rows.where("close > 0 AND volume > 0")
    bar = kept.groupBy("trading_date").agg(F.expr(f"percentile_cont({quantile}) WITHIN GROUP (ORDER BY volume)").alias("bar"))
    found = kept.join(bar, "trading_date").where((F.abs("ret") >= least) & (F.col("volume") <= F.col("bar")))
    by = Window.partitionBy("trading_date").orderBy(F.abs("ret").desc(), "volume", "market", "ticker")
    return found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= TOP)


def high_conviction(rows: DataFrame, volume_top: int = 48) -> DataFrame:
    """Leading movers of their market among the date's highest volumes, by move times log volume."""
    side = Window.partitionBy("trading_date", "market", F.signum("ret")).orderBy(F.abs("ret").desc(), "ticker")
    volume = Window.partitionBy("trading_date").orderBy(F.col("volume").desc_nulls_last(), "ticker")
    found = rows.withColumns({"side_rank": F.row_number().over(side), "volume_rank": F.row_number().over(volume)})
    found = found.where((F.col("ret") != 0) & (F.col("side_rank") <= TOP) & (F.col("volume_rank") <= volume_top) & F.col("volume").isNotNull())
    found = found.withColumn("conviction", F.abs("ret") * F.log1p("volume"))
    best = Window.partitionBy("trading_date").orderBy(F.desc("conviction"), F.abs("ret").desc(), F.desc("volume"), "market", "ticker")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= TOP)


def price_anomalies(rows: DataFrame) -> DataFrame:
    r, span = F.col("ret"), ratio(F.col("high") - F.col("low"), F.col("low"))
    kind = F.when(F.abs(r) > 1, "extreme_return").when(r > 0.30, "large_gain").when(r < -0.30, "large_loss").when(span > 0.50, "wide_range")
    found = rows.withColumns({"anomaly": kind, "severity": F.round(F.greatest(F.coalesce(F.abs(r), F.lit(0.0)), F.coalesce(span, F.lit(0.0))), 8)}).where("anomaly IS NOT NULL")
    return found.orderBy(F.desc("severity"), "ticker", "trading_date").limit(ANOMALIES)


def volume_anomalies(rows: DataFrame, multiple: float = 1.5, beyond: float = 10, least_volume: float = 100) -> DataFrame:
    """Volumes of a multiple of the 20 bars before, all of them known."""
    prior = series().rowsBetween(-20, -1)
    found = rows.withColumn("prior_average", F.when(F.count("volume").over(prior) >= 20, F.avg("volume").over(prior)))
    found = found.withColumn("multiple", F.round(ratio(F.col("volume"), F.col("prior_average")), 8))
    found = found.where((F.col("multiple") >= multiple) & ((F.col("multiple") > beyond) | (F.col("volume") >= least_volume)))
    return found.orderBy(F.desc("multiple"), "ticker", "trading_date").limit(ANOMALIES)


def basket_snapshot(rows: DataFrame, basket: list[str], preferred: str) -> DataFrame:
    """Latest row of each listed ticker, the preferred market first; tickers without a row are reported."""
    spark = rows.sparkSession
    wanted = spark.createDataFrame(list(enumerate(basket, 1)), "position int, ticker string")
    best = rows.groupBy("ticker").agg(F.max_by(F.struct("trading_date", "market", "close", "ret"), F.struct((F.col("market") == preferred).alias("p"), "trading_date", "market")).alias("row"))
    return wanted.join(best, "ticker", "left").select("position", "ticker", F.col("row").isNull().alias("missing"), "row.trading_date", "row.market", "row.close", "row.ret")
