"""Coverage, gaps, freshness and session planning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .indicators import series


def listing_coverage(listings: DataFrame, bars: DataFrame, start=None, end=None) -> DataFrame:
    """Bars and dates of every listing; the date range limits bars, so empty listings stay."""
    if start:
        bars = bars.where(F.col("trading_date") >= F.lit(start).cast("date"))
    if end:
        bars = bars.where(F.col("trading_date") <= F.lit(end).cast("date"))
    counts = bars.groupBy("listing").agg(F.count("*").alias("bars"), F.min("trading_date").alias("first_date"), F.max("trading_date").alias("last_date"))
    return listings.join(counts, "listing", "left").withColumn("bars", F.coalesce("bars", F.lit(0)))


def market_health(coverage: DataFrame, active: Column) -> DataFrame:
    """Two levels: series, then markets, by active and by having bars."""
    has, own = F.col("bars") > 0, active
    return coverage.groupBy("market").agg(
        F.count(F.when(own & has, 1)).alias("active_with_bars"), F.count(F.when(own & ~has, 1)).alias("active_without_bars"),
        F.count(F.when(~own & has, 1)).alias("inactive_with_bars"), F.count(F.when(~own & ~has, 1)).alias("inactive_without_bars"),
        F.sum("bars").alias("bars"), F.min(F.when(own, F.col("first_date"))).alias("first_date"), F.max(F.when(own, F.col("last_date"))).alias("last_date"),
    )


def weekday_gaps(bars: DataFrame) -> DataFrame:
    """Every missing Monday to Friday between consecutive bars of a listing."""
    gaps = bars.select("listing", "trading_date", F.lag("trading_date", 1).over(series()).alias("before")).where(F.datediff("trading_date", "before") > 1)
    days = gaps.select("listing", F.explode(F.sequence(F.date_add("before", 1), F.date_sub("trading_date", 1))).alias("missing_date"))
    return days.where(F.weekday("missing_date") < 5)


def with_total(rows: DataFrame, sample: int, *order: str) -> DataFrame:
    """The first ``sample`` rows, each with the number of all rows."""
    total = rows.agg(F.count("*").alias("total"))
    return rows.orderBy(*order).limit(sample).crossJoin(F.broadcast(total))


def freshness(last_date: Column, as_of: Column, delayed: int = 1, stale: int = 5) -> Column:
    age = F.datediff(as_of, last_date)
    return (
        F.when(last_date.isNull(), "no_data").when(age < 0, "invalid_future_date").when(age <= delayed, "current")
        .when(age <= stale, "delayed").otherwise("stale_candidate")
    )


def weekday_age(first: Column, last: Column) -> Column:
    """Weekdays after ``first`` up to and including ``last``, in closed form."""
    def upto(d):  # weekdays from a Monday long ago to d, inclusive
        days = F.datediff(d, F.lit("1900-01-01").cast("date")) + 1
        return F.floor(days / 7) * 5 + F.least(days % 7, F.lit(5))

    return (upto(last) - upto(first)).cast("long")


def expected_sessions(start: Column, end: Column) -> Column:
    """Array of the weekday sessions of a range, empty if it is."""
    days = F.when(start <= end, F.sequence(start, end)).otherwise(F.array().cast("array<date>"))
    return F.filter(days, lambda d: F.weekday(d) < 5)


def missing_sessions(bars: DataFrame, sessions: DataFrame) -> DataFrame:
    """Sessions (session) within a listing's own range that it has no bar for."""
    span = bars.groupBy("listing").agg(F.min("trading_date").alias("a"), F.max("trading_date").alias("b"))
    every = span.select("listing", F.explode(expected_sessions(F.col("a"), F.col("b"))).alias("trading_date"))
    if sessions is not None:
        every = every.join(sessions.select(F.col("session").alias("trading_date")), "trading_date", "left_semi")
    return every.join(bars.select("listing", "trading_date"), ["listing", "trading_date"], "left_anti")


def pull_ranges(missing: DataFrame, max_days: int = 5) -> DataFrame:
    """Islands of consecutive missing weekdays, cut into ranges of at most ``max_days`` sessions."""
    ordinal = weekday_age(F.lit("1900-01-01").cast("date"), F.col("trading_date"))
    numbered = missing.withColumn("n", ordinal).withColumn("island", F.col("n") - F.row_number().over(Window.partitionBy("listing").orderBy("trading_date")))
    start = F.min("n").over(Window.partitionBy("listing", "island"))
    parts = numbered.withColumn("part", F.floor((F.col("n") - start) / max_days))
    return parts.groupBy("listing", "island", "part").agg(F.min("trading_date").alias("range_start"), F.max("trading_date").alias("range_end"), F.count("*").alias("sessions")).drop("island", "part")


def session_coverage(bars: DataFrame, missing: DataFrame) -> DataFrame:
    stored = bars.groupBy("listing").agg(F.count("*").alias("stored"), F.count(F.when(F.weekday("trading_date") < 5, 1)).alias("stored_sessions"))
    lost = missing.groupBy("listing").agg(F.count("*").alias("missing"))
    out = stored.join(lost, "listing", "left").withColumn("missing", F.coalesce("missing", F.lit(0)))
    eligible = F.col("stored_sessions") + F.col("missing")
    return out.withColumns({"eligible": eligible, "coverage_pct": F.round(100 * F.col("stored_sessions") / F.nullif(eligible, F.lit(0)), 2)})


def prior_bar(bars: DataFrame, asked: DataFrame) -> DataFrame:
    """For each (listing, as_of) the last bar before it: one pass over both in date order."""
    bar = F.struct("trading_date", "close").alias("bar")
    rows = bars.select("listing", F.col("trading_date").alias("at"), F.lit(True).alias("is_bar"), bar)
    both = rows.unionByName(asked.select("listing", F.col("as_of").alias("at"), F.lit(False).alias("is_bar")).distinct(), allowMissingColumns=True)
    # a bar of the date itself comes after the question
    upto = Window.partitionBy("listing").orderBy("at", "is_bar").rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumn("prior", F.last("bar", ignorenulls=True).over(upto)).where("NOT is_bar")
    return found.select("listing", F.col("at").alias("as_of"), F.col("prior.trading_date").alias("prior_date"), F.col("prior.close").alias("prior_close"))
