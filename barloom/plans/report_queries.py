"""Registered reports and coverage queries with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import coverage, reports
from ..sources import adapters
from ..sources.adapters import BARS_SQL

MARKETS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
BASKET = ["NATION_6", "NATION_2", "NATION_99", "NATION_11", "NATION_20"]
DAY = ["trading_date", "market", "ticker", "close", "volume", "ret", "rank"]


def _day(spark, sf_dir):
    return reports.day_rows(adapters.bars(spark, sf_dir))


def _equities(spark, sf_dir):
    return reports.equities(_day(spark, sf_dir))


def universe(spark, sf_dir):
    return reports.universe(_day(spark, sf_dir))


def breadth(spark, sf_dir):
    return reports.breadth(_equities(spark, sf_dir), adapters.listings(spark, sf_dir))


def move_buckets(spark, sf_dir):
    return reports.move_buckets(_equities(spark, sf_dir), MARKETS)


def movers_desc(spark, sf_dir):
    return reports.movers(_equities(spark, sf_dir), True).select(*DAY)


def movers_asc(spark, sf_dir):
    return reports.movers(_equities(spark, sf_dir), False).select(*DAY)


def volume_leaders(spark, sf_dir):
    return reports.volume_leaders(_equities(spark, sf_dir)).select(*DAY)


def low_volume(spark, sf_dir):
    return reports.low_volume(_equities(spark, sf_dir)).select(*DAY)


def high_vol_low_move(spark, sf_dir):
    return reports.high_volume_low_move(_equities(spark, sf_dir), most=0.05).select(*DAY)


def unconfirmed_moves(spark, sf_dir):
    return reports.unconfirmed_moves(_equities(spark, sf_dir)).select(*DAY)


def high_conviction(spark, sf_dir):
    return reports.high_conviction(_equities(spark, sf_dir)).select(*DAY, F.round("conviction", 6).alias("conviction"))


def price_anomalies(spark, sf_dir):
    return reports.price_anomalies(_equities(spark, sf_dir)).select("trading_date", "market", "ticker", "ret", "anomaly", "severity")


def volume_anomalies(spark, sf_dir):
    return reports.volume_anomalies(_equities(spark, sf_dir)).select("trading_date", "market", "ticker", "volume", "multiple")


def basket_snapshot(spark, sf_dir):
    return reports.basket_snapshot(_equities(spark, sf_dir), BASKET, "ASIA")


def bars_listing(spark, sf_dir):
    return adapters.bars(spark, sf_dir)


def latest_date(spark, sf_dir):
    return adapters.bars(spark, sf_dir).agg(F.min("trading_date").alias("first_date"), F.max("trading_date").alias("last_date"), F.count("*").alias("bars"))


def listing_coverage(spark, sf_dir):
    return coverage.listing_coverage(adapters.listings(spark, sf_dir), adapters.bars(spark, sf_dir).where("listing % 9 <> 4"), "1995-01-01", "1996-12-31")


def series_health(spark, sf_dir):
    found = listing_coverage(spark, sf_dir)
    return found.withColumn("status", F.when(F.col("bars") == 0, "EMPTY").when(F.col("bars") < 100, "THIN").otherwise("OK"))


def market_health(spark, sf_dir):
    return coverage.market_health(listing_coverage(spark, sf_dir), F.col("listing") % 6 != 0)


def weekday_gaps(spark, sf_dir):
    return coverage.weekday_gaps(adapters.bars(spark, sf_dir))


def weekday_gap_sample(spark, sf_dir):
    return coverage.with_total(weekday_gaps(spark, sf_dir), 100, "missing_date", "listing")


def freshness(spark, sf_dir):
    rows = coverage.listing_coverage(adapters.listings(spark, sf_dir), adapters.bars(spark, sf_dir).where("listing % 9 <> 4"))
    rows = rows.withColumn("last_date", F.date_sub("last_date", F.col("listing") % 4 * 3))
    as_of = F.lit("1998-08-02").cast("date")
    return rows.select("listing", "last_date", coverage.freshness(F.col("last_date"), as_of).alias("freshness"))


def missing_sessions(spark, sf_dir):
    return coverage.missing_sessions(adapters.bars(spark, sf_dir), None)


def pull_ranges(spark, sf_dir):
    return coverage.pull_ranges(missing_sessions(spark, sf_dir))


def session_coverage(spark, sf_dir):
    return coverage.session_coverage(adapters.bars(spark, sf_dir), missing_sessions(spark, sf_dir))


def expected_sessions(spark, sf_dir):
    rows = adapters.bars(spark, sf_dir).groupBy("listing").agg(F.min("trading_date").alias("a"), F.max("trading_date").alias("b"))
    return rows.select("listing", F.size(coverage.expected_sessions(F.col("a"), F.col("b"))).cast("long").alias("sessions"))


def weekday_age(spark, sf_dir):
    rows = adapters.table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    return rows.select("o_orderkey", coverage.weekday_age(F.col("d"), F.lit("1998-08-02").cast("date")).alias("age"))


def series_coverage(spark, sf_dir):
    """Total against scoped counts and dates of each market."""
    b = adapters.bars(spark, sf_dir)
    inside = F.col("trading_date").between(F.lit("1995-01-01").cast("date"), F.lit("1995-12-31").cast("date"))
    return b.groupBy("market").agg(F.count("*").alias("bars"), F.count(F.when(inside, 1)).alias("scoped_bars"), F.count_distinct("listing").alias("listings"), F.count_distinct(F.when(inside, F.col("listing"))).alias("scoped_listings"), F.min(F.when(inside, F.col("trading_date"))).alias("scoped_first"), F.max(F.when(inside, F.col("trading_date"))).alias("scoped_last"))


def prior_bar_asof(spark, sf_dir):
    as_of = F.expr("date_add(date'1993-01-01', cast(c_custkey % 2000 as int))").alias("as_of")
    asked = adapters.table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("listing"), as_of)
    found = coverage.prior_bar(adapters.bars(spark, sf_dir), asked.select("listing", "as_of").distinct())
    return asked.join(found, ["listing", "as_of"])


def benchmark_status(spark, sf_dir):
    """Each weekday of 1995: reported, closed, not yet eligible or without data, with the change to the prior bar."""
    b = adapters.benchmark(spark, sf_dir)
    days = spark.range(1).select(F.explode(F.expr("sequence(date'1995-01-01', date'1995-12-31')")).alias("trading_date"))
    from pyspark.sql import Window

    known = b.withColumn("prior", F.lag("bench_close", 1).over(Window.partitionBy(F.lit(1)).orderBy("trading_date")))  # one series
    rows = days.join(known, "trading_date", "left")
    status = F.when(F.col("bench_close").isNotNull(), "REPORTED").when(F.weekday("trading_date") >= 5, "MARKET_CLOSED").when(F.col("trading_date") >= F.lit("1995-12-29").cast("date"), "NOT_YET_ELIGIBLE").otherwise("NO_DATA")
    return rows.select("trading_date", status.alias("status"), F.round(F.col("bench_close") - F.col("prior"), 4).alias("change"), F.round(100 * (F.col("bench_close") / F.nullif("prior", F.lit(0.0)) - 1), 6).alias("change_pct"))


QUERIES = {f.__name__: f for f in (
    universe, breadth, move_buckets, movers_desc, movers_asc, volume_leaders, low_volume, high_vol_low_move, unconfirmed_moves, high_conviction, price_anomalies,
    volume_anomalies, basket_snapshot, bars_listing, latest_date, listing_coverage, series_health, market_health, weekday_gaps, weekday_gap_sample, freshness, missing_sessions, pull_ranges,
    session_coverage, expected_sessions, weekday_age, series_coverage, prior_bar_asof, benchmark_status,
)}

_DAY = f"""WITH {BARS_SQL}, day AS (SELECT *, round(close / nullif(lag(close) OVER (PARTITION BY listing ORDER BY trading_date), 0) - 1, 8) AS ret,
  CASE WHEN listing % 5 = 4 THEN 'ETF' WHEN listing % 7 = 3 THEN '' ELSE 'EQUITY' END AS instrument FROM bars), eq AS (SELECT * FROM day WHERE instrument = 'EQUITY')"""
_COLS = "trading_date, market, ticker, close, volume, ret"


def _rank(where, order, by="trading_date, market", cols=_COLS, source="eq"):
    return f"{_DAY} SELECT {cols}, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY {order}) AS rank FROM {source} WHERE {where}) WHERE rank <= 12"


_COV = (
    f"WITH {BARS_SQL}, cov AS (SELECT l.*, count(trading_date) AS bars, min(trading_date) AS first_date, max(trading_date) AS last_date "
    f"FROM listings l LEFT JOIN raw_bars b ON b.listing = l.listing AND b.listing % 9 <> 4 AND trading_date BETWEEN DATE '1995-01-01' "
    f"AND DATE '1996-12-31' GROUP BY ALL)"
)
_GAPS = (
    f"WITH {BARS_SQL}, g AS (SELECT listing, trading_date, lag(trading_date) OVER (PARTITION BY listing ORDER BY trading_date) AS "
    f"before FROM bars), gaps AS (SELECT listing, CAST(unnest(generate_series(before + 1, trading_date - 1, INTERVAL 1 DAY)) AS DATE) "
    f"AS missing_date FROM g WHERE trading_date - before > 1), gap AS (SELECT * FROM gaps WHERE isodow(missing_date) <= 5)"
)
_MISSING = (
    f"WITH {BARS_SQL}, span AS (SELECT listing, min(trading_date) AS a, max(trading_date) AS b FROM bars GROUP BY 1), days AS (SELECT "
    f"listing, CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS trading_date FROM span), sessions AS (SELECT * FROM days "
    f"WHERE isodow(trading_date) <= 5), missing AS (SELECT * FROM sessions ANTI JOIN bars USING (listing, trading_date))"
)
_BUCKET = (
    "CASE WHEN ret <= -0.10 THEN 1 WHEN ret <= -0.05 THEN 2 WHEN ret <= -0.02 THEN 3 WHEN ret < 0 THEN 4 WHEN ret = 0 THEN 5 WHEN ret "
    "< 0.02 THEN 6 WHEN ret < 0.05 THEN 7 WHEN ret < 0.10 THEN 8 ELSE 9 END"
)

SQL = {
    "universe": (
        f"{_DAY} SELECT trading_date, count(*) AS total, count(*) FILTER (instrument = 'EQUITY') AS equities, count(*) FILTER (instrument = "
        f"'ETF') AS others, count(*) FILTER (instrument = '') AS unclassified FROM day GROUP BY 1"
    ),
    "breadth": f"""{_DAY}, every AS (SELECT trading_date, market FROM (SELECT DISTINCT trading_date FROM eq), (SELECT DISTINCT market FROM listings))
        SELECT e.trading_date, e.market, count(ticker) AS n, count(ret) AS comparable, count(*) FILTER (ret > 0) AS advancers, count(*) FILTER (ret
          < 0) AS decliners, count(*) FILTER (ret = 0) AS unchanged,
        count(*) FILTER (ticker IS NOT NULL AND ret IS NULL) AS missing, coalesce(sum(volume), 0) AS volume, round(avg(ret), 6) AS avg_return FROM
          every e LEFT JOIN eq USING (trading_date, market) GROUP BY 1, 2""",
    "move_buckets": f"{_DAY} SELECT {_BUCKET} AS bucket, " + ", ".join(f"count(*) FILTER (market = '{m}') AS \"{m}\"" for m in MARKETS) + " FROM eq WHERE ret IS NOT NULL GROUP BY 1",
    "movers_desc": _rank("ret > 0", "ret DESC, ticker"),
    "movers_asc": _rank("ret < 0", "ret, ticker"),
    "volume_leaders": _rank("volume IS NOT NULL", "volume DESC, ticker"),
    "low_volume": _rank("close > 0 AND volume > 0", "volume, ticker"),
    "high_vol_low_move": _rank("close > 0 AND abs(ret) <= 0.05", "volume DESC NULLS LAST, abs(ret), ticker"),
    "unconfirmed_moves": f"""{_DAY}, kept AS (SELECT * FROM eq WHERE close > 0 AND volume > 0), bar AS (SELECT trading_date, percentile_cont(0.2) WITHIN GROUP (ORDER BY volume) AS bar FROM kept GROUP BY 1)
        SELECT {_COLS}, CAST(rank AS INTEGER) AS rank FROM (SELECT kept.*, row_number() OVER (PARTITION BY trading_date ORDER BY abs(ret) DESC,
          volume, market, ticker) AS rank FROM kept JOIN bar USING (trading_date) WHERE abs(ret) >= 0.05 AND volume <= bar) WHERE rank <= 12""",
    "high_conviction": f"""{_DAY}, r AS (SELECT *, row_number() OVER (PARTITION BY trading_date, market, sign(ret) ORDER BY abs(ret) DESC, ticker) AS side_rank, row_number() OVER (PARTITION BY trading_date ORDER BY volume DESC NULLS LAST, ticker) AS volume_rank FROM eq),
        c AS (SELECT *, abs(ret) * ln(1 + volume) AS conviction FROM r WHERE ret <> 0 AND side_rank <= 12 AND volume_rank <= 48 AND volume IS NOT NULL)
        SELECT {_COLS}, CAST(rank AS INTEGER) AS rank, round(conviction, 6) AS conviction FROM (SELECT *, row_number() OVER (PARTITION BY
          trading_date ORDER BY conviction DESC, abs(ret) DESC, volume DESC, market, ticker) AS rank FROM c) WHERE rank <= 12""",
    "price_anomalies": f"""{_DAY}, a AS (SELECT *, (high - low) / nullif(low, 0) AS span FROM eq)
        SELECT trading_date, market, ticker, ret, CASE WHEN abs(ret) > 1 THEN 'extreme_return' WHEN ret > 0.30 THEN 'large_gain' WHEN ret < -0.30
          THEN 'large_loss' WHEN span > 0.50 THEN 'wide_range' END AS anomaly,
        round(greatest(coalesce(abs(ret), 0), coalesce(span, 0)), 8) AS severity FROM a WHERE anomaly IS NOT NULL ORDER BY severity DESC, ticker, trading_date LIMIT 40""",
    "volume_anomalies": f"""{_DAY}, v AS (SELECT *, CASE WHEN count(volume) OVER p >= 20 THEN avg(volume) OVER p END AS pa FROM eq WINDOW p AS (PARTITION BY listing ORDER BY trading_date ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING)),
        m AS (SELECT *, round(volume / nullif(pa, 0), 8) AS multiple FROM v)
        SELECT trading_date, market, ticker, volume, multiple FROM m WHERE multiple >= 1.5 AND (multiple > 10 OR volume >= 100) ORDER BY multiple DESC, ticker, trading_date LIMIT 40""",
    "basket_snapshot": f"""{_DAY}, w AS (SELECT unnest({BASKET!r}) AS ticker, CAST(unnest(range(1, {len(BASKET) + 1})) AS INTEGER) AS position),
        b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY CASE WHEN market = 'ASIA' THEN 0 ELSE 1 END, trading_date DESC) AS k FROM eq) WHERE k = 1)
        SELECT position, w.ticker, market IS NULL AS missing, trading_date, market, close, ret FROM w LEFT JOIN b USING (ticker)""",
    "bars_listing": f"WITH {BARS_SQL} SELECT * FROM bars",
    "latest_date": f"WITH {BARS_SQL} SELECT min(trading_date) AS first_date, max(trading_date) AS last_date, count(*) AS bars FROM bars",
    "listing_coverage": f"{_COV} SELECT * FROM cov",
    "series_health": f"{_COV} SELECT *, CASE WHEN bars = 0 THEN 'EMPTY' WHEN bars < 100 THEN 'THIN' ELSE 'OK' END AS status FROM cov",
    "market_health": f"""{_COV} SELECT market, count(*) FILTER (listing % 6 <> 0 AND bars > 0) AS active_with_bars, count(*) FILTER (listing % 6 <> 0 AND bars = 0) AS active_without_bars, count(*) FILTER (listing % 6 = 0 AND bars > 0) AS inactive_with_bars,
        count(*) FILTER (listing % 6 = 0 AND bars = 0) AS inactive_without_bars, CAST(sum(bars) AS BIGINT) AS bars, min(first_date) FILTER (listing
          % 6 <> 0) AS first_date, max(last_date) FILTER (listing % 6 <> 0) AS last_date FROM cov GROUP BY 1""",
    "weekday_gaps": f"{_GAPS} SELECT * FROM gap",
    "weekday_gap_sample": f"{_GAPS} SELECT *, (SELECT count(*) FROM gap) AS total FROM gap ORDER BY missing_date, listing LIMIT 100",
    "freshness": f"""WITH {BARS_SQL}, x AS (SELECT l.listing, max(trading_date) - l.listing % 4 * 3 AS last_date FROM listings l LEFT JOIN raw_bars b ON b.listing = l.listing AND b.listing % 9 <> 4 GROUP BY l.listing)
        SELECT listing, last_date, CASE WHEN last_date IS NULL THEN 'no_data' WHEN last_date > DATE '1998-08-02' THEN 'invalid_future_date' WHEN
          DATE '1998-08-02' - last_date <= 1 THEN 'current' WHEN DATE '1998-08-02' - last_date <= 5 THEN 'delayed' ELSE 'stale_candidate' END AS
          freshness FROM x""",
    "missing_sessions": f"{_MISSING} SELECT * FROM missing",
    "pull_ranges": f"""{_MISSING}, o AS (SELECT *, row_number() OVER (PARTITION BY listing ORDER BY trading_date) AS k, (SELECT count(*) FROM generate_series(DATE '1900-01-02', trading_date, INTERVAL 1 DAY) t(d) WHERE isodow(d) <= 5) AS n FROM missing),
        i AS (SELECT *, n - k AS island FROM o), p AS (SELECT *, (n - min(n) OVER (PARTITION BY listing, island)) // 5 AS part FROM i)
        SELECT listing, min(trading_date) AS range_start, max(trading_date) AS range_end, count(*) AS sessions FROM p GROUP BY listing, island, part""",
    "session_coverage": f"""{_MISSING}, s AS (SELECT listing, count(*) AS stored, count(*) FILTER (isodow(trading_date) <= 5) AS stored_sessions FROM bars GROUP BY 1), m AS (SELECT listing, count(*) AS missing FROM missing GROUP BY 1)
        SELECT listing, stored, stored_sessions, coalesce(missing, 0) AS missing, stored_sessions + coalesce(missing, 0) AS eligible, round(100 *
          stored_sessions / nullif(stored_sessions + coalesce(missing, 0), 0), 2) AS coverage_pct FROM s LEFT JOIN m USING (listing)""",
    "expected_sessions": f"{_MISSING} SELECT listing, count(*) AS sessions FROM sessions GROUP BY 1",
    "weekday_age": (
        "WITH c AS (SELECT d, count(*) FILTER (isodow(d) <= 5) OVER (ORDER BY d) AS n FROM (SELECT CAST(unnest(generate_series(DATE "
        "'1900-01-01', DATE '2030-01-01', INTERVAL 1 DAY)) AS DATE) AS d)) SELECT o_orderkey, (SELECT n FROM c WHERE d = DATE "
        "'1998-08-02') - n AS age FROM orders JOIN c ON d = CAST(o_orderdate AS DATE)"
    ),
    "series_coverage": f"""WITH {BARS_SQL}, b AS (SELECT *, trading_date BETWEEN DATE '1995-01-01' AND DATE '1995-12-31' AS inside FROM bars)
        SELECT market, count(*) AS bars, count(*) FILTER (inside) AS scoped_bars, count(DISTINCT listing) AS listings, count(DISTINCT listing)
          FILTER (inside) AS scoped_listings, min(trading_date) FILTER (inside) AS scoped_first, max(trading_date) FILTER (inside) AS scoped_last
          FROM b GROUP BY 1""",
    "prior_bar_asof": f"""WITH {BARS_SQL}, asked AS (SELECT c_custkey, c_nationkey AS listing, DATE '1993-01-01' + CAST(c_custkey % 2000 AS INTEGER) AS as_of FROM customer)
        SELECT a.*, b.trading_date AS prior_date, b.close AS prior_close FROM asked a ASOF LEFT JOIN bars b ON a.listing = b.listing AND b.trading_date < a.as_of""",
    "benchmark_status": f"""WITH {BARS_SQL}, k AS (SELECT *, lag(bench_close) OVER (ORDER BY trading_date) AS prior FROM bench), d AS (SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '1995-12-31', INTERVAL 1 DAY)) AS DATE) AS trading_date)
        SELECT trading_date, CASE WHEN bench_close IS NOT NULL THEN 'REPORTED' WHEN isodow(trading_date) > 5 THEN 'MARKET_CLOSED' WHEN trading_date
          >= DATE '1995-12-29' THEN 'NOT_YET_ELIGIBLE' ELSE 'NO_DATA' END AS status,
        round(bench_close - prior, 4) AS change, round(100 * (bench_close / nullif(prior, 0) - 1), 6) AS change_pct FROM d LEFT JOIN k USING (trading_date)""",
}
