"""Technical indicators that window aggregates express.

All take bars (listing, trading_date, open, high, low, close, volume) and add
columns over one window specification, so a plan has one exchange and one sort
by listing and date.  Lags and windows count observations.  A window that isn't
complete gives null.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import complete, distance, ratio

def series():
    """Each listing in date order."""
    return Window.partitionBy("listing").orderBy("trading_date")

RETURN_LAGS = (1, 2, 3, 5, 10, 20, 63, 126, 252)


def back(n: int):
    """The last ``n`` observations, the current one included."""
    return series().rowsBetween(-(n - 1), 0)


def returns(bars: DataFrame) -> DataFrame:
    lags = {f"__lag_{n}": F.lag("close", n).over(series()) for n in RETURN_LAGS}
    return bars.withColumns(lags).withColumns({f"return_{n}d_pct": distance(F.col("close"), F.col(f"__lag_{n}")) for n in RETURN_LAGS}).drop(*lags)


def bar_structure(bars: DataFrame) -> DataFrame:
    h, low, c, o = (F.col(x) for x in ("high", "low", "close", "open"))
    return bars.withColumns({
        "gap_1d_pct": distance(o, F.lag("close", 1).over(series())),
        "intraday_return_1d_pct": distance(c, o),
        "daily_range_pct": ratio(h - low, F.abs(c)),
        "close_location_1d": ratio(c - low, h - low),
        "dollar_volume": F.abs(c) * F.col("volume"),
    })


def streaks(bars: DataFrame) -> DataFrame:
    """Lengths of the runs of strictly rising and falling closes; an equal close ends both."""
    step = F.coalesce(F.signum(F.col("close") - F.lag("close", 1).over(series())), F.lit(0.0))
    marked = bars.withColumn("__step", step)
    marked = marked.withColumn("__new", F.when(F.col("__step") == F.lag("__step", 1).over(series()), 0).otherwise(1))
    marked = marked.withColumn("__run", F.sum("__new").over(series().rowsBetween(Window.unboundedPreceding, 0)))
    length = F.row_number().over(Window.partitionBy("listing", "__run").orderBy("trading_date"))
    return marked.withColumns({
        "consecutive_up_days": F.when(F.col("__step") > 0, length).otherwise(0),
        "consecutive_down_days": F.when(F.col("__step") < 0, length).otherwise(0),
    }).drop("__step", "__new", "__run")


def sma(bars: DataFrame, windows=(20, 50, 200)) -> DataFrame:
    return bars.withColumns({f"sma_{n}": complete(F.avg("close").over(back(n)), F.col("close"), back(n), n) for n in windows})


def moving_average_trends(bars: DataFrame) -> DataFrame:
    """From sma_* and ema_* columns."""
    c = F.col("close")
    out = {f"sma_{n}_change_20d_pct": distance(F.col(f"sma_{n}"), F.lag(f"sma_{n}", 20).over(series())) for n in (50, 200)}
    out |= {f"pct_sma_{n}": distance(c, F.col(f"sma_{n}")) for n in (20, 50, 200)}
    out |= {f"pct_sma_{a}_vs_{b}": distance(F.col(f"sma_{a}"), F.col(f"sma_{b}")) for a, b in ((20, 50), (20, 200), (50, 200))}
    return bars.withColumns(out)


def ranges(bars: DataFrame) -> DataFrame:
    out = {f"hh_{n}": complete(F.max("high").over(back(n)), F.col("high"), back(n), n) for n in (20, 50, 252)}
    out |= {f"ll_{n}": complete(F.min("low").over(back(n)), F.col("low"), back(n), n) for n in (20, 50)}
    bars = bars.withColumns(out)
    return bars.withColumns({f"pct_{x}": distance(F.col("close"), F.col(x)) for x in out})


def volatility(bars: DataFrame) -> DataFrame:
    """From return_1d_pct: sample deviation, current return included, not annualised."""
    r = F.col("return_1d_pct")
    return bars.withColumns({f"return_volatility_{n}d_pct": complete(F.stddev_samp(r).over(back(n)), r, back(n), n) for n in (20, 60)})


def zscores(bars: DataFrame) -> DataFrame:
    """From return_1d_pct and return_3d_pct: against the 20 returns before the current one."""
    prior, named, out = series().rowsBetween(-20, -1), {}, {}
    for k in (1, 3):
        r = F.col(f"return_{k}d_pct")
        named |= {f"__n_{k}": F.count(r).over(prior), f"__mean_{k}": F.avg(r).over(prior), f"__sd_{k}": F.stddev_samp(r).over(prior)}
        out[f"return_{k}d_zscore_20d"] = F.when(F.col(f"__n_{k}") == 20, ratio(r - F.col(f"__mean_{k}"), F.col(f"__sd_{k}")))
    return bars.withColumns(named).withColumns(out).drop(*named)


def bollinger(bars: DataFrame) -> DataFrame:
    """From sma_20: population deviation, two deviations to each side."""
    sd = complete(F.stddev_pop("close").over(back(20)), F.col("close"), back(20), 20)
    bars = bars.withColumn("price_stddev_20", sd)
    width = 4 * F.col("price_stddev_20")
    return bars.withColumns({
        "bollinger_percent_b_20_2": ratio(F.col("close") - (F.col("sma_20") - 2 * F.col("price_stddev_20")), width),
        "bollinger_bandwidth_20_2": ratio(width, F.abs(F.col("sma_20"))),
    })


def volumes(bars: DataFrame) -> DataFrame:
    """From dollar_volume; a null volume leaves its windows null."""
    out = {f"volume_avg_{n}": complete(F.avg("volume").over(back(n)), F.col("volume"), back(n), n) for n in (20, 60)}
    out["dollar_volume_avg_20"] = complete(F.avg("dollar_volume").over(back(20)), F.col("dollar_volume"), back(20), 20)
    bars = bars.withColumns(out)
    return bars.withColumn("volume_ratio_20", ratio(F.col("volume"), F.col("volume_avg_20")))


def windowed(bars: DataFrame) -> DataFrame:
    """Every indicator of this module."""
    for step in (returns, bar_structure, sma, moving_average_trends, ranges, volatility, zscores, bollinger, volumes, streaks):
        bars = step(bars)
    return bars
