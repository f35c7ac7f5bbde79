"""Registered feature queries and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import equivalent, rounded
from ..operators import indicators as ti
from ..operators import recurrences, relative
from ..operators.series import by_series
from ..sources import adapters
from ..sources.adapters import BARS_SQL

KEY = ["listing", "trading_date"]
PRICE_DIGITS, SHARE_DIGITS, MEAN_DIGITS = 4, 8, 6

# Names of the 76 features, by the query that gives them, and the digits that results are compared to.
RETURNS = [f"return_{n}d_pct" for n in ti.RETURN_LAGS]
DIGITS: dict[str, dict[str, int]] = {
    "ti_returns": dict.fromkeys(RETURNS, 8),
    "ti_bar_structure": dict.fromkeys(["gap_1d_pct", "intraday_return_1d_pct", "daily_range_pct", "close_location_1d"], 8) | {"dollar_volume": 4},
    "ti_sma": dict.fromkeys(["sma_20", "sma_50", "sma_200"], 6),
    "ti_ma_trends": dict.fromkeys(["sma_50_change_20d_pct", "sma_200_change_20d_pct", "pct_sma_20", "pct_sma_50", "pct_sma_200", "pct_sma_20_vs_50", "pct_sma_20_vs_200", "pct_sma_50_vs_200"], 8),
    "ti_ranges": dict.fromkeys(["hh_20", "hh_50", "hh_252", "ll_20", "ll_50"], 4) | dict.fromkeys(["pct_hh_20", "pct_hh_50", "pct_hh_252", "pct_ll_20", "pct_ll_50"], 8),
    "ti_volatility": dict.fromkeys(["return_volatility_20d_pct", "return_volatility_60d_pct"], 7),
    "ti_zscore": dict.fromkeys(["return_1d_zscore_20d", "return_3d_zscore_20d"], 7),
    "ti_bollinger": {"price_stddev_20": 4, "bollinger_percent_b_20_2": 7, "bollinger_bandwidth_20_2": 7},
    "ti_volume": {"volume_avg_20": 6, "volume_avg_60": 6, "dollar_volume_avg_20": 4, "volume_ratio_20": 8},
    "ti_streaks": {"consecutive_up_days": 0, "consecutive_down_days": 0},
    "ti_ema": dict.fromkeys([f"ema_{n}" for n in recurrences.EMA_WINDOWS], 4) | {"pct_ema_20": 8, "pct_ema_50": 8},
    "ti_rsi": {"rsi_14": 6},
    "ti_atr": {"atr_14": 4, "atr_pct_14": 8},
    "ti_dmi": dict.fromkeys(["plus_di_14", "minus_di_14", "adx_14"], 6),
    "ti_macd": dict.fromkeys(["macd_12_26", "macd_signal_12_26_9", "macd_histogram_12_26_9"], 4) | dict.fromkeys(["macd_12_26_pct", "macd_histogram_12_26_9_pct"], 8),
    "bm_ratio": dict.fromkeys(["rel_spx", "pct_rel_spx_20", "pct_rel_spx_50"], 7),
    "bm_relative_return": {f"relative_return_spx_{n}d_pct": 6 for n in (20, 63, 126, 252)},
    "bm_beta": {"spx_beta_60d": 7, "spx_beta_252d": 7},
    "bm_correlation": {"spx_correlation_60d": 7, "spx_correlation_252d": 7},
}
FEATURES = [c for own in DIGITS.values() for c in own]


def features(spark, sf_dir) -> DataFrame:
    """The wide row: every feature of every bar.  The series functions get narrow rows, and the windows follow them."""

    def both(x):
        return relative.relative_columns(x("close"), x("bench_close")) | recurrences.recurrent_columns(x("high"), x("low"), x("close"))

    rows = relative.with_benchmark(adapters.bars(spark, sf_dir), adapters.benchmark(spark, sf_dir))
    return ti.windowed(by_series(rows, both, [*relative.COLUMNS, *recurrences.COLUMNS]))


STEPS = {
    "ti_returns": [ti.returns],
    "ti_bar_structure": [ti.bar_structure],
    "ti_sma": [ti.sma],
    "ti_ma_trends": [ti.sma, ti.moving_average_trends],
    "ti_ranges": [ti.ranges],
    "ti_volatility": [ti.returns, ti.volatility],
    "ti_zscore": [ti.returns, ti.zscores],
    "ti_bollinger": [ti.sma, ti.bollinger],
    "ti_volume": [ti.bar_structure, ti.volumes],
    "ti_streaks": [ti.streaks],
    **dict.fromkeys(["ti_ema", "ti_rsi", "ti_atr", "ti_dmi", "ti_macd"], [recurrences.recurrent]),
}


def _step_query(name):
    def query(spark, sf_dir):
        rows = adapters.bars(spark, sf_dir)
        for step in STEPS[name]:
            rows = step(rows)
        return rows.select(*KEY, *rounded(DIGITS[name]))

    return query


def _relative_query(name):
    def query(spark, sf_dir):
        rows = relative.relative_features(adapters.bars(spark, sf_dir), adapters.benchmark(spark, sf_dir))
        return rows.select(*KEY, *rounded(DIGITS[name]))

    return query


def ti_features(spark, sf_dir):
    return features(spark, sf_dir).select(*KEY, *rounded({c: d for own in DIGITS.values() for c, d in own.items()}))


def bm_features(spark, sf_dir):
    """Benchmark features by subject: unsupported markets have no benchmark and no values; unshared dates keep its id."""
    rows = relative.relative_features(adapters.bars(spark, sf_dir), adapters.benchmark(spark, sf_dir))
    supported = F.col("market") != "AFRICA"
    out = [F.round(F.when(supported, F.col(c)), 6).alias(c) for c in relative.COLUMNS]
    return rows.select(*KEY, F.when(supported, F.lit("ALL_ORDERS")).alias("benchmark_id"), *out)


def bm_alignment(spark, sf_dir):
    rows = relative.aligned(adapters.bars(spark, sf_dir), adapters.benchmark(spark, sf_dir))
    return rows.where("shared").select(*KEY, "aligned_count", "valid_count", F.round("own_return", 8).alias("own_return"), F.round("bench_return", 8).alias("bench_return"))


def aligned_closes(spark, sf_dir):
    return relative.aligned(adapters.bars(spark, sf_dir), adapters.benchmark(spark, sf_dir)).where("shared").select(*KEY, "close", "bench_close")


def ti_validate(spark, sf_dir):
    """Rows of the feature table that break a bound or disagree with a recomputation, by rule."""
    rows = ti.streaks(ti.sma(ti.ranges(recurrences.recurrent(adapters.bars(spark, sf_dir)))))
    rules = {
        "rsi_out_of_bounds": ~F.col("rsi_14").between(0, 100),
        "adx_out_of_bounds": ~F.col("adx_14").between(0, 100),
        "high_below_window": F.col("hh_20") < F.col("high"),
        "low_above_window": F.col("ll_20") > F.col("low"),
        "both_streaks": (F.col("consecutive_up_days") > 0) & (F.col("consecutive_down_days") > 0),
        "ema_copy": ~equivalent(F.col("pct_ema_20"), F.col("close") / F.nullif(F.col("ema_20"), F.lit(0.0)) - 1),
    }
    found = rows.agg(*[F.count(F.when(F.coalesce(rule, F.lit(False)), 1)).alias(name) for name, rule in rules.items()])
    return found.select(F.explode(F.create_map(*[x for name in rules for x in (F.lit(name), F.col(name))])).alias("rule", "violations"))


# ---- SQL ----

_W = "PARTITION BY listing ORDER BY trading_date"


def _d(a, b):
    return f"({a}) / nullif({b}, 0) - 1"


def _over(expr, n):
    return f"{expr} OVER (w ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def _full(expr, counted, n):
    return f"CASE WHEN {_over(f'count({counted})', n)} = {n} THEN {_over(expr, n)} END"


def _select(name, inner, columns=None):
    cols = ", ".join(f"{c}" if d == 0 else f"round({c}, {d}) AS {c}" for c, d in (columns or DIGITS[name]).items())
    return f"WITH {BARS_SQL}, f AS ({inner}) SELECT listing, trading_date, {cols} FROM f"


_RETURN_SQL = ", ".join(f"{_d('close', f'lag(close, {n}) OVER w')} AS return_{n}d_pct" for n in ti.RETURN_LAGS)
_RETURNS = f"SELECT *, {_RETURN_SQL} FROM bars WINDOW w AS ({_W})"
_SMA = "SELECT *, " + ", ".join(f"{_full('avg(close)', 'close', n)} AS sma_{n}" for n in (20, 50, 200)) + f" FROM bars WINDOW w AS ({_W})"
_WIDTH = "4 * price_stddev_20"
_NUMBERED = f"numbered AS (SELECT *, row_number() OVER ({_W}) - 1 AS i, lag(close) OVER ({_W}) AS c1, lag(high) OVER ({_W}) AS h1, lag(low) OVER ({_W}) AS l1 FROM bars)"


def _recursive(ctes, first, start, seed, step, columns):
    """A recurrence along the observation number: ``seed`` at ``start``, ``step`` after it."""
    names = ", ".join(columns)
    return f"""WITH RECURSIVE {BARS_SQL}, {_NUMBERED}, {ctes}
    r AS (SELECT listing, trading_date, i, close, {seed} FROM {first} WHERE i = {start}
          UNION ALL SELECT x.listing, x.trading_date, x.i, x.close, {step} FROM r JOIN {first} x ON x.listing = r.listing AND x.i = r.i + 1),
    f AS (SELECT b.listing, b.trading_date, b.close AS bar_close, {names} FROM bars b LEFT JOIN r USING (listing, trading_date))"""


def _mean(x, n):
    return f"avg({x}) OVER ({_W} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def _ema_sql():
    parts, ctes = [], []
    for n in recurrences.EMA_WINDOWS:
        ctes.append(f"""s{n} AS (SELECT *, {_mean('close', n)} AS seed FROM numbered),
        e{n} AS (SELECT listing, trading_date, i, seed AS ema_{n} FROM s{n} WHERE i = {n - 1}
          UNION ALL SELECT x.listing, x.trading_date, x.i, r.ema_{n} + (x.close - r.ema_{n}) * (2.0::DOUBLE / {n + 1}) FROM e{n} r JOIN numbered x ON x.listing = r.listing AND x.i = r.i + 1)""")
        parts.append(f"LEFT JOIN (SELECT listing, trading_date, ema_{n} FROM e{n}) USING (listing, trading_date)")
    cols = ", ".join(f"round(ema_{n}, 4) AS ema_{n}" for n in recurrences.EMA_WINDOWS)
    return (
        f"WITH RECURSIVE {BARS_SQL}, {_NUMBERED}, {', '.join(ctes)} SELECT listing, trading_date, {cols}, round({_d('close', 'ema_20')}, 8) "
        f"AS pct_ema_20, round({_d('close', 'ema_50')}, 8) AS pct_ema_50 FROM bars {' '.join(parts)}"
    )


_TR = "greatest(high - low, abs(high - c1), abs(low - c1))"
_RSI = (
    _recursive(
        f"""m AS (SELECT *, greatest(close - c1, 0) AS up, greatest(c1 - close, 0) AS down FROM numbered),
        q AS (SELECT *, {_mean('up', 14)} AS up_seed, {_mean('down', 14)} AS down_seed FROM m),""",
        "q", 14, "up_seed AS g, down_seed AS l", "(r.g * 13 + x.up) / 14, (r.l * 13 + x.down) / 14", ["g", "l"],
    )
    + " SELECT listing, trading_date, round(CASE WHEN g + l = 0 THEN 0 ELSE 100 * (g / (g + l)) END, 6) AS rsi_14 FROM f"
)
_ATR = (
    _recursive(f"m AS (SELECT *, {_TR} AS tr FROM numbered), q AS (SELECT *, {_mean('tr', 14)} AS seed FROM m),", "q", 14, "seed AS atr", "(r.atr * 13 + x.tr) / 14", ["atr"])
    + " SELECT listing, trading_date, round(atr, 4) AS atr_14, round(atr / nullif(abs(bar_close), 0), 8) AS atr_pct_14 FROM f"
)
_DX = "CASE WHEN {t} = 0 OR {p} + {m} = 0 THEN NULL ELSE 100 * abs({m} - {p}) / ({p} + {m}) END"
_P, _M, _T = "(r.p - r.p / 14 + x.up)", "(r.m - r.m / 14 + x.down)", "(r.t - r.t / 14 + x.tr)"
_NEW_DX = _DX.format(t=_T, p=f"(100 * {_P} / {_T})", m=f"(100 * {_M} / {_T})")
_DMI = (
    _recursive(
        f"""m AS (SELECT *, {_TR} AS tr, CASE WHEN high - h1 > l1 - low AND high - h1 > 0 THEN high - h1 ELSE 0 END AS up,
               CASE WHEN l1 - low > high - h1 AND l1 - low > 0 THEN l1 - low ELSE 0 END AS down FROM numbered),
        q AS (SELECT *, sum(up) OVER z AS p0, sum(down) OVER z AS m0, sum(tr) OVER z AS t0 FROM m WINDOW z AS ({_W} ROWS BETWEEN 12 PRECEDING AND CURRENT ROW)),""",
        "q", 13, "p0 AS p, m0 AS m, t0 AS t, CAST(0 AS DOUBLE) AS s",
        f"""{_P}, {_M}, {_T},
        CASE WHEN x.i < 27 THEN r.s + coalesce({_NEW_DX}, 0) WHEN x.i = 27 THEN (r.s + coalesce({_NEW_DX}, 0)) / 14 ELSE coalesce((r.s * 13 + {_NEW_DX}) / 14, r.s) END""",
        ["i", "p", "m", "t", "s"],
    )
    + """ SELECT listing, trading_date, CASE WHEN i >= 14 THEN round(CASE WHEN t = 0 THEN 0 ELSE 100 * p / t END, 6) END AS plus_di_14,
    CASE WHEN i >= 14 THEN round(CASE WHEN t = 0 THEN 0 ELSE 100 * m / t END, 6) END AS minus_di_14, CASE WHEN i >= 27 THEN round(s, 6) END AS adx_14 FROM f"""
)
_MACD = (
    _recursive(
        f"q AS (SELECT *, {_mean('close', 12)} AS fast0, {_mean('close', 26)} AS slow0 FROM numbered),",
        "q", 25, "fast0 AS fast, slow0 AS slow, fast0 - slow0 AS total",
        """r.fast + (x.close - r.fast) * (2.0::DOUBLE / 13), r.slow + (x.close - r.slow) * (2.0::DOUBLE / 27),
        CASE WHEN x.i < 33 THEN r.total + (r.fast + (x.close - r.fast) * (2.0::DOUBLE / 13)) - (r.slow + (x.close - r.slow) * (2.0::DOUBLE / 27))
             WHEN x.i = 33 THEN (r.total + (r.fast + (x.close - r.fast) * (2.0::DOUBLE / 13)) - (r.slow + (x.close - r.slow) * (2.0::DOUBLE / 27))) / 9
             ELSE r.total + ((r.fast + (x.close - r.fast) * (2.0::DOUBLE / 13)) - (r.slow + (x.close - r.slow) * (2.0::DOUBLE / 27)) - r.total) * 0.2::DOUBLE END""",
        ["i", "fast", "slow", "total"],
    )
    + """, g AS (SELECT *, CASE WHEN i >= 33 THEN fast - slow END AS line, CASE WHEN i >= 33 THEN total END AS signal FROM f)
    SELECT listing, trading_date, round(line, 4) AS macd_12_26, round(signal, 4) AS macd_signal_12_26_9, round(line - signal, 4) AS macd_histogram_12_26_9,
    round(line / nullif(abs(slow), 0), 8) AS macd_12_26_pct, round((line - signal) / nullif(abs(bar_close), 0), 8) AS macd_histogram_12_26_9_pct FROM g"""
)

_OWN = "PARTITION BY listing ORDER BY trading_date"
_ALIGNED = f"""a0 AS (SELECT b.*, bench_close FROM bars b JOIN bench USING (trading_date)),
a1 AS (SELECT *, row_number() OVER ({_OWN}) AS aligned_count, {_d('close', f'lag(close) OVER ({_OWN})')} AS own_return,
  {_d('bench_close', f'lag(bench_close) OVER ({_OWN})')} AS bench_return, close / nullif(bench_close, 0) AS rel_spx FROM a0),
a2 AS (SELECT *, aligned_count - max(CASE WHEN own_return IS NULL OR bench_return IS NULL THEN aligned_count END) OVER ({_OWN}) AS valid_count,
       CASE WHEN own_return IS NOT NULL AND bench_return IS NOT NULL THEN 1 END AS paired FROM a1)"""


def _back(expr, n):
    return f"{expr} OVER ({_OWN} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def _when_full(expr, counted, n):
    return f"CASE WHEN {_back(f'count({counted})', n)} = {n} THEN {expr} END"


_BM_SQL = {"rel_spx": "rel_spx"}
_BM_SQL |= {f"pct_rel_spx_{n}": _when_full(_d("rel_spx", _back("avg(rel_spx)", n)), "rel_spx", n) for n in (20, 50)}
_BM_SQL |= {f"relative_return_spx_{n}d_pct": _when_full(_d(_back("product(1 + own_return)", n), _back("product(1 + bench_return)", n)), "paired", n) for n in (20, 63, 126, 252)}
_BM_SQL |= {f"spx_beta_{n}d": _when_full(f"{_back('covar_samp(own_return, bench_return)', n)} / nullif({_back('var_samp(bench_return)', n)}, 0)", "paired", n) for n in (60, 252)}
_BM_SQL |= {f"spx_correlation_{n}d": _when_full(_back("corr(own_return, bench_return)", n), "paired", n) for n in (60, 252)}


def _bm(columns: dict[str, int], extra="", suffix=""):
    made = ", ".join(f"{_BM_SQL[c]} AS {c}" for c in columns)
    out = ", ".join(f"round({f'CASE WHEN {suffix} THEN {c} END' if suffix else c}, {d}) AS {c}" for c, d in columns.items())
    return f"WITH {BARS_SQL}, {_ALIGNED}, v AS (SELECT listing, trading_date, {made} FROM a2) SELECT b.listing, b.trading_date, {extra}{out} FROM bars b LEFT JOIN v USING (listing, trading_date)"


SQL = {
    "ti_returns": _select("ti_returns", _RETURNS),
    "ti_bar_structure": _select("ti_bar_structure", f"SELECT *, {_d('open', 'lag(close) OVER w')} AS gap_1d_pct, {_d('close', 'open')} AS intraday_return_1d_pct, (high - low) / nullif(abs(close), 0) AS daily_range_pct, (close - low) / nullif(high - low, 0) AS close_location_1d, abs(close) * volume AS dollar_volume FROM bars WINDOW w AS ({_W})"),
    "ti_sma": _select("ti_sma", _SMA),
    "ti_ma_trends": _select(
        "ti_ma_trends",
        "SELECT *, " + ", ".join([*(f"{_d(f'sma_{n}', f'lag(sma_{n}, 20) OVER w')} AS sma_{n}_change_20d_pct" for n in (50, 200)), *(f"{_d('close', f'sma_{n}')} AS pct_sma_{n}" for n in (20, 50, 200)), *(f"{_d(f'sma_{a}', f'sma_{b}')} AS pct_sma_{a}_vs_{b}" for a, b in ((20, 50), (20, 200), (50, 200)))]) + f" FROM ({_SMA}) WINDOW w AS ({_W})",
    ),
    "ti_ranges": _select(
        "ti_ranges",
        "SELECT *, " + ", ".join(f"{_d('close', x)} AS pct_{x}" for x in ("hh_20", "hh_50", "hh_252", "ll_20", "ll_50")) + " FROM (SELECT *, "
        + ", ".join([*(f"{_full('max(high)', 'high', n)} AS hh_{n}" for n in (20, 50, 252)), *(f"{_full('min(low)', 'low', n)} AS ll_{n}" for n in (20, 50))]) + f" FROM bars WINDOW w AS ({_W}))",
    ),
    "ti_volatility": _select("ti_volatility", "SELECT *, " + ", ".join(f"{_full('stddev_samp(return_1d_pct)', 'return_1d_pct', n)} AS return_volatility_{n}d_pct" for n in (20, 60)) + f" FROM ({_RETURNS}) WINDOW w AS ({_W})"),
    "ti_zscore": _select(
        "ti_zscore",
        "SELECT *, " + ", ".join(f"CASE WHEN count(return_{k}d_pct) OVER p = 20 THEN (return_{k}d_pct - avg(return_{k}d_pct) OVER p) / nullif(stddev_samp(return_{k}d_pct) OVER p, 0) END AS return_{k}d_zscore_20d" for k in (1, 3)) + f" FROM ({_RETURNS}) WINDOW p AS ({_W} ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING)",
    ),
    "ti_bollinger": _select(
        "ti_bollinger",
        (
            f"SELECT *, (close - (sma_20 - 2 * price_stddev_20)) / nullif({_WIDTH}, 0) AS bollinger_percent_b_20_2, {_WIDTH} / "
            f"nullif(abs(sma_20), 0) AS bollinger_bandwidth_20_2 FROM (SELECT *, {_full('stddev_pop(close)', 'close', 20)} AS price_stddev_20 "
            f"FROM ({_SMA}) WINDOW w AS ({_W}))"
        ),
    ),
    "ti_volume": _select(
        "ti_volume",
        (
            f"SELECT *, volume / nullif(volume_avg_20, 0) AS volume_ratio_20 FROM (SELECT *, {_full('avg(volume)', 'volume', 20)} AS "
            f"volume_avg_20, {_full('avg(volume)', 'volume', 60)} AS volume_avg_60, {_full('avg(dv)', 'dv', 20)} AS dollar_volume_avg_20 FROM "
            f"(SELECT *, abs(close) * volume AS dv FROM bars) WINDOW w AS ({_W}))"
        ),
    ),
    "ti_streaks": _select(
        "ti_streaks",
        f"""SELECT *, CASE WHEN step > 0 THEN CAST(n AS INTEGER) ELSE 0 END AS consecutive_up_days, CASE WHEN step < 0 THEN CAST(n AS INTEGER) ELSE 0 END AS consecutive_down_days
        FROM (SELECT *, row_number() OVER (PARTITION BY listing, run ORDER BY trading_date) AS n
        FROM (SELECT *, sum(fresh) OVER ({_W}) AS run FROM (SELECT *, CASE WHEN step = lag(step) OVER ({_W}) THEN 0 ELSE 1 END AS fresh
        FROM (SELECT *, coalesce(sign(close - lag(close) OVER ({_W})), 0) AS step FROM bars))))""",
    ),
    "ti_ema": _ema_sql(),
    "ti_rsi": _RSI,
    "ti_atr": _ATR,
    "ti_dmi": _DMI,
    "ti_macd": _MACD,
    "bm_ratio": _bm(DIGITS["bm_ratio"]),
    "bm_relative_return": _bm(DIGITS["bm_relative_return"]),
    "bm_beta": _bm(DIGITS["bm_beta"]),
    "bm_correlation": _bm(DIGITS["bm_correlation"]),
    "bm_features": _bm(dict.fromkeys(relative.COLUMNS, 6), "CASE WHEN market <> 'AFRICA' THEN 'ALL_ORDERS' END AS benchmark_id, ", "market <> 'AFRICA'"),
    "bm_alignment": (
        f"WITH {BARS_SQL}, {_ALIGNED} SELECT listing, trading_date, CAST(aligned_count AS INTEGER) AS aligned_count, CAST(valid_count AS "
        f"INTEGER) AS valid_count, round(own_return, 8) AS own_return, round(bench_return, 8) AS bench_return FROM a2"
    ),
    "aligned_closes": f"WITH {BARS_SQL} SELECT listing, trading_date, close, bench_close FROM bars JOIN bench USING (trading_date)",
    "ti_validate": "SELECT unnest(['rsi_out_of_bounds', 'adx_out_of_bounds', 'high_below_window', 'low_above_window', 'both_streaks', 'ema_copy']) AS rule, CAST(0 AS BIGINT) AS violations",
}
# the wide row is the join of its families, each by its own SQL
SQL["ti_features"] = "SELECT * FROM " + " JOIN ".join(f"({SQL[name]})" + (" USING (listing, trading_date)" if i else "") for i, name in enumerate(DIGITS))

QUERIES = {name: _step_query(name) for name in STEPS}
QUERIES |= {name: _relative_query(name) for name in ("bm_ratio", "bm_relative_return", "bm_beta", "bm_correlation")}
QUERIES |= {f.__name__: f for f in (bm_features, bm_alignment, aligned_closes, ti_validate, ti_features)}
