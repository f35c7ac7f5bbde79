"""Indicators against scalar definitions, and edge cases of nulls, zeros and warm-ups."""

import datetime as dt
import math
import random

import numpy as np
import pytest

from barloom.operators import indicators as ti
from barloom.operators import merge, recurrences, relative

BARS = "listing int, trading_date date, open double, high double, low double, close double, volume double"
START = dt.date(2020, 1, 1)


def series(n, seed=1, listing=1, flat=None):
    rng, out, c = random.Random(seed), [], 100.0
    for i in range(n):
        o, c = c, flat if flat is not None else c + rng.uniform(-3, 3)
        out.append((listing, START + dt.timedelta(i), o, max(o, c) + rng.random(), min(o, c) - rng.random(), c, None if i == 30 else float(rng.randint(1, 99))))
    return out


@pytest.fixture(scope="module")
def wide(spark):
    bars = spark.createDataFrame(series(300) + series(5, 2, 2) + series(40, 3, 3, flat=0.0), BARS)
    bench = spark.createDataFrame([(r[1], r[5]) for i, r in enumerate(series(300, 9)) if i % 10 != 4], "trading_date date, bench_close double")
    rows = recurrences.recurrent(relative.relative_features(ti.windowed(bars), bench)).collect()
    return {k: sorted((r for r in rows if r.listing == k), key=lambda r: r.trading_date) for k in (1, 2, 3)}


def close(a, b):
    return (a is None and b is None) or (a is not None and b is not None and math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9))


def test_warm_ups(wide):
    first = {"return_1d_pct": 1, "return_252d_pct": 252, "sma_20": 19, "sma_200_change_20d_pct": 219, "hh_252": 251, "return_volatility_20d_pct": 20, "return_1d_zscore_20d": 21, "return_3d_zscore_20d": 23, "ema_26": 25, "rsi_14": 14, "atr_14": 14, "plus_di_14": 14, "adx_14": 27, "macd_12_26": 33, "price_stddev_20": 19}
    for name, i in first.items():
        values = [r[name] for r in wide[1]]
        assert values[i] is not None and all(v is None for v in values[:i]), name
        assert all(r[name] is None for r in wide[2] if i >= 5)


def test_null_volume_empties_its_windows(wide):
    values = [r["volume_avg_20"] for r in wide[1]]
    assert values[29] is not None and all(v is None for v in values[30:50]) and values[50] is not None
    assert wide[1][30]["dollar_volume"] is None


def test_zero_denominators_are_null(wide):
    rows = wide[3]
    assert all(r["return_1d_pct"] is None for r in rows[2:]) and all(r["pct_sma_20"] is None for r in rows[25:])
    assert rows[30]["rsi_14"] is not None and rows[30]["consecutive_up_days"] == 0


def test_recurrences_equal_scalar_definitions(wide):
    c = [r["close"] for r in wide[1]]
    e = sum(c[:20]) / 20
    for i in range(20, 300):
        e += (c[i] - e) * 2 / 21
        assert close(wide[1][i]["ema_20"], e)
    up = sum(max(c[i] - c[i - 1], 0) for i in range(1, 15)) / 14
    down = sum(max(c[i - 1] - c[i], 0) for i in range(1, 15)) / 14
    for i in range(15, 300):
        up, down = (up * 13 + max(c[i] - c[i - 1], 0)) / 14, (down * 13 + max(c[i - 1] - c[i], 0)) / 14
        assert close(wide[1][i]["rsi_14"], 100 * up / (up + down))
    fast, slow = sum(c[14:26]) / 12, sum(c[:26]) / 26
    lines = [fast - slow]
    for i in range(26, 300):
        fast, slow = fast + (c[i] - fast) * 2 / 13, slow + (c[i] - slow) * 2 / 27
        lines.append(fast - slow)
    signal = sum(lines[:9]) / 9
    for i in range(34, 300):
        signal += (lines[i - 25] - signal) * 0.2
        assert close(wide[1][i]["macd_signal_12_26_9"], signal) and close(wide[1][i]["macd_12_26"], lines[i - 25])


def test_no_look_ahead(spark, wide):
    rows = series(300)[:150]
    again = sorted(recurrences.recurrent(ti.windowed(spark.createDataFrame(rows, BARS))).collect(), key=lambda r: r.trading_date)
    for a, b in zip(again, wide[1]):
        assert all(close(a[c], b[c]) for c in ("sma_50", "ema_50", "adx_14", "return_1d_zscore_20d", "hh_20"))


def test_benchmark_windows_count_shared_dates(wide):
    rows = wide[1]
    own = [r for r in rows if r["shared"]]
    assert len(own) == 270 and all(r["rel_spx"] is None and r["spx_beta_60d"] is None for r in rows if not r["shared"])
    i = 100
    s = np.array([own[k]["close"] / own[k - 1]["close"] - 1 for k in range(i - 59, i + 1)])
    b = np.array([own[k]["bench_close"] / own[k - 1]["bench_close"] - 1 for k in range(i - 59, i + 1)])
    assert math.isclose(own[i]["spx_beta_60d"], np.cov(s, b)[0, 1] / np.var(b, ddof=1), rel_tol=1e-9)
    assert math.isclose(own[i]["spx_correlation_60d"], np.corrcoef(s, b)[0, 1], rel_tol=1e-9)
    assert own[59]["spx_beta_60d"] is None and own[60]["spx_beta_60d"] is not None


def test_directional_holds_without_movement():
    flat = np.full(60, 5.0)
    plus, minus, adx = recurrences.directional(flat, flat, flat)
    assert np.isnan(plus[:14]).all() and (plus[14:] == 0).all() and (adx[27:] == 0).all() and (minus[14:] == 0).all()


def test_upsert_recomputes_the_successor(spark):
    stored = spark.createDataFrame(series(4), BARS)
    fixed = [list(r) for r in series(4)[1:2]]
    fixed[0][5] = 200.0
    out = {r.trading_date: r for r in merge.upsert_bars(spark.createDataFrame(fixed, BARS), stored).collect()}
    days = sorted(out)
    assert float(out[days[2]]["change"]) == pytest.approx(out[days[2]]["close"] - 200.0, abs=1e-8)
    kinds = [r.kind for r in merge.compare_bars(spark.createDataFrame(fixed, BARS), stored).collect()]
    assert kinds == ["CORRECTED"]


def test_tolerant_merge_classes(spark):
    a = spark.createDataFrame([(1, 1.0), (2, 1.0 + 1e-13), (3, 2.0), (4, None)], "k int, x double")
    b = spark.createDataFrame([(2, 1.0), (3, 1.0), (4, None), (5, 1.0)], "k int, x double")
    assert {r.k: r.kind for r in merge.merge_features(a, b, ["k"], ["x"]).collect()} == {1: "INSERT", 2: "UNCHANGED", 3: "UPDATE", 4: "UNCHANGED", 5: "KEEP"}
