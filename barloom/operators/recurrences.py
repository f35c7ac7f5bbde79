"""Indicators whose value depends on their own previous value.

One pass over each listing's series: the seeds, warm-ups and smoothing constants
are those of the standard definitions, and the whole series is always read from
its first bar.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from .series import by_series, over

EMA_WINDOWS = (12, 20, 26, 50)
COLUMNS = [
    *(f"ema_{n}" for n in EMA_WINDOWS), "rsi_14", "atr_14", "atr_pct_14", "plus_di_14", "minus_di_14", "adx_14",
    "macd_12_26", "macd_signal_12_26_9", "macd_histogram_12_26_9", "macd_12_26_pct", "macd_histogram_12_26_9_pct", "pct_ema_20", "pct_ema_50",
]


def smoothed(seed: float, x: np.ndarray, step: float) -> np.ndarray:
    """``seed`` and then values that move by ``step`` of the way to each of ``x``; NaN from the first NaN on."""
    if np.isnan(seed):
        return np.full(len(x) + 1, np.nan)
    out = pd.Series(np.concatenate([[seed], x])).ewm(alpha=step, adjust=False).mean().to_numpy(copy=True)
    lost = np.flatnonzero(np.isnan(x))
    if len(lost):
        out[lost[0] + 1 :] = np.nan
    return out


def averaged(x: np.ndarray, n: int, first: int, step: float) -> np.ndarray:
    """Smoothed average whose seed is the mean of ``n`` values from ``first`` on."""
    out = np.full(len(x), np.nan)
    at = first + n - 1
    if len(x) > at:
        out[at:] = smoothed(float(x[first : at + 1].sum()) / n, x[at + 1 :], step)
    return out


def ema(x: np.ndarray, n: int, first: int = 0) -> np.ndarray:
    return averaged(x, n, first, 2.0 / (n + 1))


def wilder(x: np.ndarray, n: int, first: int) -> np.ndarray:
    """Average with memory (n - 1) / n."""
    return averaged(x, n, first, 1.0 / n)


def rsi(c: np.ndarray, n: int = 14) -> np.ndarray:
    move = np.diff(c, prepend=c[:1])
    up, down = wilder(np.maximum(move, 0), n, 1), wilder(np.maximum(-move, 0), n, 1)
    both = up + down
    return np.where(both == 0, 0.0, 100 * np.divide(up, both, out=np.zeros_like(both), where=both != 0)) + 0 * both


def true_range(h: np.ndarray, low: np.ndarray, c: np.ndarray) -> np.ndarray:
    before = np.concatenate([c[:1], c[:-1]])
    return np.maximum(h - low, np.maximum(np.abs(h - before), np.abs(low - before)))


def directional(h: np.ndarray, low: np.ndarray, c: np.ndarray, n: int = 14) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Plus DI, minus DI and ADX.  Sums start with n - 1 moves; ADX keeps its value where it is undefined."""
    size = len(c)
    plus, minus, adx = (np.full(size, np.nan) for _ in range(3))
    if size <= n:
        return plus, minus, adx
    rise, fall = np.diff(h, prepend=h[:1]), -np.diff(low, prepend=low[:1])
    up = np.where((rise > fall) & (rise > 0), rise, 0.0)
    down = np.where((fall > rise) & (fall > 0), fall, 0.0)
    # a sum that loses an n-th of itself at each step is n times an average
    p, m, t = (n * smoothed(float(x[1:n].sum()) / n, x[n:], 1.0 / n)[1:] for x in (up, down, true_range(h, low, c)))
    moved = t != 0
    plus[n:], minus[n:] = (100 * np.divide(x, t, out=np.zeros(size - n), where=moved) for x in (p, m))
    both = plus[n:] + minus[n:]
    valid = moved & (both != 0)
    dx = 100 * np.divide(np.abs(minus[n:] - plus[n:]), both, out=np.zeros(size - n), where=valid)
    if size >= 2 * n:
        later = valid[n:]
        values = smoothed(float(dx[:n].sum()) / n, dx[n:][later], 1.0 / n)
        adx[2 * n - 1] = values[0]
        adx[2 * n :] = values[np.cumsum(later)]
    return plus, minus, adx


def macd(c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Line, signal and histogram; both averages start at the slow one's first value, nothing shows before the signal."""
    line = ema(c, 12, 14) - ema(c, 26)
    signal = ema(line, 9, 25)
    return np.where(np.isnan(signal), np.nan, line), signal, line - signal


def recurrent_columns(h: np.ndarray, low: np.ndarray, c: np.ndarray) -> dict[str, np.ndarray]:
    out = {f"ema_{n}": ema(c, n) for n in EMA_WINDOWS}
    out["rsi_14"] = rsi(c)
    out["atr_14"] = wilder(true_range(h, low, c), 14, 1)
    out["atr_pct_14"] = over(out["atr_14"], np.abs(c))
    out["plus_di_14"], out["minus_di_14"], out["adx_14"] = directional(h, low, c)
    line, signal, histogram = macd(c)
    out |= {"macd_12_26": line, "macd_signal_12_26_9": signal, "macd_histogram_12_26_9": histogram}
    out["macd_12_26_pct"] = over(line, np.abs(out["ema_26"]))
    out["macd_histogram_12_26_9_pct"] = over(histogram, np.abs(c))
    out |= {f"pct_ema_{n}": over(c, out[f"ema_{n}"]) - 1 for n in (20, 50)}
    return out


def recurrent(bars: DataFrame) -> DataFrame:
    """``bars`` and the columns of this module."""
    return by_series(bars, lambda x: recurrent_columns(x("high"), x("low"), x("close")), COLUMNS)
