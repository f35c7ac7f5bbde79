"""Benchmark-relative features on exactly shared dates."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import distance
from .series import by_series, over

#: Correlations this close beyond 1 are rounding; others are an error.
CLAMP = 1e-12
#: Windows that are computed at once.
BLOCK = 4096
COLUMNS = [
    "rel_spx", "pct_rel_spx_20", "pct_rel_spx_50", *(f"relative_return_spx_{n}d_pct" for n in (20, 63, 126, 252)),
    "spx_beta_60d", "spx_beta_252d", "spx_correlation_60d", "spx_correlation_252d",
]


def with_benchmark(bars: DataFrame, bench: DataFrame) -> DataFrame:
    """Bars with the benchmark's close of the same date; ``shared`` says that it has one."""
    return bars.join(bench, "trading_date", "left").withColumn("shared", F.col("bench_close").isNotNull())


def aligned(bars: DataFrame, bench: DataFrame) -> DataFrame:
    """Bars with the benchmark's close of the same date (null: not shared), and returns between shared dates.

    ``aligned_count`` numbers the shared dates; ``valid_count`` counts the
    trailing run of shared dates with both returns.
    """
    joined = with_benchmark(bars, bench)
    own = Window.partitionBy("listing", "shared").orderBy("trading_date")
    out = joined.withColumns({
        "aligned_count": F.when(F.col("shared"), F.row_number().over(own)),
        "own_return": F.when(F.col("shared"), distance(F.col("close"), F.lag("close", 1).over(own))),
        "bench_return": F.when(F.col("shared"), distance(F.col("bench_close"), F.lag("bench_close", 1).over(own))),
    })
    invalid = F.max(F.when(F.col("own_return").isNull() | F.col("bench_return").isNull(), F.col("aligned_count"))).over(own.rowsBetween(Window.unboundedPreceding, 0))
    return out.withColumn("valid_count", F.when(F.col("shared"), F.col("aligned_count") - invalid))


def _windows(n: int, *series: np.ndarray) -> Iterator[tuple[slice, list[np.ndarray]]]:
    """Blocks of the windows of ``n`` values, and the places that they end at."""
    for at in range(0, len(series[0]) - n + 1, BLOCK):
        stop = min(at + BLOCK, len(series[0]) - n + 1)
        yield slice(at + n - 1, stop + n - 1), [np.lib.stride_tricks.sliding_window_view(x[at : stop + n - 1], n) for x in series]


def _deviations(rows: np.ndarray) -> np.ndarray:
    """Each row less its mean; exactly zero where all values are equal."""
    equal = (rows == rows[:, :1]).all(axis=1, keepdims=True)
    return np.where(equal, 0.0, rows - rows.mean(axis=1, keepdims=True))


def relative_columns(close: np.ndarray, bench: np.ndarray) -> dict[str, np.ndarray]:
    """The eleven features of one listing in date order; NaN is null, and all are null where ``bench`` is.

    Windows count shared dates; a window with a null return or ratio gives null.
    """
    shared = np.flatnonzero(~np.isnan(bench))
    c, b = close[shared], bench[shared]
    made = {name: np.full(len(c), np.nan) for name in COLUMNS}
    rel = made["rel_spx"] = over(c, b)
    for n in (20, 50):
        for at, (r,) in _windows(n, rel):
            made[f"pct_rel_spx_{n}"][at] = over(rel[at], r.mean(axis=1)) - 1
    own, market = (np.concatenate([[np.nan] * min(1, len(x)), over(x[1:], x[:-1]) - 1]) for x in (c, b))
    for n in (20, 63, 126, 252):
        for at, (s, m) in _windows(n, 1 + own, 1 + market):
            made[f"relative_return_spx_{n}d_pct"][at] = over(s.prod(axis=1), m.prod(axis=1)) - 1
    for n in (60, 252):
        for at, (s, m) in _windows(n, own, market):
            s, m = _deviations(s), _deviations(m)
            both, vs, vm = (s * m).sum(axis=1), (s * s).sum(axis=1), (m * m).sum(axis=1)
            made[f"spx_beta_{n}d"][at] = over(both, vm)
            r = over(both, np.sqrt(vs) * np.sqrt(vm))
            if (np.abs(r) > 1 + CLAMP).any():
                raise ValueError("a correlation lies beyond 1")
            made[f"spx_correlation_{n}d"][at] = np.clip(r, -1, 1)
    out = {name: np.full(len(close), np.nan) for name in COLUMNS}
    for name in COLUMNS:
        out[name][shared] = made[name]
    return out


def relative_features(bars: DataFrame, bench: DataFrame) -> DataFrame:
    """``bars`` with ``bench_close``, ``shared`` and the eleven benchmark features; all null on dates that the benchmark lacks."""
    return by_series(with_benchmark(bars, bench), lambda x: relative_columns(x("close"), x("bench_close")), COLUMNS)
