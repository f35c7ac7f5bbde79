"""Functions of whole series: each listing's bars in date order, as arrays."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame


def over(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a / b, NaN where b is zero or either is NaN."""
    return np.divide(a, b, out=np.full(len(a), np.nan), where=(b != 0) & ~np.isnan(b))


def by_series(bars: DataFrame, make: Callable[[Callable[[str], np.ndarray]], dict[str, np.ndarray]], columns: list[str]) -> DataFrame:
    """``bars`` with the double ``columns`` that ``make`` gives from a listing's series.

    ``make`` gets a function from a column's name to its values by date, NaN for
    null; NaN in its results is null.  The grouping key is the one that windows
    over listings are partitioned by, so this follows them without an exchange.
    A task holds one listing's bars (tens of thousands at most).
    """

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("trading_date")
        values = lambda name: rows.column(name).to_numpy().astype(np.float64)
        made = make(values)
        for name in columns:
            rows = rows.append_column(name, pa.array(made[name], pa.float64(), mask=np.isnan(made[name])))
        return rows

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in bars.schema) + "".join(f", `{c}` double" for c in columns)
    return bars.groupBy("listing").applyInArrow(run, fields)
