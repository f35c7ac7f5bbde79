"""Numeric rules: exact-zero division, complete windows, tolerant equality."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ABSOLUTE, RELATIVE = 1e-12, 1e-10


def ratio(a: Column, b: Column) -> Column:
    """a / b, null exactly where b is zero or either is null."""
    return a / F.nullif(b, F.lit(0.0))


def distance(a: Column, b: Column) -> Column:
    """a / b - 1."""
    return ratio(a, b) - 1


def complete(value: Column, counted: Column, window, n: int) -> Column:
    """``value`` where the window holds ``n`` non-null ``counted``."""
    return F.when(F.count(counted).over(window) == n, value)


def equivalent(a: Column, b: Column, absolute: float = ABSOLUTE, relative: float = RELATIVE) -> Column:
    """Equal within tolerance; nulls equal only nulls."""
    near = F.abs(a - b) <= F.greatest(F.lit(absolute), F.lit(relative) * F.greatest(F.abs(a), F.abs(b)))
    return F.coalesce(near, a.isNull() & b.isNull())


def rounded(columns: dict[str, int]) -> list[Column]:
    return [F.round(F.col(c), digits).alias(c) for c, digits in columns.items()]
