"""Classify, merge and version rows against a stored table.

Parquet tables have no MERGE, so a merge is one join on the key that classifies
every row, and a rewrite of the classified result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import equivalent
from .indicators import series

BAR_KEY = ["listing", "trading_date"]
BAR_FIELDS = ["open", "high", "low", "close", "volume"]


def differing(fields: list[str], a: str, b: str) -> Column:
    """Names of the fields whose values differ, null-safe, joined by commas."""
    return F.concat_ws(",", F.array_compact(F.array(*[F.when(~F.col(f"{a}.{f}").eqNullSafe(F.col(f"{b}.{f}")), f) for f in fields])))


def classify_duplicates(rows: DataFrame, key: list[str], fields: list[str]) -> DataFrame:
    """One row a key: SINGLE, IDENTICAL (collapses) or CONFLICT (rejected), and the fields that differ; null is a value of its own."""
    distinct = [(F.count_distinct(f) + F.max(F.col(f).isNull().cast("int"))).alias(f"__{f}") for f in fields]
    found = rows.groupBy(*key).agg(F.count("*").alias("n"), *distinct)
    names = F.concat_ws(",", F.array_compact(F.array(*[F.when(F.col(f"__{f}") > 1, f) for f in fields])))
    kind = F.when(F.col("n") == 1, "SINGLE").when(names == "", "IDENTICAL").otherwise("CONFLICT")
    return found.select(*key, "n", kind.alias("kind"), names.alias("differing"))


def merge_optional(rows: DataFrame, key: list[str], fields: list[str]) -> DataFrame:
    """Per key the one non-blank value of each field; more than one is a conflict and gives null."""
    aggs = []
    for f in fields:
        v = F.nullif(F.trim(F.col(f)), F.lit(""))
        aggs += [F.count_distinct(v).alias(f"__{f}"), F.min(v).alias(f)]
    found = rows.groupBy(*key).agg(*aggs)
    conflict = F.concat_ws(",", F.array_compact(F.array(*[F.when(F.col(f"__{f}") > 1, f) for f in fields])))
    return found.select(*key, *[F.when(F.col(f"__{f}") <= 1, F.col(f)).alias(f) for f in fields], conflict.alias("conflicts"))


def bar_violations(bars: DataFrame) -> DataFrame:
    """Bars that break a relation, with the rules' names.  NaN and infinite values break ``not_finite`` and no other rule."""
    wild = F.lit(False)
    for f in BAR_FIELDS:
        wild = wild | F.coalesce(F.isnan(f) | (F.abs(f) == float("inf")), F.lit(False))
    rules = {
        "high_below": (F.col("high") < F.col("low")) | (F.col("high") < F.col("open")) | (F.col("high") < F.col("close")),
        "low_above": (F.col("low") > F.col("open")) | (F.col("low") > F.col("close")),
        "negative_volume": F.col("volume") < 0,
        "missing_price": F.col("open").isNull() | F.col("high").isNull() | F.col("low").isNull() | F.col("close").isNull(),
    }
    rules = {name: rule & ~wild for name, rule in rules.items()} | {"not_finite": wild}
    broken = F.concat_ws(",", F.array_compact(F.array(*[F.when(F.coalesce(rule, F.lit(False)), name) for name, rule in rules.items()])))
    return bars.withColumn("violations", broken).where("violations <> ''")


def compare_bars(incoming: DataFrame, stored: DataFrame) -> DataFrame:
    """Each incoming bar as INSERTED, CORRECTED or UNCHANGED, with differing fields."""
    joined = incoming.alias("i").join(stored.withColumn("__st", F.lit(True)).alias("s"), BAR_KEY, "left")
    exists = F.col("s.__st").isNotNull()
    names = F.when(exists, differing(BAR_FIELDS, "i", "s")).otherwise("")
    kind = F.when(~exists, "INSERTED").when(names != "", "CORRECTED").otherwise("UNCHANGED")
    return joined.select(*BAR_KEY, kind.alias("kind"), names.alias("differing"))


def derived(bars: DataFrame) -> DataFrame:
    """change, changepct, typ, hl_range, oc_range as decimals of scale 8, half up; a zero predecessor gives no changepct."""
    p = {c: F.col(c).cast("decimal(30,10)") for c in ("open", "high", "low", "close")}
    before = F.lag(p["close"], 1).over(series())
    change = (p["close"] - before).cast("decimal(30,10)")
    return bars.withColumns({
        "change": change.cast("decimal(30,8)"),
        "changepct": (change / F.nullif(before, F.lit(0).cast("decimal(30,10)"))).cast("decimal(30,8)"),
        "typ": ((p["high"] + p["low"] + p["close"]).cast("decimal(30,10)") / F.lit(3).cast("decimal(30,10)")).cast("decimal(30,8)"),
        "hl_range": (p["high"] - p["low"]).cast("decimal(30,8)"),
        "oc_range": (p["close"] - p["open"]).cast("decimal(30,8)"),
    })


def upsert(incoming: DataFrame, stored: DataFrame, key: list[str]) -> DataFrame:
    """Stored rows with incoming rows over them."""
    kept = stored.join(incoming.select(*key), key, "left_anti")
    return kept.unionByName(incoming.select(*stored.columns))


def upsert_bars(incoming: DataFrame, stored: DataFrame) -> DataFrame:
    """The merged series with its derived columns, a corrected bar's successor included."""
    return derived(upsert(incoming, stored, BAR_KEY))


def merge_features(incoming: DataFrame, stored: DataFrame, key: list[str], fields: list[str]) -> DataFrame:
    """Rows as INSERT, UPDATE (materially different), UNCHANGED or KEEP (not incoming)."""
    joined = incoming.withColumn("__in", F.lit(True)).alias("i").join(stored.withColumn("__st", F.lit(True)).alias("s"), key, "full")
    same = F.lit(True)
    for f in fields:
        same = same & equivalent(F.col(f"i.{f}"), F.col(f"s.{f}"))
    kind = F.when(F.col("i.__in").isNull(), "KEEP").when(F.col("s.__st").isNull(), "INSERT").when(same, "UNCHANGED").otherwise("UPDATE")
    values = [F.when(kind.isin("INSERT", "UPDATE"), F.col(f"i.{f}")).otherwise(F.col(f"s.{f}")).alias(f) for f in fields]
    return joined.select(*key, *values, kind.alias("kind"))


def insert_absent(incoming: DataFrame, stored: DataFrame, key: list[str]) -> DataFrame:
    return stored.unionByName(incoming.join(stored.select(*key), key, "left_anti").select(*stored.columns))


def upsert_known(incoming: DataFrame, stored: DataFrame, key: list[str], fields: list[str], unknown: str = "UNKNOWN") -> DataFrame:
    """New values replace old ones unless they are null or ``unknown``."""
    joined = incoming.alias("i").join(stored.alias("s"), key, "full")
    pick = [F.coalesce(F.when(F.col(f"i.{f}") != unknown, F.col(f"i.{f}")), F.col(f"s.{f}"), F.col(f"i.{f}")).alias(f) for f in fields]
    return joined.select(*key, *pick)


def latest(rows: DataFrame, key: list[str], *order: str) -> DataFrame:
    """The last row of each key by ``order``."""
    best = rows.groupBy(*key).agg(F.max_by(F.struct(*[c for c in rows.columns if c not in key]), F.struct(*order)).alias("row"))
    return best.select(*key, "row.*")


def symbol_history(rows: DataFrame, key: str, symbol: str, at: str, tie: str) -> DataFrame:
    """Valid-time history: repeats collapse, each row closes where the next begins."""
    by = Window.partitionBy(key).orderBy(at, tie)
    changed = rows.withColumn("__before", F.lag(symbol).over(by)).where(~F.col("__before").eqNullSafe(F.col(symbol)))
    return changed.select(key, symbol, F.col(at).alias("valid_from"), F.lead(at).over(by).alias("valid_to"))
