"""Recompute planning, drift, published snapshots and model inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .merge import BAR_FIELDS, BAR_KEY

#: Reasons to write rows, in their order; the first four and the version's come from the comparison.
REASONS = ["tail_append", "missing", "source_drift", "history_drift", "benchmark_drift", "version_drift", "explicit_rebuild"]
LOCAL_REASONS = REASONS[:4]
COMPARED = [*LOCAL_REASONS, "version_drift"]


def state_comparison(source: DataFrame, payload: DataFrame, version: str) -> DataFrame:
    """Per listing: how many source bars are new, missing, different, renumbered or of another version, and since when.

    ``payload`` has the copied bar fields, ``history_count`` and ``version``.
    """
    numbered = source.withColumn("n", F.row_number().over(Window.partitionBy("listing").orderBy("trading_date")))
    tail = payload.groupBy("listing").agg(F.max("trading_date").alias("payload_last"))
    own = payload.select(*BAR_KEY, *[F.col(f).alias(f"p_{f}") for f in BAR_FIELDS], "history_count", "version")
    rows = numbered.join(own, BAR_KEY, "left").join(tail, "listing", "left")
    there = F.col("version").isNotNull()
    drift = ~F.struct(*BAR_FIELDS).eqNullSafe(F.struct(*[F.col(f"p_{f}").alias(f) for f in BAR_FIELDS]))
    flags = {
        "tail_append": ~there & (F.col("payload_last").isNull() | (F.col("trading_date") > F.col("payload_last"))),
        "missing": ~there & (F.col("trading_date") <= F.col("payload_last")),
        "source_drift": there & drift,
        "history_drift": there & (F.col("history_count") != F.col("n")),
        "version_drift": there & (F.col("version") != version),
    }
    aggs = [F.count("*").alias("source_bars"), F.min("trading_date").alias("source_first"), F.max("trading_date").alias("source_last"), F.max("payload_last").alias("payload_last")]
    for name, flag in flags.items():
        flag = F.coalesce(flag, F.lit(False))
        aggs += [F.count(F.when(flag, 1)).alias(name), F.min(F.when(flag, F.col("trading_date"))).alias(f"{name}_from")]
    return rows.groupBy("listing").agg(*aggs)


def affected_ranges(listings: DataFrame, state: DataFrame, end, start=None, benchmark_drift=None, rebuild: list[int] = ()) -> DataFrame:
    """One suffix to write per listing with any reason; calculation always starts at its first source bar.

    ``listings``: listing, active, supported (by the benchmark).  ``start`` and
    ``end`` limit the dates that are asked for, ``benchmark_drift`` is the first
    changed date of the benchmark, ``rebuild`` lists listings to be written anew.
    An inactive listing without another reason is written for a benchmark's
    drift only as far as it has technical rows, and rows behind a changed one
    are always written again.  Reasons come in the order of ``REASONS``.
    """
    date = lambda x: F.lit(x).cast("date")
    rows = listings.join(state, "listing").where("source_first IS NOT NULL")
    first, last, technical = F.col("source_first"), F.col("source_last"), F.col("payload_last")
    rows = rows.withColumn("horizon", F.least(date(end), last)).where("horizon >= source_first")
    horizon = F.col("horizon")
    since = {r: F.when((F.col(r) > 0) & (F.col(f"{r}_from") <= horizon), F.col(f"{r}_from")) for r in LOCAL_REASONS}
    since["version_drift"] = F.when(F.col("version_drift") > 0, first)
    rebuilt = F.greatest(first, date(start))
    since["explicit_rebuild"] = F.when(F.col("listing").isin(list(rebuild)) & (rebuilt <= horizon), rebuilt)
    rows = rows.withColumns({f"__{r}": c for r, c in since.items()})
    other = F.coalesce(*[F.col(f"__{r}") for r in since]).isNotNull()
    reach = F.when(F.col("active") | other, horizon).otherwise(F.when(technical.isNotNull(), F.least(horizon, technical)))
    drifted = date(benchmark_drift)
    rows = rows.withColumns({"__benchmark_drift": F.when(F.col("supported") & (first <= drifted) & (drifted <= reach), drifted), "__other": other})
    found = rows.withColumn("write_start", F.least(*[F.col(f"__{r}") for r in REASONS])).where("write_start IS NOT NULL")
    only = ~F.col("active") & ~F.col("__other") & technical.isNotNull()
    until = F.when(only, F.least(horizon, technical)).otherwise(horizon)
    until = F.when(F.col("write_start") <= technical, F.greatest(until, technical)).otherwise(until)
    found = found.withColumn("write_end", F.least(until, last)).where("write_start <= write_end")
    reasons = F.concat_ws(",", F.array_compact(F.array(*[F.when(F.col(f"__{r}").isNotNull(), r) for r in REASONS])))
    return found.select("listing", first.alias("calculation_start"), "write_start", "write_end", reasons.alias("reasons"))


def published(slot_a: DataFrame, slot_b: DataFrame, membership: DataFrame) -> DataFrame:
    """Rows of the slot that is active for their listing (membership: listing, slot)."""
    rows = slot_a.withColumn("slot", F.lit("A")).unionByName(slot_b.withColumn("slot", F.lit("B")))
    return rows.join(membership, ["listing", "slot"])


def select_slots(listings: DataFrame, membership: DataFrame) -> DataFrame:
    """The slot to write: A first, then the opposite of the active one."""
    return listings.join(membership, "listing", "left").select("listing", F.when(F.col("slot") == "A", "B").otherwise("A").alias("write_slot"))


def image_check(expected: DataFrame, found: DataFrame, key: list[str]) -> DataFrame:
    """Counts of a full outer comparison by key: both, only expected, only found."""
    a, b = expected.select(*key).withColumn("e", F.lit(1)), found.select(*key).withColumn("f", F.lit(1))
    j = a.join(b, key, "full")
    return j.agg(F.count(F.when(F.col("e").isNotNull() & F.col("f").isNotNull(), 1)).alias("both"), F.count(F.when(F.col("f").isNull(), 1)).alias("only_expected"), F.count(F.when(F.col("e").isNull(), 1)).alias("only_found"))


def feature_ranking(rows: DataFrame, feature: str, n: int = 12) -> DataFrame:
    """Largest values of a feature, nulls last, ties by listing."""
    return rows.select("listing", "trading_date", F.col(feature).alias("value")).orderBy(F.col("value").desc_nulls_last(), "listing", "trading_date").limit(n)


def feature_counts(rows: DataFrame, minimum: dict[str, int], benchmark: set[str], guaranteed: set[str]) -> DataFrame:
    """Populated values and nulls by reason of each feature, in one pass.

    ``rows`` have ``history_count`` and ``supported`` beside the features.
    ``minimum``: observations that a feature needs; rows with fewer are warm-up.
    Features of ``benchmark`` are never there for unsupported rows; those of
    ``guaranteed`` must be there after the warm-up, and other nulls depend on
    their inputs.
    """
    aggs = [F.count("*").alias("__rows"), F.count(F.when(~F.col("supported"), 1)).alias("__unsupported")]
    for f, n in minimum.items():
        early = F.col("history_count") < n
        aggs += [F.count(f).alias(f), F.count(F.when(early & F.col("supported") if f in benchmark else early, 1)).alias(f"__{f}_early")]
        if f in guaranteed:
            aggs.append(F.count(F.when(F.col(f).isNull() & ~early, 1)).alias(f"__{f}_lost"))
    one, total, zero, cells = rows.agg(*aggs), F.col("__rows"), F.lit(0).cast("long"), []
    for f in minimum:
        unsupported = F.col("__unsupported") if f in benchmark else zero
        lost = F.col(f"__{f}_lost") if f in guaranteed else zero
        nulls, early = total - F.col(f), F.col(f"__{f}_early")
        named = {"populated": F.col(f), "nulls": nulls, "warm_up": early, "dependency": nulls - early - unsupported - lost, "unsupported": unsupported, "unexpected": lost}
        cells.append(F.struct(F.lit(f).alias("feature"), total.alias("eligible"), *[c.alias(name) for name, c in named.items()]))
    return one.select(F.inline(F.array(*cells)))


def top_and_other(rows: DataFrame, code: str, n: int) -> DataFrame:
    """Counts of the ``n`` largest groups, the rest as OTHER."""
    counts = rows.groupBy(code).agg(F.count("*").alias("count"))
    keep = counts.orderBy(F.desc("count"), code).limit(n).select(code).withColumn("__keep", F.lit(True))
    named = counts.join(F.broadcast(keep), code, "left").select(F.when(F.col("__keep"), F.col(code)).otherwise("OTHER").alias(code), "count")
    return named.groupBy(code).agg(F.sum("count").alias("count"))
