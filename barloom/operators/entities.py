"""Entity resolution: conflicts, missing evidence, scores and findings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def many_targets(rows: DataFrame, key: list[str], target: str, name: str, severity: str) -> DataFrame:
    """Keys with more than one distinct target, with their number and the smallest three."""
    found = rows.where(F.col(target).isNotNull()).groupBy(*key).agg(F.sort_array(F.collect_set(target)).alias("all"))
    found = found.where(F.size("all") > 1)
    return _conflict(found, key, name, F.lit(severity), F.size("all").cast("long"), F.concat_ws(",", F.slice("all", 1, 3).cast("array<string>")))


def mismatch(left: DataFrame, right: DataFrame, on: list[str], a: str, b: str, key: list[str], name: str, severity: str) -> DataFrame:
    """Equal keys whose targets differ."""
    found = left.join(right, on).where(F.col(a) != F.col(b)).groupBy(*key).agg(F.count("*").alias("n"), F.min(F.concat_ws("<>", a, b)).alias("s"))
    return _conflict(found, key, name, F.lit(severity), F.col("n"), F.col("s"))


def absent(rows: DataFrame, other: DataFrame, on: list[str], key: list[str], name: str, severity: str) -> DataFrame:
    """Rows without a partner."""
    found = rows.join(other, on, "left_anti").groupBy(*key).agg(F.count("*").alias("n"))
    return _conflict(found, key, name, F.lit(severity), F.col("n"), F.lit(""))


def _conflict(found: DataFrame, key: list[str], name: str, severity: Column, n: Column, sample: Column) -> DataFrame:
    return found.select(F.lit(name).alias("conflict"), severity.alias("severity"), F.concat_ws("|", *[F.col(k).cast("string") for k in key]).alias("key"), n.alias("n"), sample.alias("sample"))


def severity_rollup(conflicts: DataFrame) -> DataFrame:
    """Per detector and overall: worst severity decides FAIL, WARN or PASS."""
    worst = F.when(F.max((F.col("severity") == "FAIL").cast("int")) == 1, "FAIL").when(F.max((F.col("severity") == "WARN").cast("int")) == 1, "WARN").otherwise("PASS")
    own = conflicts.groupBy("conflict").agg(F.count("*").alias("n"), worst.alias("status"))
    return own.unionByName(conflicts.agg(F.count("*").alias("n"), worst.alias("status")).withColumn("conflict", F.lit("ALL")))


def resolve_alias(rows: DataFrame, raw: str, aliases: DataFrame, codes: DataFrame) -> DataFrame:
    """``exchange`` of a raw name: by alias, else by code; both without regard to case."""
    folded = rows.withColumn("__raw", F.lower(F.trim(raw)))
    a = aliases.select(F.lower("alias").alias("__raw"), F.col("exchange").alias("__by_alias")).dropDuplicates(["__raw"])
    c = codes.select(F.lower("exchange").alias("__raw"), F.col("exchange").alias("__by_code"))
    return folded.join(a, "__raw", "left").join(c, "__raw", "left").withColumn("exchange", F.coalesce("__by_alias", "__by_code")).drop("__raw", "__by_alias", "__by_code")


def confidence(evidence: DataFrame, snapshots: int = 2, days: int = 0) -> DataFrame:
    """Rule points of each subject, with blockers and level.

    ``evidence``: subject, cik_match, ticker_stable, exchange_stable, n_snapshots, span_days, conflicts.
    A series or class identity never scores, so 70 points are the most.
    """
    enough = (F.col("n_snapshots") >= snapshots) & (F.col("span_days") >= days)
    points = F.when(F.col("cik_match"), 25).otherwise(0) + F.when(F.col("ticker_stable") & enough, 25).otherwise(0) + F.when(F.col("exchange_stable") & enough, 20).otherwise(0)
    blockers = F.concat_ws(",", F.array_compact(F.array(F.when(F.col("conflicts") > 0, "CONFLICT"), F.when(~enough, "INSUFFICIENT_EVIDENCE"))))
    scored = evidence.withColumns({"points": points, "blockers": blockers})
    level = F.when(F.col("blockers").contains("CONFLICT"), "REFUSED").when(F.col("points") >= 70, "HIGH").when(F.col("points") >= 45, "MEDIUM").otherwise("LOW")
    return scored.select("subject", "points", "blockers", level.alias("level"))


def findings(counts: DataFrame, severities: dict[str, str]) -> DataFrame:
    """Unpivots one row of counters into codes with status."""
    cells = F.array(*[F.struct(F.lit(k).alias("code"), F.col(k).alias("n"), F.when(F.col(k) > 0, F.lit(s)).otherwise("PASS").alias("status")) for k, s in severities.items()])
    return counts.select(F.inline(cells))


def evidence_coverage(evidence: DataFrame, targets: list[str]) -> DataFrame:
    """Rows by the first target that they name, in the order of ``targets``, and observations with each target."""
    first = F.coalesce(*[F.when(F.col(t).isNotNull(), t) for t in targets], F.lit("none"))
    rows = evidence.groupBy(F.concat(F.lit("rows:"), first).alias("target")).agg(F.count("*").alias("n"))
    one = evidence.agg(*[F.count_distinct(F.when(F.col(t).isNotNull(), F.col("observation"))).alias(t) for t in targets])
    cells = F.array(*[F.struct(F.lit(f"observations:{t}").alias("target"), F.col(t).alias("n")) for t in targets])
    return rows.unionByName(one.select(F.inline(cells)))


def snapshot_diff(snapshots: DataFrame) -> DataFrame:
    """Latest against previous snapshot (source, at, sha, size) of each source."""
    from pyspark.sql import Window

    by = Window.partitionBy("source").orderBy("at")
    rows = snapshots.withColumns({"before_sha": F.lag("sha").over(by), "before_size": F.lag("size").over(by), "last": F.row_number().over(Window.partitionBy("source").orderBy(F.desc("at")))})
    change = F.when(F.col("before_sha").isNull(), "UNKNOWN").when(F.col("sha") == F.col("before_sha"), "UNCHANGED").otherwise("CHANGED")
    return rows.where("last = 1").select("source", change.alias("change"), (F.col("size") - F.col("before_size")).alias("size_delta"))
