"""Append-only ledgers of runs and stored objects; state is the latest entry of a key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RUN_EVENTS = "run_id string, job string, status string, at timestamp, seq long, summary string"
OPEN = ("STARTED", "HEARTBEAT")


def run_state(events: DataFrame) -> DataFrame:
    """job, status, started, last entry and summary of each run."""
    last = F.max_by(F.struct("status", "at", "summary"), "seq")
    return events.groupBy("run_id").agg(F.max("job").alias("job"), F.min("at").alias("started"), last.alias("l")).select("run_id", "job", "started", F.col("l.status").alias("status"), F.col("l.at").alias("last_at"), F.col("l.summary").alias("summary"))


def stale_runs(events: DataFrame, now: Column, after_seconds: int) -> DataFrame:
    """Open runs without an entry for longer than ``after_seconds``."""
    silent = F.unix_timestamp(now) - F.unix_timestamp("last_at")
    return run_state(events).where(F.col("status").isin(*OPEN) & (silent > after_seconds))


def latest_success(events: DataFrame, job: str) -> DataFrame:
    return run_state(events).where((F.col("job") == job) & (F.col("status") == "SUCCEEDED")).orderBy(F.col("last_at").desc_nulls_last(), F.desc("run_id")).limit(1)


def object_manifest(files: DataFrame) -> DataFrame:
    """path, size and sha256 of binary files (path, content)."""
    return files.select("path", F.length("content").cast("long").alias("size"), F.sha2("content", 256).alias("sha256"))


def purgeable(objects: DataFrame, now: Column) -> DataFrame:
    """Objects (expires_at, deleted_at, purge_after) past their retention or soft-deleted long enough."""
    return objects.where((F.col("expires_at") <= now) | (F.col("deleted_at").isNotNull() & (F.col("purge_after") <= now)))
