"""Stored objects: checksummed writes, verified reads, soft deletion and batched purging.

Contents lie under their sha256, so equal contents are one file; the ledger of
objects is a table of events whose latest entry by ``seq`` is an object's state.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import Folder

EVENTS = "object_key string, seq long, event string, sha256 string, size long, content_type string, kind string, expires_at timestamp, purge_after timestamp"


class ObjectStore:
    """Contents by checksum below a root; small text objects such as reports."""

    def __init__(self, spark: SparkSession, root: str):
        self.folder = Folder(spark, root)

    def _name(self, sha256: str) -> str:
        return f"objects/{sha256[:2]}/{sha256}"

    def put(self, text: str) -> tuple[str, int]:
        """sha256 and size; storing the same content again changes nothing."""
        data = text.encode()
        sha256 = hashlib.sha256(data).hexdigest()
        if not self.folder.exists(self._name(sha256)):
            try:
                self.folder.publish(self._name(sha256), text)
            except FileExistsError:
                pass  # another writer stored the same content
        return sha256, len(data)

    def get(self, sha256: str, size: int | None = None) -> str:
        """The content; an error if it isn't what its name says."""
        text = self.folder.read(self._name(sha256))
        if hashlib.sha256(text.encode()).hexdigest() != sha256 or (size is not None and len(text.encode()) != size):
            raise ValueError(f"object {sha256} is damaged")
        return text

    def delete(self, sha256: str) -> bool:
        return self.folder.delete(self._name(sha256))


def object_state(events: DataFrame) -> DataFrame:
    """The latest state of each object; a PURGED one is gone."""
    fields = ("event", "sha256", "size", "content_type", "kind", "expires_at", "purge_after")
    last = events.groupBy("object_key").agg(F.max_by(F.struct(*fields), "seq").alias("o"), F.max("seq").alias("seq"))
    return last.select("object_key", "seq", "o.*").where("event <> 'PURGED'")


def cleanup_actions(state: DataFrame, now: Column, retention_days: dict[str, int], grace_days: int) -> DataFrame:
    """What is due: EXPIRE (soft deletion, purged after the grace) and PURGE, by kind's retention.

    An object is expired from ``expires_at`` on, or if it has none and its kind
    a retention, when it was stored that long ago (``purge_after`` null).
    """
    due = (F.col("event") == "STORED") & (F.col("expires_at") <= now)
    purge = (F.col("event") == "DELETED") & (F.col("purge_after") <= now)
    kept = F.element_at(F.create_map(*[F.lit(x) for kv in {"": 0, **retention_days}.items() for x in kv]), F.coalesce("kind", F.lit("")))
    action = F.when(purge, "PURGE").when(due, "EXPIRE")
    later = F.when(due, F.timestamp_add("DAY", F.coalesce(kept, F.lit(0)) + grace_days, now))
    return state.withColumns({"action": action, "next_purge_after": later}).where("action IS NOT NULL").select("object_key", "seq", "sha256", "action", "next_purge_after")


def in_batches(actions: DataFrame, size: int) -> DataFrame:
    """``actions`` with the number of the batch that takes each, in order of the key; a batch has at most ``size``.

    Ranges of keys are numbered, so no task sees all rows.
    """
    from pyspark.sql import Window

    spread = actions.withColumn("bucket", F.conv(F.substring(F.md5("object_key"), 1, 2), 16, 10).cast("int"))
    inside = F.row_number().over(Window.partitionBy("bucket").orderBy("object_key")) - 1
    return spread.withColumn("batch", F.concat_ws("-", F.format_string("%03d", "bucket"), F.format_string("%06d", F.floor(inside / size).cast("int")))).drop("bucket")


def unreferenced(contents: DataFrame, state: DataFrame) -> DataFrame:
    """Contents (sha256) that no object has."""
    return contents.join(state.select("sha256"), "sha256", "left_anti")
