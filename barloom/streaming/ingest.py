"""Streaming ingest of daily bars: files in, a merged table out.

Each batch adds one folder of changes; a reader merges the newest base with the
changes after it, and now and then they are written together as a new base.  So
a batch costs what it brings, whatever the size of the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.merge import BAR_KEY, latest
from ..storage import Folder

BAR_FILE = "listing int, trading_date date, open double, high double, low double, close double, volume double, seq long"
STORED = f"{BAR_FILE}, batch long"
#: Batches after which changes become a new base.
COMPACT_EVERY = 50


class BarTable:
    """Bars of which the last by ``seq`` wins, and of equal ones that of the later batch.

    Only folders that were written to their end count; a batch that is seen
    again replaces its own folder.  A failing read is an error: nothing stored
    is ever replaced by less.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.folder = spark, Folder(spark, root)

    def _numbers(self, kind: str) -> list[int]:
        return [int(n) for n in self.folder.names(kind) if self.folder.complete(f"{kind}/{n}")]

    def read(self) -> DataFrame:
        """The merged rows, with ``seq`` and the batch that they come from."""
        base = max(self._numbers("base"), default=-1)
        names = ([f"base/{base:012d}"] if base >= 0 else []) + [f"changes/{n:012d}" for n in self._numbers("changes") if n > base]
        if not names:
            return self.spark.createDataFrame([], STORED)
        rows = self.spark.read.schema(STORED).parquet(*map(self.folder.path, names))
        return latest(rows, BAR_KEY, "seq", "batch").select(*[c.split(" ")[0] for c in STORED.split(", ")])

    def add(self, batch: DataFrame, number: int) -> None:
        if number <= max(self._numbers("base"), default=-1):
            return  # it is part of the base
        rows = latest(batch, BAR_KEY, "seq").withColumn("batch", F.lit(number).cast("long"))
        rows.write.mode("overwrite").parquet(self.folder.path(f"changes/{number:012d}"))

    def compact(self, number: int) -> None:
        """Write a base of all changes up to ``number``, and delete what the base before it had made superfluous."""
        bases = self._numbers("base")
        if number in bases:
            return
        self.read().where(F.col("batch") <= number).write.mode("overwrite").parquet(self.folder.path(f"base/{number:012d}"))
        if bases:  # readers may still use the last base and the changes after it
            for n in self._numbers("changes"):
                if n <= bases[-1]:
                    self.folder.delete(f"changes/{n:012d}")
            for n in bases[:-1]:
                self.folder.delete(f"base/{n:012d}")


def bar_stream(spark: SparkSession, path: str, files_per_trigger: int = 50) -> DataFrame:
    return spark.readStream.schema(BAR_FILE).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def merge_batch(target: str, compact_every: int = COMPACT_EVERY):
    """A foreachBatch function that merges into the table at ``target``."""

    def merge(batch: DataFrame, epoch: int) -> None:
        table = BarTable(batch.sparkSession, target)
        table.add(batch, epoch)
        if compact_every and epoch % compact_every == compact_every - 1:
            table.compact(epoch)

    return merge


def run_once(spark: SparkSession, source: str, target: str, checkpoint: str, files_per_trigger: int = 50, compact_every: int = COMPACT_EVERY) -> DataFrame:
    """Take all waiting files, batch by batch, and return the merged table; without any file ever, an empty one."""
    writer = bar_stream(spark, source, files_per_trigger).writeStream.foreachBatch(merge_batch(target, compact_every))
    writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return BarTable(spark, target).read()


def recent_activity(events: DataFrame, late: str = "10 minutes", width: str = "5 minutes") -> DataFrame:
    """Counts by window and type with a watermark; works on streams and tables."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("value"))
