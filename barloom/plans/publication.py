"""Two-slot publication of a feature table: build, verify, then publish one manifest.

Each listing has two slots; a run writes its listings' rows to the slots that
aren't active, once, and a membership table of the next version names the run
and slot of every listing.  Manifests are numbered files that never change; the
newest is the state, so a reader sees one version or the next and a crash leaves
the one before.  Nothing is copied: a view joins the runs' rows with a version's
memberships.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import Folder

#: Status transitions that are allowed.
TRANSITIONS = {"BUILDING": {"PREPARED", "FAILED"}, "PREPARED": {"PUBLISHED", "FAILED"}, "PUBLISHED": {"BUILDING"}, "FAILED": {"BUILDING"}}
MEMBERS = "listing string, slot string, run string"


@dataclass
class Manifest:
    number: int = 0
    version: int = 0
    status: str = "PUBLISHED"
    run_id: str = ""


class Publication:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.folder = spark, Folder(spark, root)

    def read(self) -> Manifest:
        """The newest manifest."""
        names = [n for n in self.folder.names("manifests") if n.endswith(".json")]
        return Manifest(**json.loads(self.folder.read(f"manifests/{names[-1]}"))) if names else Manifest()

    def lock(self, run_id: str) -> None:
        """Only one writer: the lock file's creation fails if another run's is there; a run may take its own again."""
        try:
            self.folder.write("LOCK", run_id)
        except Exception as e:
            if not self.folder.exists("LOCK") or self.folder.read("LOCK") != run_id:
                raise RuntimeError("another run is publishing") from e

    def unlock(self, run_id: str) -> None:
        if self.folder.exists("LOCK") and self.folder.read("LOCK") == run_id:
            self.folder.delete("LOCK")

    def move(self, m: Manifest, status: str, **changes) -> Manifest:
        """The next manifest; an error if the status can't follow or another writer was faster."""
        if status not in TRANSITIONS[m.status]:
            raise ValueError(f"{m.status} can't become {status}")
        after = Manifest(**(asdict(m) | changes | {"number": m.number + 1, "status": status}))
        self.folder.publish(f"manifests/{after.number:012d}.json", json.dumps(asdict(after), sort_keys=True))
        return after

    def members(self, version: int) -> DataFrame:
        """Slot and run of each listing."""
        if not version:
            return self.spark.createDataFrame([], MEMBERS)
        return self.spark.read.schema(MEMBERS).parquet(self.folder.path(f"members/{version}"))

    def build(self, run_id: str, rows: DataFrame) -> Manifest:
        """Take the lock and write the rows of some listings to the slots that aren't active.  An ended build can be done again."""
        self.lock(run_id)
        m = self.read()
        if m.status != "BUILDING" or m.run_id != run_id:
            m = self.move(m, "BUILDING", run_id=run_id)
        keyed = rows.withColumn("__key", F.col("listing").cast("string"))
        old = self.members(m.version).select(F.col("listing").alias("__key"), F.col("slot").alias("__old"))
        slot = F.when(F.col("__old") == "A", "B").otherwise("A")
        placed = keyed.join(old, "__key", "left").withColumn("slot", slot).drop("__key", "__old")
        placed.write.mode("overwrite").parquet(self.folder.path(f"runs/run={run_id}"))
        return self.move(m, "PREPARED")

    def finalize(self, run_id: str, expected_rows: int, key: list[str] | None = None) -> Manifest:
        """Check the image, then make its slots the active ones and give the lock back.  Doing it again changes nothing.

        The image is wrong if its rows aren't ``expected_rows`` or two have one ``key``.
        """
        m = self.read()
        if m.status == "PUBLISHED" and m.run_id == run_id:
            return m
        self.lock(run_id)
        if m.status != "PREPARED" or m.run_id != run_id:
            raise ValueError(f"{run_id} isn't prepared")
        fresh = self.spark.read.parquet(self.folder.path(f"runs/run={run_id}"))
        found = fresh.count()
        twice = not fresh.groupBy(*key).count().where("count > 1").isEmpty() if key else False
        if found != expected_rows or twice:
            self.move(m, "FAILED")
            self.unlock(run_id)
            raise ValueError(f"{found} rows, not {expected_rows}" if found != expected_rows else "a key comes twice")
        own = fresh.select(F.col("listing").cast("string").alias("listing"), "slot", F.lit(run_id).alias("run")).distinct()
        kept = self.members(m.version).join(own.select("listing"), "listing", "left_anti")
        kept.unionByName(own).write.mode("overwrite").parquet(self.folder.path(f"members/{m.version + 1}"))
        m = self.move(m, "PUBLISHED", version=m.version + 1)
        self.unlock(run_id)
        return m

    def view(self, m: Manifest | None = None) -> DataFrame:
        """Rows of the published version (of the newest run's schema, without rows, if none is)."""
        m = m or self.read()
        if not m.version:
            return self.spark.read.parquet(self.folder.path(f"runs/run={m.run_id}")).limit(0)
        rows = self.spark.read.option("mergeSchema", True).parquet(self.folder.path("runs")).withColumn("run", F.col("run").cast("string"))
        active = self.members(m.version).withColumnsRenamed({"listing": "__key", "slot": "__slot", "run": "__run"})
        same = (F.col("listing").cast("string") == F.col("__key")) & (F.col("slot") == F.col("__slot")) & (F.col("run") == F.col("__run"))
        return rows.join(active, same).drop("__key", "__slot", "__run", "run")

    def recovery(self, run_id: str, run_ended: bool) -> str:
        """What a restarted run has to do."""
        m = self.read()
        if m.run_id == run_id and m.status == "PUBLISHED":
            return "ALREADY_PUBLISHED"
        if m.status == "FAILED":
            return "TERMINAL_FAILURE"
        if m.status == "PREPARED":
            return "FINALIZE_PREPARED" if run_ended else "WAIT_FOR_CORE"
        return "RESUME_BUILDING"
