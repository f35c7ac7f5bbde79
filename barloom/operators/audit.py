"""Append-only audit of what a reconciliation did."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def audit_rows(incoming: DataFrame, stored: DataFrame, key: list[str], fields: list[str], run_id: str, entity: str) -> DataFrame:
    """One row for each inserted key and for each field that differs: run, entity, key, action, field, old and new value.

    ``action`` is INSERT (field null, the new values as JSON) or UPDATE; equal
    rows leave no trace.  ``audit_id`` is a hash of what the row says, so a
    repeated run writes the same ids and ``append_absent`` adds nothing twice.
    """
    joined = incoming.alias("i").join(stored.withColumn("__st", F.lit(True)).alias("s"), key, "left")
    text = lambda side, f: F.col(f"{side}.{f}").cast("string")
    inserted = F.struct(F.lit("INSERT").alias("action"), F.lit(None).cast("string").alias("field"), F.lit(None).cast("string").alias("old"), F.to_json(F.struct(*[F.col(f"i.{f}") for f in fields])).alias("new"))
    changed = [
        F.when(~F.col(f"i.{f}").eqNullSafe(F.col(f"s.{f}")), F.struct(F.lit("UPDATE").alias("action"), F.lit(f).alias("field"), text("s", f).alias("old"), text("i", f).alias("new")))
        for f in fields
    ]
    entries = F.when(F.col("s.__st").isNull(), F.array(inserted)).otherwise(F.array_compact(F.array(*changed)))
    named = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in key])
    rows = joined.select(F.lit(run_id).alias("run_id"), F.lit(entity).alias("entity"), named.alias("key"), F.explode(entries).alias("e")).select("run_id", "entity", "key", "e.*")
    return rows.withColumn("audit_id", F.sha2(F.to_json(F.struct("run_id", "entity", "key", "action", "field", "old", "new")), 256))


def append_absent(ledger: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows that the ledger doesn't have yet."""
    return rows.dropDuplicates(["audit_id"]).join(ledger.select("audit_id"), "audit_id", "left_anti")
