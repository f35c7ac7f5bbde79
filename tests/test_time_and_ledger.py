import datetime as dt

from pyspark.sql import functions as F

from barloom.functions import text, time
from barloom.plans import ledger


def test_strict_cutoffs_reject_skipped_and_repeated_times(spark):
    local = ["2026-03-08 02:30:00", "2026-11-01 01:30:00", "2026-07-01 16:00:00", "2026-01-05 16:00:00"]
    df = spark.createDataFrame([(x,) for x in local], "t string").withColumn("u", time.strict_utc(F.to_timestamp("t"), "America/New_York").cast("string"))
    assert [r.u for r in df.collect()] == [None, None, "2026-07-01 20:00:00", "2026-01-05 21:00:00"]
    df = spark.createDataFrame([(dt.date(2026, 7, 1), 1782950400, 1.5), (dt.date(2026, 7, 2), 0, None)], "d date, e long, v double")
    rows = df.select(time.eligible_after(F.col("d"), "16:00", "America/New_York", 30).cast("string").alias("at"), time.session_date(F.col("e"), "Asia/Tokyo").alias("s"), time.measurement(F.col("v"), "mm").alias("m")).collect()
    assert rows[0].at == "2026-07-01 20:30:00" and str(rows[0].s) == "2026-07-02" and tuple(rows[0].m) == (1.5, "mm") and rows[1].m is None


def test_run_ledger(spark):
    at = lambda m: dt.datetime(2026, 1, 1, 0, m)
    events = [("a", "j", "STARTED", at(0), 1, None), ("a", "j", "HEARTBEAT", at(5), 2, None), ("b", "j", "STARTED", at(1), 1, None), ("b", "j", "SUCCEEDED", at(3), 2, "ok"), ("c", "j", "STARTED", at(19), 1, None)]
    df = spark.createDataFrame(events, ledger.RUN_EVENTS)
    assert {r.run_id: r.status for r in ledger.run_state(df).collect()} == {"a": "HEARTBEAT", "b": "SUCCEEDED", "c": "STARTED"}
    assert [r.run_id for r in ledger.stale_runs(df, F.lit(at(20)), 600).collect()] == ["a"]
    assert ledger.latest_success(df, "j").first().summary == "ok"


def test_objects(spark):
    df = spark.createDataFrame([("p", bytearray(b"abc"))], "path string, content binary")
    r = ledger.object_manifest(df).first()
    assert r["size"] == 3 and r.sha256.startswith("ba7816bf")
    objects = spark.createDataFrame([("x", 1, None, None), ("y", 9, 2, 3), ("z", 9, 2, 8)], "k string, expires_at int, deleted_at int, purge_after int")
    assert {r.k for r in ledger.purgeable(objects, F.lit(5)).collect()} == {"x", "y"}


def test_text_rules(spark):
    names = spark.createDataFrame([("Acme, Inc.",), ("ACME CORP",), ("Inca Co",), (None,)], "n string")
    assert [r[0] for r in names.select(text.normalized_name(F.col("n"))).collect()] == ["acme", "acme", "inca", None]
    d = spark.createDataFrame([("PT1H2M3S",), ("P1DT1S",), ("PT",), ("P",), ("1H",), (None,)], "d string")
    assert [r[0] for r in d.select(text.duration_seconds(F.col("d"))).collect()] == [3723, 86401, None, None, None, None]
    assert spark.range(1).select(text.padded_cik(F.lit("12345678901")), text.padded_cik(F.lit(" 42 "))).first()[:] == (None, "0000000042")
