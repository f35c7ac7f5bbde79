import datetime as dt

import pytest

from barloom.plans.publication import Publication
from barloom.streaming import ingest


def rows(spark, values):
    return spark.createDataFrame(values, "listing int, x double")


def test_slots_alternate_and_readers_keep_their_version(spark, tmp_path):
    p = Publication(spark, f"file://{tmp_path}")
    p.lock("r1")
    with pytest.raises(RuntimeError):
        Publication(spark, f"file://{tmp_path}").build("r2", rows(spark, [(1, 0.0)]))
    p.build("r1", rows(spark, [(1, 1.0), (2, 2.0)]))
    assert p.recovery("r1", True) == "FINALIZE_PREPARED" and p.recovery("r1", False) == "WAIT_FOR_CORE"
    p.finalize("r1", 2)
    assert p.recovery("r1", True) == "ALREADY_PUBLISHED" and p.finalize("r1", 2).version == 1
    old = p.view()
    p.build("r2", rows(spark, [(2, 20.0), (2, 21.0)]))
    assert p.view().count() == 2
    p.finalize("r2", 2)
    assert sorted((r.listing, r.x, r.slot) for r in p.view().collect()) == [(1, 1.0, "A"), (2, 20.0, "B"), (2, 21.0, "B")]
    assert sorted(r.x for r in old.collect()) == [1.0, 2.0]
    before = p.read()
    p.folder.write("manifests/000000000099.json.new", "{")  # a writer that died before its rename
    assert p.read() == before
    p.build("r3", rows(spark, [(1, 9.0)]))
    with pytest.raises(ValueError):
        p.finalize("r3", 5)
    assert p.recovery("r3", True) == "TERMINAL_FAILURE" and p.view().count() == 3
    p.build("r4", rows(spark, [(1, 9.0), (1, 9.0)]))
    with pytest.raises(ValueError, match="twice"):
        p.finalize("r4", 2, ["listing", "x"])
    p.build("r5", rows(spark, [(1, 9.0), (7, 1.0)]))
    m = p.read()
    p.move(m, "FAILED")
    with pytest.raises(FileExistsError):
        p.move(m, "PUBLISHED")  # by a writer that still has the manifest before
    assert not [n for n in p.folder.names("members") if n == "3"] and p.view().count() == 3


def changes(spark, path, values):
    d = dt.date(2026, 1, 2)
    rows = [(k, d, c, c, c, c, None, s) for k, c, s in values]
    spark.createDataFrame(rows, ingest.BAR_FILE).coalesce(1).write.mode("append").parquet(path)


def test_stream_keeps_what_is_newer_and_never_loses_rows(spark, tmp_path):
    run = lambda every: ingest.run_once(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/cp", 1, every)
    (tmp_path / "in").mkdir()
    assert run(2).count() == 0  # no file yet
    for values in ([(1, 1.0, 10), (2, 2.0, 10)], [(1, 9.0, 3)], [(2, 7.0, 10), (3, 3.0, 1)], [(1, 4.0, 11)], [(3, 5.0, 1)]):
        changes(spark, f"{tmp_path}/in", values)
        merged = run(2)
    # an older seq doesn't win, an equal one of a later batch does
    assert sorted((r.listing, r.close) for r in merged.collect()) == [(1, 4.0), (2, 7.0), (3, 5.0)]
    table = ingest.BarTable(spark, f"{tmp_path}/out")
    assert table._numbers("base") and max(table._numbers("base")) == 3
    # a batch that is seen again changes nothing
    table.add(ingest.BarTable(spark, f"{tmp_path}/out").read().limit(0).drop("batch"), 1)
    assert table.read().count() == 3
    # an unfinished folder doesn't count; a table that can't be read is an error, not an empty one
    (tmp_path / "out/changes/000000000009").mkdir()
    assert table.read().count() == 3
    for f in (tmp_path / "out/base").glob("*/*.parquet"):
        f.write_bytes(b"damaged")
    with pytest.raises(Exception):
        table.compact(8)
    assert not table.folder.complete("base/000000000008")


def test_stream_merges_corrections(spark, tmp_path):
    d = dt.date(2026, 1, 2)
    for i, batch in enumerate([[(1, d, 1.0, 1), (2, d, 2.0, 2)], [(1, d, 5.0, 3), (1, d, 4.0, 2)]]):
        spark.createDataFrame([(k, day, c, c, c, c, None, s) for k, day, c, s in batch], ingest.BAR_FILE).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        merged = ingest.run_once(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/cp")
        assert sorted((r.listing, r.close) for r in merged.collect()) == [[(1, 1.0), (2, 2.0)], [(1, 5.0), (2, 2.0)]][i]


def test_objects_are_checked_and_purged_in_batches(spark, tmp_path):
    from pyspark.sql import functions as F

    from barloom.operators import objects

    store = objects.ObjectStore(spark, f"file://{tmp_path}")
    sha256, size = store.put("report é")
    assert store.put("report é") == (sha256, size) and store.get(sha256, size) == "report é"
    with pytest.raises(ValueError):
        store.get(sha256, size + 1)
    (tmp_path / "objects" / sha256[:2] / sha256).write_text("other")
    (tmp_path / "objects" / sha256[:2] / f".{sha256}.crc").unlink(missing_ok=True)
    with pytest.raises(ValueError):
        store.get(sha256)
    assert store.delete(sha256) and not store.delete(sha256)
    at = lambda day: dt.datetime(2026, 1, day)
    events = [
        ("a", 1, "STORED", "x", 1, "t", "report", at(2), None), ("b", 1, "STORED", "y", 1, "t", "raw", at(9), None), ("c", 1, "STORED", "x", 1, "t", "raw", at(2), None),
        ("c", 2, "DELETED", "x", 1, "t", "raw", at(2), at(4)), ("d", 1, "STORED", "z", 1, "t", None, None, None), ("e", 2, "PURGED", "w", 1, "t", None, None, None),
    ]
    state = objects.object_state(spark.createDataFrame(events, objects.EVENTS))
    due = objects.in_batches(objects.cleanup_actions(state, F.lit(at(5)), {"report": 30}, 7), 1)
    got = {r.object_key: (r.action, r.next_purge_after) for r in due.collect()}
    assert got == {"a": ("EXPIRE", dt.datetime(2026, 2, 11)), "c": ("PURGE", None)}
    contents = spark.createDataFrame([("x",), ("w",)], "sha256 string")
    assert [r.sha256 for r in objects.unreferenced(contents, state).collect()] == ["w"]
