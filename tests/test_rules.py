"""Merge, planning and readiness rules on single rows."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom.functions import text
from barloom.operators import merge, planning, readiness, relative

D = dt.date


def test_null_is_a_value_of_its_own(spark):
    rows = spark.createDataFrame([(1, None), (1, "~"), (2, None), (2, None), (3, "a"), (3, "a"), (4, "a"), (4, None), (5, None)], "k int, v string")
    got = {r.k: (r.kind, r.differing) for r in merge.classify_duplicates(rows, ["k"], ["v"]).collect()}
    assert got == {1: ("CONFLICT", "v"), 2: ("IDENTICAL", ""), 3: ("IDENTICAL", ""), 4: ("CONFLICT", "v"), 5: ("SINGLE", "")}


BARS = "listing int, trading_date date, open double, high double, low double, close double, volume double"


def test_stored_rows_without_a_close_are_there(spark):
    day = D(2026, 1, 2)
    stored = spark.createDataFrame([(1, day, 1.0, 2.0, 1.0, None, 5.0)], BARS)
    assert [r.kind for r in merge.compare_bars(stored, stored).collect()] == ["UNCHANGED"]
    other = stored.withColumn("close", F.lit(1.5))
    assert [(r.kind, r.differing) for r in merge.compare_bars(other, stored).collect()] == [("CORRECTED", "close")]
    assert [r.kind for r in merge.compare_bars(other.withColumn("listing", F.lit(2)), stored).collect()] == ["INSERTED"]


def test_values_that_are_no_numbers_break_a_rule(spark):
    day, nan, inf = D(2026, 1, 2), float("nan"), float("inf")
    rows = [(1, day, 1.0, nan, 1.0, 1.0, 1.0), (2, day, 1.0, inf, 1.0, 1.0, 1.0), (3, day, 1.0, 2.0, -inf, 1.0, None), (4, day, 1.0, 2.0, 1.0, 1.0, nan), (5, day, 1.0, 2.0, 1.0, 1.5, None), (6, day, 3.0, 2.0, 1.0, None, -1.0)]
    got = {r.listing: r.violations for r in merge.bar_violations(spark.createDataFrame(rows, BARS)).collect()}
    assert got == {1: "not_finite", 2: "not_finite", 3: "not_finite", 4: "not_finite", 6: "high_below,negative_volume,missing_price"}


def test_correlations_of_equal_and_constant_series():
    rng = np.random.default_rng(0)
    close = 100 + np.cumsum(rng.normal(size=120))
    same = relative.relative_columns(close, 3 * close)
    assert np.nanmax(np.abs(same["spx_correlation_60d"] - 1)) < 1e-12 and np.isnan(same["spx_correlation_60d"][59]) and not np.isnan(same["spx_correlation_60d"][60])
    growing = 1.1 ** np.arange(100)  # returns that are equal but for rounding; of powers of two exactly
    flat = relative.relative_columns(2.0 ** np.arange(100), growing)
    assert np.isnan(flat["spx_correlation_60d"]).all() and np.nanmax(np.abs(flat["rel_spx"][:3] - (2 / 1.1) ** np.arange(3))) < 1e-12
    assert np.isnan(relative.relative_columns(close, np.full(120, np.nan))["rel_spx"]).all()
    assert len(relative.relative_columns(np.zeros(0), np.zeros(0))["rel_spx"]) == 0


def test_prior_bar_is_strictly_before(spark):
    from barloom.operators import coverage

    bars = spark.createDataFrame([(1, D(2026, 1, 2), 1.0), (1, D(2026, 1, 5), 2.0), (2, D(2026, 1, 5), 9.0)], "listing int, trading_date date, close double")
    asked = spark.createDataFrame([(1, D(2026, 1, 5)), (1, D(2026, 1, 6)), (1, D(2026, 1, 2)), (2, D(2026, 1, 5)), (3, D(2026, 1, 5))], "listing int, as_of date")
    got = {(r.listing, r.as_of.day): r.prior_close for r in coverage.prior_bar(bars, asked).collect()}
    assert got == {(1, 5): 1.0, (1, 6): 2.0, (1, 2): None, (2, 5): None, (3, 5): None}


def state(spark, rows):
    names = ["source_bars", "source_first", "source_last", "payload_last"] + [x for r in planning.COMPARED for x in (r, f"{r}_from")]
    kinds = "listing int, source_bars long, source_first date, source_last date, payload_last date" + "".join(f", {r} long, {r}_from date" for r in planning.COMPARED)
    return spark.createDataFrame([(i, *[own.get(n, 0 if n in planning.COMPARED else None) for n in names]) for i, own in rows.items()], kinds)


def test_affected_ranges_of_inactive_listings(spark):
    span = {"source_bars": 10, "source_first": D(2026, 1, 1), "source_last": D(2026, 1, 31)}
    rows = {
        1: span | {"payload_last": D(2026, 1, 20)},  # inactive, benchmark only: as far as it has rows
        2: span | {"payload_last": None},  # inactive without rows: nothing
        3: span | {"payload_last": D(2026, 1, 20), "missing": 1, "missing_from": D(2026, 1, 8)},  # inactive with a gap
        4: span | {"payload_last": D(2026, 1, 28)},  # active: behind the horizon rows are written again
        5: span | {"payload_last": D(2026, 1, 20), "tail_append": 2, "tail_append_from": D(2026, 1, 30)},  # beyond the horizon
        6: span | {"payload_last": D(2026, 1, 20), "version_drift": 1, "version_drift_from": D(2026, 1, 9)},
        7: {"source_bars": 0, "source_first": None, "source_last": None, "payload_last": None},
        8: span | {"payload_last": D(2026, 1, 5)},  # not supported
        9: span | {"payload_last": D(2026, 1, 25)},  # rebuilt
    }
    listings = spark.createDataFrame([(i, i not in (1, 2, 3), i not in (5, 6, 8, 9)) for i in rows], "listing int, active boolean, supported boolean")
    found = planning.affected_ranges(listings, state(spark, rows), "2026-01-25", "2026-01-06", "2026-01-10", [9])
    got = {r.listing: (r.write_start.day, r.write_end.day, r.reasons, r.calculation_start.day) for r in found.collect()}
    assert got == {
        1: (10, 20, "benchmark_drift", 1), 3: (8, 25, "missing,benchmark_drift", 1), 4: (10, 28, "benchmark_drift", 1), 6: (1, 25, "version_drift", 1), 9: (6, 25, "explicit_rebuild", 1),
    }


def test_readiness_needs_evidence_and_the_benchmark(spark):
    day = D(2026, 1, 5)
    jobs = {"EODDATA": "d", "YAHOO": "y"}
    index = '{"provider_code":"YAHOO","source_code":"yahoo_daily","outcome":"succeeded","scope":{"effective_date":"2026-01-05","tickers":%s},"report_outcome":"PASS"}'
    daily = '{"provider_code":"EODDATA","effective_date":"2026-01-05","failure_count":0,"missing_session_count":0,"report_outcome":"%s"}'
    at = dt.datetime(2026, 1, 6)
    runs = [("a", "d", day, "succeeded", at, daily % "FAIL"), ("b", "y", day, "succeeded", at, index % '["X"]'), ("c", "y", day, "succeeded", at, index % '["SPX"]'), ("e", "y", day, "failed", at, index % "[]"), ("f", "d", day, "succeeded", None, daily % "PASS")]
    listings = spark.createDataFrame([(1, "EODDATA"), (2, "STOOQ")], "listing int, provider string")
    bars = spark.createDataFrame([(1, day), (9, day)], "listing int, trading_date date")
    dates = spark.createDataFrame([(day,)], "effective_date date")
    runs = spark.createDataFrame(runs, "run_id string, job string, effective_date date, status string, completed_at timestamp, summary string")
    ask = lambda x, b: readiness.source_readiness(dates, x, bars, runs, jobs, b).first()
    row = ask(listings, 9)
    assert row.reasons == "EODDATA_SOURCE_EVIDENCE_MISSING" and row.yahoo_run_id == "c" and row.benchmark_bar and row.supported_bars == 1 and not row.ready
    assert ask(listings, 8).reasons == "EODDATA_SOURCE_EVIDENCE_MISSING,SPX_COVERAGE_INCOMPLETE"
    assert ask(listings, None).reasons == "BENCHMARK_UNAVAILABLE,EODDATA_SOURCE_EVIDENCE_MISSING"
    assert ask(listings.limit(0), 9).reasons == "NO_ELIGIBLE_LISTINGS"
    assert ask(listings.where("listing = 2"), 9).ready


def test_friendly_names_read_whole_texts(spark):
    rows = spark.createDataFrame([("*" * 200 + "Ünïcode Šárka",), ("???",), ("a" * 39 + " bcd",), (None,)], "t string")
    assert [r[0] for r in rows.select(text.friendly_name(F.col("t"))).collect()] == ["unicode_sarka", "untitled", "a" * 39, "untitled"]


def test_unknown_features_are_an_error(spark):
    with pytest.raises(ValueError, match="unknown"):
        readiness.model_inputs(spark.range(1), ["x"], {"y"}, F.lit(1), spark.range(1))


def test_audit_of_a_repeated_run_adds_nothing(spark):
    from barloom.operators import audit

    stored = spark.createDataFrame([(1, "a", None), (2, "b", 2.0)], "k int, x string, y double")
    incoming = spark.createDataFrame([(1, "a", None), (2, "c", None), (3, "d", 1.0)], stored.schema)
    rows = audit.audit_rows(incoming, stored, ["k"], ["x", "y"], "r", "thing")
    assert sorted((r.key, r.action, r.field or "", r.old, r.new) for r in rows.collect()) == [("2", "UPDATE", "x", "b", "c"), ("2", "UPDATE", "y", "2.0", None), ("3", "INSERT", "", None, '{"x":"d","y":1.0}')]
    assert audit.append_absent(rows, rows).count() == 0 and audit.append_absent(rows.limit(0), rows).count() == 3


def test_reports_and_settings():
    from decimal import Decimal

    from barloom import reports

    report = {"b": Decimal("1.50"), "a": [dt.date(2026, 1, 2), float("nan")], "c": {"z", "y"}}
    assert reports.json_text(report) == reports.json_text(dict(reversed(report.items())))
    assert '"b": "1.50"' in reports.json_text(report) and '"2026-01-02"' in reports.json_text(report)
    wanted = [reports.Setting("N", int, 5, 1), reports.Setting("ON", bool, False), reports.Setting("WAIT", "duration"), reports.Setting("WHICH", "list", [])]
    assert reports.read_settings(wanted, {"WAIT": "10m", "WHICH": "a, b,", "ON": "yes"}) == {"N": 5, "ON": True, "WAIT": 600, "WHICH": ["a", "b"]}
    with pytest.raises(ValueError, match="N is less than 1; ON is not true or false; WAIT is required"):
        reports.read_settings(wanted, {"N": "0", "ON": "maybe"})
