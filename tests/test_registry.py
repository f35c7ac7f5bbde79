"""Every query with SQL agrees with it on the smallest data; the entry runs; the package stands without the corpus part."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
SF = "/root/testdata/sf0.001"
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tools"))

from barloom import registry  # noqa: E402


def test_every_query_has_sql():
    assert set(registry.queries()) == set(registry.oracle_sql())


@pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")
def test_entry(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.count() > 0 and "rsi_14" in df.columns


#: One query of each kind; tools/compare.py runs them all.
SOME = [
    "affected_ranges", "source_readiness", "model_input_reasons", "model_inputs", "feature_coverage", "scan_quotes", "scan_symbols", "scan_chart", "scan_history_csv", "scan_fields_data",
    "scan_keyed_objects", "run_states", "stale_runs", "session_dates", "daily_measures", "object_cleanup", "published_runs", "stream_ingest", "audit_inserts", "evidence_coverage", "provenance_merge",
    "outcome_join", "prior_bar_asof", "friendly_name", "bar_validate", "bar_compare", "bm_features", "ti_streaks", "ti_dmi", "bm_alignment", "breadth", "move_buckets", "pull_ranges", "bar_upsert", "state_comparison", "published_view", "dup_classify", "confidence_score", "conflict_cik_name_variants", "duration_parse",
]


@pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")
@pytest.mark.parametrize("name", SOME)
def test_agrees_with_sql(spark, name):
    import compare

    result = compare.compare(spark, compare.connect(SF), SF, name, registry.queries()[name], registry.oracle_sql()[name])
    assert result.startswith("ok"), result


def test_imports_without_the_corpus_part(tmp_path):
    shutil.copytree(ROOT / "barloom", tmp_path / "barloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; assert e.queries() and set(e.oracle_sql()) == set(e.queries())"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=120, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)})
