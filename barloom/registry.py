"""All registered queries of the engine with their SQL."""

from __future__ import annotations

from importlib import import_module

PLANS = ("feature_queries", "report_queries", "merge_queries", "planning_queries", "entity_queries", "source_queries")


def _plans():
    return [import_module(f"barloom.plans.{name}") for name in PLANS]


def flagship(spark, sf_dir):
    return queries()["ti_features"](spark, sf_dir)


def queries() -> dict:
    return {k: f for plan in _plans() for k, f in plan.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for plan in _plans() for k, s in plan.SQL.items()}
