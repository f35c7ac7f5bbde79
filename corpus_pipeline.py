"""Corpus pipeline: stages over ``documents``, each written as Parquet and reread."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm import langid, packing, quality, queries, simhash
from barloom.llm.common import materialize, read_table

#: Texts whose best language has a smaller share of their letters are rejected.
MIN_LANGUAGE_SHARE = 0.3
#: Words of a shingle, and independent families of hashes, of the near-duplicate stage.
SHINGLE_WORDS, FAMILIES = 5, 3


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language stay: not ``und``, and a share of letters that is high enough.

    The model learns from all ``documents``, as the query of the operator does.
    """
    model = queries.op8_language_model(read_table(spark, sf_dir, "documents"))
    found = langid.identify(docs, model, with_spans=False)
    kept = found.where((F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= MIN_LANGUAGE_SHARE))
    return kept.select(docs.columns)


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted to be of quality stay; without any label all do."""
    model = queries.op4_quality_model(spark, sf_dir)
    if not len(model.labels):
        return docs
    return quality.classify(docs, model).where("predicted = 1").select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays: the one with the smallest id."""
    return simhash.representatives(docs, width=SHINGLE_WORDS, families=FAMILIES)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in windows of 4,096 tokens."""
    return packing.pack(docs)


STAGES = [("language", language), ("quality", quality_filter), ("near_dedup", near_dedup), ("packing", pack)]

#: No stage is expressible in SQL; tests compare each with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
