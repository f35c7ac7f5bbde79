"""The registered queries of the corpus operators: whole tables, production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import interpolated, langid, licenses, packing, quality, segmentation, simhash, spotsigs, tokencounts, topk
from .common import id_bucket, read_table


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.simhash_groups(read_table(spark, sf_dir, "documents"))
    return groups.select("doc_id", simhash.hex_fingerprint("fp").alias("fingerprint"), "component_id")


def op2_segmentation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four sampled segmentations of every text of ``documents`` and every turn of ``conversations``.

    The digest tells whether each decodes to its text.  Rows of documents have a
    ``doc_id``, those of conversations ``conv_id`` and ``turn``.
    """

    def sampled(name: str, keys: list[str]) -> DataFrame:
        rows = read_table(spark, sf_dir, name).withColumn("text", F.coalesce("text", F.lit("")))
        found = segmentation.sample_segmentations(rows, [*keys, "text"])
        return found.select(
            F.lit(name).alias("table"), *keys, "rank", F.size("ids").cast("long").alias("n_ids"), F.xxhash64("ids").alias("ids_hash"), "log_prob", "perturbed", "log_inclusion", (F.col("decoded") == F.col("text")).alias("decodes"),
        )

    return sampled("documents", ["doc_id"]).unionByName(sampled("conversations", ["conv_id", "turn"]), allowMissingColumns=True)


def op3_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.edited_fingerprints(read_table(spark, sf_dir, "documents"))


def op4_quality_model(spark: SparkSession, sf_dir: str) -> quality.Model:
    """Fitted on labels whose id's crc32 modulo 4 isn't 2."""
    seen = id_bucket(F.col("doc_id"), 4) != 2
    return quality.train(read_table(spark, sf_dir, "documents").where(seen), read_table(spark, sf_dir, "labels").where(seen))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.classify(docs, op4_quality_model(spark, sf_dir), keep=["doc_id"])
    return scored.withColumn("held_out", id_bucket(F.col("doc_id"), 4) == 2)


def op8_language_model(documents: DataFrame) -> langid.Model:
    """Learned from documents whose id's crc32 modulo 3 isn't 1."""
    return langid.train(documents.where(id_bucket(F.col("doc_id"), 3) != 1))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every text, and its labelled spans (language, first word, word after the last)."""
    docs = read_table(spark, sf_dir, "documents")
    found = langid.identify(docs.select("doc_id", "text"), op8_language_model(docs), keep=["doc_id"])
    return found.withColumn("held_out", id_bucket(F.col("doc_id"), 3) == 1)


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages by host and path; a page titled by a notice governs its directory."""
    path = licenses.url_path(F.col("url")).alias("path")
    pages = read_table(spark, sf_dir, "pages").select(F.col("page_id").alias("key"), path, F.col("html").alias("text"))
    return licenses.license_scan(pages, markup=True, headed_governs=True).withColumnRenamed("key", "page_id")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"))


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencounts.context_limits(tokencounts.length_histogram(read_table(spark, sf_dir, "documents")))


def op10_interpolated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learned from documents whose id's crc32 modulo 10 isn't 0; weights from those with remainder 1."""
    rest = id_bucket(F.col("doc_id"), 10)
    scored = interpolated.score(read_table(spark, sf_dir, "documents"), rest != 0, rest == 1)
    return scored.withColumn("held_out", rest == 0)


def queries() -> dict:
    own = (
        op1_simhash, op2_segmentation, op3_spotsigs, op4_quality, op5_licenses, op6_packing, op7_topk, op8_language, op9_token_counts, op10_interpolated,
    )
    return {f.__name__: f for f in own}


TOPK_SQL = """
WITH x AS (
    SELECT vec_id, list_transform(embedding, lambda c: CAST(floor(1024 * CAST(c AS DOUBLE)) AS BIGINT)) AS q
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
), p AS (
    SELECT a.vec_id AS query_id, b.vec_id,
           CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) AS BIGINT) AS score
    FROM x a JOIN x b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), r AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM p
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


def oracle_sql() -> dict[str, str]:
    return {"op7_topk": TOPK_SQL}
