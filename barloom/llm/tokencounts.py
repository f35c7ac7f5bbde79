"""Exact token counts for every context limit from one length histogram."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import batch_texts, map_batches, materialize
from .wordbpe import worker_encoder

#: Lengths that share a range in the two-level sums.
RANGE = 256


def encoded_lengths(docs: DataFrame, tokenizer_path: str | None = None, added: int = 0) -> DataFrame:
    """(doc_id, n_tokens) of each whole text; ``added`` tokens go to each.  A null text has the length of the empty one."""

    def run(batches):
        encoder = worker_encoder(tokenizer_path)
        for batch in batches:
            n = np.array([len(ids) // 4 + added for ids in encoder.ids_of(batch_texts(batch))], np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n)], ["doc_id", "n_tokens"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs.select("doc_id", "text"), run, f"doc_id {kind}, n_tokens long")


def length_histogram(docs: DataFrame, tokenizer_path: str | None = None, added: int = 0) -> DataFrame:
    """(n_tokens, n_docs) of each length, combined before the shuffle and stored, so that texts are encoded once.

    Null and empty texts count with length ``added``; every row counts, also
    those that repeat an id or have none.  A text's length is never cut.  No
    rows give an empty histogram.
    """
    counts = encoded_lengths(docs, tokenizer_path, added).groupBy("n_tokens").agg(F.count("*").alias("n_docs"))
    return materialize(counts, "length-histogram")


def context_limits(histogram: DataFrame) -> DataFrame:
    """One row for each length that occurs, taken as a context limit.

    docs_within, tokens_within: documents of at most this length and their
    tokens; docs_beyond: longer ones; truncated_tokens: tokens that remain if
    every document is cut to the limit; quantile: share of documents within.
    Between two lengths the totals follow from the row below: truncated_tokens
    grows by docs_beyond for each further token.  Sums run within ranges of
    ``RANGE`` lengths and over the ranges' totals, so no task holds them all;
    the totals, a row for each ``RANGE`` lengths, are summed in one window.
    An empty histogram gives no rows.
    """
    h = histogram.withColumn("range", F.floor(F.col("n_tokens") / RANGE)).withColumn("tokens", F.col("n_tokens") * F.col("n_docs"))
    inner = Window.partitionBy("range").orderBy("n_tokens")
    upto = inner.rowsBetween(Window.unboundedPreceding, 0)
    ranges = h.groupBy("range").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    below = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select(
        "range",
        F.coalesce(F.sum("d").over(below), F.lit(0)).alias("d0"),
        F.coalesce(F.sum("t").over(below), F.lit(0)).alias("t0"),
        F.sum("d").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("all_docs"),
    )
    out = h.withColumn("d", F.sum("n_docs").over(upto)).withColumn("t", F.sum("tokens").over(upto)).join(ranges, "range")
    within, tokens = F.col("d0") + F.col("d"), F.col("t0") + F.col("t")
    beyond = F.col("all_docs") - within
    return out.select(
        F.col("n_tokens").alias("context_limit"),
        "n_docs",
        within.alias("docs_within"),
        tokens.alias("tokens_within"),
        beyond.alias("docs_beyond"),
        (tokens + beyond * F.col("n_tokens")).alias("truncated_tokens"),
        (within / F.col("all_docs")).alias("quantile"),
    )


def at_limit(limits: DataFrame, limit: int) -> DataFrame:
    """The row of any ``limit``, occurring or not; ``n_docs`` is 0 if it doesn't occur.

    Below the shortest text nothing is within, and every text is cut to the
    limit.  Without documents there is no row.
    """
    row = limits.agg(
        F.max_by(F.struct("context_limit", "n_docs", "docs_within", "tokens_within", "docs_beyond", "quantile"), F.when(F.col("context_limit") <= limit, F.col("context_limit"))).alias("below"),
        F.max("docs_within").alias("all_docs"),
    ).where("all_docs IS NOT NULL")
    value = lambda c, none: F.coalesce(F.col(f"below.{c}"), none)
    beyond, tokens = value("docs_beyond", F.col("all_docs")), value("tokens_within", F.lit(0).cast("long"))
    return row.select(
        F.lit(limit).cast("long").alias("context_limit"),
        F.when(F.col("below.context_limit") == limit, F.col("below.n_docs")).otherwise(F.lit(0).cast("long")).alias("n_docs"),
        value("docs_within", F.lit(0).cast("long")).alias("docs_within"),
        tokens.alias("tokens_within"),
        beyond.alias("docs_beyond"),
        (tokens + beyond * limit).alias("truncated_tokens"),
        value("quantile", F.lit(0.0)).alias("quantile"),
    )
