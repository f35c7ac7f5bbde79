"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, store


def local_roots(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the edges (u, v) and the smallest node of each one's component."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    label = np.arange(len(nodes))
    while True:
        la, lb = label[a], label[b]
        differ = la != lb
        if not differ.any():
            return nodes, nodes[label]
        a, b, la, lb = a[differ], b[differ], la[differ], lb[differ]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label = up


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b of one orderable type).

    ``root`` is the smallest node reachable.  Each round is a large-star and a
    small-star step; minima are combined before the shuffle and joined back, so
    that a hub's edges are split by the skew join and never meet in one task.
    Rounds end when a round changes no edge; every round's edges are written to
    the shared folder, and those of the round before are deleted then.  Rows
    with a null end or two equal ends are ignored.  An edge table without rows
    gives no rows.
    """
    spark = edges.sparkSession

    def tidy(df: DataFrame) -> DataFrame:
        return df.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    def star(pairs: DataFrame, larger_only: bool) -> DataFrame:
        # pairs: (u, v).  Each v moves to the smallest of u and u's neighbours.
        least = pairs.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        moved = pairs.join(least, "u")
        if larger_only:
            return tidy(moved.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")))
        own = least.select(F.col("u").alias("a"), F.col("m").alias("b"))
        return tidy(moved.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(own))

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())

    def stored(df: DataFrame) -> tuple[DataFrame, str]:
        path = store(df, "edges")
        return spark.read.schema(df.schema).parquet(path), path

    now, at = stored(tidy(edges.select("a", "b")))
    seen = state(now)
    for _ in range(max_rounds):
        if not seen[0]:
            break
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = star(both, larger_only=True)
        small = star(large.select(F.col("a").alias("u"), F.col("b").alias("v")), larger_only=False)
        before = at
        now, at = stored(small)
        discard(spark, before)
        if (after := state(now)) == seen:
            break
        seen = after
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
