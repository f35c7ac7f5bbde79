"""Exact top-k inner products with a bit-sliced index.

Components become integers and are stored as bit slices: slice ``j`` of an
attribute is a bitmap over rows.  A query's score is a sum of shifted slices,
added with bitmap carry-save arithmetic on the leading ``kept`` bits of every
attribute.  Going from the most significant slice of the sum downward finds the
rows that can be among the best within the error of the bits left off; those
boundary rows are then scored exactly.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bound_batches

SCALE = 1024
#: Leading bits of each attribute that are sliced.
KEPT_BITS = 6
#: Rows of a block of candidates and queries of a block of queries.
BLOCK_ROWS = 16384
BLOCK_QUERIES = 4096


def pack_bits(flags: np.ndarray) -> np.ndarray:
    """Bitmap (uint64 words) of booleans along the last axis."""
    n = flags.shape[-1]
    flags = np.pad(flags, [(0, 0)] * (flags.ndim - 1) + [(0, -n % 64)])
    return np.packbits(flags, axis=-1, bitorder="little").view(np.uint64)


def unpack_bits(bitmap: np.ndarray, n: int) -> np.ndarray:
    return np.unpackbits(bitmap.view(np.uint8), bitorder="little", count=n).view(bool)


def signed_digits(value: int) -> list[tuple[int, int]]:
    """Non-adjacent form: (position, -1 or 1), fewest digits."""
    out, at = [], 0
    while value:
        if value & 1:
            digit = 2 - (value & 3)
            out.append((at, digit))
            value -= digit
        value >>= 1
        at += 1
    return out


class BitSlices:
    """Slices of the leading bits of integer rows (n x d)."""

    def __init__(self, rows: np.ndarray, kept: int = KEPT_BITS):
        self.rows = rows.astype(np.int64)
        self.n = len(rows)
        self.largest = max(abs(int(self.rows.min(initial=0))), abs(int(self.rows.max(initial=0))))
        low = self.rows.min(axis=0) if self.n else np.zeros(rows.shape[1], np.int64)
        # differences of 64-bit numbers fit into 64 bits without a sign
        above = self.rows.view(np.uint64) - low.view(np.uint64)
        span = int(above.max(initial=0)).bit_length()
        self.low, self.shift, self.bits = low, max(0, span - kept), max(1, min(span, kept))
        top = above >> np.uint64(self.shift)
        self.slices = pack_bits(np.stack([(top.T >> np.uint64(j)) & np.uint64(1) for j in range(self.bits)], axis=1).astype(bool))
        self.ones = pack_bits(np.ones(self.n, bool))
        self.inverse = self.slices ^ self.ones

    def sum_slices(self, query: np.ndarray) -> list[np.ndarray]:
        """Slices of sum(query * leading bits) plus a constant, from the least significant.

        A negative digit adds the complement, which shifts all sums by the same amount.
        """
        weights: list[list[np.ndarray]] = [[] for _ in range(160)]  # 64 bits of a query, the slices, and carries
        for d, value in enumerate(query.tolist()):
            for at, digit in signed_digits(value):
                source = self.slices[d] if digit > 0 else self.inverse[d]
                for j in range(self.bits):
                    weights[at + j].append(source[j])
        total, place = [], 0
        while place < len(weights) and any(weights[place:]):
            todo, carry = weights[place], weights[place + 1]
            while len(todo) > 2:  # carry-save adder: three bitmaps to a sum and a carry
                a, b, c = todo.pop(), todo.pop(), todo.pop()
                half = a ^ b
                todo.insert(0, half ^ c)
                carry.append((a & b) | (half & c))
            if len(todo) == 2:
                a, b = todo
                todo = [a ^ b]
                carry.append(a & b)
            total.append(todo[0] if todo else np.zeros_like(self.ones))
            place += 1
        return total

    def best(self, query: np.ndarray, k: int, barred: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """Rows that can be among the ``k`` best (all ties included), and their exact scores.

        Where 64 bits might not hold a sum, all rows are scored with whole numbers of any size.
        """
        if self.largest * max(map(abs, query.tolist()), default=0) * max(1, len(query)) >= 1 << 62:
            rows = np.flatnonzero(np.arange(self.n) != barred)
            return rows, self.rows[rows].astype(object) @ query.astype(object)
        alive = self.ones.copy()
        if barred >= 0:
            alive[barred >> 6] &= ~np.uint64(1 << (barred & 63))
        if k < int(np.bitwise_count(alive).sum()):
            slack = sum(map(abs, query.tolist())) * ((1 << self.shift) - 1) >> self.shift
            alive = self._at_least(self.sum_slices(query), alive, k, slack + 1)
        rows = np.flatnonzero(unpack_bits(alive, self.n))
        return rows, self.rows[rows] @ query

    def _at_least(self, total: list[np.ndarray], alive: np.ndarray, k: int, slack: int) -> np.ndarray:
        """Rows whose sum is within ``slack`` of the k-th largest sum."""
        # the k-th largest value, from the most significant slice downward
        sure, tied, value = np.zeros_like(alive), alive, 0
        for place in range(len(total) - 1, -1, -1):
            upper = tied & total[place]
            if int(np.bitwise_count(sure | upper).sum()) >= k:
                tied, value = upper, value | 1 << place
            else:
                sure, tied = sure | upper, tied & ~total[place]
        bound = value - slack
        if bound <= 0:
            return alive
        # rows >= bound, by comparing slices
        more, same = np.zeros_like(alive), alive
        for place in range(len(total) - 1, -1, -1):
            if bound >> place & 1:
                same = same & total[place]
            else:
                more, same = more | (same & total[place]), same & ~total[place]
        return (more | same) if bound.bit_length() <= len(total) else alive & ~alive


def quantise(vectors: DataFrame, id_col: str, vector_col: str, scale: int = SCALE) -> DataFrame:
    """(vec_id, q): floor(scale * x), 64 bits, of vectors without a null or non-finite component.

    A component that 64 bits don't hold is an error.
    """
    d = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    bad = F.exists(d, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    fine = F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & ~F.coalesce(bad, F.lit(True))
    beyond = F.raise_error(F.lit("a scaled component doesn't fit into 64 bits"))
    whole = lambda x: F.when(F.abs(x * scale) < float(1 << 62), F.floor(x * scale)).otherwise(beyond.cast("long"))
    return vectors.where(fine).select(F.col(id_col).cast("long").alias("vec_id"), F.transform(d, whole).alias("q"))


def top_k(vectors: DataFrame, is_query, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id, score: each query row's ``k`` best other rows.

    Score: inner product of floor(scale * component); ties go to the smaller id.
    ``is_query`` is a condition on the column ``vec_id``.  Vectors that are null
    or hold a null or non-finite component, and rows without an id, take no
    part; vectors of different lengths are not compared.  Rows that repeat an id
    are candidates of their own, but never candidates of that id's query, which
    is asked once.  Other columns are ignored.  Without queries or candidates
    there are no rows.  Queries are a stated set, met with all rows in blocks:
    each block of candidates is indexed once for each block of queries.  A score
    among the best that 64 bits don't hold is an error.
    """
    bound_batches(vectors.sparkSession)
    rows = quantise(vectors, id_col, vector_col, scale)
    sizes = rows.agg(F.count("*"), F.count(F.when(is_query, 1))).first()
    row_blocks, query_blocks = max(1, -(-sizes[0] // BLOCK_ROWS)), max(1, -(-sizes[1] // BLOCK_QUERIES))
    own = F.pmod(F.xxhash64("vec_id", "q"), F.lit(row_blocks)).cast("int")
    candidates = rows.withColumn("row_block", own).withColumn("query_block", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    asked = rows.where(is_query).dropDuplicates(["vec_id"]).withColumn("query_block", F.pmod(F.xxhash64("vec_id"), F.lit(query_blocks)).cast("int"))
    asked = asked.withColumn("row_block", F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1))))

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = [(np.empty(0, np.int64),) * 3]
        for size in left["q"].map(len).unique():
            part = left[left["q"].map(len) == size]
            index, ids = BitSlices(np.array(part["q"].tolist(), np.int64).reshape(len(part), size)), part["vec_id"].to_numpy()
            at = pd.Series(np.arange(len(ids)), index=ids)
            for query_id, q in zip(right["vec_id"], right["q"]):
                if len(q) != size:
                    continue
                same = np.atleast_1d(at.get(query_id, np.empty(0, np.int64)))
                found, scores = index.best(np.asarray(q, np.int64), k + max(0, len(same) - 1), int(same[0]) if len(same) else -1)
                scores, found = scores[ids[found] != query_id], ids[found[ids[found] != query_id]]
                if scores.dtype == object:
                    best = np.array(sorted(range(len(found)), key=lambda i: (-scores[i], found[i]))[:k], np.int64)
                else:
                    best = np.lexsort((found, -scores))[:k]
                out.append((np.full(len(best), query_id), found[best], scores[best]))
        made = [np.concatenate(x) for x in zip(*out)]
        made[2] = np.array(made[2].tolist(), np.int64)  # OverflowError if 64 bits don't hold a score
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), made)))

    partial = candidates.groupBy("row_block", "query_block").cogroup(asked.groupBy("row_block", "query_block")).applyInPandas(search, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return partial.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
