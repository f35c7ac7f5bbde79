"""Packing into fixed windows by minimum bin slack.

What is left of each document after its full windows is only a length between 1
and the capacity, so the packing problem is a histogram with at most
``capacity`` entries, however many documents there are.  A plan over that
histogram is made once: take the longest remaining length, find by a bitset
subset-sum the multiset of other remaining lengths that comes closest to the
capacity, read its counts back from the bitsets, and repeat that pattern as
often as the counts allow.  Documents then look up their place by (length, rank
within the length); the ranks come from counts by (length, bucket), so a length
that a third of all documents have is spread over all tasks.
"""

from __future__ import annotations

import zlib
from collections import deque
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import batch_texts, map_batches, materialize
from .wordbpe import END_ID, worker_encoder

CAPACITY = 4096
BUCKETS = 256


def subset_sum(counts: np.ndarray, capacity: int) -> dict[int, int]:
    """The multiset of lengths (length -> how many) whose sum comes closest to ``capacity`` from below.

    ``counts[l]`` lengths ``l`` are there.  Bit ``s`` of the bitset says that
    some multiset sums to ``s``; lengths enter from long to short, in binary
    groups of their count, until the capacity itself is reached.
    """
    reach, full, steps = 1, (1 << (capacity + 1)) - 1, []
    for length in (np.flatnonzero(counts[1 : capacity + 1]) + 1)[::-1].tolist():
        left, group = min(int(counts[length]), capacity // length), 1
        while left:
            take = min(group, left)
            steps.append((length, take, reach))
            reach |= (reach << (take * length)) & full
            left, group = left - take, group * 2
        if reach >> capacity & 1:
            break
    at, used = reach.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> at & 1:
            used[length] = used.get(length, 0) + take
            at -= take * length
    return used


@dataclass
class Block:
    """Ranks [low, high) of the remainders of ``origin`` tokens, from token ``start`` on."""

    origin: int
    start: int
    low: int
    high: int


#: Columns of a plan: rank ``r`` of [low, high) has its ``length`` tokens from ``start`` on
#: in sequence ``first + t // each`` at ``offset + t % each * length``, where ``t = t0 + r - low``.
PLAN = ("origin", "start", "length", "low", "high", "first", "each", "t0", "offset")


def plan_windows(histogram: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Rows of ``PLAN`` that place every remainder; sequences are numbered from 0.

    Every window is filled to the capacity: where no multiset does, a piece as
    long as the slack is cut from the longest remainder not in the window.
    Tokens that no longer fill a window go to windows of powers of two.
    """
    counts = np.zeros(capacity + 1, np.int64)
    stock: list[deque[Block]] = [deque() for _ in range(capacity + 1)]
    for length, n in histogram.items():
        if not 1 <= length <= capacity:
            raise ValueError(f"no remainder has {length} tokens")
        if n:
            counts[length] += n
            stock[length].append(Block(length, 0, 0, n))
    plan, sequence = [], 0

    def draw(length: int, n: int):
        counts[length] -= n
        while n:
            block = stock[length][0]
            take = min(n, block.high - block.low)
            yield Block(block.origin, block.start, block.low, block.low + take)
            block.low += take
            if block.low == block.high:
                stock[length].popleft()
            n -= take

    def place(length: int, each: int, times: int, offset: int):
        t = 0
        for b in draw(length, each * times):
            plan.append((b.origin, b.start, length, b.low, b.high, sequence, each, t, offset))
            t += b.high - b.low

    while counts.any():
        longest = int(np.flatnonzero(counts)[-1])
        counts[longest] -= 1
        used = subset_sum(counts, capacity - longest) if longest < capacity else {}
        counts[longest] += 1
        used[longest] = used.get(longest, 0) + 1
        slack = capacity - sum(length * n for length, n in used.items())
        cut = 0
        if slack:
            left = counts.copy()
            for length, n in used.items():
                left[length] -= n
            cut = int(np.flatnonzero(left)[-1]) if left.any() else 0
            if not cut:
                break
        need = dict(used)
        if cut:
            need[cut] = need.get(cut, 0) + 1
        times = min(int(counts[length]) // n for length, n in need.items())
        offset = 0
        for length in sorted(used, reverse=True):
            place(length, used[length], times, offset)
            offset += length * used[length]
        if cut:
            t = 0
            for b in draw(cut, times):
                plan.append((b.origin, b.start, slack, b.low, b.high, sequence, 1, t, offset))
                t += b.high - b.low
                stock[cut - slack].append(Block(b.origin, b.start + slack, b.low, b.high))
            counts[cut - slack] += times
        sequence += times
    total = int(sum(length * int(counts[length]) for length in range(1, capacity + 1)))
    room, offset = 0, 0
    for length in np.flatnonzero(counts)[::-1].tolist():
        for b in list(draw(length, int(counts[length]))):
            for rank in range(b.low, b.high):
                at = b.start
                while at < b.start + length:
                    if not room:
                        room, offset = 1 << (total.bit_length() - 1), 0
                    take = min(room, b.start + length - at)
                    plan.append((b.origin, at, take, rank, rank + 1, sequence, 1, 0, offset))
                    at, room, offset, total = at + take, room - take, offset + take, total - take
                    sequence += not room
    return np.array(plan, np.int64).reshape(-1, len(PLAN))


def pieces(docs: DataFrame, capacity: int = CAPACITY, tokenizer_path: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Full windows and the remainder of each document, from one encoding of each text.

    ``row`` is unique and orders the pieces of a task.
    """

    def run(batches):
        from pyspark import TaskContext

        encoder, end = worker_encoder(tokenizer_path), int(end_id).to_bytes(4, "little")
        row = TaskContext.get().partitionId() << 36
        for batch in batches:
            at, starts, lengths, crcs, totals = [], [], [], [], []
            for i, own in enumerate(encoder.ids_of(batch_texts(batch))):
                ids = memoryview(own + end)
                n = len(ids) // 4
                for start in range(0, n, capacity):
                    stop = min(n, start + capacity)
                    at.append(i)
                    starts.append(start)
                    lengths.append(stop - start)
                    crcs.append(zlib.crc32(ids[4 * start : 4 * stop]))
                    totals.append(n)
            rows = pa.array(np.arange(row, row + len(at), dtype=np.int64))
            row += len(at)
            made = [batch.column(0).take(pa.array(at, pa.int64())), rows, *(pa.array(x, pa.int64()) for x in (starts, lengths, crcs, totals))]
            yield pa.RecordBatch.from_arrays(made, ["doc_id", "row", "start", "length", "ids_crc32", "doc_tokens"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs.select("doc_id", "text"), run, f"doc_id {kind}, row long, start long, length long, ids_crc32 long, doc_tokens long")


def ranked(found: DataFrame) -> DataFrame:
    """``found`` with ``rank``: 0, 1, ... within each length."""
    found = found.withColumn("bucket", F.pmod("row", F.lit(BUCKETS)))
    sizes = found.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("row")) - 1
    return found.withColumn("inside", inside).join(base, ["length", "bucket"]).withColumn("rank", F.col("base") + F.col("inside")).drop("bucket", "base", "inside")


def place(found: DataFrame, plan: np.ndarray) -> DataFrame:
    """One row for each planned part of each piece; ``whole`` says that it isn't cut.

    A plan has at most a few rows for each length up to the capacity, whatever
    the number of documents, so each task holds it.
    """
    spark = found.sparkSession
    order = np.lexsort((plan[:, 3], plan[:, 1], plan[:, 0]))
    shared = spark.sparkContext.broadcast(plan[order])

    def run(batches):
        rows = shared.value
        group = (rows[:, 0] << 13) | rows[:, 1]
        key = (group << 37) + rows[:, 3]
        for batch in batches:
            length, rank, start = (batch.column(n).to_numpy() for n in ("length", "rank", "start"))
            at, inside = np.arange(batch.num_rows), np.zeros(batch.num_rows, np.int64)
            out = []
            while len(at):
                hit = np.searchsorted(key, (((length[at] << 13) | inside) << 37) + rank[at], side="right") - 1
                got = rows[hit]
                t = got[:, 7] + rank[at] - got[:, 3]
                out.append((at, inside, got[:, 2], got[:, 5] + t // got[:, 6], got[:, 8] + t % got[:, 6] * got[:, 2]))
                inside = inside + got[:, 2]
                more = inside < length[at]
                at, inside = at[more], inside[more]
            if not out:
                continue
            at, inside, size, sequence, offset = (np.concatenate(x) for x in zip(*out))
            taken = batch.take(pa.array(at))
            made = [
                taken.column("doc_id"), pa.array(start[at] + inside), pa.array(size), taken.column("ids_crc32"), taken.column("doc_tokens"),
                pa.array(sequence), pa.array(offset), taken.column("start"), taken.column("length"),
            ]
            yield pa.RecordBatch.from_arrays(made, names)

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "piece_start", "piece_length"]
    kind = found.schema["doc_id"].dataType.simpleString()
    rows = found.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "rank")
    return map_batches(rows, run, f"doc_id {kind}, " + ", ".join(f"{n} long" for n in names[1:]))


def _cut_checksums(docs: DataFrame, cut: DataFrame, tokenizer_path: str | None, end_id: int) -> DataFrame:
    """Checksums of parts of pieces, from the few documents that are cut once more."""
    keys = ["piece_start", "piece_length", "ids_crc32", "start", "length"]
    wanted = cut.select("doc_id", *keys).distinct().withColumnRenamed("doc_id", "id")
    texts = docs.select("doc_id", "text").join(cut.select(F.col("doc_id").alias("id")).distinct(), F.col("doc_id").eqNullSafe(F.col("id")), "left_semi").distinct()
    both = texts.join(wanted, F.col("doc_id").eqNullSafe(F.col("id"))).select("doc_id", "text", *keys)

    def run(batches):
        encoder, end = worker_encoder(tokenizer_path), int(end_id).to_bytes(4, "little")
        for batch in batches:
            ps, pl, pc, ss, ls = (batch.column(n).to_pylist() for n in keys)
            at, crcs, last, ids = [], [], None, b""
            for i, text in enumerate(batch_texts(batch)):
                if text != last:
                    last, ids = text, memoryview(encoder.ids(text) + end)
                if len(ids) >= 4 * (ps[i] + pl[i]) and zlib.crc32(ids[4 * ps[i] : 4 * (ps[i] + pl[i])]) == pc[i]:
                    at.append(i)
                    crcs.append(zlib.crc32(ids[4 * ss[i] : 4 * (ss[i] + ls[i])]))
            taken = batch.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([taken.column(n) for n in ("doc_id", *keys)] + [pa.array(crcs, pa.int64())], ["id", *keys, "part_crc32"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(both, run, f"id {kind}, " + ", ".join(f"{k} long" for k in keys) + ", part_crc32 long").distinct()


def pack(docs: DataFrame, capacity: int = CAPACITY, tokenizer_path: str | None = None, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document's ids are its text's (null: the empty text's, none) and then
    ``end_id``; every id lies in exactly one piece.  Sequences hold at most
    ``capacity`` ids, are numbered from 0 and have no gap; all but the last few,
    whose sizes are powers of two, are full.  Rows that repeat an id are
    documents of their own.  No documents give no rows.  Other columns of
    ``docs`` are ignored.  A task holds the ids of one text at a time, however
    long it is.
    """
    found = materialize(pieces(docs, capacity, tokenizer_path, end_id), "pieces")
    histogram = {r[0]: r[1] for r in found.groupBy("length").count().collect()}  # at most ``capacity`` rows
    placed = materialize(place(ranked(found), plan_windows(histogram, capacity)), "placed")
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    whole, cut = placed.where("length = piece_length").select(columns), materialize(placed.where("length < piece_length"), "cut")
    parts = _cut_checksums(docs, cut, tokenizer_path, end_id)
    keys = ["piece_start", "piece_length", "ids_crc32", "start", "length"]
    on = F.col("doc_id").eqNullSafe(F.col("id"))
    for k in keys:
        on = on & (F.col(f"c.{k}") == F.col(f"p.{k}"))
    fixed = cut.alias("c").join(parts.alias("p"), on, "left").select("c.doc_id", "c.start", "c.length", F.col("part_crc32").alias("ids_crc32"), "c.doc_tokens", "c.sequence_id", "c.offset")
    return whole.unionByName(fixed)
