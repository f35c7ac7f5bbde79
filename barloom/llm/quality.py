"""Quality scores by nearest-neighbour voting in a latent-semantic space.

A text's terms are its words (hashed) and the shapes of its tokens, with a few
terms for repetition.  TF-IDF vectors of a bounded labelled sample give a
truncated SVD; the sample's latent vectors are broadcast, every document's
cosine with all of them is computed in blocks, and its nearest neighbours vote,
weighted by similarity.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import field_types, map_batches

WORD_TERMS = 1024
SHAPE_TERMS = 256
#: Terms for the share of repeated neighbours, of repeated lines and of distinct words, in bins.
BINS = 8
EXTRA_TERMS = 3 * BINS
TERMS = WORD_TERMS + SHAPE_TERMS + EXTRA_TERMS
#: Labelled rows that the classifier is fitted on at most (those whose ids hash lowest).
TRAINING_ROWS = 8192
LATENT = 32
NEIGHBOURS = 25
#: Weight of the word block beside the shape block of length one.
WORD_WEIGHT = 0.35
THRESHOLD = 0.7
#: Tokens whose terms a task keeps; longer ones than CACHED_CHARS are worked out each time.
CACHE_TOKENS = 100_000
CACHED_CHARS = 64
BLOCK_DOCS = 256

_REPEAT = re.compile(r"(.)\1+")


def shape(token: str) -> str:
    """Whole token with letters as A or a, digits as 0, and runs shortened: ``Word,,`` is ``Aa,``."""
    made = "".join("A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in token)
    return _REPEAT.sub(r"\1", made)


def distinct_share(slots: np.ndarray, window: int = 50) -> float:
    """Mean share of distinct tokens in windows, so that it doesn't fall with length; the last window may be shorter and weighs less."""
    n = len(slots)
    whole = n - n % window
    rows = np.sort(slots[:whole].reshape(-1, window), axis=1)
    distinct = (rows[:, 1:] != rows[:, :-1]).sum() + len(rows) + len(np.unique(slots[whole:]))
    return float(distinct / n)


class _Slots(dict):
    """Token to the slots of its word and shape; forgets all when it is full."""

    def __missing__(self, token: str) -> int:
        word = zlib.crc32(token.lower().strip(".,;:!?\"'()*#%&$|").encode("utf-8", "surrogatepass")) % WORD_TERMS
        slot = word * SHAPE_TERMS + zlib.crc32(shape(token).encode("utf-8", "surrogatepass")) % SHAPE_TERMS
        if len(token) <= CACHED_CHARS:
            if len(self) >= CACHE_TOKENS:
                self.clear()
            self[token] = slot
        return slot


class Terms:
    """Rows of term counts; slots of tokens are kept."""

    def __init__(self):
        self.slot = _Slots().__getitem__

    def row(self, text: str) -> np.ndarray:
        out = np.zeros(TERMS, np.float32)
        tokens = text.split()
        if not tokens:
            return out
        slots = np.fromiter(map(self.slot, tokens), np.int64, len(tokens))
        out[:WORD_TERMS] = np.bincount(slots // SHAPE_TERMS, minlength=WORD_TERMS)
        out[WORD_TERMS : WORD_TERMS + SHAPE_TERMS] = np.bincount(slots % SHAPE_TERMS, minlength=SHAPE_TERMS)
        n, lines = len(tokens), [x for x in text.split("\n") if x]
        shares = (float((slots[1:] == slots[:-1]).mean()) if n > 1 else 0.0, 1 - len(set(lines)) / len(lines) if lines else 0.0, distinct_share(slots))
        for i, share in enumerate(shares):
            out[WORD_TERMS + SHAPE_TERMS + i * BINS + min(BINS - 1, int(share * BINS))] = n / 4
        return out


def weigh(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF rows: words by log counts, shapes by the root of their share; each block of length one before weights."""
    words = np.log1p(counts[:, :WORD_TERMS]) * idf[:WORD_TERMS]
    words *= WORD_WEIGHT / np.maximum(np.linalg.norm(words, axis=1, keepdims=True), 1e-9)
    shapes = counts[:, WORD_TERMS:]
    shapes = np.sqrt(shapes / np.maximum(shapes.sum(axis=1, keepdims=True), 1e-9)) * idf[WORD_TERMS:]
    shapes /= np.maximum(np.linalg.norm(shapes, axis=1, keepdims=True), 1e-9)
    return np.concatenate([words, shapes], axis=1).astype(np.float32)


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)


@dataclass
class Model:
    idf: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    def scores(self, counts: np.ndarray, neighbours: int = NEIGHBOURS) -> np.ndarray:
        """Share of label 1 among the nearest vectors, weighted by cosine; the mean label if none is near.

        Vectors as near as the last of the ``neighbours`` vote too, so ties don't depend on an order.
        """
        if not len(self.labels):
            return np.full(len(counts), 0.5)
        near = unit(weigh(counts, self.idf) @ self.axes) @ self.vectors.T
        k = min(neighbours, near.shape[1])
        last = np.partition(near, -k, axis=1)[:, -k]
        weight = np.where(near >= np.maximum(last, 0)[:, None], near, 0)
        total = weight.sum(axis=1, dtype=np.float64)
        voted = (weight @ self.labels.astype(np.float32)) / np.maximum(total, 1e-12)
        return np.where(total > 1e-9, np.clip(voted, 0, 1), self.labels.mean())


def fit(counts: np.ndarray, labels: np.ndarray, latent: int = LATENT) -> Model:
    idf = (1 + np.log((1 + len(counts)) / (1 + (counts > 0).sum(axis=0)))).astype(np.float32)
    if not len(counts):
        return Model(idf, np.zeros((TERMS, 1), np.float32), np.zeros((0, 1), np.float32), labels)
    rows = weigh(counts, idf)
    gram = rows.T @ rows
    axes = np.linalg.eigh(gram)[1][:, ::-1][:, : min(latent, len(counts))].astype(np.float32)
    return Model(idf, axes, unit(rows @ axes), labels)


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", limit: int = TRAINING_ROWS) -> Model:
    """Fit on at most ``limit`` labelled rows of ``labels`` (doc_id, ``label_col``).

    Rows with a null id or label don't count; an id labelled more than once
    has its mean label.  ``docs`` are the rows that may be learned from.
    """
    own = labels.where(F.col("doc_id").isNotNull() & F.col(label_col).isNotNull())
    own = own.join(docs.select("doc_id"), "doc_id", "left_semi").groupBy("doc_id").agg(F.avg(label_col).alias("label"))
    sample = own.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)

    def run(batches):
        terms = Terms()
        for batch in batches:
            rows = [terms.row(t or "") for t in batch.column(0).to_pylist()]
            if rows:
                made = pa.array([r.tobytes() for r in rows], pa.binary())
                yield pa.RecordBatch.from_arrays([made, batch.column(1), batch.column(2)], ["counts", "label", "doc_id"])

    # one text of an id that several documents have: the one that hashes lowest
    chosen = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").groupBy("doc_id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    found = map_batches(chosen.select("text", "label", "doc_id"), run, f"counts binary, label double, doc_id {kind}").toPandas().sort_values("doc_id")
    counts = np.stack([np.frombuffer(x, np.float32) for x in found["counts"]]) if len(found) else np.zeros((0, TERMS), np.float32)
    return fit(counts, found["label"].to_numpy(np.float64))


def classify(docs: DataFrame, model: Model, keep: list[str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """``keep`` columns (default: all), ``score`` and ``predicted`` of each document.

    A null text scores as the empty one; a text without words has no neighbour
    and gets the mean label of the sample, and without any labelled row every
    score is 0.5.  ``predicted`` is 1 from ``threshold`` on.  Columns of these
    two names are replaced.  Documents that are equal or repeated score alike.
    No rows give no rows.
    """
    columns = [c for c in (keep or docs.columns) if c not in ("score", "predicted")]
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most TRAINING_ROWS x LATENT and TERMS x LATENT numbers

    def run(batches):
        model, terms = shared.value, Terms()
        for batch in batches:
            texts, scores = batch.column("text").to_pylist(), []
            for at in range(0, len(texts), BLOCK_DOCS):
                scores.append(model.scores(np.stack([terms.row(t or "") for t in texts[at : at + BLOCK_DOCS]])))
            scores = np.concatenate(scores) if scores else np.empty(0)
            made = [pa.array(scores, pa.float64()), pa.array((scores >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), *made], [*columns, "score", "predicted"])

    rows = docs.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*columns, "text"])])
    return map_batches(rows, run, f"{field_types(docs, columns)}, score double, predicted int")
