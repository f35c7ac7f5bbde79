"""Language-model scores by deleted interpolation.

p(w | h) = a2(b) c(h, w) / c(h) + a1(b) c(w) / N + a0(b) / (V + 1), where b is the
bucket (power of two) of the context's frequency c(h).  The weights of each
bucket are learned by expectation-maximisation on the counts of held-out
training documents, with those documents deleted from the counts that make the
estimates.  The final estimates use all training documents.

Counts aren't joined word by word.  Each task packs its documents into batches
of token numbers; a batch asks for the counts of its distinct words and pairs,
and brings its own training counts, in one row for each range of key hashes.  A
range's task adds up all that it is brought and answers each batch in the
order of its keys.  A batch and its answers then score its documents alone, so a
frequent word costs each batch one key and no task sees an unbounded group.
Words and pairs are told apart by 63-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, map_batches, materialize, release
from .simhash import _LOWER

BATCH_TOKENS = 700_000
#: Tokens of the input for each range of key hashes.
RANGE_TOKENS = 1_500_000
#: Tasks of a shuffle by range or batch: one for each, up to this many; beyond it tasks take several, one after another.
MOST_TASKS = 50_000
CONTEXT_BUCKETS = 32
#: Held-out likelihoods are kept in bins of so many to a factor of ten.
BINS_PER_DECADE = 10
BINS = 160
ROUNDS = 60
END = b"\n"  # no word holds it
PRIOR = np.array([0.4, 0.5, 0.1])

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _squeeze(array: np.ndarray) -> bytes:
    """Whole numbers in the fewest bytes that hold the largest, compressed behind that number of bytes."""
    import zstandard

    kind = np.min_scalar_type(int(array.max(initial=0)))
    return bytes([kind.itemsize]) + zstandard.ZstdCompressor(level=1).compress(array.astype(kind).tobytes())


def _expand(data: bytes) -> np.ndarray:
    import zstandard

    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), f"<u{data[0]}")


BATCH_FIELDS = "batch long, held boolean, n_tokens long, train_tokens long, train binary, lengths binary, hashes binary, ids binary"


def batches_of(docs: DataFrame, train: Column, held: Column, batch_tokens: int = BATCH_TOKENS) -> DataFrame:
    """Rows of packed documents; held-out ones (for the weights) are in batches of their own."""
    kind = docs.schema["doc_id"].dataType

    def run(batches):
        import xxhash
        from pyspark import TaskContext

        from pyspark.sql.pandas.types import to_arrow_type

        task, made = TaskContext.get().partitionId() << 24, 0
        stores = {}

        def fresh():
            return {"known": {END: 0}, "ids": [], "lengths": [], "train": [], "docs": [], "n": 0}

        def emit(is_held, s):
            nonlocal made
            hashes = np.array([xxhash.xxh64_intdigest(w, 42) for w in s["known"]], np.uint64) & ~np.uint64(1)
            # equal hashes are one word
            distinct, place = np.unique(hashes, return_inverse=True)
            ids, lengths, flags = place.astype(np.uint32)[np.concatenate(s["ids"])], np.array(s["lengths"], np.int32), np.array(s["train"], np.uint8)
            row = [
                [s["docs"]], [task + made], [is_held], [len(ids)], [int(lengths[flags > 0].sum(dtype=np.int64))],
                [flags.tobytes()], [lengths.tobytes()], [distinct.tobytes()], [_squeeze(ids)],
            ]
            made += 1
            types = [pa.list_(to_arrow_type(kind)), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), *[pa.binary()] * 4]
            names = ["docs", "batch", "held", "n_tokens", "train_tokens", "train", "lengths", "hashes", "ids"]
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(row, types)], names)

        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            for doc, text, is_train, is_held in zip(batch.column(0).to_pylist(), texts, batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                s = stores.setdefault(bool(is_held), None) or fresh()
                stores[bool(is_held)] = s
                known = s["known"]
                words = text.translate(_LOWER).split() if text else []
                ids = [known.setdefault(w, len(known)) for w in words]
                ids.append(0)
                s["ids"].append(np.array(ids, np.uint32))
                s["lengths"].append(len(ids))
                s["train"].append(bool(is_train))
                s["docs"].append(doc)
                s["n"] += len(ids)
                if s["n"] >= batch_tokens:
                    yield emit(bool(is_held), s)
                    stores[bool(is_held)] = None
        for is_held, s in stores.items():
            if s and s["docs"]:
                yield emit(is_held, s)

    rows = docs.select("doc_id", "text", train.alias("t"), (train & held).alias("h"))
    return map_batches(rows, run, f"docs array<{kind.simpleString()}>, {BATCH_FIELDS}")


class Batch:
    """A row of ``batches_of``, unpacked."""

    def __init__(self, row):
        self.hashes = np.frombuffer(row["hashes"], np.uint64)
        self.ids = _expand(row["ids"]).astype(np.int64)
        self.lengths = np.frombuffer(row["lengths"], np.int32).astype(np.int64)
        self.train = np.frombuffer(row["train"], np.uint8) > 0
        self.starts = np.cumsum(self.lengths) - self.lengths

    def keys(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Sorted distinct keys (words even, pairs odd), and the key of each token, context and pair."""
        context = np.empty_like(self.ids)
        context[1:] = self.ids[:-1]
        context[self.starts] = self.ids[-1] if len(self.ids) else 0  # every document ends with the end token
        h, w = self.hashes[context], self.hashes[self.ids]
        h *= _A
        w *= _B
        h ^= (w << np.uint64(31)) | (w >> np.uint64(33))
        h *= _A
        h |= np.uint64(1)
        pairs, of = np.unique(h, return_inverse=True)
        del h, w
        keys = np.concatenate([self.hashes, pairs])
        order = np.argsort(keys, kind="stable")
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        return keys[order], place[self.ids], place[context], place[len(self.hashes) + of]


def _range_of(keys: np.ndarray, ranges: int) -> np.ndarray:
    """Range numbers, rising with the key."""
    return ((keys >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)


def key_counts(packed: DataFrame, ranges: int) -> DataFrame:
    """(batch, range, counts, held_counts, words): training counts of each batch's keys in a range.

    ``words``: distinct words of the training documents, on one row of each range.
    """

    def ask(batches):
        for rows in batches:
            for row in rows.to_pylist():
                b = Batch(row)
                keys, token, _, pair = b.keys()
                seen = np.repeat(b.train, b.lengths)
                counts = np.bincount(token[seen], minlength=len(keys)) + np.bincount(pair[seen], minlength=len(keys))
                at = np.searchsorted(_range_of(keys, ranges), np.arange(ranges + 1))
                cut = [(int(r), at[r], at[r + 1]) for r in np.flatnonzero(at[:-1] < at[1:])]
                made = [
                    pa.array([r for r, _, _ in cut], pa.int32()),
                    pa.array([row["batch"]] * len(cut), pa.int64()),
                    pa.array([row["held"]] * len(cut)),
                    pa.array([keys[i:j].tobytes() for _, i, j in cut], pa.binary()),
                    pa.array([_squeeze(counts[i:j]) for _, i, j in cut], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(made, ["range", "batch", "held", "keys", "counts"])

    def answer(rows: pd.DataFrame) -> pd.DataFrame:
        keys = [np.frombuffer(x, np.uint64) for x in rows["keys"]]
        distinct, of = np.unique(np.concatenate(keys), return_inverse=True)
        total, held, at = np.zeros(len(distinct), np.int64), np.zeros(len(distinct), np.int64), 0
        for k, counts, is_held in zip(keys, rows["counts"], rows["held"]):
            mine, counts = of[at : at + len(k)], _expand(counts).astype(np.int64)  # a batch has a key once
            at += len(k)
            total[mine] += counts
            if is_held:
                held[mine] += counts
        out, at = [], 0
        for k, is_held in zip(keys, rows["held"]):
            mine = of[at : at + len(k)]
            at += len(k)
            out.append((_squeeze(total[mine]), _squeeze(held[mine]) if is_held else b""))
        words = np.zeros(len(rows), np.int64)
        words[0] = int(((distinct & np.uint64(1)) == 0)[total > 0].sum())
        made = {"batch": rows["batch"], "range": rows["range"], "counts": [x for x, _ in out], "held_counts": [x for _, x in out], "words": words}
        del keys, distinct, of, total, held
        release()
        return pd.DataFrame(made)

    columns = packed.select("batch", "held", "train", "lengths", "hashes", "ids")
    asked = map_batches(columns, ask, "range int, batch long, held boolean, keys binary, counts binary")
    # as many tasks as ranges, so that a task's input doesn't grow with the corpus
    dealt = asked.repartition(min(ranges, MOST_TASKS), "range").groupBy("range")
    return dealt.applyInPandas(answer, "batch long, range int, counts binary, held_counts binary, words long")


def _gather(rows: pd.DataFrame, column: str) -> np.ndarray:
    parts = [_expand(x).astype(np.float64) for x in rows.sort_values("range")[column]]
    return np.concatenate(parts) if parts else np.empty(0)


def _by_batch(packed: DataFrame, counts: DataFrame, batches: int):
    """Batches with their answers, as many tasks as batches."""
    tasks = min(batches, MOST_TASKS)
    return packed.repartition(tasks, "batch").groupBy("batch").cogroup(counts.repartition(tasks, "batch").groupBy("batch"))


def _bucket(context: np.ndarray) -> np.ndarray:
    return np.minimum(np.floor(np.log2(np.maximum(context, 0.5))).astype(np.int64) + 1, CONTEXT_BUCKETS - 1)


def _estimates(token, context, pair, n_tokens) -> tuple[np.ndarray, np.ndarray]:
    p2 = np.divide(pair, context, out=np.zeros_like(pair), where=context > 0)
    return p2, token / max(n_tokens, 1)


def held_out_bins(packed: DataFrame, counts: DataFrame, tokens: int, batches: int) -> DataFrame:
    """(bucket, i2, i1, n): held-out tokens by binned estimates, from counts without the held-out documents.

    A bin is a tenth of a power of ten, so the weights are learned from
    likelihoods that are exact to 13 %, whatever the size of the corpus.
    """

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = [np.zeros((0, 4), np.int64)]
        for _, row in left.iterrows():
            _, token, context, pair = Batch(row).keys()
            rest = _gather(right, "counts") - _gather(right, "held_counts")
            p2, p1 = _estimates(rest[token], rest[context], rest[pair], tokens)
            i2, i1 = (np.where(p > 0, np.minimum(np.floor(-np.log10(np.maximum(p, 1e-300)) * BINS_PER_DECADE), BINS - 1), BINS).astype(np.int64) for p in (p2, p1))
            code, n = np.unique((_bucket(rest[context]) * (BINS + 1) + i2) * (BINS + 1) + i1, return_counts=True)
            out.append(np.stack([code // (BINS + 1) ** 2, code // (BINS + 1) % (BINS + 1), code % (BINS + 1), n], axis=1))
            del token, context, pair, rest, p2, p1, i2, i1
            release()
        return pd.DataFrame(np.concatenate(out), columns=["bucket", "i2", "i1", "n"])

    own = packed.where("held")
    answers = counts.join(own.select("batch"), "batch", "left_semi")
    found = _by_batch(own, answers, batches).applyInPandas(run, "bucket long, i2 long, i1 long, n long")
    return found.groupBy("bucket", "i2", "i1").agg(F.sum("n").alias("n"))


def learn_weights(bins: pd.DataFrame, words: int, rounds: int = ROUNDS) -> np.ndarray:
    """Weights (a2, a1, a0) of each context bucket, by expectation-maximisation.

    Buckets with little evidence lean on ``PRIOR``; no weight of the uniform
    part is 0, so every token has a probability.
    """
    weights = np.tile(PRIOR, (CONTEXT_BUCKETS, 1))
    if len(bins):
        bucket, n = bins["bucket"].to_numpy(np.int64), bins["n"].to_numpy(np.float64)
        p = np.zeros((len(bins), 3))
        for at, name in enumerate(("i2", "i1")):
            i = bins[name].to_numpy(np.float64)
            p[:, at] = np.where(i < BINS, 10 ** (-(i + 0.5) / BINS_PER_DECADE), 0)
        p[:, 2] = 1 / (words + 1)
        for _ in range(rounds):
            joint = weights[bucket] * p
            joint *= (n / joint.sum(axis=1))[:, None]
            mass = np.stack([np.bincount(bucket, joint[:, k], CONTEXT_BUCKETS) for k in range(3)], axis=1) + PRIOR
            weights = mass / mass.sum(axis=1, keepdims=True)
    weights[0, 0] = 0  # an unseen context says nothing
    weights = np.maximum(weights, [0, 0, 1e-4])
    return weights / weights.sum(axis=1, keepdims=True)


def score(docs: DataFrame, train: Column, held: Column, batch_tokens: int = BATCH_TOKENS, range_tokens: int = RANGE_TOKENS) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score of each document.

    ``train`` says which documents are learned from and ``held`` which of those
    the weights are learned on.  A null text is empty: its one token is the end.
    Tokens are the words (A-Z lower-cased, split at ASCII white space) and the
    end; ``base_score`` is the add-0.1 unigram log10 probability and ``score``
    the model's.  Rows that repeat an id count as documents of their own.
    Without a training document every token has the uniform probability 1.  No
    rows give no rows; other columns are ignored.  A text is scored in one
    piece: a task needs about 100 bytes for each token of the longest.
    """
    bound_batches(docs.sparkSession)
    packed = materialize(batches_of(docs, train, held, batch_tokens), "lm-batches")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    own = F.when(F.col("held"), F.col("train_tokens"))
    sizes = packed.agg(total("n_tokens"), total("train_tokens"), total(own), F.count("*"), F.count(own)).first()
    all_tokens, train_tokens, held_tokens, batches, held_batches = map(int, sizes)
    counts = materialize(key_counts(packed, max(4, -(-all_tokens // range_tokens))), "lm-counts")
    words = int(counts.agg(F.coalesce(F.sum("words"), F.lit(0))).first()[0])
    weights = learn_weights(held_out_bins(packed, counts, train_tokens - held_tokens, max(1, held_batches)).toPandas(), words)
    kind = docs.schema["doc_id"].dataType.simpleString()

    names = ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, row in left.iterrows():
            b = Batch(row)
            _, token, context, pair = b.keys()
            c = _gather(right, "counts")
            own, before = c[token], c[context]
            p2, p1 = _estimates(own, before, c[pair], train_tokens)
            bucket = _bucket(before)
            p2 *= weights[bucket, 0]
            p1 *= weights[bucket, 1]
            model = np.log10(p2 + p1 + weights[bucket, 2] / (words + 1))
            del p2, p1, bucket, before
            base = np.log10((own + 0.1) / (train_tokens + 0.1 * (words + 1)))
            if not train_tokens:
                model = np.zeros_like(base)
            add = lambda x: np.add.reduceat(x, b.starts)  # noqa: E731  every document has a token
            made = (list(row["docs"]), b.lengths, add((own > 0).astype(np.int64)), train_tokens, add(base), add(model))
            out.append(pd.DataFrame(dict(zip(names, made))))
            del b, token, context, pair, c, own, base, model
            release()
        return pd.concat(out) if out else pd.DataFrame(columns=names)

    fields = f"doc_id {kind}, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return _by_batch(packed, counts, max(1, batches)).applyInPandas(run, fields)
