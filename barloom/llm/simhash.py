"""SimHash near-duplicate groups by meet-in-the-middle ball hashing.

Two fingerprints that differ in at most ``radius`` bits share a variant within
``radius / 2`` flips of both, and two fingerprints that share such a variant
differ in at most ``radius`` bits.  So every fingerprint emits its whole ball of
half the radius (2,081 variants of 64 bits for radius 4) and equal variants
link.  A ball is shuffled by the leading bits of its variants: a fingerprint is
sent once to each of the 137 leading 16-bit values that its ball has, and the
receiving task writes out the variants with that value.  No variant is left
out; only their transport is shared.  Leading values that too many fingerprints
share are replaced by longer ones, 16 bits at a time, up to whole variants.
"""

from __future__ import annotations

from itertools import accumulate, combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import field_types, map_batches, materialize
from .components import connected_components, local_roots

BITS = 64
#: Variants that a task holds at once.
BLOCK_VARIANTS = 2_000_000
#: Leading bits of variants that are shuffled by; a value with more than HOT_ROWS fingerprints takes STEP more.
STEP = 16
HOT_ROWS = 1_000_000

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_ODD = np.uint64(0x9E3779B97F4A7C15)


def shingle_hashes(text: bytes, width: int = 4, seed: int = 42) -> np.ndarray:
    """XXH64 of every shingle of ``width`` words, repeats included.

    A-Z are lower-cased; words are runs without space, tab, LF, VT, FF, CR.
    """
    import xxhash

    words = text.translate(_LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= width:
        return np.array([digest(joined, seed)], np.uint64)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[:-width]]
    return np.array([digest(joined[a : b - 1], seed) for a, b in zip(starts, ends[width - 1 :])], np.uint64)


def majority(hashes: np.ndarray) -> int:
    """The word whose bits are set in over half of ``hashes`` (0 for none)."""
    if not len(hashes):
        return 0
    bits = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 4096):
        part = hashes[at : at + 4096]
        bits += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    packed = np.packbits(bits * 2 > len(hashes), bitorder="little")
    return int(packed.view(np.int64)[0])


def rehashed(hashes: np.ndarray, n: int) -> np.ndarray:
    """The ``n``-th independent set of hashes of the same shingles; the 0-th are the hashes themselves."""
    if not n:
        return hashes
    z = hashes + np.array([n], np.uint64) * _ODD
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, seed: int = 42) -> DataFrame:
    """(doc_id, fp): the signed 64-bit fingerprint of each whole text; a text's hashes are in memory at once."""
    return with_fingerprints(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), width, seed).drop("text")


def with_fingerprints(rows: DataFrame, width: int, seed: int, families: int = 1) -> DataFrame:
    """``rows`` without their ``text``, with ``fp``, and ``fp1``, ``fp2`` ... of further families of hashes."""
    kept, names = [c for c in rows.columns if c != "text"], ["fp", *(f"fp{i}" for i in range(1, families))]

    def run(batches):
        for batch in batches:
            made = np.zeros((families, batch.num_rows), np.int64)
            for i, text in enumerate(batch.column("text").cast(pa.binary()).to_pylist()):
                if text:
                    hashes = shingle_hashes(text, width, seed)
                    for n in range(families):
                        made[n, i] = majority(rehashed(hashes, n))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *map(pa.array, made)], [*kept, *names])

    return map_batches(rows, run, field_types(rows, kept) + "".join(f", {n} long" for n in names))


def ball_masks(bits: int, radius: int) -> np.ndarray:
    """All words of ``bits`` bits with at most ``radius`` bits set."""
    out = [sum(1 << i for i in flips) for r in range(radius + 1) for flips in combinations(range(bits), r)]
    return np.array(out, np.uint64)


def _variants(key: np.ndarray, fp: np.ndarray, low_bits: int, half: int):
    """(variant, index of its fingerprint) for the variants whose leading bits are ``key``."""
    shift = np.uint64(low_bits)
    used = np.bitwise_count((fp >> shift) ^ key)
    start = (key << shift) | (fp & np.uint64((1 << low_bits) - 1))
    values, owners = [], []
    for flips in range(half + 1):
        rows = np.flatnonzero(used == flips)
        masks = ball_masks(low_bits, half - flips)
        step = max(1, BLOCK_VARIANTS // len(masks))
        for at in range(0, len(rows), step):
            own = rows[at : at + step]
            values.append((start[own][:, None] ^ masks[None, :]).ravel())
            owners.append(np.repeat(own, len(masks)))
    return np.concatenate(values), np.concatenate(owners)


def _collisions(values: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Chains of owners that share a value, as edges."""
    ordered = np.sort(values)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    table = np.zeros(1 << 20, bool)
    table[(twice * _ODD) >> np.uint64(44)] = True
    near = np.flatnonzero(table[(values * _ODD) >> np.uint64(44)])
    at = np.searchsorted(twice, values[near])
    near = near[twice[np.minimum(at, len(twice) - 1)] == values[near]]
    near = near[np.argsort(values[near], kind="stable")]
    same = values[near][1:] == values[near][:-1]
    return owners[near[:-1][same]], owners[near[1:][same]]


def _sizes(low_bits: int, half: int) -> np.ndarray:
    """Variants of a fingerprint within a key, by the flips that the key takes."""
    return np.array([sum(comb(low_bits, r) for r in range(half - flips + 1)) for flips in range(half + 1)])


def _near_rows(key: np.ndarray, fp: np.ndarray, low_bits: int, half: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows whose fingerprints share a variant, as edges; such fingerprints differ in at most twice ``half`` bits."""
    u, v = _collisions(*_variants(key, fp, low_bits, half))
    if (np.bitwise_count(fp[u] ^ fp[v]) > 2 * half).any():
        raise AssertionError("colliding variants of distant fingerprints")
    return u, v


def _to_roots(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprint, smallest linked fingerprint, as signed numbers) of the edges (u, v)."""
    nodes, roots = local_roots(u.view(np.int64), v.view(np.int64))
    moved = nodes != roots
    return nodes[moved].view(np.uint64), roots[moved].view(np.uint64)


def _unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the groups of the rows ``a`` and ``b``; ``label`` has the smallest row of each row's group, before and after."""
    while len(a):
        la, lb = label[a], label[b]
        differ = la != lb
        if not differ.any():
            return
        a, b, la, lb = a[differ], b[differ], la[differ], lb[differ]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while not np.array_equal(up := label[label], label):
            label[:] = up


def _unite_key(label: np.ndarray, own: np.ndarray, key: np.uint64, fp: np.ndarray, low_bits: int, half: int) -> None:
    """Join the rows ``own`` of ``label`` whose fingerprints ``fp`` share a variant that begins with ``key``.

    More variants than a block are done by the next four bits, one after another.
    The many pairs of a block are forgotten once they are in ``label``.
    """
    keys = np.full(len(fp), key)
    total = int(_sizes(low_bits, half)[np.bitwise_count((fp >> np.uint64(low_bits)) ^ keys)].sum())
    if total <= BLOCK_VARIANTS or low_bits < 4:
        u, v = _near_rows(keys, fp, low_bits, half)
        return _unite(label, own[u], own[v])
    del keys
    shift = np.uint64(low_bits - 4)
    for nibble in range(16):
        longer = (key << np.uint64(4)) | np.uint64(nibble)
        near = np.flatnonzero(np.bitwise_count((fp >> shift) ^ longer) <= half)
        if len(near):
            _unite_key(label, own[near], longer, fp[near], low_bits - 4, half)


def _key_links(key: np.ndarray, fp: np.ndarray, low_bits: int, half: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges between the fingerprints of whole keys: at most one a variant of a block, or fewer than rows.

    Rows with more variants than a block are done key by key, and then by the
    next four bits, so that memory is bounded, equal variants stay together, and
    each variant is made once.
    """
    total = int(_sizes(low_bits, half)[np.bitwise_count((fp >> np.uint64(low_bits)) ^ key)].sum()) if len(fp) else 0
    if total <= BLOCK_VARIANTS:
        u, v = _near_rows(key, fp, low_bits, half)
        return fp[u], fp[v]
    edge = np.flatnonzero(np.diff(key)) + 1
    if len(edge):
        middle = int(edge[np.argmin(np.abs(edge - len(key) // 2))])
        found = [_to_roots(*_key_links(key[x], fp[x], low_bits, half)) for x in (slice(0, middle), slice(middle, None))]
        return tuple(np.concatenate(x) for x in zip(*found))
    label = np.arange(len(fp))
    _unite_key(label, label.copy(), key[0], fp, low_bits, half)
    moved = np.flatnonzero(label != np.arange(len(fp)))
    return fp[moved], fp[label[moved]]


def block_links(key: np.ndarray, fp: np.ndarray, low_bits: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprint, smallest linked fingerprint) within whole keys; keys are sorted."""
    u, v = _to_roots(*_key_links(key, fp, low_bits, radius // 2))
    return u.view(np.int64), v.view(np.int64)


def _sent(fps: DataFrame, half: int) -> DataFrame:
    """(key, used, fp): each leading value of STEP bits in the fingerprint's ball, and the flips that it takes."""
    masks = F.array(*[F.struct(F.lit(int(m)).cast("long").alias("m"), F.lit(int(m).bit_count()).alias("used")) for m in ball_masks(STEP, half)])
    rows = fps.select("fp", F.explode(masks).alias("x"))
    return rows.select(F.shiftrightunsigned("fp", BITS - STEP).bitwiseXOR(F.col("x.m")).alias("key"), F.col("x.used").alias("used"), "fp")


def _refined(rows: DataFrame, low_bits: int, half: int) -> DataFrame:
    """``rows`` of keys that leave ``low_bits``, sent to all keys of STEP more bits."""
    masks = F.array(*[F.struct(F.lit(int(m)).cast("long").alias("m"), F.lit(int(m).bit_count()).alias("more")) for m in ball_masks(STEP, half)])
    rest = low_bits - STEP
    own = F.shiftrightunsigned("fp", rest).bitwiseAND(F.lit((1 << STEP) - 1))
    made = rows.select("key", "used", "fp", F.explode(F.filter(masks, lambda x: x["more"] + F.col("used") <= half)).alias("x"))
    return made.select(F.shiftleft("key", STEP).bitwiseOR(own.bitwiseXOR(F.col("x.m"))).alias("key"), (F.col("used") + F.col("x.more")).alias("used"), "fp")


def _hot_prefixes(fps: DataFrame, half: int, hot: int) -> list[int]:
    """Leading values that more than ``hot`` fingerprints are sent to, from a histogram of 65,536 bins."""
    found = fps.groupBy(F.shiftrightunsigned("fp", BITS - STEP).alias("top")).agg(F.count("*").alias("n")).collect()
    own = np.zeros(1 << STEP, np.int64)
    for row in found:
        own[row["top"]] = row["n"]
    at = np.arange(1 << STEP)
    sent = sum(own[at ^ int(m)] for m in ball_masks(STEP, half))
    return np.flatnonzero(sent > hot).tolist()


def _linked(rows: DataFrame, low_bits: int, radius: int) -> DataFrame:
    """Edges (a, b) of the fingerprints that meet in equal keys."""

    def run(batches):
        held_key, held_fp, rows = [], [], 0
        limit = BLOCK_VARIANTS // 16

        def flush(last):
            nonlocal held_key, held_fp, rows
            key, fp = np.concatenate(held_key), np.concatenate(held_fp)
            # the last key may go on in the next batch
            cut = len(key) if last else int(np.searchsorted(key, key[-1]))
            held_key, held_fp, rows = [key[cut:]], [fp[cut:]], len(key) - cut
            if cut:
                return block_links(key[:cut].view(np.uint64), fp[:cut].view(np.uint64), low_bits, radius)
            return np.empty(0, np.int64), np.empty(0, np.int64)

        for batch in batches:
            held_key.append(batch.column(0).to_numpy())
            held_fp.append(batch.column(1).to_numpy())
            rows += batch.num_rows
            if rows >= limit:
                a, b = flush(False)
                limit = max(BLOCK_VARIANTS // 16, 2 * rows)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])
        if rows:
            a, b = flush(True)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return map_batches(rows.select("key", "fp").repartition("key").sortWithinPartitions("key"), run, "a long, b long")


def links(fps: DataFrame, radius: int = 4, hot: int = HOT_ROWS) -> DataFrame:
    """Edges (a, b) that connect all distinct ``fp`` within ``radius`` bits.

    Transitive closure of the edges is the closure of "differs in at most
    ``radius`` bits"; an edge itself may join two ends of a chain.  ``radius``
    is even.  A key that more than ``hot`` fingerprints share is replaced by
    keys of 16 more bits, again and again; a key of all 64 bits is a variant,
    which at most a ball of distinct fingerprints has, so no task gets an
    unbounded group.
    """
    half = radius // 2
    rows, low_bits, out = _sent(fps, half), BITS - STEP, None
    top = _hot_prefixes(fps, half, hot)  # at most 65,536 numbers
    crowded = fps.sparkSession.createDataFrame([(k,) for k in top], "key long") if top else None
    while crowded is not None:
        if low_bits == BITS - STEP:
            crowded = F.broadcast(crowded)
        own = _linked(rows.join(crowded, "key", "left_anti"), low_bits, radius)
        out = own if out is None else out.unionByName(own)
        rows, low_bits = _refined(rows.join(crowded, "key", "left_semi"), low_bits, half), low_bits - STEP
        if low_bits == 0:
            break
        rows = materialize(rows, "crowded-keys")
        crowded = materialize(rows.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > hot).select("key"), "hot-keys")
        if crowded.isEmpty():
            crowded = None
    own = _linked(rows, low_bits, radius)
    return (own if out is None else out.unionByName(own)).distinct()


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, seed: int = 42, radius: int = 4) -> DataFrame:
    """One row per document: id, ``fp`` (signed 64 bit), ``component_id``.

    ``component_id`` is the smallest id reachable over links of fingerprints
    that differ in at most ``radius`` bits.  A null or empty text (no word) has
    fingerprint zero and links like any other.  Rows that repeat an id keep
    their own rows; a null id never becomes a component id unless all ids of
    its component are null.  No rows give no rows.  Columns other than the id
    and the text are ignored.
    """
    own = materialize(fingerprints(docs, id_col, text_col, width, seed), "fingerprints")
    firsts = materialize(own.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fingerprints")
    comps = materialize(connected_components(links(firsts, radius)), "components")
    rooted = firsts.join(comps.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_fp = rooted.join(least, "root").select("fp", "component_id")
    return own.join(by_fp, "fp", "left").select(F.col("doc_id").alias(id_col), "fp", "component_id")


def family_links(own: DataFrame, families: int, radius: int) -> DataFrame:
    """Edges (a, b) between ``fp`` values whose texts are linked in any family.

    A value of a further family stands for the smallest ``fp`` that it comes
    with, so its links and its own texts become edges between those.
    """
    out = links(materialize(own.select("fp").distinct(), "distinct-fingerprints"), radius)
    for name in (f"fp{i}" for i in range(1, families)):
        pairs = materialize(own.select("fp", F.col(name).alias("other")).distinct(), "fingerprint-pairs")
        first = pairs.groupBy("other").agg(F.min("fp").alias("first"))
        found = links(first.select(F.col("other").alias("fp")), radius)
        met = found.join(first.withColumnsRenamed({"other": "a", "first": "x"}), "a").join(first.withColumnsRenamed({"other": "b", "first": "y"}), "b")
        shared = pairs.join(first, "other").where("fp <> first").select(F.col("fp").alias("a"), F.col("first").alias("b"))
        out = out.unionByName(met.select(F.col("x").alias("a"), F.col("y").alias("b"))).unionByName(shared)
    return out


def representatives(docs: DataFrame, width: int = 4, seed: int = 42, radius: int = 4, families: int = 1) -> DataFrame:
    """The documents that stay when one of each group stays.  All columns are kept.

    With one family the groups are those of ``simhash_groups``; with more, texts
    are linked if their fingerprints are within ``radius`` bits in any of
    ``families`` independent families of hashes, which finds more of the pairs
    that one family misses.  Of each group exactly one row stays: the one with the
    smallest id, rows without an id after all others, and among rows of one id
    the one whose columns hash lowest.  So rows that share an id but not their
    group are decided one by one, and of rows that are equal in every column one
    stays.  Null and empty texts are a group with fingerprint zero.  No rows
    give no rows.
    """
    names = [F.col(f"`{c}`") for c in docs.columns]
    values = [*names, *[c.isNull() for c in names]]
    # 128 bits tell rows apart
    keyed = docs.withColumns({"__a": F.xxhash64(*values), "__b": F.xxhash64(F.lit(1), *values)})
    slim = keyed.select(F.col("doc_id").alias("id"), F.col("__a").alias("a"), F.col("__b").alias("b"), "text")
    own = materialize(with_fingerprints(slim, width, seed, families), "fingerprints")
    comps = connected_components(family_links(own, families, radius)).withColumnRenamed("node", "fp")
    # the first row of each fingerprint, then of each component
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "a", "b")).alias("first")
    of_fp = own.groupBy("fp").agg(first).join(comps, "fp", "left").select(F.coalesce("root", "fp").alias("root"), "first")
    stay = of_fp.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.a").alias("__a"), F.col("first.b").alias("__b"))
    return keyed.join(stay, ["__a", "__b"], "left_semi").dropDuplicates(["__a", "__b"]).select(*names)


def hex_fingerprint(fp):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
