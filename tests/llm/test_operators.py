"""Each operator against a brute-force version on awkward rows: nulls, empties, repeats, long texts, clashing columns."""

import collections
import hashlib
import itertools
import math
import random
import tracemalloc
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from barloom.llm import common, components, interpolated, langid, licenses, packing, quality, segmentation, simhash, spotsigs, tokencounts, topk, wordbpe

from .conftest import make, prose


def rows_of(df):
    return [r.asDict() for r in df.collect()]


# --- 1 SimHash ---


def slow_fingerprint(text, width=4):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words, now = [], ""
    for c in text + " ":
        if c in " \t\n\x0b\x0c\r":
            words, now = (words + [now], "") if now else (words, now)
        else:
            now += c
    if not words:
        return 0
    shingles = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def slow_components(fps, radius=4):
    least = list(range(len(fps)))
    changed = True
    while changed:
        changed = False
        for i, j in itertools.combinations(range(len(fps)), 2):
            if (fps[i] ^ fps[j]).bit_count() <= radius and least[i] != least[j]:
                least[i] = least[j] = min(least[i], least[j])
                changed = True
    return least


def test_simhash_groups(spark, docs, nothing):
    got = rows_of(simhash.simhash_groups(docs))
    want = [(r.doc_id, slow_fingerprint(r.text)) for r in docs.collect()]
    ids = [i for i, _ in want]
    roots = slow_components([f for _, f in want])
    best = {}
    for i, root in zip(ids, roots):
        best[root] = min([x for x in (best.get(root), i) if x is not None], default=None)
    expected = sorted(((i, f, best[r]) for (i, f), r in zip(want, roots)), key=str)
    assert sorted(((r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in got), key=str) == expected
    assert simhash.simhash_groups(nothing).count() == 0


def test_simhash_representatives_keep_columns_and_rows_without_id(docs, nothing):
    kept = simhash.representatives(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    # rows without an id come after all others: the null text belongs to the empty ones, of which 5 stays
    assert ids.count(None) == 1 and ids.count(9) == 1 and 1 in ids and 2 not in ids and 5 in ids and not {6, 7} & set(ids)
    assert simhash.representatives(nothing).count() == 0


def test_simhash_representatives_of_texts_that_share_an_id(spark):
    texts = [prose(i, 80) for i in range(4)]
    rows = [(1, texts[0], "en"), (1, texts[1], "de"), (2, texts[1], "en"), (2, texts[2], "en"), (2, texts[2], "en"), (None, texts[3], "en"), (None, texts[3], "de"), (3, None, "x"), (3, "x", None)]
    kept = sorted(((r.doc_id, r.text) for r in simhash.representatives(make(spark, rows)).collect()), key=str)
    assert kept == sorted([(1, texts[0]), (1, texts[1]), (2, texts[2]), (None, texts[3]), (3, None), (3, "x")], key=str)


def test_simhash_families_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    base = [prose(50 + i, 140).split() for i in range(6)]
    texts = [" ".join(w if rng.random() > p else w + "x" for w in own) for own in base for p in (0, 0, 0.004, 0.01, 0.02, 0.04)]
    rows = make(spark, [(i, t, "en") for i, t in enumerate(texts)] + [(98, None, "en"), (99, "", "en")])
    hashes = [simhash.shingle_hashes(t.encode(), 5) for t in [*texts, "", ""]]
    fps = [[simhash.majority(simhash.rehashed(h, n)) % (1 << 64) for n in range(3)] for h in hashes]
    least = list(range(len(fps)))
    for _ in least:
        for i, j in itertools.combinations(range(len(fps)), 2):
            if any((a ^ b).bit_count() <= 4 for a, b in zip(fps[i], fps[j])):
                least[i] = least[j] = min(least[i], least[j])
    ids = [*range(len(texts)), 98, 99]
    want = sorted(ids[i] for i in set(least))
    assert sorted(r.doc_id for r in simhash.representatives(rows, width=5, families=3).collect()) == want
    one = sorted(r.doc_id for r in simhash.representatives(rows, width=5).collect())
    assert set(want) <= set(one)


@pytest.mark.parametrize("hot", [3, 40, 10**6])
def test_links_of_crowded_keys_equal_brute_force(spark, hot):
    rng = np.random.default_rng(8)
    flips = lambda low, n: sum(1 << int(b) for b in rng.choice(np.arange(low, 64), n, replace=False))
    near = {flips(32, int(rng.integers(0, 3))) ^ flips(0, int(rng.integers(0, 3))) for _ in range(40)}
    fps = sorted({f ^ c for f in near for c in (0, 0xFFFF000000000000, 0x00000000FFFFFFFF)})
    df = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp long")
    found = rows_of(simhash.links(df, hot=hot))
    assert all((r["a"] ^ r["b"]) % (1 << 64) for r in found)
    u, v = (np.array([r[x] for r in found], np.int64) for x in ("a", "b"))
    nodes, roots = components.local_roots(u, v)
    found, least = dict(zip(nodes.tolist(), roots.tolist())), slow_components(fps)
    signed = [int(np.uint64(f).view(np.int64)) for f in fps]
    for (a, x), (b, y) in itertools.combinations(zip(signed, least), 2):
        assert (x == y) == (found.get(a, a) == found.get(b, b))


@pytest.mark.parametrize("block", [50_000, 4_000_000])
def test_ball_links_equal_brute_force(monkeypatch, block):
    monkeypatch.setattr(simhash, "BLOCK_VARIANTS", block)
    rng = np.random.default_rng(5)
    centre = rng.integers(0, 1 << 63, 6, dtype=np.uint64)
    fps = np.unique(np.concatenate([c ^ np.array([sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 4), replace=False)) for _ in range(20)], np.uint64) for c in centre]))
    top = simhash.ball_masks(16, 2)
    key = ((fps >> np.uint64(48))[:, None] ^ top[None, :]).ravel()
    own = np.repeat(fps, len(top))
    order = np.argsort(key, kind="stable")
    u, v = simhash.block_links(key[order], own[order], 48, 4)
    nodes, roots = components.local_roots(u, v) if len(u) else (np.empty(0, np.int64),) * 2
    found = dict(zip(nodes.tolist(), roots.tolist()))
    least = slow_components([int(f) for f in fps])
    groups = collections.Counter(least)
    assert len(set(found.values())) == sum(n > 1 for n in groups.values())
    assert len(found) == sum(n for n in groups.values() if n > 1)


def test_many_near_fingerprints_of_one_key_are_linked_in_bounded_memory(monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK_VARIANTS", 50_000)
    rng = np.random.default_rng(3)
    marks = np.uint64(1) << np.array([0, 3, 5, 9, 14, 20, 21, 27, 30, 33, 38, 41, 47], np.uint64)
    near = np.bitwise_xor.reduce(np.where(rng.random((4000, len(marks))) < 0.3, marks, np.uint64(0)), axis=1)
    far = np.array([0x555555555555, 0x555555555554], np.uint64)
    fp = rng.permutation(np.unique(np.concatenate([near, far])) | np.uint64(0xBEEF << 48))
    assert len(fp) > 1500
    tracemalloc.start()
    a, b = simhash.block_links(np.full(len(fp), 0xBEEF, np.uint64), fp, 48, 4)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 12e6  # pairs of near rows are about 1,177 a row, 16 bytes each
    linked, least = np.bitwise_count(fp[:, None] ^ fp[None, :]) <= 4, np.arange(len(fp))
    while (lower := np.where(linked, least[None, :], len(fp)).min(axis=1)).tolist() != least.tolist():
        least = lower
    found, signed = dict(zip(a.tolist(), b.tolist())), fp.view(np.int64).tolist()
    roots = [found.get(x, x) for x in signed]
    assert 1 < len(set(least.tolist())) == len(set(roots)) == len(set(zip(least.tolist(), roots)))


def test_connected_components_of_chain_and_hub(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (None, 3)]
    got = {r["node"]: r["root"] for r in rows_of(components.connected_components(spark.createDataFrame(edges, "a long, b long")))}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}}
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- 2 segmentations ---


def all_paths(lattices, units):
    """Probability of each path through the units."""

    def go(node, logp, path):
        for e in range(lattices.first[node], lattices.first[node + 1]):
            after, q = int(lattices.to[e]), logp + float(lattices.logq[e])
            yield from [((*path, e), q)] if after < 0 else go(after, q, (*path, e))

    out = {(): 0.0}
    for start in lattices.add(units).tolist():
        out = {(*p, *q): x + y for p, x in out.items() for q, y in go(start, 0.0, ())}
    return {k: math.exp(v) for k, v in out.items()}


@pytest.mark.parametrize("units", [["tion"], ["▁th", "\n", "▁an"]])
def test_gumbel_top_k_draws_without_replacement(units):
    pieces = segmentation.Pieces()
    lattices = segmentation.Lattices(pieces)
    p = all_paths(lattices, units)
    assert abs(sum(p.values()) - 1) < 1e-9
    n, first, pair, inclusion = 20_000, collections.Counter(), collections.Counter(), collections.defaultdict(float)
    starts, seeds = lattices.add(units * n), np.random.default_rng(1).integers(0, 1 << 63, n).astype(np.uint64)
    paths, bars = segmentation.sample_paths(lattices, starts, np.arange(n + 1) * len(units), 2, seeds)
    for found, bar in zip(paths, bars):
        assert len({tuple(e) for e, _, _ in found}) == 2 and found[0][2] >= found[1][2] >= bar
        assert all(abs(math.exp(logp) - p[tuple(e.tolist())]) < 1e-9 for e, logp, _ in found)
        first[tuple(found[0][0].tolist())] += 1
        for e, logp, _ in found:
            pair[tuple(e.tolist())] += 1
            inclusion[tuple(e.tolist())] += 1 / math.exp(segmentation._inclusion(logp, bar))
    for path, q in p.items():
        both = q + sum(p[o] * q / (1 - p[o]) for o in p if o != path)
        assert abs(first[path] / n - q) < 5 * math.sqrt(q / n) + 1e-3
        assert abs(pair[path] / n - both) < 5 * math.sqrt(both / n) + 1e-3
        assert q < 0.02 or abs(inclusion[path] / n - 1) < 0.1  # weighting by inclusion is unbiased
    everything, bar = segmentation.sample_paths(lattices, lattices.add(units), np.array([0, len(units)]), 999, seeds[:1])
    assert len(everything[0]) == len(p) and bar[0] == -math.inf


def test_samples_of_long_texts_have_the_right_probabilities():
    """A sampled path's mean log probability is the lattice's; samples don't depend on what shares the batch."""
    lattices = segmentation.Lattices(segmentation.Pieces())
    units = lattices.pieces.units(prose(3, 4000))
    expected = 0.0
    for unit, n in collections.Counter(units).items():
        p = all_paths(lattices, [unit])
        expected += n * sum(q * math.log(q) for q in p.values())
    starts = lattices.add(units)
    seeds = np.arange(200, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    paths, _ = segmentation.sample_paths(lattices, np.tile(starts, 200), np.arange(201) * len(units), 1, seeds)
    drawn = np.array([own[0][1] for own in paths])
    assert abs(drawn.mean() - expected) < 5 * drawn.std() / math.sqrt(len(drawn))
    alone, _ = segmentation.sample_paths(lattices, starts, np.array([0, len(units)]), 4, seeds[7:8])
    shared, _ = segmentation.sample_paths(lattices, np.tile(starts, 3), np.arange(4) * len(units), 4, seeds[6:9])
    assert [x[0].tolist() for x in alone[0]] == [x[0].tolist() for x in shared[1]]
    # units of many lengths, one without spaces among them
    long = "x" * 3000 + " " + "日本" * 500
    (edges, logp), = segmentation.best_texts([long], segmentation.Lattices(lattices.pieces, with_best=True))
    assert len(edges) and -1e5 < logp < 0


def test_best_segmentation_is_the_most_probable(spark, docs):
    lattices = segmentation.Lattices(segmentation.Pieces(), with_best=True)
    for units in (["▁tion"], ["▁harbour"], ["▁é日x"], ["\n"]):
        p = all_paths(lattices, units)
        _, edges = lattices.walk(lattices.add(units), lambda at, node, step: lattices.best[node])
        assert abs(p[tuple(edges.tolist())] - max(p.values())) < 1e-12
    made = segmentation.decode(segmentation.encode(docs.select("doc_id", "text", "rank")))
    assert made.columns == ["doc_id", "text", "rank", "ids", "log_prob", "decoded"]
    for r in rows_of(made):
        assert r["decoded"] == (r["text"] or "") and r["log_prob"] <= 0 and bool(r["ids"]) == bool(r["text"])
    assert segmentation.encode(docs.limit(0)).count() == 0


def test_segmentations_decode_and_are_seeded_by_key(spark, docs):
    turns = docs.select("doc_id", "text", "rank")
    a = sorted(map(str, rows_of(segmentation.sample_segmentations(turns, ["doc_id"], k=3))))
    assert a == sorted(map(str, rows_of(segmentation.sample_segmentations(turns.repartition(3), ["doc_id"], k=3))))
    texts = {r.doc_id: r.text or "" for r in turns.collect() if r.doc_id}
    pieces = segmentation.Pieces()
    assert segmentation.sample_segmentations(turns.limit(0), ["doc_id"]).count() == 0
    for r in rows_of(segmentation.sample_segmentations(turns.where("doc_id IS NOT NULL"), ["doc_id"], k=3)):
        assert r["decoded"] == texts[r["doc_id"]]
        if not texts[r["doc_id"]].startswith(" "):
            assert pieces.model.decode(r["ids"]) == r["decoded"]
        assert r["log_inclusion"] <= 0 and r["log_prob"] <= 1e-9


def test_segmentation_query_reads_documents_and_conversations(spark, docs, tmp_path):
    from barloom.llm import queries

    some = docs.where("doc_id IN (1, 5, 6, 14, 16)")
    some.write.parquet(f"{tmp_path}/documents.parquet")
    some.select(F.col("doc_id").alias("conv_id"), F.lit(2).alias("turn"), "text").write.parquet(f"{tmp_path}/conversations.parquet")
    got = rows_of(queries.op2_segmentation(spark, str(tmp_path)))
    for name, key in (("documents", "doc_id"), ("conversations", "conv_id")):
        own = [r for r in got if r["table"] == name]
        assert collections.Counter(r[key] for r in own) == {1: 4, 5: 1, 6: 1, 14: 4, 16: 4} and all(r["decodes"] for r in own)


# --- 3 SpotSigs ---


def test_spotsigs_edited_text_and_likeness(docs, nothing):
    rows = docs.where("doc_id IS NOT NULL").select("doc_id", "text", "rank", "length").dropDuplicates(["doc_id"])
    got = {r["doc_id"]: r for r in rows_of(spotsigs.edited_fingerprints(rows, buckets=4))}
    order = sorted((r.doc_id, r.text or "") for r in rows.collect())
    cut = lambda f: {f[i : i + 8] for i in range(0, len(f), 8)}
    for (i, text), (nxt, other) in zip(order, order[1:] + order[:1]):
        half = len(text) // 2
        edited, r = text[: len(text) - half] + other[:half], got[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        a, b, c = cut(r["fingerprint"]), cut(r["edited_fingerprint"]), cut(got[nxt]["fingerprint"])
        assert abs(r["near_edited"] - len(a & b) / len(a | b)) < 1e-12 and abs(r["near_next"] - len(a & c) / len(a | c)) < 1e-12
    assert got[1]["fingerprint"] == got[2]["fingerprint"] and got[1]["near_next"] == 1
    assert spotsigs.edited_fingerprints(nothing).count() == 0
    assert spotsigs.edited_fingerprints(docs).count() == docs.count()


def slow_signatures(text):
    """Signatures as words, from the rule in plain Python."""
    words = ["".join(own) for is_word, own in itertools.groupby((text or "").lower(), str.isalnum) if is_word]
    parts, part = [], []
    for w in words:
        if part and (w in spotsigs.ANCHORS or len(part) == spotsigs.RUN):
            parts, part = [*parts, part], []
        part = [*part, w]
    found = {" ".join(p[: spotsigs.CHAIN + 1]) for p in [*parts, part] if len(p) > 1}
    if not words:
        return {text or ""}
    return found | set(words) if len(words) <= spotsigs.SHORT else found or set(words)


def test_spotsigs_fingerprints_equal_brute_force(spark, docs):
    rows = docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    texts = {r.doc_id: r.text for r in rows.collect()}
    wanted = {i: slow_signatures(t) for i, t in texts.items()}
    hashed = spark.createDataFrame([(x,) for x in set().union(*wanted.values())], "x string").select("x", F.hash("x").alias("h"))
    h = {r.x: r.h % (1 << 32) for r in hashed.collect()}
    got = {r["doc_id"]: r for r in rows_of(spotsigs.edited_fingerprints(rows, buckets=3))}
    for i, own in wanted.items():
        assert {got[i]["fingerprint"][a : a + 8] for a in range(0, 8 * got[i]["n_signatures"], 8)} == {f"{h[x]:08x}" for x in own}
        assert len(got[i]["fingerprint"]) == 8 * len({h[x] for x in own})


def test_spotsigs_length_bound_prunes(spark):
    df = spark.createDataFrame([([1, 2, 3, 4], [1]), ([1, 2], [2, 3]), (None, [1])], "a array<int>, b array<int>")
    got = [r[0] for r in df.select(spotsigs.pruned_jaccard(F.col("a"), F.col("b"), 0.5)).collect()]
    assert got == [0.0, 1 / 3, 0.0]


def test_spotsigs_of_long_texts_of_anchors_only(spark):
    texts = ["the of and to " * 5, "le la les de " * 6, "", "the of and to " * 5 + "harbour"]
    got = [r for _, r in sorted((r["doc_id"], r) for r in rows_of(spotsigs.edited_fingerprints(make(spark, [(i, t, None) for i, t in enumerate(texts)]))))]
    assert [r["n_signatures"] for r in got] == [4, 4, 1, 1]
    assert got[0]["fingerprint"] != got[1]["fingerprint"] and got[0]["near_next"] == got[1]["near_next"] == 0
    assert got[1]["near_edited"] == 1  # the next text is empty, so half of the anchors stay
    empty = spark.createDataFrame([([], [])], "a array<int>, b array<int>")
    assert empty.select(spotsigs.pruned_jaccard(F.col("a"), F.col("b"))).first()[0] == 1


@pytest.mark.parametrize("hot", [2, 1000])
def test_spotsigs_near_sets_equal_brute_force(spark, docs, hot):
    base = [prose(i, 150).split() for i in range(4)]
    texts = [" ".join(w[:cut] + ["zebra"] * more) for w in base for cut, more in ((150, 0), (148, 0), (140, 2), (150, 30), (125, 0), (120, 1), (90, 0))]
    rows = docs.unionByName(make(spark, [(100 + i, t, "en") for i, t in enumerate(texts)]))
    members, pairs = spotsigs.near_sets(rows, hot=hot)
    sets = {r["set_id"]: frozenset(r["signatures"]) for r in rows_of(spotsigs.with_signatures(rows, "text", "signatures").withColumn("set_id", F.md5(spotsigs.as_text(F.col("signatures")))))}
    want = {frozenset(p): len(sets[p[0]] & sets[p[1]]) / len(sets[p[0]] | sets[p[1]]) for p in itertools.combinations(sets, 2)}
    want = {p: x for p, x in want.items() if x >= 0.8}
    found = rows_of(pairs)
    got = {frozenset((r["a"], r["b"])): r["likeness"] for r in found}
    assert len(got) == len(found) and len(want) > 5 and got == pytest.approx(want)
    assert members.count() == rows.count() and {r["set_id"] for r in rows_of(members)} == set(sets)


# --- 4 quality ---


def test_quality_votes_match_brute_force_and_separate(spark):
    rows = [(i, prose(i, 60), "en") for i in range(60)] + [(100 + i, " ".join(w.upper() + "!!" for w in prose(i, 60).split()), "en") for i in range(60)]
    docs = make(spark, rows)
    labels = spark.createDataFrame([(i, int(i < 100), 0) for i, _, _ in rows if i % 3] + [(None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    model = quality.train(docs, labels, limit=70)
    assert len(model.labels) == 70
    got = {r["doc_id"]: r for r in rows_of(quality.classify(docs, model))}
    terms = quality.Terms()
    for i, text, _ in rows:
        v = quality.unit(quality.weigh(terms.row(text)[None, :], model.idf) @ model.axes)[0]
        cosines = sorted((sum(float(a) * float(b) for a, b in zip(v, w)) for w in model.vectors), reverse=True)
        # those as near as the last of the neighbours vote, give or take rounding
        near = [(c, y) for c, y in zip((sum(float(a) * float(b) for a, b in zip(v, w)) for w in model.vectors), model.labels) if c >= cosines[quality.NEIGHBOURS - 1] - 1e-6]
        score = sum(max(s, 0) * y for s, y in near) / sum(max(s, 0) for s, _ in near)
        assert abs(got[i]["score"] - score) < 1e-3 and got[i]["predicted"] == int(i < 100)


def test_quality_terms_cover_whole_texts():
    spam = [f"w{i}" for i in range(51)] + ["buy"] * 48
    assert quality.distinct_share(np.arange(99)) == 1 and quality.distinct_share(np.array([hash(w) for w in spam])) < 0.6
    assert quality.distinct_share(np.array([1, 1, 1, 1])) == 0.25
    assert quality.shape("a" * 64 + "!1") == "a!0" and quality.shape("Word,,") == "Aa,"
    short, long = quality.Terms().row("x " * 10 + "b" * 70), quality.Terms().row("x " * 10 + "b" * 70 + "!")
    assert (short != long).any()


def test_quality_ties_do_not_depend_on_order():
    rng = np.random.default_rng(0)
    counts = np.zeros((60, quality.TERMS), np.float32)
    counts[:, :8] = np.repeat(rng.integers(1, 5, (2, 8)), 30, axis=0)
    labels = rng.integers(0, 2, 60).astype(np.float64)
    a, order = quality.fit(counts, labels), rng.permutation(60)
    b = quality.Model(a.idf, a.axes, a.vectors[order], a.labels[order])
    assert np.allclose(a.scores(counts, 5), b.scores(counts, 5), atol=1e-5)


def test_quality_awkward_rows(spark, docs, nothing):
    empty = spark.createDataFrame([], "doc_id long, quality int")
    none = quality.train(docs, empty)
    assert {r["score"] for r in rows_of(quality.classify(docs, none))} == {0.5}
    model = quality.train(docs, spark.createDataFrame([(1, 1), (4, 0), (12, 1), (12, 0)], "doc_id long, quality int"))
    got = rows_of(quality.classify(docs, model))
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 for r in got)
    assert quality.classify(docs, model).columns[:5] == docs.columns[:5]
    assert quality.classify(nothing, model).count() == 0


# --- 5 licences ---


def test_licenses_inherit_from_the_nearest_directory(spark):
    files = [
        ("a/LICENSE", "Released under the MIT License."), ("a/x.py", "print(1)"), ("a/b/LICENSE.txt", "intro\nLicensed under the Apache License, Version 2.0."), ("a/b/c/y.py", ""),
        ("a/b/z.py", "# Licensed under CC BY-NC 4.0."), ("q/w.py", None), (None, "Released under the MIT License."), ("LICENSE", "This work is licensed under the GNU General Public License, version 3."), ("a/x.py", "print(1)"),
    ]
    df = spark.createDataFrame([(i, p, t, "x", 1.0) for i, (p, t) in enumerate(files)], "key int, path string, text string, dir string, own_score double")
    got = {r["key"]: (r["own_license"], r["license"], r["inherited_from"], r["distance"]) for r in rows_of(licenses.license_scan(df))}
    assert got[1] == (None, "MIT", "a", 0) == got[8]
    assert got[3] == (None, "Apache-2.0", "a/b", 1)
    assert got[4] == ("CC-BY-NC-4.0", "CC-BY-NC-4.0", None, None)
    assert got[5] == (None, "GPL-3.0", "", 1)
    assert got[6][:2] == ("MIT", "MIT")
    assert licenses.license_scan(df.limit(0)).count() == 0


def test_license_cosine_matches_dense_vectors():
    matcher = licenses.Matcher(licenses.TEMPLATES, {"the": 50, "license": 3}, 100)
    vocabulary = sorted({t for own in licenses.TEMPLATES.values() for x in own for t in licenses.terms(x)})

    def dense(text):
        c = licenses.terms(text)
        return np.array([c[t] * matcher.idf[t] for t in vocabulary]), math.sqrt(sum((n * matcher.idf.get(t, matcher.other)) ** 2 for t, n in c.items()))

    for line in ("Released under the MIT License", "see the license file", "licensed under version 2.0 of something"):
        v, norm = dense(line)
        best = max((float(v @ w) / norm / wn, name) for name, own in licenses.TEMPLATES.items() for w, wn in map(dense, own))
        assert abs(matcher.best(line)[1] - best[0]) < 1e-9
    assert matcher.best("zzz") == (None, 0.0)


def test_license_notices_that_span_lines_or_hold_tags(spark):
    import textwrap

    notices = [(name, t) for name, own in licenses.TEMPLATES.items() for t in own]
    plain = [(f"{i}/a.py", "# x\n" + "\n".join("# " + x for x in textwrap.wrap(t, 40)) + "\n\nprint(1)\n") for i, (_, t) in enumerate(notices)]
    plain += [("sub/COPYING", textwrap.fill("Some Project, copyright its authors. " + notices[-1][1] + " Nothing else here.", 30)), ("sub/x.py", "print(2)")]
    df = spark.createDataFrame(plain, "path string, text string").withColumn("key", F.col("path"))
    got = {r["path"]: r["license"] for r in rows_of(licenses.license_scan(df))}
    assert [got[f"{i}/a.py"] for i in range(len(notices))] == [name for name, _ in notices]
    assert got["sub/COPYING"] == got["sub/x.py"] == notices[-1][0]
    pages = [
        ("CC-BY-4.0", "<p>Words before.</p><p>This work is licensed under a <a href='x'>Creative Commons <b>Attribution</b> 4.0 International License</a>.</p>"),
        ("Apache-2.0", "<div>Licensed under the <a>Apache License,\n Version 2.0</a>.</div><div>rest of it</div>"),
        ("MIT", "<p>Many other words of a long paragraph come first here. Released under the MIT License. And many more of them after it.</p>"), (None, "<p>Read the license.</p>"),
    ]
    df = spark.createDataFrame([(str(i), f"h/{i}", t) for i, (_, t) in enumerate(pages)], "key string, path string, text string")
    got = {r["key"]: r["own_license"] for r in rows_of(licenses.license_scan(df, markup=True))}
    assert [got[str(i)] for i in range(len(pages))] == [name for name, _ in pages]


def test_licenses_of_crowded_directories(spark):
    """Files of large and small directories inherit alike; without a path nothing does."""
    files = [("big/LICENSE", "Released under the MIT License.")] + [(f"big/f{i}", "x") for i in range(1500)] + [(f"big/d{i}/f", "y") for i in range(40)]
    files += [(f"none/f{i}", "x") for i in range(1200)] + [(None, "x")] * 30
    df = spark.createDataFrame([(i, p, t) for i, (p, t) in enumerate(files)], "key int, path string, text string")
    got = rows_of(licenses.license_scan(df))
    assert len(got) == len(files)
    for r in got:
        path = files[r["key"]][0]
        assert r["license"] == ("MIT" if (path or "").startswith("big/") else None)
        assert r["distance"] == (None if r["license"] is None or path == "big/LICENSE" else int("/d" in path))


# --- 6 packing ---


def slow_ids(text):
    from tokenizers import Tokenizer

    slow_ids.t = getattr(slow_ids, "t", None) or Tokenizer.from_file(wordbpe.vocabulary_path())
    return slow_ids.t.encode(text or "", add_special_tokens=False).ids + [2]


@pytest.mark.parametrize("capacity", [16, 64, 4096])
def test_packing_holds_every_id_once_without_padding(docs, capacity):
    got = rows_of(packing.pack(docs, capacity))
    want = collections.Counter((r.doc_id, zlib.crc32(np.array(slow_ids(r.text), "<u4").tobytes())) for r in docs.collect())
    texts = {}
    for r in docs.collect():
        texts.setdefault(r.doc_id, []).append(np.array(slow_ids(r.text), "<u4"))
    assert sum(r["length"] for r in got) == sum(len(x) for own in texts.values() for x in own)
    assert len(want)
    for r in got:
        assert any(len(x) == r["doc_tokens"] and zlib.crc32(x[r["start"] : r["start"] + r["length"]].tobytes()) == r["ids_crc32"] for x in texts[r["doc_id"]])
    pieces = collections.Counter()
    for r in got:
        for i in range(r["start"], r["start"] + r["length"]):
            pieces[r["doc_id"], r["doc_tokens"], i] += 1
    copies = collections.Counter((d, len(x)) for d, own in texts.items() for x in own)
    assert all(n == copies[d, total] for (d, total, _), n in pieces.items())
    sequences = {}
    for r in got:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert set(sequences) == set(range(len(sequences)))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at == capacity or at < capacity and at & (at - 1) == 0


def test_packing_of_nothing(nothing):
    assert packing.pack(nothing).count() == 0


def test_subset_sum_is_the_best(rng=np.random.default_rng(3)):
    for _ in range(40):
        counts = np.zeros(40, np.int64)
        for length in rng.integers(1, 40, 5):
            counts[length] += rng.integers(1, 3)
        items = [x for x in range(40) for _ in range(counts[x])]
        best = max(s for r in range(len(items) + 1) for c in itertools.combinations(items, r) if (s := sum(c)) <= 37)
        used = packing.subset_sum(counts, 37)
        assert sum(k * n for k, n in used.items()) == best and all(n <= counts[k] for k, n in used.items())


def test_plan_of_many_equal_lengths_is_small():
    for histogram in ({5: 10**9}, {3000: 10**9}, {4095: 7, 4096: 3, 1: 2}):
        plan = packing.plan_windows(histogram)
        assert len(plan) < 300
        placed = sum(int(r[2]) * int(r[4] - r[3]) for r in plan)
        assert placed == sum(k * n for k, n in histogram.items())


# --- 7 top-k ---


@pytest.mark.parametrize(("rows", "kept"), [(16384, 6), (40, 3)])
def test_topk_equals_brute_force(spark, monkeypatch, rows, kept):
    monkeypatch.setattr(topk, "BLOCK_ROWS", rows)
    rng = np.random.default_rng(1)
    vectors = [(i, rng.normal(0, 0.3, 8).tolist(), 0) for i in range(150)]
    vectors += [(200 + i, vectors[0][1], 0) for i in range(20)] + [(300, None, 0), (400, [0.1, None] + [0.0] * 6, 0), (401, [float("nan")] * 8, 0), (500, [float("inf")] + [0.0] * 7, 0), (None, [0.1] * 8, 0), (50, vectors[50][1], 1), (600, [0.5] * 3, 0), (601, [0.25] * 3, 0)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>, score int")
    got = {}
    for r in rows_of(topk.top_k(df, F.col("vec_id") % 50 == 0)):
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    kept_rows = [(i, np.floor(1024 * np.array(v, np.float32).astype(float)).astype(int)) for i, v, _ in vectors if i is not None and v is not None and None not in v and np.isfinite(v).all()]
    for q in {i for i, _ in kept_rows if i % 50 == 0}:
        own = next(v for i, v in kept_rows if i == q)
        best = sorted((-int(v @ own), i) for i, v in kept_rows if i != q and len(v) == len(own))[:10]
        assert sorted(got.get(q, [])) == [(k, i, -s) for k, (s, i) in enumerate(best, 1)]
    assert topk.top_k(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_topk_of_large_components(spark):
    big = float(1 << 33)
    vectors = [(0, [big, 1.0]), (1, [-big, 2.0]), (2, [1000.0, 3.0]), (3, [0.5, -0.25]), (4, [0.25, 1.0])]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
    got = rows_of(topk.top_k(df.where("vec_id <> 1"), F.col("vec_id") == 0))
    own = [int(math.floor(1024 * x)) for x in vectors[0][1]]
    want = sorted((-sum(int(math.floor(1024 * x)) * y for x, y in zip(v, own)), i) for i, v in vectors[2:])
    assert [(r["rank"], r["vec_id"], r["score"]) for r in sorted(got, key=lambda r: r["rank"])] == [(k, i, -s) for k, (s, i) in enumerate(want, 1)]
    plain = spark.createDataFrame([(0, [2097152.0]), (1, [0.5]), (2, [-3.0]), (3, [2097152.0])], df.schema)
    assert [r["score"] for r in rows_of(topk.top_k(plain, F.col("vec_id") == 0).orderBy("rank"))] == [1 << 62, 1 << 40, -3072 << 31]
    with pytest.raises(Exception, match="too large|too big|Overflow"):
        topk.top_k(df.union(spark.createDataFrame([(5, [big, 0.0])], df.schema)), F.col("vec_id") == 0).collect()
    with pytest.raises(Exception, match="64 bits"):
        topk.top_k(spark.createDataFrame([(0, [1e30]), (1, [1.0])], df.schema), F.col("vec_id") == 0).collect()


def test_signed_digits():
    for v in range(-2000, 2000, 7):
        digits = topk.signed_digits(v)
        assert sum(d << p for p, d in digits) == v and all(b - a > 1 for (a, _), (b, _) in zip(digits, digits[1:]))


# --- 8 language ---


def slow_viterbi(scores, penalty):
    best = [(s, (i,)) for i, s in enumerate(scores[0])]
    for row in scores[1:]:
        best = [max((v - (penalty if p[-1] != i else 0) + s, p[-1] == i, p + (i,)) for v, p in best)[::2] for i, s in enumerate(row)]
    return max(best)[0]


def test_viterbi_scores_equal_brute_force():
    rng = np.random.default_rng(2)
    lengths = np.array([1, 7, 3, 12, 7])
    starts = np.cumsum(lengths) - lengths
    scores = rng.normal(0, 5, (int(lengths.sum()), 3)).astype(np.float32)
    label = langid.viterbi(scores, starts, lengths, 4.0)
    for a, n in zip(starts, lengths):
        own, path = scores[a : a + n].astype(float), label[a : a + n]
        total = sum(own[t, path[t]] for t in range(n)) - 4.0 * sum(path[t] != path[t - 1] for t in range(1, n))
        assert abs(total - slow_viterbi(own.tolist(), 4.0)) < 1e-4


def test_language_of_awkward_rows(docs, nothing):
    model = langid.train(docs)
    assert model.languages == ["de", "en"]
    got = rows_of(langid.identify(docs, model))
    assert len(got) == docs.count()
    for r in got:
        text = r["text"] or ""
        if not any(c.isalpha() for c in text):
            assert (r["lang_pred"], r["score"], r["spans"] or []) == ("und", 0.0, r["spans"])
        else:
            assert r["lang_pred"] in ("de", "en") and 0 <= r["score"] <= 1
    by = {r["doc_id"]: r for r in got}
    assert by[1]["lang_pred"] == "en" and by[17]["lang_pred"] == "de"
    assert langid.identify(nothing, model).count() == 0
    assert {r["lang_pred"] for r in rows_of(langid.identify(docs, langid.train(nothing)))} == {"und"}


def test_spans_of_mixed_text(spark, docs):
    model = langid.train(docs)
    mixed = "the window of the quiet garden and the river " * 3 + "das haus und der garten sind nicht die stadt " * 3
    r = rows_of(langid.identify(make(spark, [(1, mixed, None)]), model))[0]
    spans = [(s["lang"], s["first"], s["stop"]) for s in r["spans"]]
    assert [s[0] for s in spans] == ["en", "de"] and spans[0][2] == spans[1][1] and abs(spans[0][2] - 27) <= 1


def test_scripts_narrow_candidates(docs):
    model = langid.train(docs)
    names, scores, _ = langid.label_texts(["日本語 текст", "", "日本語 the window of the garden"], langid.WordScores(model))
    assert names[0] in ("de", "en") and scores[0] == 0 and names[1] == "und" and names[2] == "en" and 0.5 < scores[2] < 1


def test_many_languages(spark):
    """More languages than a signed byte counts."""
    rng = np.random.default_rng(2)
    words = ["".join(map(chr, rng.integers(97, 123, 9))) for _ in range(400)]
    rows = [(i, " ".join([words[2 * i], words[2 * i + 1]] * 12), f"l{i:03d}") for i in range(200)]
    model = langid.train(make(spark, rows))
    assert len(model.languages) == 200
    names, _, spans = langid.label_texts([t for _, t, _ in rows], langid.WordScores(model))
    assert sum(a == b for a, (_, _, b) in zip(names, rows)) > 190 and all(s[0][1] == 0 and s[-1][2] == 24 for s in spans)


def test_spans_of_the_table_equal_those_of_texts(docs):
    model = langid.train(docs)
    scorer = langid.WordScores(model)
    for r in rows_of(langid.identify(docs, model)):
        (name,), (score,), (spans,) = langid.label_texts([r["text"] or ""], scorer)
        assert r["lang_pred"] == name and abs(r["score"] - score) < 1e-9
        assert [(s["lang"], s["first"], s["stop"]) for s in r["spans"]] == spans


# --- 9 token counts ---


def test_context_limits_equal_brute_force(docs, nothing):
    lengths = sorted(len(slow_ids(r.text)) - 1 for r in docs.collect())
    limits = tokencounts.context_limits(tokencounts.length_histogram(docs))
    got = {r["context_limit"]: r for r in rows_of(limits)}
    assert set(got) == set(lengths)
    for limit, r in got.items():
        within = [n for n in lengths if n <= limit]
        assert (r["docs_within"], r["tokens_within"], r["docs_beyond"]) == (len(within), sum(within), len(lengths) - len(within))
        assert r["truncated_tokens"] == sum(min(n, limit) for n in lengths) and abs(r["quantile"] - len(within) / len(lengths)) < 1e-12
    for limit in (0, 1, 7, 1000, 10**6, *lengths):
        (row,) = rows_of(tokencounts.at_limit(limits, limit))
        within = [n for n in lengths if n <= limit]
        assert row == {
            "context_limit": limit, "n_docs": lengths.count(limit), "docs_within": len(within), "tokens_within": sum(within), "docs_beyond": len(lengths) - len(within),
            "truncated_tokens": sum(min(n, limit) for n in lengths), "quantile": len(within) / len(lengths),
        }
    shifted = tokencounts.context_limits(tokencounts.length_histogram(docs, added=5))
    assert rows_of(tokencounts.at_limit(shifted, 3))[0]["truncated_tokens"] == 3 * len(lengths)
    assert tokencounts.at_limit(limits.limit(0), 5).count() == 0
    assert tokencounts.context_limits(tokencounts.length_histogram(nothing)).count() == 0


# --- 10 language model ---


def test_interpolated_counts_and_base_score(docs, nothing):
    rest = common.id_bucket(F.col("doc_id"), 10)
    got = rows_of(interpolated.score(docs, rest != 0, rest == 1, batch_tokens=500, range_tokens=400))
    words = []
    for r in docs.collect():
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in r.text or "")
        for c in "\t\n\x0b\x0c\r":
            text = text.replace(c, " ")
        words.append((r.doc_id, [w for w in text.split(" ") if w] + ["\n"]))
    bucket = lambda i: zlib.crc32(str("" if i is None else i).encode()) % 10
    c = collections.Counter(w for i, own in words if bucket(i) for w in own)
    n, v = sum(c.values()), len(c)
    want = sorted((str(i), len(own), sum(c[w] > 0 for w in own), round(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own), 6)) for i, own in words)
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], round(r["base_score"], 6)) for r in got) == want
    assert all(r["train_tokens"] == n and r["score"] <= 0 for r in got)
    assert interpolated.score(nothing, rest != 0, rest == 1).count() == 0


def test_counts_beyond_32_bits():
    for numbers in ([0, 1, 255], [70_000], [1 << 33, 5], []):
        assert interpolated._expand(interpolated._squeeze(np.array(numbers, np.int64))).tolist() == numbers


def test_interpolated_scores_equal_brute_force(spark, docs):
    """The model's probability of each text, from plain dictionaries and the same weights."""
    rest = common.id_bucket(F.col("doc_id"), 10)
    got = {r["doc_id"]: r["score"] for r in rows_of(interpolated.score(docs, rest != 0, rest == 1, batch_tokens=300, range_tokens=500)) if r["doc_id"] is not None}
    split = lambda t: [*bytes((t or "").encode()).translate(simhash._LOWER).split(), b"\n"]
    bucket = lambda i: zlib.crc32(str("" if i is None else i).encode()) % 10
    texts = [(r.doc_id, split(r.text)) for r in docs.collect()]
    pairs = lambda own: list(zip([own[-1], *own[:-1]], own))

    def counts(kept):
        one = collections.Counter(w for i, own in texts if kept(i) for w in own)
        return one, collections.Counter(p for i, own in texts if kept(i) for p in pairs(own)), sum(one.values())

    floor = lambda p: min(int(math.floor(-math.log10(p) * interpolated.BINS_PER_DECADE)), interpolated.BINS - 1) if p > 0 else interpolated.BINS
    log2 = lambda c: min(int(math.floor(math.log2(max(c, 0.5)))) + 1, interpolated.CONTEXT_BUCKETS - 1)
    one, two, n = counts(lambda i: bucket(i) > 1)
    bins = collections.Counter(
        (log2(one[h]), floor(two[h, w] / one[h] if one[h] else 0), floor(one[w] / n)) for i, own in texts if bucket(i) == 1 for h, w in pairs(own)
    )
    one, two, n = counts(lambda i: bucket(i) > 0)
    frame = interpolated.pd.DataFrame([(*k, x) for k, x in bins.items()], columns=["bucket", "i2", "i1", "n"])
    weights = interpolated.learn_weights(frame, len(one))
    for i, own in texts:
        if i is not None:
            score = 0.0
            for h, w in pairs(own):
                a = weights[log2(one[h])]
                score += math.log10(a[0] * (two[h, w] / one[h] if one[h] else 0) + a[1] * one[w] / n + a[2] / (len(one) + 1))
            assert abs(got[i] - score) < 1e-6 * max(1, abs(score))


def test_model_is_a_distribution():
    """Probabilities of all words after a context, and of an unseen one, add up to one."""
    text = "a b a c a b b c a".split()
    uni, pair = collections.Counter(text), collections.Counter(zip(text, text[1:]))
    weights = interpolated.learn_weights(__import__("pandas").DataFrame({"bucket": [2, 3], "i2": [3, 5], "i1": [4, interpolated.BINS], "n": [10, 3]}), len(uni))
    assert np.allclose(weights.sum(axis=1), 1) and (weights[:, 2] > 0).all() and weights[0, 0] == 0
    for h in uni:
        follows = sum(n for (x, _), n in pair.items() if x == h)
        a2, a1, a0 = weights[interpolated._bucket(np.array([float(follows)]))[0]]
        total = sum(a2 * pair[h, w] / max(follows, 1) + a1 * uni[w] / len(text) + a0 / (len(uni) + 1) for w in uni) + a0 / (len(uni) + 1)
        assert abs(total - (1 if follows else 1 - a2)) < 1e-9


def test_weights_prefer_the_estimate_that_fits():
    import pandas as pd

    weights = interpolated.learn_weights(pd.DataFrame({"bucket": [5], "i2": [2], "i1": [40], "n": [1000]}), 100)
    assert weights[5, 0] > 0.95


def test_scores_do_not_depend_on_batches(docs):
    rest = common.id_bucket(F.col("doc_id"), 10)
    a, b = (sorted((str(r["doc_id"]), round(r["score"], 6)) for r in rows_of(interpolated.score(docs, rest != 0, rest == 1, *sizes))) for sizes in ((300, 200), (10**6, 10**6)))
    assert a == b


def test_segmentation_decodes_without_a_number_for_each_byte():
    import tracemalloc

    pieces = segmentation.Pieces()
    ids = np.array(pieces.model.encode("a quiet garden of letters\n" * 4000), np.int32)
    ends = np.array([0, len(ids) // 2, len(ids)])
    tracemalloc.start()
    made = pieces.decode_lists(ids, ends).to_pylist()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert made == [pieces.decode(ids[a:b].tolist()) for a, b in zip(ends, ends[1:])]
    assert peak < 8 * sum(map(len, made)) + 16 * len(ids)


def test_segmentation_units_are_those_of_the_pattern():
    pieces, rng = segmentation.Pieces(), random.Random(5)
    for _ in range(2000):
        text = "".join(rng.choice(" \n▁\x01ab日") for _ in range(rng.randint(1, 9)))
        assert pieces.units(text) == segmentation._UNITS.findall(pieces.model.normalize(text))
