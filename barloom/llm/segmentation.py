"""SentencePiece encoding and decoding: the best segmentation, and distinct sampled ones.

A text's segmentations are the paths of a lattice over the pieces of a given
vocabulary; a path's probability is the product of its pieces' weights over the
sum for all paths.  ``encode`` gives the most probable path.  Gumbel top-k draws
``k`` distinct paths without replacement: every path has its log probability
plus Gumbel noise, and an A-star search pops them in the order of that sum.

An agenda entry is a prefix with the largest perturbed score below it.  Which
path has that score doesn't depend on its value, so a popped prefix is completed
by drawing the rest of the path from the lattice, with backward sums as exact
completion.  The scores of the prefixes that leave this path are then drawn from
Gumbel distributions cut at its score, and the best of them join the agenda.  The
score that comes next after the ``k`` gives each path its inclusion probability.

All texts of a batch are searched side by side, one pop each at a time.  Noise is
a hash of the row's seed and the place it is needed at, so it doesn't depend on
what shares the batch.  Pieces never cross a word start or a line end, so
lattices are built for units of text and kept.  Prefixes that are so improbable
that no score of theirs can come up (by more than the resolution of a double)
are left out.
"""

from __future__ import annotations

import math
import re
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import field_types, map_batches

DEFAULT_MODEL = "piece_bpe_32k.model"
#: Piece of merge rank r has weight (r + RANK_OFFSET) ** -SHARPNESS: the file has ranks, not probabilities.
RANK_OFFSET = 20.0
SHARPNESS = 0.5
#: Log weight of a character that only bytes can spell.
BYTE_LOG_WEIGHT = -9.0
#: Nodes of kept lattices.
CACHE_NODES = 1_000_000
#: Rows are searched in batches of about so many characters.
BATCH_CHARS = 100_000
#: Natural log of the smallest chance that a double drawn from [0, 1) can show.
RESOLUTION = 40.0
#: Prefixes so far below a text's best score are left out at first, while its agenda is still empty.
FIRST_DEPTH = 50.0

_UNITS = re.compile("▁+[^▁\n]*|[^▁\n]+|\n")
#: Stands, where a text doesn't have it, before units that no space begins.
_BARE = "\x01"
_GOLDEN, _MIX, _STIR = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def model_path(name: str = DEFAULT_MODEL) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _hashed(h: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Hash of strings whose hash was ``h`` with one more character."""
    h = (h ^ codes) * _GOLDEN
    return h ^ (h >> np.uint64(32))


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def _ranges(first: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the range, number) of all numbers of the ranges from ``first`` on."""
    of = np.repeat(np.arange(len(counts)), counts)
    return of, np.arange(len(of)) + np.repeat(first - np.cumsum(counts) + counts, counts)


class Pieces:
    """Vocabulary: log weights, a table of all prefixes of pieces, and decoding."""

    def __init__(self, path: str | None = None, sharpness: float = SHARPNESS):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path or model_path())
        n = self.model.get_piece_size()
        text = [self.model.id_to_piece(i) for i in range(n)]
        self.byte, kept = [0] * 256, []
        self.spelled = [x.replace("▁", " ").encode() for x in text]
        for i, piece in enumerate(text):
            if self.model.is_byte(i):
                self.byte[int(piece[3:5], 16)] = i
                self.spelled[i] = bytes([int(piece[3:5], 16)])
            elif not (self.model.is_control(i) or self.model.is_unknown(i) or self.model.is_unused(i)):
                kept.append(i)
        self.bytes_of = pa.array(self.spelled, pa.binary())
        ids = np.array(kept, np.int64)
        rank = np.array([min(-self.model.get_score(i), float(n)) for i in kept])
        lengths = np.array([len(text[i]) for i in kept])
        codes, start = _codes("".join(text[i] for i in kept)), np.cumsum(lengths) - lengths
        h, hashes, found = np.zeros(len(ids), np.uint64), [], []
        for size in range(1, int(lengths.max()) + 1):
            at = np.flatnonzero(lengths >= size)
            h[at] = _hashed(h[at], codes[start[at] + size - 1])
            hashes.append(h[at].copy())
            found.append(np.where(lengths[at] == size, at, -1))
        hashes, found = np.concatenate(hashes), np.concatenate(found)
        order = np.lexsort((-found, hashes))  # a whole piece before the longer ones that start with it
        hashes, found = hashes[order], found[order]
        first = np.concatenate([[True], hashes[1:] != hashes[:-1]])
        self.prefix, whole = hashes[first], found[first]
        if len(self.prefix) != len({text[i][:j] for i in kept for j in range(1, len(text[i]) + 1)}):
            raise ValueError("prefixes of pieces have equal hashes")
        self.piece = np.where(whole >= 0, ids[whole], -1)
        # most prefixes are found by the leading bits of their hash; those that share them, by search
        self.table = np.full(1 << 20, -1, np.int32)
        slot = (self.prefix >> np.uint64(44)).astype(np.int64)
        self.table[slot] = np.arange(len(slot))
        crowded = np.flatnonzero(np.bincount(slot, minlength=1 << 20)[slot] > 1)
        self.table[slot[crowded]] = -2
        self.crowded = crowded
        self.weight = np.where(whole >= 0, -sharpness * np.log(rank[whole] + RANK_OFFSET), 0.0)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Places of prefixes in the table, -1 for strings that no piece starts with."""
        at = self.table[(hashes >> np.uint64(44)).astype(np.int64)]
        many = np.flatnonzero(at == -2)
        if len(many):
            at[many] = self.crowded[np.minimum(np.searchsorted(self.prefix[self.crowded], hashes[many]), len(self.crowded) - 1)]
        at[self.prefix[at] != hashes] = -1
        return at

    def units(self, text: str) -> list[str]:
        """Runs of spaces with the word after them, words behind line ends, and line ends."""
        if not text:
            return []
        text = self.model.normalize(text)
        if "▁▁" in text or _BARE in text or text[:1] != "▁":
            return _UNITS.findall(text)
        if "\n" in text:
            text = text.replace("\n", f"▁{_BARE}\n▁{_BARE}").replace(f"▁{_BARE}▁", "▁").removesuffix(f"▁{_BARE}")
            return [w[1:] if w[:1] == _BARE else "▁" + w for w in text[1:].split("▁")]
        return ["▁" + w for w in text[1:].split("▁")]

    def decode(self, ids: list[int]) -> str:
        """Text of ids: byte pieces are joined as UTF-8, spaces restored, the added first space dropped."""
        return b"".join(map(self.spelled.__getitem__, ids)).decode("utf-8", "replace").removeprefix(" ")

    def decode_lists(self, ids: np.ndarray, ends: np.ndarray) -> pa.Array:
        """Texts of lists of ids, as ``decode`` gives them."""
        spelled = self.bytes_of.take(pa.array(ids))
        _, upto, made = spelled.buffers()
        upto = np.frombuffer(upto, np.int32)[spelled.offset : spelled.offset + len(spelled) + 1].astype(np.int64) if len(spelled) else np.zeros(1, np.int64)
        made = np.frombuffer(made, np.uint8)[: upto[-1]] if upto[-1] else np.zeros(0, np.uint8)
        begin, stop = upto[ends[:-1]], upto[ends[1:]]
        spaced = begin < stop
        spaced[spaced] = made[begin[spaced]] == 32
        kept = np.ones(len(made), bool)
        kept[begin[spaced]] = False
        offsets = np.concatenate([[0], np.cumsum(stop - begin - spaced)]).astype(np.int32)
        made = pa.StringArray.from_buffers(len(begin), pa.py_buffer(offsets), pa.py_buffer(made[kept]))
        try:
            made.validate(full=True)
        except pa.ArrowInvalid:  # bytes that are no UTF-8
            return pa.array([self.decode(ids[a:b].tolist()) for a, b in zip(ends, ends[1:])], pa.string())
        return made


class Column:
    """Numbers that grow at the end; ``all`` are those so far."""

    def __init__(self, kind):
        self.held = np.empty(0, kind)
        self.clear()

    def clear(self, first=()) -> None:
        """Start anew in the memory that is there."""
        self.all = self.held[:0]
        self.add(np.array(first, self.held.dtype))

    def add(self, values: np.ndarray) -> None:
        n = len(self.all) + len(values)
        if n > len(self.held):
            held = np.empty(n + n // 2, self.held.dtype)
            held[: len(self.all)] = self.all
            self.held = held
        self.held[len(self.all) : n] = values
        self.all = self.held[:n]


class Lattices:
    """Edge tables of the units seen so far.

    Node ``m`` has the edges [first[m], first[m + 1]); ``node`` leads back,
    ``upto`` sums their probabilities, ``to`` is the node after the edge, -1 at the
    unit's end, ``logq`` its log probability, ``piece`` its id (-1 - c for a
    character c that takes several byte pieces).  A node's edges are ordered from
    the longest down.  ``best[m]`` is the first edge of the most probable rest,
    where that is asked for.
    """

    def __init__(self, pieces: Pieces, with_best: bool = False):
        self.pieces, self.with_best = pieces, with_best
        kinds = {"first": np.int64, "best": np.int64, "node": np.int32, "to": np.int32, "piece": np.int32, "upto": np.float64, "logq": np.float64}
        self.columns = {name: Column(kind) for name, kind in kinds.items()}
        self.clear()

    def clear(self) -> None:
        self.start: dict[str, int] = {}
        for name, column in self.columns.items():
            column.clear([0] if name == "first" else ())
        self._show()

    def _show(self) -> None:
        for name, column in self.columns.items():
            setattr(self, name, column.all)

    def add(self, units: list[str]) -> np.ndarray:
        """First nodes of the units; new ones are built together."""
        found = np.fromiter(map(self.start.get, units, repeat(-1)), np.int64, len(units))
        new = np.flatnonzero(found < 0)
        if len(new):
            missing = [units[i] for i in new.tolist()]
            self._build(list(dict.fromkeys(missing)))
            found[new] = np.fromiter(map(self.start.__getitem__, missing), np.int64, len(missing))
        return found

    def _matches(self, codes: np.ndarray, end: np.ndarray):
        """Edges (from, length, id, weight) of all pieces in the text, by start and from the longest down."""
        pieces, alive, h, found = self.pieces, np.arange(len(codes)), np.zeros(len(codes), np.uint64), []
        size = 0
        while len(alive):
            size += 1
            inside = alive + size <= end[alive]
            alive, h = alive[inside], h[inside]
            h = _hashed(h, codes[alive + size - 1])
            at = pieces.find(h)
            known = np.flatnonzero(at >= 0)
            alive, h, at = alive[known], h[known], at[known]
            whole = pieces.piece[at] >= 0
            found.append((alive[whole], np.full(int(whole.sum()), size), pieces.piece[at[whole]], pieces.weight[at[whole]]))
        covered = np.zeros(len(codes), bool)
        for x in found:
            covered[x[0]] = True
        bare = np.flatnonzero(~covered)
        letter = codes[bare].astype(np.int64)
        ids = np.where(letter < 128, np.array(pieces.byte)[np.minimum(letter, 127)], -1 - letter)
        found.append((bare, np.ones(len(bare), np.int64), ids, np.full(len(bare), BYTE_LOG_WEIGHT)))
        src, size, ids, weight = (np.concatenate(x) for x in zip(*found[::-1]))
        order = np.argsort(src, kind="stable")
        return src[order], size[order], ids[order], weight[order]

    def _build(self, units: list[str]) -> None:
        lengths = np.fromiter(map(len, units), np.int64, len(units))
        codes, n = _codes("".join(units)), int(lengths.sum())
        end = np.repeat(np.cumsum(lengths), lengths)
        src, size, ids, weight = self._matches(codes, end)
        to = np.where(src + size == end[src], n, src + size)  # n: the end of any unit
        first = np.concatenate([[0], np.cumsum(np.bincount(src, minlength=n))])
        # logs of the sum (and of the largest weight) of all ways to the end, from the end on, all units side by side
        total, most = np.zeros(n + 1), np.zeros(n + 1)
        left = end - np.arange(n)
        by_left = np.argsort(left.astype(np.uint16) if n and left.max() < 1 << 16 else left, kind="stable")  # short numbers sort by radix
        for part in np.split(by_left, np.flatnonzero(np.diff(left[by_left])) + 1):
            counts = first[part + 1] - first[part]
            of, edge = _ranges(first[part], counts)
            seg = np.cumsum(counts) - counts
            value, after = weight[edge], to[edge]
            if self.with_best:
                most[part] = np.maximum.reduceat(value + most[after], seg)
            value += total[after]
            high = np.maximum.reduceat(value, seg)
            value -= high[of]
            total[part] = high + np.log(np.add.reduceat(np.exp(value), seg))
        logq = weight + total[to] - total[src]
        # sums within each node, so that they don't depend on what else is built
        upto, edge = np.exp(logq), first[:-1]
        while len(edge := edge[edge + 1 < first[src[edge] + 1]] + 1):
            upto[edge] += upto[edge - 1]
        upto[first[1:] - 1] = 1.0
        base, edges = len(self.first) - 1, len(self.logq)
        if self.with_best:
            leads, best = np.flatnonzero(weight + most[to] >= most[src]), np.empty(n, np.int64)
            best[src[leads]] = leads  # of equal ones the shortest is written last
            self.columns["best"].add(best + edges)
        made = {"first": first[1:] + edges, "node": src + base, "to": np.where(to == n, -1, to + base), "piece": ids, "upto": upto, "logq": logq}
        for name, values in made.items():
            self.columns[name].add(values)
        self._show()
        self.start.update(zip(units, (np.cumsum(lengths) - lengths + base).tolist()))

    def walk(self, nodes: np.ndarray, choose) -> tuple[np.ndarray, np.ndarray]:
        """Paths from ``nodes`` to the ends of their units: where each begins (and the last ends), and their edges.

        ``choose(index, node, step)`` gives the next edges; ``index`` is all of them at first.
        """
        at, steps, lengths = slice(None), [], np.ones(len(nodes), np.int64)
        while len(nodes):
            edge = choose(at, nodes, len(steps))
            steps.append((at, edge))
            nodes = self.to[edge]
            more = np.flatnonzero(nodes >= 0)
            at, nodes = at[more] if len(steps) > 1 else more, nodes[more]
            lengths[at] += 1
        ends = np.concatenate([[0], np.cumsum(lengths)])
        begin, path = ends[:-1], np.empty(int(ends[-1]), np.int64)
        for step, (at, edge) in enumerate(steps):
            path[begin[at] + step] = edge
        return ends, path

    def drawn(self, edge: np.ndarray, upto: np.ndarray, chance: np.ndarray) -> np.ndarray:
        """Moves ``edge``, the first of its node with the sum ``upto``, on to that at which the sum of probabilities passes ``chance``."""
        on = np.flatnonzero(upto <= chance)
        now, chance = edge[on], chance[on]
        while len(on):
            now += 1
            edge[on] = now
            more = np.flatnonzero(self.upto[now] <= chance)
            on, now, chance = on[more], now[more], chance[more]
        return edge

    def ids(self, paths: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of the paths, one after another, and where each begins (and the last ends)."""
        ids = self.piece[np.concatenate(paths)] if paths else np.zeros(0, np.int32)
        ends = np.cumsum([0, *map(len, paths)])
        rare = np.flatnonzero(ids < 0)
        if len(rare):
            spelled = [[self.pieces.byte[b] for b in chr(-1 - x).encode("utf-8", "surrogatepass")] for x in ids[rare].tolist()]
            counts = np.ones(len(ids), np.int64)
            counts[rare] = [len(x) for x in spelled]
            begins = np.cumsum(counts) - counts
            ids = np.repeat(ids, counts)
            ids[_ranges(begins[rare], counts[rare])[1]] = [b for x in spelled for b in x]
            ends = np.append(begins, len(ids))[ends]
        return ids, ends


def _uniform(seeds: np.ndarray, stream: int, place: np.ndarray, step) -> np.ndarray:
    """Numbers in (0, 1) that depend on the seed and the place only."""
    return _stirred(seeds + (np.uint64(stream << 56) + (place.astype(np.uint64) << np.uint64(20)) + np.asarray(step).astype(np.uint64) + np.uint64(1)) * _GOLDEN)


def _stirred(z: np.ndarray) -> np.ndarray:
    z = z ^ (z >> np.uint64(30))
    z *= _MIX
    z ^= z >> np.uint64(27)
    z *= _STIR
    z ^= z >> np.uint64(31)
    z >>= np.uint64(11)
    out = z.astype(np.float64)
    out += 0.5
    out *= 2.0**-53
    return out


class Agenda:
    """The best few prefixes of each text: score, log probability, place, and the path that they leave."""

    FIELDS = ("unit", "node", "parent", "cut", "edge")

    def __init__(self, texts: int, size: int):
        self.size = size
        self.score, self.logp = np.full((texts, size), -np.inf), np.zeros((texts, size))
        self.places = np.zeros((len(self.FIELDS), texts, size), np.int64)

    def pop(self):
        """Texts with an entry, and the best entry of each: score, log probability and places."""
        best = self.score.argmax(axis=1)
        live = np.flatnonzero(self.score[np.arange(len(best)), best] > -np.inf)
        at = live, best[live]
        popped = live, self.score[at], self.logp[at], self.places[:, *at]
        self.score[at] = -np.inf
        return popped

    def bar(self, n: int) -> np.ndarray:
        """The ``n``-th best score of each text."""
        return -np.partition(-self.score, n - 1, axis=1)[:, n - 1]

    def push(self, text: np.ndarray, score: np.ndarray, logp: np.ndarray, places: np.ndarray) -> None:
        """Keep the best of what is there and what comes."""
        there = np.nonzero(self.score > -np.inf)
        text = np.concatenate([there[0], text])
        score, logp = np.concatenate([self.score[there], score]), np.concatenate([self.logp[there], logp])
        places = np.concatenate([self.places[:, *there], places], axis=1)
        order = np.lexsort((-score, text))
        ordered = text[order]
        rank = np.arange(len(order)) - np.searchsorted(ordered, ordered)
        order, rank = order[rank < self.size], rank[rank < self.size]
        self.score[:] = -np.inf
        at = text[order], rank
        self.score[at], self.logp[at], self.places[:, *at] = score[order], logp[order], places[:, order]


def sample_paths(lattices: Lattices, starts: np.ndarray, offsets: np.ndarray, k: int, seeds: np.ndarray):
    """The ``k`` paths of largest perturbed score of each text, and the next score.

    Units of text ``t`` begin at the nodes starts[offsets[t] : offsets[t + 1]].
    Returns a list of (edges, log probability, perturbed score) for each text,
    best first, and an array with the score that comes after them (-inf: none).
    """
    texts = len(offsets) - 1
    first, to, logq = lattices.first, lattices.to, lattices.logq
    agenda, paths = Agenda(texts, k + 1), [[] for _ in range(texts)]
    node_at = lambda unit, text: np.where(unit < offsets[text + 1], starts[np.minimum(unit, len(starts) - 1)] if len(starts) else -1, -1)
    rows = np.arange(texts)
    agenda.score[:, 0] = -np.log(-np.log(_uniform(seeds, 255, rows * 0, 0)))
    agenda.places[:, :, 0] = [offsets[:-1], node_at(offsets[:-1], rows), rows * 0 - 1, rows * 0, rows * 0 - 1]
    # first edges of the units, and their noise but for turn and step, as ``_uniform`` has it
    lead = first[starts]
    reached = lattices.upto[lead]
    text_of, local = _ranges(rows * 0, np.diff(offsets))
    noisy = seeds[text_of] + ((local.astype(np.uint64) << np.uint64(20)) + np.uint64(1)) * _GOLDEN
    for turn in range(k):
        live, score, logp, (unit, node, parent, cut, leaving) = agenda.pop()
        if not len(live):
            break
        own = seeds[live]
        # the rest of each path: the rest of a unit, and whole units
        counts = np.where(node >= 0, offsets[live + 1] - unit, 0)
        begins = np.concatenate([[0], np.cumsum(counts)])
        units = np.arange(begins[-1]) + np.repeat(unit - begins[:-1], counts)
        at = begins[:-1][node >= 0]  # the first is entered inside
        nodes, edge, upto = starts[units], lead[units], reached[units]
        nodes[at] = node[node >= 0]
        edge[at] = first[nodes[at]]
        upto[at] = lattices.upto[edge[at]]
        noise = noisy[units] + np.array([turn << 56], np.uint64) * _GOLDEN

        def choose(at, node, step):
            if not step:
                return lattices.drawn(edge, upto, _stirred(noise))
            now = first[node]
            return lattices.drawn(now, lattices.upto[now], _stirred(noise[at] + np.array([step], np.uint64) * _GOLDEN))

        unit_ends, edges = lattices.walk(nodes, choose)
        ends = unit_ends[begins]
        q = logq[edges]
        before = np.empty(len(q))
        for a, b, sofar in zip(ends.tolist(), ends[1:].tolist(), logp.tolist()):  # one by one: rounding mustn't depend on other texts
            np.cumsum(q[a:b], out=before[a:b])
            before[a:b] += sofar
        whole = np.where(ends[1:] > ends[:-1], before[ends[1:] - 1] if len(q) else logp, logp).tolist()
        before -= q
        kept = np.where(leaving >= 0, cut + 1, 0)
        for j, t in enumerate(live.tolist()):
            path = edges[ends[j] : ends[j + 1]]
            if leaving[j] >= 0:
                path = np.concatenate([paths[t][parent[j]][0][: cut[j]], leaving[j : j + 1], path])
            paths[t].append((path, whole[j], float(score[j])))
        # prefixes that leave these paths
        need = k - turn
        bar = agenda.bar(need)[live]
        low = np.where(bar > -np.inf, bar - RESOLUTION, score - FIRST_DEPTH)
        while True:
            at = np.flatnonzero(before > np.repeat(low, np.diff(ends)))
            m = lattices.node[edges[at]]
            which, side = _ranges(first[m], first[m + 1] - first[m])
            others = side != edges[at[which]]
            which, side = at[which[others]], side[others]
            t = np.searchsorted(ends, which, side="right") - 1
            phi = before[which] + logq[side]
            noise = _uniform(own[t], 128 + turn, which - ends[t], side - first[lattices.node[side]])
            given = phi - np.log(np.exp(phi - score[t]) - np.log(noise))
            able = given > bar[t]
            high, texted = given[able], t[able]
            # where the scores reach so far down that what was left out might matter, nothing is left out
            order = np.lexsort((-high, texted))
            rank = np.arange(len(order)) - np.searchsorted(texted[order], texted[order])
            last = np.full(len(live), -np.inf)
            last[texted[order[rank == need - 1]]] = high[order[rank == need - 1]]
            some = ends[1:] > ends[:-1]
            short = some.copy()
            short[some] = before[ends[1:][some] - 1] <= low[some]  # prefixes get ever less probable
            again = short & (np.maximum(last, bar) - RESOLUTION < low)
            if not again.any():
                break
            low[again] = -np.inf
        which, side, t, phi = which[able], side[able], t[able], phi[able]
        inside = to[side] >= 0
        at_unit = units[np.searchsorted(unit_ends, which, side="right") - 1] + ~inside
        places = [at_unit, np.where(inside, to[side], node_at(at_unit, live[t])), np.full(len(t), turn), kept[t] + which - ends[t], side]
        agenda.push(live[t], high, phi, np.array(places, np.int64).reshape(len(places), -1))
    return paths, agenda.score.max(axis=1, initial=-np.inf)


def _inclusion(logp: float, bar: float) -> float:
    """Log probability that a path's score exceeds ``bar``."""
    if bar == -np.inf:
        return 0.0
    gap = logp - bar
    return gap if gap < -30 else float(np.log(-np.expm1(-np.exp(min(gap, 700.0)))))


def _texts_in_parts(texts: list[str | None]):
    """(first, texts) of runs of about ``BATCH_CHARS`` characters."""
    at = 0
    while at < len(texts):
        stop, chars = at, 0
        while stop < len(texts) and stop - at < 2000 and chars < BATCH_CHARS:
            chars, stop = chars + len(texts[stop] or ""), stop + 1
        yield at, [t or "" for t in texts[at:stop]]
        at = stop


def sample_texts(texts: list[str], seeds: np.ndarray, lattices: Lattices, k: int):
    """For each text its (edges, log probability, perturbed score, log inclusion probability), best first."""
    if len(lattices.first) > CACHE_NODES:
        lattices.clear()
    units = [lattices.pieces.units(t) for t in texts]
    offsets = np.cumsum([0, *map(len, units)])
    starts = lattices.add([u for own in units for u in own])
    paths, bars = sample_paths(lattices, starts, offsets, k, seeds)
    return [[(*found, _inclusion(found[1], bar)) for found in own] for own, bar in zip(paths, bars.tolist())]


def _list_array(ids: np.ndarray, ends: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids))


def sample_segmentations(rows: DataFrame, keys: list[str], text_col: str = "text", k: int = 4, seed: int = 17, model_file: str | None = None) -> DataFrame:
    """``keys`` and, for each of at most ``k`` distinct segmentations of the text: rank (from 1), ids, log_prob,
    perturbed, log_inclusion, decoded.

    The noise of a row comes from ``seed`` and the row's keys, so a row gets the
    same samples wherever it runs; rows with equal keys and texts get equal
    samples.  A text with fewer segmentations has a row for each; a null or
    empty text has one, the empty one.  ``decoded`` is the text of the ids.
    Texts are segmented whole; a task holds a batch of them, or one long one.
    Equal scores don't occur but by chance in the last bit; the first found
    comes first.  Other columns are ignored; no rows give no rows.
    """

    def run(batches):
        import xxhash

        lattices = Lattices(Pieces(model_file))
        for batch in batches:
            named = [batch.column(i).to_pylist() for i in range(len(keys))]
            for begin, texts in _texts_in_parts(batch.column(len(keys)).to_pylist()):
                own = range(begin, begin + len(texts))
                seeds = np.array([xxhash.xxh64_intdigest(repr([seed, *(c[i] for c in named)]).encode()) for i in own], np.uint64)
                sampled = sample_texts(texts, seeds, lattices, k)
                taken = batch.take(pa.array(np.repeat(own, [len(x) for x in sampled])))
                found = [x for text in sampled for x in text]
                ids, ends = lattices.ids([x[0] for x in found])
                made = [pa.array([i for x in sampled for i in range(1, len(x) + 1)], pa.int32()), _list_array(ids, ends)]
                made += [*(pa.array([x[i] for x in found], pa.float64()) for i in (1, 2, 3)), lattices.pieces.decode_lists(ids, ends)]
                yield pa.RecordBatch.from_arrays([*(taken.column(j) for j in range(len(keys))), *made], [*keys, *names])

    names = ["rank", "ids", "log_prob", "perturbed", "log_inclusion", "decoded"]
    kinds = ", rank int, ids array<int>, log_prob double, perturbed double, log_inclusion double, decoded string"
    return map_batches(rows.select(*keys, F.col(text_col)), run, field_types(rows, keys) + kinds)


def best_texts(texts: list[str], lattices: Lattices) -> list[tuple[np.ndarray, float]]:
    """Edges and log probability of each text's most probable segmentation; of equal ones that with the shortest first piece."""
    if len(lattices.first) > CACHE_NODES:
        lattices.clear()
    units = [lattices.pieces.units(t) for t in texts]
    starts = lattices.add([u for own in units for u in own])
    ends, edges = lattices.walk(starts, lambda at, node, step: lattices.best[node])
    cuts = ends[np.cumsum([0, *map(len, units)])]
    return [(edges[a:b], math.fsum(lattices.logq[edges[a:b]])) for a, b in zip(cuts, cuts[1:])]


def encode(rows: DataFrame, text_col: str = "text", model_file: str | None = None) -> DataFrame:
    """``rows`` with ``ids`` and ``log_prob`` of the most probable segmentation of each text.

    A null or empty text has no ids and log probability 0.  Columns of these
    names are replaced; no rows give no rows.
    """
    columns = [c for c in rows.columns if c not in ("ids", "log_prob")]

    def run(batches):
        lattices = Lattices(Pieces(model_file), with_best=True)
        for batch in batches:
            for begin, texts in _texts_in_parts(batch.column(text_col).to_pylist()):
                found, part = best_texts(texts, lattices), batch.slice(begin, len(texts))
                made = [_list_array(*lattices.ids([x for x, _ in found])), pa.array([p for _, p in found], pa.float64())]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in columns), *made], [*columns, "ids", "log_prob"])

    fields = field_types(rows, columns) + ", ids array<int>, log_prob double"
    return map_batches(rows.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*columns, text_col])]), run, fields)


def decode(rows: DataFrame, ids_col: str = "ids", model_file: str | None = None) -> DataFrame:
    """``rows`` with ``decoded``, the text of the ids; null ids give null."""
    columns = [c for c in rows.columns if c != "decoded"]

    def run(batches):
        pieces = Pieces(model_file)
        for batch in batches:
            made = [None if ids is None else pieces.decode(ids) for ids in batch.column(ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), pa.array(made, pa.string())], [*columns, "decoded"])

    return map_batches(rows.select(*[F.col(f"`{c}`") for c in columns]), run, field_types(rows, columns) + ", decoded string")
