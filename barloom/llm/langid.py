"""Language identification: script ranges, per-word scores, Viterbi labels.

Every word is scored for each learned language by smoothed character trigrams.
The scripts of its letters narrow the languages that it can be: a language is a
candidate only where training text of it has that script.  Viterbi with a
constant penalty for each switch labels the words of a text, so mixed texts
split into spans; the language with most letters is the text's language.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch_texts, field_types, map_batches

#: First and last code point of the scripts told apart; others count as "other".
SCRIPTS = {
    "latin": [(0x41, 0x24F), (0x1E00, 0x1EFF)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F)],
    "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x590, 0x5FF)],
    "arabic": [(0x600, 0x77F)],
    "devanagari": [(0x900, 0x97F)],
    "thai": [(0xE00, 0xE7F)],
    "hangul": [(0x1100, 0x11FF), (0xAC00, 0xD7AF)],
    "kana": [(0x3040, 0x30FF)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF)],
}
NAMES = [*SCRIPTS, "other"]
TABLE = 1 << 16
#: A language has a script from this share of its training letters on.
SCRIPT_SHARE = 0.001
#: Expected number of training documents of each language; documents are taken by a hash of their id.
TRAINING_DOCUMENTS = 3000
SWITCH_PENALTY = 12.0
SMOOTHING = 0.1
#: Words, and characters of words, whose scores a task keeps.
CACHE_WORDS = 100_000
CACHE_CHARS = 2_000_000
#: Characters of text that a task labels at once, unless one text has more.
BLOCK_CHARS = 2_000_000
#: Languages at most: a model is broadcast, 260 kB for each.
MAX_LANGUAGES = 400
UNDETERMINED = "und"

_starts = np.array(sorted((a, b, i) for i, name in enumerate(SCRIPTS) for a, b in SCRIPTS[name]))


def scripts_of(codes: np.ndarray) -> np.ndarray:
    at = np.maximum(np.searchsorted(_starts[:, 0], codes, side="right") - 1, 0)
    inside = (codes >= _starts[at, 0]) & (codes <= _starts[at, 1])
    return np.where(inside, _starts[at, 2], len(SCRIPTS))


def letters(token: str) -> str:
    return token.lower() if token.isalpha() else "".join(c for c in token if c.isalpha()).lower()


def trigrams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(index of the word, table slot) of each character trigram, word ends marked."""
    codes = np.frombuffer("".join(f"\x02{w}\x03" for w in words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    if len(codes) < 3:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    of = np.cumsum(codes == 2) - 1
    a, b, c = codes[:-2], codes[1:-1], codes[2:]
    kept = (a != 3) & (b != 3)
    slot = ((a * np.uint64(0x1F123BB5) + b * np.uint64(0x9E3779B1) + c * np.uint64(0x85EBCA77)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)
    return of[:-2][kept], slot[kept].astype(np.int64)


@dataclass
class Model:
    """``scores[l, slot]``: log probability; ``allowed[l, script]``."""

    languages: list[str]
    scores: np.ndarray
    allowed: np.ndarray
    penalty: float = SWITCH_PENALTY


@dataclass
class WordScores:
    """Score rows of words, kept for words seen again."""

    model: Model
    index: dict[str, int] = field(default_factory=dict)

    def __post_init__(self):
        n = len(self.model.languages)
        self.rows, self.sizes, self.open, self.chars = np.empty((0, n), np.float32), np.empty(0, np.int32), np.empty((0, n), bool), 0

    def lookup(self, texts: list[list[str]]) -> list[np.ndarray]:
        distinct = dict.fromkeys(w for t in texts for w in t)
        missing = [w for w in distinct if w not in self.index]
        if len(self.index) + len(missing) > CACHE_WORDS or self.chars > CACHE_CHARS:
            self.index = {}
            self.__post_init__()
            missing = list(distinct)
        self.chars += sum(map(len, missing))
        if missing:
            self.index |= {w: i for i, w in enumerate(missing, len(self.index))}
            got = self._score(missing)
            self.rows, self.sizes, self.open = (np.concatenate(x) for x in zip((self.rows, self.sizes, self.open), got))
        get = self.index.__getitem__
        return [np.fromiter(map(get, t), np.int64, len(t)) for t in texts]

    def _score(self, tokens: list[str]):
        words = [letters(t) for t in tokens]
        n, size = len(self.model.languages), np.array([len(w) for w in words], np.int32)
        of, slot = trigrams(words)
        rows = np.stack([np.bincount(of, self.model.scores[i][slot], len(words)) for i in range(n)], axis=1)
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        at = np.repeat(np.arange(len(words)), size)
        closed = np.stack([np.bincount(at, ~self.model.allowed[i][scripts_of(codes)], len(words)) for i in range(n)], axis=1) > 0
        able = ~closed & (size > 0)[:, None]
        # a word without a letter or candidate says nothing; other languages than its candidates are out
        some = able.any(axis=1)
        low = np.where(able, rows, np.inf).min(axis=1, initial=np.inf)
        rows = np.where(able, rows, np.where(some, low - 50.0, 0.0)[:, None])
        rows[~some] = 0
        return rows.astype(np.float32), size, able


def viterbi(scores: np.ndarray, starts: np.ndarray, lengths: np.ndarray, penalty: float) -> np.ndarray:
    """Best label of each row; texts are the row ranges ``starts`` + ``lengths``, stepped through together."""
    total, n = scores.shape
    kind = np.min_scalar_type(max(n - 1, 0))
    label = np.zeros(total, np.int64)
    if not total:
        return label
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[order], lengths[order]
    longest = int(lengths[0])
    active = np.searchsorted(-lengths, -np.arange(1, longest + 1), side="right")
    back = np.zeros((total, n), kind)
    value = scores[starts[: active[0]]].astype(np.float64)
    own = np.arange(n, dtype=kind)[None, :]
    last = np.zeros(len(starts), np.int64)
    for t in range(1, longest):
        a = active[t]
        if a < active[t - 1]:
            last[a : active[t - 1]] = value[a:].argmax(axis=1)
            value = value[:a]
        at = starts[:a] + t
        best = value.argmax(axis=1)
        switched = value[np.arange(a), best] - penalty
        stay = value >= switched[:, None]
        back[at] = np.where(stay, own, best[:, None])
        value = np.where(stay, value, switched[:, None]) + scores[at]
    last[: len(value)] = value.argmax(axis=1)
    now = last
    for t in range(longest - 1, -1, -1):
        a = active[t]
        at = starts[:a] + t
        label[at] = now[:a]
        if t:
            now[:a] = back[at, now[:a]]
    return label


@dataclass
class Labelled:
    """Best language (index) and its share of letters of each text (total: letters), and spans one after another.

    Spans of text ``i`` are those from ``offsets[i]`` to ``offsets[i + 1]``:
    language, first word and the word after the last.
    """

    best: np.ndarray
    share: np.ndarray
    total: np.ndarray
    offsets: np.ndarray
    language: np.ndarray
    first: np.ndarray
    stop: np.ndarray


def label_words(texts: list[str], scorer: WordScores) -> Labelled:
    n = len(scorer.model.languages)
    tokens = [t.split() for t in texts]
    at = scorer.lookup(tokens)
    lengths = np.array([len(t) for t in tokens], np.int64)
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
    rows = np.concatenate(at) if len(at) else np.empty(0, np.int64)
    kept = np.flatnonzero(lengths)
    label = viterbi(scorer.rows[rows], starts[kept], lengths[kept], scorer.model.penalty)
    size, able = scorer.sizes[rows], scorer.open[rows]
    of = np.repeat(np.arange(len(texts)), lengths)
    counted = size * able[np.arange(len(rows)), label]
    weight = np.bincount(of * n + label, counted, len(texts) * n).reshape(-1, n)
    total = np.bincount(of, size, len(texts))
    best = weight.argmax(axis=1)
    share = weight[np.arange(len(texts)), best] / np.maximum(total, 1)
    change = np.ones(len(rows), bool)
    change[1:] = (label[1:] != label[:-1]) | (of[1:] != of[:-1])
    edge = np.flatnonzero(change)
    offsets = np.searchsorted(of[edge], np.arange(len(texts) + 1))
    ends = np.append(edge[1:], len(rows))[: len(edge)]
    return Labelled(best, share, total, offsets, label[edge], edge - starts[of[edge]], ends - starts[of[edge]])


def label_texts(texts: list[str], scorer: WordScores) -> tuple[list[str], list[float], list[list[tuple[str, int, int]]]]:
    """Language, score and spans (language, first word, word after the last) of each text."""
    languages = scorer.model.languages
    if not languages:
        return [UNDETERMINED] * len(texts), [0.0] * len(texts), [[] for _ in texts]
    got = label_words(texts, scorer)
    names = [languages[b] if t else UNDETERMINED for b, t in zip(got.best, got.total)]
    spans = list(zip([languages[x] for x in got.language], got.first.tolist(), got.stop.tolist()))
    return names, [float(s) if t else 0.0 for s, t in zip(got.share, got.total)], [spans[a:b] for a, b in zip(got.offsets, got.offsets[1:])]


def train(docs: DataFrame, per_language: int = TRAINING_DOCUMENTS, penalty: float = SWITCH_PENALTY) -> Model:
    """Learn from rows (doc_id, text, lang) whose text and lang aren't null.

    From each language about ``per_language`` documents are taken (all, if
    fewer), chosen by a hash of the id: the one bounded sample of this operator.
    More than ``MAX_LANGUAGES`` languages are an error.
    """
    rows = docs.where("text IS NOT NULL AND lang IS NOT NULL").select("doc_id", "text", "lang")
    sizes = {r[0]: r[1] for r in rows.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()}
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages: is lang a language?")
    languages = sorted(sizes)
    scores, allowed = np.zeros((len(languages), TABLE)), np.zeros((len(languages), len(NAMES)))
    if not languages:
        return Model([], scores, allowed.astype(bool), penalty)
    share = F.create_map(*[F.lit(x) for k in languages for x in (k, min(1.0, per_language / sizes[k]))])
    sample = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < F.element_at(share, F.col("lang")) * (1 << 20))

    def run(batches):
        place = {k: i for i, k in enumerate(languages)}
        tri, scr = np.zeros((len(languages), TABLE), np.int64), np.zeros((len(languages), len(NAMES)), np.int64)
        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = [w for w in map(letters, text.split()) if w]
                if words:
                    tri[place[lang]] += np.bincount(trigrams(words)[1], minlength=TABLE)
                    codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
                    scr[place[lang]] += np.bincount(scripts_of(codes), minlength=len(NAMES))
        both = np.concatenate([tri, scr], axis=1)
        of, slot = np.nonzero(both)
        yield pa.RecordBatch.from_arrays([pa.array(of), pa.array(slot), pa.array(both[of, slot])], ["of", "slot", "n"])

    counts = map_batches(sample.select("text", "lang"), run, "of long, slot long, n long").groupBy("of", "slot").agg(F.sum("n").alias("n")).toPandas()
    both = np.zeros((len(languages), TABLE + len(NAMES)))
    both[counts["of"], counts["slot"]] = counts["n"]
    tri, scr = both[:, :TABLE], both[:, TABLE:]
    scores = np.log((tri + SMOOTHING) / (tri.sum(axis=1, keepdims=True) + SMOOTHING * TABLE)).astype(np.float32)
    allowed = scr >= SCRIPT_SHARE * np.maximum(scr.sum(axis=1, keepdims=True), 1)
    return Model(languages, scores, allowed & (scr > 0), penalty)


def identify(docs: DataFrame, model: Model, keep: list[str] | None = None, with_spans: bool = True) -> DataFrame:
    """``keep`` columns (default: all) and lang_pred, score, spans of each document.

    ``lang_pred`` is ``und`` with score 0 where the text is null, has no letter
    or nothing was learned.  Otherwise it is the learned language with most
    letters (ties: the first by name) and ``score`` its share of all letters; a
    text in a script that no learned language has scores 0.  Spans count white-
    space separated words.  Columns of these names are replaced.
    """
    added = ("lang_pred", "score", "spans") if with_spans else ("lang_pred", "score")
    columns = [c for c in (keep or docs.columns) if c not in added]
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most MAX_LANGUAGES x 65,536 scores
    fields = "lang_pred string, score double" + ", spans array<struct<lang:string,first:int,stop:int>>" * with_spans

    def run(batches):
        model = shared.value
        scorer, names = WordScores(model), pa.array([*model.languages, UNDETERMINED], pa.string())
        for batch in batches:
            texts, parts, at = batch_texts(batch), [], 0
            while at < len(texts) and model.languages:
                stop, size = at, 0
                while stop < len(texts) and (stop == at or size + len(texts[stop]) <= BLOCK_CHARS):
                    size += len(texts[stop])
                    stop += 1
                parts.append(label_words(texts[at:stop], scorer))
                at = stop
            join = lambda name: np.concatenate([getattr(p, name) for p in parts]) if parts else np.zeros(0 if name in ("language", "first", "stop") else len(texts))
            total = join("total")
            best = np.where(total > 0, join("best"), len(model.languages)).astype(np.int64)
            made = [names.take(pa.array(best)), pa.array(np.where(total > 0, join("share"), 0.0), pa.float64())]
            if with_spans:
                sizes = np.concatenate([np.diff(p.offsets) for p in parts]) if parts else np.zeros(len(texts), np.int64)
                offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                of = [names.take(pa.array(join("language").astype(np.int64))), *(pa.array(join(x).astype(np.int32)) for x in ("first", "stop"))]
                made.append(pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(of, ["lang", "first", "stop"])))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), *made], [*columns, *added])

    rows = docs.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*columns, "text"])])
    return map_batches(rows, run, f"{field_types(docs, columns)}, {fields}")
