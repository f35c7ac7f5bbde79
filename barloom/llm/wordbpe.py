"""Whole-text encoding with a tokenizer whose pieces never cross spaces.

The default vocabulary file drops white space before merging, so a text's ids
are the ids of its space- and newline-separated chunks in order.  Chunks repeat
much more than texts do; a bounded cache keeps their ids as little-endian bytes.
The cache stays with a Python worker from task to task.  A file that normalises
or splits texts in another way is taken as it is: each text is encoded whole.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from itertools import islice

from .common import single_threaded

#: Chunks that the cache holds; when it is full, all but the first KEPT_CHUNKS go: frequent chunks come early.
CACHE_CHUNKS = 150_000
KEPT_CHUNKS = 60_000
#: Longer chunks aren't kept.
CACHED_CHARS = 64
#: Characters of text whose chunks are looked up at once, unless one text has more.
BLOCK_CHARS = 500_000
#: How the default file normalises and splits texts.
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
PRE_TOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": SPLIT}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}
#: Chunks whose case folding and splitting are plain: Latin letters, then ASCII marks that don't start a contraction or an added token.
_PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([^\\s\\w'<\x80-\U0010ffff]*)")
DEFAULT_VOCABULARY = "word_bpe_49k.json"
END_ID = 2


def vocabulary_path(name: str = DEFAULT_VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordEncoder:
    """``ids_of(texts)``: each text's ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str | None = None, cache_chunks: int = CACHE_CHUNKS, kept_chunks: int = KEPT_CHUNKS):
        single_threaded()
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path or vocabulary_path())
        parts = (self.tokenizer.normalizer, self.tokenizer.pre_tokenizer)
        self.by_chunks = [p and json.loads(p.__getstate__()) for p in parts] == [NORMALIZER, PRE_TOKENIZER]
        self.cache_chunks, self.kept_chunks = cache_chunks, kept_chunks
        self.known: dict[str, bytes] = {"": b""}
        self.runs: dict[str, bytes] = {"": b""}  # ids of letter runs and of mark runs
        # the byte-level alphabet: printable bytes stand for themselves, the rest follow from 256 on
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = iter(range(256, 512))
        self.letter = {b: next(others) for b in range(256) if b not in printable}
        self.model = self.tokenizer.model

    def _run(self, run: str) -> bytes:
        """Ids of one run of letters or marks, already folded, that isn't in ``runs``."""
        word = run if run.isascii() else run.encode().decode("latin-1").translate(self.letter)
        got = array("I", [t.id for t in self.model.tokenize(word)]).tobytes()
        if len(run) <= CACHED_CHARS:
            self.runs[run] = got
        return got

    def _learn(self, chunks: set[str]) -> None:
        missing = list(chunks.difference(self.known))
        if len(self.known) + len(missing) > self.cache_chunks:
            self.known = dict(islice(self.known.items(), self.kept_chunks))
            missing = list(chunks.difference(self.known))
        if len(self.runs) > self.cache_chunks:
            self.runs = dict(islice(self.runs.items(), self.kept_chunks))
        special, self.long = [], [chunk for chunk in missing if len(chunk) > CACHED_CHARS]
        known, find, run, match = self.known, self.runs.get, self._run, _PLAIN.fullmatch
        for chunk in missing:
            if chunk.isascii() and chunk.isalpha():
                letters, marks = chunk.lower(), ""
            elif plain := match(chunk):
                letters, marks = plain.groups()
                letters = letters.lower()
            else:
                special.append(chunk)
                continue
            ids = find(letters)
            if ids is None:
                ids = run(letters)
            if marks:
                rest = find(marks)
                ids += run(marks) if rest is None else rest
            known[chunk] = ids  # without marks the one object of the run
        for at in range(0, len(special), 4096):
            part = special[at : at + 4096]
            for chunk, got in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False)):
                self.known[chunk] = array("I", got.ids).tobytes()

    def ids_of(self, texts: list[str | None]) -> Iterator[bytes]:
        if not self.by_chunks:
            for text in texts:
                yield array("I", self.tokenizer.encode(text or "", add_special_tokens=False).ids).tobytes()
            return
        at = 0
        while at < len(texts):
            block, size = [], 0
            while at < len(texts) and size < BLOCK_CHARS:
                text = texts[at] or ""
                block.append(text.replace("\n", " ").split(" "))
                size += len(text)
                at += 1
            self._learn(set().union(*block))
            get = self.known.__getitem__
            for chunks in block:
                yield b"".join(map(get, chunks))
            for chunk in self.long:
                del self.known[chunk]

    def ids(self, text: str | None) -> bytes:
        return next(self.ids_of([text]))


_held: dict[str | None, WordEncoder] = {}


def worker_encoder(path: str | None = None) -> WordEncoder:
    """This process's encoder of the vocabulary file."""
    if path not in _held:
        _held[path] = WordEncoder(path)
    return _held[path]
