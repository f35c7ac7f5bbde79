"""License scans: sparse TF-IDF cosine to templates, then inheritance along paths.

Each line of a file is compared with licence templates by the cosine of sparse
TF-IDF vectors, and so is each window of consecutive sentences up to twice a
template's length, the header and the whole file wherever they can reach the
threshold; a file's own licence is that of the best of them.  Files that
govern (licence files) give their licence to their directory, and every file
without a licence of its own takes that of its nearest ancestor directory, found
by joins of directory paths.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_batches, materialize

#: Licence names and the wording of their notices.
TEMPLATES = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."],
    "BSD-3-Clause": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", "Released under the BSD 3-Clause License."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2.", "GNU General Public License version 2"],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.", "GNU General Public License version 3", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "MIT": ["Released under the MIT License.", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
}
THRESHOLD = 0.8
LICENSE_FILES = re.compile(r"(?i)(licen[cs]e|copying|unlicense|notice)([.-].*)?")

_TERM = re.compile(r"[a-z]+|\d+(?:\.\d+)*")
_SKIPPED = re.compile(r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->")
#: Tags that end a line; all others (links, emphasis) stand within one.
_BLOCKS = (
    "address article aside blockquote body br button caption center col colgroup dd details dialog dir div dl dt fieldset figcaption figure footer form frame frameset "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe input legend li link main menu meta nav noscript object ol optgroup option p pre search section select summary "
    "svg table tbody td template textarea tfoot th thead title tr ul video audio canvas"
).split()
_BLOCK = re.compile(r"(?is)</?(?:" + "|".join(_BLOCKS) + r")(?![\w:-])[^>]*>|<[!?][^>]*>")
_TAG = re.compile(r"(?s)<[^>]*>")
_SENTENCE = re.compile(r"(?<=[.!?:;])\s+")
#: Windows of several sentences hold at most so many times a template's words.
WINDOW = 2


def terms(line: str) -> Counter:
    """Words and word pairs of a line; pairs keep the parts of a licence's name together."""
    words = _TERM.findall(line.lower())
    return Counter(words) + Counter(f"{a} {b}" for a, b in zip(words, words[1:]))


def text_lines(text: str, markup: bool = False) -> list[str]:
    """Lines with content; in markup every block tag ends a line."""
    if markup:
        text = html.unescape(_TAG.sub("", _BLOCK.sub("\n", _SKIPPED.sub("\n", text))))
    return [x for x in (line.strip(" \t\r*#/;-") for line in text.split("\n")) if x]


def header_lines(text: str) -> list[str]:
    """Lines with content before the first blank one."""
    return text_lines(re.split(r"\n[ \t\r*#/;-]*\n", text.lstrip(), maxsplit=1)[0])


class Matcher:
    """Cosines of a line to all templates, given document frequencies of the templates' terms."""

    def __init__(self, templates: dict[str, list[str]], frequency: dict[str, int], lines: int):
        self.names = [name for name in sorted(templates) for _ in templates[name]]
        counted = [terms(t) for name in sorted(templates) for t in templates[name]]
        self.idf = {t: 1 + math.log((1 + lines) / (1 + frequency.get(t, 0))) for c in counted for t in c}
        self.other = 1 + math.log(1 + lines)  # a term of no template is as rare as can be
        self.postings: dict[str, list[tuple[int, float]]] = {}
        for i, c in enumerate(counted):
            norm = math.sqrt(sum((n * self.idf[t]) ** 2 for t, n in c.items()))
            for t, n in c.items():
                self.postings.setdefault(t, []).append((i, n * self.idf[t] / norm))

        self.weights: list[dict[str, float]] = [{} for _ in counted]
        for t, own in self.postings.items():
            for i, w in own:
                self.weights[i][t] = w
        self.words = [sum(n for t, n in c.items() if " " not in t) for c in counted]
        self.vocabulary = {t for t in self.postings if " " not in t}

    def best(self, line: str) -> tuple[str | None, float]:
        return self.best_of(terms(line))

    def best_of(self, found: Counter) -> tuple[str | None, float]:
        norm = math.sqrt(sum((n * self.idf.get(t, self.other)) ** 2 for t, n in found.items()))
        scores = np.zeros(len(self.names))
        for t, n in found.items():
            for i, w in self.postings.get(t, ()):
                scores[i] += w * n * self.idf[t]
        if not norm or not scores.any():
            return None, 0.0
        at = int(scores.argmax())
        return self.names[at], min(1.0, float(scores[at] / norm))

    def shared(self, words: list[str]) -> set[str]:
        """Terms of the templates among these words and their neighbours."""
        single = self.vocabulary.intersection(words)
        if len(single) < 2:
            return single
        return single | {pair for a, b in zip(words, words[1:]) if a in single and b in single and (pair := f"{a} {b}") in self.postings}

    def bounds(self, present: set[str]) -> list[float]:
        """Squares that the cosine of a text with these terms to each template can't exceed: a cosine is at most the length of the template's part on the shared terms."""
        mass = [0.0] * len(self.names)
        for t in present:
            for i, w in self.postings[t]:
                mass[i] += w * w
        return mass

    def possible(self, present: set[str], threshold: float) -> list[int]:
        """Templates that some part of a text with these terms could reach."""
        return [i for i, m in enumerate(self.bounds(present)) if m >= threshold * threshold - 1e-9]

    def windows(self, units: list[list[str]], i: int) -> tuple[float, float]:
        """Best cosines to template ``i`` of windows of consecutive units: of all, and of those from the first unit.

        A first unit without any of the template's words can only lower a cosine.
        """
        weights, idf, limit = self.weights[i], self.idf, WINDOW * self.words[i]
        best = first = 0.0
        for start, unit in enumerate(units):
            if start and not any(w in weights for w in unit):
                continue
            counts, squares, dot, words, last = {}, 0.0, 0.0, 0, None
            for unit in units[start:]:
                words += len(unit)
                if words > limit and last is not None:
                    break
                for w in unit:
                    for t in (w,) if last is None else (w, f"{last} {w}"):
                        n = counts.get(t, 0)
                        counts[t] = n + 1
                        x = idf.get(t, self.other)
                        squares += (2 * n + 1) * x * x
                        if t in weights:
                            dot += weights[t] * x
                    last = w
                score = min(1.0, dot / math.sqrt(squares))
                best = max(best, score)
                if not start:
                    first = max(first, score)
        return best, first

    def best_in(self, lines: list[str], threshold: float, header: list[str] | None = None) -> tuple[tuple[str | None, float], bool]:
        """The best line, or window of sentences, header or whole text if that reaches ``threshold``; whether the text starts with such a one.

        Of equal scores the first line's counts, and of templates the first by name.
        """
        best, headed, present, last = (None, 0.0), False, set(), None
        for at, line in enumerate(lines):
            words = _TERM.findall(line.lower())
            own = self.shared(words)
            # a line that can't be better needs no cosine
            if own and max(self.bounds(own)) >= best[1] * best[1] - 1e-9:
                got = self.best_of(Counter(words) + Counter(f"{a} {b}" for a, b in zip(words, words[1:])))
                headed |= not at and got[1] >= threshold
                if got[1] > best[1]:
                    best = got
            present |= own
            if words:
                if last is not None and (pair := f"{last} {words[0]}") in self.postings:
                    present.add(pair)
                last = words[-1]
        units = None
        for i in self.possible(present, threshold):
            if units is None:
                units = [w for line in lines for part in _SENTENCE.split(line) if (w := _TERM.findall(part.lower()))]
                wholes = [[[w for x in part for w in _TERM.findall(x.lower())]] for part in (lines, header or [])]
            score, first = self.windows(units, i)
            for whole in wholes:
                if whole[0]:
                    got = self.windows(whole, i)[1]
                    score, first = max(score, got), max(first, got)
            headed |= first >= threshold
            if score >= threshold and score > best[1] + 1e-12:
                best = self.names[i], score
        return best, headed


def term_frequencies(files: DataFrame, templates: dict[str, list[str]], markup: bool) -> tuple[dict[str, int], int]:
    """Lines that hold each term of the templates, and all lines, over every file (as many rows as templates have terms)."""

    def run(batches):
        count, lines, matcher = Counter(), 0, Matcher(templates, {}, 0)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                for line in text_lines(text or "", markup):
                    lines += 1
                    count.update(matcher.shared(_TERM.findall(line.lower())))
        yield pa.RecordBatch.from_arrays([pa.array([*count, None], pa.string()), pa.array([*count.values(), lines], pa.int64())], ["term", "n"])

    rows = map_batches(files.select("text"), run, "term string, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    return {r["term"]: r["n"] for r in rows if r["term"] is not None}, next((r["n"] for r in rows if r["term"] is None), 0)


def scan(files: DataFrame, templates: dict[str, list[str]] | None = None, markup: bool = False, threshold: float = THRESHOLD) -> DataFrame:
    """key, path, own_license, own_score, headed of each row (key, path, text).

    ``own_license`` is the licence of the best line, window of sentences, header
    or whole text from ``threshold`` on (else null, and ``own_score`` is the best
    line's); ``headed`` says that the text starts with such a one.  A null or
    empty text has none and score 0.  Of templates that score alike the first by
    name counts, of lines the first.  Whole texts are read, one at a time,
    however long.  Rows that repeat a key or a path are files of their own.
    """
    templates = templates or TEMPLATES
    frequency, lines = term_frequencies(files, templates, markup)
    kind = files.schema["key"].dataType.simpleString()

    def run(batches):
        matcher = Matcher(templates, frequency, lines)
        for batch in batches:
            names, scores, headed = [], [], []
            for text in batch.column(2).to_pylist():
                best, first = matcher.best_in(text_lines(text or "", markup), threshold, None if markup else header_lines(text or ""))
                names.append(best[0] if best[1] >= threshold else None)
                scores.append(best[1])
                headed.append(first)
            made = [batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(headed, pa.bool_())]
            yield pa.RecordBatch.from_arrays(made, ["key", "path", "own_license", "own_score", "headed"])

    return map_batches(files.select("key", "path", "text"), run, f"key {kind}, path string, own_license string, own_score double, headed boolean")


def directory(path: Column) -> Column:
    """What comes before the last slash ('' at the top)."""
    return F.regexp_extract(path, r"^(.*)/", 1)


def inherit(scanned: DataFrame, governs: Column) -> DataFrame:
    """Adds license, inherited_from and distance to ``scanned``.

    Rows for which ``governs`` holds and that have a licence give it to their
    directory (if several do: the highest score, then the first name).  Without
    a licence of its own a row takes that of the nearest directory from its own
    upward; ``distance`` counts the steps.  Rows without a path inherit nothing.
    Distinct directories look up their ancestors once, however many files they
    hold; files of directories with more than a thousandth of all files are
    joined by broadcast of those directories, which are fewer than a thousand.
    """
    own = materialize(scanned.withColumn("dir", directory(F.col("path"))), "licenses")
    governing = own.where(governs & F.col("own_license").isNotNull() & F.col("path").isNotNull())
    best = governing.groupBy("dir").agg(F.min(F.struct((-F.col("own_score")).alias("s"), "own_license")).alias("best"))
    given = best.select(F.col("dir").alias("above"), F.col("best.own_license").alias("given"))
    sizes = own.where("dir IS NOT NULL").groupBy("dir").agg(F.count("*").alias("files"))
    parts = F.split("dir", "/")
    climbing = sizes.select("dir", F.explode(F.sequence(F.lit(0), F.size(parts))).alias("distance"))
    climbing = climbing.withColumn("above", F.array_join(F.slice(parts, 1, F.size(parts) - F.col("distance")), "/"))
    near = climbing.join(given, "above").groupBy("dir").agg(F.min(F.struct("distance", "above", "given")).alias("near"))
    near = materialize(near, "governed")  # a row for each directory that inherits
    crowded = sizes.where(F.col("files") * 1000 > own.count()).join(near, "dir", "left").select("dir", "near")
    beside = own.where("dir IS NOT NULL").join(F.broadcast(crowded.select("dir")), "dir", "left_anti")
    joined = own.join(F.broadcast(crowded), "dir").unionByName(beside.join(near, "dir", "left"))
    joined = joined.unionByName(own.where("dir IS NULL"), allowMissingColumns=True)
    taken = F.col("own_license").isNull() & F.col("near").isNotNull()
    return joined.select(
        "key", "path", "own_license", "own_score", F.coalesce("own_license", "near.given").alias("license"),
        F.when(taken, F.col("near.above")).alias("inherited_from"), F.when(taken, F.col("near.distance")).alias("distance"),
    )


def url_path(url: Column) -> Column:
    """Host and path of a URL, without scheme, query and fragment."""
    return F.regexp_replace(F.regexp_replace(url, r"[?#].*$", ""), r"^[a-zA-Z][a-zA-Z0-9+.-]*://", "")


def license_scan(files: DataFrame, markup: bool = False, threshold: float = THRESHOLD, headed_governs: bool = False) -> DataFrame:
    """Licences of files (key, path, text): own, or of the nearest ancestor directory.

    Licence files are those named like one; ``headed_governs`` also counts files
    whose first line is a notice (a page titled by it).  Other columns are
    ignored.  A null text is empty, without a licence of its own; a null path
    gives and inherits nothing; both and rows that repeat a key keep their rows.
    No rows give no rows.  Ties: see ``scan`` and ``inherit``.
    """
    name = F.regexp_extract(F.col("path"), r"([^/]*)$", 1)
    governs = name.rlike("^" + LICENSE_FILES.pattern + "$")
    return inherit(scan(files, None, markup, threshold), governs | F.col("headed") if headed_governs else governs)
