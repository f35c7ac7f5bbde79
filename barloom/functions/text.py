"""Text rules: company names, symbols, durations, row hashes, path-safe names."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words that don't tell companies apart; they are removed from names before these are compared.
LEGAL_WORDS = ["inc", "incorporated", "corp", "corporation", "co", "company", "ltd", "limited", "plc", "llc", "class", "common", "stock"]


def _folds() -> tuple[str, str]:
    """Latin letters with marks, and the plain letter that each decomposes into."""
    pairs = [(chr(c), unicodedata.normalize("NFKD", chr(c))[0]) for c in range(0xC0, 0x250)]
    pairs = [(c, base) for c, base in pairs if c.lower() == c and base.isascii() and base.isalnum()]
    return "".join(c for c, _ in pairs), "".join(base for _, base in pairs)


ACCENTED, PLAIN = _folds()


def normalized_name(name: Column) -> Column:
    """Lower case, other characters than ASCII letters and digits as spaces, without ``LEGAL_WORDS``; null if nothing is left."""
    bare = F.regexp_replace(F.lower(F.trim(name)), "[^a-z0-9]+", " ")
    return F.nullif(F.trim(F.regexp_replace(bare, rf"\b(?:{'|'.join(LEGAL_WORDS)})\b", "")), F.lit(""))


def normalized_symbol(symbol: Column) -> Column:
    return F.nullif(F.upper(F.trim(symbol)), F.lit(""))


def padded_cik(cik: Column) -> Column:
    """Ten digits; longer or non-numeric input gives null."""
    text = F.trim(cik.cast("string"))
    return F.when(text.rlike(r"^\d{1,10}$"), F.lpad(text, 10, "0"))


def duration_seconds(text: Column) -> Column:
    """Seconds of an ISO-8601 duration of days to seconds, null if it isn't one."""
    fine = text.rlike(r"^P(?=.)(\d+D)?(T(?=\d)(\d+H)?(\d+M)?(\d+S)?)?$")
    part = lambda unit: F.coalesce(F.nullif(F.regexp_extract(text, rf"(\d+){unit}", 1), F.lit("")).cast("long"), F.lit(0))
    return F.when(fine, part("D") * 86400 + part("H") * 3600 + part("M") * 60 + part("S"))


def clock(seconds: Column) -> Column:
    """h:mm:ss."""
    return F.format_string("%d:%02d:%02d", F.floor(seconds / 3600), F.floor(seconds % 3600 / 60), seconds % 60)


def row_hash(*columns: str) -> Column:
    """sha256 of the values in the order given; null is told from empty."""
    return F.sha2(F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in columns]), 256)


def friendly_name(text: Column, longest: int = 40) -> Column:
    """Path-safe: accents of Latin letters folded, other marks to underscores, cut at a word; from the whole text."""
    folded = F.translate(F.lower(text), ACCENTED, PLAIN)
    safe = F.regexp_replace(F.regexp_replace(folded, r"[^a-z0-9]+", "_"), r"^_+|_+$", "")
    cut = F.when(F.char_length(safe) <= longest, safe).otherwise(F.regexp_replace(F.substring(safe, 1, longest + 1), r"_?[^_]*$", ""))
    return F.coalesce(F.nullif(cut, F.lit("")), F.lit("untitled"))
