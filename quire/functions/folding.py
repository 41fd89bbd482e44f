"""Text without case and diacritics, natively: Spark's collation for comparing, a table by rule for writing it out."""

from __future__ import annotations

import sys
import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from quire.functions import chars

#: Equal are texts that differ in case and diacritics alone.
COLLATION = "UNICODE_CI_AI"
# Apostrophes that become the plain one, and the letter that only stretches a word.
APOSTROPHES, TATWEEL = "’ʻʾ", "ـ"


def loose(text: Column) -> Column:
    """The text as one that compares without case and diacritics: in ==, groupBy, joins and contains()."""
    return F.collate(text, COLLATION)


def contains(text: Column, query: str) -> Column:
    return F.contains(loose(text), loose(F.lit(query)))


@cache
def _bases() -> tuple[str, str]:
    """Letters that decompose into one letter and marks, and those letters."""
    pairs = []
    for code in range(0xC0, sys.maxunicode + 1):
        c = chr(code)
        if unicodedata.decomposition(c):
            rest = [x for x in unicodedata.normalize("NFD", c) if unicodedata.category(x) != "Mn"]
            if len(rest) == 1 and rest[0] != c:
                pairs.append((c, rest[0]))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


@cache
def _growing() -> dict[int, str]:
    """Of characters whose compatibility decomposition, without marks and tatweel, has n characters: a class of them by n."""
    by: dict[int, list[int]] = {}
    for code in range(0x80, sys.maxunicode + 1):
        if 0xD800 <= code < 0xE000:
            continue
        rest = [x for x in unicodedata.normalize("NFKD", chr(code)) if unicodedata.category(x)[0] != "M" and x != TATWEEL]
        if len(rest) != 1:
            by.setdefault(len(rest), []).append(code)
    return {n: _class(codes) for n, codes in by.items()}


@cache
def _marks() -> str:
    """The non-spacing marks, of the same edition as the decompositions."""
    return _class([c for c in range(0x80, sys.maxunicode + 1) if unicodedata.category(chr(c)) == "Mn"])


def _class(codes: list[int]) -> str:
    ranges: list[list[int]] = []
    for code in codes:
        if ranges and ranges[-1][1] == code - 1:
            ranges[-1][1] = code
        else:
            ranges.append([code, code])
    return "[" + "".join(f"\\x{{{a:x}}}" + (f"-\\x{{{b:x}}}" if b > a else "") for a, b in ranges) + "]"


def fold(text: Column) -> Column:
    """Lower case without diacritics, with one kind of apostrophe. A character that decomposes into several letters or vowel signs (Hangul, some of India) stays composed."""
    letters, plain = _bases()
    bare = F.regexp_replace(F.translate(F.lower(text), letters + APOSTROPHES, plain + "'" * len(APOSTROPHES)), _marks() + "+", "")
    return F.when(text.rlike(r"[^\x00-\x7F]"), bare).otherwise(F.lower(text))


def fold_length(text: Column) -> Column:
    """The length of the text's compatibility decomposition without marks and tatweel, counted without making it."""
    rare = F.array_join(F.regexp_extract_all(text, F.lit(r"[^\x00-\x7F]+"), F.lit(0)), "")

    def counted(r: Column) -> Column:
        n = F.length(text)
        for size, cls in _growing().items():
            n = n + (size - 1) * F.regexp_count(r, F.lit(cls))
        return n

    return F.when(text.rlike(r"[^\x00-\x7F]"), chars.let(rare, counted)).otherwise(F.length(text))


def fold_ratio(text: Column) -> Column:
    """fold_length() to the length; 0 for none."""
    return F.coalesce(F.try_divide(fold_length(text).cast("double"), F.length(text)), F.lit(0.0))
