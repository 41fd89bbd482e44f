"""Character classes (Java regex syntax) and what counts them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The five Arabic classes, which must stay apart, and further ranges.
ARABIC_BLOCK = r"؀-ۿ"
ARABIC_LETTERS = r"ؠ-يٮ-ۓݐ-ݿࢠ-ࣿﭐ-﷿ﹰ-﻿"
ARABIC_FULL = (
    r"؀-ۿݐ-ݿࡰ-࢟ࢠ-ࣿﭐ-﷿ﹰ-ﻼ"
    r"\x{10E60}-\x{10E7F}\x{10EC0}-\x{10EFF}\x{1EE00}-\x{1EEFF}"
)
ARABIC_SPAN = r"؀-ۿݐ-ݿࢠ-ࣿﭐ-﷿ﹰ-﻿"
DIGITS = r"0-9٠-٩۰-۹"
# Decimal digits of Unicode 14 and 15 (Tangsa, Kawi, Nag Mundari), which \p{Nd} of Java 17 does not know.
LATER_DIGITS = r"\x{16AC0}-\x{16AC9}\x{11F50}-\x{11F59}\x{1E4F0}-\x{1E4F9}"
FOREIGN_SCRIPTS = {
    "Cyrillic": r"Ѐ-ӿ", "Greek": r"Ͱ-Ͽ", "CJK": r"一-鿿",
    "Devanagari": r"ऀ-ॿ", "Thai": r"฀-๿", "Armenian": r"԰-֏",
    "Georgian": r"Ⴀ-ჿ", "Katakana": r"゠-ヿ", "Hangul": r"가-힯",
}
REPLACEMENT, CONTROL = r"�", r"\x00-\x08\x0B\x0C\x0E-\x1F\x7F-\x9F"
FILLER_GLYPH = "\U00010348"
EASTERN = "٠١٢٣٤٥٦٧٨٩۰۱۲۳۴۵۶۷۸۹"


def let(value: Column, body) -> Column:
    """body(value), with value computed once, although body names it often or inside lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def count(text: Column, cls: str) -> Column:
    """Characters of a class."""
    return F.regexp_count(text, F.lit(f"[{cls}]"))


def runs(text: Column, cls: str) -> Column:
    """Maximal runs of a class."""
    return F.regexp_extract_all(text, F.lit(f"[{cls}]+"), F.lit(0))


def longest(found: Column) -> Column:
    """Length of the longest of an array of strings, 0 if there is none."""
    return F.coalesce(F.array_max(F.transform(found, lambda x: F.length(x))), F.lit(0))


def total(found: Column) -> Column:
    return F.aggregate(found, F.lit(0), lambda a, x: a + F.length(x))


def ascii_digits(text: Column) -> Column:
    """Both eastern digit sets as ASCII."""
    return F.translate(text, EASTERN, "01234567890123456789")


def arabic_ratio(text: Column) -> Column:
    return F.coalesce(F.try_divide(count(text, ARABIC_LETTERS).cast("double"), F.length(text)), F.lit(0.0))


def prose_score(text: Column) -> Column:
    """Number of Latin words."""
    return F.regexp_count(text, F.lit("[A-Za-z][A-Za-z'’-]*"))


def prose_from(text: Column, least: int) -> Column:
    """Whether prose_score() is `least` or more, without going on to the text's end."""
    return text.rlike(rf"\A[^A-Za-z]*+(?:[A-Za-z][A-Za-z'’-]*+[^A-Za-z]*+){{{least}}}")


def symbol_count(text: Column) -> Column:
    """Characters that carry no language: not ASCII, letters of the Arabic class, digits of any script, spaces or long dashes."""
    # ASCII is told first, before the classes that need a table.
    found = F.regexp_count(text, F.lit(r"(?U)[[^\x00-\x7F]&&[^" + ARABIC_LETTERS + LATER_DIGITS + r"\s\p{Nd}—–]]"))
    return F.when(text.rlike(r"[^\x00-\x7F]"), found).otherwise(F.when(text.isNotNull(), F.lit(0)))


def symbol_load(text: Column) -> Column:
    """Share of symbols among what is not white space."""
    # Spaces are taken out as bytes: a match for each, a sixth of a text, costs more than all else here.
    solid = let(F.replace(text, F.lit(" "), F.lit("")), lambda t: F.length(t) - F.regexp_count(t, F.lit(r"(?U)\s")))
    return F.coalesce(F.try_divide(symbol_count(text).cast("double"), solid), F.lit(0.0))


def marker_density(text: Column, markers: list[str]) -> Column:
    """Share of Latin word tokens, in lower case, that are markers."""
    share = lambda ts: F.coalesce(F.try_divide(F.size(F.filter(ts, lambda t: t.isin(sorted(set(markers))))).cast("double"), F.size(ts)), F.lit(0.0))
    return let(F.regexp_extract_all(F.lower(text), F.lit("[A-Za-z][A-Za-z'’-]*"), F.lit(0)), share)
