"""Printed page numbers: seven definitions that differ on purpose, by name."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quire.functions import chars, text

DIALECTS = ("first_number", "marked_line", "top_three", "digits_only", "dashed_line", "late_page", "reader")
NUMBER = r"[٠-٩]+|[0-9]{1,3}"


def _first_line(body: Column) -> Column:
    """First line that is not blank."""
    return F.get(F.filter(F.split(body, "\n", -1), lambda x: x.rlike(r"(?U)\S")), F.lit(0))


def _number(digits: Column) -> Column:
    return F.when(digits != "", F.coalesce(chars.ascii_digits(digits).try_cast("decimal(38,0)").cast("string"), digits))


def folio(body: Column, dialect: str = "first_number", page: Column | None = None) -> Column:
    """The number as a string, null if there is none.

    first_number: the first number of the first line with text. marked_line: the same, if that line
    has a dash or a parenthesis. top_three: all digits of the first of three lines that has any.
    digits_only: all digits of the first line, "?" if none. dashed_line: any line that is only a
    number between long dashes. late_page: the first line, wrapped in dashes or parentheses, after
    page 7. reader: wrapped, or at most three digits alone, or before a separator.
    """
    first = _first_line(F.coalesce(body, F.lit("")))
    if dialect == "first_number":
        return _number(F.regexp_extract(first, NUMBER, 0))
    if dialect == "marked_line":
        return F.when(first.rlike("[-—(]"), _number(F.regexp_extract(first, NUMBER, 0)))
    if dialect == "top_three":
        lines = F.slice(F.split(text.strip(F.coalesce(body, F.lit(""))), "\n", -1), 1, 3)
        digits = F.transform(lines, lambda x: F.regexp_replace(x, f"[^{chars.DIGITS}]", ""))
        return chars.ascii_digits(F.get(F.filter(digits, lambda x: x != ""), F.lit(0)))
    if dialect == "digits_only":
        digits = F.regexp_replace(chars.ascii_digits(F.coalesce(first, F.lit(""))), "[^0-9]", "")
        return F.coalesce(F.nullif(digits, F.lit("")), F.lit("?"))
    if dialect == "dashed_line":
        lines = F.transform(F.split(F.coalesce(body, F.lit("")), "\n", -1), lambda x: F.regexp_extract(x, r"^\s*—\s*([0-9٠-٩]+)\s*—\s*\z", 1))
        return chars.ascii_digits(F.get(F.filter(lines, lambda x: x != ""), F.lit(0)))
    if dialect == "late_page":
        wrapped = text.strip(first).rlike(r"^(?:[—–-]\s*[0-9]+\s*[—–-]|\(\s*[0-9]+\s*\))\z")
        return F.when(wrapped & (page > 7), F.regexp_extract(first, "[0-9]+", 0))
    if dialect == "reader":
        line = chars.ascii_digits(text.strip(first))
        found = [
            F.regexp_extract(line, r"^[—–(\[-]\s*([0-9]+)\s*[—–)\]-]\z", 1),
            F.regexp_extract(line, r"^([0-9]{1,3})\z", 1),
            F.regexp_extract(line, r"^([0-9]{1,3})\s*[.)—–:-]", 1),
        ]
        return F.coalesce(*[F.nullif(f, F.lit("")) for f in found])
    raise ValueError(dialect)
