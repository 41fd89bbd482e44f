"""Text functions from Column to Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quire.functions import chars, dims

# Patterns of the checks.
BATCH_HEADER = r"(?m)^[ \t]*---[ \t]*PAGE[ \t]+\d+[ \t]*TRANSLATION[ \t]*---[ \t]*$"
COMBINED_STUB = r"(?im)^\[combined output[^\\\]]*\]$"
COMBINED_INLINE = r"(?i)\[combined output[^\]]*\]"
BLANK_SOURCE = r"(?i)\A---\s*\nthere is no text on this page\.\s*\n---\z"
PLACEHOLDER = (
    r"(?i)no (english|indonesian|arabic) text on this page|tidak ada teks pada halaman ini|no visible text|no text visible|"
    r"tidak ada teks yang terlihat|this page is empty|halaman ini kosong|blank page"
)
SCRATCH = r"ELEMENT_MESSAGE|The result of the|four lingual|\bPuPu|what what|/what\b|assistant<|analysis<|<tool_call>|Here's a thinking"
TRUNCATION = {
    "worker": r"(?i)\[\.\.\.|truncated\}|omitted for brevity",
    "completeness": r"(?i)\[\.\.\.|truncated\}|omitted for brevity|remaining pages|\[continue(?:d)? on|see next page",
}
BLANK_NOTE = (
    r"(?i)no (visible )?(arabic )?text|does not contain any|tidak ada teks|tidak mengandung teks|لا يحتوي على أي|صفحة فارغة"
)
DAMAGE_NOTE = r"(?i)unclear|tidak terbaca|tidak dapat dipulihkan|dipertahankan apa|hanya memuat|\[[^\]\n]*(recovered|recoverable|OCR|grid|square|preserve)"
BANNED_HONORIFIC, WANTED_HONORIFIC = "exalted is He", "Most High"
LOCAL_HONORIFIC = r"(?i)\bTa['‘’]ala\b"
VERB_FRAME = r"(?i)(^|[.\n;]\s*|\band\s*)God Most High(?=\s+(?:above|over|beyond)\b)"


def strip(text: Column) -> Column:
    """Without outer white space of any kind; trim() knows only the space."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+\z", "")


def clean(text: Column) -> Column:
    """Line ends as \\n, no outer white space; null becomes empty."""
    return strip(F.regexp_replace(F.coalesce(text, F.lit("")), r"\r\n?", "\n"))


def crlf_to_lf(content: Column) -> Column:
    """CRLF alone, in bytes: through hex digits in pairs, so that nothing is decoded."""
    pairs = F.regexp_replace(F.hex(content), "(..)", "$1 ")
    return F.unhex(F.replace(F.replace(pairs, F.lit("0D 0A "), F.lit("0A ")), F.lit(" "), F.lit("")))


def fold_space(text: Column) -> Column:
    """Runs of white space as one space, none outside."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)\s+", " "))


def strip_artifacts(text: Column) -> Column:
    for pattern in (BATCH_HEADER, COMBINED_STUB, COMBINED_INLINE):
        text = F.regexp_replace(text, pattern, "")
    return strip(F.regexp_replace(text, r"\n{3,}", "\n\n"))


def is_blank_source(text: Column) -> Column:
    return clean(text).rlike(BLANK_SOURCE)


def is_blank_marker(body: Column, lang: str) -> Column:
    return F.lower(clean(body)) == dims.BLANK_MARKERS[lang].lower()


def is_fallback(body: Column, lang: str, profile: str = "parser") -> Column:
    return F.lower(clean(body)).isin(*dims.FALLBACKS[profile][lang])


def is_translation_like(body: Column, lang: str | None = None, wrong: float = 0.02) -> Column:
    """A Latin-script text of some length in the expected language; markers of blank pages count, fallbacks never."""

    def judged(b: Column) -> Column:
        shaped = (F.length(b) >= 25) & chars.prose_from(b, 4) & (chars.arabic_ratio(b) <= 0.15) & (chars.symbol_load(b) <= 0.25)
        if lang is None:
            return shaped
        other = dims.MARKERS["id" if lang == "en" else "en"]
        # What is longer than every marker and fallback is none; b is clean already.
        short = F.length(b) <= max(map(len, (dims.BLANK_MARKERS[lang], *dims.FALLBACKS["parser"][lang])))
        fallback, marker = (short & (F.lower(b).isin(*found)) for found in (dims.FALLBACKS["parser"][lang], [dims.BLANK_MARKERS[lang].lower()]))
        return ~fallback & (marker | (shaped & (chars.marker_density(b, other) <= wrong)))

    return chars.let(strip_artifacts(clean(body)), judged)


def html_escape(text: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def html_to_text(html: Column) -> Column:
    """Inline tags vanish, other tags become a space, the five XML entities and the no-break space are read; & comes last."""
    text = F.regexp_replace(html, r"(?i)</?(?:span|strong|em|b|i|a|u|code)(?:\s[^>]*)?>", "")
    text = F.regexp_replace(text, r"<[^>]*>", " ")
    for a, b in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#x27;", "'"), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def wrap_arabic(text: Column, cls: str = "ar") -> Column:
    """Arabic runs, bridging white space, in spans."""
    run = f"[{chars.ARABIC_SPAN}]+(?:\\s+[{chars.ARABIC_SPAN}]+)*"
    return F.regexp_replace(text, f"({run})", f'<span class="{cls}">$1</span>')


def snippet(text: Column, at: Column, size: Column, before: int = 60, after: int = 80) -> tuple[Column, Column]:
    """(snippet with ellipses, place of the match in it) around code point `at`, counted from 0."""
    start = F.greatest(F.lit(0), at - before)
    end = F.least(F.length(text), at + size + after)
    body = F.substring(text, start + 1, end - start)
    left, right = F.when(start > 0, "…").otherwise(""), F.when(end < F.length(text), "…").otherwise("")
    return F.concat(left, body, right), at - start


def highlight(text: Column, at: Column, size: Column) -> Column:
    """(before, match, after)."""
    cut = lambda a, n: F.substring(text, a, n)
    return F.struct(
        cut(F.lit(1), at).alias("before"), cut(at + 1, size).alias("match"), cut(at + size + 1, F.length(text)).alias("after")
    )


def page_name(page: Column, prefix: str = "page_", suffix: str = ".txt") -> Column:
    return F.concat(F.lit(prefix), F.when(page < 1000, F.lpad(page.cast("string"), 3, "0")).otherwise(page.cast("string")), F.lit(suffix))


def page_list(text: Column) -> Column:
    """Pages of "1-3, 7" as an array; parts that are no range or number are left out."""
    parts = F.transform(F.split(text, r"\s*,\s*"), lambda p: F.struct(
        F.regexp_extract(p, r"^\s*(\d+)", 1).try_cast("int").alias("a"),
        F.coalesce(F.regexp_extract(p, r"-\s*(\d+)\s*$", 1).try_cast("int"), F.regexp_extract(p, r"^\s*(\d+)", 1).try_cast("int")).alias("b"),
    ))
    some = F.filter(parts, lambda p: p["a"].isNotNull() & (p["b"] >= p["a"]))
    return F.flatten(F.transform(some, lambda p: F.sequence(p["a"], p["b"])))


def age_seconds(stamp: Column, now: Column) -> Column:
    """Seconds from an ISO stamp (without zone: UTC) to now; a malformed stamp is infinitely old."""
    return F.coalesce((F.unix_micros(now) - F.unix_micros(F.try_to_timestamp(stamp))) / 1e6, F.lit(float("inf")))


def backoff_seconds(attempt: Column) -> Column:
    """Delay without jitter."""
    return F.least(F.pow(F.lit(2.0), attempt) * 3, F.lit(60.0))


def section_title(text: Column) -> Column:
    """Without outer parentheses."""
    return strip(F.regexp_replace(strip(text), r"^[(（]\s*|\s*[)）]\z", ""))


def canonical_tokens(text: Column, table: dict[str, str], trailing: str = ".,;:!?)") -> Column:
    """Words that begin with a key of table become its value, with their trailing punctuation kept."""

    def fix(token: Column) -> Column:
        tail = F.regexp_extract(token, f"[{trailing}]*\\z", 0)
        out = token
        for prefix, whole in reversed(table.items()):
            out = F.when(token.startswith(prefix), F.concat(F.lit(whole), tail)).otherwise(out)
        return out

    return F.array_join(F.transform(F.split(text, " ", -1), fix), " ")


def sha256_of(record: Column) -> Column:
    """Hash of a struct as compact JSON; give its fields in sorted order. Null fields are left out."""
    return F.sha2(F.to_json(record), 256)
