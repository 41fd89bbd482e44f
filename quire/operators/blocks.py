"""Labelled blocks: parsing, rendering and the dialects of sections."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quire.functions import chars, text
from quire.functions.dims import LABELS

#: Stands for a label that was recognized; a control character that clean texts do not hold, and which is removed first.
MARK = "\x01"
ANY = "|".join(LABELS)
BLOCK = "struct<label:string,body:string,start_line:int>"


def _split(marked: Column, labels: str = ANY) -> Column:
    """Blocks of a text whose labels stand between two marks."""
    lines = lambda x: F.length(x) - F.length(F.replace(x, F.lit("\n"), F.lit("")))

    def found(parts: Column) -> Column:
        block = lambda i: F.struct(
            F.regexp_extract(F.get(parts, i), f"({labels})", 1).alias("label"),
            text.strip(F.get(parts, i + 1)).alias("body"),
            lines(F.array_join(F.slice(parts, 1, i), "")).cast("int").alias("start_line"),
        )
        some = F.transform(F.sequence(F.lit(1), F.size(parts) - 2, F.lit(2)), block)
        return F.when(F.size(parts) < 3, F.array().cast(f"array<{BLOCK}>")).otherwise(some)

    return chars.let(F.split(marked, MARK, -1), found)


def _plain(body: Column) -> Column:
    return F.replace(F.regexp_replace(F.coalesce(body, F.lit("")), r"\r\n?", "\n"), F.lit(MARK), F.lit(""))


def parse_lines(body: Column, labels: tuple[str, ...] = LABELS) -> Column:
    """Every block whose label fills its line, in order, repeated ones included."""
    names = "|".join(labels)
    return _split(F.regexp_replace(_plain(body), rf"(?m)^[ \t]*({names}):[ \t]*$", f"{MARK}$1{MARK}"), names)


def first_blocks(blocks: Column) -> Column:
    """The first block of each label."""
    return F.filter(blocks, lambda b, i: F.array_position(F.transform(blocks, lambda x: x["label"]), b["label"]) == i + 1)


def duplicate_labels(blocks: Column) -> Column:
    """Labels that occur twice or more, sorted."""
    names = F.transform(blocks, lambda b: b["label"])
    return F.array_sort(F.array_distinct(F.filter(names, lambda n: F.size(F.filter(names, lambda m: m == n)) > 1)))


def parse_context(body: Column, profile: str = "fixed") -> Column:
    """Blocks whose label heads a line or follows Arabic letters on its line; several may share a line.

    The body begins after the colon. What stands before a label on its line, on a later line than
    the open block began, belongs to that block; profile "compat" drops it.
    """
    letters = chars.ARABIC_LETTERS
    marked = F.regexp_replace(_plain(body), rf"(?m)^[ \t]*({ANY})[ \t]*:", f"{MARK}$1{MARK}")
    inline = rf"(?=(?:{ANY})[ \t]*:)(?<=[{letters}][^\n{MARK}]{{0,2000}})(?<!{MARK})({ANY})[ \t]*:"
    if profile == "compat":
        marked = F.regexp_replace(marked, rf"(?m)^[^\n{MARK}]*[{letters}][^\n{MARK}]*(?<!{MARK})({ANY})[ \t]*:", f"{MARK}$1{MARK}")
    return _split(F.regexp_replace(marked, inline, f"{MARK}$1{MARK}"))


def labelled(body: Column) -> Column:
    """Whether parse_context() finds a block; most texts without one name no label at all."""
    named = F.contains(body, F.lit(MARK))
    for label in LABELS:
        named |= F.contains(body, F.lit(label))
    return F.when(named, F.size(parse_context(body)) > 0).otherwise(F.lit(False))


def bodies(blocks: Column, label: str) -> Column:
    return F.transform(F.filter(blocks, lambda b: b["label"] == label), lambda b: b["body"])


def body_of(blocks: Column, label: str) -> Column:
    """The first body of a label, null if it is missing."""
    return F.get(bodies(blocks, label), F.lit(0))


def labels_of(blocks: Column) -> Column:
    return F.transform(blocks, lambda b: b["label"])


def section(body: Column, label: str, dialect: str = "line") -> Column:
    """A label's section as five readers see it.

    line: a label that fills its line. colon_optional: the colon may be missing or full-width.
    first_english: all after the first "English:" line, without notes. bare: up to the next label at a
    line's start, wherever the body starts. lookahead: pieces that begin with a label anywhere.
    """
    t = _plain(body)
    if dialect == "line":
        return body_of(parse_lines(body), label)
    if dialect == "colon_optional":
        return body_of(_split(F.regexp_replace(t, rf"(?m)^({ANY})\s*[:：]?[ \t]*$", f"{MARK}$1{MARK}")), label)
    if dialect == "first_english":
        rest = F.get(F.split(t, "English:\n", 2), F.lit(1))
        return text.strip(F.regexp_replace(rest, r"(?s)\nNotes:.*|\n\nNotes\n.*", ""))
    if dialect == "bare":
        return F.nullif(text.strip(F.regexp_extract(t, rf"(?ms)^{label}:[ \t]*(.*?)(?=^(?:{ANY}):|\z)", 1)), F.lit(""))
    if dialect == "lookahead":
        found = F.filter(F.split(t, rf"(?=(?:{ANY}):)", -1), lambda s: s.startswith(f"{label}:"))
        return text.strip(F.regexp_replace(F.get(found, F.lit(0)), rf"^{label}:", ""))
    raise ValueError(dialect)


def render(canonical: Column, label: str | Column, body: Column) -> Column:
    """The canonical two-block file."""
    name = F.lit(label) if isinstance(label, str) else label
    return F.concat(F.lit("Arabic:\n"), canonical, F.lit("\n\n"), name, F.lit(":\n"), body, F.lit("\n"))


def split_pages(body: Column, marker: str = r"(?m)^=+ PAGE (\d+) =+$") -> Column:
    """(page_num, content, content_length) of a chapter file between page markers; empty pages are left out."""

    def found(parts: Column) -> Column:
        page = lambda i: F.struct(F.get(parts, i).try_cast("int").alias("page_num"), text.strip(F.get(parts, i + 1)).alias("content"))
        return F.transform(F.sequence(F.lit(1), F.greatest(F.size(parts) - 2, F.lit(1)), F.lit(2)), page)

    pages = chars.let(F.split(F.regexp_replace(_plain(body), marker, f"{MARK}$1{MARK}"), MARK, -1), found)
    full = F.filter(pages, lambda p: p["page_num"].isNotNull() & (p["content"] != ""))
    return F.transform(full, lambda p: F.struct(p["page_num"], p["content"], F.length(p["content"]).alias("content_length")))


def split_response(response: Column, page: Column, single: Column, profile: str = "en") -> Column:
    """One page's part of a model's answer: by translation markers, then by page markers, then by source labels.

    Where nothing fits, "en" gives a stub that keeps the whole answer and "id" gives null; "id" also
    wants a filled Indonesia section.
    """
    part = lambda word: F.nullif(text.strip(F.get(F.regexp_extract_all(
        response, F.concat(F.lit("(?s)--- PAGE "), page.cast("string"), F.lit(rf"{word} ---\n?(.*?)(?=--- PAGE \d+{word} ---|\z)")), F.lit(1)), F.lit(0))), F.lit(""))
    sections = F.filter(F.split(response, r"\n(?=Arabic:)", -1), lambda s: s.startswith("Arabic:"))
    if profile == "id":
        sourced = F.filter(sections, lambda s: F.regexp_extract(s, r"(?s)Arabic:\s*\n(.*?)(?=Indonesia:|Notes:|\z)", 1).rlike(f"[{chars.ARABIC_BLOCK}]"))
        found = F.coalesce(part(r"(?:\s+\w+)?"), part(""), text.strip(F.try_element_at(sourced, F.lit(-1))))
        return F.when(found.rlike(r"Indonesia:\s*\n\s*\S"), found)
    stub = F.when(single, response).otherwise(F.concat(F.lit("Arabic:\n[combined output — see batch]\n\nEnglish:\n"), response))
    return F.coalesce(part(" TRANSLATION"), part(""), F.when(single, text.strip(F.get(sections, F.lit(0)))), stub)


def packed(body: Column, batch_size: int, limit: int = 5000, single_limit: int = 8000, empty: str = "[empty page]") -> Column:
    """A page as it goes into a batch: cut with a marker, or a placeholder."""
    most = single_limit if batch_size == 1 else limit
    t = text.clean(body)
    return F.when(t == "", empty).when(F.length(t) > most, F.concat(F.substring(t, 1, most), F.lit("\n[truncated]"))).otherwise(t)


def payload_text(payload: Column) -> Column:
    """The texts of a nested answer, joined; items of the second kind where the first has none."""
    schema = "output array<struct<type:string,content:array<struct<type:string,text:string>>>>"
    items = F.flatten(F.transform(F.from_json(payload, schema)["output"], lambda o: F.coalesce(o["content"], F.array().cast("array<struct<type:string,text:string>>"))))
    of = lambda kind: F.array_join(F.transform(F.filter(items, lambda c: c["type"] == kind), lambda c: c["text"]), "")
    return F.coalesce(F.nullif(of("output_text"), F.lit("")), F.nullif(of("reasoning_text"), F.lit("")))
