"""HTML character references as Spark expressions: the standard's named ones from a table, numeric ones by arithmetic."""

from __future__ import annotations

import html.entities
import json
import zlib

from pyspark.sql import Column
from pyspark.sql import functions as F

from quire.functions import chars

#: A reference, other text, or a lone ampersand.
TOKEN = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)|[^&]+|&"
#: Names are looked up in a bucket of their checksum, so that a lookup compares a name or two.
BUCKETS = 4096
#: Names that also count without a semicolon, and then at the head of longer ones.
OPEN = {n: v for n, v in html.entities.html5.items() if not n.endswith(";")}
LONGEST_OPEN = max(map(len, OPEN))


def _table(names: dict[str, str]) -> Column:
    buckets: list[dict[str, str]] = [{} for _ in range(BUCKETS)]
    for name, value in names.items():
        buckets[zlib.crc32(name.encode()) % BUCKETS][name] = value
    return F.from_json(F.lit(json.dumps(buckets)), "array<map<string,string>>")


def _named(table: Column, name: Column) -> Column:
    return F.try_element_at(F.get(table, F.pmod(F.crc32(name.cast("binary")), F.lit(BUCKETS)).cast("int")), name)


def character(code: Column) -> Column:
    """The character of a code point, as browsers read a numeric reference: bytes of an old code page, nothing for what is no character."""
    page = {0: "�", 13: "\r"} | {b: bytes([b]).decode("cp1252", "ignore") or chr(b) for b in range(0x80, 0xA0)}
    old = F.try_element_at(F.create_map(*[F.lit(x) for kv in page.items() for x in kv]), code.cast("int"))
    wrong = code.between(0xD800, 0xDFFF) | (code > 0x10FFFF) | code.isNull()
    nothing = code.between(1, 8) | (code == 11) | code.between(14, 31) | (code == 127) | code.between(0xFDD0, 0xFDEF) | (code.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE)
    made = F.decode(F.unhex(F.lpad(F.hex(F.when(wrong, F.lit(0xFFFD).cast("long")).otherwise(code)), 8, "0")), "UTF-32")
    return F.when(wrong, F.lit("�")).when((code < 160) & old.isNotNull(), old).when(nothing, F.lit("")).otherwise(made)


def _number(token: Column) -> Column:
    """The code point of a numeric reference; null beyond any."""
    body = F.rtrim(F.substring(token, F.lit(3), F.length(token) - 2), F.lit(";"))
    is_hex = body.rlike("^[xX]")
    digits = F.regexp_replace(F.regexp_replace(body, "^[xX]", ""), "^0+(?=.)", "")
    return F.when(F.length(digits) <= 8, F.when(is_hex, F.conv(digits, 16, 10)).otherwise(digits).try_cast("long"))


def unescape(text: Column) -> Column:
    """The text with all references read once; unknown ones stay as they are."""
    every, opened = _table(html.entities.html5), _table(OPEN)

    def read(token: Column) -> Column:
        name = F.substring(token, F.lit(2), F.length(token) - 1)
        heads = []
        for k in range(LONGEST_OPEN, 1, -1):
            head = F.when(F.length(name) > k, _named(opened, F.substring(name, F.lit(1), F.lit(k))))
            heads.append(F.concat(head, F.substring(name, F.lit(k + 1), F.length(name))))
        return F.when(F.length(token) < 2, token).when(token.startswith("&#"), F.when(token.rlike("^&#(?:[0-9]|[xX][0-9a-fA-F])"), character(_number(token))).otherwise(token)).otherwise(F.coalesce(_named(every, name), *heads, token))

    tokens = F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))
    parts = F.transform(tokens, lambda t: F.when(t.startswith("&"), read(t)).otherwise(t))
    return F.when(F.contains(text, F.lit("&")), F.array_join(parts, "")).otherwise(text)
