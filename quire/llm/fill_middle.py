"""Fill-in-middle transformation: cuts found by a sparse index of checkpoints.

A text is counted once, in units (a run of ASCII letters, or any other code point), and every so many
units the byte and the code point reached are written down. A cut is then a binary search among the
checkpoints and a short scan from the one before it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm._io import CHUNK, small_batches, table, trimmed

#: The marks before the prefix, the suffix and the middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Units between checkpoints.
EVERY = 1 << 10
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True


def _starts(raw: np.ndarray, before: int) -> tuple[np.ndarray, np.ndarray]:
    """Which bytes begin a unit, and which a code point; before is the byte ahead of them, 0 for none."""
    letter = _LETTER[raw]
    point = (raw & 0xC0) != 0x80
    follows = np.empty_like(letter)
    follows[:1], follows[1:] = _LETTER[before], letter[:-1]
    return point & ~(letter & follows), point


class Checkpoints:
    """The units of a text counted, with the byte and the code point at which each `every`-th begins.

    A view of the text and two short arrays are kept, whatever its length; it is read in chunks.
    """

    def __init__(self, raw: bytes | memoryview, every: int = EVERY):
        self.raw, self.every, self.units, self.points = np.frombuffer(raw, np.uint8), every, 0, 0
        bytes_, points = [], []
        for at in range(0, len(self.raw), CHUNK):
            start, point = _starts(self.raw[at : at + CHUNK], int(self.raw[at - 1]) if at else 0)
            where = np.flatnonzero(start)
            marks = where[-self.units % every :: every]
            bytes_.append(marks + at)
            # A mark begins a code point: the points ahead of it are those counted so far and in the chunk before it.
            points.append(self.points + np.searchsorted(np.flatnonzero(point), marks))
            self.units, self.points = self.units + len(where), self.points + int(point.sum())
        self.bytes_at = np.concatenate(bytes_) if bytes_ else np.zeros(0, np.int64)
        self.points_at = np.concatenate(points) if points else np.zeros(0, np.int64)

    def cut(self, unit: int) -> tuple[int, int]:
        """Byte and code point at which the unit begins; the text's ends for a unit behind the last."""
        if unit >= self.units:
            return len(self.raw), self.points
        units_at = np.arange(len(self.bytes_at)) * self.every
        k = int(np.searchsorted(units_at, unit, "right")) - 1
        at, left, points = int(self.bytes_at[k]), unit - k * self.every, int(self.points_at[k])
        step, limit = 4 * self.every, int(self.bytes_at[k + 1]) if k + 1 < len(self.bytes_at) else len(self.raw)
        while at < limit:
            part = self.raw[at : min(at + step, limit)]
            start, point = _starts(part, int(self.raw[at - 1]) if at else 0)
            where = np.flatnonzero(start)
            if left < len(where):
                return at + int(where[left]), points + int(point[: where[left]].sum())
            left, at, points = left - len(where), at + len(part), points + int(point.sum())
        raise AssertionError("a unit within the count is always met")


def draws(doc_id: Column, seed: int = 1) -> list[Column]:
    """Four numbers below 2^32 that follow from the id (null: an empty string) and the seed."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 1, plain: int = 10, spm: int = 20, every: int = EVERY) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and output of every row.

    Of 100 rows about `plain` stay as they are, and about `spm` of 100 others get the suffix first;
    so does every text that is empty or holds a mark. A cut lies between units, and parts may be empty.
    Null counts as empty, null ids share their draws, other columns are not read.
    """
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]

    def one(text: pa.StringScalar, h1: int, h2: int, h3: int, h4: int) -> tuple:
        raw = memoryview(text.as_buffer() or b"")
        index = Checkpoints(raw, every)
        whole = raw.tobytes()
        if not whole or h3 % 100 >= 100 - plain or any(m in whole for m in marks):
            return index.units, "plain", None, None, whole
        low, high = sorted((h1 % (index.units + 1), h2 % (index.units + 1)))
        (a, first), (b, second) = index.cut(low), index.cut(high)
        p, m, s = marks[0] + whole[:a], marks[2] + whole[a:b], marks[1] + whole[b:]
        form = "spm" if h4 % 100 < spm else "psm"
        return index.units, form, first, second - first, s + p + m if form == "spm" else p + s + m

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary()]
        for batch in batches:
            numbers = [batch.column(k).to_numpy() for k in range(2, 6)]
            rows = [one(text, *(int(x[k]) for x in numbers)) for k, text in enumerate(batch.column(1))]
            cols = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)] if rows else [pa.array([], t) for t in types]
            cols[4] = cols[4].cast(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols], ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *[h.alias(f"h{k}") for k, h in enumerate(draws(F.col(id_col), seed))])
    return small_batches(rows).mapInArrow(trimmed(run), "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of: its three parts between the marks, put in order again."""
    parts = F.split(output, "<[PSM]>", -1)
    ordered = lambda *k: F.concat(*[parts[i] for i in k])
    return F.when(form == "psm", ordered(1, 3, 2)).when(form == "spm", ordered(2, 3, 1)).otherwise(output)


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output_sha256 and restored_sha256 of every row of documents.

    Null and empty texts are plain, with no units and an empty output. A text of any length is one row,
    counted in chunks. Repeated rows repeat with the same cuts, rows without id share the draws of an
    empty id, an empty table gives none, and no column but doc_id and text is read.
    """
    rows = transform(table(spark, sf_dir, "documents"))
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"), digest(restored(F.col("output"), F.col("form"))).alias("restored_sha256"))


def oracle() -> str:
    h = lambda k: f"CAST('0x' || substr(h, {8 * k + 1}, 8) AS BIGINT)"
    return f"""
    WITH d AS (
        SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
    ), u AS (
        SELECT doc_id, t, h, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') AS units FROM d
    ), c AS (
        SELECT *, len(units) AS n, {h(0)} % (len(units) + 1) AS x, {h(1)} % (len(units) + 1) AS y,
            CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR {h(2)} % 100 >= 90 THEN 'plain'
                WHEN {h(3)} % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
        FROM u
    ), p AS (
        SELECT doc_id, t, n, form, coalesce(array_to_string(units[1:least(x, y)], ''), '') AS a,
            coalesce(array_to_string(units[least(x, y) + 1:greatest(x, y)], ''), '') AS b, coalesce(array_to_string(units[greatest(x, y) + 1:], ''), '') AS c
        FROM c
    )
    SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(a) AS BIGINT) END AS prefix_chars,
        CASE WHEN form <> 'plain' THEN CAST(length(b) AS BIGINT) END AS middle_chars,
        sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || a || '<S>' || c || '<M>' || b ELSE '<S>' || c || '<P>' || a || '<M>' || b END) AS output_sha256,
        sha256(t) AS restored_sha256
    FROM p"""
