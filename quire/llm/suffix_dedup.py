"""Suffix-array dedup: interval expansion on a Burrows-Wheeler transform, bounded by a length."""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from quire.llm._io import table
from quire.llm.repeats import _BYTE, NO_ID, Block, Kind, covered, spread

LENGTH = 50


def suffix_array(t: np.ndarray) -> np.ndarray:
    """Start places of all suffixes of t in order; t has 9-bit symbols and ends with its only 0.

    Sorts by seven symbols at once, then doubles the length, each time among ties alone.
    """
    n, h = len(t), 7
    wide = np.concatenate([t.astype(np.uint64), np.zeros(h, np.uint64)])
    key = np.zeros(n, np.uint64)
    for k in range(h):
        key = key << np.uint64(9) | wide[k : k + n]
    sa = np.argsort(key)
    new = np.r_[True, key[sa[1:]] != key[sa[:-1]]]
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    group = np.flatnonzero(new)[np.cumsum(new) - 1]
    rank[sa] = group
    open_ = np.flatnonzero(~(new & np.r_[new[1:], True]))
    while len(open_):
        at = sa[open_]
        both = rank[at] * (n + 1) + rank[np.minimum(at + h, n)] + 1
        order = np.argsort(both)
        at, both = at[order], both[order]
        sa[open_] = at
        new = np.r_[True, both[1:] != both[:-1]]
        rank[at] = open_[np.flatnonzero(new)[np.cumsum(new) - 1]]
        open_ = open_[~(new & np.r_[new[1:], True])]
        h *= 2
    return sa


def common_prefixes(bwt: np.ndarray, length: int) -> np.ndarray:
    """Whether each suffix in order shares `length` symbols with the one before it.

    Intervals of the suffix array stand for the strings that begin its suffixes. Level by level, each
    is extended backward by every symbol that precedes it. The right border of an extended interval
    parts suffixes whose common prefix has just the level's length; an interval whose border was set
    at an earlier level need not be followed. What is unset after `length` levels is as long or longer.
    """
    n = len(bwt)
    order = np.argsort(bwt, kind="stable").astype(np.int32)  # the k-th occurrence, over the sorted symbols
    lf = np.empty(n, np.int32)
    lf[order] = np.arange(n, dtype=np.int32)
    same = bwt[order[1:]] == bwt[order[:-1]]
    before, after = np.full(n, -1, np.int32), np.full(n, n, np.int32)
    before[order[1:]] = np.where(same, order[:-1], -1)
    after[order[:-1]] = np.where(same, order[1:], n)
    unset = np.ones(n + 1, bool)
    unset[[0, n]] = False
    low, high = np.zeros(1, np.int32), np.full(1, n, np.int32)  # high is exclusive
    for _ in range(length):
        if not len(low):
            break
        one = high - low == 1
        single = lf[low[one]]
        low, high = low[~one], high[~one]
        size = high - low
        at = np.arange(size.sum(), dtype=np.int32) - np.repeat(np.cumsum(size, dtype=np.int32) - size - low, size)
        first, last = before[at] < np.repeat(low, size), after[at] >= np.repeat(high, size)
        # The extended intervals are disjoint, so that sorting matches starts with ends.
        low, high = np.sort(lf[at[first]]), np.sort(lf[at[last]]) + 1
        low, high = np.concatenate([low, single]), np.concatenate([high, single + 1])
        new = unset[high]
        low, high = low[new], high[new]
        unset[high] = False
    return unset[:n]


def _index(pieces: list[bytes]) -> np.ndarray:
    """A number for each window of each piece; windows of LENGTH equal bytes stand together in the suffix array."""
    sizes = np.array(list(map(len, pieces)), np.int64)
    t = np.frombuffer(b"\0".join(pieces) + b"\0\0", np.uint8).astype(np.uint16) + np.uint16(2)
    starts = np.cumsum(sizes + 1) - sizes - 1
    t[starts + sizes], t[-1] = 1, 0
    sa = suffix_array(t)
    number = np.empty(len(t), np.int64)
    number[sa] = np.cumsum(~common_prefixes(t[sa - 1], LENGTH))
    return number[spread(starts, sizes - LENGTH + 1)]


def _bytes(data: np.ndarray, offsets: np.ndarray):
    at = np.arange(len(data))
    return np.take(_BYTE, data), at, at + 1, offsets[:-1]


# Two or three words of 16 bytes recur by chance in more and more texts as a corpus grows; 24 bytes seldom do.
KIND = Kind(LENGTH, 24, bytes, _bytes, _index, len, same_document=False, batch=1 << 17)


def kept(b: Block, removed: np.ndarray, starts: np.ndarray, ends: np.ndarray, firsts: np.ndarray) -> pd.DataFrame:
    """A row for each document of a block: sizes, and removed runs as (start, end) pairs of bytes."""
    rows, data, prefix = [], np.frombuffer(b.data, np.uint8), np.r_[0, np.cumsum(removed)]
    for k in range(len(b.ids)):
        x, y = int(b.offsets[k]), int(b.offsets[k + 1])
        gone, text = int(prefix[y] - prefix[x]), b.data[x:y]
        spans = []
        if gone:
            own = removed[x:y]
            edge = np.flatnonzero(np.diff(np.r_[0, own.astype(np.int8), 0]))
            spans, text = edge.tolist(), data[x:y][~own].tobytes()
        rows.append((None if b.null[k] else int(b.ids[k]), y - x, gone, len(spans) // 2, hashlib.sha256(text).hexdigest(), spans))
    out = pd.DataFrame(rows, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])
    return out.astype({"doc_id": "Int64"})


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document with the runs of bytes that LENGTH bytes also starting in a document of smaller id cover.

    Documents of equal ids leave each other alone, and rows with a null id count as the largest.
    """
    return covered(docs, KIND, kept, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<long>", id_col, text_col)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null and empty texts have no bytes; repeated rows are repeated in the result."""
    return suffix_dedup(table(spark, sf_dir, "documents")).drop("spans")


def oracle() -> str:
    return f"""
WITH d AS (SELECT row_number() OVER () AS no, doc_id, coalesce(doc_id, {NO_ID}) AS id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT no, id, i, substr(h, 2 * i - 1, {2 * LENGTH}) AS s FROM (SELECT no, id, h, unnest(range(1, length(h) // 2 - {LENGTH - 2})) AS i FROM d)),
r AS (SELECT no, i FROM (SELECT no, i, id, min(id) OVER (PARTITION BY s) AS least FROM w) WHERE least < id),
c AS (SELECT no, b, lag(b) OVER (PARTITION BY no ORDER BY b) AS before FROM (SELECT DISTINCT no, i + o AS b FROM r, range({LENGTH}) x(o))),
g AS (SELECT no, count(*) AS n, count(*) FILTER (before IS NULL OR before < b - 1) AS runs FROM c GROUP BY no),
k AS (SELECT e.no, string_agg(substr(h, 2 * b - 1, 2), '' ORDER BY b) AS kept
  FROM (SELECT no, h, unnest(range(1, length(h) // 2 + 1)) AS b FROM d WHERE no IN (SELECT no FROM g)) e ANTI JOIN c ON e.no = c.no AND e.b = c.b GROUP BY e.no)
SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(g.n, 0)::BIGINT AS n_removed, coalesce(g.runs, 0)::BIGINT AS n_spans,
  sha256(unhex(CASE WHEN g.no IS NULL THEN h ELSE coalesce(kept, '') END)) AS kept_sha256
FROM d LEFT JOIN g USING (no) LEFT JOIN k USING (no)
"""
