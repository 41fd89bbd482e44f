"""Substring dedup with prefix-partitioned suffix trees over words."""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from quire.llm._io import table, word_chunks
from quire.llm.repeats import _BYTE, _ODD, Block, Kind, _mix, covered, spread

WINDOW = 35
#: Suffixes of one subtree; a prefix with more is made longer.
GROUP = 1 << 16
_INVERSE = pow(_ODD, -1, 2**64)
_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        for name, base in (("up", _ODD), ("down", _INVERSE)):
            p = np.full(max(n, 1 << 21), base, np.uint64)
            p[0] = 1
            _powers[name] = np.multiply.accumulate(p)
    return _powers["up"][:n], _powers["down"][:n]


def _words(data: np.ndarray, offsets: np.ndarray):
    """Hash, start and end of each word. Words are single-spaced; each document ends with a newline."""
    gap = (data == 32) | (data == 10)
    ends = np.flatnonzero(gap & np.r_[False, ~gap[:-1]]) if len(data) else np.zeros(0, np.int64)
    starts = np.flatnonzero(~gap & np.r_[True, gap[:-1]]) if len(data) else ends
    up, down = _power(len(data) + 1)
    total = np.r_[np.uint64(0), np.cumsum(_BYTE[data] * up[: len(data)], dtype=np.uint64)]
    hashes = _mix((total[ends] - total[starts]) * down[starts])
    return hashes, starts, ends, np.searchsorted(starts, offsets[:-1])


def prefix_groups(t: np.ndarray, suffixes: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """Suffixes (places in t) by prefixes as long as it takes for a group to be small: (length, places).

    Small groups of one length go together into one subtree's batch. A group of WINDOW equal words
    needs no longer prefix.
    """
    out, todo = [], [(0, suffixes)]
    while todo:
        depth, at = todo.pop()
        if len(at) <= GROUP or depth == WINDOW:
            out.append((depth, at))
            continue
        at = at[np.argsort(t[at + depth], kind="stable")]
        cuts = np.flatnonzero(np.r_[True, np.diff(t[at + depth]) != 0, True])
        start = 0
        for k in range(1, len(cuts)):
            last = k == len(cuts) - 1
            if cuts[k] - cuts[start] <= GROUP and not last and cuts[k + 1] - cuts[start] <= GROUP:
                continue
            # One prefix alone is known one word further; several share only what they shared before.
            todo.append((depth + (k - start == 1), at[cuts[start] : cuts[k]]))
            start = k
    return out


def deep_nodes(t: np.ndarray, depth: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The subtree below one prefix, grown from the root down: (places, node) of the leaves under nodes of WINDOW words.

    A level splits every open node by its next word, all nodes at once. A leaf alone keeps a node of
    its own, since copies of its piece may have been counted together.
    """
    node = np.zeros(len(at), np.int64)
    done_at, done_node, alone = [], [], -1
    if depth and len(at) > 1 and depth < WINDOW:
        depth = 0 if (t[at + depth - 1] != t[at[0] + depth - 1]).any() else depth
    while depth < WINDOW and len(at):
        key = node << 32 | t[at + depth]
        order = np.argsort(key, kind="stable")
        at, key = at[order], key[order]
        new = np.r_[True, key[1:] != key[:-1]]
        single = new & np.r_[new[1:], True]
        done_at.append(at[single])
        done_node.append(np.arange(alone, alone - single.sum(), -1))
        alone -= int(single.sum())
        node = (np.cumsum(new) - 1)[~single]
        at = at[~single]
        depth += 1
    return np.concatenate([*done_at, at]), np.concatenate([*done_node, node])


def _index(pieces: list[bytes]) -> np.ndarray:
    """A number for each window of each piece: that of the node WINDOW words deep which its suffix passes."""
    ids: dict[bytes, int] = {}
    split = [p.split(b" ") for p in pieces]
    t = np.fromiter((ids.setdefault(w, len(ids)) for p in split for w in p), np.int64)
    sizes = np.array(list(map(len, split)), np.int64)
    windows = spread(np.cumsum(sizes) - sizes, sizes - WINDOW + 1)
    number, used = np.zeros(len(t), np.int64), 0
    for depth, at in prefix_groups(t, windows):
        at, node = deep_nodes(t, depth, at)
        _, which = np.unique(node, return_inverse=True)
        number[at] = used + which
        used += int(which.max(initial=-1)) + 1
    return number[windows]


def _clean(raw: memoryview) -> bytes:
    """Words with one space between them and a newline at the end."""
    return b" ".join(b" ".join(part.split()) for part in word_chunks(raw) if not part.isspace()) + b"\n"


KIND = Kind(WINDOW, 3, _clean, _words, _index, lambda t: t.count(b" ") + 1, same_document=True)


def kept(b: Block, removed: np.ndarray, starts: np.ndarray, ends: np.ndarray, firsts: np.ndarray) -> pd.DataFrame:
    """A row for each document of a block: numbers of words, and the text that stays, single-spaced."""
    rows, last = [], np.r_[firsts[1:], len(starts)]
    for k in range(len(b.ids)):
        x, y = int(firsts[k]), int(last[k])
        text, own = b.data[b.offsets[k] : b.offsets[k + 1] - 1], removed[x:y]
        gone = int(own.sum())
        if gone:
            text = b" ".join(compress(text.split(b" "), (~own).tolist()))
        rows.append((None if b.null[k] else int(b.ids[k]), y - x, gone, hashlib.sha256(text).hexdigest(), text.decode("utf-8", "replace")))
    return pd.DataFrame(rows, columns=["doc_id", "n_words", "n_removed", "kept_sha256", "kept"]).astype({"doc_id": "Int64"})


def _digest(*args) -> pd.DataFrame:
    return kept(*args).drop(columns="kept")


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document without the words that windows starting twice or more in the corpus cover, with the text kept."""
    return covered(docs, KIND, kept, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string", id_col, text_col)


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null and empty texts have no words; repeated rows repeat each other's windows."""
    return covered(table(spark, sf_dir, "documents"), KIND, _digest, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def oracle() -> str:
    return f"""
WITH d AS (SELECT row_number() OVER () AS no, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
w AS (SELECT no, i, array_to_string(ws[i:i + {WINDOW - 1}], ' ') AS s FROM (SELECT no, ws, unnest(range(1, len(ws) - {WINDOW - 2})) AS i FROM d)),
r AS (SELECT no, i FROM (SELECT no, i, count(*) OVER (PARTITION BY s) AS n FROM w) WHERE n > 1),
c AS (SELECT DISTINCT no, i + o AS at_word FROM r, range({WINDOW}) x(o)),
g AS (SELECT no, count(*) AS n, list(at_word) AS gone FROM c GROUP BY no)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(g.n, 0)::BIGINT AS n_removed,
  sha256(CASE WHEN g.no IS NULL THEN array_to_string(ws, ' ') ELSE coalesce((SELECT string_agg(ws[k], ' ' ORDER BY k) FROM (SELECT unnest(range(1, len(ws) + 1)) AS k) WHERE NOT list_contains(gone, k)), '') END) AS kept_sha256
FROM d LEFT JOIN g USING (no)
"""
