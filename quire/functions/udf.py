"""What Spark has no function for: Unicode normalization, true case folding, counting a text's windows and what many sets share, vectorized."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType



@F.pandas_udf(StringType())
def _nfkd(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else "".join(c for c in unicodedata.normalize("NFKD", x) if unicodedata.category(c)[0] != "M" and c != "ـ"))


@F.pandas_udf(StringType())
def _casefold(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else x.casefold())


def nfkd_strip(text: Column) -> Column:
    """Compatibility decomposition without marks and tatweel."""
    return _nfkd(text)


def casefold(text: Column) -> Column:
    return _casefold(text)


def needs_honorific(source: Column) -> Column:
    """Whether the two words of the honorific stand side by side, vocalized or not, with the usual clitics."""
    return nfkd_strip(source).rlike(r"(?U)(?<!\w)[وف]?(?:[بك]?الله|لله)\s+تعالى(?!\w)")


def window_counts(texts: list[str], size: int) -> tuple[str | None, int]:
    """The window of `size` characters that begins most often in texts, their last ones left out, and how often; of equal ones that of the highest code points.

    Windows are numbers of as many characters as 64 bits hold; what is longer is ranked and extended, so that the order stays that of the characters.
    """
    parts = [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    lengths = np.array([len(p) for p in parts], np.int64)
    many = np.maximum(lengths - size, 0)
    if not many.sum():
        return None, 0
    letters, codes = np.unique(np.concatenate(parts), return_inverse=True)
    ends = np.cumsum(many)
    at = np.arange(ends[-1]) + np.repeat(np.cumsum(lengths) - lengths - ends + many, many)
    base, done, keys, classes = max(len(letters), 2), 0, np.zeros(len(at), np.int64), 1
    while True:
        while done < size and classes * base < 1 << 63:
            keys = keys * base + codes[at + done]
            classes, done = classes * base, done + 1
        if done == size:
            break
        found, keys = np.unique(keys, return_inverse=True)
        classes = len(found)
    _, first, times = np.unique(keys, return_index=True, return_counts=True)
    best = len(times) - 1 - int(np.argmax(times[::-1]))
    begin = int(at[first[best]])
    return letters[codes[begin : begin + size]].astype(np.uint32).tobytes().decode("utf-32-le", "surrogatepass"), int(times[best])


def top_window(texts: Column, size: int) -> Column:
    """(w, n): the most frequent window of an array of texts, as window_counts() finds it."""

    @F.pandas_udf("w string, n long")
    def found(s: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([window_counts(list(ts), size) for ts in s], columns=["w", "n"]).astype({"w": object, "n": "int64"})

    return found(texts)


#: Members of sets that are looked at together.
MEMBERS = 1 << 20


def common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For rows (part, page, n, hs, partners) sorted by part, those without partners first: small, page, n and how many members both sets have."""
    now = pages = None
    for batch in batches:
        part, page, n, hs, partners = (batch.column(k) for k in range(5))
        members, ends, asked, stops, bare = hs.values.to_numpy(), hs.offsets.to_numpy(), partners.values.to_numpy(), partners.offsets.to_numpy(), partners.is_null().to_pylist()
        found = []
        for k, (of, this, size) in enumerate(zip(part.to_pylist(), page.to_pylist(), n.to_pylist(), strict=True)):
            if of != now:
                now, keys, kept, pages = of, [], [], None
            mine = members[ends[k] : ends[k + 1]]
            if bare[k]:
                keys.append(this)
                kept.append(mine.copy())
                continue
            if pages is None:
                order = np.argsort(keys)
                pages, kept = np.array(keys)[order], [kept[x] for x in order]
                lengths = np.array([len(x) for x in kept])
                begins = np.cumsum(lengths) - lengths
                known, codes = np.unique(np.concatenate(kept), return_inverse=True)
                kept, marked = [], np.zeros(len(known), bool)
            at = np.minimum(np.searchsorted(known, mine), len(known) - 1)
            at = at[known[at] == mine]
            marked[at] = True
            others = np.sort(asked[stops[k] : stops[k + 1]])
            places = np.searchsorted(pages, others)
            cuts = np.flatnonzero(np.diff(np.cumsum(lengths[places]) // MEMBERS)) + 1
            for where, whose in zip(np.split(places, cuts), np.split(others, cuts), strict=True):
                many = lengths[where]
                firsts = np.cumsum(many) - many
                index = np.arange(many.sum()) + np.repeat(begins[where] - firsts, many)
                shared = np.add.reduceat(marked[codes[index]], firsts, dtype=np.int64)
                found.append((np.full(len(whose), this, np.int64), whose, np.full(len(whose), size, np.int64), shared))
            marked[at] = False
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found, strict=True)], ["small", "page", "n", "shared"])


def count_common(dealt: DataFrame) -> DataFrame:
    """(small, page, n, shared): how many members a set has in common with each of its partners' in its part."""
    rows = dealt.select(F.col("part").cast("int"), F.col("page").cast("long"), F.col("n").cast("long"), F.col("hs").cast("array<long>"), F.col("partners").cast("array<long>"))
    whole = rows.repartition("part").sortWithinPartitions("part", F.col("partners").isNotNull())
    return whole.mapInArrow(common, "small long, page long, n long, shared long")
