"""Near duplicates by their shingle sets: every pair whose Jaccard similarity reaches a threshold, and no other.

SimHash proposes first: nodes whose fingerprints meet under a deletion variant and lie within a few
bits are compared set by set, which puts most copies into their groups. Pairs that fingerprints tell
apart though their sets are alike are found after it. Shingles have one order for all texts, rare
ones first; two sets that are alike enough share one of the first shingles of each (prefix filter),
so texts of different groups meet under these; sizes and places in the order rule further pairs out
(length and position filter), then parity maps do, and what is left is compared set by set. None of
the filters loses a pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm._io import ranges_of, raw_texts, save, small_batches, trimmed
from quire.llm.simhash import BITS, MOST_BITS, RANGE_BYTES, SEED, blobs, classes, components, shingle_hashes, tokens
from quire.llm.simhash import links as fingerprint_links

#: About so many texts tell which shingles are common; they steer the order and never results.
SAMPLE = 1 << 13
LEAST_COMMON, MOST_COMMON = 4, 1 << 17
#: Members of a bucket are compared up to this distance at first; where several components are left, up to WIDER times it, and so on.
REACH, WIDER = 8, 8
_KEPT = 256


def line_of(raw: bytes | memoryview) -> bytes:
    """The words of a text as fingerprints see them: ASCII case and white space alone are folded."""
    return b" ".join(b" ".join(part) for part in tokens(raw) if part)


def _name(line: bytes) -> int:
    return xxhash.xxh64_intdigest(line, SEED)


def shingles(raw: bytes | memoryview, words: int) -> np.ndarray:
    """Distinct XXH64 of the shingles; a text of fewer words is one shingle, one without words has none."""
    return np.unique(np.concatenate([np.zeros(0, np.uint64), *shingle_hashes(raw, words)]))


def majority(own: np.ndarray) -> int:
    """The fingerprint of a set of shingles."""
    total = np.zeros(BITS, np.int64)
    for k in range(0, len(own), 4096):
        total += np.unpackbits(own[k : k + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * total > len(own), bitorder="little").view(np.uint64)[0])


def node(text: Column) -> Column:
    """What names texts that are equal up to case and white space."""

    @F.pandas_udf("long")
    def named(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([_name(line_of((t or "").encode("utf-8", "replace"))) for t in texts], np.uint64).view(np.int64))

    return named(text)


def _common(docs: DataFrame, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that a sample holds several times, and how often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = {line_of(t) for t in raw_texts(batch.column(0))}
            found = np.concatenate([np.zeros(0, np.uint64), *(shingles(x, words) for x in lines)])
            h, n = np.unique(found, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], ["h", "n"])

    share = min(1.0, SAMPLE / max(1, docs.count()))
    some = docs.select("text").sample(share, seed=SEED) if share < 1 else docs.select("text")
    counted = small_batches(some).mapInArrow(trimmed(run), "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COMMON)
    rows = counted.orderBy(F.col("n").desc(), "h").limit(MOST_COMMON).collect()
    h, n = np.array([r.h for r in rows], np.int64).view(np.uint64), np.array([r.n for r in rows], np.int64)
    order = np.argsort(h)
    return h[order], n[order]


def prefix(own: np.ndarray, common: tuple[np.ndarray, np.ndarray], alike: int) -> np.ndarray:
    """The shingles, rarest first, one of which any set alike enough holds among its own such ones."""
    h, n = common
    often = np.zeros(len(own), np.int64)
    if len(h):
        at = np.minimum(np.searchsorted(h, own), len(h) - 1)
        often = np.where(h[at] == own, n[at], 0)
    least = -(-alike * len(own) // 100)
    return own[np.lexsort((own, often))][: len(own) - least + 1 if len(own) else 0]


def parity(own: np.ndarray) -> bytes:
    """For each value of a hash's lowest bits, whether an odd number of the shingles has it; about a bit for each shingle."""
    bits = max(64, 1 << max(0, len(own) - 1).bit_length())
    count = np.bincount((own & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits(count & 1, bitorder="little").tobytes()


def differing(a: bytes, b: bytes) -> int:
    """A lower bound of the shingles that only one of two sets has; the larger map is folded to the smaller."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    n = min(len(x), len(y))
    x, y = (np.bitwise_xor.reduce(v.reshape(-1, n), 0) for v in (x, y))
    return int(np.bitwise_count(x ^ y).sum())


def _prefixes(docs: DataFrame, common: tuple[np.ndarray, np.ndarray], words: int, alike: int) -> DataFrame:
    """(doc_id, node, size, fp, prefix, parity) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, sizes, prints, firsts, maps = [], [], [], [], []
            for t in raw_texts(batch.column(1)):
                line = line_of(t)
                own = shingles(line, words)
                names.append(_name(line))
                sizes.append(len(own))
                prints.append(majority(own))
                firsts.append(prefix(own, common, alike).tobytes())
                maps.append(parity(own))
            numbers = [pa.array(np.array(v, np.uint64).view(np.int64)) for v in (names, sizes, prints)]
            columns = [batch.column(0), *numbers, pa.array(firsts, pa.binary()), pa.array(maps, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "node", "size", "fp", "prefix", "parity"])

    return small_batches(docs).mapInArrow(trimmed(run), "doc_id long, node long, size long, fp long, prefix binary, parity binary")


def _pack(ranges: int):
    """Nodes to blobs of (shingle, node, size and place, root), one for each range of the shingles."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for k in range(0, len(pdf), 1 << 12):
                part = pdf.iloc[k : k + (1 << 12)]
                counts = (part["prefix"].map(len) // 8).to_numpy()
                place = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
                where = np.repeat(part["size"].to_numpy(), counts) << 32 | place
                rows = np.column_stack([np.repeat(part["node"].to_numpy(), counts), where, np.repeat(part["root"].to_numpy(), counts)]).astype(np.int64).view(np.uint64)
                yield from blobs(np.frombuffer(b"".join(part["prefix"]), np.uint64), rows, ranges)

    return run


def candidates(rows: pd.DataFrame, low: int, high: int, alike: int) -> tuple[np.ndarray, pd.DataFrame]:
    """Pairs of nodes of different roots at distances above low and up to high in their buckets, and the rows of buckets with more to compare.

    rows has key, node, size, place and root. Two sets whose first shared shingle stands at places i
    and j share 1 + min(rest after i, rest after j) at most.
    """
    rows = rows.iloc[np.lexsort((rows["node"], rows["size"], rows["key"]))]
    key, name, size, place, root = (rows[c].to_numpy() for c in ("key", "node", "size", "place", "root"))
    found = [np.zeros((0, 2), np.int64)]
    for d in range(low + 1, high + 1):
        a = np.flatnonzero(key[d:] == key[:-d])
        if not len(a):
            break
        b = a + d
        most = np.minimum(size[a] - place[a], size[b] - place[b])
        keep = (root[a] != root[b]) & ((100 + alike) * most >= alike * (size[a] + size[b]))
        a, b = name[a[keep]], name[b[keep]]
        found.append(np.column_stack([np.minimum(a, b), np.maximum(a, b)]))
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    count = np.diff(np.r_[starts, len(key)])
    several = np.minimum.reduceat(root, starts) < np.maximum.reduceat(root, starts) if len(key) else np.zeros(0, bool)
    return np.unique(np.concatenate(found), axis=0), rows[np.repeat((count > high + 1) & several, count)]


_FOUND = "key long, a long, b long, size long, place long, more boolean"


def _found(rows: pd.DataFrame, low: int, high: int, alike: int) -> Iterator[pd.DataFrame]:
    pairs, more = candidates(rows, low, high, alike)
    yield pd.DataFrame({"key": 0, "a": pairs[:, 0], "b": pairs[:, 1], "size": 0, "place": 0, "more": False})
    yield pd.DataFrame({"key": more["key"], "a": more["node"], "b": 0, "size": more["size"], "place": more["place"], "more": True})


def _first(high: int, alike: int):
    def run(_: tuple, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        raw = np.frombuffer(b"".join(x for pdf in batches for x in pdf["pairs"]), np.int64).reshape(-1, 4)
        raw = raw[np.argsort(raw[:, 0], kind="stable")]
        same = raw[1:, 0] == raw[:-1, 0]
        raw = raw[np.r_[False, same] | np.r_[same, False]] if len(raw) else raw
        rows = pd.DataFrame({"key": raw[:, 0], "node": raw[:, 1], "size": raw[:, 2] >> 32, "place": raw[:, 2] & 0xFFFFFFFF, "root": raw[:, 3]})
        yield from _found(rows, 0, high, alike)

    return run


def _again(low: int, high: int, alike: int):
    def run(_: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.concat(_found(pdf, low, high, alike))

    return run


def _sift(alike: int):
    """Pairs whose maps leave it open whether they are alike: those that are differ by (100 - alike) / (100 + alike) of both sizes at most."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            least = [differing(x, y) for x, y in zip(pdf["map_a"], pdf["map_b"], strict=True)]
            both = (pdf["size_a"] + pdf["size_b"]).to_numpy()
            yield pdf.loc[(100 + alike) * np.array(least, np.int64) <= (100 - alike) * both, ["a", "b"]]

    return run


def _compare(words: int, alike: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept: dict[int, np.ndarray] = {}

        def own(name: int, line: bytes) -> np.ndarray:  # the last ones, as pairs come in groups
            if (got := kept.get(name)) is None:
                if len(kept) >= _KEPT:
                    kept.clear()
                got = kept[name] = shingles(line, words)
            return got

        for pdf in batches:
            good = []
            for a, b, x, y in zip(pdf["a"], pdf["b"], pdf["line_a"], pdf["line_b"], strict=True):
                x, y = own(a, x), own(b, y)
                shared = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * shared >= alike * (len(x) + len(y) - shared))
            yield pdf.loc[np.array(good, bool), ["a", "b"]]

    return run


def _lines(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(name, line) of the nodes wanted, each once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = [line_of(t) for t in raw_texts(batch.column(0))]
            names = np.array([_name(x) for x in lines], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(lines, pa.binary())], ["name", "line"])

    every = small_batches(docs.select("text")).mapInArrow(trimmed(run), "name long, line binary")
    return save(every.join(wanted, F.col("name") == F.col("wanted"), "left_semi").groupBy("name").agg(F.first("line").alias("line")), "lines")


def _by_fingerprint(nodes: DataFrame) -> DataFrame:
    """(a, b): nodes with a node of the same fingerprint, and nodes of fingerprints that SimHash links."""
    one = save(nodes.groupBy("fp").agg(F.min("node").alias("first")), "prints")
    same = nodes.join(one.withColumnRenamed("fp", "o_fp"), F.col("fp") == F.col("o_fp")).filter("node != first").select(F.col("node").alias("a"), F.col("first").alias("b"))
    near = fingerprint_links(one, one.count(), MOST_BITS)
    for c in ("a", "b"):
        named = one.select(F.col("fp").alias(f"fp_{c}"), F.col("first").alias(f"first_{c}"))
        near = near.join(named, F.col(c) == F.col(f"fp_{c}"))
    return same.union(near.select(F.col("first_a").alias("a"), F.col("first_b").alias("b")))


def _verified(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, words: int, alike: int) -> DataFrame:
    """The pairs (a, b) whose sets are alike enough."""
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    for c in ("a", "b"):
        maps = nodes.select(F.col("node").alias(f"node_{c}"), F.col("size").alias(f"size_{c}"), F.col("parity").alias(f"map_{c}"))
        pairs = pairs.join(maps, F.col(c) == F.col(f"node_{c}"))
    pairs = save(pairs.select("a", "b", "size_a", "map_a", "size_b", "map_b").mapInPandas(trimmed(_sift(alike)), "a long, b long"), "pairs")
    if pairs.isEmpty():
        return pairs
    lines = _lines(docs, save(pairs.select(F.explode(F.array("a", "b")).alias("wanted")).distinct(), "wanted"))
    for c in ("a", "b"):
        own = lines.select(F.col("name").alias(f"name_{c}"), F.col("line").alias(f"line_{c}"))
        pairs = pairs.join(own, F.col(c) == F.col(f"name_{c}"))
    return save(small_batches(pairs.select("a", "b", "line_a", "line_b")).mapInPandas(trimmed(_compare(words, alike)), "a long, b long"), "links")


def _rooted(nodes: DataFrame, found: DataFrame) -> DataFrame:
    """nodes with the root of each so far."""
    roots = save(components(found).select(F.col("node").alias("r_node"), F.col("root").alias("r_root")), "roots")
    return nodes.join(roots, F.col("node") == F.col("r_node"), "left").withColumn("root", F.coalesce("r_root", "node")).drop("r_node", "r_root")


def links(docs: DataFrame, nodes: DataFrame, words: int, alike: int) -> DataFrame:
    """(a, b) links whose components are those of all pairs of nodes alike enough.

    What SimHash proposes comes first. Buckets then compare near neighbours first. Where members
    still belong to several components, distances widen until every pair of different components
    has been compared, so that large groups of near copies take few comparisons and nothing is left out.
    """
    out = _verified(docs, nodes, _by_fingerprint(nodes), words, alike)
    size = nodes.agg(F.sum(F.octet_length("prefix"))).first()[0] or 0
    ranges = ranges_of(4 * size, RANGE_BYTES)
    packed = _rooted(nodes.select("node", "size", "prefix"), out).mapInPandas(trimmed(_pack(ranges)), "range long, pairs binary")
    found = save(packed.groupBy("range").applyInPandas(_first(REACH, alike), _FOUND), "candidates")
    low, high = 0, REACH
    while True:
        out = save(out.union(_verified(docs, nodes, found.filter(~F.col("more")).select("a", "b"), words, alike)), "links")
        more = found.filter("more")
        if more.isEmpty():
            return out
        low, high = high, high * WIDER
        rows = _rooted(more.select("key", F.col("a").alias("node"), "size", "place"), out)
        found = save(rows.groupBy(F.col("key").alias("bucket")).applyInPandas(_again(low, high, alike), _FOUND), "candidates")


def near_duplicates(docs: DataFrame, alike: int, words: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, node, component_id, root) for every row; links are the pairs with a Jaccard similarity of alike percent at least.

    node names texts equal up to ASCII case and white space; null and empty texts and others without
    words are one node.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = save(_prefixes(docs, _common(docs, words), words, alike), "prefixes")
    first = [F.first(c).alias(c) for c in ("size", "fp", "prefix", "parity")]
    nodes = save(rows.groupBy("node").agg(F.min("doc_id").alias("least_id"), *first), "nodes")
    return classes(rows.select("doc_id", "node"), nodes, links(docs, nodes, words, alike))
