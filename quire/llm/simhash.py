"""SimHash near-dedup with deletion-variant signatures."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, chain

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm._io import ranges_of, raw_texts, save, small_batches, table, trimmed, word_chunks

BITS = 64
MOST_BITS = 3
WORDS = 3
SEED = 42
#: Buckets up to this many fingerprints are compared pair by pair in blocks; larger ones are split further.
PAIRWISE = 1 << 14
#: A sample of so many nodes tells which keys are so frequent that they are split before they are gathered: the ones with COMMON nodes of it or more.
SAMPLE, COMMON = 1 << 16, 16
_BLOCK = 1 << 9
_SMALL = 32
RANGE_BYTES = 8 << 20
#: The lowest bits of a key tell the segment that it fixes; this value stands for a key of a split bucket.
_FINER = np.uint64(7)


def tokens(raw: bytes | memoryview) -> Iterator[list[bytes]]:
    """Words of a text with A-Z in lower case, some thousands at a time; bytes.lower() and bytes.split() know ASCII alone."""
    return (part.lower().split() for part in word_chunks(raw))


def shingle_hashes(raw: bytes | memoryview, words: int, seed: int = SEED) -> Iterator[np.ndarray]:
    """XXH64 of every shingle, repeats included, some thousands at a time; a text of fewer words is one shingle, one without words has none."""
    kept: list[bytes] = []
    digest, found = xxhash.xxh64_intdigest, False
    for part in tokens(raw):
        part = kept + part
        if n := max(0, len(part) - words + 1):
            line, found = b" ".join(part), True
            ends = list(accumulate(map(len, part), lambda a, k: a + 1 + k))
            starts = chain((0,), (e + 1 for e in ends))
            yield np.array([digest(line[a:b], seed) for a, b in zip(starts, ends[words - 1 :], strict=False)], np.uint64)
        kept = part[n:]
    if kept and not found:
        yield np.array([digest(b" ".join(kept), seed)], np.uint64)


def fingerprint(text: str | bytes | memoryview | None, words: int = WORDS, seed: int = SEED) -> int:
    """Majority of the bits of the shingles' XXH64; 0 for a text without words (null: none). Memory is bounded but for the text itself and its longest word."""
    raw = text.encode("utf-8", "replace") if isinstance(text, str) else text or b""
    total, n = np.zeros(BITS, np.int64), 0
    for found in shingle_hashes(raw, words, seed):
        n += len(found)
        for k in range(0, len(found), 4096):
            h = found[k : k + 4096]
            total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * total > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, words: int = WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp) with fingerprints as longs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.fromiter((fingerprint(t, words) for t in raw_texts(batch.column(1))), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp.view(np.int64))], ["doc_id", "fp"])

    return small_batches(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))).mapInArrow(trimmed(run), "doc_id long, fp long")


def segments(low: int, width: int, most_bits: int) -> list[tuple[int, int]]:
    """(low, width) of the segments of which one differs by a bit at most, if the whole does by most_bits: half of them plus one."""
    n = most_bits // 2 + 1
    cuts = [low + width * k // n for k in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


def _mix(v: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        v = (v ^ (v >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
        v = (v ^ (v >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
        return v ^ (v >> np.uint64(33))


def _key(v: np.ndarray, number: int, segment: int) -> np.ndarray:
    """A hash of a variant and its number; the lowest bits tell the segment that it fixes."""
    odd = np.uint64(0x9E3779B97F4A7C15 * (number + 1) % 2**64)
    return _mix(v + odd) & ~np.uint64(7) | np.uint64(segment)


def variants(fp: np.ndarray, low: int, width: int, most_bits: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """For each segment and bit in it: its number, the segment's, and the segment without that bit. Equal values mean one bit apart at most."""
    number = 0
    for segment, (at, size) in enumerate(segments(low, width, most_bits)):
        mask = np.uint64(((1 << size) - 1) << at)
        for bit in range(at, at + size):
            yield number, segment, fp & mask & ~np.uint64(1 << bit)
            number += 1


def _keys(fp: np.ndarray, most_bits: int) -> np.ndarray:
    """The BITS signatures of each fingerprint: all of the first bit, then all of the second, and so on."""
    return np.concatenate([_key(v, n, g) for n, g, v in variants(fp, 0, BITS, most_bits)])


def _finer(key: np.ndarray, fp: np.ndarray, most_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys and fingerprints of rows of large buckets, in finer buckets.

    Linked members of a bucket differ by at most most_bits of the bits outside the segment that its key
    fixes, so those bits, put together, are cut into segments in turn.
    """
    keys, own = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
    for segment, (at, size) in enumerate(segments(0, BITS, most_bits)):
        rows = (key & np.uint64(7)) == segment
        some = fp[rows]
        high = some >> np.uint64(at + size) << np.uint64(at) if at + size < BITS else some & np.uint64(0)
        rest = high | some & np.uint64((1 << at) - 1)
        for n, g, v in variants(rest, 0, BITS - size, most_bits):
            keys.append(_mix(key[rows] ^ _key(v, n, g)) | _FINER)
            own.append(some)
    return np.concatenate(keys), np.concatenate(own)


def blobs(keys: np.ndarray, rows: np.ndarray, ranges: int) -> Iterator[pd.DataFrame]:
    """(key, row) pairs, packed for each range of the keys' hashes."""
    # The lowest bits of a key are no hash; a range takes the others.
    where = ((keys >> np.uint64(3)) % np.uint64(ranges)).astype(np.int64)
    order = np.argsort(where, kind="stable")
    pairs, where = np.column_stack([keys[order], rows[order]]), where[order]
    full = np.flatnonzero(np.r_[True, where[1:] != where[:-1]]) if len(where) else np.zeros(0, np.int64)
    yield pd.DataFrame({"range": where[full], "pairs": [pairs[a:b].tobytes() for a, b in zip(full, np.r_[full[1:], len(where)], strict=False)]})


def _pack(ranges: int, most_bits: int, common: np.ndarray):
    """Nodes to blobs of (key, fingerprint), one for each range of the keys' hashes; rows of common keys go to finer buckets at once."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for k in range(0, len(pdf), 1 << 14):
                fp = pdf["fp"].to_numpy()[k : k + (1 << 14)].astype(np.int64).view(np.uint64)
                keys, fp = _keys(fp, most_bits), np.tile(fp, BITS)
                hot = np.isin(keys, common) if len(common) else np.zeros(len(keys), bool)
                yield from blobs(keys[~hot], fp[~hot], ranges)
                if hot.any():
                    yield from blobs(*_finer(keys[hot], fp[hot], most_bits), ranges)

    return run


def _common_keys(distinct: DataFrame, count: int, most_bits: int) -> np.ndarray:
    """Keys that a sample meets often; at most BITS * SAMPLE / COMMON of them. Small tables have none that matter."""
    if count <= SAMPLE:
        return np.zeros(0, np.uint64)
    some = distinct.select("fp").sample(SAMPLE / count, seed=SEED)
    keys = some.mapInPandas(lambda it: (pd.DataFrame({"key": _keys(pdf["fp"].to_numpy().astype(np.int64).view(np.uint64), most_bits).view(np.int64)}) for pdf in it), "key long")
    counted = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= COMMON)
    return np.array([r.key for r in counted.select("key").collect()], np.int64).view(np.uint64)


def _near(a: np.ndarray, b: np.ndarray, most_bits: int) -> np.ndarray:
    return np.bitwise_count(a ^ b) <= most_bits


def _roots(fp: np.ndarray, most_bits: int) -> np.ndarray:
    """For each of the distinct fingerprints the smallest index it is linked to, over any number of links; blocks bound the memory."""
    root = np.arange(len(fp))
    for a in range(0, len(fp), _BLOCK):
        for b in range(a, len(fp), _BLOCK):
            i, j = np.nonzero(_near(fp[a : a + _BLOCK, None], fp[None, b : b + _BLOCK], most_bits))
            i, j = i + a, j + b
            while len(i):
                ri, rj = root[i], root[j]
                todo = ri != rj
                i, j, ri, rj = i[todo], j[todo], ri[todo], rj[todo]
                np.minimum.at(root, np.maximum(ri, rj), np.minimum(ri, rj))
                while not np.array_equal(up := root[root], root):
                    root[:] = up
    return root


def _edges(pairs: np.ndarray, limit: int | None, most_bits: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Links (member, root) inside the buckets of (key, fingerprint) rows, and the rows of buckets above limit that can be split."""
    pairs = pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]
    starts = np.flatnonzero(np.r_[True, pairs[1:, 0] != pairs[:-1, 0]]) if len(pairs) else np.zeros(0, np.int64)
    ends = np.r_[starts[1:], len(pairs)]
    fp, size = pairs[:, 1], ends - starts
    links, large = [np.zeros((0, 2), np.uint64)], []
    # Most shared buckets are small: neighbours at each distance are compared in all of them at once.
    small = np.repeat((size > 1) & (size <= _SMALL), size)
    key, some = pairs[small, 0], fp[small]
    for d in range(1, _SMALL):
        same = np.flatnonzero(key[d:] == key[:-d])
        if not len(same):
            break
        near = same[_near(some[same + d], some[same], most_bits)]
        links.append(np.column_stack([some[near + d], some[near]]))
    for a, b in zip(starts[size > _SMALL].tolist(), ends[size > _SMALL].tolist(), strict=True):
        own = np.unique(fp[a:b])
        if limit is not None and len(own) > limit and pairs[a, 0] & np.uint64(7) != _FINER:
            large.append(np.column_stack([np.full(len(own), pairs[a, 0]), own]))
            continue
        root = _roots(own, most_bits)
        child = root != np.arange(len(own))
        links.append(np.column_stack([own[child], own[root[child]]]))
    return links, large


def _resolve(limit: int | None, most_bits: int):
    def run(_: tuple, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        packed = [b for pdf in batches for b in pdf["pairs"]]
        links, large = _edges(np.frombuffer(b"".join(packed), np.uint64).reshape(-1, 2), limit, most_bits)
        link = np.unique(np.concatenate(links), axis=0).view(np.int64)
        yield pd.DataFrame({"a": link[:, 0], "b": link[:, 1], "linked": True})
        for rows in large:
            yield pd.DataFrame({"a": rows.view(np.int64)[:, 0], "b": rows.view(np.int64)[:, 1], "linked": False})

    return run


def _split_large(ranges: int, most_bits: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for k in range(0, len(pdf), 1 << 14):
                key, fp = (pdf[c].to_numpy()[k : k + (1 << 14)].astype(np.int64).view(np.uint64) for c in ("a", "b"))
                yield from blobs(*_finer(key, fp, most_bits), ranges)

    return run


def links(distinct: DataFrame, count: int, most_bits: int = MOST_BITS) -> DataFrame:
    """(a, b) links whose components are those of all pairs of fingerprints within most_bits.

    distinct holds each fingerprint once, count says about how many. Each goes with its 64 signatures
    to the ranges of a hash; packed, they take two words each. Inside a bucket members get a link to
    their root instead of one to every partner. Keys that a sample shows to be common are cut again
    before they are gathered, other buckets above PAIRWISE members afterwards. At three bits 31 bits
    are fixed first and 15 or more then, so what is left free, 18 bits, bounds a bucket for good.
    """
    ranges, schema = ranges_of(count * BITS * 16, RANGE_BYTES), "a long, b long, linked boolean"
    # Each row becomes BITS rows, so that few files of nodes are many tasks.
    spread = distinct.select("fp").repartition(max(8, count >> 15))
    packed = spread.mapInPandas(trimmed(_pack(ranges, most_bits, _common_keys(distinct, count, most_bits))), "range long, pairs binary")
    found = save(packed.groupBy("range").applyInPandas(_resolve(PAIRWISE, most_bits), schema), "links")
    finer = found.filter(~F.col("linked")).mapInPandas(_split_large(ranges, most_bits), "range long, pairs binary")
    more = finer.groupBy("range").applyInPandas(_resolve(None, most_bits), schema)
    return found.filter("linked").select("a", "b").union(more.filter("linked").select("a", "b"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each linked node reaches; roots themselves have no row.

    Alternates two star steps until nothing changes: every node's larger neighbours, then its
    smaller ones, are tied to the smallest neighbour. The edges stay as many
    as they are at most, and steps grow with the logarithm of a component's size. What a star's
    centre is joined with is written first, so that the join is dealt anew where a centre is hot.
    """
    e = save(edges.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    mark = lambda df: tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    was = mark(e)
    while was[0]:
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = save(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "least")
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()
        large = save(large, "stars")
        low = save(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        tied = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")
        e = save(tied.union(low.select("u", F.col("m").alias("v"))).distinct(), "stars")
        if (now := mark(e)) == was:
            break
        was = now
    return e.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))


def classes(rows: DataFrame, nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """rows, which name a node each, with component_id and root; nodes has node and least_id, edges links nodes.

    component_id is the smallest id reachable by links, root names the component too. Rows with a null
    id count as documents but never name a component, unless it has no other id.
    """
    roots = components(edges).select(F.col("node").alias("r_node"), F.col("root").alias("r_root"))
    named = nodes.join(roots, F.col("node") == F.col("r_node"), "left").select("node", "least_id", F.coalesce("r_root", "node").alias("root"))
    named = save(named, "named")
    # Written before the join, so that a large component's rows can be split there.
    ids = save(named.groupBy("root").agg(F.min("least_id").alias("component_id")), "ids")
    of = save(named.join(ids, "root").select(F.col("node").alias("c_node"), "component_id", "root"), "component_ids")
    return rows.join(of, F.col("node") == F.col("c_node")).drop("c_node")


def near_duplicates(docs: DataFrame, words: int = WORDS, most_bits: int = MOST_BITS, alike: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, node, component_id, root) for every row; node is the fingerprint as a long.

    With alike, fingerprints only propose, and links are the pairs whose sets of shingles have a
    Jaccard similarity of so many percent at least; node is then shingle_sets.node of the text.

    Documents with equal fingerprints are one node, with the smallest of their ids; links join
    nodes. Null and empty texts and others without words share the fingerprint 0; repeated rows and
    ids stay as many rows. Columns other than id and text are not read, so that no name can clash.
    """
    if alike is not None:
        from quire.llm import shingle_sets

        return shingle_sets.near_duplicates(docs, alike, words, id_col, text_col)
    rows = save(fingerprints(docs, words, id_col, text_col).withColumnRenamed("fp", "node"), "fingerprints")
    nodes = save(rows.groupBy("node").agg(F.min("doc_id").alias("least_id")), "nodes")
    return classes(rows, nodes, links(nodes.select(F.col("node").alias("fp")), nodes.count(), most_bits))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, fingerprint and component_id of every row of documents.

    Null and empty texts, and those of white space alone, have the fingerprint 0 and are linked like
    others; texts of one or two words are one shingle. Repeated rows are rows of one component, a
    tie is none (a bit needs more than half), null ids name a component only where it has no other,
    and an empty table gives none. Columns other than doc_id and text are not read.
    """
    rows = near_duplicates(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", F.lower(F.lpad(F.hex("node"), 16, "0")).alias("fingerprint"), "component_id")
