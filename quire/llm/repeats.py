"""Repeated windows of symbols over a whole corpus: what substring and suffix-array dedup share.

Texts are packed into blocks. Of each window's k-grams the one with the least hash is its anchor, so
equal windows have equal anchors, and runs of windows around one anchor make a piece. Anchors met
once go; the pieces of the others are dealt out by a hash of their anchor, and an index over each
share tells which windows are equal. What is dealt out is packed and counted up block by block
first, so that neither many copies nor a common passage make a large group.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm._io import ranges_of, raw_texts, save, small_batches, trimmed

BLOCK_BYTES = 2 << 20
STEP = 1 << 16
RANGE_BYTES = 6 << 20
#: Symbols that one index is built over; memory is about 150 bytes for each.
INDEX_SYMBOLS = 1 << 20
#: The pieces of an anchor in more blocks than this are cut again by a second anchor.
HOT_BLOCKS = 1 << 10
NO_ID = np.iinfo(np.int64).max

_rng = np.random.default_rng(20)
_BYTE = _rng.integers(1, 2**64, 256, np.uint64)
_ODD = 0x9E3779B97F4A7C15


class Kind(NamedTuple):
    """What a text's symbols are and which windows count."""

    window: int
    gram: int
    clean: Callable[[memoryview], bytes]
    #: Block bytes and offsets of its documents to the hash, start and end of each symbol, and each document's first symbol.
    symbols: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]
    #: Pieces to a number for each window of each piece, in a row; equal windows, and no others, have equal numbers.
    index: Callable[[list[bytes]], np.ndarray]
    #: Symbols of a piece.
    size: Callable[[bytes], int]
    #: Whether copies in one document count.
    same_document: bool
    #: Symbols at which an index is full unless one anchor has more; its arrays should fit the processor's cache.
    batch: int = INDEX_SYMBOLS


class Block(NamedTuple):
    ids: np.ndarray
    null: np.ndarray
    offsets: np.ndarray
    data: bytes

    def packed(self) -> bytes:
        head = np.int64(len(self.ids)).tobytes() + self.ids.tobytes() + self.null.tobytes() + self.offsets.tobytes()
        return zstandard.compress(head + self.data, 3)

    @classmethod
    def of(cls, payload: bytes) -> Block:
        raw = zstandard.decompress(payload)
        n = int(np.frombuffer(raw, np.int64, 1)[0])
        ids, null = np.frombuffer(raw, np.int64, n, 8), np.frombuffer(raw, np.bool_, n, 8 + 8 * n)
        return cls(ids, null, np.frombuffer(raw[8 + 9 * n : 16 + 17 * n], np.int64), raw[16 + 17 * n :])


def pack(docs: DataFrame, kind: Kind, id_col: str, text_col: str) -> DataFrame:
    """(block, bytes, payload): documents in blocks of about BLOCK_BYTES; one longer text is a block of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, ids, texts, size = TaskContext.get().partitionId() << 32, [], [], 0

        def block() -> pa.RecordBatch:
            offsets = np.cumsum([0, *map(len, texts)], dtype=np.int64)
            null = np.array([i is None for i in ids], bool)
            b = Block(np.array([NO_ID if i is None else i for i in ids], np.int64), null, offsets, b"".join(texts))
            return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([size], pa.int64()), pa.array([b.packed()], pa.binary())], ["block", "bytes", "payload"])

        for batch in batches:
            for i, raw in zip(batch.column(0).to_pylist(), raw_texts(batch.column(1)), strict=True):
                t = kind.clean(raw)
                if texts and size + len(t) > BLOCK_BYTES:
                    yield block()
                    number, ids, texts, size = number + 1, [], [], 0
                ids.append(i)
                texts.append(t)
                size += len(t)
        if texts:
            yield block()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return save(small_batches(rows).mapInArrow(trimmed(run), "block long, bytes long, payload binary"), "blocks")


def _mix(v: np.ndarray) -> np.ndarray:
    v = (v ^ (v >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    v = (v ^ (v >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return v ^ (v >> np.uint64(33))


def _grams(h: np.ndarray, k: int) -> np.ndarray:
    """A hash of each k symbols in a row, by doubling."""
    n, span, out, done = len(h) - k + 1, 1, None, 0
    if n <= 0:
        return h[:0]
    while True:
        if k & span:
            out = h[done : done + n].copy() if out is None else out * np.uint64(pow(_ODD, span, 2**64)) + h[done : done + n]
            done += span
        if done == k:
            return _mix(out)
        h = h[:-span] * np.uint64(pow(_ODD, span, 2**64)) + h[span:]
        span *= 2


def _least(v: np.ndarray, k: int) -> np.ndarray:
    """The least of each k values in a row."""
    span = 1
    while span * 2 <= k:
        v = np.minimum(v[:-span], v[span:])
        span *= 2
    rest = k - span
    return np.minimum(v[: len(v) - rest], v[rest:]) if rest else v


def spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers start..start + size - 1 of each pair, in a row."""
    return np.arange(size.sum()) + np.repeat(start - np.cumsum(size) + size, size)


class Pieces(NamedTuple):
    """Runs of windows with one anchor: first and last window, and what identifies the anchor."""

    first: np.ndarray
    last: np.ndarray
    doc: np.ndarray
    range: np.ndarray
    mark: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    firsts: np.ndarray


def pieces(b: Block, kind: Kind, ranges: int) -> Pieces:
    hashes, starts, ends, firsts = kind.symbols(np.frombuffer(b.data, np.uint8), b.offsets)
    first, last, gram = _cut(hashes, firsts, kind)
    doc = np.searchsorted(firsts, first, side="right") - 1  # empty documents stand before the one that begins there
    return Pieces(first, last, doc, *_place(gram, ranges), starts, ends, firsts)


def _place(gram: np.ndarray, ranges: int) -> tuple[np.ndarray, np.ndarray]:
    """Range and mark of an anchor."""
    key = _mix(gram ^ np.uint64(0x5851F42D4C957F2D))
    return ((key >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64), (key & np.uint64(0x7FFFFFFF)).astype(np.int64)


def _cut(hashes: np.ndarray, firsts: np.ndarray, kind: Kind, second: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, last window, hash of the anchor) of the pieces of all documents.

    With second, a piece's windows also share the gram that another hash puts first, and the hash is
    one of both anchors.
    """
    n, found = len(hashes), []
    bounds = np.r_[firsts, n]
    # A few documents at a time, so that the arrays stay in the processor's cache.
    cuts = np.unique(np.r_[np.searchsorted(bounds, np.arange(0, n, STEP)), len(firsts)])
    for i, k in zip(cuts.tolist(), cuts[1:].tolist(), strict=False):
        x, y = int(bounds[i]), int(bounds[k])
        if y - x >= kind.window:
            found.append(_pieces(hashes[x:y], bounds[i:k] - x, kind, x, second))
    none = np.zeros(0, np.int64)
    return tuple(np.concatenate(v) for v in zip(*found, strict=True)) if found else (none, none, none.view(np.uint64))


def _pieces(hashes: np.ndarray, firsts: np.ndarray, kind: Kind, shift: int, second: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes = np.diff(np.r_[firsts, len(hashes)])
    gram = _grams(hashes, kind.gram)
    place = np.arange(len(gram), dtype=np.uint64)

    def anchors(gram: np.ndarray) -> np.ndarray:
        least = _least((gram & np.uint64(0xFFFFFFFF00000000)) | place, kind.window - kind.gram + 1)
        return (least & np.uint64(0xFFFFFFFF)).astype(np.int64)

    s = spread(firsts, np.maximum(sizes - kind.window + 1, 0))
    if not len(s):
        return s, s, gram[:0]
    a = anchors(gram)[s]
    change = a[1:] != a[:-1]
    if second:
        other = anchors(_mix(gram ^ np.uint64(_ODD)))[s]
        change |= other[1:] != other[:-1]
    new = np.flatnonzero(np.r_[True, change | (s[1:] != s[:-1] + 1)])
    of = gram[a[new]]
    return s[new] + shift, s[np.r_[new[1:], len(s)] - 1] + shift, _mix(of + _mix(gram[other[new]])) if second else of


def _anchors(b: Block, p: Pieces, kind: Kind) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The block's distinct anchors, each piece's number among them, and whether the block alone repeats them."""
    anchors, which, count = np.unique(p.range << 31 | p.mark, return_inverse=True, return_counts=True)
    if kind.same_document:
        return anchors, which, count > 1
    ids = b.ids[p.doc] if len(p.doc) else np.zeros(0, np.int64)
    low, high = np.full(len(anchors), NO_ID), np.full(len(anchors), np.iinfo(np.int64).min)
    np.minimum.at(low, which, ids)
    np.maximum.at(high, which, ids)
    return anchors, which, low < high


def _send_anchors(kind: Kind, ranges: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for number, payload in zip(pdf["block"], pdf["payload"], strict=True):
                b = Block.of(payload)
                anchors, _, alone = _anchors(b, pieces(b, kind, ranges), kind)
                of = anchors >> 31
                marks = ((anchors & 0x7FFFFFFF) << 1 | alone).astype(np.uint32)
                full = np.flatnonzero(np.r_[True, of[1:] != of[:-1]]) if len(of) else np.zeros(0, np.int64)
                yield pd.DataFrame({"range": of[full], "block": np.full(len(full), number, np.int64), "marks": [marks[x:y].tobytes() for x, y in zip(full, np.r_[full[1:], len(of)], strict=False)]})

    return run


def _shared(key: tuple, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For each block's anchors of one range: 0 if only it has them and once, 1, or 2 for hot ones."""
    rows = [(int(n), np.frombuffer(m, np.uint32)) for pdf in batches for n, m in zip(pdf["block"], pdf["marks"], strict=True)]
    marks = np.concatenate([m for _, m in rows])
    values, which, count = np.unique(marks >> 1, return_inverse=True, return_counts=True)
    level = np.where(count > HOT_BLOCKS, 2, np.where(count > 1, 1, 0)).astype(np.uint8)[which]
    level = np.maximum(level, (marks & 1).astype(np.uint8))
    cuts = np.cumsum([0, *(len(m) for _, m in rows)])
    yield pd.DataFrame({"block": [n for n, _ in rows], "range": int(key[0]), "levels": [zstandard.compress(level[a:b].tobytes(), 1) for a, b in zip(cuts, cuts[1:], strict=False)]})


def _put(table: dict[int, dict[bytes, list]], r: int, mark: int, text: bytes, at: int, doc: int) -> None:
    own = table.get(r)
    if own is None:
        own = table[r] = {}
    got = own.get(text)
    if got is None:
        own[text] = [mark, doc, doc, [at]]
    else:
        if doc < got[1]:
            got[1] = doc
        elif doc > got[2]:
            got[2] = doc
        got[3].append(at)


def _cut_again(b: Block, p: Pieces, hot: np.ndarray, kind: Kind, ranges: int) -> tuple[np.ndarray, ...]:
    """(range, mark, first, last, doc) of the parts that a second anchor makes of hot pieces."""
    hashes = kind.symbols(np.frombuffer(b.data, np.uint8), b.offsets)[0]
    first, last, gram = _cut(hashes, p.firsts, kind, second=True)
    # Every part lies in one piece, the last that begins at or before it.
    of = np.searchsorted(p.first, first, side="right") - 1
    keep = hot[of]
    return *_place(gram[keep], ranges), first[keep], last[keep], p.doc[of[keep]]


def _send_pieces(kind: Kind, ranges: int):
    """A block's repeated pieces, each distinct one once, in packets for their ranges."""

    def run(_: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = {"range": [], "block": [], "packet": []}
        for number, payload in zip(left["block"], left["payload"], strict=True):
            b = Block.of(payload)
            p = pieces(b, kind, ranges)
            anchors, which, _ = _anchors(b, p, kind)
            level = np.zeros(len(anchors), np.uint8)
            of = anchors >> 31
            for r, levels in zip(right["range"], right["levels"], strict=True):
                a, z = np.searchsorted(of, [r, r + 1])
                level[a:z] = np.frombuffer(zstandard.decompress(levels), np.uint8)
            level = level[which] if len(which) else level[:0]
            table: dict[int, dict[bytes, list]] = {}
            data, w = b.data, kind.window

            some = level == 1
            dealt = [(p.range[some], p.mark[some], p.first[some], p.last[some], p.doc[some])]
            if (level == 2).any():
                dealt.append(_cut_again(b, p, level == 2, kind, ranges))
            for ranges_, marks, firsts, lasts, docs in dealt:
                some = np.argsort(ranges_, kind="stable")
                rows = [ranges_[some], marks[some], p.starts[firsts[some]], p.ends[lasts[some] + w - 1], firsts[some], b.ids[docs[some]]]
                for r, mark, x, y, at, doc in zip(*[v.tolist() for v in rows], strict=True):
                    _put(table, r, mark, data[x:y], at, doc)
            for r, found in table.items():
                texts, rows = list(found), list(found.values())
                parts = [np.array([len(texts), sum(len(x[3]) for x in rows)], np.int64), np.array([x[1] for x in rows], np.int64), np.array([x[2] for x in rows], np.int64)]
                parts += [np.array(v, np.uint32) for v in ([x[0] for x in rows], list(map(len, texts)), [len(x[3]) for x in rows], [a for x in rows for a in x[3]])]
                out["range"].append(r)
                out["block"].append(number)
                out["packet"].append(zstandard.compress(b"".join(v.tobytes() for v in parts) + b"".join(texts), 3))
        return pd.DataFrame(out)

    return run


def _open(packet: bytes) -> tuple[list[np.ndarray], list[bytes]]:
    """Arrays low, high, mark, count, places; and texts."""
    raw = zstandard.decompress(packet)
    n, m = np.frombuffer(raw, np.int64, 2).tolist()
    low, high = np.frombuffer(raw, np.int64, 2 * n, 16).reshape(2, n)
    mark, size, count = np.frombuffer(raw, np.uint32, 3 * n, 16 + 16 * n).reshape(3, n).astype(np.int64)
    at = 16 + 28 * n
    ends = (at + 4 * m + np.cumsum(size)).tolist()
    texts = [raw[e - k : e] for e, k in zip(ends, size.tolist(), strict=True)]
    return [low, high, mark, count, np.frombuffer(raw, np.uint32, m, at).astype(np.int64)], texts


def _value(kind: Kind, number: np.ndarray, low: np.ndarray, count: np.ndarray) -> np.ndarray:
    """For each window, by the number of its class: the least id that has it or, where copies in a document count, 0 if it comes twice; else NO_ID."""
    if not len(number):
        return np.zeros(0, np.int64)
    if kind.same_document:
        return np.where(np.bincount(number, count)[number] > 1, 0, NO_ID)
    least = np.full(int(number.max()) + 1, NO_ID)
    np.minimum.at(least, number, low)
    return least[number]


def _find(kind: Kind, texts: list[bytes], mark: np.ndarray, low: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values of all windows in a row, and each piece's first; pieces of one anchor stay together, and one index holds INDEX_SYMBOLS at most."""
    symbols = np.fromiter(map(kind.size, texts), np.int64, len(texts))
    per = symbols - kind.window + 1
    offset = np.cumsum(per) - per
    out = np.full(per.sum(), NO_ID)
    full = min(INDEX_SYMBOLS, kind.batch)
    order = np.argsort(mark, kind="stable")
    ordered = np.cumsum(symbols[order])
    cuts = np.flatnonzero(np.r_[True, np.diff(mark[order]) != 0, True]) if len(order) else np.zeros(1, np.int64)

    def simple(a: int, z: int, index: Callable = kind.index) -> None:
        if z > a:
            todo = order[a:z]
            number = index([texts[i] for i in todo.tolist()])
            out[spread(offset[todo], per[todo])] = _value(kind, number, np.repeat(low[todo], per[todo]), np.repeat(count[todo], per[todo]))

    begin, done = 0, 0
    for a, z in zip(cuts.tolist(), cuts[1:].tolist(), strict=False):
        before = int(ordered[a - 1]) if a else 0
        size = int(ordered[z - 1]) - before
        if int(ordered[z - 1]) - done > full:
            simple(begin, a)
            begin, done = a, before
        if size > INDEX_SYMBOLS:
            simple(a, z, lambda group: _large(kind, group))
            begin, done = z, int(ordered[z - 1])
    simple(begin, len(order))
    return out, offset


def _large(kind: Kind, texts: list[bytes]) -> np.ndarray:
    """kind.index() for the pieces of one anchor that are too many for one index.

    Their windows are dealt out in the order of a hash, so that equal ones meet in one share. An
    index over each share tells which are equal; of those of one hash that fill more than a share,
    each share's distinct ones go on to the next round.
    """
    data = b"\n".join(texts) + b"\n"
    lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    hashes, starts, ends, firsts = kind.symbols(np.frombuffer(data, np.uint8), np.cumsum(np.r_[0, lengths]))
    per = np.fromiter(map(kind.size, texts), np.int64, len(texts)) - kind.window + 1
    at = spread(firsts, per)
    hashed = _grams(hashes, kind.window)[at]
    number, used, share = np.zeros(len(at), np.int64), 0, max(2, INDEX_SYMBOLS // kind.window)
    order = np.argsort(hashed, kind="stable")
    cuts = np.flatnonzero(np.r_[True, np.diff(hashed[order]) != 0, True])

    def classes(rows: np.ndarray) -> np.ndarray:
        """A number from 0 for the class of each window of rows."""
        if len(rows) <= share:
            texts = [data[x:y] for x, y in zip(starts[at[rows]].tolist(), ends[at[rows] + kind.window - 1].tolist(), strict=True)]
            return np.unique(kind.index(texts), return_inverse=True)[1]
        # One of each class of each share stands for it in the next round.
        found, base, firsts_ = [], 0, []
        for k in range(0, len(rows), share):
            own = classes(rows[k : k + share])
            firsts_.append(k + np.unique(own, return_index=True)[1])
            found.append(own + base)
            base += int(own.max()) + 1
        stand = np.concatenate(firsts_)
        if len(stand) == len(rows):  # all distinct: what shares a hash doesn't shrink
            return np.unique([data[starts[a] : ends[a + kind.window - 1]] for a in at[rows]], return_inverse=True)[1]
        return classes(rows[stand])[np.concatenate(found)]

    begin = 0
    for a, z in zip(cuts.tolist(), cuts[1:].tolist(), strict=False):
        if z - begin > share and begin < a:
            number[order[begin:a]] = classes(order[begin:a]) + used
            used = int(number[order[begin:a]].max()) + 1
            begin = a
        if z == len(order) or z - begin > share:
            number[order[begin:z]] = classes(order[begin:z]) + used
            used = int(number[order[begin:z]].max()) + 1
            begin = z
    return number


def _match(kind: Kind):
    """From the packets of a range to runs of repeated windows, for each block: place, number of windows, value."""

    def run(_: tuple, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number: dict[bytes, int] = {}
        packets = []
        for pdf in batches:
            for block, packet in zip(pdf["block"], pdf["packet"], strict=True):
                (low, high, mark, count, places), own = _open(packet)
                which = np.fromiter([number.setdefault(t, len(number)) for t in own], np.int64, len(own))
                packets.append((block, which, low, high, mark, count, places))
        n = len(number)
        low_of, count_of, mark_of = np.full(n, NO_ID), np.zeros(n, np.int64), np.zeros(n, np.int64)
        for _, which, low, _, mark, count, _ in packets:
            np.minimum.at(low_of, which, low)
            np.add.at(count_of, which, count)
            mark_of[which] = mark
        values, offset = _find(kind, list(number), mark_of, low_of, count_of)
        number.clear()
        # Runs of windows with one value, and each piece's first run.
        new = np.r_[True, values[1:] != values[:-1]] if len(values) else np.zeros(0, bool)
        new[offset] = True
        at = np.flatnonzero(new)
        size, value = np.diff(np.r_[at, len(values)]), values[at]
        some = value != NO_ID
        at, size, value = at[some], size[some], value[some]
        first = np.searchsorted(at, offset)
        runs_of = np.diff(np.r_[first, len(at)])
        for block, which, _, high, _, count, places in packets:
            # A row for each run of each piece, then one for each place of the piece in the block.
            entry = np.repeat(np.arange(len(which)), runs_of[which])
            run = spread(first[which], runs_of[which])
            if not kind.same_document:
                keep = value[run] < high[entry]
                entry, run = entry[keep], run[keep]
            if len(run):
                begin = np.cumsum(count) - count
                here = places[spread(begin[entry], count[entry])] + np.repeat(at[run] - offset[which[entry]], count[entry])
                got = np.stack([here, np.repeat(size[run], count[entry]), np.repeat(value[run], count[entry])])
                yield pd.DataFrame({"block": [block], "runs": [zstandard.compress(got.tobytes(), 1)]})

    return run


def _finish(kind: Kind, ranges: int, report: Callable[[Block, np.ndarray, Pieces], pd.DataFrame]):
    def run(_: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        for payload in left["payload"]:
            b = Block.of(payload)
            _, starts, ends, firsts = kind.symbols(np.frombuffer(b.data, np.uint8), b.offsets)
            n = len(starts)
            edge = np.zeros(n + 1, np.int64)
            sizes = np.diff(np.r_[firsts, n])
            doc = np.repeat(np.arange(len(sizes)), sizes)
            for runs in right["runs"]:
                at, size, value = np.frombuffer(zstandard.decompress(runs), np.int64).reshape(3, -1)
                if not kind.same_document:
                    keep = value < b.ids[doc[at]]
                    at, size = at[keep], size[keep]
                np.add.at(edge, at, 1)
                np.add.at(edge, at + size + kind.window - 1, -1)
            out.append(report(b, edge.cumsum()[:n] > 0, starts, ends, firsts))
        return pd.concat(out)

    return run


def covered(docs: DataFrame, kind: Kind, report: Callable, schema: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """report() of every document, given for each of its symbols whether a repeated window covers it.

    Null texts are empty; rows with a null id stand behind all others; other columns are not read.
    """
    blocks = pack(docs, kind, id_col, text_col)
    ranges = ranges_of(blocks.agg(F.sum("bytes")).first()[0] or 0, RANGE_BYTES)
    blocks = blocks.drop("bytes")
    anchors = blocks.mapInPandas(trimmed(_send_anchors(kind, ranges)), "range long, block long, marks binary")
    levels = anchors.groupBy("range").applyInPandas(_shared, "block long, range long, levels binary")
    sent = blocks.groupBy("block").cogroup(levels.groupBy("block")).applyInPandas(_send_pieces(kind, ranges), "range long, block long, packet binary")
    runs = sent.groupBy("range").applyInPandas(_match(kind), "block long, runs binary")
    return blocks.groupBy("block").cogroup(runs.groupBy("block")).applyInPandas(_finish(kind, ranges, report), schema)
