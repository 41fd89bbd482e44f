"""Cross-tokenizer alignment: a sweep over the token ends of two tokenizers.

Both encode each text, and the ends of their tokens are events. The events of both are put together,
dealt by document and sorted by offset, and a machine that holds no more than the group still open
runs over them: bytes where both have an end close a group, and every end closes a link. Events travel
in packets of consecutive tokens of one tokenizer; a token's end follows from the ids before it.

How often a pair of ids is linked in the whole corpus is counted over blocks of documents: a block sends
each of its pairs once, and gets its count back once, so that a pair that every document has is no hot key.
Pairs travel in packets too, one from each block to each range of B ids, where they are added up and
compared; what comes back stands in the order of what was sent.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import byte_pairs
from quire.llm._io import RESIDENT, ranges_of, save, small_batches, table, trimmed
from quire.llm.byte_pairs import Kept, pack
from quire.llm.pieces import BREAKS, MODEL

#: Tokens in a packet, and pairs of a document counted before a block is closed.
PACKET, BLOCK_PAIRS = 1 << 14, 1 << 21
#: Bytes of pairs and totals that one range of B ids gets.
RANGE_BYTES = 4 << 20
PACKETS = "key long, doc_id long, start long, side int, n int, ids binary"
SWEPT = "block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, slots binary, times binary, pairs binary, totals binary"
ASKED = "range long, block long, pairs binary, totals binary"
ANSWERS = "range long, block long, counts binary, best binary"
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


class Unlike(ValueError):
    """The tokens' bytes are not those of the text."""


class Pieces:
    """A model of pieces in bounded parts: words that no piece crosses are encoded once and kept."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        with open(path, "rb") as f:
            proto = sentencepiece_model_pb2.ModelProto.FromString(f.read())
        spec = proto.normalizer_spec
        if spec.name != "identity" or spec.remove_extra_whitespaces or not spec.add_dummy_prefix or not proto.trainer_spec.byte_fallback:
            raise ValueError(f"{path} changes texts before it cuts them, or has no pieces for bytes")
        spec.add_dummy_prefix = False  # the space before a text is put there by us
        self.model = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
        ids = range(self.model.vocab_size())
        names = [self.model.id_to_piece(i).replace("▁", " ") for i in ids]
        self.bytes_of = {i: bytes([int(p[1:-1], 16)]) if self.model.is_byte(i) else p.encode() for i, p in enumerate(names)}
        plain = [names[i] for i in ids if not (self.model.is_byte(i) or self.model.is_control(i) or self.model.is_unknown(i))]
        if bad := [p for p in plain if " " in p.lstrip(" ")]:
            raise ValueError(f"pieces with a space inside: {bad[:3]}")
        own = re.escape("".join(c for c in BREAKS if not any(c in p for p in plain)))
        self._words = re.compile(f" *[^ {own}]+| +|[{own}]" if own else " *[^ ]+| +").findall
        self._seam = re.compile("(?<=[^ ]) ")
        self.kept = Kept(self._new)

    def _new(self, word: str) -> bytes:
        ids = self.model.encode(word)
        if b"".join(map(self.bytes_of.__getitem__, ids)) != word.encode():
            raise Unlike(word)
        return pack(ids)

    def plain(self, text: str) -> Iterator[bytes]:
        at = 0
        while at < len(text):
            cut = self._seam.search(text, at + byte_pairs.PART) if len(text) - at > byte_pairs.PART else None
            end = cut.start() if cut else len(text)
            yield b"".join(map(self.kept.__getitem__, self._words(text[at:end])))
            at = end


class Both:
    """The two tokenizers, sent to executors as the paths of their files."""

    def __init__(self, a: str, b: str):
        self.paths, self.sides = (a, b), (byte_pairs.Coder(a, specials=False), Pieces(b))
        self.sizes = []
        for side in self.sides:
            self.sizes.append(np.zeros(max(side.bytes_of) + 1, np.int64))
            self.sizes[-1][list(side.bytes_of)] = [len(x) for x in side.bytes_of.values()]
        most = max(map(len, self.sizes))
        self.kind, self.bits = (np.uint16, 16) if most <= 1 << 16 else (np.uint32, 31)
        #: Each id's digits with what follows it: another of its side, the other side, or a group.
        self.names = [f"{i}{after}".encode() for i in range(most) for after in ",|;"]

    def __reduce__(self):
        return once, self.paths

    def spread(self, b: np.ndarray) -> np.ndarray:
        """B ids as other numbers of as many bits, one for each, in which neighbours lie far apart: ranges of them are of like size."""
        return b.astype(np.int64) * (0x9E3779B1 & (1 << self.bits) - 1) & (1 << self.bits) - 1

    def tokens(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of both for a text with a space before it; none where the text is empty or tokens would change it."""
        none = np.zeros(0, self.kind)
        if not text:
            return none, none
        try:
            a, b = (np.frombuffer(b"".join(side.plain(" " + text)), np.uint32).astype(self.kind) for side in self.sides)
        except Unlike:
            return none, none
        return a, b


def once(a: str, b: str) -> Both:
    """A worker's tokenizers, kept between its tasks until another operator's come."""
    kept = RESIDENT.setdefault("token_alignment", {})
    if (a, b) not in kept:
        kept[a, b] = Both(a, b)
    return kept[a, b]


def packets(docs: DataFrame, both: Both, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The token ends of each row in packets: the row's key, where the packet begins, its side, how many ids and the ids, compressed.

    A key is a row's place in its partition, so docs should be a table, whose partitions are the same when they are read again.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, key = pa.Codec("zstd", 1), TaskContext.get().partitionId() << 40
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                key += 1
                for side, ids in enumerate(both.tokens(text.as_py())):
                    starts = np.cumsum(both.sizes[side][ids]) if len(ids) > PACKET else None
                    for at in range(0, max(1, len(ids)), PACKET):
                        part = ids[at : at + PACKET]
                        rows.append((key, doc_id, int(starts[at - 1]) if at else 0, side, len(part), codec.compress(part.tobytes(), asbytes=True)))
                if len(rows) >= 256:
                    yield _batch(rows, PACKETS)
                    rows = []
            yield _batch(rows, PACKETS)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return small_batches(rows).mapInArrow(trimmed(run, keeps="token_alignment"), PACKETS)


_TYPES = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names, kinds = zip(*(x.split() for x in schema.split(", ")), strict=True)
    cols = zip(*rows, strict=True) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, _TYPES[k]) for c, k in zip(cols, kinds, strict=True)], list(names))


class Sweep:
    """The machine for one document: fed with packets in the order of their offsets, it keeps the tokens of the group still open."""

    def __init__(self, both: Both, doc_id: int | None):
        self.both, self.doc_id = both, doc_id
        self.open = [np.zeros(0, both.kind), np.zeros(0, both.kind)]
        self.n, self.groups, self.links, self.digest = [0, 0], 0, 0, None
        self.found: list[tuple[np.ndarray, np.ndarray]] = []

    def feed(self, side: int, ids: np.ndarray) -> None:
        self.open[side] = np.r_[self.open[side], ids] if len(self.open[side]) else ids
        if len(self.open[0]) and len(self.open[1]):
            self._close()

    def _close(self) -> None:
        """Emits all groups that end before either side's tokens run out."""
        (a, b), (size_a, size_b) = self.open, self.both.sizes
        end_a, end_b = np.cumsum(size_a[a]), np.cumsum(size_b[b])
        reach = min(end_a[-1], end_b[-1])
        mark = np.zeros(reach + 1, np.uint8)
        mark[end_a[: np.searchsorted(end_a, reach, "right")]] = 1
        mark[end_b[: np.searchsorted(end_b, reach, "right")]] |= 2
        events = mark[mark > 0]
        shut = events == 3
        last = len(events) - int(np.argmax(shut[::-1])) if shut.any() else 0
        if not last:
            return
        events, shut = events[:last], shut[:last]
        of_a, of_b = (events & 1).astype(np.int64), (events >> 1).astype(np.int64)
        at_a, at_b = np.cumsum(of_a) - of_a, np.cumsum(of_b) - of_b
        keys = self.both.spread(b[at_b]) << self.both.bits | a[at_a]
        self.found.append(np.unique(keys.astype(np.uint32) if self.both.bits == 16 else keys, return_counts=True))
        if len(self.found) > 64:
            self.found = [self._pairs()]
        # Within a group A's ids come first: each id moves behind those of the other side that precede it.
        group = np.cumsum(shut) - shut
        is_a, is_b = of_a > 0, of_b > 0
        n_a, n_b = int(of_a.sum()), int(of_b.sum())
        group_a, group_b = group[is_a], group[is_b]
        sum_a, sum_b = np.cumsum(np.bincount(group_a)), np.bincount(group_b)
        names = np.empty(n_a + n_b, np.int64)
        names[np.arange(n_a) + (np.cumsum(sum_b) - sum_b)[group_a]] = a[:n_a].astype(np.int64) * 3 + shut[is_a]
        names[np.arange(n_b) + sum_a[group_b]] = b[:n_b].astype(np.int64) * 3 + 2 * shut[is_b]
        text = b"".join(map(self.both.names.__getitem__, names.tolist()))
        if self.digest is None:
            self.digest = hashlib.sha256()
        else:
            self.digest.update(b";")
        self.digest.update(memoryview(text)[:-1])
        self.n, self.groups, self.links = [self.n[0] + n_a, self.n[1] + n_b], self.groups + int(shut.sum()), self.links + last
        self.open = [a[n_a:], b[n_b:]]

    def _pairs(self) -> tuple[np.ndarray, np.ndarray]:
        if len(self.found) == 1:
            return self.found[0]
        keys, where = np.unique(np.concatenate([k for k, _ in self.found]), return_inverse=True)
        return keys, np.bincount(where, np.concatenate([n for _, n in self.found])).astype(np.int64)

    def row(self) -> tuple[tuple, tuple[np.ndarray, np.ndarray]]:
        pairs = self._pairs() if self.found else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        return (self.doc_id, *self.n, self.groups, self.links, self.digest.hexdigest() if self.digest else ""), pairs


def _block(number: int, docs: list[tuple]) -> Iterator[pa.RecordBatch]:
    """The rows of a block: a row for each document, with its pairs by their place in the block, and one with the block's pairs in order and their totals."""
    keys = np.concatenate([k for _, (k, _) in docs])
    times = np.concatenate([n for _, (_, n) in docs])
    pairs, place = np.unique(keys, return_inverse=True)
    totals = np.bincount(place, times).astype(np.int64)
    rows, at = [], 0
    for row, (k, n) in docs:
        rows.append((number, *row, np.diff(place[at : at + len(k)], prepend=0).astype(np.uint32).tobytes(), n.astype(np.uint32).tobytes(), None, None))
        at += len(k)
        if len(rows) >= 1024:
            yield _batch(rows, SWEPT)
            rows = []
    yield _batch(rows, SWEPT)
    yield _batch([(number, *[None] * 8, pairs.astype(np.int64).tobytes(), totals.tobytes())], SWEPT)


def sweep(events: DataFrame, both: Both) -> DataFrame:
    """Blocks of documents with their numbers and digests, from packets dealt by document and sorted by offset."""
    sizes = {0: both.kind}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, block, docs, held = pa.Codec("zstd"), TaskContext.get().partitionId() << 32, [], 0
        width, machine, now = np.dtype(sizes[0]).itemsize, None, None
        for batch in batches:
            key, doc_id, _, side, n, ids = (batch.column(k) for k in range(6))
            for k, (this, which, many) in enumerate(zip(key.to_pylist(), side.to_pylist(), n.to_pylist(), strict=True)):
                if this != now:
                    if machine:
                        docs.append(machine.row())
                        held += len(docs[-1][1][0])
                        if held >= BLOCK_PAIRS:
                            yield from _block(block, docs)
                            block, docs, held = block + 1, [], 0
                    now, machine = this, Sweep(both, doc_id[k].as_py())
                if many:
                    machine.feed(which, np.frombuffer(codec.decompress(ids[k].as_buffer(), many * width), sizes[0]))
        if machine:
            yield from _block(block, [*docs, machine.row()])

    dealt = events.repartition("key").sortWithinPartitions("key", "start", "side")
    return small_batches(dealt).mapInArrow(trimmed(run, keeps="token_alignment"), SWEPT)


def asked(swept: DataFrame, both: Both) -> DataFrame:
    """range, block, pairs, totals: each block's pairs once, in packets for ranges of their B ids."""
    bits, packets_ = both.bits, swept.filter("pairs is not null").select("block", "pairs", "totals")
    size = packets_.agg(F.sum(F.octet_length("pairs") + F.octet_length("totals"))).first()[0] or 0
    ranges = min(1 << bits, ranges_of(size, RANGE_BYTES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, pairs, totals in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                keys = np.frombuffer(pairs, np.int64)
                of = (keys >> bits) * ranges >> bits
                cuts = np.flatnonzero(np.r_[True, of[1:] != of[:-1], True]) if len(of) else []
                rows = [(int(of[x]), block, pairs[8 * x : 8 * y], totals[8 * x : 8 * y]) for x, y in zip(cuts, cuts[1:], strict=False)]
                yield _batch(rows, ASKED)

    return small_batches(packets_).mapInArrow(trimmed(run), ASKED)


def counted(asked: DataFrame, both: Both) -> DataFrame:
    """range, block, counts, best: for each packet the counts of its pairs in the corpus, and whether they are their B id's highest."""
    bits = both.bits

    def run(got: pa.Table) -> pa.Table:
        packets_ = [np.frombuffer(x.as_buffer(), np.int64) for x in got["pairs"]]
        pairs, place = np.unique(np.concatenate(packets_), return_inverse=True)
        count = np.zeros(len(pairs), np.int64)
        np.add.at(count, place, np.concatenate([np.frombuffer(x.as_buffer(), np.int64) for x in got["totals"]]))
        first = np.flatnonzero(np.r_[True, np.diff(pairs >> bits) != 0])
        best = count == np.repeat(np.maximum.reduceat(count, first), np.diff(np.r_[first, len(pairs)]))
        places = np.split(place, np.cumsum([len(p) for p in packets_])[:-1])
        answers = [[v[p].tobytes() for p in places] for v in (count, best)]
        return pa.table({"range": got["range"], "block": got["block"], "counts": pa.array(answers[0], pa.binary()), "best": pa.array(answers[1], pa.binary())})

    return asked.groupBy("range").applyInArrow(run, ANSWERS)


def align(docs: DataFrame, both: Both, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Blocks of swept documents, and for each block what counted() says of its pairs."""
    swept = save(sweep(packets(docs, both, id_col, text_col), both), "swept")
    return swept, counted(asked(swept, both), both)


def scored(swept: DataFrame, answers: DataFrame) -> DataFrame:
    """A row for each document, with the links that are best for their B id and the sum of their counts."""

    def run(docs: pa.Table, known: pa.Table) -> pa.Table:
        known = known.sort_by("range")  # as the block's pairs are
        count = np.frombuffer(b"".join(known["counts"].to_pylist()), np.int64)
        top = np.frombuffer(b"".join(known["best"].to_pylist()), np.bool_)
        n_best, sums = [], []
        for slots, times in zip(docs["slots"], docs["times"], strict=True):
            place = np.cumsum(np.frombuffer(slots.as_buffer(), np.uint32), dtype=np.int64)
            many = np.frombuffer(times.as_buffer(), np.uint32).astype(np.int64)
            n_best.append(int(many[top[place]].sum()))
            sums.append(int((many * count[place]).sum()))
        out = {c: docs[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
        return pa.table(out | {"n_best": pa.array(n_best, pa.int64()), "count_sum": pa.array(sums, pa.int64()), "groups_sha256": docs["groups_sha256"]})

    rows = small_batches(swept).filter("slots is not null").drop("pairs", "totals")
    return rows.groupBy("block").cogroup(answers.withColumnRenamed("block", "to").groupBy("to")).applyInArrow(run, RESULT)


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row of documents.

    Null and empty texts, and texts that either tokenizer would give back changed (those with its own
    mark for spaces), have zeros and an empty digest. A text of any length is encoded in parts and swept in packets; a
    group without an end in common is held as a whole. Repeated rows repeat and count each time, an
    empty table gives none, and no column but doc_id and text is read.
    """
    both = Both(byte_pairs.vocabulary(), MODEL)
    return scored(*align(table(spark, sf_dir, "documents"), both))
