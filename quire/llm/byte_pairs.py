"""BPE encoding and decoding over bytes: a contiguous array of ranks for each word.

A word starts as one part a byte. Between neighbouring parts stands a boundary with the rank of their
merge; the least rank goes first, the leftmost of equals. Ids are those of the public library, special
tokens met in a text included unless they are said to be plain.
"""

from __future__ import annotations

import json
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm._io import RESIDENT, small_batches, table, trimmed

#: The public pattern that cuts texts into words before byte-level merging.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words of more bytes go through rounds of numpy instead: the array of ranks is for short ones.
SHORT = 256
#: Code points of a text that are words in memory at a time, and words kept with their ids in each of two generations.
PART, CACHED, CACHED_CHARS = 1 << 16, 1 << 18, 48
NONE = 1 << 29


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a vocabulary: itself where it prints, else the next from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


def latin_words():
    """What WORDS finds in texts of code points below 256, which most are: the same classes, written out, for the faster engine."""
    letters, digits, spaces = ("".join(re.escape(chr(c)) for c in range(256) if regex.match(kind, chr(c))) for kind in (r"\p{L}", r"\p{N}", r"\s"))
    return re.compile(f"'(?:[stmd]|re|ve|ll)| ?[{letters}]+| ?[{digits}]+| ?[^{spaces}{letters}{digits}]+|[{spaces}]+(?![^{spaces}])|[{spaces}]+").findall


def pack(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit numbers."""
    return struct.pack(f"<{len(ids)}I", *ids)


class Kept(dict):
    """What `make` made of each word, short ones kept in two generations: a full one becomes the old one."""

    def __init__(self, make):
        super().__init__()
        self.make, self.old = make, {}

    def __missing__(self, word: str) -> bytes:
        got = self.old.get(word)
        if got is None:
            got = self.make(word)
        if len(word) <= CACHED_CHARS:
            if len(self) >= CACHED:
                self.old = dict(self)
                self.clear()
            self[word] = got
        return got


class Coder:
    """A byte-level vocabulary with its merges in order, by the path of the library's file.

    Sent to executors as its path alone. specials=False takes the strings of special tokens in a text as plain text.
    """

    def __init__(self, path: str, specials: bool = True):
        self.path, self.specials = path, specials
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, before = spec["model"], spec["pre_tokenizer"] or {}
        if model["type"] != "BPE" or before.get("type") != "ByteLevel" or before["add_prefix_space"] or not before.get("use_regex", True) or spec["normalizer"] or model.get("ignore_merges"):
            raise ValueError(f"{path} is no plain byte-level vocabulary")
        vocab, letters = model["vocab"], byte_letters()
        of = {c: bytes([b]) for b, c in enumerate(letters)}
        self.bytes_of = {i: b"".join([of[c] for c in t]) for t, i in vocab.items()}
        self.first = [vocab[c] for c in letters]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        if len({a + b for a, b in pairs}) < len(pairs):
            raise ValueError(f"{path}: two merges make the same token")
        #: By the id of a left part, the rank of its merge with each right one; by rank, the new id.
        self.after: dict[int, dict[int, int]] = {i: {} for i in vocab.values()}
        for k, (a, b) in enumerate(pairs):
            self.after[vocab[a]][vocab[b]] = k
        self.made = [vocab[a + b] for a, b in pairs]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
        self._ranks = np.argsort(keys)
        self._pairs = keys[self._ranks]
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec["added_tokens"]):
            raise ValueError(f"{path}: special tokens that take in their surroundings")
        self.bytes_of |= {i: t.encode() for t, i in added.items()}
        self._special = {t: np.uint32(i).tobytes() for t, i in added.items()} if specials else {}
        self._cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self._special, key=len, reverse=True))) + ")") if self._special else None
        self._any, self._latin, self._seam = regex.compile(WORDS).findall, latin_words(), regex.compile(r"(?<=\S)\s")
        self.kept = Kept(self._new)

    def __reduce__(self):
        return once, (self.path, self.specials)

    def short(self, word: bytes) -> list[int]:
        """Ids of a word by its array of ranks: the least is looked for again after each merge."""
        after, made, first = self.after, self.made, self.first
        ids = [first[b] for b in word]
        ranks = [after[a].get(b, NONE) for a, b in zip(ids, ids[1:], strict=False)]
        while ranks and (least := min(ranks)) != NONE:
            k = ranks.index(least)
            ids[k] = new = made[least]
            del ids[k + 1], ranks[k]
            if k:
                ranks[k - 1] = after[ids[k - 1]].get(new, NONE)
            if k < len(ranks):
                ranks[k] = after[new].get(ids[k + 1], NONE)
        return ids

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left << 32 | right
        at = np.minimum(np.searchsorted(self._pairs, keys), len(self._pairs) - 1)
        return np.where(self._pairs[at] == keys, self._ranks[at], NONE)

    def long(self, word: bytes) -> np.ndarray:
        """Ids of a word of any length: all places of the least rank merge in one round.

        That is the same order, since a merge with a new part always ranks behind the one that made it.
        """
        ids = np.array(self.first, np.int64)[np.frombuffer(word, np.uint8)]
        ranks = self._rank(ids[:-1], ids[1:])
        while len(ranks) and (least := ranks.min()) != NONE:
            at = np.flatnonzero(ranks == least)
            # Of places that overlap (one letter repeated) every second one of a run merges, from its left.
            run = np.maximum.accumulate(np.where(np.r_[True, np.diff(at) > 1], np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - run) % 2 == 0]
            ids[at] = self.made[least]
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            ids, at = ids[keep], at - np.arange(len(at))
            ranks = ranks[keep[1:]]
            # A deleted boundary's right neighbour moved one place to the left: both sides are ranked anew.
            for side in (at - 1, at):
                side = side[(side >= 0) & (side < len(ids) - 1)]
                ranks[side] = self._rank(ids[side], ids[side + 1])
        return ids

    def _new(self, word: str) -> bytes:
        raw = word.encode()
        return pack(self.short(raw)) if len(raw) <= SHORT else self.long(raw).astype(np.uint32).tobytes()

    def _words(self, text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self._any(text)
        return self._latin(text)

    def parts(self, text: str) -> Iterator[str]:
        """A text in parts of about PART code points, cut where a space ends a run of anything else: no word crosses that."""
        at = 0
        while at < len(text):
            cut = self._seam.search(text, at + PART) if len(text) - at > PART else None
            end = cut.start() if cut else len(text)
            yield text[at:end] if at or end < len(text) else text
            at = end

    def plain(self, text: str) -> Iterator[bytes]:
        """Ids of a text without special tokens, as little-endian unsigned 32-bit numbers, part by part."""
        for part in self.parts(text):
            yield b"".join(map(self.kept.__getitem__, self._words(part)))

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit numbers; none for null and empty texts."""
        if not text:
            return b""
        if not self._cut or not self._cut.search(text):
            return b"".join(self.plain(text))
        return b"".join(x for s in self._cut.split(text) for x in ([self._special[s]] if s in self._special else self.plain(s)))

    def decode(self, ids: bytes | memoryview) -> str:
        """The text of ids; bytes that are no UTF-8 become U+FFFD."""
        out, step = [], 1 << 16
        for at in range(0, len(ids), 4 * step):
            out.append(b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids[at : at + 4 * step], np.uint32).tolist())))
        return b"".join(out).decode("utf-8", "replace")


def once(path: str, specials: bool) -> Coder:
    """A worker's coder, kept between its tasks until another operator's come."""
    kept = RESIDENT.setdefault("byte_pairs", {})
    if (path, specials) not in kept:
        kept[path, specials] = Coder(path, specials)
    return kept[path, specials]


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encode(docs: DataFrame, coder: Coder, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (binary: little-endian unsigned 32-bit numbers) and n_ids of every row. Other columns are not read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                ids = [coder.encode(text.as_py()) for text in part.column(1)]
                sizes = pa.array([len(x) // 4 for x in ids], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary()), sizes], ["doc_id", "ids", "n_ids"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return small_batches(rows).mapInArrow(trimmed(run, keeps="byte_pairs"), "doc_id long, ids binary, n_ids long")


def decode(rows: DataFrame, coder: Coder, ids_col: str = "ids", out_col: str = "text") -> DataFrame:
    """rows with the text of their ids, as encode() writes them; null ids give a null text."""
    text = F.pandas_udf(lambda s: s.map(lambda ids: None if ids is None else coder.decode(ids)), "string")
    return small_batches(rows).withColumn(out_col, text(ids_col))


def op13_byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row of documents.

    Null and empty texts have no ids and decode to an empty text. A text of any length is one row,
    worked on in parts; a word of over 256 bytes is merged in rounds, with the same ids. Repeated rows
    repeat, equal texts get equal ids, an empty table gives none, and no column but doc_id and text is read.
    """
    coder = Coder(vocabulary())
    rows = decode(encode(table(spark, sf_dir, "documents"), coder), coder)
    return rows.select("doc_id", F.col("n_ids").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))
