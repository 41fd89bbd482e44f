"""SentencePiece encoding and decoding: one pass over the matches of an Aho-Corasick automaton.

For unigram models the pass is Viterbi's: it keeps the best sum of scores at each position. In models
made by pair merging a score is the rank of a merge and sums of ranks mean nothing, so there the
pass keeps, at each position, the one piece that agrees with the merge order.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm._io import RESIDENT, small_batches, table, trimmed

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Texts fall apart where no piece crosses: before the spaces that follow anything else, and around these characters.
BREAKS = "\n\r\t"
CACHED, CACHED_CHARS = 1 << 18, 48


class Vocabulary:
    """Pieces with scores, and the automaton over them; spaces stand for the model's space mark.

    The mark itself, met in a text, is no piece and goes through bytes, so that decoding gives back
    every text exactly.
    """

    def __init__(self, pieces: list[tuple[int, str, float]], byte_ids: list[int], merged: bool = False):
        self.pieces, self.byte_ids, self.merged = pieces, byte_ids, merged
        if bad := [p for _, p, _ in pieces if " " in p.lstrip(" ")]:
            raise ValueError(f"pieces with a space inside: {bad[:3]}")
        if len(byte_ids) != 256:
            raise ValueError("the model has no byte pieces")
        self.unknown = min((s for *_, s in pieces), default=0.0) - 10.0
        self.bytes_of = {i: p.encode() for i, p, _ in pieces} | {i: bytes([b]) for b, i in enumerate(byte_ids)}
        self._build()
        self._score, self._text = {p: s for _, p, s in pieces}, {i: p for i, p, _ in pieces}
        self._halves: dict[str, tuple[str, str] | None] = {}
        own = re.escape("".join(c for c in BREAKS if not any(c in p for _, p, _ in pieces)))
        self._chunks = re.compile(f" *[^ {own}]+| +|[{own}]" if own else " *[^ ]+| +").findall
        # Two generations each: a full one becomes the old one.
        self._cache: dict[str, tuple[int, ...]] = {}
        self._old: dict[str, tuple[int, ...]] = {}
        self._fits: dict[int, bool] = {}
        self._old_fits: dict[int, bool] = {}

    def __reduce__(self):
        return _once, (self.pieces, self.byte_ids, self.merged)

    @classmethod
    def load(cls, path: str = MODEL) -> Vocabulary:
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        m = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(m.vocab_size())
        plain = [i for i in ids if not (m.is_control(i) or m.is_unknown(i) or m.is_byte(i) or m.is_unused(i))]
        bytes_ = {int(m.id_to_piece(i)[1:-1], 16): i for i in ids if m.is_byte(i)}
        spec = sentencepiece_model_pb2.ModelProto.FromString(m.serialized_model_proto()).trainer_spec
        pieces = [(i, m.id_to_piece(i).replace("▁", " "), m.get_score(i)) for i in plain]
        return cls(pieces, [bytes_[b] for b in sorted(bytes_)], spec.model_type == spec.BPE)

    def _build(self) -> None:
        self.goto: list[dict[str, int]] = [{}]
        self.out: list[tuple[int, float, int] | None] = [None]
        for i, piece, score in self.pieces:
            node = 0
            for c in piece:
                node = self.goto[node].setdefault(c, len(self.goto))
                if node == len(self.goto):
                    self.goto.append({})
                    self.out.append(None)
            self.out[node] = (len(piece), score, i)
        self.fail, self.link = [0] * len(self.goto), [0] * len(self.goto)
        todo = deque(self.goto[0].values())
        while todo:
            node = todo.popleft()
            for c, child in self.goto[node].items():
                todo.append(child)
                back = self.fail[node]
                while back and c not in self.goto[back]:
                    back = self.fail[back]
                self.fail[child] = back = self.goto[back].get(c, 0)
                self.link[child] = back if self.out[back] else self.link[back]
        # The first node with a piece on each state's chain, and transitions that failures were followed for.
        self._first = [k if o else self.link[k] for k, o in enumerate(self.out)]
        self._next = [dict(g) for g in self.goto]

    def viterbi(self, chunk: str) -> tuple[int, ...]:
        """Ids of the segmentation with the highest sum of scores; at a tie the longer last piece wins.

        One pass: each character moves the automaton, and the chain of output links from its state
        lists every piece that ends there. A character that is no piece costs `unknown` and is
        written as its UTF-8 bytes.
        """
        follow, first, link, out = self._next, self._first, self.link, self.out
        best, last, state = [0.0], [(0, 0)], 0
        for i, c in enumerate(chunk, 1):
            state = s if (s := follow[state].get(c)) is not None else self._step(state, c)
            node = first[state]
            top, how, size = float("-inf"), (0, 0), 0
            while node:
                size, score, piece = out[node]
                if (s := best[i - size] + score) > top:
                    top, how = s, (size, piece)
                node = link[node]
            if size != 1 and (s := best[i - 1] + self.unknown) > top:
                top, how = s, (1, -1)
            best.append(top)
            last.append(how)
        ids, i = [], len(chunk)
        while i:
            size, piece = last[i]
            if piece < 0:
                ids.extend(self.byte_ids[b] for b in reversed(chunk[i - 1].encode()))
            else:
                ids.append(piece)
            i -= size
        return tuple(ids[::-1])

    def _last_merge(self, piece: str) -> tuple[str, str] | None:
        """The two parts that became the piece last, when its own characters merge; None if something else comes out."""
        if piece in self._halves:
            return self._halves[piece]
        parts, score, halves = list(piece), self._score, None
        while len(parts) > 1:
            ranks = [score.get(a + b, float("-inf")) for a, b in zip(parts, parts[1:], strict=False)]
            top = max(ranks)
            if top == float("-inf"):
                halves = None
                break
            k = ranks.index(top)
            halves = (parts[k], parts[k + 1])
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        self._halves[piece] = halves
        return halves

    def fits(self, left: str, right: str) -> bool:
        """Whether merging the characters of both by rank, leftmost first among equals, leaves the seam between them.

        Undoes the merges of both sides, the latest first. The seam holds if, at each step, the two
        parts that touch it make no piece, or one whose turn is after the merge just undone.
        """
        a, b, score, least, ties = left, right, self._score, float("-inf"), False
        while True:
            seam = score.get(a + b)
            if seam is not None and (seam > least or ties and seam == least):
                return False
            if len(a) == 1 and len(b) == 1:
                return True
            # One character was there from the start; of equal ranks the right one merged later.
            if len(b) == 1 or len(a) > 1 and score[a] < score[b]:
                least, ties, halves = score[a], False, self._last_merge(a)
                a = halves and halves[1]
            else:
                least, ties, halves = score[b], True, self._last_merge(b)
                b = halves and halves[0]
            if halves is None:
                return False

    def _fits_ids(self, key: int) -> bool:
        """fits() by numbers: the left piece's above the right one's 20 bits; 0xFFFFF is a character that is no piece, or nothing."""
        left, right = key >> 20, self._text[key & 0xFFFFF]
        known = self._old_fits.get(key)
        if known is None:
            known = len(right) == 1 or self._last_merge(right) is not None if left == 0xFFFFF else self.fits(self._text[left], right)
        if len(self._fits) >= CACHED:
            self._fits, self._old_fits = {}, self._fits
        self._fits[key] = known
        return known

    def _step(self, state: int, c: str) -> int:
        """The automaton's next state, kept for the next time."""
        goto, back = self.goto, state
        while back and c not in goto[back]:
            back = self.fail[back]
        after = goto[back].get(c, 0)
        if len(self._next[state]) < 512:
            self._next[state][c] = after
        return after

    def merge_order(self, chunk: str) -> tuple[int, ...]:
        """Ids that merging adjacent pieces, best rank first, would end with, found in one pass.

        A segmentation is that of the merge order if and only if each pair of neighbours is; so of the
        pieces that end at a position just one fits the last piece of what stands before it.
        """
        follow, first, link, out, fits = self._next, self._first, self.link, self.out, self._fits.get
        last, sizes, state = [0xFFFFF], [0], 0
        for i, c in enumerate(chunk, 1):
            state = s if (s := follow[state].get(c)) is not None else self._step(state, c)
            node = first[state]
            while node:
                size, _, piece = out[node]
                key = last[i - size] << 20 | piece
                known = fits(key)
                if known is None:
                    known = self._fits_ids(key)
                    fits = self._fits.get
                if known:
                    last.append(piece)
                    sizes.append(size)
                    break
                node = link[node]
            else:
                last.append(0xFFFFF)
                sizes.append(1)
        ids, i = [], len(chunk)
        while i:
            if last[i] == 0xFFFFF:
                ids.extend(self.byte_ids[b] for b in reversed(chunk[i - 1].encode()))
            else:
                ids.append(last[i])
            i -= sizes[i]
        return tuple(ids[::-1])

    def encode(self, text: str | None) -> list[int]:
        """Ids of a whole text with a space put before it; none for null and empty texts."""
        if not text:
            return []
        cache, old, ids, run = self._cache, self._old, [], self.merge_order if self.merged else self.viterbi
        for chunk in self._chunks(" " + text):
            got = cache.get(chunk)
            if got is None:
                got = old.get(chunk) or run(chunk)
                if len(chunk) <= CACHED_CHARS:
                    if len(cache) >= CACHED:
                        self._old, self._cache = cache, {}
                        cache, old = self._cache, cache
                    cache[chunk] = got
            ids += got
        return ids

    def decode(self, ids: list[int]) -> str:
        """The text of ids, without the space put before it; byte pieces that are no UTF-8 become U+FFFD."""
        of = self.bytes_of
        return b"".join([of[i] for i in ids]).decode("utf-8", "replace")[1:]


def _once(pieces: list, byte_ids: list[int], merged: bool) -> Vocabulary:
    """The vocabulary of a process: later tasks of a worker find the automaton and the caches ready, until another operator's tasks come."""
    key = (len(pieces), hash(tuple(pieces)), tuple(byte_ids), merged)
    kept = RESIDENT.get("pieces")
    if kept is None or kept[0] != key:
        kept = RESIDENT["pieces"] = (key, Vocabulary(pieces, byte_ids, merged))
    return kept[1]


def encode(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids and n_ids of every row, and round_trip: whether decoding ids gave the text (null: empty) back.

    The vocabulary is as large as its file, whatever the input. Other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                flat, offsets, same = [], [0], []
                for text in part.column(1).to_pylist():
                    ids = vocabulary.encode(text)
                    flat += ids
                    offsets.append(len(flat))
                    same.append(vocabulary.decode(ids) == (text or ""))
                ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32()))
                sizes = pa.array([b - a for a, b in zip(offsets, offsets[1:], strict=False)], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0), ids, sizes, pa.array(same, pa.bool_())], ["doc_id", "ids", "n_ids", "round_trip"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return small_batches(rows).mapInArrow(trimmed(run, keeps="pieces"), "doc_id long, ids array<int>, n_ids long, round_trip boolean")


def decode(rows: DataFrame, vocabulary: Vocabulary, ids_col: str = "ids", out_col: str = "text") -> DataFrame:
    """rows with the text of their ids; null ids give a null text."""
    text = F.pandas_udf(lambda s: s.map(lambda ids: None if ids is None else vocabulary.decode(list(ids))), "string")
    return rows.withColumn(out_col, text(ids_col))


def op10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_ids and round_trip of every row of documents.

    Null and empty texts have no ids; a text of any length is one row, cut where no piece crosses
    while it is worked on; repeated rows repeat, equal texts get equal ids, an empty table gives none.
    """
    return encode(table(spark, sf_dir, "documents"), Vocabulary.load())
