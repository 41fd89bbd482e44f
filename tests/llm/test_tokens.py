"""Byte-level BPE, fill-in-middle and alignment against the public libraries and plain Python."""

import hashlib
import random
import re
import struct
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quire.llm import byte_pairs, fill_middle, token_alignment
from quire.llm.pieces import MODEL

BITS = ["a", "the", " ", "  ", "\n", "\t ", "'s", "'ll", "12", "<|endoftext|>", "<|", "<P>", "<S", ">", "é", "漢字", "😀", " ", "\x85", "!", "==", "ing", "Th", "▁", "\x00", "<s>", "<0x41>", "　"]
TEXT = st.lists(st.sampled_from(BITS), max_size=30).map("".join)


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(byte_pairs.vocabulary())


@pytest.fixture(scope="module")
def plain_library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(byte_pairs.vocabulary())
    t.encode_special_tokens = True
    return t


CODER = byte_pairs.Coder(byte_pairs.vocabulary())
BOTH = token_alignment.Both(byte_pairs.vocabulary(), MODEL)


def rows():
    rnd = random.Random(9)
    long_ = " ".join(rnd.choice(["alpha", "beta", "Über", "été", "x1", "\n"]) + str(rnd.randint(0, 40)) for _ in range(40_000))
    texts = [None, "", " ", "a", "\n\n", "a\nb", long_, "a" * 3000, "漢字" * 900, " " * 2000, "x<|endoftext|>y<|endoftext|>", "has <M> in it", "a▁b", "nul \x00 here", "<s> </s> <unk> <0x41>"]
    texts += ["".join(rnd.choice(BITS) for _ in range(rnd.randint(0, 60))) for _ in range(120)] + ["same text"] * 30
    return [(k, t) for k, t in enumerate(texts)] + [(3, "a"), (3, "a"), (None, None), (None, "no id"), (-5, "b c")]


@pytest.fixture(scope="module")
def where(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("tokens")
    spark.createDataFrame([(i, t, t, 1, "x", b"y") for i, t in rows()], "doc_id long, text string, ids string, key int, output string, pairs binary").repartition(3).write.parquet(f"{d}/documents.parquet")
    return str(d)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@given(TEXT)
@settings(max_examples=300, deadline=None)
def test_ids_are_those_of_the_library(text):
    from tokenizers import Tokenizer

    library = test_ids_are_those_of_the_library.__dict__.setdefault("lib", Tokenizer.from_file(byte_pairs.vocabulary()))
    ids = CODER.encode(text)
    assert np.frombuffer(ids, np.uint32).tolist() == library.encode(text, add_special_tokens=False).ids
    assert CODER.decode(ids) == text


@given(st.binary(min_size=1, max_size=300))
@settings(max_examples=200, deadline=None)
def test_rounds_merge_as_the_array_does(word):
    assert CODER.short(word) == CODER.long(word).tolist()


def test_decoding_what_is_no_text(library):
    for ids in ([255], [230], [120, 255, 100], [50256, 162, 50256]):
        assert CODER.decode(byte_pairs.pack(ids)) == library.decode(ids, skip_special_tokens=False)


def test_a_full_cache_changes_nothing(monkeypatch, library):
    monkeypatch.setattr(byte_pairs, "CACHED", 7)
    monkeypatch.setattr(byte_pairs, "PART", 50)
    coder = byte_pairs.Coder(byte_pairs.vocabulary())
    for _, text in rows()[10:]:
        assert np.frombuffer(coder.encode(text), np.uint32).tolist() == library.encode(text or "", add_special_tokens=False).ids


def test_byte_pairs(spark, where, library):
    want = Counter()
    for i, t in rows():
        e = library.encode(t or "", add_special_tokens=False).ids
        want[(i, len(e), hashlib.sha256(struct.pack(f"<{len(e)}I", *e)).hexdigest(), sha(library.decode(e, skip_special_tokens=False)))] += 1
    got = byte_pairs.op13_byte_pairs(spark, where).collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == want


UNIT = re.compile("[A-Za-z]+|[^A-Za-z]", re.S)


@pytest.mark.parametrize("every", [1, 3, 1024])
@pytest.mark.parametrize("chunk", [1, 7, 1 << 18])
def test_cuts(monkeypatch, every, chunk):
    monkeypatch.setattr(fill_middle, "CHUNK", chunk)
    for text in ["", "a", "é", "abc d", "漢a字bc😀  x\n\nY", "".join(BITS) * 9]:
        units, index = UNIT.findall(text), fill_middle.Checkpoints(text.encode(), every)
        assert (index.units, index.points) == (len(units), len(text))
        for k in range(len(units) + 1):
            ahead = "".join(units[:k])
            assert index.cut(k) == (len(ahead.encode()), len(ahead))


def test_fill_middle(spark, where):
    want = Counter()
    for i, t in rows():
        t, units = t or "", UNIT.findall(t or "")
        h = hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
        h = [int(h[8 * k : 8 * k + 8], 16) for k in range(4)]
        a, b = sorted(x % (len(units) + 1) for x in h[:2])
        p, m, s = ("".join(units[x:y]) for x, y in ((0, a), (a, b), (b, None)))
        if not t or any(x in t for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
            form, out, sizes = "plain", t, (None, None)
        else:
            form, sizes = "spm" if h[3] % 100 < 20 else "psm", (len(p), len(m))
            out = f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"
        want[(i, len(units), form, *sizes, sha(out), sha(t))] += 1
    got = fill_middle.op11_fill_middle(spark, where).collect()
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    assert Counter((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output_sha256, r.restored_sha256) for r in got) == want


def brute(library):
    """Rows of the alignment, with tokens of the libraries on whole texts."""
    import sentencepiece

    letters = {c: b for b, c in enumerate(byte_pairs.byte_letters())}
    pieces = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    docs, count = [], Counter()
    for i, t in rows():
        a = [(x, bytes(letters[c] for c in library.id_to_token(x))) for x in (library.encode(" " + t, add_special_tokens=False).ids if t else [])]
        b = [(x, bytes([int(pieces.id_to_piece(x)[1:-1], 16)]) if pieces.is_byte(x) else pieces.id_to_piece(x).replace("▁", " ").encode()) for x in (pieces.encode(t) if t else [])]
        if any(b"".join(x for _, x in side) != (" " + (t or "")).encode() for side in (a, b)):
            a = b = []
        spans = [[], []]
        for side, tokens in enumerate((a, b)):
            at = 0
            for x, raw in tokens:
                spans[side].append((x, at, at + len(raw)))
                at += len(raw)
        ends = sorted({e for *_, e in spans[0]} & {e for *_, e in spans[1]})
        groups = [[[], []] for _ in ends]
        for side in (0, 1):
            k = 0
            for x, _, e in spans[side]:
                groups[k][side].append(str(x))
                k += e == ends[k]
        links, k = [], 0
        for x, s, e in spans[0]:
            while k < len(spans[1]) and spans[1][k][2] <= s:
                k += 1
            j = k
            while j < len(spans[1]) and spans[1][j][1] < e:
                links.append((x, spans[1][j][0]))
                j += 1
        count.update(links)
        docs.append((i, len(a), len(b), len(ends), links, ";".join(f"{','.join(x)}|{','.join(y)}" for x, y in groups)))
    top = Counter()
    for (_, y), n in count.items():
        top[y] = max(top[y], n)
    return Counter((i, n_a, n_b, g, len(ls), sum(count[x] == top[x[1]] for x in ls), sum(count[x] for x in ls), sha(text) if n_a else "") for i, n_a, n_b, g, ls, text in docs)


def same(spark, where, library):
    got = token_alignment.op12_token_alignment(spark, where).collect()
    assert Counter((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in got) == brute(library)
    assert sum(r.n_links for r in got) > 1000


def test_alignment(spark, where, plain_library):
    same(spark, where, plain_library)


def test_alignment_in_small_packets_and_blocks(where, plain_library):
    """Packets of few tokens through the machine itself: groups run over packets, and a block holds few pairs."""
    for _, text in rows():
        a, b = BOTH.tokens(text)
        whole, pieces = (token_alignment.Sweep(BOTH, 1) for _ in range(2))
        events = []
        for side, ids in enumerate((a, b)):
            ends = np.cumsum(BOTH.sizes[side][ids]) if len(ids) else []
            events += [(int(ends[k - 1]) if k else 0, side, ids[k : k + 3]) for k in range(0, len(ids), 3)]
            if len(ids):
                whole.feed(side, ids)
        for _, side, ids in sorted(events, key=lambda e: e[:2]):
            pieces.feed(side, ids)
        (row, (keys, n)), (row2, (keys2, n2)) = whole.row(), pieces.row()
        assert row == row2 and keys.tolist() == keys2.tolist() and n.tolist() == n2.tolist()
        assert row[1:3] == (len(a), len(b))


def test_a_model_that_changes_texts_is_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2

    with open(MODEL, "rb") as f:
        proto = sentencepiece_model_pb2.ModelProto.FromString(f.read())
    proto.normalizer_spec.remove_extra_whitespaces = True
    (tmp_path / "m").write_bytes(proto.SerializeToString())
    with pytest.raises(ValueError, match="changes texts"):
        token_alignment.Pieces(str(tmp_path / "m"))


def test_texts_without_tokens_alone(spark, tmp_path):
    spark.createDataFrame([(1, None), (2, ""), (2, "▁")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = token_alignment.op12_token_alignment(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got)) == [(k, 0, 0, 0, 0, 0, 0, "") for k in (1, 2, 2)]


def test_pairs_travel_in_packets(spark, where):
    """A block sends a packet to each range of B ids, and no rows of pairs are joined."""
    swept = token_alignment.sweep(token_alignment.packets(spark.read.parquet(f"{where}/documents.parquet"), BOTH), BOTH).cache()
    sent = token_alignment.asked(swept, BOTH)
    pairs = sum(len(r.pairs) // 8 for r in sent.select("pairs").collect())
    blocks = swept.select("block").distinct().count()
    assert sent.count() <= 64 * blocks < pairs
    plan = token_alignment.scored(swept, token_alignment.counted(sent, BOTH))._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
    swept.unpersist()
    ids = BOTH.spread(np.arange(1 << BOTH.bits, dtype=np.int64)) if BOTH.bits == 16 else np.arange(2)
    assert len(np.unique(ids)) == len(ids) and ids.max() < 1 << BOTH.bits


def test_both_engines_find_the_same_words():
    import random

    from quire.llm import byte_pairs
    from quire.llm.byte_pairs import Coder, vocabulary

    coder, rng = Coder(vocabulary()), random.Random(5)
    letters = [chr(c) for c in range(256)] + list(" '  \n\tstrevmld''  abcé12") * 4
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 80))) for _ in range(3000)] + ["", " ", "don't we'll 'VE I'm\x1c\x1d x\x85\xa0 y  ", "²³¼ªºµ ß×÷"]
    used = []
    for t in texts:
        assert coder._latin(t) == coder._any(t) == coder._words(t)
    coder._any = lambda t: used.append(t) or []
    assert coder._words("l'été à Köln") and not used  # before, every text went through the slower engine
    assert coder._words("œuvre") == [] and used == ["œuvre"]
    assert byte_pairs.latin_words().__self__.groups == 0
