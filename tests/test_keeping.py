"""The segmented index against a full rebuild, and chapters in pieces against plain joining."""

import hashlib
import random
import threading

import pytest
from pyspark.sql import functions as F

from quire.operators import search, segments
from quire.operators.segments import SegmentedIndex
from quire.sources import chapters


def postings(df):
    return sorted((r.term, r.page_num, tuple(r.positions)) for r in df.collect())


@pytest.mark.parametrize("fanout", [2, 4])
def test_changes_equal_a_rebuild(spark, tmp_path, monkeypatch, fanout):
    monkeypatch.setattr(segments, "FANOUT", fanout)
    rnd, pages = random.Random(fanout), {}
    index = SegmentedIndex(spark, str(tmp_path))
    assert postings(index.postings()) == []
    for step in range(6):
        changes = []
        for page in rnd.sample(range(8), 3):
            op = rnd.choice(["insert", "update", "DELETE"])
            body = " ".join(rnd.choice("ab cd ef Gh".split()) for _ in range(rnd.randint(0, 5)))
            changes.append((op, page, body if op != "DELETE" else None))
            if op == "DELETE":
                pages.pop(page, None)
            else:
                pages[page] = body
        index.apply(spark.createDataFrame(changes, "op string, page_num long, content string"))
        whole = search.inverted_index(spark.createDataFrame(list(pages.items()) or [(-1, "")], "page_num long, content string"), "page_num", "content")
        assert postings(index.postings()) == postings(whole), step
    version, held = index.segments()
    assert len(held) < 6 and version > 5
    before = postings(index.postings())
    assert index.sweep() > 0 and postings(index.postings()) == before and index.sweep() == 0
    assert [s["first"] for s in held[1:]] == [s["last"] + 1 for s in held[:-1]] and held[-1]["last"] == 5


def test_only_the_changed_pages_are_written(spark, tmp_path):
    index = SegmentedIndex(spark, str(tmp_path))
    index.apply(spark.range(50).select(F.lit("insert").alias("op"), F.col("id").alias("page_num"), F.lit("one two").alias("content")))
    index.apply(spark.createDataFrame([("delete", 3, None)], "op string, page_num long, content string"))
    index.apply(spark.createDataFrame([("update", 4, "three")], "op string, page_num long, content string"))
    assert [s["rows"] for s in index.segments()[1]] == [100, 0, 1]
    assert {r.page_num for r in search.match(index.postings(), "page_num", "one").collect()} == set(range(50)) - {3, 4}


def test_two_writers_of_an_index(spark, tmp_path):
    one = lambda k: spark.createDataFrame([("insert", k, f"w{k} x")], "op string, page_num long, content string")
    frames = [one(k) for k in range(2)]
    threads = [threading.Thread(target=lambda f=f: SegmentedIndex(spark, str(tmp_path)).apply(f)) for f in frames]
    [t.start() for t in threads]
    [t.join(120) for t in threads]
    assert {t for t, *_ in postings(SegmentedIndex(spark, str(tmp_path)).postings())} == {"w0", "w1", "x"}


@pytest.mark.parametrize("piece_bytes", [1, 200, 700, 1 << 20])
def test_pieces_are_the_file(spark, piece_bytes):
    rnd = random.Random(1)
    pages = [("a", k, "é" * rnd.randint(20, 90)) for k in range(40)] + [("b", 1, "x" * 5000), ("b", 1234, "y" * 30), ("c", 1, "short")]
    pages += [("a", 50, "There is no text on this page, " + "z" * 40), ("a", 51, None), ("b", 3, "  This page is empty\n" + "z" * 40), ("b", 4, "z" * 29 + "   ")]
    got = chapters.pieces(spark.createDataFrame(pages, "slug string, page long, body string").repartition(3), piece_bytes=piece_bytes).collect()
    rule = "━" * 60
    want = {s: "".join(f"\n{rule}  ┃  PAGE {p:03d}{rule}\n{t}" for slug, p, t in sorted(pages[:42]) if slug == s and len(t) >= 30) for s in "ab"}
    for slug, whole in want.items():
        mine = sorted((r.piece, r.offset, r.n_bytes, r.content) for r in got if r.slug == slug)
        assert "".join(m[3] for m in mine) == whole
        at = 0
        for _, offset, size, content in mine:
            assert offset == at and size == len(content.encode())
            at += size
    assert {r.slug for r in got} == {"a", "b"}


def test_digest_of_a_chapter(spark):
    cut = spark.createDataFrame([("a", 1, 1, 3, "yy"), ("a", 0, 2, 4, "x")], "slug string, piece long, n_pages long, n_bytes long, content string")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert [tuple(r) for r in chapters.digests(cut).collect()] == [("a", 3, 7, sha(sha("x") + sha("yy")))]
