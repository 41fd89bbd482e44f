import random

import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, shard int, fp long, spans string, block long, part int, words string, root long, id long, no long"


def passage(rnd, n):
    return " ".join(rnd.choice(["alpha", "beta", "gamma", "delta", "the", "of", "Über", "été", "x1"]) + str(rnd.randint(0, 40)) for _ in range(n))


def rows():
    """Nulls, empty and long texts, ties, repeated rows and ids, many copies, shared passages, secrets."""
    rnd = random.Random(5)
    shared, long_ = passage(rnd, 60), passage(rnd, 6000)
    texts = [None, "", " \n\t ", "one", "one two", "ONE TWO", shared, f"x {shared} y", f"{shared} {shared}", long_, long_ + " tail", long_.upper()]
    texts += ["a" * 400, "ab" * 300, "\x00\x01 \x0b\x0c x" * 30, "漢字 " * 80, "😀é" * 60, "line\nline\nother line here\nline", "▁ ▁▁ a  b   c"]
    texts += ['password = "hunter2hunter2" token=ab', "AKIA" + "B" * 20 + " " + "0f" * 20 + " secret:" + "z" * 9, "token=api_key: abcdefghijk", "😀 Secret = abcdefgh12 é"]
    texts += [passage(rnd, rnd.randint(5, 200)) for _ in range(40)] + ["same text again and again"] * 60
    texts += [" ".join(long_.split()[:300]) + f" end {k}" for k in range(6)]
    out = []
    for k, t in enumerate(texts):
        out.append((k * 3 % 157, t, "en", None if k % 11 == 0 else "hot" if k % 3 else f"s{k % 4}", len(t or ""), 7, 1, 2, "z", 3, 4, "w", 5, 6, 8))
    out += [out[6], out[6], (None, shared, None, None, None, 1, 1, 1, "", 1, 1, "", 1, 1, 1), (None, None, None, "s1", None, *[None] * 10), (None, shared, "en", "s1", 0, *[None] * 10)]
    return out


@pytest.fixture(scope="session")
def nasty(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("nasty")
    docs = spark.createDataFrame(rows(), DOCS)
    docs.repartition(3).write.parquet(f"{d}/documents.parquet")
    labels = [(k, k % 2, 0) for k in range(0, 150, 2)] + [(3, None, None), (None, 1, 0), (6, 1, 0), (6, 0, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    rnd = random.Random(6)
    vecs = [(k, [rnd.uniform(-1, 1) for _ in range(8)], 0) for k in range(300)] + [(k, [0.5] * 8, 0) for k in range(300, 400)]
    vecs += [(50, [0.25] * 8, 0), (7, None, 0), (8, [None] * 8, 0), (9, [float("nan")] * 8, 0), (10, [float("inf")] + [0.0] * 7, 0), (None, [1.0] * 8, 0), (100, [], 0), (101, [3.0], 0), (150, [0.5] * 8, 0)]
    spark.createDataFrame(vecs, "vec_id long, embedding array<float>, label int").repartition(3).write.parquet(f"{d}/embeddings.parquet")
    return str(d)


@pytest.fixture(scope="session")
def empty(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("empty")
    spark.createDataFrame([], DOCS).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([], "vec_id long, embedding array<float>, label int").write.parquet(f"{d}/embeddings.parquet")
    return str(d)


@pytest.fixture(scope="session")
def docs(spark, nasty):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{nasty}/documents.parquet").select(F.col("doc_id"), F.col("text")).collect()]
