"""Page trees as a data source, and imports in the accepted shapes."""

import json

import pytest
from pyspark.sql import functions as F

from quire.sources import pagetree, scan


def tree(spark, path, **options):
    return sorted((r.layer, r.page, r["size"], None if r.content is None else bytes(r.content)) for r in pagetree.read(spark, str(path), **options).collect())


def test_page_tree(spark, tmp_path):
    rows = [("ar", 1, b"x" * 11), ("ar", 2, b"\xff\xfe"), ("en", 1, b""), ("en", 1234, b"abc")]
    pagetree.write(spark.createDataFrame(rows, "layer string, page int, content binary").repartition(3), str(tmp_path))
    for name in ("ar/page_x.txt", "ar/other.txt", "page_001.txt", "ar/page_99999999999.txt"):
        (tmp_path / name).write_text("no page")
    assert tree(spark, tmp_path) == sorted((a, p, len(c), c) for a, p, c in rows)
    assert tree(spark, tmp_path, layers=("en",), content=False) == [("en", 1, 0, None), ("en", 1234, 3, None)]
    assert (tmp_path / "en" / "page_1234.txt").read_bytes() == b"abc"
    small = spark.read.format("page_tree").option("path", str(tmp_path)).option("partitionBytes", "3").load()
    assert small.rdd.getNumPartitions() > 1 and small.count() == 4
    got = pagetree.furthest(pagetree.read(spark, str(tmp_path), content=False), ("ar", "en"), 3, least=2)
    assert sorted(map(tuple, got.collect())) == [(1, "ar"), (2, "pending"), (3, "pending")]
    pagetree.write(spark.createDataFrame([("ar", 7, b"new")], "layer string, page int, content binary"), str(tmp_path), mode="overwrite")
    assert tree(spark, tmp_path) == [("ar", 7, 3, b"new")] and (tmp_path / "ar" / "other.txt").exists()


def test_a_failed_write_leaves_nothing(spark, tmp_path):
    pagetree.write(spark.createDataFrame([("ar", 1, b"old")], "layer string, page int, content binary"), str(tmp_path))
    twice = spark.createDataFrame([("ar", 1, b"a"), ("ar", 1, b"b")], "layer string, page int, content binary")
    with pytest.raises(Exception, match="two rows for one page"):
        pagetree.write(twice, str(tmp_path))
    bad = spark.range(4).select(F.lit("ar").alias("layer"), F.when(F.col("id") == 3, F.raise_error(F.lit("stop"))).otherwise(F.col("id")).cast("int").alias("page"), F.lit(b"z").alias("content"))
    with pytest.raises(Exception, match="stop"):
        pagetree.write(bad.repartition(2), str(tmp_path))
    assert tree(spark, tmp_path) == [("ar", 1, 3, b"old")]
    assert tree(spark, tmp_path / "nowhere") == []


def test_a_file_costs_the_driver_a_few_bytes(tmp_path):
    """A task's message holds numbers of pages, not two paths for each file."""
    import pickle

    import pyarrow as pa

    batch = pagetree._batch([("ar", k, 1, b"x") for k in range(2000)])
    writer = pagetree.Writer(str(tmp_path), True)
    message = writer.write(iter([batch]))
    assert len(pickle.dumps(message)) < 8 * 2000
    with pytest.raises(ValueError, match="two rows for one page"):
        writer.write(iter([pa.RecordBatch.from_arrays([c.take(pa.array([3, 3])) for c in batch.columns], batch.schema.names)]))
    writer.commit([message, None])
    names = sorted(p.name for p in (tmp_path / "ar").iterdir())
    assert names == sorted(f"page_{k:03d}.txt" for k in range(2000))


SHAPES = [
    ({"page": 1, "body": "plain"}, "plain"), ({"page": 1, "content": "c"}, "c"), ({"page": 1, "text": {"en": ""}, "en": "direct"}, "direct"), ({"page": "1", "translation": "t"}, "t"), ({"p": 1, "text_": "t"}, "t"),
    ({"page": 1, "text": {"en": "nested"}, "en": "direct", "body": "b"}, "nested"), ({"page": 1, "body": "", "content": "c"}, ""), ({"page": 1, "body": None, "content": "c"}, "c"), ({"page": 1, "body": {"en": "x"}}, "x"),
    ({"page": 1, "en": 5, "text": "s", "body": "b"}, "b"), ({"number": 1.0, "en": "x"}, "x"), ({"page": None, "n": " 1 ", "en": "x"}, "x"),
]


@pytest.mark.parametrize("wrapped", [False, True])
def test_import_shapes(spark, wrapped):
    for record, want in SHAPES:
        doc = json.dumps({"pages": [record]} if wrapped else [record])
        assert [r.en for r in scan.tolerant_records(spark.createDataFrame([(doc,)], "j string"), "j", 9).collect()] == [want], record


def test_import_errors(spark):
    docs = [(0, "[{"), (1, "[]"), (2, "{}"), (3, '{"data":[{"page":1}]}'), (4, '[{"page":0},{"page":10},{"page":"x"},{"page":1.5},5]'), (5, '[{"page":1}]'), (6, None), (7, '[{"page":1}]]'), (8, "")]
    got = {r.k: r.error for r in scan.tolerant_errors(spark.createDataFrame(docs, "k int, j string"), "k", "j", 9).collect()}
    assert got == {0: "invalid JSON", 1: "no page entries", 2: "no page entries", 3: "no page entries", 4: "no valid pages", 6: "invalid JSON", 7: "invalid JSON", 8: "invalid JSON"}
