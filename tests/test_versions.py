"""Snapshots by version: the newest that is not empty, and plans that read only what is needed."""

import pytest

from quire.sources import versions


@pytest.fixture
def root(spark, tmp_path):
    where = f"{tmp_path}/v"
    rows = [[("a", b"1"), ("b", b"1"), ("c", b"1"), ("d", None)], [("a", b"2"), ("b", b""), ("c", b"1")], [("a", b""), ("c", b"3"), ("e", b"")]]
    for k, files in enumerate(rows, 1):
        versions.add(spark.createDataFrame(files, "path string, content binary"), where, k)
    return where


def files_read(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan


def test_newest(spark, root):
    got = {r.path: (r.version, bytes(r.content)) for r in versions.newest(spark, root).collect()}
    assert got == {"a": (2, b"2"), "b": (1, b"1"), "c": (3, b"3")}
    assert {r.path: r.version for r in versions.newest(spark, root, upto=2).collect()} == {"a": 2, "b": 1, "c": 2}
    with pytest.raises(Exception, match="exists"):
        versions.add(spark.createDataFrame([("a", b"x")], "path string, content binary"), root, 2)


def test_only_needed_versions_are_read(spark, root):
    found = versions.newest(spark, root, paths=spark.createDataFrame([("a",)], "path string"))
    contents = [line for line in files_read(found).split("\n") if "FileScan" in line and "content" in line.split("Batched")[0]]
    assert len(contents) == 1 and "version#" in contents[0] and "IN (2)" in contents[0].replace("(version", "").replace("= 2", "IN (2)")
    assert {r.path for r in found.collect()} == {"a"}
    delta = versions.changes(spark, root, 1, 3)
    scans = [line for line in files_read(delta).split("\n") if "FileScan" in line]
    assert len(scans) == 2 and not any("content" in s.split("Batched")[0] for s in scans) and all("PartitionFilters: [isnotnull(version" in s for s in scans)
    assert {r.path: r.change for r in delta.collect()} == {"a": "changed", "b": "removed", "c": "changed", "d": "removed", "e": "added"}
