"""Strict JSON, paths, overrides, manifests, receipts."""

import hashlib

import pytest
from pyspark.sql import functions as F

from quire.operators import evidence

T = F.col("t")


def test_strict_json(column):
    rows = [('{"a": 1}',), ('{"a": 1, "a": 2}',), ('{"a": {"b": 1, "\\u0062": 2}}',), ('{"a": NaN}',), ("[Infinity]",), ("",), (None,), ("[1, 2]",)]
    assert column(evidence.strict_json(T).isNotNull(), "t string", rows) == [True, False, False, False, False, False, False, True]


@pytest.mark.parametrize(
    ("path", "safe", "provenance"),
    [
        ("docs/english-corrections/a.md", True, True), ("docs/english-corrections", True, False), ("docs/x/a.md", True, False), ("/etc/x", False, False), ("a/../b", False, False),
        ("C:/x", False, False), ("a\\b", False, False), ("docs/english-corrections/a.", True, False), ("docs/english-corrections//a", False, False), ("", False, False), (None, False, False),
    ],
)
def test_paths(column, path, safe, provenance):
    assert column(evidence.is_safe_path(T), "t string", [(path,)]) == [safe]
    assert bool(column(evidence.is_provenance_path(T), "t string", [(path,)])[0]) == provenance


def test_digests(column):
    assert column(evidence.is_digest(T), "t string", [("a" * 64,), ("A" * 64,), ("a" * 64 + "\n",), (None,)]) == [True, False, False, False]
    assert column(evidence.is_commit(T), "t string", [("abcdef1",), ("abc",), ("g" * 8,)]) == [True, False, False]


SOURCE, OLD, NEW = "نص\n", "Arabic:\nنص\n\nEnglish:\nold\n", "Arabic:\nنص\n\nEnglish:\nnew\n"
SCHEMA = "page int, boundary int, at string, source string, old string, new string, prov array<struct<path:string,content:string>>"
PROV = [("docs/english-corrections/x.md", "why")]


def entry_of(spark, **change):
    row = {"page": 5, "boundary": 7, "at": "2024-01-01", "source": SOURCE, "old": OLD, "new": NEW, "prov": PROV} | change
    df = spark.createDataFrame([tuple(row.values())], SCHEMA)
    e = evidence.override_entry(*[F.col(c) for c in ("page", "boundary", "at", "source", "old", "new", "prov")])
    return df.select("*", e.alias("e"))


def test_override(spark):
    got = entry_of(spark).first().e
    assert got.problem is None and got.entry.en_sha256 == hashlib.sha256(NEW.encode()).hexdigest()
    assert entry_of(spark, new=NEW.replace("\n", "\r\n")).first().e.problem is None
    match = lambda df, target: df.select(evidence.override_matches(F.col("e.entry"), F.col("page"), F.col("source"), target)).first()[0]
    assert match(entry_of(spark), F.col("new"))
    assert match(entry_of(spark), F.replace(F.col("new"), F.lit("\n"), F.lit("\r\n")))
    assert not match(entry_of(spark), F.concat(F.col("new"), F.lit("x")))
    assert not match(entry_of(spark).withColumn("page", F.lit(6)), F.col("new"))
    assert not match(entry_of(spark).withColumn("source", F.lit("other")), F.col("new"))


@pytest.mark.parametrize("change", [{"page": 0}, {"page": 605}, {"at": " "}, {"prov": []}, {"prov": [("x/y/z", "a")]}, {"new": NEW.replace("نص", "غير")}, {"new": "English:\nx"}, {"source": "غير"}, {"new": "Arabic:\nنص\n\nEnglish:\n\n"}])
def test_override_refuses(spark, change):
    got = entry_of(spark, **change).first().e
    assert got.entry is None and got.problem


def test_waivers(spark):
    f = spark.createDataFrame([("untranslated", 1, "en"), ("untranslated", 1, "id"), ("empty", 1, "en"), ("banned-honorific", 2, "en")], "rule string, page long, layer string")
    got = {(r.rule, r.page, r.layer): r.waived for r in evidence.waive(f, spark.createDataFrame([(1,)], "page long")).collect()}
    assert got == {("untranslated", 1, "en"): True, ("untranslated", 1, "id"): False, ("empty", 1, "en"): False, ("banned-honorific", 2, "en"): False}


def test_manifest(spark):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    files = spark.createDataFrame([("a.txt", bytearray(b"a")), ("b.txt", bytearray(b"b"))], "path string, content binary")
    records = spark.createDataFrame([(1, sha("r"))], "page long, record_sha256 string")
    manifest = [(1, "source", "a.txt", sha("a")), (1, "record", None, sha("r")), (2, "source", "b.txt", sha("x")), (2, "english", "../c", sha("c")), (2, "indonesian", "c.txt", "zz"), (9, "source", "a.txt", sha("a"))]
    got = {r.page: r.errors for r in evidence.manifest_audit(spark.createDataFrame(manifest, "page long, role string, path string, sha256 string"), files, records, 3).collect()}
    assert got == {1: [], 2: ["english: unsafe path", "indonesian: malformed digest", "source: file differs"], 3: ["page missing from manifest"], 9: ["source: page out of scope"]}


def test_receipts(spark):
    reports = spark.createDataFrame([(1, True), (2, False)], "page int, ok boolean")
    files = spark.createDataFrame([(1, "a.txt", "a")], "page int, path string, content string")
    [r] = evidence.receipts(reports, files, "w", "r").collect()
    assert r.page == 1 and r.receipt.file_hashes == {"a.txt": hashlib.sha256(b"a").hexdigest()}
