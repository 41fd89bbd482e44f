"""Every registered query of the library against DuckDB on the smallest tables, and under another partitioning."""

import math
import os
from collections import Counter

import duckdb
import pytest

from quire.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES, SQL = catalog.queries(), catalog.oracle_sql()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="tables are not here")


def clean(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    return [clean(x) for x in v] if isinstance(v, list) else v


def rows(found, names):
    return Counter(repr([clean(v) for v in r]) for r in found)


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, SF)
    names = sorted(got.columns)
    found = got.select(*names).collect()
    if name in SQL:
        want = duck.execute(f"select {', '.join(chr(34) + n + chr(34) for n in names)} from ({SQL[name]})").fetchall()
        assert rows(found, names) == rows(want, names)


@pytest.mark.parametrize("name", ["near_duplicates", "paragraphs", "audit_findings", "rare_term_coverage"])
def test_partitions_do_not_matter(spark, tmp_path, name):
    for t in ("documents", "pages", "benchmark"):
        spark.read.parquet(f"{SF}/{t}.parquet").repartition(5).write.parquet(f"{tmp_path}/{t}.parquet")
    a, b = QUERIES[name](spark, SF), QUERIES[name](spark, str(tmp_path))
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0


def test_library_stands_without_the_subpackage():
    import pathlib
    import re

    root = pathlib.Path(__file__).parent.parent / "quire"
    for f in root.rglob("*.py"):
        if "llm" not in f.parts:
            assert not re.search(r"quire\.llm|from quire import llm", f.read_text()), f


def test_entry_points_with_the_subpackage_hidden(tmp_path):
    """A copy without the two folders and the pipeline still imports and registers every other query."""
    import pathlib
    import shutil
    import subprocess
    import sys

    root = pathlib.Path(__file__).parent.parent
    shutil.copytree(root / "quire", tmp_path / "quire", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "from tests_session import spark; import __spark_entry__ as e; q = e.queries(); print(len(q), len(e.oracle_sql()), sum(n.startswith('op') and n[2].isdigit() for n in q))"
    (tmp_path / "tests_session.py").write_text("from pyspark.sql import SparkSession\nspark = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false').getOrCreate()\n")
    ran = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert ran.returncode == 0, ran.stderr[-2000:]
    assert ran.stdout.split() == [str(len(QUERIES)), str(len(SQL)), "0"]


def test_symbol_scores_of_odd_texts_as_sql_has_them(spark, tmp_path):
    """Texts that are null or empty, shares that end in a 5 at the tenth place, and digits that came with Unicode 14 and 15."""
    texts = [None, "", " ", "ا", "12\U00016ac1", "a\U00011f50—\U00011f59b", "\U0001e4f0٣é", "\U00011f4f\U00011f5a\U00016abf\U00016aca\U0001e4ef\U0001e4fa"]
    texts += ["ب" * k + "x" * (n - k) for k, n in [(3, 1024), (1366, 5120), (1367, 5120), (4101, 15360), (6749, 25600)]]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    c = duckdb.connect()
    c.execute(f"create view documents as select * from read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    names = ["doc_id", "arabic_ratio", "prose_score", "n_symbols"]
    got = [tuple(r) for r in QUERIES["prose_symbol_scores"](spark, str(tmp_path)).select(*names).orderBy("doc_id").collect()]
    assert got == c.execute(f"select {', '.join(names)} from ({SQL['prose_symbol_scores']}) order by doc_id").fetchall()
