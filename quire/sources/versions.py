"""Snapshots of files by version: a partition each, so that only the versions a question needs are read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators import relate

SCHEMA = "path string, size long, digest string, content binary, version int"


def add(files: DataFrame, root: str, version: int) -> None:
    """Writes files (path, content) as a version, which must be new."""
    content = F.coalesce(F.col("content").cast("binary"), F.lit(b""))
    rows = files.select("path", F.octet_length(content).cast("long").alias("size"), F.sha2(content, 256).alias("digest"), content.alias("content"))
    rows.write.mode("errorifexists").parquet(f"{root.rstrip('/')}/version={version}")


def read(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(SCHEMA).option("basePath", root).parquet(root)


def newest(spark: SparkSession, root: str, paths: DataFrame | None = None, upto: int | None = None) -> DataFrame:
    """(path, version, digest, content) of each file's newest version that is not empty, of all files or of those in paths.

    Names and sizes alone decide; then contents are read from the versions that some file needs, and no others.
    """
    rows = read(spark, root)
    rows = rows if upto is None else rows.filter(F.col("version") <= upto)
    known = rows.select("path", "size", "version").filter("size > 0")
    known = known if paths is None else known.join(paths.select("path").distinct(), "path", "left_semi")
    best = known.groupBy(F.col("path").alias("of_path")).agg(F.max("version").alias("of_version"))
    needed = [r[0] for r in best.select("of_version").distinct().collect()]
    found = read(spark, root).filter(F.col("version").isin(needed) & (F.col("size") > 0))
    return found.join(best, (F.col("path") == F.col("of_path")) & (F.col("version") == F.col("of_version"))).select("path", "version", "digest", "content")


def changes(spark: SparkSession, root: str, before: int, after: int) -> DataFrame:
    """(path, was, now, change) between any two versions, by digests alone; files that stayed the same are left out."""
    one = lambda v: read(spark, root).filter(F.col("version") == v).select("path", "digest")
    return relate.version_delta(one(before), one(after), "path", "digest").filter("change != 'same'")
