"""Chapter files of any size: pages in order, cut into pieces by byte offset, and a digest over the pieces' digests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quire.functions import text
from quire.operators import relate
from quire.sources import work

#: A piece begins with the first page at or behind each multiple of so many bytes.
PIECE_BYTES = 4 << 20
# Pages that say that they are empty, the least length of any other, and the line above a page.
BLANK_PHRASES = ("There is no text on this page", "This page is empty")
LEAST_CHARS = 30
RULE = "━" * 60


def is_blank(body: Column) -> Column:
    stripped = text.clean(body)
    said = F.lit(False)
    for phrase in BLANK_PHRASES:
        said = said | stripped.contains(phrase)
    return said | (F.length(stripped) < LEAST_CHARS)


def section(page: Column, body: Column) -> Column:
    """A page under its heading, as it stands in a chapter's file."""
    number = page.cast("string")
    return F.concat(F.lit(f"\n{RULE}  ┃  PAGE "), F.when(F.length(number) < 3, F.lpad(number, 3, "0")).otherwise(number), F.lit(f"{RULE}\n"), body)


def offsets(rows: DataFrame, key: str, order: str, size: str) -> DataFrame:
    """rows with the sum of `size` over the rows before each in its key's order, whatever share of the rows one key has.

    The rows are written once, in ranges of (key, order); each range adds up its own, and what the
    ranges before it hold comes from one total for each range and key.
    """
    spark, path = rows.sparkSession, work.folder(rows.sparkSession, "ranges")
    rows.repartitionByRange(key, order).withColumn("range_no", F.spark_partition_id()).write.parquet(path)
    ranged = spark.read.parquet(path)
    totals = ranged.groupBy(F.col("range_no").alias("t_range"), F.col(key).alias("t_key")).agg(F.sum(size).alias("here"))
    before = W.partitionBy("t_key").orderBy("t_range").rowsBetween(W.unboundedPreceding, -1)
    ahead = totals.select("t_range", "t_key", F.coalesce(F.sum("here").over(before), F.lit(0)).alias("ahead"))
    local = F.sum(size).over(W.partitionBy("range_no", key).orderBy(order).rowsBetween(W.unboundedPreceding, -1))
    joined = ranged.withColumn("behind", F.coalesce(local, F.lit(0))).join(ahead, (F.col("range_no") == F.col("t_range")) & F.col(key).eqNullSafe(F.col("t_key")))
    return joined.withColumn("offset", F.col("ahead") + F.col("behind")).drop("range_no", "t_range", "t_key", "ahead", "behind")


def pieces(pages: DataFrame, key: str = "slug", page: str = "page", body: str = "body", piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """(key, piece, offset, n_pages, n_bytes, content): each chapter's file in pieces, in the order of piece; blank pages are left out.

    A piece has whole pages, so it is longer than piece_bytes by one page at most, however long its chapter is.
    """
    full = pages.filter(~F.coalesce(is_blank(F.col(body)), F.lit(True))).select(key, page, section(F.col(page), F.col(body)).alias("section"))
    placed = offsets(full.withColumn("size", F.octet_length("section").cast("long")), key, page, "size")
    rows = placed.withColumn("piece", F.floor(F.col("offset") / piece_bytes))
    ordered = F.array_sort(F.collect_list(F.struct(page, "section")))
    found = rows.groupBy(key, "piece").agg(F.min("offset").alias("offset"), F.count(F.lit(1)).alias("n_pages"), F.sum("size").alias("n_bytes"), ordered.alias("parts"))
    return found.select(key, "piece", "offset", "n_pages", "n_bytes", F.array_join(F.transform("parts", lambda p: p["section"]), "").alias("content"))


def digests(cut: DataFrame, key: str = "slug") -> DataFrame:
    """(key, n_pages, n_bytes, digest) of chapters from their pieces: the digest is that of the pieces' digests in order."""
    each = cut.select(key, "piece", "n_pages", "n_bytes", F.sha2("content", 256).alias("digest"))
    found = each.groupBy(key).agg(F.sum("n_pages").alias("n_pages"), F.sum("n_bytes").alias("n_bytes"), F.array_sort(F.collect_list(F.struct("piece", "digest"))).alias("ds"))
    return found.select(key, "n_pages", "n_bytes", F.sha2(F.array_join(F.transform("ds", lambda d: d["digest"]), ""), 256).alias("digest"))


def write(cut: DataFrame, path: str, key: str = "slug") -> None:
    """Pieces as Parquet, a folder for each chapter; reading one in the order of piece gives its file."""
    cut.write.partitionBy(key).parquet(path)


def placed(docs: DataFrame, page: str, body: str, chapters: DataFrame) -> DataFrame:
    """(slug, page, body) of pages within chapters."""
    return relate.as_of(docs.select(F.col(page).alias("page"), F.col(body).alias("body")), "page", chapters).filter("slug is not null").select("slug", "page", "body")
