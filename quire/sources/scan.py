"""Readers: text layers, datasets, logs and snapshots, all as DataFrames."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import text
from quire.operators import relate

PAGE_NAME = r"page_(\d+)\.txt$"
RECORD = "page int, text struct<ar:string,en:string,id:string>, title struct<ar:string,en:string,id:string>, scanSrc string"
EVENT = "timestamp string, action string, page int, worker_id string, reviewer_id string, reason string, status string"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def layer(spark: SparkSession, path: str, name: str) -> DataFrame:
    """(page, layer, content) of the page files of a folder; undecodable bytes become U+FFFD."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "page_*.txt").load(path)
    page = F.regexp_extract("path", PAGE_NAME, 1).try_cast("int")
    return files.select(page.alias("page"), F.lit(name).alias("layer"), lenient(F.col("content")).alias("content")).filter("page is not null")


def layers(spark: SparkSession, folders: dict[str, str]) -> DataFrame:
    out = None
    for name, path in folders.items():
        one = layer(spark, path, name)
        out = one if out is None else out.unionByName(one)
    return out


def dense_pages(spark: SparkSession, total: int, layers_: dict[str, DataFrame]) -> DataFrame:
    """Every page 1..total with a column for each layer (page, content), empty where a file is missing."""
    spine = spark.range(1, total + 1).select(F.col("id").cast("int").alias("page"))
    return relate.dense(spine, "page", layers_)


def lenient(content: Column) -> Column:
    """Text of bytes, whatever they are."""
    return F.make_valid_utf8(content.cast("string"))


def dataset(spark: SparkSession, path: str) -> DataFrame:
    """Records of a JSON array file."""
    return spark.read.schema(RECORD).json(path, multiLine=True)


def _entries(docs: DataFrame, column: str) -> Column:
    """The records of a JSON document: an array, or the array under "pages"."""
    as_array = lambda path: F.try_variant_get(_whole(column), path, "array<variant>")
    return F.coalesce(as_array("$"), as_array("$.pages"))


#: Stands behind a document to show that it ended where its JSON did.
END = "end of document"


def _whole(column: str) -> Column:
    """The document's VARIANT; null if it is no JSON, or goes on behind its end, which the parser alone would not mind."""
    items = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), F.col(column), F.lit(f',"{END}"]'))), "$", "array<variant>")
    ended = F.try_variant_get(F.get(items, F.lit(1)), "$", "string") == END
    return F.when((F.size(items) == 2) & ended, F.get(items, F.lit(0)))


def _present(record: Column, *paths: str) -> Column:
    """The first of the values that is there and not null."""
    at = [F.try_variant_get(record, p, "variant") for p in paths]
    return F.coalesce(*[F.when(~F.is_variant_null(v), v) for v in at])


def _said(value: Column) -> Column:
    """A value that is a string and not empty."""
    return F.when(F.schema_of_variant(value) == "STRING", F.nullif(F.try_variant_get(value, "$", "string"), F.lit("")))


def _page(record: Column) -> Column:
    """A record's page, a number or a string of one; null if it is neither or not whole."""
    n = F.try_variant_get(_present(record, "$.page", "$.p", "$.number", "$.n"), "$", "double")
    return F.when(n == F.floor(n), n.try_cast("int"))


def tolerant_records(docs: DataFrame, column: str, total: int) -> DataFrame:
    """(page, ar, en, id, scan, section) of JSON documents in any of the accepted shapes.

    Of a record's texts the nested one under "text" comes before the one under the language's own name,
    unless it is empty; a record without English takes the first plain string of "body", "content",
    "text_" and "translation", and any language what stands under its name within one of these. Pages out of range go; of repeated pages the last of a document wins.
    Documents without records give none: tolerant_errors() tells which.
    """
    rows = docs.select(F.posexplode(_entries(docs, column)).alias("at", "r"))
    r = F.col("r")
    others = ("$.body", "$.content", "$.text_", "$.translation")
    nested = lambda k: F.coalesce(*[_said(_present(r, f"{p}.{k}")) for p in others])
    lang = lambda k: F.coalesce(_said(_present(r, f"$.text.{k}")), _said(_present(r, f"$.{k}")))
    plain = {"en": _said(_present(r, *others))}
    texts = [F.coalesce(lang(k), plain.get(k, F.lit(None)), nested(k), F.lit("")).alias(k) for k in ("ar", "en", "id")]
    scan = F.try_variant_get(_present(r, "$.scanSrc", "$.scan"), "$", "string").alias("scan")
    section = F.coalesce(F.try_variant_get(_present(r, "$.sectionId", "$.section"), "$", "string"), F.lit("")).alias("section")
    out = rows.select("at", _page(r).alias("page"), *texts, scan, section)
    return relate.first_by(out.filter(F.col("page").between(1, total)), ["page"], F.col("at").desc()).drop("at")


def tolerant_errors(docs: DataFrame, key: str, column: str, total: int) -> DataFrame:
    """(key, error) of the documents that an import refuses: no JSON, no records, or none with a page in range."""
    items = _entries(docs, column)
    known = F.exists(F.transform(items, _page), lambda p: F.coalesce(p.between(1, total), F.lit(False)))
    error = F.when(_whole(column).isNull(), "invalid JSON").when(F.coalesce(F.size(items), F.lit(0)) <= 0, "no page entries").when(~known, "no valid pages")
    return docs.select(key, error.alias("error")).filter("error is not null")


def require_rows(rows: DataFrame, key: str) -> DataFrame:
    """Fails when it is run if there are no rows."""
    n = rows.agg(F.count(F.lit(1)).alias("n")).select(F.assert_true(F.col("n") > 0, F.lit("no pages found")).alias("checked"))
    return rows.join(F.broadcast(n)).filter("checked is null").drop("checked")  # one row


def event_log(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a JSON log; blank ones are skipped."""
    lines = spark.read.text(path).filter(F.trim("value") != "")
    return lines.select(F.from_json("value", EVENT).alias("e")).select("e.*")


def snapshot_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """(path, was, now, change) of two snapshots (path, content) whose digests differ."""
    digest = lambda df: df.select("path", F.sha2("content", 256).alias("digest"))
    return relate.version_delta(digest(before), digest(after), "path", "digest").filter("change != 'same'")


def newest_filled(versions: DataFrame, key: str, version: str, value: str) -> DataFrame:
    """(key, value) from the newest version that has one."""
    return versions.filter(F.col(value).isNotNull()).groupBy(key).agg(F.max_by(value, version).alias(value))


def base64_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", F.base64("content").alias("data"))


def stage_of(spark: SparkSession, folders: dict[str, str], total: int, least: int = 10) -> DataFrame:
    """(page, status): the furthest stage, in the order of folders, whose file is larger than least bytes, else pending."""
    out = spark.range(1, total + 1).select(F.col("id").cast("int").alias("page"), F.lit("pending").alias("status"))
    for stage, path in folders.items():
        files = spark.read.format("binaryFile").option("pathGlobFilter", "page_*.txt").load(path)
        have = files.filter(F.col("length") > least).select(F.regexp_extract("path", PAGE_NAME, 1).cast("int").alias("have")).distinct()
        out = out.join(have, F.col("page") == F.col("have"), "left").withColumn("status", F.when(F.col("have").isNotNull(), stage).otherwise(F.col("status"))).drop("have")
    return out


def one_record(records: DataFrame, page: int) -> DataFrame:
    """The record of a page; fails when it is run unless there is exactly one."""
    rows = records.filter(F.col("page") == page)
    n = rows.agg(F.count(F.lit(1)).alias("n")).select(F.assert_true(F.col("n") == 1, F.lit(f"page {page} must have one record")).alias("checked"))
    return rows.join(F.broadcast(n)).filter("checked is null").drop("checked")  # one row


def total_pages(manifest: str, default: int = 604) -> int:
    """total_pages of a manifest file, or the default if it is missing or not a positive whole number."""
    try:
        n = json.loads(Path(manifest).read_text()).get("total_pages")
    except (OSError, ValueError, AttributeError):
        return default
    return n if type(n) is int and n > 0 else default


def records(spine: DataFrame, scan_base: str = "/scans/") -> DataFrame:
    """Dataset records of (page, ar, en, id): empty texts become the language's fallback, and the scan's address is added."""
    from quire.functions.dims import FALLBACKS

    filled = {g: F.coalesce(F.nullif(text.clean(F.col(g)), F.lit("")), F.lit(FALLBACKS["validator"]["en" if g == "ar" else g][1])) for g in ("ar", "en", "id")}
    return spine.select("page", F.struct(*[c.alias(g) for g, c in filled.items()]).alias("text"), text.page_name(F.col("page"), scan_base + "page_", ".jpg").alias("scanSrc"))


def placeholder_page(page: Column, seeds: list[str]) -> Column:
    """The same stand-in text for the same page number."""
    return F.element_at(F.array(*map(F.lit, seeds)), (F.pmod(page, F.lit(len(seeds))) + 1).cast("int"))
