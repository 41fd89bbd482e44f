"""Queries over what is kept up or written in pieces: chapters, the segmented index, streamed state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import dims
from quire.operators import segments
from quire.plans.campaign_plans import LATEST
from quire.plans.registry import query
from quire.plans.relation_plans import CHAPTERS, IN_CHAPTER, docs
from quire.plans.tracker_plans import RAW
from quire.sources import chapters, pagetree, versions, work
from quire.sources.scan import lenient, table
from quire.streaming import state_log

PIECE = 1 << 16
TRIM = "regexp_replace(replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10)), '^\\s+|\\s+$', '', 'g')"
PIECES = f"""SELECT slug, floor(start / {PIECE})::BIGINT AS piece, min(start)::BIGINT AS byte_offset, count(*) AS n_pages, sum(size)::BIGINT AS n_bytes, sha256(string_agg(section, '' ORDER BY doc_id)) AS digest
  FROM (SELECT *, coalesce(sum(size) OVER (PARTITION BY slug ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
    FROM (SELECT slug, doc_id, section, octet_length(encode(section)) AS size
      FROM (SELECT slug, doc_id, chr(10) || repeat('━', 60) || '  ┃  PAGE ' || CASE WHEN doc_id < 100 THEN lpad(doc_id::VARCHAR, 3, '0') ELSE doc_id::VARCHAR END || repeat('━', 60) || chr(10) || text AS section
        FROM documents JOIN {CHAPTERS} c ON {IN_CHAPTER}
        WHERE length({TRIM}) >= 30 AND NOT contains(text, 'There is no text on this page') AND NOT contains(text, 'This page is empty')))) GROUP BY 1, 2"""


def _pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chapters.pieces(chapters.placed(docs(spark, sf_dir), "doc_id", "text", dims.chapters(spark)), piece_bytes=PIECE)


@query(PIECES)
def chapter_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of each chapter joined in order, in pieces of about 64 KB, each with its digest."""
    return _pieces(spark, sf_dir).select("slug", "piece", F.col("offset").alias("byte_offset"), "n_pages", "n_bytes", F.sha2("content", 256).alias("digest"))


@query(f"SELECT slug, sum(n_pages)::BIGINT AS n_pages, sum(n_bytes)::BIGINT AS n_bytes, sha256(string_agg(digest, '' ORDER BY piece)) AS digest FROM ({PIECES}) GROUP BY 1")
def chapter_concat_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chapters.digests(_pieces(spark, sf_dir))


@query("""WITH now AS (SELECT doc_id, CASE WHEN lang = 'fr' THEN reverse(text) ELSE text END AS text FROM documents WHERE lang <> 'de' OR lang IS NULL),
t AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')) AS term FROM now)
SELECT doc_id, count(DISTINCT term) AS n_terms, count(*) AS n_positions, md5(string_agg(DISTINCT term, ' ' ORDER BY term)) AS terms FROM t GROUP BY 1""")
def index_upkeep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Terms of each document from an index of all but the Spanish ones, after the German ones are deleted, the French ones turned round and the Spanish ones inserted."""
    pages = docs(spark, sf_dir).select(F.col("doc_id").alias("page_num"), F.col("text").alias("content"), "lang")
    index = segments.SegmentedIndex(spark, work.folder(spark, "index"))
    change = lambda op, rows: index.apply(rows.select(F.lit(op).alias("op"), "page_num", "content"))
    change("insert", pages.filter(F.coalesce(F.col("lang") != "es", F.lit(True))))
    change("delete", pages.filter("lang = 'de'"))
    change("update", pages.filter("lang = 'fr'").withColumn("content", F.reverse("content")))
    change("insert", pages.filter("lang = 'es'"))
    found = index.postings().groupBy(F.col("page_num").alias("doc_id")).agg(F.count(F.lit(1)).alias("n_terms"), F.sum(F.size("positions")).alias("n_positions"), F.array_sort(F.collect_list("term")).alias("ts"))
    return found.select("doc_id", "n_terms", "n_positions", F.md5(F.array_join("ts", " ")).alias("terms"))


@query(f"SELECT user_id, status FROM ({LATEST})")
def stream_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's latest event, kept by a stream as one state behind manifests."""
    events = spark.readStream.schema(RAW).parquet(f"{sf_dir}/events.parquet*")
    rows = events.select("user_id", F.col("event_type").alias("status"), F.struct("ts", "event_id").alias("at"))
    path = work.folder(spark, "state")
    state_log.replace_latest(rows, path, work.folder(spark, "state-stream"), ["user_id"], "at").awaitTermination()
    return state_log.StateLog(spark, path).read().select("user_id", "status")


STAGES = ("ocr", "enriched", "enriched_en")
TREE = "SELECT doc_id::INT + 1 AS page, lang, coalesce(text, '') || CASE WHEN doc_id % 4 = 1 THEN chr(65533) ELSE '' END AS body, octet_length(encode(coalesce(text, ''))) + (doc_id % 4 = 1)::INT AS size, doc_id % 3 AS third FROM documents"


@query(f"""SELECT page, CASE WHEN size <= 10 THEN 'pending' WHEN lang = 'en' THEN 'enriched_en' WHEN third > 0 THEN 'enriched' ELSE 'ocr' END AS status, (1 + (third > 0)::INT + coalesce(lang = 'en', false)::INT)::BIGINT AS n_files,
  sha256(body) AS digest FROM ({TREE})""")
def page_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as page files of three layers, some with a broken byte, read back; each page's stage from the listing."""
    rows = docs(spark, sf_dir).select((F.col("doc_id") + 1).alias("page"), "lang", F.col("doc_id"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("raw"))
    content = F.when(F.col("doc_id") % 4 == 1, F.concat("raw", F.unhex(F.lit("FF")))).otherwise(F.col("raw"))
    layer = F.filter(F.array(F.lit("ocr"), F.when(F.col("doc_id") % 3 > 0, "enriched"), F.when(F.col("lang") == "en", "enriched_en")), lambda x: x.isNotNull())
    path = work.folder(spark, "tree").removeprefix("file:")
    pagetree.write(rows.select(F.explode(layer).alias("layer"), "page", content.alias("content")), path)
    listed = pagetree.read(spark, path, content=False)
    status = pagetree.furthest(listed, STAGES, listed.agg(F.max("page")).first()[0] or 0)
    texts = pagetree.read(spark, path, layers=("ocr",)).select(F.col("page").alias("of"), F.sha2(lenient(F.col("content")), 256).alias("digest"))
    counts = listed.groupBy(F.col("page").alias("counted")).agg(F.count(F.lit(1)).alias("n_files"))
    return status.join(texts, F.col("page") == F.col("of")).join(counts, F.col("page") == F.col("counted")).select("page", "status", "n_files", "digest")


#: What each version makes of a document: the second empties the French and shouts, the third lacks the German and empties the Spanish.
VERSIONS = """SELECT doc_id, 1 AS version, coalesce(text, '') AS body FROM documents UNION ALL SELECT doc_id, 2, CASE WHEN lang = 'fr' THEN '' ELSE coalesce(text, '') || '!' END FROM documents
  UNION ALL SELECT doc_id, 3, CASE WHEN lang = 'es' THEN '' WHEN doc_id % 2 = 0 THEN coalesce(text, '') ELSE coalesce(text, '') || '!' END FROM documents WHERE lang <> 'de' OR lang IS NULL"""


def _snapshots(spark: SparkSession, sf_dir: str) -> str:
    root, rows = work.folder(spark, "versions"), docs(spark, sf_dir)
    body, path = F.coalesce(F.col("text"), F.lit("")), F.col("doc_id").cast("string").alias("path")
    spanish, french, german = (F.coalesce(F.col("lang") == x, F.lit(False)) for x in ("es", "fr", "de"))
    versions.add(rows.select(path, body.alias("content")), root, 1)
    versions.add(rows.select(path, F.when(french, "").otherwise(F.concat(body, F.lit("!"))).alias("content")), root, 2)
    versions.add(rows.filter(~german).select(path, F.when(spanish, "").when(F.col("doc_id") % 2 == 0, body).otherwise(F.concat(body, F.lit("!"))).alias("content")), root, 3)
    return root


@query(f"SELECT doc_id, max(version)::INT AS version, sha256(arg_max(body, version)) AS digest FROM ({VERSIONS}) WHERE body <> '' GROUP BY 1")
def snapshot_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's newest version that is not empty, of three."""
    found = versions.newest(spark, _snapshots(spark, sf_dir))
    return found.select(F.col("path").cast("long").alias("doc_id"), "version", F.sha2("content", 256).alias("digest"))


@query(f"""SELECT doc_id, CASE WHEN now IS NULL THEN 'removed' ELSE 'changed' END AS change FROM (SELECT doc_id, max(CASE WHEN version = 1 THEN body END) AS was, max(CASE WHEN version = 3 THEN body END) AS now FROM ({VERSIONS}) GROUP BY 1)
  WHERE was IS DISTINCT FROM now""")
def snapshot_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What changed from the first version to the third, by digests."""
    return versions.changes(spark, _snapshots(spark, sf_dir), 1, 3).select(F.col("path").cast("long").alias("doc_id"), "change")
