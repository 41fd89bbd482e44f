"""Validators, receipts and repairs over a book of file pairs in which each check comes out both ways."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import text
from quire.operators import checks, evidence, repair, sweeps
from quire.plans.registry import query
from quire.plans.relation_plans import docs
from quire.sources import sinks

#: page, t (its English text), source, own (its Indonesian text), k (the fault that it has; 0 and 7: none).
PAIRS = r"""b AS (SELECT doc_id + 1 AS page, regexp_replace(regexp_replace(coalesce(text, ''), '\r\n?', chr(10), 'g'), '^\s+|\s+$', '', 'g') AS c FROM documents),
p AS (SELECT page, page % 8 AS k, 'نص الصفحة ' || page AS source, CASE WHEN page % 8 = 5 THEN '(No English text on this page.)' WHEN c = '' THEN 'Page ' || page ELSE c END AS t, 'Halaman ' || page || ' bacalah nama itu pada malam yang terang' AS own FROM b)"""
FILE = lambda label, source, body: f"'Arabic:' || chr(10) || {source} || chr(10) || chr(10) || '{label}:' || chr(10) || {body} || chr(10)"
EN_FILE, ID_FILE = FILE("English", "CASE WHEN k = 3 THEN source || 'x' ELSE source END", "t"), FILE("Indonesia", "source", "own")


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = docs(spark, sf_dir).select((F.col("doc_id") + 1).alias("page"), text.clean(F.col("text")).alias("c")).withColumn("k", F.col("page") % 8)
    body = F.when(F.col("k") == 5, "(No English text on this page.)").when(F.col("c") == "", F.concat(F.lit("Page "), F.col("page").cast("string"))).otherwise(F.col("c"))
    return rows.select("page", "k", F.expr("'نص الصفحة ' || page").alias("source"), body.alias("t"), F.expr("'Halaman ' || page || ' bacalah nama itu pada malam yang terang'").alias("own")).withColumns({"en": F.expr(EN_FILE), "id": F.expr(ID_FILE)})


def reported(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(files, reports) of the pairs."""
    rows = pairs(spark, sf_dir)
    files = rows.select("page", F.lit("en").alias("layer"), F.col("en").alias("content")).unionByName(rows.filter("k <> 1").select("page", F.lit("id").alias("layer"), F.col("id").alias("content")))
    record = F.struct(F.col("source").alias("ar"), F.when(F.col("k") == 2, "another text").otherwise(F.col("t")).alias("en"), F.col("own").alias("id"))
    records = rows.filter("k <> 4").select("page", F.explode(F.when(F.col("k") == 6, F.array(record, record)).otherwise(F.array(record))).alias("text"))
    return files, checks.validate(files, rows.select("page", F.col("source").alias("body")), records)


REPORT = f"""WITH {PAIRS}, v AS (SELECT *, CASE k WHEN 1 THEN 'id: file missing' WHEN 2 THEN 'en: dataset differs from file' WHEN 3 THEN 'en: embedded Arabic differs from canonical source' WHEN 4 THEN 'dataset has 0 records'
  WHEN 5 THEN 'en: fallback text is not allowed on a content page' WHEN 6 THEN 'dataset has 2 records' ELSE '' END AS errors FROM p)"""


@query(f"{REPORT} SELECT page, errors = '' AS ok, errors FROM v")
def validated_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports on pages with files in both languages, one fault for each kind, and none."""
    return reported(spark, sf_dir)[1].select("page", "ok", F.array_join("errors", "; ").alias("errors"))


@query(f"{REPORT} SELECT count(*) AS pages, count(*) FILTER (errors = '') AS passed, count(*) FILTER (errors <> '') AS failed FROM v")
def sweep_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.sweep_totals(reported(spark, sf_dir)[1])


@query(f"{REPORT} SELECT page, 'verification_receipt' AS type, 'r' AS reviewer, true AS ok, sha256({EN_FILE}) AS en, sha256({ID_FILE}) AS id FROM v WHERE errors = ''")
def verification_receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A receipt for each page that passes, with the digests of its files."""
    files, reports = reported(spark, sf_dir)
    named = files.select("page", F.col("layer").alias("path"), F.col("content").cast("binary").alias("content"))
    r = evidence.receipts(reports, named, "w", "r").select("page", "receipt.*")
    return r.select("page", "type", "reviewer", F.col("validator.ok").alias("ok"), *[F.element_at("file_hashes", g).alias(g) for g in ("en", "id")])


TRANSLATED, ENGLISH_TEXT = "bacalah nama itu pada malam yang terang untuk semua saudara", "read this name aloud at night under a bright moon, brother"
#: Every third file has an Indonesian block: a translation that its sibling also has, one that it has not, a stub, or English.
FOREIGN = f"CASE page % 4 WHEN 0 THEN '{TRANSLATED} ' || page WHEN 1 THEN '{TRANSLATED}' WHEN 2 THEN 'halaman' ELSE '{ENGLISH_TEXT}' END"


@query(f"SELECT page, page % 4 <> 1 AS safe FROM (SELECT doc_id + 1 AS page FROM documents) WHERE page % 3 = 0")
def foreign_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with a block of another language, and whether dropping it loses nothing."""
    return repair.strip_labels(foreign(spark, sf_dir)).select("page", "safe")


@query(f"SELECT page, length('own ' || page)::INT AS own_chars, (page % 4 = 3)::INT AS n_stray FROM (SELECT doc_id + 1 AS page FROM documents) WHERE page % 3 = 0")
def stray_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same files, with blocks that read as the file's own language under another label."""
    return repair.stray_bodies(foreign(spark, sf_dir).filter("layer = 'en'")).select("page", "own_chars", F.size("stray").alias("n_stray"))


def foreign(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = docs(spark, sf_dir).select((F.col("doc_id") + 1).alias("page"))
    own = F.concat(F.lit("Arabic:\nنص\n\nEnglish:\nown "), F.col("page").cast("string"))
    other = F.when(F.col("page") % 3 == 0, F.concat(F.lit("\n\nIndonesia:\n"), F.expr(FOREIGN))).otherwise("")
    sibling = F.concat(F.lit("Arabic:\nنص\n\nIndonesia:\n"), F.when(F.col("page") % 4 == 1, "lain").otherwise(F.expr(FOREIGN)))
    every = F.array(F.struct(F.lit("en").alias("layer"), F.concat(own, other, F.lit("\n")).alias("content")), F.struct(F.lit("id").alias("layer"), F.concat(sibling, F.lit("\n")).alias("content")))
    return rows.select("page", F.explode(every).alias("f")).select("page", "f.layer", "f.content")


FILLER = "𐍈"


@query(f"""WITH {PAIRS}, x AS (SELECT page, source, CASE page % 4 WHEN 0 THEN source WHEN 1 THEN source || '{FILLER}' WHEN 2 THEN source || repeat('{FILLER}', 3) ELSE replace(source, 'ن', '') END AS emb FROM p)
SELECT page, CASE WHEN page % 4 = 0 THEN 'same' WHEN page % 4 IN (1, 3) THEN 'fixable' ELSE 'escalate' END AS drift, CASE page % 4 WHEN 1 THEN 1 WHEN 2 THEN 3 ELSE 0 END AS filler FROM x""")
def filler_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embedded sources with filler glyphs too many, or a letter too few."""
    emb = F.expr(f"CASE page % 4 WHEN 0 THEN source WHEN 1 THEN source || '{FILLER}' WHEN 2 THEN source || repeat('{FILLER}', 3) ELSE replace(source, 'ن', '') END")
    return pairs(spark, sf_dir).select("page", repair.source_drift(emb, F.col("source")).alias("drift"), repair.filler_drift(emb, F.col("source")).alias("filler"))


@query("""SELECT conv_id AS page, turn AS paragraph, md5('<' || tag || '>' || replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') || '</' || tag || '>') AS digest
  FROM (SELECT *, CASE role WHEN 'system' THEN 'h3' WHEN 'user' THEN 'pre' ELSE 'p' END AS tag FROM conversations)""")
def block_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as the blocks of a page: headings, grids and prose, escaped."""
    from quire.sources.scan import table

    kind = F.when(F.col("role") == "system", "section_heading").when(F.col("role") == "user", "grid").otherwise("prose")
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("page"), F.col("turn").alias("paragraph"), kind.alias("kind"), F.col("text").alias("body"))
    return sinks.html_blocks(rows).select("page", "paragraph", F.md5("html").alias("digest"))


#: Words of a source: one that all pages have and a stop word, between some that follow from the page's number.
WORDED = "'بسم الله الرحمن الرحيم ' || repeat('العلوم ', 2) || repeat('ابجد', 2 + page % 5) || ' ' || repeat('نور', 1 + page % 4) || ' نص ' || repeat('حرف', 2 + page % 3)"


@query(rf"""WITH w AS (SELECT DISTINCT doc_id + 1 AS page, unnest(regexp_extract_all({WORDED.replace("page", "(doc_id + 1)")}, '[\x{{0600}}-\x{{06FF}}]{{5,}}')) AS term FROM documents),
r AS (SELECT page, term, row_number() OVER (PARTITION BY page ORDER BY length(term) DESC, term)::INT AS place FROM w WHERE term NOT IN ({", ".join(f"'{x}'" for x in sweeps.COMMON_WORDS)}))
SELECT page, place, term FROM r WHERE place <= 6""")
def own_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The longest words of each source, without stop words."""
    rows = docs(spark, sf_dir).select((F.col("doc_id") + 1).alias("page"))
    return sweeps.own_terms(rows.select("page", F.expr(WORDED).alias("body")))


ENRICHED = "CASE doc_id % 4 WHEN 0 THEN substr(t, 1, CAST(floor(length(t) / 3) AS INT)) WHEN 1 THEN concat(t, ' more') WHEN 2 THEN concat(t, t, t, t) ELSE substr(t, 1, CAST(ceil(length(t) / 2) AS INT)) END"


@query(f"""SELECT doc_id, md5(CASE WHEN length(e) BETWEEN 0.5 * length(t) AND 3 * length(t) THEN e ELSE t END) AS digest, (length(e) BETWEEN 0.5 * length(t) AND 3 * length(t)) AS accepted
  FROM (SELECT doc_id, t, {ENRICHED} AS e FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents))""")
def enriched_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enriched texts that are too short or too long give way to the raw ones."""
    rows = docs(spark, sf_dir).select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("t")).withColumn("e", F.expr(ENRICHED))
    kept = checks.accept_enriched(F.col("t"), F.col("e"))
    return rows.select("doc_id", F.md5(kept).alias("digest"), (kept == F.col("e")).alias("accepted"))
