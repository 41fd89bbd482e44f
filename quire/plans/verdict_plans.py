"""The whole dataset audit over a book with a source layer, and what of it blocks a release."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators import checks
from quire.plans.audit_plans import EN, ID, SYMBOL_SQL
from quire.plans.book_plans import LETTER
from quire.plans.registry import query
from quire.plans.relation_plans import docs

INDONESIAN = " ".join(["dan bacalah nama itu pada malam yang terang untuk kebaikan"] * 4)
ENGLISH = " ".join(["and read this name in the night of the moon for the good of it"] * 4)
SAME = " ".join(["Every page whose body repeats this one was copied forward and never translated."] * 4)
ARABIC = "ابتثجحخدذرزسشص"
#: A book of three layers: each eighth page has one fault of its own in the English text, or in what it prints as its number.
LAYERS = f"""SELECT doc_id + 1 AS page, 'ar' AS layer, doc_id || chr(10) || coalesce(text, '') AS body FROM documents UNION ALL
SELECT doc_id + 1, 'en', CASE doc_id % 8 WHEN 1 THEN (doc_id + 1) || chr(10) || coalesce(text, '') WHEN 2 THEN (doc_id + 5) || chr(10) || coalesce(text, '') WHEN 3 THEN '' WHEN 4 THEN doc_id || chr(10) || coalesce(text, '') || chr(10) || '--- PAGE 12 TRANSLATION ---' || chr(10) || 'end'
  WHEN 5 THEN doc_id || chr(10) || coalesce(text, '') || ' {ARABIC}' WHEN 6 THEN doc_id || chr(10) || '{INDONESIAN}' WHEN 7 THEN '{SAME}' ELSE doc_id || chr(10) || coalesce(text, '') END FROM documents UNION ALL
SELECT doc_id + 1, 'id', (doc_id + CASE doc_id % 8 WHEN 1 THEN 1 WHEN 2 THEN 7 ELSE 0 END) || chr(10) || CASE WHEN doc_id % 8 = 2 THEN '{ENGLISH}' ELSE '{INDONESIAN}' END FROM documents"""
WORD = "[A-Za-z][A-Za-z''’-]*"
AUDIT = rf"""WITH l AS MATERIALIZED (SELECT *, trim(regexp_replace(regexp_replace(body, '\s+', ' ', 'g'), '^ | $', '', 'g')) AS b FROM ({LAYERS})),
k AS (SELECT *, regexp_extract_all(lower(b), '{WORD}') AS ts FROM l),
d AS (SELECT *, CASE layer WHEN 'en' THEN len(list_filter(ts, lambda t: t IN ({ID}))) WHEN 'id' THEN len(list_filter(ts, lambda t: t IN ({EN}))) END::DOUBLE / nullif(len(ts), 0) AS density FROM k),
s AS (SELECT *, CASE WHEN b = '' THEN 'empty' WHEN layer = 'ar' OR length(b) >= 25 AND len(regexp_extract_all(b, '{LETTER}'))::DOUBLE / length(b) <= 0.15 AND len(ts) >= 4
    AND len(regexp_extract_all(b, '{SYMBOL_SQL}'))::DOUBLE / nullif(len(regexp_extract_all(b, '\S')), 0) <= 0.25 AND coalesce(density, 0) <= 0.02 THEN 'real' ELSE 'not-translation-like' END AS state,
  CASE WHEN layer = 'ar' THEN page - 1 WHEN layer = 'id' THEN page - 1 + CASE (page - 1) % 8 WHEN 1 THEN 1 WHEN 2 THEN 7 ELSE 0 END WHEN (page - 1) % 8 IN (3, 7) THEN NULL ELSE page - 1 + CASE (page - 1) % 8 WHEN 1 THEN 1 WHEN 2 THEN 5 ELSE 0 END END AS number FROM d),
g AS (SELECT layer, md5(b) AS h, min(page) AS first_page FROM l WHERE length(b) >= 200 GROUP BY 1, 2),
n AS (SELECT t.page, t.layer, a.number AS want, t.number AS got FROM s t JOIN s a ON a.page = t.page AND a.layer = 'ar' WHERE t.layer <> 'ar'),
r AS (SELECT doc_id + 1 AS page, doc_id % 13 = 0 AS untitled, doc_id % 17 = 0 AS unscanned FROM documents WHERE doc_id % 50 <> 49 UNION ALL SELECT doc_id + 1, doc_id % 13 = 0, doc_id % 17 = 0 FROM documents WHERE doc_id % 29 = 0 AND doc_id % 50 <> 49
  UNION ALL SELECT -doc_id - 1, false, false FROM documents WHERE doc_id % 41 = 0),
f AS (SELECT 'coverage' AS rule, page, layer, 'error' AS severity, NULL::BIGINT AS other_page, state AS detail FROM s WHERE state <> 'real'
  UNION ALL SELECT 'batch-artifact', page, layer, 'error', NULL, NULL FROM s WHERE layer = 'en' AND (page - 1) % 8 = 4
  UNION ALL SELECT 'arabic-run', page, layer, 'error', NULL, NULL FROM s WHERE layer = 'en' AND (page - 1) % 8 = 5
  UNION ALL SELECT 'wrong-language', page, layer, 'error', NULL, NULL FROM s WHERE layer <> 'ar' AND length(b) >= 100 AND density > 0.05
  UNION ALL SELECT 'duplicate-body', page, s.layer, 'error', first_page, NULL FROM s JOIN g ON g.layer = s.layer AND h = md5(b) WHERE length(b) >= 200 AND page > first_page
  UNION ALL SELECT CASE WHEN abs(got - want) >= 2 THEN 'misfiled' ELSE 'off-by-one' END, page, layer, CASE WHEN abs(got - want) >= 2 THEN 'error' ELSE 'info' END, NULL, want || ' vs ' || got FROM n WHERE want <> got
  UNION ALL SELECT 'missing-page', doc_id + 1, 'record', 'error', NULL, NULL FROM documents WHERE doc_id % 50 = 49
  UNION ALL SELECT 'repeated-page', page, 'record', 'error', NULL, NULL FROM r GROUP BY page HAVING count(*) > 1
  UNION ALL SELECT 'unexpected-page', page, 'record', 'error', NULL, NULL FROM r WHERE page < 0
  UNION ALL SELECT 'untitled', page, 'record', 'error', NULL, NULL FROM r GROUP BY page HAVING bool_or(untitled)
  UNION ALL SELECT 'no-scan', page, 'record', 'warning', NULL, NULL FROM r GROUP BY page HAVING bool_or(unscanned))"""


def findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = docs(spark, sf_dir).select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("t"))
    n, k = F.col("doc_id"), F.col("doc_id") % 8
    under = lambda number, *body: F.concat(number.cast("string"), F.lit("\n"), *body)
    en = F.get(F.array(
        under(n, F.col("t")), under(n + 1, F.col("t")), under(n + 5, F.col("t")), F.lit(""), under(n, F.col("t"), F.lit("\n--- PAGE 12 TRANSLATION ---\nend")), under(n, F.col("t"), F.lit(f" {ARABIC}")), under(n, F.lit(INDONESIAN)), F.lit(SAME)
    ), k.cast("int"))
    own = under(n + F.when(k == 1, 1).when(k == 2, 7).otherwise(0), F.when(k == 2, ENGLISH).otherwise(INDONESIAN))
    layers = F.array(*[F.struct(F.lit(g).alias("layer"), b.alias("body")) for g, b in (("ar", under(n, F.col("t"))), ("en", en), ("id", own))])
    pages = rows.select((n + 1).alias("page"), F.explode(layers).alias("l")).select("page", "l.layer", "l.body")
    title, scan = F.when(n % 13 == 0, " ").otherwise("title"), F.when(n % 17 == 0, F.lit(None)).otherwise("scan")
    ids = docs(spark, sf_dir).select("doc_id")
    records = ids.filter(n % 50 != 49).select(F.explode(F.when(n % 29 == 0, F.array(n + 1, n + 1)).otherwise(F.array(n + 1))).alias("page"), title.alias("title"), scan.alias("scan"))
    records = records.unionByName(ids.filter(n % 41 == 0).select((-n - 1).alias("page"), F.lit("title").alias("title"), F.lit("scan").alias("scan")))
    return checks.dataset_audit(pages).unionByName(checks.structure(records, ids.select((n + 1).alias("page"))))


@query(f"{AUDIT} SELECT * FROM f")
def audit_book(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All seven sections of the audit over a book with a source and two targets."""
    return findings(spark, sf_dir).select("rule", "page", "layer", "severity", "other_page", "detail")


@query(f"""{AUDIT} SELECT CASE WHEN rule IN ('missing-page', 'repeated-page', 'unexpected-page') THEN 'record count/contiguity' WHEN rule = 'untitled' THEN 'untitled pages' ELSE layer || ' duplicate bodies' END AS reason, count(*) AS n_findings
FROM f WHERE rule IN ('missing-page', 'repeated-page', 'unexpected-page', 'untitled', 'duplicate-body') GROUP BY 1""")
def audit_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Why the book may not be released."""
    return checks.verdict(findings(spark, sf_dir))
