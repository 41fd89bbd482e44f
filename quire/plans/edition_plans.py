"""Queries of the printed edition and of the repair of cut-off sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import dims
from quire.operators import layout, relate, sweeps
from quire.plans.registry import query, values
from quire.plans.relation_plans import docs
from quire.plans.text_plans import LINES

RUNS = rf"""{LINES}, t AS (SELECT *, regexp_matches(line, '\|.*\|') AND NOT starts_with(line, '[Letter-string:') AS is_table, line = '' AS blank FROM l),
w AS (SELECT *, lag(blank) OVER o AS wb, lag(is_table) OVER o AS wt FROM t WINDOW o AS (PARTITION BY doc_id ORDER BY line_no)),
i AS (SELECT *, sum(CASE WHEN wb IS NULL OR wb <> blank OR wt <> is_table THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY line_no) AS island FROM w),
b AS (SELECT doc_id AS page, row_number() OVER (PARTITION BY doc_id ORDER BY island)::INT - 1 AS block FROM i WHERE NOT blank GROUP BY doc_id, island)"""


@query(f"""WITH {RUNS}, f AS (SELECT figure, page, after_block FROM {values(dims.FIGURES, "figure, page, after_block, size")}), m AS (SELECT page, max(block) AS last FROM b GROUP BY 1),
every AS (SELECT page, NULL::INT AS figure, block, block AS behind FROM b UNION ALL SELECT f.page, f.figure, NULL, CASE WHEN after_block < 0 THEN -1 ELSE least(after_block, last) END FROM f LEFT JOIN m ON f.page = m.page WHERE after_block < 0 OR last IS NOT NULL)
SELECT page, row_number() OVER (PARTITION BY page ORDER BY behind, figure NULLS FIRST)::INT AS place, figure::INT AS figure, block::INT AS block FROM every""")
def figure_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks and figures of every page in the order in which they are printed."""
    runs = layout.segments(docs(spark, sf_dir), "doc_id", "text").select(F.col("doc_id").alias("page"), (F.col("segment") - 1).alias("block"))
    return relate.place_figures(dims.figures(spark), runs, "page")


CLEAN = r"regexp_replace(regexp_replace({0}, '\r\n?', chr(10), 'g'), '^\s+|\s+$', '', 'g')"
FLAT = r"regexp_replace(regexp_replace({0}, '\s+', ' ', 'g'), '^ | $', '', 'g')"
#: What is embedded in each file: the whole, its first half as it is or on one line, another half, or nearly all.
CUT = """CASE doc_id % 5 WHEN 0 THEN c WHEN 1 THEN substr(c, 1, length(c) // 2) WHEN 2 THEN replace(substr(c, 1, length(c) // 2), chr(10), ' ') WHEN 3 THEN 'x' || substr(c, 1, length(c) // 2)
  ELSE substr(c, 1, greatest(length(c) - 100, 0)) END"""


@query(rf"""WITH s AS (SELECT doc_id, {CLEAN.format("coalesce(text, '')")} AS c FROM documents), e AS (SELECT *, {CLEAN.format(CUT)} AS emb FROM s), f AS (SELECT *, {FLAT.format("emb")} AS a, {FLAT.format("c")} AS b FROM e)
SELECT doc_id AS page, (length(c) - length(emb))::INT AS shortfall, md5('Arabic:' || chr(10) || c || chr(10) || chr(10) || 'English:' || chr(10) || CASE WHEN doc_id % 7 = 0 THEN '' ELSE 'kept ' || doc_id END || chr(10)) AS digest
FROM f WHERE emb <> '' AND emb <> c AND length(c) > length(emb) AND starts_with(b, substr(a, 1, 200)) AND length(b) - length(a) >= 200""")
def restore_truncated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as sources, embedded whole or cut off in files of labelled blocks; the repaired files are compared."""
    from quire.functions import text

    rows = docs(spark, sf_dir).select("doc_id", text.clean(F.coalesce(F.col("text"), F.lit(""))).alias("c"))
    n = F.length("c")
    half = F.substring(F.col("c"), F.lit(1), F.floor(n / 2).cast("int"))
    emb = F.get(F.array(F.col("c"), half, F.replace(half, F.lit("\n"), F.lit(" ")), F.concat(F.lit("x"), half), F.substring(F.col("c"), F.lit(1), F.greatest(n - 100, F.lit(0)))), (F.col("doc_id") % 5).cast("int"))
    target = F.when(F.col("doc_id") % 7 == 0, "").otherwise(F.concat(F.lit("\n\nEnglish:\nkept "), F.col("doc_id").cast("string")))
    files = rows.select(F.col("doc_id").alias("page"), F.lit("en").alias("layer"), F.concat(F.lit("Arabic:\n"), emb, target, F.lit("\n")).alias("content"))
    found = sweeps.restore_truncated(files, rows.select(F.col("doc_id").alias("page"), F.col("c").alias("body")))
    return found.select("page", "shortfall", F.md5("content").alias("digest"))
