"""Duplicate detection, term statistics and audits as queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import chars, dims, text
from quire.operators import checks, duplicates
from quire.plans.registry import query
from quire.plans.relation_plans import docs
from quire.sources.scan import table

TOKENS = "regexp_extract_all(lower(text), '[A-Za-z][A-Za-z''’-]*')"
EN, ID = (", ".join(f"'{w}'" for w in sorted(set(dims.MARKERS[g]))) for g in ("en", "id"))
WORD_SQL = "regexp_extract_all(lower(text), '[a-zà-öø-ɏ'']+')"
LATIN = r"[a-zà-öø-ɏ']+"


def word_list(body):
    return F.regexp_extract_all(F.lower(body), F.lit(LATIN), F.lit(0))


def shingle_sql(source: str, key: str, k: int) -> str:
    return f"""SELECT DISTINCT {key}, array_to_string(ws[i:i + {k - 1}], ' ') AS s FROM (SELECT {key}, ws, unnest(range(1, len(ws) - {k - 2})) AS i FROM (SELECT {key}, {WORD_SQL} AS ws FROM {source}))"""


@query(f"""WITH f AS (SELECT min(doc_id) AS doc_id, arg_min(text, doc_id) AS text FROM documents GROUP BY md5(trim(regexp_replace(text, '\\s+', ' ', 'g')))),
s AS ({shingle_sql("f", "doc_id", 12)}), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS page_a, b.doc_id AS page_b, count(*) AS shared FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2)
SELECT page_a, page_b, shared, shared::DOUBLE / least(x.n, y.n) AS containment FROM p JOIN n x ON x.doc_id = page_a JOIN n y ON y.doc_id = page_b WHERE shared::DOUBLE / least(x.n, y.n) > 0.6""")
def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of first copies that share over 60% of the smaller one's twelve-word shingles."""
    return duplicates.near_pairs(docs(spark, sf_dir), "doc_id", "text")


@query(f"""WITH d AS ({shingle_sql("documents", "doc_id", 5)}), b AS ({shingle_sql("benchmark", "item_id", 5)}), n AS (SELECT item_id, count(*) AS n FROM b GROUP BY 1)
SELECT doc_id, item_id, count(*) AS shared, count(*)::DOUBLE / any_value(n) AS share FROM d JOIN b USING (s) JOIN n USING (item_id) GROUP BY 1, 2""")
def benchmark_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicates.containment(docs(spark, sf_dir), "doc_id", "text", table(spark, sf_dir, "benchmark"), "item_id", "text", 5)


@query(f"""WITH d AS (SELECT DISTINCT doc_id, unnest({WORD_SQL}) AS t FROM documents), b AS (SELECT DISTINCT item_id, unnest({WORD_SQL}) AS t FROM benchmark),
dn AS (SELECT doc_id, count(*) AS m FROM d GROUP BY 1), bn AS (SELECT item_id, count(*) AS n FROM b GROUP BY 1), j AS (SELECT item_id, doc_id, count(*) AS x FROM b JOIN d USING (t) GROUP BY 1, 2),
s AS (SELECT item_id, doc_id, x::DOUBLE / (n + m - x) AS jaccard FROM j JOIN dn USING (doc_id) JOIN bn USING (item_id))
SELECT item_id, doc_id AS best, jaccard FROM s QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY jaccard DESC, doc_id) = 1""")
def best_slot_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "benchmark").select("item_id", word_list(F.col("text")).alias("tokens"))
    return duplicates.best_slot(items, "item_id", docs(spark, sf_dir).select("doc_id", word_list(F.col("text")).alias("tokens")), "doc_id")


@query(f"SELECT term, count(*) AS df FROM (SELECT DISTINCT doc_id, unnest({WORD_SQL}) AS term FROM documents) GROUP BY 1")
def document_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicates.document_frequency(docs(spark, sf_dir), "doc_id", word_list(F.col("text")))


@query(f"""WITH t AS (SELECT DISTINCT doc_id, unnest({WORD_SQL}) AS term FROM documents), r AS (SELECT term FROM t GROUP BY 1 HAVING count(*) <= 3),
h AS (SELECT doc_id, lower(substr(text, 1, length(text) // 2)) AS half FROM documents),
c AS (SELECT doc_id, count(*) AS n_rare, sum(contains(half, term)::INT)::BIGINT AS n_found FROM t JOIN r USING (term) JOIN h USING (doc_id) GROUP BY 1)
SELECT doc_id, n_rare, n_found, n_found::DOUBLE / n_rare AS coverage FROM c WHERE n_rare >= 4""")
def rare_term_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many of a document's rare terms its first half already holds."""
    half = F.lower(F.substring(F.col("text"), F.lit(1), F.floor(F.length("text") / 2).cast("int")))
    return duplicates.rare_coverage(docs(spark, sf_dir).withColumn("half", half), "doc_id", word_list(F.col("text")), "half")


@query(r"""WITH l AS (SELECT doc_id, unnest(string_split(regexp_replace(regexp_replace(text, '\r\n?', chr(10), 'g'), '^\s+|\s+$', '', 'g'), chr(10))) AS line FROM documents),
c AS (SELECT doc_id, line, count(*) AS n FROM l WHERE regexp_matches(line, '\S') GROUP BY 1, 2)
SELECT doc_id, sum(n) OVER (PARTITION BY doc_id)::BIGINT AS n_lines, line AS top, n AS top_count FROM c QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, line) = 1""")
def top_line_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicates.top_line(docs(spark, sf_dir), "doc_id", "text")


@query(r"""WITH w AS (SELECT doc_id, length(text) AS n_body, substr(text, i, 12) AS w FROM (SELECT doc_id, text, unnest(range(1, length(text) - 11)) AS i FROM documents WHERE length(text) > 12)),
c AS (SELECT doc_id, n_body, w, count(*) AS n FROM w GROUP BY ALL), t AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, hex(w) DESC) = 1)
SELECT doc_id, w AS top, n AS top_count, n_body > 500 AND 3 * n > n_body AND NOT (contains(w, ' ') AND 2 * len(regexp_extract_all(w, '[A-Za-z ]')) > 12) AS looped FROM t""")
def top_char_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicates.top_window(docs(spark, sf_dir), "doc_id", "text")


@query(f"""SELECT doc_id, lang, len(ts)::INT AS n_tokens, coalesce(len(list_filter(ts, lambda t: t IN ({EN})))::DOUBLE / nullif(len(ts), 0), 0) AS en_density,
  coalesce(len(list_filter(ts, lambda t: t IN ({ID})))::DOUBLE / nullif(len(ts), 0), 0) AS id_density FROM (SELECT doc_id, lang, {TOKENS} AS ts FROM documents)""")
def marker_density_by_lang(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("text")
    return docs(spark, sf_dir).select("doc_id", "lang", chars.prose_score(F.lower(t)).alias("n_tokens"), chars.marker_density(t, dims.MARKERS["en"]).alias("en_density"), chars.marker_density(t, dims.MARKERS["id"]).alias("id_density"))


@query(f"""SELECT doc_id, density FROM (SELECT doc_id, length(trim(regexp_replace(text, '\\s+', ' ', 'g'))) AS n, coalesce(len(list_filter({TOKENS}, lambda t: t IN ({EN})))::DOUBLE / nullif(len({TOKENS}), 0), 0) AS density
  FROM documents WHERE lang <> 'en') WHERE n >= 100 AND density > 0.05""")
def wrong_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of other languages in which English function words are dense."""
    b = text.fold_space(F.col("text"))
    rows = docs(spark, sf_dir).filter("lang <> 'en'").select("doc_id", F.length(b).alias("n"), chars.marker_density(b, dims.MARKERS["en"]).alias("density"))
    return rows.filter("n >= 100 and density > 0.05").select("doc_id", "density")


SCRIPT_SQL = {
    "Cyrillic": r"\x{0400}-\x{04FF}", "Greek": r"\x{0370}-\x{03FF}", "CJK": r"\x{4E00}-\x{9FFF}", "Devanagari": r"\x{0900}-\x{097F}", "Thai": r"\x{0E00}-\x{0E7F}",
    "Armenian": r"\x{0530}-\x{058F}", "Georgian": r"\x{10A0}-\x{10FF}", "Katakana": r"\x{30A0}-\x{30FF}", "Hangul": r"\x{AC00}-\x{D7AF}",
    "U+FFFD replacement": r"\x{FFFD}", "control": r"\x01-\x08\x0B\x0C\x0E-\x1F\x7F-\x{9F}", "Latin accents": r"\x{C0}-\x{24F}", "Arabic block": r"\x{0600}-\x{06FF}",
}


@query("WITH t AS (SELECT text AS b FROM documents UNION ALL SELECT html FROM pages) " + " UNION ALL ".join(
    f"SELECT '{k}' AS kind, count(*) FILTER (regexp_matches(b, '[{c}]')) AS n_rows, coalesce(sum(len(regexp_extract_all(b, '[{c}]'))), 0)::BIGINT AS n_chars FROM t" for k, c in SCRIPT_SQL.items()))
def script_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and characters of each script, over documents and pages, in one scan."""
    kinds = chars.FOREIGN_SCRIPTS | {"U+FFFD replacement": chars.REPLACEMENT, "control": chars.CONTROL, "Latin accents": r"À-ɏ", "Arabic block": chars.ARABIC_BLOCK}
    every = docs(spark, sf_dir).select(F.col("text").alias("b")).union(table(spark, sf_dir, "pages").select("html"))
    counted = every.select(F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), chars.count(F.col("b"), c).alias("n")) for k, c in kinds.items()])).alias("x"))
    return counted.groupBy("x.kind").agg(F.count_if(F.col("x.n") > 0).alias("n_rows"), F.coalesce(F.sum("x.n"), F.lit(0)).alias("n_chars"))


@query("WITH c AS (SELECT page_id, i - 1 AS place, cs[i] AS ch FROM (SELECT page_id, cs, unnest(range(1, len(cs) + 1)) AS i FROM (SELECT page_id, regexp_extract_all(html, '(?s).') AS cs FROM pages))) SELECT page_id, place, ch, kind FROM (SELECT *, CASE "
    + " ".join(f"WHEN regexp_matches(ch, '[{c}]') THEN '{k}'" for k, c in SCRIPT_SQL.items() if k not in ("Latin accents", "Arabic block")) + " END AS kind FROM c) WHERE kind IS NOT NULL")
def foreign_script(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every character of a page that no target may hold, with its place."""
    return checks.foreign_places(table(spark, sf_dir, "pages"), "page_id", "html").select("page_id", F.col("at").cast("long").alias("place"), "ch", "kind")


@query(r"""SELECT doc_id, regexp_matches(replace(text, '[?]', ''), '(?i)\[\.\.\.|truncated\}|omitted for brevity') AS worker, regexp_matches(text, '(?i)\[\.\.\.|truncated\}|omitted for brevity|remaining pages|\[continue(?:d)? on|see next page') AS completeness,
  regexp_matches(text, 'ELEMENT_MESSAGE|The result of the|four lingual|\bPuPu|what what|/what\b|assistant<|analysis<|<tool_call>|Here''s a thinking') AS scratch FROM documents""")
def truncation_scratch_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("text")
    return docs(spark, sf_dir).select("doc_id", checks.truncated(t).alias("worker"), checks.truncated(t, "completeness").alias("completeness"), t.rlike(text.SCRATCH).alias("scratch"))


@query("""WITH c AS (SELECT conv_id, coalesce(sum(length(text)) FILTER (role = 'user'), 0) AS a, coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS b FROM conversations GROUP BY 1)
SELECT conv_id, a::BIGINT AS n_source, b::BIGINT AS n_target, b::DOUBLE / nullif(a, 0) AS ratio, coalesce(a > 200 AND b::DOUBLE / nullif(a, 0) < 0.25, false) AS too_short, b >= 0.5 * a AND b <= 3 * a AS accepted FROM c""")
def completeness_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers measured against their questions."""
    part = lambda role: F.coalesce(F.sum(F.when(F.col("role") == role, F.length("text"))), F.lit(0))
    rows = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(part("user").alias("a"), part("assistant").alias("b"))
    ratio = F.try_divide(F.col("b").cast("double"), F.col("a"))
    return rows.select("conv_id", F.col("a").alias("n_source"), F.col("b").alias("n_target"), ratio.alias("ratio"), F.coalesce((F.col("a") > 200) & (ratio < 0.25), F.lit(False)).alias("too_short"), ((F.col("b") >= 0.5 * F.col("a")) & (F.col("b") <= 3 * F.col("a"))).alias("accepted"))


SYMBOL_SQL = r"[^\x00-\x7F\x{0620}-\x{064A}\x{066E}-\x{06D3}\x{0750}-\x{077F}\x{08A0}-\x{08FF}\x{FB50}-\x{FDFF}\x{FE70}-\x{FEFF}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\p{Nd}—–]"
WORK_SQL = rf"""CASE WHEN regexp_matches(text, '(?i)no (visible )?(arabic )?text|does not contain any|tidak ada teks|tidak mengandung teks') AND length(text) < 200 THEN 'MARKER' WHEN len(regexp_extract_all(text, '\[\?\]')) > 200 THEN 'OCR-FAIL'
  WHEN len(regexp_extract_all(text, '{SYMBOL_SQL}')) > len(regexp_extract_all(text, '[\x{{0600}}-\x{{06FF}}]')) AND len(regexp_extract_all(text, '[\x{{0600}}-\x{{06FF}}]')) < 60 THEN 'GRID' ELSE 'TRANSLATE' END"""


@query(f"SELECT lang, {WORK_SQL} AS work, count(*) AS n FROM documents GROUP BY 1, 2")
def work_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = checks.work_class(F.col("text"), F.lit(""), F.lit("en"))
    return docs(spark, sf_dir).groupBy("lang", work.alias("work")).agg(F.count(F.lit(1)).alias("n"))


STATE_SQL = rf"""s AS (SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS b FROM documents),
k AS (SELECT *, regexp_extract_all(lower(b), '[A-Za-z][A-Za-z''’-]*') AS ts FROM s),
c AS (SELECT doc_id, b, ts, CASE WHEN b = '' THEN 'empty'
  WHEN regexp_matches(b, '(?i)no (english|indonesian|arabic) text on this page|tidak ada teks pada halaman ini|no visible text|no text visible|tidak ada teks yang terlihat|this page is empty|halaman ini kosong|blank page') THEN 'placeholder'
  WHEN length(b) >= 25 AND len(ts) >= 4 AND len(regexp_extract_all(b, '{SYMBOL_SQL}'))::DOUBLE / nullif(len(regexp_extract_all(b, '\S')), 0) <= 0.25
    AND len(list_filter(ts, lambda t: t IN ({ID})))::DOUBLE / nullif(len(ts), 0) <= 0.02 THEN 'real' ELSE 'not-translation-like' END AS state FROM k)"""


@query(f"WITH {STATE_SQL} SELECT 'en' AS layer, state, count(*) AS n_pages FROM c GROUP BY 1, 2")
def coverage_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents audited as the English layer of a book."""
    return checks.coverage_summary(layer_en(spark, sf_dir))


def layer_en(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs(spark, sf_dir).select(F.col("doc_id").alias("page"), F.lit("en").alias("layer"), F.col("text").alias("body"))


@query(f"""WITH {STATE_SQL}, g AS (SELECT md5(b) AS h, min(doc_id) AS first_page FROM c WHERE length(b) >= 200 GROUP BY 1),
w AS (SELECT doc_id, len(list_filter(ts, lambda t: t IN ({ID})))::DOUBLE / nullif(len(ts), 0) AS density FROM c WHERE length(b) >= 100 AND state <> 'placeholder')
SELECT 'coverage' AS rule, doc_id AS page, 'en' AS layer, NULL::BIGINT AS other_page, state AS detail FROM c WHERE state <> 'real'
UNION ALL SELECT 'duplicate-body', doc_id, 'en', first_page, NULL FROM c JOIN g ON h = md5(b) WHERE length(b) >= 200 AND doc_id > first_page
UNION ALL SELECT 'wrong-language', doc_id, 'en', NULL, NULL FROM w WHERE density > 0.05""")
def audit_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dataset audit of documents as the English layer."""
    return checks.dataset_audit(layer_en(spark, sf_dir)).select("rule", "page", "layer", "other_page", "detail")
