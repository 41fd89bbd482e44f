"""Documents as a book of labelled files: what checks, sweeps and repairs say of every page.

Each document is a page. Its source, its English body and its file follow from its text and number by
the expressions below, which both engines evaluate; faults of all kinds come round with the number. The SQL
never parses a file: it knows of what each is made.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import dims, text
from quire.functions.folio import folio
from quire.operators import blocks, checks, duplicates, evidence, relate, repair, sweeps
from quire.plans.audit_plans import ID, SYMBOL_SQL
from quire.plans.registry import query
from quire.plans.relation_plans import docs

STRIP = r"'^\s+|\s+$', '', 'g'"
LETTER = r"[\x{0620}-\x{064A}\x{066E}-\x{06D3}\x{0750}-\x{077F}\x{08A0}-\x{08FF}\x{FB50}-\x{FDFF}\x{FE70}-\x{FEFF}]"
SOURCE = """CASE page % 8 WHEN 0 THEN '---' || chr(10) || 'There is no text on this page.' || chr(10) || '---' WHEN 1 THEN '— ' || page || ' —' || chr(10) || 'بسم الله الرحمن الرحيم'
  WHEN 2 THEN repeat('[?]' || chr(10), 5) || 'نص' WHEN 3 THEN '(' || page || ')' || chr(10) || 'قال الله تعالى ' || repeat('العلم نور ', 30)
  WHEN 4 THEN 'نص ' || repeat('1234567', 4) WHEN 5 THEN '— ' || page || ' —' || chr(10) || 'نص' WHEN 6 THEN 'نص ' || page ELSE repeat('ابجد' || chr(10), 5) || 'ابجد' END"""
BODY = """CASE page % 11 WHEN 0 THEN '[NO VISIBLE TEXT]' WHEN 1 THEN '— ' || page || ' —' || chr(10) || t WHEN 2 THEN '' WHEN 3 THEN t || ' العربيةالطويلةهنا'
  WHEN 4 THEN '— ' || (page + 1) || ' —' || chr(10) || t WHEN 5 THEN t || ' [...] omitted for brevity, see next page' WHEN 6 THEN 'ELEMENT_MESSAGE ' || t
  WHEN 7 THEN t || ' exalted is He 123456789' WHEN 8 THEN repeat('xq', 400) WHEN 9 THEN t || ' ' || repeat('ا ', 100) || '[unclear]' ELSE substr(t, 1, 20) END"""
EMBEDDED = "CASE page % 9 WHEN 2 THEN source || 'x' WHEN 3 THEN 'لا شيء هنا' ELSE source END"
FILE = """CASE page % 9 WHEN 1 THEN body WHEN 0 THEN 'Arabic:' || chr(10) || emb || chr(10) || chr(10) || 'English:' || chr(10) || body || chr(10) || chr(10) || 'Indonesia:' || chr(10) || 'halaman' || chr(10)
  ELSE 'Arabic:' || chr(10) || emb || chr(10) || chr(10) || 'English:' || chr(10) || body || chr(10) END"""
#: page, source, body, emb (null: the file has no labels), formed, target (null: no block), file.
BOOK = rf"""bd AS (SELECT doc_id + 1 AS page, regexp_replace(regexp_replace(text, '\r\n?', chr(10), 'g'), {STRIP}) AS t FROM documents),
bs AS (SELECT page, t, regexp_replace({SOURCE}, {STRIP}) AS source, regexp_replace({BODY}, {STRIP}) AS body FROM bd),
be AS (SELECT *, {EMBEDDED} AS emb FROM bs), bf AS (SELECT *, {FILE} AS file FROM be),
book AS (SELECT page, t, source, body, CASE WHEN page % 9 <> 1 THEN emb END AS emb, page % 9 NOT IN (0, 1) AS formed, CASE WHEN page % 9 <> 1 THEN body END AS target, file FROM bf)"""


def book(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = docs(spark, sf_dir).select((F.col("doc_id") + 1).alias("page"), text.clean(F.col("text")).alias("t"))
    rows = rows.withColumns({"source": text.strip(F.expr(SOURCE)), "body": text.strip(F.expr(BODY))})
    return rows.withColumn("emb", F.expr(EMBEDDED)).withColumn("file", F.expr(FILE))


def parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(files, sources) of the book."""
    rows = book(spark, sf_dir)
    return rows.select("page", F.lit("en").alias("layer"), F.col("file").alias("content")), rows.select("page", F.col("source").alias("body"))


@query(rf"""WITH {BOOK}, r AS (SELECT page, regexp_extract_all(body, '[\x{{0600}}-\x{{06FF}}]+') AS rs FROM book WHERE formed),
m AS (SELECT page, rs, list_max(list_transform(rs, lambda x: length(x))) AS longest, list_sum(list_transform(rs, lambda x: length(x))) AS total FROM r WHERE len(rs) > 0)
SELECT page, 'en' AS layer, CASE WHEN longest >= 4 THEN 'prose' ELSE 'cells' END AS kind, longest::INT AS longest, total::INT AS total, list_filter(rs, lambda x: length(x) = longest)[1] AS sample FROM m""")
def untranslated_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sweeps.untranslated_sweep(*parts(spark, sf_dir))


@query(rf"""WITH {BOOK}, r AS (SELECT page, regexp_extract_all(body, '[\x{{0600}}-\x{{06FF}}]+') AS rs FROM book WHERE formed),
m AS (SELECT page, list_max(list_transform(rs, lambda x: length(x))) AS longest, list_sum(list_transform(rs, lambda x: length(x))) AS total FROM r WHERE len(rs) > 0)
SELECT page, longest::INT AS longest, total::INT AS total, row_number() OVER (ORDER BY longest DESC, total DESC, page)::INT AS place FROM m ORDER BY longest DESC, total DESC, page LIMIT 12""")
def worst_untranslated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sweeps.worst_first(sweeps.untranslated_sweep(*parts(spark, sf_dir))).select("page", "longest", "total", "place")


COUNTS = rf"""c AS (SELECT *, len(regexp_extract_all(source, '[\x{{0600}}-\x{{06FF}}]')) - len(regexp_extract_all(source, '[\x{{0600}}-\x{{061F}}\x{{064B}}-\x{{066D}}\x{{06D4}}\x{{06D6}}-\x{{06E4}}\x{{06E7}}-\x{{06ED}}\x{{06F0}}-\x{{06F9}}\x{{06FD}}\x{{06FE}}]')) AS n,
  len(regexp_extract_all(body, '{LETTER}')) AS n_arabic, coalesce(list_max(list_transform(regexp_extract_all(body, '[\x{{0600}}-\x{{06FF}}]+'), lambda x: length(x))), 0) AS longest FROM book)"""


@query(rf"""WITH {BOOK}, {COUNTS}
SELECT 'embedded-differs' AS rule, page, NULL::DOUBLE AS metric FROM c WHERE formed AND trim(regexp_replace(emb, '\s+', ' ', 'g')) <> trim(regexp_replace(source, '\s+', ' ', 'g'))
UNION ALL SELECT 'arabic-share', page, n_arabic::DOUBLE FROM c WHERE formed AND n_arabic > greatest(4.0, length(body) * 0.005::DOUBLE)
UNION ALL SELECT 'truncation', page, NULL FROM c WHERE formed AND regexp_matches(body, '(?i)\[\.\.\.|truncated\}}|omitted for brevity|remaining pages|\[continue(?:d)? on|see next page')
UNION ALL SELECT 'ratio', page, length(body)::DOUBLE / n FROM c WHERE formed AND n > 200 AND length(body)::DOUBLE / n < 0.25""")
def completeness_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sweeps.completeness(*parts(spark, sf_dir)).select("rule", "page", "metric")


@query(rf"""WITH {BOOK}, {COUNTS}, w AS (SELECT page, length(target) AS n_body, substr(target, i, 12) AS w FROM (SELECT page, target, unnest(range(1, length(target) - 11)) AS i FROM c WHERE length(target) > 500)),
k AS (SELECT page, n_body, w, count(*) AS x FROM w GROUP BY ALL), t AS (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY page ORDER BY x DESC, hex(w) DESC) = 1)
SELECT 'degenerate-repetition' AS rule, page FROM t WHERE 3 * x > n_body AND NOT (contains(w, ' ') AND 2 * len(regexp_extract_all(w, '[A-Za-z ]')) > 12)
UNION ALL SELECT 'label-count', page FROM c WHERE target IS NULL UNION ALL SELECT 'empty-target', page FROM c WHERE coalesce(target, '') = ''
UNION ALL SELECT 'embedded-differs', page FROM c WHERE emb IS NOT NULL AND trim(regexp_replace(emb, '\s+', ' ', 'g')) <> trim(regexp_replace(source, '\s+', ' ', 'g'))
UNION ALL SELECT 'scratchpad', page FROM c WHERE regexp_matches(file, 'ELEMENT_MESSAGE|The result of the|four lingual|\bPuPu|what what|/what\b|assistant<|analysis<|<tool_call>|Here''s a thinking')
UNION ALL SELECT 'untranslated', page FROM c WHERE target IS NOT NULL AND (longest >= 12 OR (n_arabic > greatest(4.0, length(body) * 0.005::DOUBLE) AND longest < 3 AND n_arabic > 60))
UNION ALL SELECT 'truncation', page FROM c WHERE regexp_matches(replace(coalesce(target, ''), '[?]', ''), '(?i)\[\.\.\.|truncated\}}|omitted for brevity')
UNION ALL SELECT 'ratio', page FROM c WHERE n > 200 AND length(coalesce(target, ''))::DOUBLE / n < 0.25""")
def worker_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = book(spark, sf_dir).select("page", F.lit("en").alias("layer"), F.col("file").alias("raw"), "source")
    return checks.worker_output(rows).select("rule", "page")


@query(rf"""WITH {BOOK}, x AS (SELECT *, CASE page % 8 WHEN 2 THEN 'unclear-marker' WHEN 7 THEN 'repeated-glyph' END AS kind FROM book)
SELECT page, kind, CASE page % 8 WHEN 2 THEN 5 ELSE 0 END AS n_unclear, CASE page % 8 WHEN 2 THEN 2 ELSE 24 END AS n_letters,
  CASE WHEN emb IS NULL OR emb <> source THEN 'AR-WRONG' WHEN target = '' THEN 'NO-TRANSLATION'
    WHEN regexp_matches(target, '(?i)unclear|tidak terbaca|tidak dapat dipulihkan|dipertahankan apa|hanya memuat|\[[^\]\n]*(recovered|recoverable|OCR|grid|square|preserve)') THEN 'documented' ELSE 'undocumented' END AS state
FROM x WHERE kind IS NOT NULL""")
def degenerate_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sweeps.degenerate_audit(*parts(spark, sf_dir)).drop("layer")


@query(rf"""WITH {BOOK}, x AS (SELECT *, regexp_extract_all(body, '[0-9\x{{0660}}-\x{{0669}}\x{{06F0}}-\x{{06F9}}]+') AS rs FROM book WHERE formed AND page % 8 = 4),
y AS (SELECT *, coalesce(list_max(list_transform(rs, lambda x: length(x))), 0) AS longest FROM x)
SELECT page, 28 AS source_longest, len(rs)::INT AS n_runs, longest::INT AS longest, CASE WHEN longest >= 14 THEN 'mirrors source' WHEN contains(body, '[UNCLEAR') THEN 'declared unclear' ELSE 'suspect' END AS verdict FROM y""")
def digit_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sweeps.digit_audit(*parts(spark, sf_dir)).drop("layer")


FIRST = r"list_filter(string_split({0}, chr(10)), lambda x: regexp_matches(x, '\S'))[1]"


@query(rf"""WITH {BOOK}, s AS (SELECT *, CASE WHEN NOT formed THEN 'MALFORMED' WHEN length(body) < 40 THEN 'EMPTY' ELSE 'OK' END AS state FROM book)
SELECT page, state, CASE WHEN state = 'OK' THEN length(body)::DOUBLE / greatest(length(source), 1) END AS ratio,
  CASE WHEN state = 'OK' THEN coalesce(nullif(regexp_replace({FIRST.format("source")}, '[^0-9]', '', 'g'), ''), '?') = coalesce(nullif(regexp_replace(coalesce({FIRST.format("body")}, ''), '[^0-9]', '', 'g'), ''), '?') END AS same_folio,
  CASE page % 8 WHEN 1 THEN 2 WHEN 3 THEN 2 ELSE 0 END AS n_terms FROM s""")
def own_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fingerprint counts words of five Arabic letters or more: two in the sources that have any."""
    return sweeps.own_text(*parts(spark, sf_dir)).drop("layer")


@query(rf"""WITH {BOOK}, v AS (SELECT *, CASE WHEN emb IS NULL THEN 'no Arabic block' WHEN emb = source THEN 'ok' WHEN abs(length(emb) - length(source)) > 1 THEN 'escalate' ELSE 'fixed' END AS verdict FROM book)
SELECT page, verdict, (length(emb) - length(source))::INT AS delta, CASE WHEN verdict = 'fixed' THEN md5('Arabic:' || chr(10) || source || chr(10) || chr(10) || 'English:' || chr(10) || body || chr(10)) END AS digest FROM v""")
def restore_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sweeps.restore_sources(*parts(spark, sf_dir)).select("page", "verdict", "delta", F.md5("content").alias("digest"))


BEFORE = "'Arabic:' || chr(10) || source || chr(10) || chr(10) || 'English:' || chr(10) || t || ' ا ب' || chr(10)"
VERSIONS = rf"""v AS (SELECT page, source, t, CASE WHEN target IS NULL THEN -1 ELSE len(regexp_extract_all(body, '{LETTER}')) END AS after, len(regexp_extract_all(t, '{LETTER}')) + 2 AS before FROM book)"""


def versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    rows = book(spark, sf_dir)
    files, sources = parts(spark, sf_dir)
    return rows.select("page", F.lit("en").alias("layer"), F.expr(BEFORE).alias("content")), files, sources


@query(rf"""WITH {BOOK}, {VERSIONS} SELECT page, before::INT AS before, after::INT AS after, CASE WHEN after <= 0 THEN 'now clean' WHEN after > before THEN 'worse' WHEN after < before THEN 'cleaner' ELSE 'unchanged' END AS change FROM v""")
def regression_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sweeps.regressions(*versions(spark, sf_dir)).drop("layer")


@query(rf"""WITH {BOOK}, {VERSIONS} SELECT page, before::INT AS before, after::INT AS after, md5('Arabic:' || chr(10) || source || chr(10) || chr(10) || 'English:' || chr(10) || t || ' ا ب' || chr(10)) AS digest
FROM v WHERE before >= 0 AND after > 0 AND before < after - 3""")
def restore_upstream(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sweeps.restore_upstream(*versions(spark, sf_dir))
    return found.select("page", "before", "after", F.md5("content").alias("digest"))


@query(rf"""WITH {BOOK}, t AS (SELECT DISTINCT page, unnest(regexp_extract_all(lower(t), '[a-zà-öø-ɏ'']+')) AS term FROM book), r AS (SELECT term FROM t GROUP BY 1 HAVING count(*) <= 3),
c AS (SELECT page, count(*) AS n_rare, sum(contains(lower(body), term)::INT)::BIGINT AS n_found FROM t JOIN r USING (term) JOIN book USING (page) GROUP BY 1)
SELECT page, n_found::DOUBLE / n_rare AS coverage FROM c WHERE n_rare >= 4 AND n_found::DOUBLE / n_rare < 0.5""")
def misfiled_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = book(spark, sf_dir).select("page", "t", F.lower("body").alias("low"))
    tokens = F.regexp_extract_all(F.lower("t"), F.lit("[a-zà-öø-ɏ']+"), F.lit(0))
    return sweeps.misfiled(duplicates.rare_coverage(rows, "page", tokens, "low"), "page").select("page", "coverage")


@query(rf"""WITH {BOOK}, g AS (SELECT page, label, k, CASE label WHEN 'Arabic' THEN emb WHEN 'English' THEN body ELSE 'halaman' END AS body FROM book, (VALUES ('Arabic', 0), ('English', 1), ('Indonesia', 2)) v(label, k)
  WHERE emb IS NOT NULL AND (k < 2 OR NOT formed))
SELECT page, k::INT AS place, label, md5(body) AS digest FROM g""")
def parse_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The context-aware parser over every file; what it was rendered from comes out again."""
    rows = book(spark, sf_dir).select("page", F.posexplode(blocks.parse_context(text.clean(F.col("file")))).alias("place", "b"))
    return rows.select("page", "place", F.col("b.label").alias("label"), F.md5("b.body").alias("digest"))


@query(rf"""WITH {BOOK} SELECT page, md5('Arabic:' || chr(10) || source || chr(10) || chr(10) || 'English:' || chr(10) || body || chr(10)) AS digest FROM book""")
def render_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return book(spark, sf_dir).select("page", F.md5(blocks.render(F.col("source"), "English", F.col("body"))).alias("digest"))


@query(rf"""WITH {BOOK} SELECT page, md5(target) AS line, md5(target) AS colon_optional, CASE WHEN target IS NOT NULL THEN md5(CASE WHEN formed THEN body ELSE regexp_replace(body || chr(10) || chr(10) || 'Indonesia:' || chr(10) || 'halaman', {STRIP}) END) END AS first_english,
  CASE WHEN target <> '' THEN md5(target) END AS bare FROM book""")
def section_dialects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The English section of every file as four readers see it."""
    of = lambda d: F.md5(blocks.section(F.col("file"), "English", d)).alias(d)
    return book(spark, sf_dir).select("page", *map(of, ("line", "colon_optional", "first_english", "bare")))


@query(rf"""WITH {BOOK} SELECT page, regexp_matches(source, '(?i)^---\s*\nthere is no text on this page\.\s*\n---$') AS blank_source, body = '[NO VISIBLE TEXT]' AS marker, regexp_matches(body, '(?i)\[combined output[^\]]*\]') AS artifact,
  regexp_matches(body, '(?i)unclear|tidak terbaca|tidak dapat dipulihkan|dipertahankan apa|hanya memuat|\[[^\]\n]*(recovered|recoverable|OCR|grid|square|preserve)') AS damage, contains(body, 'exalted is He') AS banned,
  length(regexp_replace(source, {STRIP})) <= 200 AND regexp_matches(source, '(?i)no (visible )?(arabic )?text|does not contain any|tidak ada teks|tidak mengandung teks') AS blank_note FROM book""")
def page_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    b, s = F.col("body"), F.col("source")
    return book(spark, sf_dir).select(
        "page", text.is_blank_source(s).alias("blank_source"), text.is_blank_marker(b, "en").alias("marker"), b.rlike(text.COMBINED_INLINE).alias("artifact"), sweeps.documents_damage(b).alias("damage"),
        b.contains(text.BANNED_HONORIFIC).alias("banned"), ((F.length(text.clean(s)) <= 200) & s.rlike(text.BLANK_NOTE)).alias("blank_note"),
    )


@query(rf"""WITH {BOOK} SELECT page, '[NO VISIBLE TEXT]' AS marker FROM book WHERE page % 8 = 0 AND body <> '[NO VISIBLE TEXT]'""")
def blank_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blank pages whose body is not their exact marker."""
    return repair.blank_plan(book(spark, sf_dir).select("page", F.lit("en").alias("layer"), "source", "body")).drop("layer")


@query(rf"""WITH {BOOK}, x AS (SELECT page, trim(regexp_replace(emb, '\s+', ' ', 'g')) AS a, trim(regexp_replace(source, '\s+', ' ', 'g')) AS b FROM book WHERE emb IS NOT NULL)
SELECT page, CASE WHEN a = b THEN 'same' WHEN length(b) - length(a) >= 200 AND starts_with(b, a) THEN 'truncated' WHEN abs(length(a) - length(b)) <= 1 THEN 'fixable' ELSE 'escalate' END AS drift,
  (len(regexp_extract_all(a, '\x{{10348}}')) - len(regexp_extract_all(b, '\x{{10348}}')))::INT AS filler FROM x""")
def source_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = book(spark, sf_dir).filter("page % 9 <> 1")
    return rows.select("page", repair.source_drift(F.col("emb"), F.col("source")).alias("drift"), repair.filler_drift(F.col("emb"), F.col("source")).alias("filler"))


LIKE = rf"""(length(@b) >= 25 AND coalesce(len(regexp_extract_all(@b, '{LETTER}'))::DOUBLE / nullif(length(@b), 0), 0) <= 0.15 AND len(regexp_extract_all(@b, '[A-Za-z][A-Za-z''’-]*')) >= 4
  AND len(regexp_extract_all(@b, '{SYMBOL_SQL}'))::DOUBLE / nullif(len(regexp_extract_all(@b, '\S')), 0) <= 0.25
  AND coalesce(len(list_filter(regexp_extract_all(lower(@b), '[A-Za-z][A-Za-z''’-]*'), lambda t: t IN ({ID})))::DOUBLE / nullif(len(regexp_extract_all(lower(@b), '[A-Za-z][A-Za-z''’-]*')), 0), 0) <= 0.02 OR @b = '[NO VISIBLE TEXT]')"""
TIDY = rf"regexp_replace(regexp_replace(@b, '\n{{3,}}', chr(10) || chr(10), 'g'), {STRIP})"


@query(rf"""WITH {BOOK}, x AS (SELECT *, {TIDY.replace("@b", "t")} AS d FROM book)
SELECT page, CASE WHEN d = '' THEN 'empty draft' WHEN NOT {LIKE.replace("@b", "d")} THEN 'not a translation' END AS problem,
  CASE WHEN d <> '' AND {LIKE.replace("@b", "d")} THEN md5('Arabic:' || chr(10) || source || chr(10) || chr(10) || 'English:' || chr(10) || d || chr(10)) END AS digest FROM x""")
def assemble_drafts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A two-block file from each body-only draft, or why it is refused."""
    made = book(spark, sf_dir).select("page", repair.assemble(F.col("t"), F.col("source"), "en").alias("a"))
    return made.select("page", F.col("a.problem").alias("problem"), F.md5("a.content").alias("digest"))


NUMBER = r"CASE WHEN regexp_matches(@f, '[-—(]') THEN nullif(regexp_extract(@f, '[0-9]{1,3}'), '')::INT::VARCHAR END"


@query(rf"""WITH {BOOK}, f AS (SELECT page, {FIRST.format("source")} AS sf, {FIRST.format("body")} AS bf FROM book), n AS (SELECT page, {NUMBER.replace("@f", "sf")} AS want, {NUMBER.replace("@f", "bf")} AS got FROM f)
SELECT page, want, got, CASE WHEN want IS NULL THEN 'no-source' WHEN got IS NULL THEN 'no-folio' WHEN want = got THEN 'aligned' WHEN abs(want::INT - got::INT) = 1 THEN 'off-by-one' ELSE 'wrong page' END AS verdict FROM n""")
def folio_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = book(spark, sf_dir)
    return checks.folio_alignment(rows.select("page", F.lit("en").alias("layer"), "body"), rows.select("page", F.col("source").alias("body"))).drop("layer")


ERRORS = r"""list_filter([CASE WHEN page % 5 = 0 THEN 'dataset has 0 records' END, CASE WHEN page % 5 <> 0 AND page % 7 = 0 THEN 'dataset ar differs from source' END,
  CASE WHEN labels IS NULL THEN 'en: missing required labels: Arabic, English' END, CASE WHEN NOT formed AND labels IS NOT NULL THEN 'en: unexpected labels: Indonesia' END,
  CASE WHEN emb <> source THEN 'en: embedded Arabic differs from canonical source' END, CASE WHEN target = '' THEN 'en: English block is empty' END,
  CASE WHEN page % 8 = 0 AND target <> '[NO VISIBLE TEXT]' THEN 'en: blank source requires its exact marker' END,
  CASE WHEN page % 5 <> 0 AND target <> body || CASE WHEN page % 13 = 0 THEN '!' ELSE '' END THEN 'en: dataset differs from file' END, 'id: file missing'], lambda x: x IS NOT NULL)"""


def reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validator reports of the book against records of which some are missing or differ."""
    files, sources = parts(spark, sf_dir)
    ar = F.when(F.col("page") % 7 == 0, "other").otherwise(F.col("source"))
    en = F.concat("body", F.when(F.col("page") % 13 == 0, "!").otherwise(""))
    records = book(spark, sf_dir).filter("page % 5 <> 0").select("page", F.struct(ar.alias("ar"), en.alias("en"), F.lit(None).cast("string").alias("id")).alias("text"))
    return checks.validate(files, sources, records)


@query(rf"""WITH {BOOK}, l AS (SELECT *, CASE WHEN target IS NOT NULL THEN true END AS labels FROM book), e AS (SELECT *, {ERRORS} AS errors FROM l)
SELECT page, len(errors) = 0 AS ok, page % 8 = 0 AS blank_source, target IS NOT NULL AS english_block, page % 5 <> 0 AS record_found, array_to_string(errors, '; ') AS errors FROM e""")
def validate_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports(spark, sf_dir).select("page", "ok", "blank_source", "english_block", "record_found", F.array_join("errors", "; ").alias("errors"))


@query("SELECT count(*) AS pages, 0::BIGINT AS passed, count(*) AS failed FROM documents")
def sweep_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No page of the book has an Indonesian file, so none passes."""
    return checks.sweep_totals(reports(spark, sf_dir))


@query(rf"""WITH {BOOK}, x AS (SELECT page, emb, target, formed, emb IS NOT NULL AS labelled FROM book)
SELECT page, CASE WHEN NOT labelled OR NOT formed THEN 'expected exactly Arabic and English blocks in order' WHEN emb = '' OR target = '' THEN 'bodies must not be empty' END AS problem,
  CASE WHEN formed THEN md5('Arabic:' || chr(10) || emb || chr(10) || chr(10)) END AS prefix FROM x""")
def target_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bytes before each file's second heading, and what is wrong with the file."""
    rows = book(spark, sf_dir).select("page", evidence.target_parts(F.col("file")).alias("p"))
    return rows.select("page", F.col("p.problem").alias("problem"), F.when(F.col("page") % 9 > 1, F.md5("p.prefix")).alias("prefix"))


@query(rf"""WITH {BOOK}, f AS (SELECT page, string_split(regexp_replace(source, {STRIP}), chr(10)) AS sl FROM book)
SELECT page, page % 9 = 0 AS has_foreign, page % 9 = 0 AND true AS safe FROM book WHERE page % 9 = 0""")
def strip_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with a label that is not theirs; its body is no translation, so dropping it loses nothing."""
    found = repair.strip_labels(parts(spark, sf_dir)[0])
    return found.select("page", (F.size("foreign") > 0).alias("has_foreign"), "safe")


@query(rf"""WITH {BOOK} SELECT page, length(body)::INT AS own_chars, 0 AS n_stray FROM book WHERE page % 9 = 0 AND body <> ''""")
def stray_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that are not canonical, with what they hold."""
    return repair.stray_bodies(parts(spark, sf_dir)[0]).select("page", "own_chars", F.size("stray").alias("n_stray"))


@query(rf"""WITH {BOOK} SELECT page, replace(right(t, 38), chr(10), ' ') || '. God Most High above all' AS context FROM book WHERE NOT contains(t, 'God Most High')""")
def verb_contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = book(spark, sf_dir).filter("not contains(t, 'God Most High')").select("page", F.concat("t", F.lit(". God Most High above all")).alias("b"))
    return repair.verb_contexts(rows, "b")


@query("SELECT layer, page::BIGINT AS page, title FROM (VALUES " + ", ".join(f"('{g}', {p})" for g, p in dims.CANDIDATES) + ") c(layer, page) LEFT JOIN (VALUES " + ", ".join(f"({p}, '{t['en']}')" for p, t in dims.TAIL_TITLES.items()) + ") t(tail, title) ON tail = page")
def candidate_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Static dimensions: pages classified one by one, with titles of the last pages."""
    titles = dims.tail_titles(spark).select(F.col("page").alias("tail"), F.col("title.en").alias("title"))
    return dims.candidates(spark).join(F.broadcast(titles), F.col("page") == F.col("tail"), "left").select("layer", "page", "title")  # four rows


@query(rf"""WITH {BOOK} SELECT page, CASE WHEN page % 4 = 0 THEN 'patched ' || page ELSE left(body, 9) END AS title FROM book""")
def title_patch(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = book(spark, sf_dir).select("page", F.substring("body", 1, 9).alias("title"))
    titles = rows.filter("page % 4 = 0").select("page", F.concat(F.lit("patched "), F.col("page").cast("string")).alias("title"))
    return repair.title_patch(rows, titles)


@query(rf"""WITH {BOOK}, c AS (SELECT page, page % 6 AS want, (page + CASE WHEN page % 10 = 0 THEN 1 WHEN page % 10 = 1 AND page % 6 > 0 THEN -1 ELSE 0 END) % 6 AS got FROM book)
SELECT page, want::INT AS want, got::INT AS got, CASE WHEN got = want THEN 'OK' WHEN got > want THEN 'DOUBLED' ELSE 'TRUNCATED' END AS verdict FROM c""")
def cell_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grid cells of a body against those of its source."""
    page = F.col("page")
    off = F.when(page % 10 == 0, 1).when((page % 10 == 1) & (page % 6 > 0), -1).otherwise(0)
    rows = book(spark, sf_dir).select("page", F.concat("t", F.repeat(F.lit("\n[?]"), (page % 6).cast("int"))).alias("s"), F.concat("t", F.repeat(F.lit("\n[cell]"), ((page + off) % 6).cast("int"))).alias("b"))
    return rows.select("page", repair.cell_plan(F.col("s"), F.col("b"), "[?]", "[cell]").alias("c")).select("page", "c.want", "c.got", "c.verdict")


@query(rf"""WITH {BOOK}, x AS (SELECT page, regexp_replace(t, '(?i)(^|[.\n;]\s*|\band\s*)God Most High', 'z', 'g') AS u, t || '. God Most High above all' AS v FROM book)
SELECT page, md5(t || '. He is exalted above all') AS digest FROM book""")
def verb_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = book(spark, sf_dir).select("page", F.concat("t", F.lit(". God Most High above all")).alias("b"))
    return rows.select("page", F.md5(repair.verb_frame(F.col("b"))).alias("digest"))


def layered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs(spark, sf_dir).select((F.col("doc_id") + 1).alias("page"), F.lit("en").alias("layer"), F.col("text").alias("body"))


@query(rf"""WITH k AS (SELECT doc_id + 1 AS page, md5(trim(regexp_replace(text, '\s+', ' ', 'g'))) AS digest FROM documents WHERE length(text) >= 60), g AS (SELECT digest, min(page) AS other_page FROM k GROUP BY 1)
SELECT 'exact-duplicate' AS rule, page, other_page FROM k JOIN g USING (digest) WHERE page > other_page
UNION ALL SELECT 'folio-mismatch', page, NULL FROM (SELECT doc_id + 1 AS page, {NUMBER.replace("@f", FIRST.format("text"))} AS got FROM documents WHERE length(text) >= 60) WHERE got <> (page % 1000)::VARCHAR""")
def copy_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies of earlier pages and numbers off the source's; near copies are near_duplicates' own query."""
    sources = docs(spark, sf_dir).select((F.col("doc_id") + 1).alias("page"), F.concat(F.lit("— "), ((F.col("doc_id") + 1) % 1000).cast("string"), F.lit(" —")).alias("body"))
    found = checks.copy_forward(layered(spark, sf_dir), sources).filter("rule <> 'near-duplicate'")
    return found.select("rule", "page", "other_page")


@query(rf"""WITH {BOOK}, h AS (SELECT page, CASE WHEN page % 6 = 0 THEN page + 1 WHEN page % 6 = 2 THEN page + 1 ELSE page END AS says FROM book), p AS (SELECT page, says AS to_page FROM h JOIN (SELECT page AS s FROM book) ON says = s WHERE says <> page),
c AS (SELECT to_page, count(*) > 1 AS collides FROM p GROUP BY 1)
SELECT page, to_page, collides, to_page NOT IN (SELECT page FROM p) AS overwrites FROM p JOIN c USING (to_page)""")
def rename_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each target's printed header says that it belongs."""
    rows = book(spark, sf_dir).select("page", F.concat(F.lit("— "), (F.col("page") + (F.col("page") % 6).isin(0, 2).cast("int")).cast("string"), F.lit(" —\n"), "t").alias("body"), F.concat(F.lit("— "), F.col("page").cast("string"), F.lit(" —")).alias("s"))
    header = lambda c: folio(F.col(c), "dashed_line").alias("header")
    return duplicates.header_plan(rows.select("page", header("body")), rows.select("page", header("s")))


@query(rf"""WITH {BOOK} SELECT page, 'English' AS waived_label, page % 3 = 0 AS waived FROM book WHERE contains(body, 'exalted is He')""")
def waived_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Style findings on pages with a matching override are waived."""
    rows = book(spark, sf_dir).select("page", F.lit("en").alias("layer"), "body")
    found = checks.finding(rows, "banned-honorific", F.col("body").contains(text.BANNED_HONORIFIC))
    return evidence.waive(found, rows.filter("page % 3 = 0")).select("page", F.lit("English").alias("waived_label"), "waived")


@query("""SELECT d.doc_id AS page, l.doc_id IS NULL AS waits FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id AND l.quality = 1""")
def waiting_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    every = docs(spark, sf_dir).select(F.col("doc_id").alias("page"))
    done = spark.read.parquet(f"{sf_dir}/labels.parquet").filter("quality = 1").select(F.col("doc_id").alias("page"))
    waits = relate.pending(every, done, "page").withColumn("waits", F.lit(True))
    return waits.union(relate.among(every, done, "page").withColumn("waits", F.lit(False)))
