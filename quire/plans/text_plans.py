"""Parsing, layout, scalar functions and folios as queries."""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import chars, entities, text
from quire.functions.folio import folio
from quire.operators import blocks, layout, relate, repair
from quire.plans.registry import query, values
from quire.plans.relation_plans import docs
from quire.sources.scan import table

ROLES = ("system", "user", "assistant")
STRIP = r"'^\s+|\s+$', '', 'g'"
#: White space of Unicode beyond ASCII, for DuckDB's patterns.
WIDE = r"\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
LINES = r"""l AS (SELECT doc_id, i - 1 AS line_no, trim(ls[i], chr(32) || chr(9) || chr(13) || chr(11) || chr(12)) AS line
  FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM (SELECT doc_id, string_split(regexp_replace(regexp_replace(text, '\r\n?', chr(10), 'g'), '^\s+|\s+$', '', 'g'), chr(10)) AS ls FROM documents)))"""
KIND = r"""CASE WHEN line = '' THEN 'blank' WHEN regexp_matches(line, '^[—\-–]\s*[0-9]+\s*[—\-–]$') THEN 'page_number' WHEN regexp_matches(line, '^[❖※⁂]') THEN 'ornament_heading'
  WHEN regexp_matches(line, '^[(（]\s*(?:Section|Chapter|الفصل|الباب|The\s)') THEN 'section_heading' WHEN regexp_matches(line, '^[0-9]{1,3}$') THEN 'short_num'
  WHEN regexp_matches(line, '[☩۞۩○●□■▢∆▲▽▼]') AND length(line) > 5 THEN 'grid' WHEN regexp_matches(line, '^[0-9\s]{8,}$') AND length(line) > 10 THEN 'grid'
  WHEN len(regexp_extract_all(line, '\S+')) <= 3 THEN 'short_line' ELSE 'prose' END"""


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(conv_id, content): each conversation as a file of labelled blocks."""
    rows = table(spark, sf_dir, "conversations").withColumn("block", F.concat(F.col("role"), F.lit(":\n"), "text", F.lit("\n\n")))
    return relate.ordered_text(rows, ["conv_id"], "turn", "block", "", "content")


@query(rf"""SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn)::INT - 1 AS place, role AS label, md5(regexp_replace(text, {STRIP})) AS digest FROM conversations""")
def parse_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rendered to labelled text and parsed back: every turn comes out again."""
    parsed = labelled(spark, sf_dir).select("conv_id", F.posexplode(blocks.parse_lines(F.col("content"), ROLES)).alias("place", "b"))
    return parsed.select("conv_id", "place", F.col("b.label").alias("label"), F.md5("b.body").alias("digest"))


@query("""SELECT conv_id, array_to_string(list_sort(list(role)), ',') AS repeated FROM (SELECT conv_id, role FROM conversations GROUP BY 1, 2 HAVING count(*) > 1) GROUP BY 1""")
def duplicate_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = labelled(spark, sf_dir).select("conv_id", F.array_join(blocks.duplicate_labels(blocks.parse_lines(F.col("content"), ROLES)), ",").alias("repeated"))
    return found.filter("repeated <> ''")


@query(rf"""WITH f AS (SELECT conv_id, role, arg_min(text, turn) AS body FROM conversations GROUP BY 1, 2)
SELECT conv_id, role AS label, length(regexp_replace(body, {STRIP})) AS n_chars FROM f""")
def first_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = labelled(spark, sf_dir).select("conv_id", F.explode(blocks.first_blocks(blocks.parse_lines(F.col("content"), ROLES))).alias("b"))
    return rows.select("conv_id", F.col("b.label").alias("label"), F.length("b.body").cast("long").alias("n_chars"))


@query(rf"SELECT conv_id, count(*)::INT AS n_blocks, sum(length(regexp_replace(text, {STRIP})))::BIGINT AS n_chars FROM conversations GROUP BY 1")
def block_count_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    bs = blocks.parse_lines(F.col("content"), ROLES)
    return labelled(spark, sf_dir).select("conv_id", F.size(bs).alias("n_blocks"), F.aggregate(bs, F.lit(0).cast("long"), lambda a, b: a + F.length(b["body"])).alias("n_chars"))


@query(r"""WITH p AS (SELECT doc_id, doc_id // 3 AS batch, regexp_replace(regexp_replace(text, '\r\n?', chr(10), 'g'), '^\s+|\s+$', '', 'g') AS t FROM documents),
q AS (SELECT batch, doc_id, '--- PAGE ' || doc_id || ' ---' || chr(10) || CASE WHEN t = '' THEN '[empty page]' WHEN length(t) > 5000 THEN substr(t, 1, 5000) || chr(10) || '[truncated]' ELSE t END AS s FROM p)
SELECT batch, count(*) AS n, md5(string_agg(s, chr(10) || chr(10) ORDER BY doc_id)) AS digest FROM q GROUP BY 1""")
def batch_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three pages a call; ids are dense, so the batch follows from the id and needs no numbering."""
    body = F.concat(F.lit("--- PAGE "), F.col("doc_id").cast("string"), F.lit(" ---\n"), blocks.packed(F.col("text"), 3))
    rows = docs(spark, sf_dir).select("doc_id", F.floor(F.col("doc_id") / 3).alias("batch"), body.alias("s"))
    one = relate.ordered_text(rows, ["batch"], "doc_id", "s", "\n\n", "content")
    return rows.groupBy("batch").agg(F.count(F.lit(1)).alias("n")).join(one, "batch").select("batch", "n", F.md5("content").alias("digest"))


@query(r"SELECT doc_id, md5(trim(regexp_replace(text, '\s+', ' ', 'g'))) AS digest FROM documents")
def clean_fold_md5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs(spark, sf_dir).select("doc_id", F.md5(text.fold_space(F.col("text"))).alias("digest"))


@query(rf"""SELECT doc_id, round(len(regexp_extract_all(text, '[\x{{0620}}-\x{{064A}}\x{{066E}}-\x{{06D3}}\x{{0750}}-\x{{077F}}\x{{08A0}}-\x{{08FF}}\x{{FB50}}-\x{{FDFF}}\x{{FE70}}-\x{{FEFF}}]'))::DOUBLE / nullif(length(text), 0), 9) AS arabic_ratio,
  len(regexp_extract_all(text, '[A-Za-z][A-Za-z''’-]*'))::INT AS prose_score,
  len(regexp_extract_all(text, '[^\x00-\x7F\x{{0620}}-\x{{064A}}\x{{066E}}-\x{{06D3}}\x{{0750}}-\x{{077F}}\x{{08A0}}-\x{{08FF}}\x{{FB50}}-\x{{FDFF}}\x{{FE70}}-\x{{FEFF}}{WIDE}\p{{Nd}}—–]'))::INT AS n_symbols
FROM documents""")
def prose_symbol_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("text")
    # Scaled and rounded as in SQL; Spark's round(x, 9) goes by decimal digits, which differs where the tenth place is a last 5. A text without characters has no ratio.
    ratio = F.when(F.length(t) > 0, F.round(chars.arabic_ratio(t) * 1e9) / 1e9)
    return docs(spark, sf_dir).select("doc_id", ratio.alias("arabic_ratio"), chars.prose_score(t).alias("prose_score"), chars.symbol_count(t).alias("n_symbols"))


@query(r"""SELECT doc_id, len(rs)::INT AS n_runs, coalesce(list_max(list_transform(rs, lambda x: length(x))), 0)::INT AS longest, coalesce(list_sum(list_transform(rs, lambda x: length(x))), 0)::INT AS n_digits
FROM (SELECT doc_id, regexp_extract_all(text, '[0-9\x{0660}-\x{0669}\x{06F0}-\x{06F9}]+') AS rs FROM documents)""")
def digit_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = docs(spark, sf_dir).select("doc_id", chars.runs(F.col("text"), chars.DIGITS).alias("rs"))
    return found.select("doc_id", F.size("rs").alias("n_runs"), chars.longest(F.col("rs")).alias("longest"), chars.total(F.col("rs")).alias("n_digits"))


@query(r"""WITH b AS (SELECT doc_id, text, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '\S'))[1] AS f,
    list_filter(list_transform(string_split(regexp_replace(text, '^\s+|\s+$', '', 'g'), chr(10))[1:3], lambda x: regexp_replace(x, '[^0-9]', '', 'g')), lambda x: x <> '') AS top,
    list_filter(list_transform(string_split(text, chr(10)), lambda x: regexp_extract(x, '^\s*—\s*([0-9]+)\s*—\s*$', 1)), lambda x: x <> '') AS dashed FROM documents),
n AS (SELECT *, nullif(regexp_extract(f, '[0-9]{1,3}'), '')::INT::VARCHAR AS num FROM b)
SELECT doc_id, num AS first_number, CASE WHEN regexp_matches(f, '[-—(]') THEN num END AS marked_line, top[1] AS top_three,
  coalesce(nullif(regexp_replace(coalesce(f, ''), '[^0-9]', '', 'g'), ''), '?') AS digits_only, dashed[1] AS dashed_line,
  CASE WHEN doc_id > 7 AND regexp_matches(regexp_replace(f, '^\s+|\s+$', '', 'g'), '^(?:[—–-]\s*[0-9]+\s*[—–-]|\(\s*[0-9]+\s*\))$') THEN regexp_extract(f, '[0-9]+') END AS late_page,
  coalesce(nullif(regexp_extract(regexp_replace(f, '^\s+|\s+$', '', 'g'), '^[—–(\[-]\s*([0-9]+)\s*[—–)\]-]$', 1), ''), nullif(regexp_extract(regexp_replace(f, '^\s+|\s+$', '', 'g'), '^([0-9]{1,3})$', 1), ''),
    nullif(regexp_extract(regexp_replace(f, '^\s+|\s+$', '', 'g'), '^([0-9]{1,3})\s*[.)—–:-]', 1), '')) AS reader FROM n""")
def leading_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The printed number of each document by all seven definitions."""
    names = ("first_number", "marked_line", "top_three", "digits_only", "dashed_line", "late_page", "reader")
    return docs(spark, sf_dir).select("doc_id", *[folio(F.col("text"), d, F.col("doc_id")).alias(d) for d in names])


@query(f"WITH {LINES} SELECT doc_id, {KIND} AS kind, count(*) AS n FROM l GROUP BY 1, 2")
def line_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.lines(docs(spark, sf_dir), "doc_id", "text").groupBy("doc_id", "kind").agg(F.count(F.lit(1)).alias("n"))


@query(rf"""WITH {LINES}, k AS (SELECT *, {KIND} AS kind FROM l),
s AS (SELECT doc_id, line_no, line, CASE WHEN kind IN ('prose', 'short_line') THEN 'prose' ELSE kind END AS shape FROM k WHERE kind <> 'short_num'),
w AS (SELECT *, lag(shape) OVER o AS was, lag(line) OVER o AS above FROM s WINDOW o AS (PARTITION BY doc_id ORDER BY line_no)),
i AS (SELECT *, sum(CASE WHEN was IS NULL OR was <> shape OR shape IN ('section_heading', 'ornament_heading')
    OR (shape = 'prose' AND regexp_matches(above, '[.!?:،؛]\s*$') AND len(regexp_extract_all(above, '\S+')) > 4) THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY line_no) AS island FROM w),
p AS (SELECT doc_id, island, shape AS kind, string_agg(line, ' ' ORDER BY line_no) AS body FROM i WHERE shape NOT IN ('blank', 'page_number') GROUP BY 1, 2, 3)
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY island)::INT AS paragraph, kind, md5(body) AS digest FROM p""")
def paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = layout.page_paragraphs(docs(spark, sf_dir), "doc_id", "text")
    return rows.select("doc_id", "paragraph", "kind", F.md5("body").alias("digest"))


@query(rf"""WITH {LINES}, t AS (SELECT *, regexp_matches(line, '\|.*\|') AND NOT starts_with(line, '[Letter-string:') AS is_table, line = '' AS blank FROM l),
w AS (SELECT *, lag(blank) OVER o AS wb, lag(is_table) OVER o AS wt FROM t WINDOW o AS (PARTITION BY doc_id ORDER BY line_no)),
i AS (SELECT *, sum(CASE WHEN wb IS NULL OR wb <> blank OR wt <> is_table THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY line_no) AS island FROM w)
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY island)::INT AS segment, is_table, count(*) AS n_lines FROM i WHERE NOT blank GROUP BY doc_id, island, is_table""")
def run_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.segments(docs(spark, sf_dir), "doc_id", "text")


@query(rf"""WITH {LINES}, r AS (SELECT doc_id, line_no, list_transform(string_split(regexp_replace(line, '^\||\|$', '', 'g'), '|'), lambda x: regexp_replace(x, {STRIP})) AS cells FROM l
  WHERE regexp_matches(line, '\|.*\|') AND NOT regexp_matches(line, '^\s*\|?[\s:|-]*-[\s:|-]*\|?\s*$'))
SELECT doc_id, count(*)::INT AS n_rows, max(len(cells))::INT AS n_columns, sum(len(list_filter(cells, lambda x: x <> '')))::INT AS n_filled FROM r GROUP BY 1""")
def table_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, columns and filled cells of the pipe-table lines of each document."""
    rows = docs(spark, sf_dir).select("doc_id", layout.table_rows(F.array_join(F.transform(F.split(text.clean(F.col("text")), "\n", -1), text.strip), "\n")).alias("rows")).filter(F.size("rows") > 0)
    filled = F.size(F.filter(F.flatten("rows"), lambda c: c != ""))
    return rows.select("doc_id", F.size("rows").alias("n_rows"), F.size(F.get("rows", F.lit(0))).alias("n_columns"), filled.alias("n_filled"))


TO_TEXT = r"""replace(replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(html, '(?i)</?(?:span|strong|em|b|i|a|u|code)(?:\s[^>]*)?>', '', 'g'), '<[^>]*>', ' ', 'g'),
  '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#x27;', ''''), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&')"""


@query(rf"SELECT page_id, len(ws)::INT AS n_tokens, md5(array_to_string(ws, ' ')) AS digest FROM (SELECT page_id, regexp_extract_all({TO_TEXT}, '[^\x20\x09-\x0D]+') AS ws FROM pages)")
def html_text_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = F.regexp_extract_all(text.html_to_text(F.col("html")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    return table(spark, sf_dir, "pages").select("page_id", ws.alias("ws")).select("page_id", F.size("ws").alias("n_tokens"), F.md5(F.array_join("ws", " ")).alias("digest"))


@query("SELECT page_id, md5(replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')) AS digest FROM pages")
def html_escape_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", F.md5(text.html_escape(F.col("html"))).alias("digest"))


@query(rf"""SELECT page_id, len(b.ws)::INT AS n_tokens, (SELECT min(i) FROM range(greatest(len(a.ws), len(b.ws))) r(i) WHERE a.ws[i + 1] IS DISTINCT FROM b.ws[i + 1])::INT AS first_difference
FROM (SELECT page_id, regexp_extract_all({TO_TEXT}, '[^\x20\x09-\x0D]+') AS ws FROM pages) b JOIN (SELECT page_id, regexp_extract_all(regexp_replace(html, '<[^>]*>', ' ', 'g'), '[^\x20\x09-\x0D]+') AS ws FROM pages) a USING (page_id)""")
def token_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where reading inline tags and entities first changes a page's tokens."""
    ws = lambda c: F.regexp_extract_all(c, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    rows = table(spark, sf_dir, "pages").select("page_id", ws(text.html_to_text(F.col("html"))).alias("b"), ws(F.regexp_replace("html", "<[^>]*>", " ")).alias("a"))
    return rows.select("page_id", F.size("b").alias("n_tokens"), layout.first_difference(F.col("a"), F.col("b")).cast("int").alias("first_difference"))


@query(r"""SELECT doc_id, 'page_' || CASE WHEN doc_id < 1000 THEN lpad(doc_id::VARCHAR, 3, '0') ELSE doc_id::VARCHAR END || '.txt' AS name, greatest(1, least(604, doc_id))::BIGINT AS clamped,
  ((doc_id % 7 + 7) % 7)::BIGINT AS cyclic, round(n_chars / 1024.0::DOUBLE, 6) AS kib, least(pow(2, doc_id % 8) * 3, 60)::DOUBLE AS delay,
  regexp_replace(regexp_replace('( ' || lang || ' )', '^[(（]\s*|\s*[)）]$', '', 'g'), '^\s+|\s+$', '', 'g') AS title, [doc_id, doc_id + 1, doc_id + 2, doc_id + 9] AS pages,
  CASE WHEN starts_with(lang, 'e') THEN 'europe;' ELSE lang || ';' END AS canonical, substr(text, 11, 5) AS match, length(text) - 15 AS n_after
FROM documents WHERE length(text) > 15""")
def scalar_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names, clamping, cycles, delays, titles, page lists, canonical tokens and highlights."""
    d, i = docs(spark, sf_dir).filter(F.length("text") > 15), F.col("doc_id")
    ranges = F.concat(i.cast("string"), F.lit("-"), (i + 2).cast("string"), F.lit(", "), (i + 9).cast("string"))
    lit = text.highlight(F.col("text"), F.lit(10), F.lit(5))
    return d.select(
        "doc_id", text.page_name(i).alias("name"), F.greatest(F.lit(1), F.least(F.lit(604), i)).cast("long").alias("clamped"), F.pmod(i, F.lit(7)).alias("cyclic"),
        F.round(F.col("n_chars") / 1024.0, 6).alias("kib"), text.backoff_seconds(i % 8).alias("delay"), text.section_title(F.concat(F.lit("( "), "lang", F.lit(" )"))).alias("title"),
        text.page_list(ranges).cast("array<bigint>").alias("pages"), text.canonical_tokens(F.concat("lang", F.lit(";")), {"e": "europe"}).alias("canonical"), lit["match"].alias("match"),
        F.length(lit["after"]).cast("long").alias("n_after"),
    )


@query("""WITH c AS (SELECT conv_id, arg_min(text, turn) FILTER (role = 'user') AS a, arg_min(text, turn) FILTER (role = 'assistant') AS b FROM conversations GROUP BY 1),
n AS (SELECT conv_id, len(regexp_extract_all(a, '[\\x{0620}-\\x{064A}\\x{066E}-\\x{06D3}]')) AS x, len(regexp_extract_all(b, '[\\x{0620}-\\x{064A}\\x{066E}-\\x{06D3}]')) AS y FROM c WHERE a IS NOT NULL AND b IS NOT NULL)
SELECT conv_id, CASE WHEN x = 0 AND y > 0 THEN 'id' ELSE 'en' END AS winner FROM n""")
def choose_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = lambda role: F.min_by(F.when(F.col("role") == role, F.col("text")), F.when(F.col("role") == role, F.col("turn")))
    rows = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(first("user").alias("a"), first("assistant").alias("b")).filter("a is not null and b is not null")
    return rows.select("conv_id", repair.choose(F.col("a"), F.col("b"))["winner"].alias("winner"))


NAMES = values(sorted(html5.items()), "name, letters")
OLD_PAGE = values([(b, bytes([b]).decode("cp1252", "ignore") or chr(b)) for b in range(0x80, 0xA0)], "code, letter")
#: Each page ends with references of its own: numbers, names with and without a semicolon, and some that are none.
REFERRED = """html || '&#' || (page_id * 37) || ';&#x' || (page_id % 10) || '3;&eacute;&notit;&ampx &nosuch; &; &#;' || chr(10) || '&NotEqualTilde;' || page_id"""


@query(rf"""WITH t AS (SELECT page_id, unnest(ts) AS token, generate_subscripts(ts, 1) AS i FROM (SELECT page_id, regexp_extract_all({REFERRED}, '&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{{1,32}};?)|[^&]+|&') AS ts FROM pages)),
n AS (SELECT *, CASE WHEN regexp_matches(token, '^&#[0-9]') THEN CAST(regexp_extract(token, '[0-9]+') AS BIGINT) WHEN regexp_matches(token, '^&#[xX]') THEN CAST('0x' || regexp_extract(token, '[xX]([0-9a-fA-F]+)', 1) AS BIGINT) END AS code FROM t),
e AS (SELECT name, letters FROM {NAMES}), o AS (SELECT code AS old, letter FROM {OLD_PAGE}),
heads AS (SELECT token, max_by(letters || substr(token, length(name) + 2), length(name)) AS read FROM (SELECT DISTINCT token FROM t WHERE token LIKE '&%') JOIN e ON NOT contains(name, ';') AND starts_with(substr(token, 2), name) GROUP BY 1)
SELECT page_id, md5(string_agg(CASE WHEN code IS NOT NULL THEN CASE WHEN letter IS NOT NULL THEN letter WHEN code = 0 OR code BETWEEN 55296 AND 57343 OR code > 1114111 THEN chr(65533) WHEN code = 13 THEN chr(13)
    WHEN code BETWEEN 1 AND 8 OR code = 11 OR code BETWEEN 14 AND 31 OR code = 127 OR code BETWEEN 64976 AND 65007 OR code & 65534 = 65534 THEN '' ELSE chr(code::INT) END
  WHEN letters IS NOT NULL THEN letters WHEN read IS NOT NULL THEN read ELSE n.token END, '' ORDER BY i)) AS digest
FROM n LEFT JOIN o ON code = old LEFT JOIN e ON n.token = '&' || name LEFT JOIN heads h ON h.token = n.token GROUP BY page_id""")
def html_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole pages with all character references read, named and numeric."""
    number = F.col("page_id").cast("string")
    more = F.concat("html", F.lit("&#"), (F.col("page_id") * 37).cast("string"), F.lit(";&#x"), (F.col("page_id") % 10).cast("string"), F.lit("3;&eacute;&notit;&ampx &nosuch; &; &#;\n&NotEqualTilde;"), number)
    return table(spark, sf_dir, "pages").select("page_id", F.md5(entities.unescape(more)).alias("digest"))
