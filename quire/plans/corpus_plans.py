"""Readers and writers, page splitting, evidence, alignment and campaign bookkeeping as queries over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import dims, folding, text
from quire.operators import blocks, campaign, checks, duplicates, evidence, layout, relate, repair, search
from quire.plans.book_plans import BOOK, FIRST, LIKE, STRIP, TIDY, book, parts
from quire.plans.campaign_plans import LATEST, events, newest
from quire.plans.registry import query
from quire.plans.relation_plans import CHAPTERS, IN_CHAPTER, docs
from quire.sources import scan, sinks, work
from quire.sources.scan import table

NUMBER = r"nullif(regexp_extract(@f, '[0-9]{1,3}'), '')::INT"


@query(rf"""WITH {BOOK}, n AS (SELECT *, {NUMBER.replace("@f", FIRST.format("source"))} AS want, {NUMBER.replace("@f", FIRST.format("body"))} AS got, body = '[NO VISIBLE TEXT]' AS marker FROM book WHERE formed)
SELECT 'malformed-labels' AS rule, page, CASE WHEN page % 9 = 0 THEN 'Arabic,English,Indonesia' ELSE '' END AS detail FROM book WHERE NOT formed
UNION ALL SELECT 'marker-over-text', page, NULL FROM n WHERE marker AND page % 8 <> 0
UNION ALL SELECT 'empty', page, NULL FROM n WHERE NOT marker AND length(body) < 40
UNION ALL SELECT 'untranslated', page, regexp_extract(body, '[\x{{0600}}-\x{{06FF}}]+') FROM n WHERE regexp_matches(body, '[\x{{0600}}-\x{{06FF}}]')
UNION ALL SELECT 'wrong-page', page, want || ' vs ' || got FROM n WHERE abs(want - got) > 1 UNION ALL SELECT 'off-by-one', page, want || ' vs ' || got FROM n WHERE abs(want - got) = 1
UNION ALL SELECT 'banned-honorific', page, NULL FROM n WHERE contains(body, 'exalted is He')
UNION ALL SELECT 'missing-honorific', page, NULL FROM n WHERE page % 8 = 3 AND NOT contains(body, 'exalted is He') AND NOT contains(body, 'Most High')""")
def triage_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The book's files against their sources, problem by problem."""
    return checks.triage(*parts(spark, sf_dir)).select("rule", "page", "detail")


@query(rf"""WITH {BOOK}, x AS (SELECT page, {TIDY.replace("@b", "target")} AS first, {TIDY.replace("@b", "regexp_replace(file, '(?m)^[ \t]*(Arabic|English|Indonesia)[ \t]*:', '', 'g')")} AS bare FROM book),
a AS (SELECT *, CASE WHEN first IS NOT NULL AND {LIKE.replace("@b", "first")} THEN 'recover' WHEN {LIKE.replace("@b", "bare")} THEN 'relabel' ELSE 'translate' END AS action FROM x)
SELECT page, action, CASE action WHEN 'recover' THEN md5(first) WHEN 'relabel' THEN md5(bare) ELSE md5('') END AS digest FROM a""")
def repair_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the English layer could take from the book's files, read as its siblings."""
    plan = book(spark, sf_dir).select("page", repair.plan_block(F.col("file"), "English", "en").alias("p"))
    return plan.select("page", "p.action", F.md5("p.body").alias("digest"))


@query(rf"""WITH {BOOK}, x AS (SELECT page, {TIDY.replace("@b", "target")} AS first, {TIDY.replace("@b", "regexp_replace(file, '(?m)^[ \t]*(Arabic|English|Indonesia)[ \t]*:', '', 'g')")} AS bare FROM book)
SELECT page, CASE WHEN first IS NOT NULL AND {LIKE.replace("@b", "first")} THEN 'recover' WHEN {LIKE.replace("@b", "bare")} THEN 'relabel' ELSE 'translate' END AS action FROM x""")
def missing_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plans for a layer of which no file exists yet."""
    files, sources = parts(spark, sf_dir)
    return repair.plan_missing(files.withColumn("layer", F.lit("id")), sources, "en").select("page", "action")


@query(rf"""WITH {BOOK}, x AS (SELECT page, page % 9 <> 1 AND {LIKE.replace("@b", TIDY.replace("@b", "coalesce(target, '')"))} AS found FROM book)
SELECT page, found AS rewritten FROM x""")
def applied_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A plan's blocks put into stand-in files: those with a block to recover are rewritten, the others stay."""
    _, sources = parts(spark, sf_dir)
    plan = book(spark, sf_dir).select("page", repair.plan_block(F.col("file"), "English", "en").alias("p")).select("page", F.when(F.col("p.action") == "recover", "recover").otherwise("translate").alias("action"), "p.body")
    stand_in = sources.select("page", F.lit("en").alias("layer"), F.lit("old").alias("content"))
    return repair.apply_plan(stand_in, plan, sources, "en").select("page", (F.col("content") != "old").alias("rewritten"))


BATCHED = "'===== PAGE ' || page || ' =====' || chr(10) || t"


@query(rf"""WITH {BOOK} SELECT page::INT AS page_num, length(t)::INT AS content_length, md5(t) AS digest FROM book WHERE t <> ''""")
def page_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages joined eight at a time under page markers, and taken apart again."""
    rows = book(spark, sf_dir).select("page", F.floor(F.col("page") / 8).alias("file_no"), F.expr(BATCHED).alias("part"))
    files = relate.ordered_text(rows, ["file_no"], "page", "part", "\n\n", "content")
    found = files.select(F.explode(blocks.split_pages(F.col("content"))).alias("p"))
    return found.select("p.page_num", "p.content_length", F.md5("p.content").alias("digest"))


@query(rf"""WITH {BOOK} SELECT page, md5(CASE WHEN t = '' THEN NULL ELSE t END) AS digest FROM book WHERE t <> ''""")
def response_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three pages' answers in one response, each found again by its marker."""
    rows = book(spark, sf_dir).filter("t <> ''").select("page", F.floor(F.col("page") / 3).alias("call"), F.expr("'--- PAGE ' || page || ' TRANSLATION ---' || chr(10) || t").alias("part"))
    answers = relate.ordered_text(rows, ["call"], "page", "part", "\n\n", "response").withColumnRenamed("call", "r_call")
    both = rows.select("page", "call").join(answers, F.col("call") == F.col("r_call"))
    return both.select("page", F.md5(blocks.split_response(F.col("response"), F.col("page"), F.lit(False))).alias("digest"))


PARAGRAPHS = rf"""p AS (SELECT page, i - 1 AS idx, regexp_replace(ps[i], {STRIP}) AS b FROM (SELECT page, ps, unnest(range(1, len(ps) + 1)) AS i FROM (SELECT page, regexp_split_to_array(t || chr(10) || chr(10) || '— ' || page || ' —' || chr(10) || chr(10) || 'Chapter One', '\n[ \t]*\n') AS ps FROM book))),
r AS (SELECT *, list_filter(list_transform(string_split(b, chr(10)), lambda x: regexp_replace(x, {STRIP})), lambda x: x <> '') AS rows FROM p)"""
PIPE = r"(regexp_matches({0}, '^[^\n]*\|[^\n]*\|[^\n]*$') AND NOT starts_with({0}, '[Letter-string:'))"


@query(rf"""WITH {BOOK}, {PARAGRAPHS}
SELECT CASE WHEN len(rows) = 0 THEN 'empty' WHEN idx = 0 AND len(rows) = 1 AND page >= 8 AND regexp_matches(rows[1], '^(?:[—–-]\s*[0-9]+\s*[—–-]|\(\s*[0-9]+\s*\))$') THEN 'folio' WHEN len(rows) = 1 AND rows[1] = '[NO VISIBLE TEXT]' THEN 'blank_notice'
  WHEN len(list_filter(rows, lambda x: NOT {PIPE.format("x")})) = 0 THEN 'table' WHEN regexp_matches(rows[1], '^\[Row\s+[0-9]+\]$') AND len(rows) > 1 THEN 'names_row'
  WHEN regexp_matches(rows[1], '^\[(?:Inside|Around|Outside|Top|Bottom|Grid\s+contents|Table\s+containing|Geometric\s+figure|Letter-string)') OR starts_with(rows[1], 'Text transcribed ') OR starts_with(rows[1], 'Picture of ') THEN 'diagram'
  WHEN page IN (2, 4, 6, 7) THEN 'imprint' WHEN len(rows) = 1 AND rows[1] = '*' THEN 'asterisk' WHEN len(rows) = 1 AND starts_with(rows[1], '❖') THEN 'ornament'
  WHEN len(rows) = 1 AND regexp_matches(rows[1], '^(?:## |(?:Chapter|Section|Part)\b[^.\n]{{0,80}}$)') THEN 'heading' WHEN len(list_filter(rows, lambda x: contains(x, ' * '))) >= 2 THEN 'verse' ELSE 'prose' END AS kind, count(*) AS n FROM r GROUP BY 1""")
def block_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks between blank lines, by class."""
    whole = F.concat("t", F.lit("\n\n— "), F.col("page").cast("string"), F.lit(" —\n\nChapter One"))
    rows = book(spark, sf_dir).select("page", F.posexplode(F.split(whole, r"\n[ \t]*\n", -1)).alias("idx", "b"))
    return rows.groupBy(layout.block_kind(text.strip(F.col("b")), F.col("idx"), F.col("page")).alias("kind")).agg(F.count(F.lit(1)).alias("n"))


@query(rf"""WITH {BOOK}, l AS (SELECT page, unnest(string_split(t, chr(10))) AS line FROM book)
SELECT page, sum(len(regexp_split_to_array(line || ' * x', '\s*\*\s*')))::BIGINT AS halves, count(*) FILTER (len(regexp_extract_all(line || repeat('☩', page % 25), '[☩۞۩○●□■▢∆▲▽▼]')) >= 20) AS art FROM l GROUP BY 1""")
def verse_halves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Halves of verses line by line, and lines drawn of glyphs."""
    rows = book(spark, sf_dir).select("page", F.explode(F.split("t", "\n", -1)).alias("line"))
    art = layout.is_grid_art(F.concat("line", F.repeat(F.lit("☩"), (F.col("page") % 25).cast("int"))))
    return rows.groupBy("page").agg(F.sum(F.size(layout.verse_halves(F.concat("line", F.lit(" * x"))))).alias("halves"), F.count_if(art).alias("art"))


@query("""SELECT conv_id, turn, text, arg_max(CASE WHEN role = 'user' THEN text END, turn) FILTER (role = 'user') OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS asked FROM conversations""")
def filled_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each turn with the question that stands last before it."""
    rows = table(spark, sf_dir, "conversations").withColumn("question", F.when(F.col("role") == "user", F.col("text")))
    return layout.fill_forward(rows, "conv_id", "turn", "question", "asked").select("conv_id", "turn", "text", "asked")


RECORDS = "(SELECT doc_id + 1 AS page, CASE WHEN doc_id % 10 = 0 THEN '' ELSE text END AS en FROM documents)"


@query(rf"""SELECT page::INT AS page, md5(CASE WHEN regexp_replace(en, {STRIP}) = '' THEN '(no english text on this page.)' ELSE regexp_replace(regexp_replace(en, '\r\n?', chr(10), 'g'), {STRIP}) END) AS en,
  '/scans/page_' || CASE WHEN page < 1000 THEN lpad(page::VARCHAR, 3, '0') ELSE page::VARCHAR END || '.jpg' AS "scanSrc" FROM {RECORDS}""")
def dataset_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records built with fallbacks, written as JSON lines and read back."""
    rows = docs(spark, sf_dir).select((F.col("doc_id") + 1).alias("page"), F.lit("").alias("ar"), F.when(F.col("doc_id") % 10 == 0, "").otherwise(F.col("text")).alias("en"), F.lit("").alias("id"))
    path = work.folder(spark, "dataset")
    sinks.dataset_json(scan.records(rows), path)
    return spark.read.schema(scan.RECORD).json(path).select("page", F.md5("text.en").alias("en"), "scanSrc")


@query("""SELECT doc_id::INT + 1 AS page, CASE WHEN doc_id % 8 = 7 AND coalesce(text, '') = '' THEN 'direct' ELSE coalesce(text, '') END AS en, CASE WHEN doc_id % 8 = 7 THEN 'teks' ELSE '' END AS id,
  CASE WHEN doc_id % 8 IN (5, 6) THEN 'scan' END AS scan, CASE WHEN doc_id % 8 = 7 THEN 's7' ELSE '' END AS section FROM documents""")
def tolerant_import(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document in each of the accepted JSON shapes, by turns: nested, flat, wrapped, plain strings, numbers as strings, repeated pages."""
    n, body = F.col("doc_id") + 1, F.coalesce(F.col("text"), F.lit(""))
    one = lambda **c: F.to_json(F.struct(*[(v if not isinstance(v, str) else F.lit(v)).alias(k) for k, v in c.items()]))
    array = lambda *records: F.concat(F.lit("["), F.concat_ws(",", *records), F.lit("]"))
    wrapped = lambda *records: F.concat(F.lit('{"toc":[],"pages":'), array(*records), F.lit("}"))
    shapes = [
        array(one(page=n, text=F.struct(body.alias("en")))), wrapped(one(p=n, en=body)), array(one(number=n, body=body)), wrapped(one(n=n.cast("string"), content=body)),
        array(one(page=n, text=F.struct(F.lit("").alias("en")), en=body)), array(F.concat(F.lit('{"page":null,'), F.substring(one(p=n, text_=body, scan="scan"), F.lit(2), F.lit(2**31 - 1)))),
        array(one(page=n, translation=body, scanSrc="scan")), array(one(page=n, en="old"), one(page=n, text=F.struct(body.alias("en"), F.lit("teks").alias("id")), en="direct", sectionId="s7")),
    ]
    j = F.get(F.array(*shapes), (F.col("doc_id") % 8).cast("int"))
    return scan.tolerant_records(docs(spark, sf_dir).select(j.alias("j")), "j", 2**31 - 1).select("page", "en", "id", "scan", "section")


@query("SELECT doc_id, CASE WHEN doc_id % 6 = 0 THEN 'invalid JSON' WHEN doc_id % 6 < 3 THEN 'no page entries' ELSE 'no valid pages' END AS error FROM documents WHERE doc_id % 6 <> 5 AND NOT (doc_id % 6 = 4 AND doc_id BETWEEN 1 AND 604)")
def import_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that an import refuses, with the reason."""
    n, body = F.col("doc_id"), F.to_json(F.array(F.coalesce(F.col("text"), F.lit(""))))
    record = lambda page: F.concat(F.lit('[{"page":'), page, F.lit(',"body":'), F.substring(body, F.lit(2), F.length(body) - 2), F.lit("}]"))
    shapes = [F.concat(body, F.lit("}")), F.lit("[]"), F.concat(F.lit('{"data":'), record(F.lit("1")), F.lit("}")), record(F.lit('"one"')), record(n.cast("string")), record(F.lit('"1"'))]
    return scan.tolerant_errors(docs(spark, sf_dir).select("doc_id", F.get(F.array(*shapes), (n % 6).cast("int")).alias("j")), "doc_id", "j", 604)


@query("SELECT conv_id, string_agg(text, '' ORDER BY turn) AS said FROM conversations WHERE text <> '' GROUP BY 1")
def payload_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as one nested answer, and its text again."""
    rows = table(spark, sf_dir, "conversations").filter("text <> ''")
    items = F.array_sort(F.collect_list(F.struct("turn", F.lit("output_text").alias("type"), "text")))
    payload = F.to_json(F.struct(F.array(F.struct(F.lit("message").alias("type"), items.alias("content"))).alias("output")))
    return rows.groupBy("conv_id").agg(payload.alias("p")).select("conv_id", blocks.payload_text(F.col("p")).alias("said"))


@query("SELECT conv_id, arg_max(text, turn) AS text FROM conversations WHERE role = 'assistant' AND text IS NOT NULL GROUP BY 1")
def newest_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest turn of each conversation that an assistant filled."""
    rows = table(spark, sf_dir, "conversations").withColumn("said", F.when(F.col("role") == "assistant", F.col("text")))
    return scan.newest_filled(rows, "conv_id", "turn", "said").select("conv_id", F.col("said").alias("text"))


@query("SELECT doc_id AS page, text, lang FROM documents WHERE doc_id = 7")
def one_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan.one_record(docs(spark, sf_dir).select(F.col("doc_id").alias("page"), "text", "lang"), 7)


@query("SELECT event_type AS action, count(*) AS n, count(DISTINCT user_id) AS pages FROM events GROUP BY 1")
def logged_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events appended to a log in two parts and read from it."""
    path = work.folder(spark, "log")
    rows = events(spark, sf_dir).select(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"), F.col("event_type").alias("action"), F.col("user_id").cast("int").alias("page"), "event_id")
    for rest in (0, 1):
        sinks.append_log(rows.filter(F.col("event_id") % 2 == rest).drop("event_id"), path)
    return scan.event_log(spark, path).groupBy("action").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("page").alias("pages"))


@query("SELECT to_base64(encode(string_agg(r_name, chr(10) ORDER BY r_name) || chr(10))) AS data FROM region")
def base64_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work.folder(spark, "names")
    table(spark, sf_dir, "region").select("r_name").coalesce(1).sortWithinPartitions("r_name").write.text(path)
    return scan.base64_files(spark, f"{path}/*.txt").select("data")


@query(f"""SELECT chapter_num, count(*) AS n_pages, sum(len(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+')))::BIGINT AS n_terms FROM documents JOIN {CHAPTERS} c ON {IN_CHAPTER} GROUP BY 1""")
def stored_chapters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The analytical store written whole: its pages by chapter and its index agree."""
    path = work.folder(spark, "store")
    pages = relate.as_of(docs(spark, sf_dir).select(F.col("doc_id").alias("page_num"), F.col("text").alias("content")), "page_num", dims.chapters(spark)).select("page_num", "content", "chapter_num")
    sinks.analytical_store(pages, dims.chapters(spark), path)
    index = spark.read.parquet(f"{path}/fts_content").groupBy(F.col("page_num").alias("i_page")).agg(F.sum(F.size("positions")).alias("terms"))
    stored = spark.read.parquet(f"{path}/pages").join(index, F.col("page_num") == F.col("i_page"), "left")
    return stored.groupBy("chapter_num").agg(F.count(F.lit(1)).alias("n_pages"), F.coalesce(F.sum("terms"), F.lit(0)).alias("n_terms"))


@query(f"""SELECT slug, count(*) AS n_lines FROM (SELECT doc_id, replace(text, chr(10), ' ') AS line FROM documents) JOIN {CHAPTERS} c ON {IN_CHAPTER} GROUP BY 1""")
def chapter_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as one line each in a folder for each chapter."""
    path = work.folder(spark, "tree")
    placed = relate.as_of(docs(spark, sf_dir).select("doc_id", "text"), "doc_id", dims.chapters(spark))
    sinks.chapter_tree(placed.select("slug", F.regexp_replace("text", r"[\r\n]", " ").alias("value")), path)
    return spark.read.text(path).groupBy("slug").agg(F.count(F.lit(1)).alias("n_lines"))


@query("SELECT doc_id AS page, (doc_id % 4 + 1)::VARCHAR AS seed FROM documents")
def placeholder_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stand-in of each page number, the same in every run."""
    return docs(spark, sf_dir).select(F.col("doc_id").alias("page"), scan.placeholder_page(F.col("doc_id"), ["1", "2", "3", "4"]).alias("seed"))


@query("SELECT doc_id, strip_accents(lower(text)) AS folded, coalesce(length(strip_accents(text))::DOUBLE / nullif(length(text), 0), 0) AS ratio FROM documents")
def folded_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts without case and diacritics, and how much shorter they are."""
    return docs(spark, sf_dir).select("doc_id", folding.fold(F.col("text")).alias("folded"), folding.fold_ratio(F.col("text")).alias("ratio"))


@query("SELECT doc_id FROM documents WHERE contains(strip_accents(lower(text)), 'leere')")
def loose_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a run of letters, whatever their accents and case."""
    return search.loose_search(docs(spark, sf_dir), "doc_id", "text", "LeÈré")


@query("""SELECT min(term) AS term, count(DISTINCT doc_id) AS n_pages, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[\\p{L}\\p{N}]+')) AS term FROM documents) GROUP BY replace(strip_accents(lower(term)), 'ß', 'ss')""")
def loose_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that differ in case and accents alone, counted together."""
    return search.loose_terms(docs(spark, sf_dir), "doc_id", "text")


@query("""WITH t AS (SELECT doc_id, unnest(regexp_extract_all(strip_accents(lower(text)), '[\\p{L}\\p{N}]+')) AS term FROM documents)
SELECT doc_id, count(*) AS hits FROM t WHERE term = 'license' GROUP BY 1""")
def folded_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index without diacritics."""
    return search.match(search.inverted_index(docs(spark, sf_dir), "doc_id", "text", fold=True), "doc_id", "license")


@query("SELECT doc_id, n_chars FROM documents ORDER BY n_chars DESC, doc_id LIMIT 100 OFFSET 100")
def second_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second hundred of an ordered list."""
    return search.page_of(docs(spark, sf_dir).select("doc_id", "n_chars"), [F.col("n_chars").desc(), F.col("doc_id")], 100)


@query(rf"""WITH {BOOK} SELECT page, CASE page % 8 WHEN 1 THEN 'الرحمن الرحيم' WHEN 3 THEN 'العلم تعالى' ELSE '' END AS terms FROM book""")
def fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each source's longest distinct words, in the order of their length."""
    return book(spark, sf_dir).select("page", F.array_join(duplicates.fingerprint_terms(F.col("source"), []), " ").alias("terms"))


SIGNED = "CASE WHEN page % 4 = 0 THEN '— ' || (page + @d) || ' —' || chr(10) ELSE '' END || repeat('﴾', (page + @d) % 5) || CASE (page + @d) % 3 WHEN 1 THEN ' Musa and Isa' WHEN 2 THEN ' Adam' ELSE '' END || ' ' || t"


@query("""WITH g AS (SELECT doc_id + 1 AS page, doc_id + 1 + (doc_id % 7 = 0)::INT AS says FROM documents), x AS (SELECT *, (says + 1) % 4 AS z FROM g),
t AS (SELECT page, CASE WHEN page % 4 = 0 THEN says END AS h, says % 5 AS f, says % 3 AS l FROM g), s AS (SELECT page AS slot, CASE WHEN page % 4 = 0 THEN page END AS h, page % 5 AS f, page % 3 AS l FROM g),
p AS (SELECT t.page, s.slot, (CASE WHEN t.h IS NOT NULL AND s.h IS NOT NULL AND t.h = s.h THEN 2 ELSE 0 END + (t.f = s.f)::INT + (t.l = s.l)::INT)::DOUBLE / CASE WHEN t.h IS NOT NULL AND s.h IS NOT NULL THEN 4 ELSE 2 END AS score,
  (t.h = s.h) OR ((t.f > 0 OR t.l > 0) AND t.f = s.f AND t.l = s.l) AS met FROM t, s WHERE t.h IS NOT NULL OR t.f > 0 OR t.l > 0),
o AS (SELECT page, score AS own_score FROM p WHERE slot = page AND score < 0.999)
SELECT page, own_score, slot AS best, score AS best_score FROM p JOIN o USING (page) WHERE met QUALIFY row_number() OVER (PARTITION BY page ORDER BY score DESC, slot) = 1""")
def alignment_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages whose signature fits another source than their own: every seventh says the next page's."""
    rows = docs(spark, sf_dir).select((F.col("doc_id") + 1).alias("page"), (F.col("doc_id") % 7 == 0).cast("int").alias("d"), F.lit("").alias("t"))
    of = lambda d: rows.select("page", F.expr(SIGNED.replace("@d", d)).alias("body"))
    return duplicates.alignment(of("d"), of("0"))


@query("SELECT doc_id // 1000 AS part, count(*) FILTER (quality = 1) AS done, count(*) AS total, md5(string_agg(CASE WHEN quality = 1 THEN '- [x] ' ELSE '- [ ] ' END || doc_id, chr(10) ORDER BY doc_id)) AS digest, ceil((count(*) - count(*) FILTER (quality = 1)) / 3.0)::BIGINT AS calls FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1")
def checklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of good quality are done; with the calls that the others will take."""
    marked = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("l_id"), "quality")
    state = docs(spark, sf_dir).select("doc_id").join(marked, F.col("doc_id") == F.col("l_id"), "left").select("doc_id", F.when(F.col("quality") == 1, "committed").otherwise("pending").alias("status"))
    return campaign.checklist(state, "doc_id").select("part", "done", "total", F.md5("lines").alias("digest"), campaign.remaining_calls(F.col("total"), F.col("done")).alias("calls"))


@query("""WITH c AS (SELECT conv_id AS page, substr(sha256(conv_id::VARCHAR), 1, 6 + conv_id % 4) AS sha, list_distinct(list(role)) AS paths FROM conversations GROUP BY 1),
x AS (SELECT *, list_sort(list_filter(paths, lambda p: p NOT IN ('user', 'assistant'))) AS outside, list_sort(list_filter(paths, lambda p: p = 'assistant')) AS touched FROM c)
SELECT page, array_to_string(outside, ',') AS outside, array_to_string(touched, ',') AS touched, len(outside) = 0 AND len(touched) > 0 AND length(sha) >= 7 AS ok FROM x""")
def commit_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roles stand for paths: a commit may change two of them and must change the assistant's."""
    c = F.col("conv_id")
    commits = table(spark, sf_dir, "conversations").groupBy(c.alias("page")).agg(F.collect_set("role").alias("paths"))
    commits = commits.withColumn("sha", F.expr("substring(sha2(cast(page AS string), 256), 1, cast(6 + page % 4 AS int))"))
    allowed = commits.select("page", F.array(F.lit("user"), F.lit("assistant")).alias("paths"), F.array(F.lit("assistant")).alias("targets"))
    return campaign.commit_scope(commits, allowed).select("page", F.array_join("outside", ",").alias("outside"), F.array_join("touched", ",").alias("touched"), "ok")


@query("""WITH s AS (SELECT DISTINCT user_id FROM events), n AS (SELECT unnest(range(1, 1001)) AS page)
SELECT page, 'missing' AS error FROM n WHERE page NOT IN (SELECT user_id FROM s) UNION ALL SELECT user_id, 'unexpected' FROM s WHERE user_id NOT BETWEEN 1 AND 1000
UNION ALL SELECT user_id, 'unknown status' FROM s WHERE user_id % 9 = 0""")
def state_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = events(spark, sf_dir).select(F.col("user_id").alias("page")).distinct().withColumn("status", F.when(F.col("page") % 9 == 0, "lost").otherwise("pending"))
    return campaign.state_errors(state, 1000)


@query(f"""SELECT user_id, CASE WHEN user_id % 5 = 0 THEN 'marked' ELSE status END AS status FROM ({LATEST})""")
def marked_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest statuses with newer marks put in."""
    state = newest(spark, sf_dir).select("user_id", "status", F.col("ts").alias("updated"))
    marks = state.filter("user_id % 5 = 0").withColumn("status", F.lit("marked"))
    return campaign.mark(state, marks, "user_id").select("user_id", "status")


@query(rf"""WITH {BOOK} SELECT page, CASE WHEN page % 2 = 0 THEN 'claimed' ELSE 'rework' END AS status, page % 3 AS attempt, md5(source) AS source, md5(file) AS draft, 'ocr/enriched/page_' || CASE WHEN page < 1000 THEN lpad(page::VARCHAR, 3, '0') ELSE page::VARCHAR END || '.txt' AS path
FROM book WHERE page % 4 < 2 AND page % 10 <> 0""")
def work_packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a worker gets for each page that it holds."""
    files, sources = parts(spark, sf_dir)
    page = F.col("page")
    state = sources.select("page", F.when(page % 2 == 0, "claimed").otherwise("rework").alias("status"), F.when(page % 10 == 0, "other").when(page % 4 < 2, "me").alias("owner"), (page % 3).alias("attempts"))
    every = files.unionByName(sources.select("page", F.lit("ar").alias("layer"), F.col("body").alias("content")))
    p = campaign.work_packets(state, every, "me").select("packet.*")
    return p.select("page", "status", "attempt", F.md5("source_text").alias("source"), F.md5("english_draft").alias("draft"), F.col("paths.source").alias("path"))


@query(rf"""WITH {BOOK}, e AS (SELECT page, list_filter([CASE WHEN page % 6 = 0 THEN 'file: malformed digest' WHEN page % 6 = 1 THEN 'file: unsafe path' WHEN page % 6 = 2 THEN 'file: file missing' WHEN page % 6 = 3 THEN 'file: file differs' END,
  CASE WHEN page % 5 = 0 THEN 'record: record differs' END], lambda x: x IS NOT NULL) AS errors FROM book) SELECT page, array_to_string(errors, '; ') AS errors FROM e""")
def manifest_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A manifest of the book's files and records, a part of it wrong."""
    rows = book(spark, sf_dir).select("page", "file", F.concat(F.lit("en/"), F.col("page").cast("string")).alias("path"))
    page, digest = F.col("page"), F.sha2("file", 256)
    files = rows.filter("page % 6 <> 2").select("path", F.when(page % 6 == 3, "other").otherwise(F.col("file")).alias("content"))
    files = files.union(rows.filter("page % 6 = 1").select(F.concat(F.lit("../"), "path"), "file"))
    listed = rows.select("page", F.lit("file").alias("role"), F.when(page % 6 == 1, F.concat(F.lit("../"), "path")).otherwise(F.col("path")).alias("path"), F.when(page % 6 == 0, "none").otherwise(digest).alias("sha256"))
    records = rows.select("page", F.sha2(F.col("path"), 256).alias("record_sha256"))
    listed = listed.union(rows.select("page", F.lit("record"), F.lit(None).cast("string"), F.sha2(F.when(page % 5 == 0, F.lit("x")).otherwise(F.col("path")), 256)))
    last = rows.agg(F.max("page")).first()[0] or 0
    return evidence.manifest_audit(listed, files, records, last).select("page", F.array_join("errors", "; ").alias("errors"))


@query(rf"""WITH {BOOK} SELECT page, md5(source) AS source, page % 4 = 0 AS matches FROM book WHERE formed AND emb = source AND emb <> '' AND body <> '' AND page <= 604""")
def editorial_overrides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overrides registered for well-formed pages; three of four pages were edited once more and match no longer."""
    rows = book(spark, sf_dir).filter("page % 9 > 3 AND body <> '' AND page <= 604")
    proof = F.array(F.struct(F.lit("docs/english-corrections/a/b.md").alias("path"), F.lit("why").alias("content")))
    entry = evidence.override_entry(F.col("page"), F.lit(1), F.lit("2026-01-01"), F.col("source"), F.col("file"), F.col("file"), proof)
    now = F.concat("file", F.when(F.col("page") % 4 != 0, "more").otherwise(""))
    return rows.select("page", F.md5("source").alias("source"), evidence.override_matches(entry["entry"], F.col("page"), F.col("source"), now).alias("matches"))


@query(rf"""WITH {BOOK} SELECT page, md5(t || ' Rahmat, Jabrail.') AS digest, true AS idempotent FROM book""")
def doubled_tails(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names put into their one form, checked again on their own."""
    fixed = repair.doubled_tails(F.concat("t", F.lit(" Rahmatmat, Jabrailil.")), {"Rahmatm": "Rahmat", "Jabraili": "Jabrail"})
    return book(spark, sf_dir).select("page", fixed.alias("f")).select("page", F.md5("f.body").alias("digest"), "f.idempotent")


@query("SELECT doc_id AS page, md5(lang) AS ar, md5(source) AS en FROM documents UNION ALL SELECT NULL, NULL, NULL WHERE false")
def layer_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two layers in long form, side by side again."""
    d = docs(spark, sf_dir)
    long = d.select(F.col("doc_id").alias("page"), F.lit("ar").alias("layer"), F.col("lang").alias("content")).unionByName(d.select(F.col("doc_id").alias("page"), F.lit("en").alias("layer"), F.col("source").alias("content")))
    of = lambda name: long.filter(F.col("layer") == name).select("page", "content")
    dense = relate.dense(d.select(F.col("doc_id").alias("page")), "page", {"ar": of("ar"), "en": of("en")})
    return dense.select("page", F.md5("ar").alias("ar"), F.md5("en").alias("en"))


@query(rf"""WITH {BOOK} SELECT page, len(regexp_extract_all(t, '[^\x20\x09-\x0D]+'))::INT AS n_tokens FROM book WHERE NOT contains(t, '|')""")
def layout_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of texts without tables."""
    return book(spark, sf_dir).filter("not contains(t, '|')").select("page", F.size(layout.tokens(F.col("t"))).alias("n_tokens"))
