"""Joins, aggregations, windows and set operations as queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import dims, text
from quire.operators import duplicates, relate
from quire.plans.registry import query, values
from quire.sources.scan import table

CHAPTERS = f"""(SELECT chapter_num, start_page, lead(start_page) OVER (ORDER BY start_page) - 1 AS end_page, slug
  FROM {values(((0, 0, "front_matter"), *dims.CHAPTERS), "chapter_num, start_page, slug")})"""
SECTIONS = f"""(SELECT section_id, start_page, lead(start_page) OVER (ORDER BY start_page) - 1 AS end_page
  FROM {values(dims.SECTIONS, "section_id, start_page")})"""
IN_CHAPTER = "doc_id >= start_page AND (end_page IS NULL OR doc_id <= end_page)"
BANDS = ((1, 0), (2, 50_000), (3, 100_000), (4, 150_000), (5, 200_000), (6, 300_000))


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


@query(f"""
SELECT chapter_num, slug, count(*) AS page_count, sum(length(text))::BIGINT AS total_length, min(doc_id) AS first_page, max(doc_id) AS last_page,
  sum(regexp_matches(text, '[\\x{{0600}}-\\x{{06FF}}]')::INT)::BIGINT AS n_arabic, sum(regexp_matches(text, '[A-Za-z]{{3}}')::INT)::BIGINT AS n_english
FROM documents JOIN {CHAPTERS} c ON {IN_CHAPTER} WHERE chapter_num > 0 GROUP BY 1, 2""")
def chapter_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages, lengths and languages of each chapter; front matter is left out as in the analytical store."""
    flag = lambda p: F.sum(F.col("text").rlike(p).cast("int"))
    placed = relate.as_of(docs(spark, sf_dir).select("doc_id", "text"), "doc_id", dims.chapters(spark)).filter("chapter_num > 0")
    return placed.groupBy("chapter_num", "slug").agg(
        F.count(F.lit(1)).alias("page_count"), F.sum(F.length("text")).alias("total_length"), F.min("doc_id").alias("first_page"), F.max("doc_id").alias("last_page"),
        flag("[؀-ۿ]").alias("n_arabic"), flag("[A-Za-z]{3}").alias("n_english"),
    )


@query(f"SELECT slug, lang, count(*) AS n FROM documents JOIN {CHAPTERS} c ON {IN_CHAPTER} GROUP BY 1, 2")
def chapter_counts_by_lang(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relate.as_of(docs(spark, sf_dir).select("doc_id", "lang"), "doc_id", dims.chapters(spark)).groupBy("slug", "lang").agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT doc_id, coalesce(section_id, 30) AS section_id FROM documents LEFT JOIN {SECTIONS} s ON {IN_CHAPTER}")
def section_of_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page outside every section belongs to the last."""
    placed = relate.as_of(docs(spark, sf_dir).select("doc_id"), "doc_id", dims.sections(spark))
    return placed.select("doc_id", F.coalesce("section_id", F.lit(30)).alias("section_id"))


@query(f"SELECT section_id, start_page, end_page FROM {SECTIONS}")
def section_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.sections(spark)


@query(f"""SELECT part_id, count(*) AS n FROM documents JOIN (SELECT part_id, start_page, lead(start_page) OVER (ORDER BY start_page) - 1 AS end_page
  FROM {values(dims.PARTS, "part_id, start_page")}) p ON {IN_CHAPTER} GROUP BY 1""")
def part_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = relate.as_of(docs(spark, sf_dir).select("doc_id"), "doc_id", dims.parts(spark))
    return placed.filter("part_id is not null").groupBy("part_id").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT conv_id, md5(string_agg('===== TURN ' || turn || ' =====' || chr(10) || text, chr(10) || chr(10) ORDER BY turn)) AS digest, count(*) AS n
  FROM conversations WHERE length(text) >= 30 GROUP BY conv_id""")
def ordered_concat_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of 30 characters or more joined in order under headings; a conversation fits a row."""
    rows = table(spark, sf_dir, "conversations").filter(F.length("text") >= 30)
    headed = rows.withColumn("section", F.concat(F.lit("===== TURN "), F.col("turn").cast("string"), F.lit(" =====\n"), "text"))
    joined = relate.ordered_text(headed, ["conv_id"], "turn", "section", "\n\n", "content")
    return joined.join(rows.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")), "conv_id").select("conv_id", F.md5("content").alias("digest"), "n")


@query("SELECT n_nationkey, n_name, c_custkey, c_name FROM nation JOIN customer ON n_nationkey = c_nationkey")
def header_lines_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("n_nationkey"), "c_custkey", "c_name")
    return table(spark, sf_dir, "nation").select("n_nationkey", "n_name").join(lines, "n_nationkey").orderBy("n_nationkey", "c_custkey")


@query(f"""SELECT band, count(*) AS n, min(o_orderkey) AS first_order FROM orders JOIN (SELECT band, low, lead(low) OVER (ORDER BY low) AS high
  FROM {values(BANDS, "band, low")}) b ON o_totalprice >= low AND (high IS NULL OR o_totalprice < high) GROUP BY 1""")
def order_price_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A range join on a number that is not whole: each band ends where the next begins."""
    bands = dims.bounds(spark.createDataFrame(list(BANDS), "band int, low long"), "low", "last").withColumn("high", F.col("last") + 1)
    inside = (F.col("o_totalprice") >= F.col("low")) & (F.col("high").isNull() | (F.col("o_totalprice") < F.col("high")))
    rows = table(spark, sf_dir, "orders").join(F.broadcast(bands), inside)
    return rows.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("first_order"))


@query("""SELECT r_name, to_json(list(struct_pack(n_nationkey := n_nationkey, n_name := n_name) ORDER BY n_nationkey))::VARCHAR AS nations
  FROM region JOIN nation ON r_regionkey = n_regionkey GROUP BY r_name""")
def nested_group_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "region").join(table(spark, sf_dir, "nation"), F.col("r_regionkey") == F.col("n_regionkey"))
    return rows.groupBy("r_name").agg(F.to_json(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name")))).alias("nations"))


@query("""SELECT g.id::BIGINT AS doc_id, coalesce(text, '') <> '' AS has_text, coalesce(quality, -1) AS quality
  FROM (SELECT unnest(range(0, (SELECT max(doc_id) + 1 FROM documents))) AS id) g LEFT JOIN documents d ON d.doc_id = g.id LEFT JOIN labels l ON l.doc_id = g.id""")
def dense_spine_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every id up to the highest, with what the layers have for it."""
    d, labels = docs(spark, sf_dir), table(spark, sf_dir, "labels")
    last = d.agg(F.max("doc_id")).first()[0]
    spine = spark.range(0, (-1 if last is None else last) + 1).withColumnRenamed("id", "doc_id")
    rows = relate.dense(spine, "doc_id", {"body": d.select("doc_id", "text"), "mark": labels.select("doc_id", F.col("quality").cast("string"))})
    return rows.select("doc_id", (F.col("body") != "").alias("has_text"), F.coalesce(F.col("mark").try_cast("int"), F.lit(-1)).alias("quality"))


@query("""SELECT d.doc_id, 'lang:' || lang || chr(10) || 'quality:' || coalesce(quality::VARCHAR, '[missing]') AS merged
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""")
def layer_left_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    part = lambda name, c: F.concat(F.lit(f"{name}:"), F.coalesce(F.col(c).cast("string"), F.lit("[missing]")))
    return docs(spark, sf_dir).select("doc_id", "lang").join(labels, "doc_id", "left").select("doc_id", F.concat_ws("\n", part("lang", "lang"), part("quality", "quality")).alias("merged"))


@query("SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def pending_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relate.pending(docs(spark, sf_dir).select("doc_id", "lang"), table(spark, sf_dir, "labels"), "doc_id")


@query("SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)")
def reviewed_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relate.among(docs(spark, sf_dir).select("doc_id", "lang"), table(spark, sf_dir, "labels").filter("quality = 1"), "doc_id")


@query("SELECT id::BIGINT AS doc_id FROM (SELECT unnest(range(0, (SELECT max(doc_id) + 1 FROM documents))) AS id) WHERE id NOT IN (SELECT doc_id FROM labels)")
def missing_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = docs(spark, sf_dir).agg(F.max("doc_id")).first()[0]
    return relate.missing(table(spark, sf_dir, "labels"), "doc_id", 0, -1 if last is None else last)


@query("""SELECT min(doc_id) AS lowest, max(doc_id) AS highest, count(doc_id) AS n, count(DISTINCT doc_id) AS n_distinct,
  count(doc_id) = count(DISTINCT doc_id) AND max(doc_id) - min(doc_id) + 1 = count(doc_id) AS contiguous FROM documents""")
def contiguity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relate.contiguity(docs(spark, sf_dir), "doc_id")


@query("""SELECT doc_id, coalesce(CASE WHEN lang <> 'en' THEN lang END, substr(b.text, 1, 20)) AS title
  FROM documents d LEFT JOIN benchmark b ON b.item_id = d.doc_id""")
def titles_restore(spark: SparkSession, sf_dir: str) -> DataFrame:
    new = docs(spark, sf_dir).select("doc_id", F.when(F.col("lang") != "en", F.col("lang")).alias("title"))
    old = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("doc_id"), F.substring("text", 1, 20).alias("title"))
    return relate.restore(new, old, "doc_id", "title").select("doc_id", "title")


@query("""SELECT doc_id, md5(coalesce(b.text, d.text)) AS en_digest, lang AS id_text FROM documents d LEFT JOIN benchmark b ON b.item_id = d.doc_id""")
def overlay_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replaces one language of the records that a patch names, and nothing else."""
    records = docs(spark, sf_dir).select("doc_id", F.struct(F.col("text").alias("en"), F.col("lang").alias("id")).alias("text"))
    patched = relate.overlay(records, table(spark, sf_dir, "benchmark").select("item_id", "text"), "doc_id", "en")
    return patched.select("doc_id", F.md5("text.en").alias("en_digest"), F.col("text.id").alias("id_text"))


@query("""WITH b AS (SELECT doc_id, md5(text) AS was FROM documents WHERE lang <> 'fr'), a AS (SELECT doc_id, md5(lower(text)) AS now FROM documents WHERE lang <> 'es')
SELECT CASE WHEN was IS NULL THEN 'added' WHEN now IS NULL THEN 'removed' WHEN was <> now THEN 'changed' ELSE 'same' END AS change, count(*) AS n
FROM b FULL JOIN a USING (doc_id) GROUP BY 1""")
def version_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = docs(spark, sf_dir)
    before = d.filter("lang <> 'fr'").select("doc_id", F.md5("text").alias("h"))
    after = d.filter("lang <> 'es'").select("doc_id", F.md5(F.lower("text")).alias("h"))
    return relate.version_delta(before, after, "doc_id", "h").groupBy("change").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH s AS (SELECT conv_id, list_distinct(list(role)) AS roles FROM conversations GROUP BY 1)
SELECT conv_id, array_to_string(list_sort(list_filter(['assistant', 'system', 'user'], lambda x: NOT list_contains(roles, x))), ',') AS missing,
  array_to_string(list_sort(list_filter(roles, lambda x: x NOT IN ('assistant', 'user'))), ',') AS extra FROM s""")
def label_set_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    sets = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.collect_set("role").alias("roles"))
    missing, _ = relate.set_difference(F.array(*map(F.lit, ("assistant", "system", "user"))), F.col("roles"))
    _, extra = relate.set_difference(F.array(F.lit("assistant"), F.lit("user")), F.col("roles"))
    return sets.select("conv_id", F.array_join(missing, ",").alias("missing"), F.array_join(extra, ",").alias("extra"))


@query("""WITH g AS (SELECT md5(trim(regexp_replace(text, '\\s+', ' ', 'g'))) AS digest, min(doc_id) AS first_page, count(*) AS n_pages FROM documents GROUP BY 1 HAVING count(*) > 1)
SELECT doc_id, first_page, n_pages FROM documents JOIN g ON digest = md5(trim(regexp_replace(text, '\\s+', ' ', 'g')))""")
def exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicates.exact_groups(docs(spark, sf_dir), "doc_id", "text")


@query("""SELECT doc_id, min(doc_id) OVER (PARTITION BY md5(trim(regexp_replace(text, '\\s+', ' ', 'g')))) AS first_page FROM documents
  WHERE length(trim(regexp_replace(text, '\\s+', ' ', 'g'))) >= 200""")
def first_seen_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first page of each body of 200 characters or more; copies are counted up before they are joined back."""
    keyed = docs(spark, sf_dir).select("doc_id", text.fold_space(F.col("text")).alias("b")).filter(F.length("b") >= 200).select("doc_id", F.md5("b").alias("digest"))
    firsts = keyed.groupBy("digest").agg(F.min("doc_id").alias("first_page"))
    return keyed.join(firsts, "digest").select("doc_id", "first_page")


@query("SELECT conv_id, arg_min(turn, (-length(text), turn)) AS turn, max(length(text)) AS n_chars FROM conversations GROUP BY 1")
def longest_candidate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    best = F.max_by("turn", F.struct(F.length("text"), -F.col("turn")))
    return rows.groupBy("conv_id").agg(best.alias("turn"), F.max(F.length("text")).cast("long").alias("n_chars"))


@query("""SELECT doc_id, lang, CASE WHEN item_id IS NOT NULL THEN length(b.text) ELSE n_chars END AS n_chars FROM documents d LEFT JOIN benchmark b ON item_id = doc_id
  UNION ALL SELECT item_id, NULL, length(text) FROM benchmark WHERE item_id NOT IN (SELECT doc_id FROM documents)""")
def import_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Imported records over generated ones, key by key."""
    over = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("doc_id"), F.length("text").cast("long").alias("n_chars"))
    return relate.override(docs(spark, sf_dir).select("doc_id", "lang", "n_chars"), over, "doc_id")
