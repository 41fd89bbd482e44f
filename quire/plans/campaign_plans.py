"""Campaign state from the event table, and search, evidence and streaming queries."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import text
from quire.operators import campaign, evidence, relate, search
from quire.plans.registry import query
from quire.plans.relation_plans import SECTIONS, docs
from quire.sources.scan import table
from quire.streaming import campaign as streams

LATEST = "SELECT user_id, event_type AS status, ts FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).select("user_id", "event_type", "ts", "event_id")
    return campaign.latest(rows, "user_id", F.col("ts").desc(), F.col("event_id").desc()).withColumnRenamed("event_type", "status")


def now_of(spark: SparkSession, sf_dir: str):
    """The newest event's time: the clock of queries over a finished log."""
    return F.lit(events(spark, sf_dir).agg(F.max("ts").alias("m")).first()["m"]).cast("timestamp")


@query(f"SELECT user_id, status FROM ({LATEST})")
def latest_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return newest(spark, sf_dir).select("user_id", "status")


@query(f"SELECT status, count(*) AS n FROM ({LATEST}) GROUP BY 1")
def status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return campaign.status_counts(newest(spark, sf_dir), "status")


@query(f"SELECT min(user_id) AS page, arg_min(status, user_id) AS status FROM ({LATEST}) WHERE status <> 'purchase'")
def sequence_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A purchase stands for a committed page."""
    state = newest(spark, sf_dir).select(F.col("user_id").alias("page"), F.when(F.col("status") == "purchase", campaign.TERMINAL).otherwise(F.col("status")).alias("status"))
    return campaign.sequence_gate(state)


@query("""SELECT user_id, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_beat, floor(epoch((SELECT max(ts) FROM events) - max(ts)))::BIGINT AS age FROM events GROUP BY user_id
  HAVING floor(epoch((SELECT max(ts) FROM events) - max(ts))) > 1800""")
def stale_locks(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = campaign.stale(events(spark, sf_dir), "user_id", "ts", now_of(spark, sf_dir))
    return found.withColumn("last_beat", F.date_format("last_beat", "yyyy-MM-dd HH:mm:ss"))


@query(f"""WITH s AS ({LATEST}), p AS (SELECT user_id, CASE WHEN status = 'error' AND epoch((SELECT max(ts) FROM events) - ts) / 3600 >= 24 THEN 0
    WHEN status = 'view' THEN 1 WHEN status = 'signup' THEN 2 END AS priority FROM s)
SELECT user_id, priority, row_number() OVER (ORDER BY priority, user_id)::INT AS place FROM p WHERE priority IS NOT NULL ORDER BY priority, user_id LIMIT 10""")
def retry_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors are failed pages, views half-done ones, signups pending ones."""
    names = F.create_map(*[F.lit(x) for kv in (("error", "failed"), ("view", "raw_ocr_done"), ("signup", "pending"), ("purchase", "done")) for x in kv])
    state = newest(spark, sf_dir).select("user_id", F.coalesce(F.try_element_at(names, F.col("status")), F.lit("other")).alias("status"), F.col("ts").cast("timestamp").alias("updated"))
    return campaign.retry_batch(state, "user_id", now_of(spark, sf_dir))


@query("""WITH RECURSIVE a AS (SELECT user_id AS page, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n,
    CASE event_type WHEN 'signup' THEN 'claim' WHEN 'view' THEN 'start' WHEN 'purchase' THEN 'submit' WHEN 'error' THEN 'block' ELSE 'other' END AS action FROM events),
r AS (SELECT DISTINCT page, 0::BIGINT AS n, 'pending' AS status, NULL::VARCHAR AS owner, 0 AS attempts, 0 AS n_refused FROM a
  UNION ALL SELECT page, n, coalesce(new, status), CASE WHEN new IS NOT NULL AND action = 'claim' THEN 'worker' ELSE owner END, attempts + (new IS NOT NULL AND action = 'claim')::INT, n_refused + (new IS NULL)::INT
  FROM (SELECT r.page, a.n, r.status, r.owner, r.attempts, r.n_refused, a.action, CASE WHEN action = 'claim' AND status IN ('pending', 'rework') THEN 'claimed' WHEN action = 'start' AND status = 'claimed' THEN 'in_progress'
    WHEN action = 'submit' AND status = 'in_progress' THEN 'review' WHEN action = 'block' AND status IN ('claimed', 'in_progress', 'review', 'rework') THEN 'blocked' END AS new FROM r JOIN a ON a.page = r.page AND a.n = r.n + 1))
SELECT page, status, owner, attempts, n_refused FROM r QUALIFY row_number() OVER (PARTITION BY page ORDER BY n DESC) = 1""")
def state_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's events as a page's actions, folded in order; the SQL walks them one by one."""
    actions = F.create_map(*[F.lit(x) for kv in (("signup", "claim"), ("view", "start"), ("purchase", "submit"), ("error", "block")) for x in kv])
    rows = events(spark, sf_dir).select(
        F.col("user_id").alias("page"), F.struct("ts", "event_id").alias("seq"), F.coalesce(F.try_element_at(actions, F.col("event_type")), F.lit("other")).alias("action"), F.lit("worker").alias("actor")
    )
    return campaign.fold(rows)


@query("SELECT event_id, event_type FROM events ORDER BY ts DESC, event_id DESC LIMIT 10")
def tail_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return campaign.tail(events(spark, sf_dir).select("event_id", "event_type", "ts"), 10, F.col("ts").desc(), F.col("event_id").desc()).select("event_id", "event_type")


@query("SELECT strftime(ts, '%Y-%m-%d') AS day, event_type AS kind, count(*) AS n FROM events GROUP BY 1, 2")
def stream_daily_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    return streams.daily_counts(spark, f"{sf_dir}/events.parquet*", schema, "ts", "event_type", f"daily_{uuid.uuid4().hex}").withColumn("day", F.col("day").cast("string"))


@query("SELECT event_id, coalesce(json_valid(props), false) AS valid FROM events")
def strict_json_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select("event_id", evidence.strict_json(F.col("props")).isNotNull().alias("valid"))


@query("""SELECT page_id, NOT regexp_matches(url, '[\\\\:\\x00-\\x1F]') AND len(list_filter(string_split(url, '/'), lambda p: p IN ('', '.', '..'))) = 0 AS safe,
  regexp_matches(sha256(url), '^[0-9a-f]{64}$') AS digest_ok, regexp_matches(regexp_replace(url, '^.*/', ''), '^[0-9a-fA-F]{7,64}$') AS commit_like FROM pages""")
def path_digest_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    return table(spark, sf_dir, "pages").select("page_id", evidence.is_safe_path(url).alias("safe"), evidence.is_digest(F.sha2(url, 256)).alias("digest_ok"), evidence.is_commit(F.regexp_replace(url, "^.*/", "")).alias("commit_like"))


@query("""SELECT doc_id, sha256('{"doc_id":' || doc_id || ',"lang":"' || lang || '","n_chars":' || n_chars || ',"source":"' || source || '"}') AS digest FROM documents""")
def record_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs(spark, sf_dir).select("doc_id", text.sha256_of(F.struct("doc_id", "lang", "n_chars", "source")).alias("digest"))


@query(f"""WITH h AS (SELECT doc_id, text, instr(lower(text), 'license') - 1 AS i FROM documents),
s AS (SELECT *, greatest(0, i - 60) AS a, least(length(text), i + 7 + 80) AS z FROM h WHERE i >= 0 ORDER BY doc_id LIMIT 60)
SELECT doc_id, coalesce(section_id, 30) AS section_id, i - a AS at,
  CASE WHEN a > 0 THEN '…' ELSE '' END || substr(text, a + 1, z - a) || CASE WHEN z < length(text) THEN '…' ELSE '' END AS snippet
FROM s LEFT JOIN {SECTIONS} t ON doc_id >= start_page AND (end_page IS NULL OR doc_id <= end_page)""")
def substring_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quire.functions import dims

    hits = search.substring_search(docs(spark, sf_dir), "doc_id", "text", "License")
    placed = relate.as_of(hits, "doc_id", dims.sections(spark))
    return placed.select("doc_id", F.coalesce("section_id", F.lit(30)).alias("section_id"), "at", "snippet")


@query("""WITH t AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')) AS term FROM documents)
SELECT doc_id, count(*) AS hits FROM t WHERE term IN ('apache', 'license') GROUP BY 1 HAVING count(DISTINCT term) = 2""")
def fts_and_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.match(search.inverted_index(docs(spark, sf_dir), "doc_id", "text"), "doc_id", "Apache license")


@query("""SELECT doc_id, substr(text, 1, 200) AS head, (SELECT count(*) FROM documents WHERE contains(lower(text), 'license')) AS total
  FROM documents WHERE contains(lower(text), 'license') ORDER BY doc_id LIMIT 20""")
def search_total_top20(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search_total(docs(spark, sf_dir), "doc_id", "text", "License")
