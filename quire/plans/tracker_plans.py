"""The tracker's stream over the event table, with SQL that walks the same events one by one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import dims
from quire.plans.registry import query
from quire.sources import work
from quire.sources.scan import table
from quire.streaming import tracker

RAW = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
ACTION = """CASE event_type WHEN 'signup' THEN 'claim' WHEN 'click' THEN 'submit' WHEN 'view' THEN CASE WHEN event_id % 3 = 0 THEN 'heartbeat' ELSE 'start' END
    WHEN 'purchase' THEN CASE WHEN event_id % 2 = 0 THEN 'approve' ELSE 'commit' END
    ELSE CASE event_id % 4 WHEN 0 THEN 'rework' WHEN 1 THEN 'block' WHEN 2 THEN 'unblock' ELSE 'reclaim' END END"""
#: So many users work on one campaign, without and with leases, so that campaigns grow with the table; they call each other w0 to w2.
USERS = {False: 40, True: 160}
FIELDS = f"""CAST(floor(user_id / USERS) AS BIGINT) AS campaign, event_id AS seq, CASE WHEN event_id % 7 = 0 THEN 1 + CAST(event_id % 5 AS INT) END AS page, {ACTION} AS action,
  concat('w', CAST(user_id % 3 AS VARCHAR(1))) AS actor, event_id % 11 < 8 AS flag, CASE WHEN event_id % 5 = 0 THEN CAST(event_id % 40 AS INT) END AS token, event_id % 29 = 0 AS crashed"""


def walked(leases: bool) -> str:
    """Verdicts by a recursive query: a step takes the next event of each campaign."""
    held, crashed, token = ("held IS NOT NULL", "crashed", "token <> own") if leases else ("false", "false", "false")
    gone = "worker IS NOT NULL AND us - beat >= 1800000000" if leases else "false"
    freed = "held IS NOT NULL AND us - held > 300000000" if leases else "false"
    end = (
        """UNION ALL SELECT campaign, NULL, beat + 1800000000, 'expire', gate, 'blocked', true, 'no heartbeat', own FROM last WHERE worker IS NOT NULL AND beat + 1800000000 <= (SELECT max(us) FROM e)
    UNION ALL SELECT campaign, NULL, held + 300000000, 'unlock', NULL, NULL, true, 'state lock', NULL FROM last WHERE held + 300000000 < (SELECT max(us) FROM e)
    UNION ALL SELECT campaign, NULL, expired, 'expire', e_page, 'blocked', true, 'no heartbeat', e_own FROM r WHERE expired IS NOT NULL
    UNION ALL SELECT campaign, NULL, unlocked, 'unlock', NULL, NULL, true, 'state lock', NULL FROM r WHERE unlocked IS NOT NULL"""
        if leases
        else ""
    )
    return f"""WITH RECURSIVE e AS (SELECT {FIELDS.replace('USERS', str(USERS[leases]))}, epoch_us(ts) AS us, row_number() OVER (PARTITION BY floor(user_id / {USERS[leases]}) ORDER BY ts, event_id) AS n FROM events),
done AS (SELECT list(2 * r_regionkey + 1) AS pages FROM region),
r AS (SELECT DISTINCT campaign, 0::BIGINT AS n, 2::INT AS gate, 'pending'::VARCHAR AS status, NULL::VARCHAR AS owner, NULL::VARCHAR AS worker, NULL::BIGINT AS beat, 0::INT AS own, NULL::BIGINT AS held,
    NULL::BIGINT AS seq, NULL::BIGINT AS us, NULL::VARCHAR AS action, NULL::INT AS page, NULL::VARCHAR AS seen, NULL::VARCHAR AS reason, NULL::BIGINT AS expired, NULL::INT AS e_page, NULL::INT AS e_own, NULL::BIGINT AS unlocked, NULL::INT AS o_token FROM e
  UNION ALL
  SELECT campaign, n,
    CASE WHEN ok AND action = 'commit' THEN list_filter(range(gate + 1, gate + 12), lambda x: NOT list_contains(pages, x))[1]::INT ELSE gate END,
    CASE WHEN NOT ok OR action = 'heartbeat' THEN status WHEN action = 'commit' THEN 'pending' ELSE after END,
    CASE WHEN ok AND action = 'claim' THEN actor WHEN ok AND action = 'commit' THEN NULL ELSE owner END,
    CASE WHEN ok AND action = 'claim' THEN actor WHEN ok AND action IN ('block', 'reclaim', 'commit') THEN NULL ELSE worker END,
    CASE WHEN ok AND action IN ('claim', 'heartbeat') THEN us ELSE beat END, own + (ok AND action = 'claim')::INT,
    CASE WHEN reason = 'crashed' THEN us ELSE held END, seq, us, action, page,
    CASE WHEN ok AND action <> 'heartbeat' THEN after ELSE p_status END, reason, expired, e_page, e_own, unlocked, (own + (ok AND action = 'claim')::INT)
  FROM (SELECT *, reason IN ('', 'forced') AS ok, CASE action WHEN 'claim' THEN 'claimed' WHEN 'start' THEN 'in_progress' WHEN 'submit' THEN 'review' WHEN 'approve' THEN 'approved' WHEN 'rework' THEN 'rework' WHEN 'unblock' THEN 'pending'
      WHEN 'commit' THEN 'committed' ELSE 'blocked' END AS after
    FROM (SELECT *, CASE WHEN {held} THEN 'state lock is held' WHEN {crashed} THEN 'crashed'
        WHEN action = 'claim' THEN CASE WHEN worker IS NOT NULL THEN 'busy' WHEN page <> gate THEN 'not the gate' WHEN p_status IN ('pending', 'rework') THEN '' ELSE 'gate is ' || p_status END
        WHEN action IN ('start', 'heartbeat', 'submit', 'block', 'commit') THEN CASE WHEN action = 'submit' AND NOT flag THEN 'validator failed' WHEN NOT locked OR actor <> worker THEN 'not the holder' WHEN {token} THEN 'stale token'
          WHEN action = 'heartbeat' OR action = 'start' AND p_status IN ('claimed', 'rework') OR action = 'submit' AND p_status = 'in_progress' OR action = 'block' AND p_status IN ('claimed', 'in_progress', 'review', 'rework')
            OR action = 'commit' AND p_status = 'approved' THEN '' ELSE 'page is ' || p_status END
        WHEN action IN ('approve', 'rework') THEN CASE WHEN NOT locked THEN 'not locked' WHEN p_status <> 'review' THEN 'page is ' || p_status WHEN action = 'approve' AND actor = owner AND NOT flag THEN 'independent review required' ELSE '' END
        WHEN action = 'unblock' THEN CASE WHEN worker IS NOT NULL THEN 'busy' WHEN page <> gate THEN 'not the gate' WHEN p_status = 'blocked' THEN '' ELSE 'page is ' || p_status END
        WHEN NOT locked THEN 'no lock' WHEN flag THEN 'forced' WHEN us - beat >= 1800000000 THEN '' ELSE 'lock is not stale' END AS reason
      FROM (SELECT *, worker IS NOT NULL AND page = gate AS locked, CASE WHEN page = gate THEN status WHEN page < gate OR list_contains(pages, page) THEN 'committed' ELSE 'pending' END AS p_status
        FROM (SELECT e.campaign, e.n, e.seq, e.us, e.action, e.actor, e.flag, e.token, e.crashed, coalesce(e.page, r.gate) AS page, r.gate, r.owner, r.own, d.pages,
            CASE WHEN {gone} THEN 'blocked' ELSE r.status END AS status, CASE WHEN {gone} THEN NULL ELSE r.worker END AS worker, r.beat, CASE WHEN {freed} THEN NULL ELSE r.held END AS held,
            CASE WHEN {gone} THEN r.beat + 1800000000 END AS expired, CASE WHEN {gone} THEN r.gate END AS e_page, CASE WHEN {gone} THEN r.own END AS e_own, CASE WHEN {freed} THEN r.held + 300000000 END AS unlocked
          FROM (SELECT campaign, n, gate, status, owner, worker, beat, own, held FROM r) r JOIN e ON e.campaign = r.campaign AND e.n = r.n + 1 CROSS JOIN done d))))),
last AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY campaign ORDER BY n DESC) = 1)
SELECT campaign, seq, us, action, page, seen AS status, reason IN ('', 'forced') AS accepted, reason, o_token AS token FROM r WHERE n > 0 {end}"""


def run(spark: SparkSession, sf_dir: str, leases: bool) -> DataFrame:
    events = spark.readStream.schema(RAW).parquet(f"{sf_dir}/events.parquet*")
    fields = FIELDS.replace("VARCHAR(1)", "STRING").replace("USERS", str(USERS[leases]))
    rows = events.selectExpr("CAST(ts AS TIMESTAMP) AS ts", *_split(fields))
    # Each campaign begins with the odd pages up to nine committed.
    campaigns = table(spark, sf_dir, "events").selectExpr(f"CAST(floor(user_id / {USERS[leases]}) AS BIGINT) AS campaign").distinct()
    odd = table(spark, sf_dir, "region").select((2 * F.col("r_regionkey") + 1).cast("int").alias("page"))
    first = campaigns.select("campaign", F.explode(F.sequence(F.lit(1), F.lit(9), F.lit(2))).alias("page")).join(odd, "page", "left_semi")
    first = first.select("campaign", "page", F.lit("committed").alias("status"), F.lit(None).cast("string").alias("owner"))
    path = work.folder(spark, "verdicts")
    tracker.logged(tracker.verdicts(rows, dims.TOTAL_PAGES, first, leases), path, work.folder(spark, "tracker")).awaitTermination()
    return spark.read.schema(tracker.VERDICT).parquet(path)


def _split(fields: str) -> list[str]:
    """The select list's items: commas within brackets don't end one."""
    out, depth = [""], 0
    for c in fields:
        depth += (c == "(") - (c == ")")
        if c == "," and not depth:
            out.append("")
        else:
            out[-1] += c
    return out


@query(walked(False))
def stream_tracker(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event's verdict by gate, lock and review, from a stream that begins with some pages committed."""
    return run(spark, sf_dir, leases=False)


@query(walked(True))
def stream_leases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As stream_tracker, with locks that run out after 30 and 5 minutes of event time, fencing tokens, and actors that die holding the state lock."""
    return run(spark, sf_dir, leases=True)
