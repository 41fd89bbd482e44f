"""A page campaign from its events: statuses, sequence gate, locks, retries and batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quire.functions import text

TERMINAL = "committed"
# What each action needs and gives.
MOVES = {
    "claim": (("pending", "rework"), "claimed"), "start": (("claimed",), "in_progress"), "submit": (("in_progress",), "review"),
    "approve": (("review",), "approved"), "rework": (("review",), "rework"), "commit": (("approved",), "committed"),
    "block": (("claimed", "in_progress", "review", "rework"), "blocked"), "unblock": (("blocked",), "pending"),
}
WORKER_STALE, STATE_STALE, COOLDOWN_HOURS = 30 * 60, 5 * 60, 24


def move(status: Column, action: Column, actor: Column, owner: Column) -> Column:
    """The next status, or null if the action is not allowed: wrong status, or a page reviewed by its own worker."""
    out = F.lit(None).cast("string")
    for name, (before, after) in MOVES.items():
        allowed = status.isin(*before)
        if name in ("approve", "rework"):
            allowed = allowed & ~actor.eqNullSafe(owner)
        out = F.when((action == name) & allowed, F.lit(after)).otherwise(out)
    return out


def fold(events: DataFrame, key: str = "page") -> DataFrame:
    """(key, status, owner, attempts, n_refused) after all of a page's events (seq, action, actor), in order.

    Events of one page are folded in one expression; pages are independent here, and the gate across
    pages is sequence_gate().
    """
    ordered = events.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("seq", "action", "actor"))).alias("es"))
    zero = F.struct(F.lit("pending").alias("status"), F.lit(None).cast("string").alias("owner"), F.lit(0).alias("attempts"), F.lit(0).alias("n_refused"))

    def step(s: Column, e: Column) -> Column:
        new, claim = move(s["status"], e["action"], e["actor"], s["owner"]), e["action"] == "claim"
        return F.struct(
            F.coalesce(new, s["status"]).alias("status"),
            F.when(new.isNull(), s["owner"]).when(claim, e["actor"]).when(e["action"] == "unblock", F.lit(None)).otherwise(s["owner"]).alias("owner"),
            (s["attempts"] + (claim & new.isNotNull()).cast("int")).alias("attempts"),
            (s["n_refused"] + new.isNull().cast("int")).alias("n_refused"),
        )

    return ordered.select(key, F.aggregate("es", zero, step).alias("s")).select(key, "s.*")


def sequence_gate(state: DataFrame, key: str = "page", status: str = "status") -> DataFrame:
    """One row: the lowest page that is not committed, and its status; it alone may be claimed."""
    return state.filter(F.col(status) != TERMINAL).agg(F.min_by(F.struct(F.col(key).alias("page"), F.col(status).alias("status")), key).alias("g")).select("g.page", "g.status")


def latest(events: DataFrame, key: str, *order: Column) -> DataFrame:
    return events.withColumn("r", F.row_number().over(W.partitionBy(key).orderBy(*order))).filter("r = 1").drop("r")


def status_counts(state: DataFrame, status: str) -> DataFrame:
    return state.groupBy(status).agg(F.count(F.lit(1)).alias("n"))


def stale(beats: DataFrame, key: str, ts: str, now: Column, seconds: int = WORKER_STALE) -> DataFrame:
    """(key, last_beat, age): holders whose last heartbeat is older than allowed."""
    age = F.unix_micros(now) - F.unix_micros(F.col("last_beat"))
    return beats.groupBy(key).agg(F.max(F.col(ts).cast("timestamp")).alias("last_beat")).withColumn("age", (age / 1e6).cast("long")).filter(F.col("age") > seconds)


def retry_batch(state: DataFrame, key: str, now: Column, limit: int = 10) -> DataFrame:
    """(key, priority, place): failed pages due again, then half-done, then pending ones, by number; (key, status, updated)."""
    hours = (F.unix_micros(now) - F.unix_micros(F.col("updated"))) / 3.6e9
    due = (F.col("status") == "failed") & F.coalesce(hours >= COOLDOWN_HOURS, F.lit(True))
    prio = F.when(due, 0).when(F.col("status") == "raw_ocr_done", 1).when(F.col("status") == "pending", 2)
    rows = state.withColumn("priority", prio).filter("priority is not null")
    best = rows.groupBy(key).agg(F.min("priority").alias("priority")).orderBy("priority", key).limit(limit)
    return best.withColumn("place", F.row_number().over(W.partitionBy(F.lit(0)).orderBy("priority", key)))


def mark(state: DataFrame, marks: DataFrame, key: str = "page") -> DataFrame:
    """state (key, status, updated) with newer marks put in."""
    every = state.select(key, "status", "updated", F.lit(0).alias("new")).union(marks.select(key, "status", "updated", F.lit(1).alias("new")))
    return latest(every, key, F.col("new").desc(), F.col("updated").desc_nulls_last()).drop("new")


def commit_scope(commits: DataFrame, allowed: DataFrame) -> DataFrame:
    """(page, sha, outside, touched, ok): a commit (page, sha, paths) may only change its page's files and must change one; allowed is (page, paths, targets)."""
    a = allowed.select(F.col("page").alias("a_page"), F.col("paths").alias("a_paths"), "targets")
    rows = commits.join(a, F.col("page") == F.col("a_page"), "left")
    outside, touched = F.array_sort(F.array_except("paths", "a_paths")), F.array_sort(F.array_intersect("paths", "targets"))
    return rows.select("page", "sha", outside.alias("outside"), touched.alias("touched"), F.coalesce((F.size(outside) == 0) & (F.size(touched) > 0) & F.col("sha").rlike(r"^[0-9a-fA-F]{7,64}\z"), F.lit(False)).alias("ok"))


def state_errors(state: DataFrame, total: int, statuses: tuple[str, ...] = ("pending", "claimed", "in_progress", "review", "rework", "approved", "committed", "blocked")) -> DataFrame:
    """(page, error): pages missing from or beyond 1..total, and unknown statuses."""
    spine = state.sparkSession.range(1, total + 1).select(F.col("id").alias("page"))
    lost = spine.join(state.select("page"), "page", "left_anti").select("page", F.lit("missing").alias("error"))
    extra = state.filter(~F.col("page").between(1, total)).select(F.col("page").cast("long").alias("page"), F.lit("unexpected").alias("error"))
    bad = state.filter(~F.col("status").isin(*statuses)).select(F.col("page").cast("long").alias("page"), F.lit("unknown status").alias("error"))
    return lost.union(extra).union(bad)


def checklist(state: DataFrame, key: str, done: str = "committed", chunk: int = 1000) -> DataFrame:
    """(part, lines, done, total): lines "[x] page" in order, chunk pages in a row, so that no row grows with the campaign; parts follow on each other."""
    line = F.concat(F.when(F.col("status") == done, "- [x] ").otherwise("- [ ] "), F.col(key).cast("string"))
    parts = state.groupBy(F.floor(F.col(key) / chunk).alias("part"))
    got = parts.agg(F.array_sort(F.collect_list(F.struct(F.col(key).alias("k"), line.alias("line")))).alias("ls"), F.count_if(F.col("status") == done).alias("done"), F.count(F.lit(1)).alias("total"))
    return got.select("part", F.array_join(F.transform("ls", lambda x: x["line"]), "\n").alias("lines"), "done", "total")


def remaining_calls(total: Column, done: Column, per_call: int = 3) -> Column:
    """Calls that the pages left will take."""
    return F.ceil((total - done) / per_call)


WORKABLE = ("claimed", "in_progress", "rework")


def work_packets(state: DataFrame, files: DataFrame, worker: str) -> DataFrame:
    """(page, packet) for the pages (page, status, owner, attempts) that a worker holds in a workable status; files are (page, layer, content), null where there is no draft."""
    held = state.filter((F.col("owner") == worker) & F.col("status").isin(*WORKABLE))
    drafts = files.groupBy(F.col("page").alias("f_page")).pivot("layer", ["ar", "en", "id"]).agg(F.first("content"))
    name = text.page_name(F.col("page"))
    paths = F.struct(*[F.concat(F.lit(folder), name).alias(k) for k, folder in (("source", "ocr/enriched/"), ("english", "ocr/enriched_en/"), ("indonesian", "ocr/enriched_id/"))])
    rows = held.join(drafts, F.col("page") == F.col("f_page"), "left")
    packet = F.struct(F.lit(worker).alias("worker_id"), "page", F.col("attempts").alias("attempt"), "status", paths.alias("paths"), F.col("ar").alias("source_text"), F.col("en").alias("english_draft"), F.col("id").alias("indonesian_draft"))
    return rows.select("page", packet.alias("packet"))


def tail(events: DataFrame, n: int, *order: Column) -> DataFrame:
    """The last n events; order is from the last to the first."""
    return events.orderBy(*order).limit(n)
