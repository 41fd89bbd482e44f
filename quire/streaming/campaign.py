"""The page campaign as a stream: a stateful fold of events, heartbeats with timers, and sinks."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from quire.operators.campaign import MOVES, TERMINAL, WORKER_STALE
from quire.sources import work
from quire.streaming import state_log

EVENT = "campaign string, seq long, ts timestamp, page int, action string, actor string"
OUT = "campaign string, seq long, page int, action string, status string, accepted boolean, reason string"


def event_stream(spark: SparkSession, path: str) -> DataFrame:
    """New JSON event files of a folder."""
    return spark.readStream.schema(EVENT).json(path)


def _apply(state: dict, total: int, seq: int, page: int, action: str, actor: str, now: float, stale: float) -> tuple[bool, str, str]:
    """One event against a campaign: the gate opens only the lowest page that is not committed, and one worker holds the lock."""
    status = state["status"].get(page, "pending")
    if not 1 <= page <= total:
        return False, status, "page out of range"
    lock = state["lock"]
    if lock and now - lock[2] > stale:
        lock = state["lock"] = None
    if action == "heartbeat":
        if not lock or lock[:2] != [page, actor]:
            return False, status, "no such lock"
        lock[2] = now
        return True, status, ""
    before, after = MOVES.get(action, ((), ""))
    if status not in before:
        return False, status, f"cannot {action or '?'} from {status}"
    if action == "claim":
        gate = next((p for p in range(1, total + 1) if state["status"].get(p, "pending") != TERMINAL), None)
        if page != gate:
            return False, status, f"the gate is at page {gate}"
        if lock:
            return False, status, f"page {lock[0]} is locked by {lock[1]}"
        state["lock"] = [page, actor, now]
        state["owner"][page] = actor
    elif action in ("start", "submit", "block") and (not lock or lock[:2] != [page, actor]):
        return False, status, "not the holder of the lock"
    elif action in ("approve", "rework") and actor == state["owner"].get(page):
        return False, status, "a reviewer must be someone else"
    if action in ("rework", "block", "commit"):
        state["lock"] = None
    state["status"][page] = after
    return True, after, ""


def _flat(state: dict) -> tuple:
    lock = state["lock"] or [None, None, None]
    pages = sorted(state["status"])
    return (pages, [state["status"][p] for p in pages], [state["owner"].get(p) for p in pages], *lock)


def stateful(events: DataFrame, total: int, stale: float = WORKER_STALE, timers: bool = False) -> DataFrame:
    """Every event with its verdict and the page's status after it.

    With timers a lock also goes, with a row of its own ("release", seq -1), once no event has come for
    stale seconds of processing time, so that it is freed without another event. Such a stream never
    runs out of work, so it is none for a trigger that stops when all is read. The gate is global to a campaign, so the campaign is the key: one campaign is one task's work, which a
    few hundred pages allow, and many campaigns spread. The lock's age is measured in event time.
    """

    def run(key: tuple, batches: Iterator[pd.DataFrame], group: GroupState) -> Iterator[pd.DataFrame]:
        state = {"status": {}, "owner": {}, "lock": None}
        if group.exists:
            pages, status, owner, *lock = group.get
            state = {"status": dict(zip(pages, status, strict=True)), "owner": dict(zip(pages, owner, strict=True)), "lock": None if lock[0] is None else list(lock)}
        out = []
        if group.hasTimedOut:
            if lock := state["lock"]:
                out.append((key[0], -1, lock[0], "release", state["status"].get(lock[0], "pending"), True, f"stale lock of {lock[1]}"))
            state["lock"] = None
        else:
            for r in pd.concat(list(batches)).sort_values("seq").itertuples():
                ok, status, reason = _apply(state, total, r.seq, r.page, r.action, r.actor, r.ts.timestamp(), stale)
                out.append((key[0], r.seq, r.page, r.action, status, ok, reason))
        group.update(_flat(state))
        if timers and state["lock"]:
            group.setTimeoutDuration(max(1, int(stale * 1000)))
        yield pd.DataFrame(out, columns=["campaign", "seq", "page", "action", "status", "accepted", "reason"])

    kept = "pages array<int>, status array<string>, owner array<string>, lock_page int, lock_actor string, beat double"
    return events.groupBy("campaign").applyInPandasWithState(run, OUT, kept, "append", GroupStateTimeout.ProcessingTimeTimeout if timers else GroupStateTimeout.NoTimeout)


def batch(events: DataFrame, total: int, stale: float = WORKER_STALE) -> DataFrame:
    """The same verdicts over a finished log."""

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        state, out = {"status": {}, "owner": {}, "lock": None}, []
        for r in pdf.sort_values("seq").itertuples():
            ok, status, reason = _apply(state, total, r.seq, r.page, r.action, r.actor, r.ts.timestamp(), stale)
            out.append((key[0], r.seq, r.page, r.action, status, ok, reason))
        return pd.DataFrame(out, columns=["campaign", "seq", "page", "action", "status", "accepted", "reason"])

    return events.groupBy("campaign").applyInPandas(run, OUT)


def append_events(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append-only log of a stream's rows; runs what is there and stops."""
    return rows.writeStream.format("json").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def replace_state(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """The latest status of each page, replaced as a whole after each batch (see state_log)."""
    return state_log.replace_latest(rows.filter("accepted").select("campaign", "page", "status", "seq"), path, checkpoint, ["campaign", "page"], "seq")


def current_state(spark: SparkSession, path: str) -> DataFrame | None:
    """(campaign, page, status, seq) as replace_state() left it; None before its first batch."""
    return state_log.StateLog(spark, path).read()


def daily_counts(spark: SparkSession, path: str, schema: str, ts: str, kind: str, name: str, checkpoint: str | None = None) -> DataFrame:
    """(day, kind, n) over a folder of Parquet files, read as a stream until nothing is left, into a memory table.

    Timestamps without zone are read as UTC. One row a day and kind is all that the table holds.
    """
    stream = spark.readStream.schema(schema).parquet(path)
    day = F.to_date(F.col(ts).cast("timestamp"))
    counts = stream.groupBy(day.alias("day"), F.col(kind).alias("kind")).agg(F.count(F.lit(1)).alias("n"))
    writer = counts.writeStream.format("memory").queryName(name).outputMode("complete").trigger(availableNow=True)
    query = writer.option("checkpointLocation", checkpoint or work.folder(spark, name)).start()
    query.awaitTermination()
    return spark.table(name)
