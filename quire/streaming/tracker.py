"""The page tracker as a stateful stream: sequence gate, worker lock, independent review, leases with fencing tokens.

State is kept by campaign: a value for the gate and the locks, a map for the pages that an event has
touched. It may begin from a table of pages, and leases run out by event time under a watermark.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from quire.operators.campaign import STATE_STALE, TERMINAL, WORKER_STALE

#: page null: the gate's. flag: the validator's verdict of a submission, an allowed self review, a forced reclaim.
#: token: what the worker was granted, where it says so. crashed: the actor died holding the state lock.
EVENT = "campaign long, seq long, ts timestamp, page int, action string, actor string, flag boolean, token int, crashed boolean"
VERDICT = "campaign long, seq long, us long, action string, page int, status string, accepted boolean, reason string, token int"
PAGE = "campaign long, page int, status string, owner string"
#: Statuses in which a page is being worked on.
ACTIVE = ("claimed", "in_progress", "review", "rework")
PROVIDER = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


class Campaign:
    """What a campaign has come to; pages are looked up one by one."""

    def __init__(self, pages, total: int, head: tuple | None):
        self.pages, self.total = pages, total
        self.gate, self.worker, self.beat, self.token, self.held = head or (0, None, None, 0, None)
        if not head:
            self.advance()

    def head(self) -> tuple:
        return self.gate, self.worker, self.beat, self.token, self.held

    def advance(self) -> None:
        """The gate goes to the next page that is not committed, or behind the last."""
        self.gate += 1
        while self.gate <= self.total and self.record(self.gate)[0] == TERMINAL:
            self.gate += 1

    def record(self, page: int) -> tuple:
        return self.pages.getValue((page,)) or ("pending", None, 0)

    def put(self, page: int, status: str, owner: str | None, attempts: int) -> None:
        self.pages.updateValue((page,), (status, owner, attempts))

    def expire(self, at: int) -> Iterator[tuple]:
        """Locks that have run out by the time `at`, in microseconds: a worker's page is blocked, as if its lock were reclaimed."""
        if self.held is not None and at - self.held > STATE_STALE * 10**6:
            yield (None, self.held + STATE_STALE * 10**6, "unlock", None, None, True, "state lock", None)
            self.held = None
        if self.worker is not None and at - self.beat >= WORKER_STALE * 10**6:
            due, (_, owner, attempts) = self.beat + WORKER_STALE * 10**6, self.record(self.gate)
            self.put(self.gate, "blocked", owner, attempts)
            self.worker = None
            yield (None, due, "expire", self.gate, "blocked", True, "no heartbeat", self.token)

    def next_due(self) -> int | None:
        """The first microsecond at which a lock runs out."""
        due = [self.held + STATE_STALE * 10**6 + 1] if self.held is not None else []
        due += [self.beat + WORKER_STALE * 10**6] if self.worker is not None else []
        return min(due, default=None)

    def verdict(self, e, leases: bool) -> tuple[int, str, bool, str]:
        """(page, status, accepted, reason) of an event, which takes effect if it is accepted."""
        page = self.gate if pd.isna(e.page) else int(e.page)
        if not 1 <= page <= self.total:
            return page, "", False, "done" if e.action == "claim" and pd.isna(e.page) else "no such page"
        status, owner, attempts = self.record(page)
        if leases and self.held is not None:
            return page, status, False, "state lock is held"
        if leases and e.crashed is True:
            self.held = int(e.us)
            return page, status, False, "crashed"
        if reason := self.refusal(e, page, status, owner, leases):
            return page, status, False, reason
        flagged = e.flag is True
        if e.action == "claim":
            self.worker, self.beat, self.token, owner, attempts = e.actor, int(e.us), self.token + 1, e.actor, attempts + 1
        elif e.action == "heartbeat":
            self.beat = int(e.us)
            return page, status, True, ""
        elif e.action in ("block", "reclaim", "commit"):
            self.worker = None
        status = {"claim": "claimed", "start": "in_progress", "submit": "review", "approve": "approved", "rework": "rework", "block": "blocked", "unblock": "pending", "commit": TERMINAL, "reclaim": "blocked"}[e.action]
        self.put(page, status, owner, attempts)
        if status == TERMINAL:
            self.advance()
        return page, status, True, "forced" if e.action == "reclaim" and flagged else ""

    def refusal(self, e, page: int, status: str, owner: str | None, leases: bool) -> str:
        locked, flagged = self.worker is not None and page == self.gate, e.flag is True
        if e.action == "claim":
            if self.worker is not None:
                return "busy"
            if page != self.gate:
                return "not the gate"
            return "" if status in ("pending", "rework") else f"gate is {status}"
        if e.action in ("start", "heartbeat", "submit", "block", "commit"):
            if e.action == "submit" and not flagged:
                return "validator failed"
            if not locked or e.actor != self.worker:
                return "not the holder"
            if leases and not pd.isna(e.token) and int(e.token) != self.token:
                return "stale token"
            allowed = {"start": ("claimed", "rework"), "heartbeat": (status,), "submit": ("in_progress",), "block": ACTIVE, "commit": ("approved",)}[e.action]
            return "" if status in allowed else f"page is {status}"
        if e.action in ("approve", "rework"):
            if not locked:
                return "not locked"
            if status != "review":
                return f"page is {status}"
            return "independent review required" if e.action == "approve" and e.actor == owner and not flagged else ""
        if e.action == "unblock":
            if self.worker is not None:
                return "busy"
            if page != self.gate:
                return "not the gate"
            return "" if status == "blocked" else f"page is {status}"
        if e.action == "reclaim":
            if not locked:
                return "no lock"
            return "" if flagged or int(e.us) - self.beat >= WORKER_STALE * 10**6 else "lock is not stale"
        return "no such action"


class Tracker(StatefulProcessor):
    """One campaign's events in the order of time; those of one micro-batch are sorted in the task that has the campaign."""

    def __init__(self, total: int, leases: bool, retain_ms: int | None):
        self.total, self.leases, self.retain_ms = total, leases, retain_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.head = handle.getValueState("head", "gate int, worker string, beat long, token int, held long")
        self.timer = handle.getValueState("timer", "due long")
        self.pages = handle.getMapState("pages", "page int", "status string, owner string, attempts int", self.retain_ms)

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        for r in initialState.itertuples():
            self.pages.updateValue((int(r.page),), (r.status, r.owner, 0))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        now, out = Campaign(self.pages, self.total, self.head.get()), []
        for e in pd.concat(list(rows)).sort_values(["us", "seq"]).itertuples():
            if self.leases:
                out += now.expire(int(e.us))
            page, status, ok, reason = now.verdict(e, self.leases)
            out.append((int(e.seq), int(e.us), e.action, page, status, ok, reason, now.token))
        yield self.settled(key, now, out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = Campaign(self.pages, self.total, self.head.get())
        self.timer.clear()
        # All that the watermark has passed at once: a timer set now for one of them would wait for the next batch.
        out = list(now.expire(max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs()) * 1000))
        yield self.settled(key, now, out)

    def settled(self, key, now: Campaign, out: list[tuple]) -> pd.DataFrame:
        self.head.update(now.head())
        due = now.next_due() if self.leases else None
        due = None if due is None else -(-due // 1000)
        known = self.timer.get()
        if known and known[0] != due:
            self.handle.deleteTimer(known[0])
            self.timer.clear()
        if due is not None and not (known and known[0] == due):
            self.handle.registerTimer(due)
            self.timer.update((due,))
        names = [c.split()[0] for c in VERDICT.split(", ")][1:]
        found = pd.DataFrame(out, columns=names).astype({"seq": "Int64", "page": "Int32", "token": "Int32"})
        found.insert(0, "campaign", key[0])
        return found

    def close(self) -> None:
        pass


def verdicts(events: DataFrame, total: int, pages: DataFrame | None = None, leases: bool = False, delay: str = "0 seconds", retain_ms: int | None = None) -> DataFrame:
    """A verdict for each event of a stream, and with leases a row for each lock that ran out by event time.

    pages is where campaigns begin (campaign, page, status, owner); what it leaves out is pending. With
    leases, a worker's lock runs out 30 minutes and the state lock 5 minutes after its last sign of
    life: at the next event or, when none comes, by a timer once the watermark has passed. Each grant
    raises the campaign's token, and whoever writes with an older one is refused. Events behind the
    watermark are dropped by the engine. retain_ms forgets pages not written for so long, by the clock;
    the engine has either that or timers of event time, and such a stream never runs out of work, so it
    takes a trigger that goes on instead of logged(). One campaign is one key, since its gate is global.
    """
    if leases and retain_ms:
        raise ValueError("pages are kept for a time by the clock, leases run by event time: choose one")
    rows = events.withColumn("us", F.unix_micros("ts"))
    rows = rows.withWatermark("ts", delay) if leases else rows
    mode = "eventTime" if leases else "processingTime" if retain_ms else "none"
    first = None if pages is None else pages.select("campaign", "page", "status", "owner").groupBy("campaign")
    return rows.groupBy("campaign").transformWithStateInPandas(Tracker(total, leases, retain_ms), VERDICT, "append", mode, initialState=first)


@contextlib.contextmanager
def rocks(spark: SparkSession):
    """Queries started within keep their state in RocksDB, which maps, timers and times to live need; the session's own setting comes back."""
    before = spark.conf.get(PROVIDER[0], None)
    spark.conf.set(*PROVIDER)
    try:
        yield
    finally:
        spark.conf.unset(PROVIDER[0]) if before is None else spark.conf.set(PROVIDER[0], before)


def logged(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Verdicts appended to a table of Parquet files, until all input is read."""
    with rocks(rows.sparkSession):
        return rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
