"""The daily driver: one run a day claimed beforehand, files admitted in batches, a ledger of what is done.

A day is claimed by a file that only one driver can put. A claim holds for a lease, after which another
driver may take the day over; whoever lost it is stopped at its next batch. Results go into the ledger
by the number of their batch, so a run that was killed is taken up where it stood.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession

from quire.sources.store import Store
from quire.streaming.state_log import StateLog

#: Fixed value: pages handled in one run.
BURST = 6
ENOUGH, LOST = "no more batches today", "the day was taken over"


class Days:
    """Who has which day: `day.N.claim` and its signs of life `day.N.beat.K`, and `day.done`."""

    def __init__(self, spark: SparkSession, path: str, lease: float):
        self.store, self.lease = Store(spark, path), lease

    def attempts(self, day: str) -> dict[int, float]:
        """When each claim of a day last gave a sign of life."""
        out: dict[int, float] = {}
        for name in self.store.names():
            if name.startswith(f"{day}.") and not name.endswith(".done"):
                n = int(name[len(day) + 1 :].split(".")[0])
                out[n] = max(out.get(n, 0.0), json.loads(self.store.read(name))["at"])
        return out

    def claim(self, day: str, holder: str, now: float) -> int | None:
        """The number of the claim; None if the day is done, or held by a driver that is alive, or another was faster."""
        if f"{day}.done" in self.store.names():
            return None
        before = self.attempts(day)
        if before and now - before[max(before)] <= self.lease:
            return None
        n = max(before, default=0) + 1
        return n if self.store.put(f"{day}.{n}.claim", json.dumps({"holder": holder, "at": now})) else None

    def beat(self, day: str, attempt: int, count: int, now: float) -> bool:
        """A sign of life; false if the day has been taken over."""
        if max(self.attempts(day)) != attempt:
            return False
        self.store.put(f"{day}.{attempt}.beat.{count}", json.dumps({"at": now}))
        return True

    def done(self, day: str, attempt: int) -> None:
        self.store.put(f"{day}.done", json.dumps({"attempt": attempt}))


def run_day(files: DataFrame, path: str, day: str, job: Callable[[DataFrame], DataFrame], holder: str, clock: Callable[[], float], lease: float = 3600.0, batches: int = BURST) -> int | None:
    """How many batches of a stream of files this run did; None if the day was done or is another's.

    files admits them (maxFilesPerTrigger); job turns a batch into the rows that go into the ledger at
    path. After so many batches the run ends, and the next day begins with the batch after them. A batch
    that a killed run has put into the ledger is not run again; one that it has not is.
    """
    spark = files.sparkSession
    days, ledger, did = Days(spark, f"{path}/days", lease), StateLog(spark, f"{path}/ledger"), 0
    attempt = days.claim(day, holder, clock())
    if attempt is None:
        return None

    def write(batch: DataFrame, number: int) -> None:
        nonlocal did
        known = ledger.newest()
        if known and known["writers"].get("driver", -1) >= number:
            return
        if did >= batches:
            raise RuntimeError(ENOUGH)
        if not days.beat(day, attempt, did, clock()):
            raise RuntimeError(LOST)
        rows = job(batch)
        if ledger.commit(lambda old: rows if old is None else old.unionByName(rows), "driver", number):
            did += 1

    query = files.writeStream.foreachBatch(write).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start()
    try:
        query.awaitTermination()
    except StreamingQueryException as e:
        if ENOUGH not in str(e):
            raise
    days.done(day, attempt)
    return did


def results(spark: SparkSession, path: str) -> DataFrame | None:
    """All rows that the runs so far have put into the ledger; None before the first."""
    return StateLog(spark, f"{path}/ledger").read()
