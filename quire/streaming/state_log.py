"""State that is replaced as a whole: numbered manifests, each put once, name the table that is current.

A writer that dies between any two steps leaves the last manifest in force: tables are written under new
names, and one takes effect only by its manifest, which no other writer can have put under that number.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from quire.sources.store import Store


class Conflict(RuntimeError):
    """Others were faster each time."""


class StateLog:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.store = spark, path.rstrip("/"), Store(spark, f"{path.rstrip('/')}/manifests")

    def newest(self) -> dict | None:
        """The manifest with the highest number among those that can be read whole; None before the first."""
        for name in reversed([n for n in self.store.names() if n.endswith(".json")]):
            try:
                found = json.loads(self.store.read(name))
                if isinstance(found, dict) and {"version", "table", "writers", "schema"} <= found.keys():
                    return found
            except ValueError:
                continue
        return None

    def read(self, manifest: dict | None = None) -> DataFrame | None:
        """The state as of a manifest, the newest if none is named; None before the first. Its table is never changed by later writers."""
        found = manifest or self.newest()
        return found and self.spark.read.schema(found["schema"]).parquet(f"{self.path}/{found['table']}")

    def commit(self, make: Callable[[DataFrame | None], DataFrame], writer: str = "", batch: int | None = None, tries: int = 10) -> bool:
        """Replaces the state by make(state); false if this writer's batch, or a later one, is in it already.

        If another writer was faster, make runs again on what that one put. Tables of lost attempts stay until sweep().
        """
        for _ in range(tries):
            now = self.newest()
            if batch is not None and now and now["writers"].get(writer, -1) >= batch:
                return False
            table = f"table-{uuid.uuid4().hex}"
            new = make(self.read(now) if now else None)
            new.write.parquet(f"{self.path}/{table}")
            version = now["version"] + 1 if now else 0
            writers = (now["writers"] if now else {}) | ({} if batch is None else {writer: batch})
            manifest = {"version": version, "table": table, "writers": writers, "schema": ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new.schema)}
            if self.store.put(f"{version:012d}.json", json.dumps(manifest)):
                return True
        raise Conflict(f"{self.path}: {tries} attempts, and another writer was faster each time")

    def sweep(self, keep: int = 2) -> int:
        """Removes manifests before the last `keep`, and every table that none left names; how many tables went.

        For a time when no writer and no reader of older states is at work.
        """
        names = [n for n in self.store.names() if n.endswith(".json")]
        for name in names[:-keep]:
            self.store.remove(name)
        named = {json.loads(self.store.read(n))["table"] for n in names[-keep:]}
        tables = Store(self.spark, self.path)
        lost = [t for t in tables.folders() if t.startswith("table-") and t not in named]
        for t in lost:
            tables.remove(t)
        return len(lost)


def latest_of(new: DataFrame, old: DataFrame | None, keys: list[str], order: str) -> DataFrame:
    """Each key's row with the highest order, of both."""
    both = new if old is None else new.unionByName(old)
    rest = [c for c in new.columns if c not in keys]
    best = both.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("best"))
    return best.select(*keys, *[F.col(f"best.`{c}`").alias(c) for c in rest])


def replace_latest(rows: DataFrame, path: str, checkpoint: str, keys: list[str], order: str, writer: str = "stream") -> StreamingQuery:
    """Keeps each key's latest row of a stream as one state; a batch that is run again after a stop is taken once."""

    def write(batch: DataFrame, number: int) -> None:
        StateLog(batch.sparkSession, path).commit(lambda old: latest_of(batch, old, keys, order), writer, number)

    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
