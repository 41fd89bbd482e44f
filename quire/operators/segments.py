"""An inverted index kept up by changes: segments of postings, tombstones of pages, merges by size.

Inserted, deleted and updated pages make one new segment with the postings of their own terms and a
tombstone for each page that had older ones. Which segments there are stands in a manifest that is put
once, so readers and other writers always meet a whole index.
"""

from __future__ import annotations

import json
import math
import uuid
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators import search
from quire.sources.store import Store

#: So many segments of like size are merged into one, so that each posting is written again a logarithm of times.
FANOUT = 4
SMALLEST = 1 << 10


class SegmentedIndex:
    """Terms of pages (key, body). Each segment has a number: a page's postings count unless a later segment has a tombstone for it."""

    def __init__(self, spark: SparkSession, path: str, key: str = "page_num", body: str = "content", key_type: str = "long"):
        self.spark, self.path, self.key, self.body, self.key_type = spark, path.rstrip("/"), key, body, key_type
        self.store = Store(spark, f"{self.path}/manifests")

    def segments(self) -> tuple[int, list[dict]]:
        """Version and segments {name, first, last, rows} of the newest manifest; a merged one covers the numbers from first to last."""
        names = [n for n in self.store.names() if n.endswith(".json")]
        if not names:
            return -1, []
        return int(names[-1].split(".")[0]), json.loads(self.store.read(names[-1]))

    def _put(self, version: int, segments: list[dict]) -> bool:
        return self.store.put(f"{version:012d}.json", json.dumps(segments))

    def _read(self, segments: list[dict], kind: str, schema: str) -> DataFrame:
        out = self.spark.createDataFrame([], f"{schema}, number long")
        for s in segments:
            out = out.unionByName(self.spark.read.schema(schema).parquet(f"{self.path}/{s['name']}/{kind}").withColumn("number", F.lit(s["last"]).cast("long")))
        return out

    def _alive(self, segments: list[dict]) -> DataFrame:
        """Postings with their segment's number, without those of pages with a later tombstone.

        Within a segment postings are never older than its tombstones.
        """
        postings = self._read(segments, "postings", f"term string, {self.key} {self.key_type}, positions array<int>")
        gone = self._read(segments, "tombstones", f"{self.key} {self.key_type}").groupBy(F.col(self.key).alias("gone")).agg(F.max("number").alias("until"))
        return postings.join(gone, (F.col(self.key) == F.col("gone")) & (F.col("number") < F.col("until")), "left_anti")

    def postings(self) -> DataFrame:
        """(term, key, positions), as search.inverted_index() makes them of the pages as they are now."""
        return self._alive(self.segments()[1]).drop("number")

    def apply(self, changes: DataFrame, tries: int = 10) -> None:
        """changes (op, key, body): insert, update and delete, one a page; rows of other pages are not read.

        An update of a page that there is not inserts it, an insert of one that there is replaces it.
        """
        op = F.lower("op")
        name = f"segment-{uuid.uuid4().hex}"
        new = search.inverted_index(changes.filter(op.isin("insert", "update")), self.key, self.body)
        new.repartitionByRange("term").sortWithinPartitions("term").write.parquet(f"{self.path}/{name}/postings")
        changes.select(F.col(self.key).cast(self.key_type).alias(self.key)).distinct().write.parquet(f"{self.path}/{name}/tombstones")
        rows = self.spark.read.parquet(f"{self.path}/{name}/postings").count()
        for _ in range(tries):
            version, segments = self.segments()
            number = max((s["last"] for s in segments), default=-1) + 1
            if self._put(version + 1, [*segments, {"name": name, "first": number, "last": number, "rows": rows}]):
                self.merge()
                return
        raise RuntimeError(f"{self.path}: another writer was faster {tries} times")

    def sweep(self, keep: int = 1) -> int:
        """Removes manifests before the last `keep`, and every segment that none left names; how many went. For a time without writers and readers."""
        names = [n for n in self.store.names() if n.endswith(".json")]
        for name in names[:-keep]:
            self.store.remove(name)
        named = {s["name"] for n in names[-keep:] for s in json.loads(self.store.read(n))}
        every = Store(self.spark, self.path)
        lost = [f for f in every.folders() if f.startswith("segment-") and f not in named]
        for f in lost:
            every.remove(f)
        return len(lost)

    def merge(self) -> bool:
        """Merges runs of FANOUT neighbours of like size until there is none; false if another writer was faster, which then merges."""
        while True:
            version, segments = self.segments()
            run = _run(segments)
            if not run:
                return True
            a, b = run
            old, first = segments[a:b], a == 0
            name = f"segment-{uuid.uuid4().hex}"
            alive = self._alive(old).drop("number")
            alive.repartitionByRange("term").sortWithinPartitions("term").write.parquet(f"{self.path}/{name}/postings")
            # Tombstones still speak for older segments; where there is none, they have done their work.
            gone = self._read(old, "tombstones", f"{self.key} {self.key_type}").select(self.key).distinct()
            (gone.limit(0) if first else gone).write.parquet(f"{self.path}/{name}/tombstones")
            rows = self.spark.read.parquet(f"{self.path}/{name}/postings").count()
            merged = {"name": name, "first": old[0]["first"], "last": old[-1]["last"], "rows": rows}
            if not self._put(version + 1, [*segments[:a], merged, *segments[b:]]):
                return False


def _run(segments: list[dict]) -> tuple[int, int] | None:
    """FANOUT neighbours of one class of size (powers of FANOUT), the smallest class first; neighbours alone, so that numbers stay in order."""
    classes = [max(0, int(math.log(max(s["rows"], 1) / SMALLEST, FANOUT))) if s["rows"] > SMALLEST else 0 for s in segments]
    found: dict[int, tuple[int, int]] = defaultdict(tuple)
    at = 0
    while at < len(classes):
        end = at
        while end < len(classes) and classes[end] == classes[at]:
            end += 1
        if end - at >= FANOUT:
            found.setdefault(classes[at], (at, end))
        at = end
    return found[min(found)] if found else None
