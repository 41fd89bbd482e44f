"""Reading tables and cutting lineage in the folder that all executors share."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import re
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Words are runs of anything but these ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
BATCH_BYTES = 8 << 20
#: Bytes of a text that are words in memory at a time.
CHUNK = 1 << 18
SMALL_RANGES = 1 << 12
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which all executors share.

    Where it is unset, a session on one machine (of a test) gets a temporary one; on a cluster that
    would be a folder of each executor's own, so there it is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir is not set: it must name a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="quire-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def save(df: DataFrame, tag: str) -> DataFrame:
    """The rows, written once as Parquet under the shared folder and read back with a fresh plan.

    Unlike cached blocks, the files outlive any executor.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(df: DataFrame) -> DataFrame:
    """df, whose rows go to Python workers in Arrow batches of BATCH_BYTES, or of one row that is larger.

    Spark's own bound, 64 MB, is held by both sides of each task, more than once. A smaller setting of the session stays.
    """
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    now = conf.get(name, None)
    if now is None or not now.rstrip("b").isdigit() or int(now.rstrip("b")) > BATCH_BYTES:
        conf.set(name, str(BATCH_BYTES))
    return df


#: What a worker keeps between its tasks, by the name of the operator that it is for.
RESIDENT: dict[str, object] = {}


def trimmed(run, keeps: str | None = None):
    """run, a generator over batches, for workers that live on between tasks and operators.

    It begins without what other operators keep in the worker, and ends by giving what it has freed
    back to the system.
    """

    @functools.wraps(run)
    def wrapped(*args):
        from quire.llm._io import RESIDENT  # the worker's own: a global would be sent along as a copy

        for name in [n for n in RESIDENT if n != keeps]:
            del RESIDENT[name]
        try:
            yield from run(*args)
        finally:
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # a system without it
                ctypes.CDLL(None).malloc_trim(0)

    return wrapped


def raw_texts(column: pa.Array) -> Iterator[memoryview]:
    """The UTF-8 bytes of each text, where the batch has them; none for null."""
    for t in column:
        yield memoryview(t.as_buffer() or b"")


def word_chunks(raw: bytes | memoryview) -> Iterator[bytes]:
    """A text in parts of about CHUNK bytes, cut before white space."""
    at = 0
    while at < len(raw):
        end = min(at + CHUNK, len(raw))
        if end < len(raw):
            gap = _SPACE.search(raw, end)
            end = gap.start() if gap else len(raw)
        yield bytes(raw[at:end])
        at = end


def ranges_of(size: int, range_bytes: int) -> int:
    """Into how many ranges so many bytes are dealt.

    A range holds range_bytes; from SMALL_RANGES on, number and size of the ranges grow alike, so that
    what one block sends to one range doesn't shrink to a row.
    """
    small = max(64, -(-size // range_bytes))
    return small if small <= SMALL_RANGES else int((small * SMALL_RANGES) ** 0.5)


def in_order(df: DataFrame, *order) -> DataFrame:
    """df range-partitioned by the columns, with `part`, which grows with the order; written, so that it stays."""
    return save(df.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "ordered")


def running_sum(df: DataFrame, key: str, order: list, value: str, name: str) -> DataFrame:
    """df with the sum of `value` up to and with each row in its key's order, whatever share of the rows one key has.

    Range partitions are summed up on their own; the totals of the earlier ones, a row for each
    partition and key, are added. Rows alike in every column are interchangeable.
    """
    cols = df.columns
    parts = in_order(df, F.col(key).asc_nulls_last(), *order)
    totals = parts.groupBy("part", key).agg(F.sum(value).alias("total_here"))
    before = W.partitionBy(key).orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(F.col("part").alias("o_part"), F.col(key).alias("o_key"), F.coalesce(F.sum("total_here").over(before), F.lit(0)).alias("offset"))
    offsets = save(offsets, "offsets")
    local = F.sum(value).over(W.partitionBy("part", key).orderBy(*order).rowsBetween(W.unboundedPreceding, 0))
    here = parts.withColumn("local_sum", local)
    on = (here["part"] == offsets["o_part"]) & here[key].eqNullSafe(offsets["o_key"])
    return here.join(offsets, on).select(*cols, (F.col("offset") + F.col("local_sum")).alias(name))


def number_rows(df: DataFrame, key: str, order: list, name: str) -> DataFrame:
    """df with a number from 1 in each key's order."""
    return running_sum(df.withColumn("one_row", F.lit(1).cast("long")), key, order, "one_row", name).drop("one_row")
