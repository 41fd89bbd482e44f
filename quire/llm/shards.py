"""Sharding by balanced label propagation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm._io import number_rows, running_sum, save, table

SHARDS = 24
SEED = 42


def _quotas(spark: SparkSession, rows: int, shards: int) -> DataFrame:
    """(q_shard, quota): one row a shard."""
    return spark.range(shards).select(F.col("id").cast("int").alias("q_shard"), (F.lit(rows // shards) + (F.col("id") < rows % shards).cast("long")).alias("quota"))


def _propagate(linked: DataFrame, rows: int, shards: int) -> tuple[DataFrame, int]:
    """One round: linked (with group and shard) after the moves that quotas admit, and how many wanted to move.

    A group's members in one shard move together or stay. They look at where most of their
    neighbours are, among shards with room; requests for a shard are granted in the order of the
    links that they save, as long as their running sum stays within the shard's room.
    """
    spark = linked.sparkSession
    held = save(linked.groupBy("group", "shard").agg(F.count(F.lit(1)).alias("n")), "held")
    used = held.groupBy(F.col("shard").alias("u_shard")).agg(F.sum("n").alias("used"))
    quotas = _quotas(spark, rows, shards)
    room = quotas.join(used, F.col("q_shard") == F.col("u_shard"), "left").select("q_shard", (F.col("quota") - F.coalesce("used", F.lit(0))).alias("room"))
    room = save(room, "room")  # a row a shard, so it may be broadcast
    seen = held.join(F.broadcast(room), F.col("shard") == F.col("q_shard")).drop("q_shard")
    # A shard without room for the smallest part of a group neither draws its others nor gives up its own.
    least = seen.groupBy(F.col("group").alias("l_group")).agg(F.min("n").alias("least"), F.count(F.lit(1)).alias("parts"))
    open_ = seen.join(least, F.col("group") == F.col("l_group")).filter((F.col("parts") > 1) & (F.col("room") >= F.col("least")))
    target = open_.groupBy(F.col("group").alias("t_group")).agg(F.max(F.struct("n", F.xxhash64("group", "shard").alias("tie"), "shard")).alias("t"))
    wish = open_.join(target, F.col("group") == F.col("t_group")).select("group", "shard", "n", F.col("t.shard").alias("target"), (F.col("t.n") - F.col("n")).alias("gain")).filter("shard != target")
    # What can never fit asks for nothing: in the running sum it would shut out all that come after it.
    wish = wish.join(F.broadcast(room), F.col("target") == F.col("q_shard")).filter("n <= room").drop("q_shard", "room")
    wish = save(wish, "wish")
    wanted = wish.count()
    if not wanted:
        return linked, 0
    ahead = running_sum(wish, "target", [F.col("gain").desc(), F.col("group"), F.col("shard")], "n", "ahead")
    granted = ahead.join(F.broadcast(room), F.col("target") == F.col("q_shard")).filter(F.col("ahead") <= F.col("room"))
    granted = save(granted.select(F.col("group").alias("m_group"), F.col("shard").alias("m_shard"), "target"), "granted")
    on = (F.col("group") == F.col("m_group")) & (F.col("shard") == F.col("m_shard"))
    moved = linked.join(granted, on, "left").withColumn("shard", F.coalesce("target", "shard")).drop("m_group", "m_shard", "target")
    return save(moved, "linked"), granted.count()


def assign(members: DataFrame, shards: int = SHARDS, rounds: int | None = None, seed: int = SEED) -> DataFrame:
    """members with shard and slot; members has id and group, and documents of one group are linked.

    Counts of rows differ by one at most. Rows start in the shard of a hash; linked ones propagate
    labels until no move is granted (or for so many rounds); each move makes one of two parts of a
    group, so that this ends. Then each shard keeps its quota, linked rows first, and the rest, in the order of
    groups, fills what is left free. Slots count on from 0 in every shard. A group larger than a
    shard is spread. Null groups link nothing; repeated rows are rows of their own.
    """
    spark, cols = members.sparkSession, members.columns
    start = F.pmod(F.xxhash64(F.lit(seed), "id", "group"), F.lit(shards)).cast("int")
    labelled = members.withColumn("shard", F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(shards)).cast("int"))
    labelled = labelled.withColumn("shard", F.when(F.col("id").isNull(), start).otherwise(F.col("shard")))
    sizes = members.groupBy(F.col("group").alias("s_group")).agg(F.count(F.lit(1)).alias("in_group"))
    sizes = save(sizes.filter("s_group is not null and in_group > 1").select("s_group"), "groups")
    labelled = save(labelled.join(sizes, F.col("group") == F.col("s_group"), "left").withColumn("is_linked", F.col("s_group").isNotNull()).drop("s_group"), "labelled")
    rows = labelled.count()
    linked, moves, done = labelled.filter("is_linked"), 1, 0
    while moves and (rounds is None or done < rounds):
        linked, moves = _propagate(linked, rows, shards)
        done += 1
    every = linked.unionByName(labelled.filter("not is_linked"))
    quotas = _quotas(spark, rows, shards)
    held = save(number_rows(every, "shard", [F.col("is_linked").desc(), F.col("group").asc_nulls_last(), F.col("id").asc_nulls_last()], "no"), "numbered")
    judged = held.join(F.broadcast(quotas), F.col("shard") == F.col("q_shard"))
    stay = judged.filter("no <= quota").select(*cols, "shard", (F.col("no") - 1).alias("slot"))
    count = held.groupBy(F.col("shard").alias("c_shard")).agg(F.count(F.lit(1)).alias("here"))
    free = quotas.join(count, F.col("q_shard") == F.col("c_shard"), "left").select("q_shard", F.coalesce("here", F.lit(0)).alias("here"), F.greatest(F.col("quota") - F.coalesce("here", F.lit(0)), F.lit(0)).alias("free"))
    free = free.select(F.struct("q_shard", "here", "free").alias("f")).agg(F.array_sort(F.collect_list("f")).alias("f"))  # one entry a shard
    ends = F.transform("f", lambda x, i: F.struct(x["q_shard"].alias("to_shard"), x["here"].alias("here"), (F.aggregate(F.slice("f", 1, i + 1), F.lit(0).cast("long"), lambda a, y: a + y["free"])).alias("end"), x["free"].alias("free")))
    free = save(free.select(F.explode(ends).alias("e")).select("e.*"), "free")
    over = judged.filter("no > quota").select(*cols, F.lit(0).alias("all_rows"))
    dealt = number_rows(over, "all_rows", [F.col("group").asc_nulls_last(), F.col("id").asc_nulls_last()], "nth")
    goes = (F.col("nth") > F.col("end") - F.col("free")) & (F.col("nth") <= F.col("end"))
    placed = dealt.join(F.broadcast(free), goes).select(*cols, F.col("to_shard").alias("shard"), (F.col("here") + F.col("nth") - (F.col("end") - F.col("free")) - 1).alias("slot"))
    return stay.unionByName(placed)


def op5_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of equal texts are linked (null: no text, and null texts are linked with each other).

    Null and empty texts have the size 8; repeated rows are rows of their own; null ids are placed
    by their group; an empty table gives no rows; columns other than doc_id and text are not read.
    """
    docs = table(spark, sf_dir, "documents")
    text = F.coalesce(F.col("text"), F.lit(""))
    group = F.concat(F.col("text").isNull().cast("string"), F.lit(":"), F.sha2(text, 256))
    size = F.octet_length(text).cast("long") + 8
    members = save(docs.select(F.col("doc_id").alias("id"), group.alias("group"), size.alias("size"), F.crc32(text).alias("text_crc32")), "members")
    rows = assign(members)
    return rows.select(
        F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("rows").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
