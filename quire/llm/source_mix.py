"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quire.llm._io import WORD, number_rows, save, table

WEIGHTS = (5, 2, 1)
#: The mix's size as a share of all sizes, in halves: 3 halves are 150%.
SHARE_HALVES = 3
MOST_COPIES = 2
SEED = 42


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share_halves: int = SHARE_HALVES, most: int = MOST_COPIES) -> DataFrame:
    """(source, source_size, target) from (source, size) rows.

    Weights repeat over the sources by code point, null last. A target stops at `most` times its
    source's size; filling up sources in the order of that limit for each unit of weight gives
    the level at which nothing more overflows. One row a source is all that the windows without a
    key see.
    """
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    one = F.lit(0)
    by_name = W.partitionBy(one).orderBy(F.col("source").asc_nulls_last())
    s = sizes.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("rank", F.row_number().over(by_name))
    s = s.withColumn("weight", weight).withColumn("cap", most * F.col("source_size"))
    filling = W.partitionBy(one).orderBy(F.col("cap") / F.col("weight"), "rank")
    every = W.partitionBy(one)
    s = s.withColumns({
        "whole": share_halves * F.sum("source_size").over(every) / 2,
        "caps_before": F.coalesce(F.sum("cap").over(filling.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)),
        "weight_left": F.sum("weight").over(filling.rowsBetween(0, W.unboundedFollowing)),
    })
    s = s.withColumn("capped", F.col("cap") * F.col("weight_left") <= (F.col("whole") - F.col("caps_before")) * F.col("weight"))
    capped = F.sum(F.when(F.col("capped"), F.col("cap")).otherwise(0)).over(every)
    free = F.sum(F.when(F.col("capped"), 0).otherwise(F.col("weight"))).over(every)
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(F.col("weight") * (F.col("whole") - capped) / free)
    return s.select("source", "source_size", target.alias("target"))


def offset_of(source: Column, seed: int = SEED) -> Column:
    """The one random offset of a source, in [0, 1): 32 bits of a digest of seed and source."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.concat(F.lit("="), source), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / 4294967296.0


def mix(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, share_halves: int = SHARE_HALVES, most: int = MOST_COPIES, seed: int = SEED) -> DataFrame:
    """(id, source, size) rows with source_size, target, copies and taken = copies * size.

    A document's expected copies are target / source_size. Running sums of them within a source,
    from the largest document down, plus the source's offset, cross an integer once for each
    copy. Neighbours in that order differ little, so the words taken stay near the target: the
    error is below the largest size. Ties go by id, so that reruns agree; rows alike in all three
    columns are interchangeable. A source without words has target 0 and no copies.
    """
    targets = save(source_targets(rows, weights, share_halves, most), "targets")
    numbered = number_rows(rows.select("id", "source", "size"), "source", [F.col("size").desc(), F.col("id").asc_nulls_last()], "no")
    t = targets.withColumnRenamed("source", "t_source")
    ratio = F.col("target") / F.nullif(F.col("source_size"), F.lit(0))
    crossed = lambda k: F.floor(offset_of(F.col("source"), seed) + k * ratio)
    copies = F.coalesce(crossed(F.col("no")) - crossed(F.col("no") - 1), F.lit(0)).cast("long")
    return (
        numbered.join(t, F.col("source").eqNullSafe(F.col("t_source")))
        .withColumn("copies", copies)
        .select("id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))
    )


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null and empty texts have size 0; null sources are one source, the last; rows alike in all columns
    are interchangeable; an empty table gives no rows; columns other than doc_id, text and source are not read.
    """
    docs = table(spark, sf_dir, "documents")
    rows = save(docs.select(F.col("doc_id").alias("id"), "source", word_count(F.col("text")).alias("size")), "sizes")
    return mix(rows).select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def oracle() -> str:
    return f"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM d GROUP BY source),
w AS (SELECT *, {list(WEIGHTS)}[((rank - 1) % {len(WEIGHTS)}) + 1] AS weight, {MOST_COPIES} * source_size AS cap,
        {SHARE_HALVES} * (sum(source_size) OVER ())::DOUBLE / 2 AS whole FROM s),
f AS (SELECT *, coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS caps_before,
        sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weight_left
      FROM w WINDOW o AS (ORDER BY cap / weight, rank)),
g AS (SELECT *, cap * weight_left <= (whole - caps_before) * weight AS capped FROM f),
t AS (SELECT source, source_size, CASE WHEN capped THEN cap::DOUBLE ELSE
        weight * (whole - sum(CASE WHEN capped THEN cap ELSE 0 END) OVER ()::DOUBLE)
          / sum(CASE WHEN capped THEN 0 ELSE weight END) OVER ()::DOUBLE END AS target FROM g),
n AS (SELECT d.*, source_size, target, target / nullif(source_size, 0)::DOUBLE AS ratio,
        row_number() OVER (PARTITION BY d.source ORDER BY size DESC, doc_id NULLS LAST) AS no,
        ('0x' || substr(md5('{SEED}:' || coalesce('=' || d.source, '')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  (coalesce(floor(u + no * ratio) - floor(u + (no - 1) * ratio), 0)::BIGINT * size)::BIGINT AS taken
FROM n
"""
