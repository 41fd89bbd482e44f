"""Joins, windows and set operations over pages, layers and dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


#: Rows up to which a dimension of ranges goes to every task.
SMALL_DIM = 100_000


def as_of(pages: DataFrame, page: str, dim: DataFrame, start: str = "start_page", end: str = "end_page") -> DataFrame:
    """pages with the columns of the dimension's row whose range holds them; ranges do not overlap, and pages in none get nulls.

    A dimension of SMALL_DIM rows at most, which is checked, is broadcast into a range join. A larger one is
    joined through the order of both: each page looks back to the last start at or before it.
    """
    if dim.limit(SMALL_DIM + 1).count() <= SMALL_DIM:
        inside = (F.col(page) >= F.col(start)) & (F.col(end).isNull() | (F.col(page) <= F.col(end)))
        return pages.join(F.broadcast(dim), inside, "left")
    # Cells of equal length around the mean distance of starts: a range goes to the cells that it touches.
    low, high, n = dim.agg(F.min(start), F.max(start), F.count(F.lit(1))).first()
    width = max(1, (int(high) - int(low)) // int(n))
    cell = lambda c: F.floor(c.cast("double") / width).cast("long")
    last = F.lit(pages.agg(F.max(page)).first()[0])
    until = F.least(F.coalesce(F.col(end), last), last)
    cells = dim.filter(until >= F.col(start)).withColumn("dim_cell", F.explode(F.sequence(cell(F.col(start)), cell(until))))
    on = (cell(F.col(page)) == F.col("dim_cell")) & (F.col(page) >= F.col(start)) & (F.col(end).isNull() | (F.col(page) <= F.col(end)))
    return pages.join(cells, on, "left").drop("dim_cell")


def dense(spine: DataFrame, key: str, layers: dict[str, DataFrame], default: str = "") -> DataFrame:
    """Every key of the spine with one text column for each layer (key, body); what is missing is the default."""
    for name, layer in layers.items():
        one = layer.select(F.col(layer.columns[0]).alias(f"{name}_key"), F.col(layer.columns[1]).alias(name))
        spine = spine.join(one, F.col(key) == F.col(f"{name}_key"), "left").drop(f"{name}_key").withColumn(name, F.coalesce(name, F.lit(default)))
    return spine


def pending(every: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return every.join(done.select(key).distinct(), key, "left_anti")


def among(every: DataFrame, some: DataFrame, key: str) -> DataFrame:
    return every.join(some.select(key).distinct(), key, "left_semi")


def restore(new: DataFrame, old: DataFrame, key: str, column: str) -> DataFrame:
    """new with nulls of a column filled from old."""
    before = old.select(F.col(key).alias("old_key"), F.col(column).alias("old_value"))
    return new.join(before, F.col(key) == F.col("old_key"), "left").withColumn(column, F.coalesce(column, "old_value")).drop("old_key", "old_value")


def override(base: DataFrame, over: DataFrame, key: str) -> DataFrame:
    """Full outer union of keys in which over's values win."""
    o = over.select(*[F.col(c).alias(f"o_{c}") for c in over.columns])
    joined = base.join(o, F.col(key) == F.col(f"o_{key}"), "full")
    return joined.select(*[F.coalesce(f"o_{c}", c).alias(c) if c in over.columns else F.col(c) for c in base.columns])


def overlay(records: DataFrame, patches: DataFrame, key: str, field: str) -> DataFrame:
    """records whose `text` struct has one field replaced where a patch (key, value) exists."""
    p = patches.select(F.col(patches.columns[0]).alias("patch_key"), F.col(patches.columns[1]).alias("patch"))
    joined = records.join(p, F.col(key) == F.col("patch_key"), "left")
    new = F.when(F.col("patch").isNotNull(), F.col("text").withField(field, F.col("patch"))).otherwise(F.col("text"))
    return joined.withColumn("text", new).drop("patch_key", "patch")


def version_delta(before: DataFrame, after: DataFrame, key: str, value: str) -> DataFrame:
    """(key, was, now, change) over two versions: added, removed, changed or same."""
    b, a = before.select(key, F.col(value).alias("was")), after.select(key, F.col(value).alias("now"))
    change = F.when(F.col("was").isNull(), "added").when(F.col("now").isNull(), "removed").when(F.col("was") != F.col("now"), "changed").otherwise("same")
    return b.join(a, key, "full").withColumn("change", change)


def bucket_delta(was: Column, now: Column) -> Column:
    """Counts of findings before and after: clean, now clean, cleaner, unchanged or worse."""
    return (
        F.when((was == 0) & (now == 0), "clean").when((was > 0) & (now == 0), "now clean").when(now < was, "cleaner")
        .when(now == was, "unchanged").otherwise("worse")
    )


def contiguity(pages: DataFrame, key: str) -> DataFrame:
    """One row: lowest, highest, rows, distinct, whether they are just lowest..highest once each."""
    k = F.col(key)
    return pages.agg(F.min(k).alias("lowest"), F.max(k).alias("highest"), F.count(k).alias("n"), F.count_distinct(k).alias("n_distinct")).withColumn(
        "contiguous", (F.col("n") == F.col("n_distinct")) & (F.col("highest") - F.col("lowest") + 1 == F.col("n"))
    )


def missing(pages: DataFrame, key: str, low: int, high: int) -> DataFrame:
    return pages.sparkSession.range(low, high + 1).select(F.col("id").alias(key)).join(pages.select(key).distinct(), key, "left_anti")


def first_by(rows: DataFrame, key: list[str], *order: Column) -> DataFrame:
    """One row for each key, the first in order."""
    return rows.withColumn("row_rank", F.row_number().over(W.partitionBy(*key).orderBy(*order))).filter("row_rank = 1").drop("row_rank")


def set_difference(a: Column, b: Column) -> tuple[Column, Column]:
    """(missing, extra), sorted."""
    return F.array_sort(F.array_except(a, b)), F.array_sort(F.array_except(b, a))


def ordered_text(rows: DataFrame, key: list[str], order: str, value: str, separator: str, name: str) -> DataFrame:
    """Values of a key in order, as one string; the caller knows that one key's values fit a row."""
    got = rows.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(value).alias("v")))).alias("vs"))
    return got.select(*key, F.array_join(F.transform("vs", lambda x: x["v"]), separator).alias(name))


def nearest_block(figures: DataFrame, blocks: DataFrame, page: str) -> DataFrame:
    """Figures (page, after_block) at their block, or at the page's last one."""
    last = blocks.groupBy(page).agg(F.max("block").alias("last_block"))
    at = figures.join(last, page).withColumn("block", F.least("after_block", "last_block"))
    return at.join(blocks, [page, "block"], "left")


def place_figures(figures: DataFrame, blocks: DataFrame, page: str) -> DataFrame:
    """(page, place from 1, figure, block): blocks (page, block from 0) in order, with each figure (page, figure, after_block) where it is shown.

    A figure stands behind its block, or the page's last one if there are fewer; a negative one stands
    before the first. On a page without blocks there is nothing to stand behind: only such figures are shown.
    """
    last = blocks.groupBy(F.col(page).alias("l_page")).agg(F.max("block").alias("last_block"))
    shown = figures.join(last, F.col("page") == F.col("l_page"), "left").filter((F.col("after_block") < 0) | F.col("last_block").isNotNull())
    behind = F.when(F.col("after_block") < 0, F.lit(-1)).otherwise(F.least("after_block", "last_block"))
    both = blocks.select(F.col(page).cast("long").alias("page"), F.lit(None).cast("int").alias("figure"), F.col("block").cast("int").alias("block"), F.col("block").cast("int").alias("behind")).unionByName(
        shown.select(F.col("page").cast("long").alias("page"), "figure", F.lit(None).cast("int").alias("block"), behind.cast("int").alias("behind"))
    )
    order = W.partitionBy("page").orderBy("behind", F.col("figure").asc_nulls_first())
    return both.withColumn("place", F.row_number().over(order)).select("page", "place", "figure", "block")
