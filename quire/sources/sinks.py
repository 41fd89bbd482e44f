"""Writers; each takes what a pure DataFrame builder made."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions import text
from quire.operators import relate, search


def dataset_json(records: DataFrame, path: str) -> None:
    """One JSON record a line, in files by page range."""
    records.repartitionByRange("page").sortWithinPartitions("page").write.mode("overwrite").json(path)


def analytical_store(pages: DataFrame, chapters: DataFrame, path: str) -> None:
    """chapters, pages by chapter, and the inverted index of pages (chapter_num, page_num, content, ...)."""
    chapters.write.mode("overwrite").parquet(f"{path}/chapters")
    pages.write.mode("overwrite").partitionBy("chapter_num").parquet(f"{path}/pages")
    search.inverted_index(pages, "page_num", "content").write.mode("overwrite").parquet(f"{path}/fts_content")


def chapter_files(pages: DataFrame, separator: str = "\n\n") -> DataFrame:
    """(slug, content): pages (slug, page, body) joined in order under page headings; blank ones are dropped."""
    full = pages.filter(F.length(text.clean(F.col("body"))) >= 30)
    headed = full.withColumn("section", F.concat(F.lit("===== PAGE "), F.col("page").cast("string"), F.lit(" =====\n"), text.clean(F.col("body"))))
    return relate.ordered_text(headed, ["slug"], "page", "section", separator, "content")


def chapter_tree(pages: DataFrame, path: str) -> None:
    pages.write.mode("overwrite").partitionBy("slug").text(path)


def merged_pages(spine: DataFrame) -> DataFrame:
    """(page, content): three layers under their labels, with a note where one is missing."""
    part = lambda label, c: F.concat(F.lit(f"{label}:\n"), F.coalesce(F.nullif(text.clean(F.col(c)), F.lit("")), F.lit("[missing]")))
    return spine.select("page", F.concat_ws("\n\n", part("Arabic", "ar"), part("English", "en"), part("Indonesia", "id")).alias("content"))


def page_tree_json(pages: DataFrame) -> DataFrame:
    """(chapter_num, data): each chapter's pages as one JSON array, for a static page."""
    one = pages.groupBy("chapter_num").agg(F.array_sort(F.collect_list(F.struct("page_num", "content"))).alias("pages"))
    return one.select("chapter_num", F.to_json("pages").alias("data"))


def html_blocks(pages: DataFrame) -> DataFrame:
    """(page, paragraph, kind, html): paragraphs (page, paragraph, kind, body) as escaped HTML."""
    tag = F.when(F.col("kind").endswith("heading"), "h3").when(F.col("kind") == "grid", "pre").otherwise("p")
    inner = text.wrap_arabic(text.html_escape(F.col("body")))
    return pages.select("page", "paragraph", "kind", F.concat(F.lit("<"), tag, F.lit(">"), inner, F.lit("</"), tag, F.lit(">")).alias("html"))


def append_log(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").json(path)
