"""Full-text search: substring scan, and an inverted index with AND semantics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions import folding, text

TERM = r"(?U)[\p{L}\p{N}]+"


def substring_search(pages: DataFrame, key: str, body: str, query: str, limit: int | None = 60) -> DataFrame:
    """(key, snippet, at): the first hit of each page in page order, case ignored; queries under two characters find nothing."""
    q = query.strip().lower()
    b = F.col(body)
    at = F.instr(F.lower(b), q) - 1
    cut, place = text.snippet(b, at, F.lit(len(q)))
    hits = pages.filter((at >= 0) & F.lit(len(q) >= 2)).select(key, cut.alias("snippet"), place.alias("at"))
    return hits if limit is None else hits.orderBy(key).limit(limit)


def loose_search(pages: DataFrame, key: str, body: str, query: str) -> DataFrame:
    """(key): the pages that hold the query, whatever its case and diacritics, on either side."""
    return pages.filter(folding.contains(F.col(body), query)).select(key)


def loose_terms(pages: DataFrame, key: str, body: str) -> DataFrame:
    """(term, n_pages, n): terms grouped without case and diacritics, each under the spelling that sorts first."""
    # Texts are dealt by page, so that what is counted for each page needs no shuffle of its terms.
    rows = pages.select(key, body).repartition(key).select(key, F.explode_outer(F.regexp_extract_all(F.col(body), F.lit(TERM), F.lit(0))).alias("term")).filter("term is not null")
    each = rows.groupBy("term", key).agg(F.count(F.lit(1)).alias("n"))
    # Collations are compared once for each spelling; what meets for each page are plain strings.
    spelled = rows.select("term").distinct().groupBy(folding.loose(F.col("term")).alias("alike"))
    classes = spelled.agg(F.min("term").alias("least"), F.collect_list("term").alias("terms")).select("least", F.explode("terms").alias("of"))
    named = each.join(classes.filter("of != least"), F.col("term") == F.col("of"), "left").select(F.coalesce("least", "term").alias("term"), key, "n")
    by_page = named.groupBy("term", key).agg(F.sum("n").alias("n"))
    return by_page.groupBy("term").agg(F.count(key).alias("n_pages"), F.sum("n").alias("n"))


def search_total(pages: DataFrame, key: str, body: str, query: str, shown: int = 20, head: int = 200) -> DataFrame:
    """(key, head, total): the first pages that hold the query literally, with the number of all of them."""
    hits = pages.filter(F.lower(F.col(body)).contains(query.lower()))
    total = hits.agg(F.count(F.lit(1)).alias("total"))
    first = hits.select(key, F.substring(F.col(body), 1, head).alias("head")).orderBy(key).limit(shown)
    return first.join(F.broadcast(total))  # one row of one number


def terms(body: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.regexp_extract_all(F.lower(body), F.lit(TERM), F.lit(0))


def page_of(hits: DataFrame, order: list[Column], offset: int, size: int = 100) -> DataFrame:
    """The hits after the first offset ones, size at most."""
    return hits.orderBy(*order).offset(offset).limit(size)


def inverted_index(pages: DataFrame, key: str, body: str, fold: bool = False) -> DataFrame:
    """(term, key, positions from 0): a row for each term and page; pages bound the positions. With fold, diacritics are left out of terms.

    Texts are dealt by page, so that their terms meet where they are found. An outer generator has no filter
    inferred for it, which would cut every text into terms a second time.
    """
    dealt, own = pages.select(key, F.col(body).alias("body")).repartition(key), F.col("body")
    rows = dealt.select(key, (folding.fold(own) if fold else own).alias("body")).select(key, F.posexplode_outer(terms(F.col("body"))).alias("at", "term")).filter("term is not null")
    return rows.groupBy("term", key).agg(F.array_sort(F.collect_list("at")).alias("positions"))


def match(index: DataFrame, key: str, query: str) -> DataFrame:
    """(key, hits): pages with every term of the query."""
    import re

    wanted = sorted({w.lower() for w in re.findall(r"[^\W_]+", query)})
    rows = index.filter(F.col("term").isin(*wanted)) if wanted else index.filter(F.lit(False))
    return rows.groupBy(key).agg(F.count_distinct("term").alias("n"), F.sum(F.size("positions")).alias("hits")).filter(F.col("n") == len(wanted)).select(key, "hits")
