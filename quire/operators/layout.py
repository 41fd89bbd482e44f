"""Lines, paragraphs, tables and tokens of a page's body."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quire.functions import chars, text

# Glyphs of grids, ornaments, and line shapes.
GRID_GLYPHS = "☩۞۩○●□■▢∆▲▽▼"
ORNAMENTS = "❖※⁂"
PAGE_NUMBER = r"^[—\-–]\s*[0-9]+\s*[—\-–]\z"
SECTION_HEAD = r"^[(（]\s*(?:Section|Chapter|الفصل|الباب|The\s)"
FOLIO_LINE = r"^(?:[—–-]\s*[0-9]+\s*[—–-]|\(\s*[0-9]+\s*\))\z"
PIPE_ROW = r"^[^\n]*\|[^\n]*\|[^\n]*\z"
PIPE_SEPARATOR = r"^\s*\|?[\s:|-]*-[\s:|-]*\|?\s*\z"
DIAGRAM = r"^\[(?:Inside|Around|Outside|Top|Bottom|Grid\s+contents|Table\s+containing|Geometric\s+figure|Letter-string)"
HEADING = r"^(?:## |(?:Chapter|Section|Part)\b[^.\n]{0,80}\z)"


def line_kind(line: Column) -> Column:
    """Class of a stripped line; the order of the tests matters."""
    words = F.size(F.filter(F.split(line, r"\s+", -1), lambda w: w != ""))
    return (
        F.when(line == "", "blank").when(line.rlike(PAGE_NUMBER), "page_number").when(line.rlike(f"^[{ORNAMENTS}]"), "ornament_heading")
        .when(line.rlike(SECTION_HEAD), "section_heading").when(line.rlike(r"^[0-9]{1,3}\z"), "short_num")
        .when(line.rlike(f"[{GRID_GLYPHS}]") & (F.length(line) > 5), "grid").when(line.rlike(r"^[0-9\s]{8,}\z") & (F.length(line) > 10), "grid")
        .when(words <= 3, "short_line").otherwise("prose")
    )


def lines(pages: DataFrame, key: str, body: str) -> DataFrame:
    """(key, line_no from 0, line, kind)."""
    split = pages.select(F.col(key), F.posexplode(F.split(text.clean(F.col(body)), "\n", -1)).alias("line_no", "raw"))
    return split.select(key, "line_no", text.strip(F.col("raw")).alias("line")).withColumn("kind", line_kind(F.col("line")))


def is_grid_art(line: Column, least: int = 20) -> Column:
    """A line drawn of glyphs: so many of the set or more."""
    return F.regexp_count(line, F.lit(f"[{GRID_GLYPHS}]")) >= least


def _closes(line: Column) -> Column:
    """A line after which a new paragraph begins: it ends a sentence and has more than four words."""
    words = F.size(F.filter(F.split(line, r"\s+", -1), lambda w: w != ""))
    return line.rlike(r"[.!?:،؛]\s*\z") & (words > 4)


def paragraphs(classed: DataFrame, key: str) -> DataFrame:
    """(key, paragraph from 1, kind, body): lines joined over gaps and islands.

    Blank lines and page numbers end a paragraph, lone numbers are skipped, headings stand alone,
    grid rows stay together, and prose runs on unless the line before it closes.
    """
    flat = F.when(F.col("kind").isin("prose", "short_line"), "prose").otherwise(F.col("kind"))
    rows = classed.withColumn("shape", flat).filter("kind != 'short_num'")
    order = W.partitionBy(key).orderBy("line_no")
    rows = rows.withColumns({"was": F.lag("shape").over(order), "above": F.lag("line").over(order)})
    alone = F.col("shape").isin("section_heading", "ornament_heading")
    new = F.col("was").isNull() | (F.col("was") != F.col("shape")) | alone | ((F.col("shape") == "prose") & _closes(F.col("above")))
    rows = rows.withColumn("island", F.sum(new.cast("int")).over(order.rowsBetween(W.unboundedPreceding, 0)))
    rows = rows.filter(~F.col("shape").isin("blank", "page_number"))
    joined = rows.groupBy(key, "island", "shape").agg(F.array_sort(F.collect_list(F.struct("line_no", "line"))).alias("ls"))
    body = F.array_join(F.transform("ls", lambda x: x["line"]), " ")
    number = F.row_number().over(W.partitionBy(key).orderBy("island"))
    return joined.select(key, number.alias("paragraph"), F.col("shape").alias("kind"), body.alias("body"))


def page_paragraphs(pages: DataFrame, key: str, body: str) -> DataFrame:
    """paragraphs() of whole pages, inside each page's own row: nothing is exchanged.

    A paragraph begins at a place that depends on a line and the one before it alone, so the places
    are filtered and the lines between two of them are cut out.
    """
    rows = pages.select(F.col(key), F.transform(F.split(text.clean(F.col(body)), "\n", -1), text.strip).alias("raw"))
    rows = rows.select(key, F.filter(F.transform("raw", lambda x: F.struct(x.alias("line"), line_kind(x).alias("kind"))), lambda r: r["kind"] != "short_num").alias("rs"))
    rows = rows.select(key, F.transform("rs", lambda r: F.struct(r["line"], F.when(r["kind"].isin("prose", "short_line"), "prose").otherwise(r["kind"]).alias("shape"))).alias("rs"))

    def begins(r: Column, i: Column) -> Column:
        above = F.get("rs", i - 1)
        alone = r["shape"].isin("section_heading", "ornament_heading")
        return F.when((i == 0) | alone | (above["shape"] != r["shape"]) | ((r["shape"] == "prose") & _closes(above["line"])), i)

    starts = F.filter(F.transform("rs", begins), lambda i: i.isNotNull())
    rows = rows.select(key, "rs", starts.alias("at"))

    def cut(i: Column, k: Column) -> Column:
        until = F.coalesce(F.get("at", k + 1), F.size("rs"))
        lines_ = F.transform(F.slice("rs", i + 1, until - i), lambda r: r["line"])
        return F.struct(F.get("rs", i)["shape"].alias("kind"), F.array_join(lines_, " ").alias("body"))

    found = F.filter(F.transform("at", cut), lambda p: ~p["kind"].isin("blank", "page_number"))
    return rows.select(key, F.posexplode(found).alias("n", "p")).select(key, (F.col("n") + 1).alias("paragraph"), "p.kind", "p.body")


def segments(pages: DataFrame, key: str, body: str) -> DataFrame:
    """(key, segment from 1, is_table, n_lines): runs of table rows and of other lines between blank lines."""
    rows = lines(pages, key, body).withColumn("is_table", is_pipe_row(F.col("line")))
    order = W.partitionBy(key).orderBy("line_no")
    was = F.lag(F.struct(F.col("line") == "", "is_table")).over(order)
    new = was.isNull() | (was != F.struct(F.col("line") == "", "is_table"))
    rows = rows.withColumn("island", F.sum(new.cast("int")).over(order.rowsBetween(W.unboundedPreceding, 0))).filter("line != ''")
    runs = rows.groupBy(key, "island", "is_table").agg(F.count(F.lit(1)).alias("n_lines"))
    return runs.select(key, F.row_number().over(W.partitionBy(key).orderBy("island")).alias("segment"), "is_table", "n_lines")


def is_pipe_row(line: Column) -> Column:
    return line.rlike(PIPE_ROW) & ~line.startswith("[Letter-string:")


def is_separator(line: Column) -> Column:
    return line.rlike(PIPE_SEPARATOR) & line.contains("-")


def cells(row: Column) -> Column:
    inner = F.regexp_replace(text.strip(row), r"^\||\|\z", "")
    return F.transform(F.split(inner, r"\|", -1), text.strip)


def table_rows(body: Column) -> Column:
    """Rows of cells of a pipe table; separators are left out and ragged rows filled up."""
    rows = F.transform(F.filter(F.split(body, "\n", -1), lambda x: is_pipe_row(x) & ~is_separator(x)), cells)
    sized = lambda rs: F.struct(rs.alias("rows"), F.array_max(F.transform(rs, lambda r: F.size(r))).alias("width"))
    filled = lambda t: F.transform(t["rows"], lambda r: F.concat(r, F.array_repeat(F.lit(""), t["width"] - F.size(r))))
    return chars.let(chars.let(rows, sized), filled)


def verse_halves(line: Column) -> Column:
    return F.split(line, r"\s*\*\s*", -1)


def block_kind(block: Column, index: Column, page: Column) -> Column:
    """Class of a whole block."""
    rows = F.filter(F.transform(F.split(block, "\n", -1), text.strip), lambda x: x != "")
    first, one = F.get(rows, F.lit(0)), F.size(rows) == 1
    verses = F.size(F.filter(rows, lambda x: x.contains(" * ")))
    return (
        F.when(F.size(rows) == 0, "empty").when((index == 0) & one & (page >= 8) & first.rlike(FOLIO_LINE), "folio")
        .when(one & (first == "[NO VISIBLE TEXT]"), "blank_notice").when(F.forall(rows, is_pipe_row), "table")
        .when(first.rlike(r"^\[Row\s+[0-9]+\]\z") & ~one, "names_row")
        .when(first.rlike(DIAGRAM) | first.startswith("Text transcribed ") | first.startswith("Picture of "), "diagram")
        .when(page.isin(2, 4, 6, 7), "imprint").when(one & (first == "*"), "asterisk").when(one & first.startswith("❖"), "ornament")
        .when(one & first.rlike(HEADING), "heading").when(verses >= 2, "verse").otherwise("prose")
    )


def tokens(body: Column) -> Column:
    """Words without the syntax of tables: separator rows go and bars are spaces."""
    rows = F.transform(F.split(body, "\n", -1), lambda x: F.when(is_separator(x), "").when(is_pipe_row(x), F.replace(x, F.lit("|"), F.lit(" "))).otherwise(x))
    return F.regexp_extract_all(F.array_join(rows, "\n"), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))


def first_difference(a: Column, b: Column) -> Column:
    """Index from 0 of the first place where two arrays differ, null if they are equal."""
    zipped = F.zip_with(a, b, lambda x, y: x.eqNullSafe(y))
    return F.nullif(F.array_position(zipped, F.lit(False)), F.lit(0)) - 1


def fill_forward(rows: DataFrame, key: str, order: str, value: str, name: str) -> DataFrame:
    """The last value that is not null up to each row."""
    return rows.withColumn(name, F.last(value, ignorenulls=True).over(W.partitionBy(key).orderBy(order).rowsBetween(W.unboundedPreceding, 0)))
