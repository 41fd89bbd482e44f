"""Quality rules: one threshold table, compiled into one projection of text ratios."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm._io import WORD, table

WINDOW = 8
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\f\r"

# Frequent function words of the four languages.
STOP_WORDS = (
    "the of and to in a is that it was for on are as with be this by from or an at not have "
    "der die das und in den von zu mit sich ist im nicht ein eine als auf für dem des es "
    "le la les de des et un une du en que qui est pour dans ce il au par avec sur pas "
    "el la los las de y en que un una es con por para del se no al lo su como"
)


class Rule(NamedTuple):
    """A document passes if low * per <= 100 * value <= high * per; None leaves that side open."""

    name: str
    value: str
    per: str
    low: int | None
    high: int | None


#: Percentages, so that every comparison is one of integers.
RULES = (
    Rule("length", "n_words", "one", 2_000, None),
    Rule("word_length", "word_chars", "n_words", 150, 1_500),
    Rule("symbols", "n_symbols", "n_words", None, 10),
    Rule("stop_words", "n_stop_words", "n_words", 2, None),
    Rule("repeated_lines", "n_dup_lines", "n_lines", None, 50),
    Rule("repeated_words", "n_repeat_words", "n_words", None, 30),
)


def let(value: Column, body) -> Column:
    """body(value), with value computed once although body names it often, also inside lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Number of words inside windows whose hash occurs twice or more, by sorting (hash, start)."""
    n = F.size(words)
    # slice() inside a lambda copies the whole array; single elements cost the same wherever they are.
    hashes = F.transform(F.sequence(F.lit(0), n - window), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(window)]))

    def neighbours(pairs: Column) -> Column:
        def start(p: Column, k: Column) -> Column:
            alike = lambda other: F.coalesce(F.get(pairs, other)["hash"] == p["hash"], F.lit(False))
            return F.when(alike(k - 1) | alike(k + 1), p["at"])

        return F.array_sort(F.filter(F.transform(pairs, start), lambda s: s.isNotNull()))

    def covered(starts: Column) -> Column:
        zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))
        add = lambda a, s: F.struct((a["n"] + s + window - F.greatest(a["end"], s.cast("long"))).alias("n"), (s + window).cast("long").alias("end"))
        return F.aggregate(starts, zero, add, lambda a: a["n"])

    def count(h: Column) -> Column:
        pairs = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("hash"), i.alias("at"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(covered(let(pairs, neighbours)))

    return F.when(n < window, F.lit(0).cast("long")).otherwise(let(hashes, count))


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the counts that rules name; a null text has no words, lines or symbols."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.translate(x, SPACES, "") != "")
    words = F.col("words")
    stop = STOP_WORDS.split()
    return (
        docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
        .withColumn("words", words_of(F.col("text")))
        .withColumn("lines", lines)
        .select(
            "doc_id",
            F.size(words).cast("long").alias("n_words"),
            F.length(F.translate(text, SPACES, "")).cast("long").alias("word_chars"),
            (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
            repeated_words(words).alias("n_repeat_words"),
            F.size("lines").cast("long").alias("n_lines"),
            F.size(F.filter(words, lambda w: F.lower(w).isin(sorted(set(stop))))).cast("long").alias("n_stop_words"),
            F.lit(1).cast("long").alias("one"),
        )
    )


def verdicts(measured: DataFrame, rules: tuple[Rule, ...] = RULES) -> dict[str, Column]:
    """A boolean Column for each rule of the table."""
    out = {}
    for r in rules:
        value, per = 100 * F.col(r.value), F.col(r.per)
        sides = [per * r.low <= value] * (r.low is not None) + [value <= per * r.high] * (r.high is not None)
        passed = F.lit(True)
        for side in sides:
            passed = passed & side
        out[r.name] = passed
    return out


def quality_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row's counts, base_failed, kept, and the names of the rules that it failed.

    Null and empty texts have no words and fail; repeated rows are judged one by one alike; other
    columns of docs are never read, so their names cannot clash.
    """
    measured = measures(docs, id_col, text_col)
    passed = verdicts(measured, rules)
    base = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    all_passed = F.lit(True)
    for p in passed.values():
        all_passed = all_passed & p
    failed = F.array_compact(F.array(*[F.when(~p, F.lit(name)) for name, p in passed.items()]))
    return measured.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"), (~base & all_passed).alias("kept"), F.array_join(failed, ",").alias("failed_rules"),
    )


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdicts of every row of documents.

    Null and empty texts have no words and fail; a text of any length is judged as a whole; repeated
    rows are judged alike; an empty table gives none; columns other than doc_id and text are not read.
    """
    return quality_rules(table(spark, sf_dir, "documents"))


def oracle() -> str:
    stop = ", ".join(f"'{w}'" for w in sorted(set(STOP_WORDS.split())))
    tests = []
    for r in RULES:
        sides = [f"{r.per} * {r.low} <= 100 * {r.value}"] * (r.low is not None) + [f"100 * {r.value} <= {r.per} * {r.high}"] * (r.high is not None)
        tests.append((r.name, " AND ".join(sides)))
    failed = ", ".join(f"CASE WHEN NOT ({t}) THEN '{n}' END" for n, t in tests)
    return f"""
WITH d AS (SELECT row_number() OVER () AS row_no, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS ws,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM d),
win AS (SELECT row_no, i AS pos, array_to_string(ws[i:i + {WINDOW - 1}], ' ') AS k
        FROM (SELECT row_no, ws, unnest(range(1, len(ws) - {WINDOW - 2})) AS i FROM w)),
dup AS (SELECT row_no, pos FROM (SELECT *, count(*) OVER (PARTITION BY row_no, k) AS n FROM win) WHERE n > 1),
rep AS (SELECT row_no, count(DISTINCT pos + o) AS n FROM dup, range({WINDOW}) r(o) GROUP BY row_no),
m AS (SELECT doc_id, len(ws)::BIGINT AS n_words,
        coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
        len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
        (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
        coalesce(rep.n, 0)::BIGINT AS n_repeat_words, len(ls) AS n_lines,
        len(list_filter(ws, lambda x: lower(x) IN ({stop}))) AS n_stop_words, 1 AS one
      FROM w LEFT JOIN rep USING (row_no)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND {" AND ".join(f"({t})" for _, t in tests)} AS kept,
  concat_ws(',', {failed}) AS failed_rules
FROM b
"""
