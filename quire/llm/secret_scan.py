"""Secret scans over an incremental ledger of content-addressed blobs."""

from __future__ import annotations

import hashlib
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm._io import save, table
from quire.llm.quality_rules import let


class Rule(NamedTuple):
    """Leftmost matches that do not overlap; those whose group is shorter than least are dropped."""

    kind: str
    pattern: str
    group: int
    least: int

    @property
    def version(self) -> str:
        return self.kind + "-" + hashlib.sha256(repr(tuple(self)).encode()).hexdigest()[:12]


# The three base kinds in their order.
BASE = (
    Rule("assign", r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]{12,}", 0, 16),
    Rule("hex", r"[0-9a-f]{32,}", 0, 32),
)
# Public formats of further credentials. A run too short for access or hex has no
# longer one inside it, so those two can ask for the length in the pattern.
MORE = (
    Rule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", 0, 1),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", 0, 1),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 1),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 1),
)
RULES = BASE + MORE
#: What is masked of a private key: the body too, up to the END line or, without one, over the base64 lines.
_PEM = (
    r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----(?:\s*[A-Za-z0-9-]{1,40}:[^\r\n]*){0,8}"
    r"(?:[^-]*-----END [A-Z ]{0,40}PRIVATE KEY-----|(?:(?:\\[nr]|\s){0,4}[A-Za-z0-9+/]{16,}={0,2}|[\x20\t]*\r?\n[A-Za-z0-9+/]+={0,2}[\x20\t]*(?=\r?\n|$)){0,400})"
)
MASKED = tuple(r._replace(pattern=_PEM) if r.kind == "pem" else r for r in RULES)
SPAN = "array<struct<start:bigint,rank:int,end:bigint,kind:string>>"


#: Arrays are folded so many entries at a time, as each step of a fold copies what it has gathered.
FOLD = 512
#: Code points of the segments that a text is cut into before parts of it are taken, as each taking walks from a segment's start.
SEGMENT = 4096


def _chunks(items: Column, fold) -> Column:
    """fold(number of the chunk, chunk) of each FOLD items in a row."""
    numbers = F.sequence(F.lit(0), F.greatest(F.ceil(F.size(items) / FOLD) - 1, F.lit(0)).cast("int"))
    return F.transform(numbers, lambda c: fold(c, F.slice(items, c * FOLD + 1, FOLD)))


def spans(text: Column, rule: Rule, rank: int) -> Column:
    """Where a rule matches, in code points, end exclusive.

    split() gives the texts between matches and regexp_extract_all() the matches; their lengths
    add up to the places.
    """
    pattern = F.lit(rule.pattern)
    between = F.transform(F.split(text, rule.pattern, -1), lambda x: F.length(x))
    whole = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), lambda x: F.length(x))
    judged = F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), lambda x: F.length(x))
    found = F.filter(F.arrays_zip(between.alias("gap"), whole.alias("size"), judged.alias("judged")), lambda z: z["size"].isNotNull())
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(SPAN).alias("out"))

    def span(start: Column, end: Column) -> Column:
        return F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(rule.kind).alias("kind"))

    def step(a: Column, z: Column) -> Column:
        start, end = a["at"] + z["gap"], a["at"] + z["gap"] + z["size"]
        return F.struct(end.alias("at"), F.when(z["judged"] >= rule.least, F.concat(a["out"], F.array(span(start, end)))).otherwise(a["out"]).alias("out"))

    def join(a: Column, x: Column) -> Column:
        moved = F.transform(x["out"], lambda s: span(s["start"] + a["at"], s["end"] + a["at"]))
        return F.struct((a["at"] + x["at"]).alias("at"), F.concat(a["out"], moved).alias("out"))

    chunks = let(found, lambda f: _chunks(f, lambda _, part: F.aggregate(part, zero, step)))
    return F.when(text.rlike(rule.pattern), F.aggregate(chunks, zero, join, lambda a: a["out"])).otherwise(F.array().cast(SPAN))


def address(content: Column) -> Column:
    """The name of a blob: SHA-256 of its UTF-8 bytes; null and empty contents are the same blob."""
    return F.sha2(F.coalesce(content, F.lit("")), 256)


def scan_new(versions: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES, content_col: str = "content") -> DataFrame:
    """Ledger entries (blob, versions, spans) for the blob and rule-version pairs that the ledger lacks.

    versions has a row for each historical version of each path. Equal contents meet under one
    address and are scanned once; blobs with nothing to do are dropped before the scan.
    """
    content = F.coalesce(F.col(content_col), F.lit(""))
    blobs = versions.select(address(content).alias("blob"), content.alias("content")).groupBy("blob").agg(F.first("content").alias("content"))
    todo = F.array(*[F.lit(r.version) for r in rules])
    if ledger is not None:
        seen = ledger.select(F.col("blob").alias("seen_blob"), F.explode("versions").alias("v")).groupBy("seen_blob").agg(F.collect_set("v").alias("seen"))
        blobs = blobs.join(seen, F.col("blob") == F.col("seen_blob"), "left")
        todo = F.array_except(todo, F.coalesce(F.col("seen"), F.array().cast("array<string>")))
    blobs = blobs.withColumn("versions", todo).filter(F.size("versions") > 0)
    none = F.array().cast(SPAN)
    parts = [F.when(F.array_contains("versions", r.version), spans(F.col("content"), r, k)).otherwise(none) for k, r in enumerate(rules)]
    return blobs.select("blob", "versions", F.array_sort(F.concat(*parts)).alias("spans"))


def findings(ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(found_blob, spans) of the blobs in which the rules, as they stand now, found something."""
    versions = {r.kind: r.version for r in rules}
    current = reduce(lambda a, b: a | b, [(F.col("s.kind") == k) & F.array_contains("versions", v) for k, v in versions.items()])
    rows = ledger.filter(F.size("spans") > 0).select("blob", "versions", F.explode("spans").alias("s")).filter(current)
    return rows.groupBy(F.col("blob").alias("found_blob")).agg(F.array_sort(F.collect_set("s")).alias("spans"))


def secrets_by_path(versions: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES, content_col: str = "content") -> DataFrame:
    """versions with blob and spans; a row without findings has an empty array."""
    named = versions.withColumn("blob", address(F.col(content_col)))
    found = findings(ledger, rules)
    return named.join(found, F.col("blob") == F.col("found_blob"), "left").drop("found_blob").withColumn("spans", F.coalesce("spans", F.array().cast(SPAN)))


def masked(text: Column, found: Column, mask: str = "[SECRET]") -> Column:
    """text with each run of overlapping spans replaced by mask."""

    def between(x: Column, a: Column, b: Column) -> Column:
        """Code points a to b, end exclusive."""
        i, j = F.floor(a / SEGMENT).cast("int"), F.floor(b / SEGMENT).cast("int")
        part = lambda k, at, n: F.substring(F.coalesce(F.get(x["segments"], k), F.lit("")), (at + 1).cast("int"), n.cast("int"))
        several = F.concat(part(i, a % SEGMENT, F.lit(SEGMENT)), F.array_join(F.slice(x["segments"], i + 2, j - i - 1), ""), part(j, F.lit(0), b % SEGMENT))
        return F.when(a >= b, F.lit("")).when(i == j, part(i, a % SEGMENT, b - a)).otherwise(several)

    def last(spans: Column) -> Column:
        return F.coalesce(F.array_max(F.transform(spans, lambda s: s["end"])), F.lit(0).cast("long"))

    def cut(x: Column) -> Column:
        def step(a: Column, s: Column) -> Column:
            apart = (s["start"] >= a["end"]) & ((s["start"] > a["end"]) | (a["end"] == 0))
            new = F.concat(a["out"], between(x, a["end"], s["start"]), F.lit(mask))
            return F.struct(F.when(apart, new).otherwise(a["out"]).alias("out"), F.greatest(a["end"], s["end"]).alias("end"))

        def fold(c: Column, part: Column) -> Column:
            zero = F.struct(F.lit("").alias("out"), last(F.slice(x["spans"], 1, c * FOLD)).alias("end"))
            return F.aggregate(part, zero, step, lambda a: a["out"])

        return F.concat(F.array_join(_chunks(x["spans"], fold), ""), between(x, last(x["spans"]), x["size"]))

    parts = F.struct(F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{SEGMENT}}}"), F.lit(0)).alias("segments"), found.alias("spans"), F.length(text).cast("long").alias("size"))
    return F.when(F.size(found) > 0, let(parts, cut)).otherwise(text)


def digest(found: Column, kinds: tuple[str, ...] | None = None) -> Column:
    kept = F.filter(found, lambda s: s["kind"].isin(*kinds)) if kinds else found
    return F.array_join(F.transform(kept, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first scan: the ledger is empty, every document is the only version of its own path.

    Null texts are scanned as empty ones; repeated rows each get their findings; columns other than
    doc_id and text are not read.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ledger = save(scan_new(docs, content_col="text"), "ledger")
    paths = docs.select("doc_id", address(F.col("text")).alias("blob"))
    found = save(findings(ledger), "findings")
    rows = paths.join(found, F.col("blob") == F.col("found_blob"), "left").withColumn("spans", F.coalesce("spans", F.array().cast(SPAN)))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return rows.select(
        "doc_id", *[count(r.kind).alias(f"n_{r.kind}") for r in BASE],
        F.sha2(digest(F.col("spans"), tuple(r.kind for r in BASE)), 256).alias("base_sha256"), digest(F.col("spans")).alias("spans"),
    )


def oracle() -> str:
    def found(k: int, r: Rule) -> str:
        p = r.pattern.replace("'", "''")
        return f"""SELECT no, {k} AS rank, '{r.kind}' AS kind, s, s + length(m[i]) AS e FROM (SELECT no, m, i,
      (list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0))::BIGINT AS s
    FROM (SELECT no, regexp_split_to_array(t, '{p}') AS p, regexp_extract_all(t, '{p}') AS m, unnest(range(1, len(regexp_extract_all(t, '{p}')) + 1)) AS i,
      regexp_extract_all(t, '{p}', {r.group}) AS g FROM d) WHERE length(g[i]) >= {r.least})"""

    base = ", ".join(f"'{r.kind}'" for r in BASE)
    counts = ", ".join(f"coalesce(count(*) FILTER (kind = '{r.kind}'), 0)::BIGINT AS n_{r.kind}" for r in BASE)
    return f"""
WITH d AS (SELECT row_number() OVER () AS no, doc_id, coalesce(text, '') AS t FROM documents),
f AS ({" UNION ALL ".join(found(k, r) for k, r in enumerate(RULES))})
SELECT any_value(doc_id) AS doc_id, {counts},
  sha256(coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) FILTER (kind IN ({base})), '')) AS base_sha256,
  coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank), '') AS spans
FROM d LEFT JOIN f USING (no) GROUP BY no
"""
