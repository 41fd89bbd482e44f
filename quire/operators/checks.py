"""Checks and audits; all report (rule, page, layer, severity, other_page, metric, detail)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions import chars, dims, text, udf
from quire.functions.folio import folio
from quire.operators import blocks, duplicates
from quire.sources import work

MIN_CHECKED = {"copy": 60, "duplicate": 200, "language": 100, "short": 40}


def finding(rows: DataFrame, rule: str, when: Column, *, severity: str = "error", other: Column | None = None, metric: Column | None = None, detail: Column | None = None) -> DataFrame:
    """Rows (page, layer, ...) on which a rule holds, in the shape of findings."""
    null = lambda c, kind: (c if c is not None else F.lit(None)).cast(kind)
    return rows.filter(when).select(
        F.lit(rule).alias("rule"), F.col("page").cast("long").alias("page"), "layer", F.lit(severity).alias("severity"),
        null(other, "long").alias("other_page"), null(metric, "double").alias("metric"), null(detail, "string").alias("detail"),
    )


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def by_lang(layer: Column, test) -> Column:
    """test(lang) for rows of the two target layers."""
    return F.when(layer == "en", test("en")).when(layer == "id", test("id"))


def untranslated(body: Column) -> Column:
    """(longest, total, sample, kind) of Arabic runs: prose from four letters on, else grid cells."""
    found = chars.runs(body, chars.ARABIC_BLOCK)
    most = chars.longest(found)
    sample = F.get(F.filter(found, lambda r: F.length(r) == most), F.lit(0))
    return F.struct(most.alias("longest"), chars.total(found).alias("total"), sample.alias("sample"), F.when(most == 0, "none").when(most >= 4, "prose").otherwise("cells").alias("kind"))


def foreign(body: Column) -> Column:
    """Counts of characters that no target may hold, by kind."""
    kinds = chars.FOREIGN_SCRIPTS | {"U+FFFD replacement": chars.REPLACEMENT, "control": chars.CONTROL}
    return F.map_filter(F.map_from_arrays(F.array(*map(F.lit, kinds)), F.array(*[chars.count(body, c) for c in kinds.values()])), lambda _, n: n > 0)


def foreign_places(rows: DataFrame, key: str, body: str) -> DataFrame:
    """(key, at from 0, ch, kind) of each such character."""
    kinds = chars.FOREIGN_SCRIPTS | {"U+FFFD replacement": chars.REPLACEMENT, "control": chars.CONTROL}
    kind = F.coalesce(*[F.when(F.col("ch").rlike(f"[{c}]"), n) for n, c in kinds.items()])
    some = F.col(body).rlike("[" + "".join(kinds.values()) + "]")
    return rows.filter(some).select(key, F.posexplode(F.split(F.col(body), "")).alias("at", "ch")).withColumn("kind", kind).filter("kind is not null")


def letters(source: Column) -> Column:
    """Letters of the Arabic block, digits and marks excluded."""
    return F.regexp_count(source, F.lit(f"[{chars.ARABIC_BLOCK}&&\\p{{L}}]"))


def too_short(body: Column, n_letters: Column) -> Column:
    return (n_letters > 200) & (F.length(body).cast("double") / F.nullif(n_letters, F.lit(0)) < 0.25)


def truncated(body: Column, profile: str = "worker") -> Column:
    """A marker of text left out; "worker" does not look at unreadable cells."""
    t = F.replace(body, F.lit("[?]"), F.lit("")) if profile == "worker" else body
    return t.rlike(text.TRUNCATION[profile])


def digit_shrink(source: Column, body: Column) -> Column:
    """mirrors source, declared unclear, or suspect: by the longest run of digits."""
    longest = lambda t: chars.longest(chars.runs(t, chars.DIGITS))
    return F.when(longest(body) >= F.floor(longest(source) / 2), "mirrors source").when(body.contains("[UNCLEAR"), "declared unclear").otherwise("suspect")


def degenerate(pages: DataFrame, key: str, body: str) -> DataFrame:
    """(key, kind, n_unclear, n_letters) of sources where one of four or more lines is over half of all; prose that repeats is meant."""
    top = duplicates.top_line(pages, key, body).withColumnRenamed(key, "top_key").filter("n_lines >= 4 and 2 * top_count > n_lines")
    rows = pages.join(top, F.col(key) == F.col("top_key"))
    n = chars.count(F.col(body), chars.ARABIC_BLOCK)
    kind = F.when(text.strip(F.col("top")).startswith("["), "unclear-marker").otherwise("repeated-glyph")
    out = rows.select(key, kind.alias("kind"), F.regexp_count(F.col(body), F.lit(r"\[\?\]")).alias("n_unclear"), n.alias("n_letters"), "top_count")
    return out.filter("not (kind = 'repeated-glyph' and n_letters > 40 * top_count)").drop("top_count")


def work_class(source: Column, target: Column, lang: Column) -> Column:
    """DONE, MARKER, OCR-FAIL, GRID or TRANSLATE."""
    n, symbols = letters(source), chars.symbol_count(source)
    return (
        F.when(text.strip(target).isin(*dims.BLANK_MARKERS.values()), "DONE")
        .when(source.rlike(text.BLANK_NOTE) & (F.length(source) < 200), "MARKER")
        .when(F.regexp_count(source, F.lit(r"\[\?\]")) > 200, "OCR-FAIL")
        .when((symbols > n) & (n < 60), "GRID")
        .when(F.lower(target).contains("grid content preserved") | F.lower(target).contains("[grid content"), "GRID")
        .otherwise("TRANSLATE")
    )


def accept_enriched(raw: Column, enriched: Column) -> Column:
    """The enriched text if it is half to three times as long as the raw one, else the raw one."""
    n = F.length(raw)
    return F.when((F.length(enriched) >= 0.5 * n) & (F.length(enriched) <= 3 * n), enriched).otherwise(raw)


def coverage(body: Column, lang: str, folded: bool = False) -> Column:
    """real, empty, placeholder or not-translation-like; folded tells that white space is folded already."""
    b = body if folded else text.fold_space(body)
    real = F.lit(True) if lang == "ar" else text.is_translation_like(b, lang)
    return F.when(b == "", "empty").when(b.rlike(text.PLACEHOLDER), "placeholder").when(real, "real").otherwise("not-translation-like")


def copy_forward(pages: DataFrame, sources: DataFrame) -> DataFrame:
    """Findings on (page, layer, body): bodies equal to an earlier page's, near copies, and printed numbers off the source's."""
    rows = pages.filter(F.length("body") >= MIN_CHECKED["copy"])
    keyed = rows.withColumn("digest", F.md5(text.fold_space(F.col("body"))))
    firsts = keyed.groupBy("layer", "digest").agg(F.min("page").alias("first_page"))
    exact = keyed.join(firsts, ["layer", "digest"])
    out = [finding(exact, "exact-duplicate", F.col("page") > F.col("first_page"), other=F.col("first_page"))]
    for layer in ("en", "id"):
        pairs = duplicates.near_pairs(rows.filter(F.col("layer") == layer), "page", "body")
        both = pairs.select(F.col("page_a").alias("page"), F.col("page_b").alias("other"), "containment").union(pairs.select("page_b", "page_a", "containment")).withColumn("layer", F.lit(layer))
        out.append(finding(both, "near-duplicate", F.lit(True), severity="warning", other=F.col("other"), metric=F.col("containment")))
    src = sources.select(F.col("page").alias("source_page"), folio(F.col("body"), "marked_line").alias("want"))
    got = rows.withColumn("got", folio(F.col("body"), "marked_line")).join(src, F.col("page") == F.col("source_page"))
    out.append(finding(got, "folio-mismatch", F.col("want") != F.col("got"), severity="warning", detail=F.concat_ws(" vs ", "want", "got")))
    return union(out)


def row_findings(rows: DataFrame, rules: dict[str, tuple]) -> DataFrame:
    """Findings of rules that look at one row, in one scan: name -> (condition, metric, detail) and, where it is no error, the severity."""
    null = lambda c, kind: (c if c is not None else F.lit(None)).cast(kind)
    fields = lambda name, metric, detail, severity="error": F.struct(F.lit(name).alias("rule"), F.lit(severity).alias("severity"), null(metric, "double").alias("metric"), null(detail, "string").alias("detail"))
    each = [F.when(when, fields(name, *rest)) for name, (when, *rest) in rules.items()]
    found = rows.select(F.col("page").cast("long").alias("page"), "layer", F.explode_outer(F.array_compact(F.array(*each))).alias("f")).filter("f is not null")
    return found.select("f.rule", "page", "layer", "f.severity", F.lit(None).cast("long").alias("other_page"), "f.metric", "f.detail")


def dataset_audit(pages: DataFrame) -> DataFrame:
    """All findings of the dataset audit on long rows (page, layer in ar, en, id, body).

    The bodies are read once: what the rules need of a row is a few dozen bytes, written and read
    again by each of them.
    """
    layer, body, folded = F.col("layer"), F.col("body"), F.col("folded")
    target = layer.isin("en", "id")
    state = F.coalesce(by_lang(layer, lambda g: coverage(folded, g, True)), coverage(folded, "ar", True))
    wrong = by_lang(layer, lambda g: chars.marker_density(folded, dims.MARKERS["id" if g == "en" else "en"]))
    seen = pages.select("page", "layer", "body", text.fold_space(body).alias("folded")).select(
        "page", "layer", state.alias("state"), (target & (body.rlike(text.BATCH_HEADER) | body.rlike(text.COMBINED_INLINE))).alias("artifact"),
        F.when(target, chars.longest(chars.runs(body, chars.ARABIC_BLOCK))).alias("run"),
        F.when(target & (F.length(folded) >= MIN_CHECKED["language"]) & ~body.rlike(text.PLACEHOLDER), wrong).alias("density"),
        F.when(F.length(folded) >= MIN_CHECKED["duplicate"], F.md5(folded)).alias("digest"), folio(body, "top_three").alias("number"),
    )
    path = work.folder(pages.sparkSession, "audit")
    seen.write.parquet(path)
    seen = pages.sparkSession.read.schema(seen.schema).parquet(path)
    out = [row_findings(seen, {
        "coverage": (F.col("state") != "real", None, F.col("state")), "batch-artifact": (F.col("artifact"), None, None),
        "arabic-run": (F.col("run") >= 12, F.col("run"), None), "wrong-language": (F.col("density") > 0.05, F.col("density"), None),
    })]
    keyed = seen.filter("digest is not null").select("page", "layer", "digest")
    firsts = keyed.groupBy("layer", "digest").agg(F.min("page").alias("first_page"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    out.append(finding(keyed.join(firsts, ["layer", "digest"]), "duplicate-body", F.col("page") > F.col("first_page"), other=F.col("first_page")))
    src = seen.filter(layer == "ar").select(F.col("page").alias("source_page"), F.col("number").alias("want"))
    numbered = seen.filter(target).select("page", "layer", F.col("number").alias("got")).join(src, F.col("page") == F.col("source_page"))
    numbered = numbered.withColumn("delta", F.abs(F.col("got").try_cast("long") - F.col("want").try_cast("long")))
    both = F.concat_ws(" vs ", "want", "got")
    out.append(finding(numbered, "misfiled", F.col("delta") >= 2, metric=F.col("delta"), detail=both))
    out.append(finding(numbered, "off-by-one", (F.col("delta") == 1) | (F.col("delta").isNull() & (F.col("want") != F.col("got"))), severity="info", detail=both))
    return union(out)


def structure(records: DataFrame, spine: DataFrame) -> DataFrame:
    """Findings on the records (page, title, scan) themselves: pages of the spine (page) that have none, pages with several or beyond it, no English title, no scan."""
    counts = records.groupBy("page").agg(F.count(F.lit(1)).alias("n"), F.max(F.coalesce(text.strip(F.col("title")), F.lit("")) == "").alias("untitled"), F.max(F.coalesce(text.strip(F.col("scan")), F.lit("")) == "").alias("unscanned"))
    both = spine.select(F.col("page").alias("due")).distinct().join(counts, F.col("due") == F.col("page"), "full").withColumn("layer", F.lit("record"))
    both = both.withColumn("beyond", F.col("due").isNull()).withColumn("lost", F.col("n").isNull()).withColumn("page", F.coalesce("page", "due"))
    lack = lambda rule, when, severity="error": finding(both, rule, F.coalesce(when, F.lit(False)), severity=severity, metric=F.col("n"))
    return union([lack("missing-page", F.col("lost")), lack("repeated-page", F.col("n") > 1), lack("unexpected-page", F.col("beyond")), lack("untitled", F.col("untitled")), lack("no-scan", F.col("unscanned"), "warning")])


#: Rules that stop a release; all others are for a reader to judge.
BLOCKING = {"missing-page": "record count/contiguity", "repeated-page": "record count/contiguity", "unexpected-page": "record count/contiguity", "untitled": "untitled pages"}


def verdict(findings: DataFrame) -> DataFrame:
    """(reason, n_findings) for what blocks: records out of order, pages without title, bodies that two pages of a layer share. None: nothing blocks."""
    reason = F.coalesce(*[F.when(F.col("rule") == rule, F.lit(why)) for rule, why in BLOCKING.items()], F.when(F.col("rule") == "duplicate-body", F.concat("layer", F.lit(" duplicate bodies"))))
    return findings.withColumn("reason", reason).filter("reason is not null").groupBy("reason").agg(F.count(F.lit(1)).alias("n_findings"))


def coverage_summary(pages: DataFrame) -> DataFrame:
    """(layer, state, n_pages)."""
    layer, body = F.col("layer"), F.col("body")
    state = F.coalesce(by_lang(layer, lambda g: coverage(body, g)), coverage(body, "ar"))
    return pages.groupBy("layer", state.alias("state")).agg(F.count(F.lit(1)).alias("n_pages"))


def blocking(findings: DataFrame) -> DataFrame:
    """One row: errors, warnings and whether anything blocks."""
    return findings.agg(F.count_if(F.col("severity") == "error").alias("errors"), F.count_if(F.col("severity") == "warning").alias("warnings")).withColumn("blocked", F.col("errors") > 0)


def folio_alignment(pages: DataFrame, sources: DataFrame) -> DataFrame:
    """(page, layer, want, got, verdict): aligned, off-by-one, wrong page, no-folio or no-source."""
    src = sources.select(F.col("page").alias("source_page"), folio(F.col("body"), "marked_line").alias("want"))
    rows = pages.withColumn("got", folio(F.col("body"), "marked_line")).join(src, F.col("page") == F.col("source_page"), "left")
    delta = F.abs(F.col("got").try_cast("long") - F.col("want").try_cast("long"))
    verdict = F.when(F.col("want").isNull(), "no-source").when(F.col("got").isNull(), "no-folio").when(delta == 0, "aligned").when(delta == 1, "off-by-one").otherwise("wrong page")
    return rows.select("page", "layer", "want", "got", verdict.alias("verdict"))


def triage(pages: DataFrame, sources: DataFrame) -> DataFrame:
    """Findings on labelled files (page, layer, content) against sources (page, body)."""
    src = sources.select(F.col("page").alias("source_page"), text.clean(F.col("body")).alias("source"))
    joined = pages.join(src, F.col("page") == F.col("source_page"), "left").withColumn("bs", blocks.parse_context(text.clean(F.col("content"))))
    label = by_lang(F.col("layer"), lambda g: F.lit(dims.LANGS[g]))
    shaped = blocks.labels_of(F.col("bs")) == F.array(F.lit("Arabic"), label)
    rows = joined.withColumn("good", shaped & F.col("source").isNotNull()).withColumn("body", F.get(F.filter("bs", lambda b: b["label"] != "Arabic"), F.lit(0))["body"])
    body, layer = F.col("body"), F.col("layer")
    marker = body.isin(*dims.BLANK_MARKERS.values())
    own = by_lang(layer, lambda g: F.lit(dims.BLANK_MARKERS[g]))
    delta = F.abs(F.col("got").try_cast("long") - F.col("want").try_cast("long"))
    asks = udf.needs_honorific(F.when((layer == "en") & F.col("good"), F.col("source")))
    both, labels = F.concat_ws(" vs ", "want", "got"), F.array_join(blocks.labels_of(F.col("bs")), ",")
    good, lettered = F.col("good"), F.col("runs")
    # One pass: each row is parsed once and holds all of its findings.
    seen = rows.withColumns({"want": folio(F.col("source")), "got": folio(body), "runs": chars.runs(body, chars.ARABIC_FULL), "blank": text.is_blank_source(F.col("source")), "asks": asks})
    return row_findings(seen, {
        "no-source": (F.col("source").isNull(), None, None),
        "malformed-labels": (F.col("source").isNotNull() & ~shaped, None, labels),
        "marker-over-text": (good & marker & ~F.col("blank"), None, None), "wrong-marker": (good & marker & F.col("blank") & (body != own), None, None),
        "empty": (good & ~marker & (F.length(body) < MIN_CHECKED["short"]), F.length(body), None),
        "untranslated": (good & (F.size("runs") > 0), chars.total(lettered), F.get("runs", F.lit(0))),
        "wrong-page": (good & (delta > 1), None, both), "off-by-one": (good & (delta == 1), None, both, "info"),
        "banned-honorific": (good & (layer == "en") & body.contains(text.BANNED_HONORIFIC), None, None),
        "missing-honorific": (good & F.col("asks") & ~body.contains(text.BANNED_HONORIFIC) & ~body.contains(text.WANTED_HONORIFIC), None, None),
        "local-honorific": (good & (layer == "id") & body.rlike(text.LOCAL_HONORIFIC), None, None),
    })


def validate(files: DataFrame, sources: DataFrame, dataset: DataFrame) -> DataFrame:
    """(page, ok, blank_source, english_block, indonesian_block, record_found, errors): strict report of each source page.

    files are (page, layer, content), sources (page, body), dataset records (page, text struct).
    """
    labels = {"en": "English", "id": "Indonesia"}
    out = sources.select("page", F.col("body").alias("source"), text.is_blank_source(F.col("body")).alias("blank_source"))
    record = dataset.groupBy(F.col("page").alias("record_page")).agg(F.count(F.lit(1)).alias("n_records"), F.any_value("text").alias("record"))
    out = out.join(record, F.col("page") == F.col("record_page"), "left")
    errors = [F.when(F.coalesce("n_records", F.lit(0)) != 1, F.concat(F.lit("dataset has "), F.coalesce("n_records", F.lit(0)).cast("string"), F.lit(" records")))]
    one = (F.coalesce("n_records", F.lit(0)) == 1) & F.col("record").isNotNull()  # only a single record is compared
    errors.append(F.when(one & (text.clean(F.col("record.ar")) != text.clean(F.col("source"))), F.lit("dataset ar differs from source")))
    for lang, label in labels.items():
        file = files.filter(F.col("layer") == lang).select(F.col("page").alias(f"{lang}_page"), F.col("content").alias(f"{lang}_file"), blocks.parse_lines(F.col("content")).alias(f"{lang}_blocks"))
        out = out.join(file, F.col("page") == F.col(f"{lang}_page"), "left")
        bs, body = F.col(f"{lang}_blocks"), text.clean(blocks.body_of(F.col(f"{lang}_blocks"), label))
        names = F.array_distinct(blocks.labels_of(bs))
        wanted = F.array(F.lit("Arabic"), F.lit(label))
        say = lambda cond, what: F.when(cond, what if isinstance(what, Column) else F.lit(what))
        lost, extra = F.array_sort(F.array_except(wanted, names)), F.array_sort(F.array_except(names, wanted))
        prefix, has, filled = F.lit(f"{lang}: "), F.col(f"{lang}_file").isNotNull(), blocks.body_of(bs, label).isNotNull()
        errors += [
            say(~has, f"{lang}: file missing"),
            say(has & (F.size(lost) > 0), F.concat(prefix, F.lit("missing required labels: "), F.array_join(lost, ", "))),
            say(has & (F.size(extra) > 0), F.concat(prefix, F.lit("unexpected labels: "), F.array_join(extra, ", "))),
            say(has & (F.size(blocks.duplicate_labels(bs)) > 0), F.concat(prefix, F.lit("duplicate labels: "), F.array_join(blocks.duplicate_labels(bs), ", "))),
            say(blocks.body_of(bs, "Arabic").isNotNull() & (text.clean(blocks.body_of(bs, "Arabic")) != text.clean(F.col("source"))), f"{lang}: embedded Arabic differs from canonical source"),
            say(filled & (body == ""), f"{lang}: {label} block is empty"),
            say(filled & F.col("blank_source") & (body != dims.BLANK_MARKERS[lang]), f"{lang}: blank source requires its exact marker"),
            say(filled & ~F.col("blank_source") & text.is_fallback(body, lang, "validator"), f"{lang}: fallback text is not allowed on a content page"),
            say(one & filled & (text.clean(F.col(f"record.{lang}")) != body), f"{lang}: dataset differs from file"),
        ]
    en, id_ = (blocks.body_of(F.col(f"{g}_blocks"), n).isNotNull() for g, n in labels.items())
    out = out.withColumn("errors", F.array_compact(F.array(*errors)))
    return out.select("page", (F.size("errors") == 0).alias("ok"), "blank_source", en.alias("english_block"), id_.alias("indonesian_block"), (F.coalesce("n_records", F.lit(0)) == 1).alias("record_found"), "errors")


def sweep_totals(reports: DataFrame) -> DataFrame:
    return reports.agg(F.count(F.lit(1)).alias("pages"), F.count_if("ok").alias("passed"), F.count_if(~F.col("ok")).alias("failed"))


def worker_output(pages: DataFrame) -> DataFrame:
    """Findings on (page, layer, raw, source) with the rules for a worker's file, degenerate repetition included."""
    label = by_lang(F.col("layer"), lambda g: F.lit(dims.LANGS[g]))
    rows = pages.withColumns({"bs": blocks.parse_context(text.clean(F.col("raw"))), "label": label, "n": letters(text.clean(F.col("source")))})
    n_label = F.size(F.filter("bs", lambda b: b["label"] == F.col("label")))
    rows = rows.withColumns({"n_label": n_label, "body": F.coalesce(F.get(F.filter("bs", lambda b: b["label"] == F.col("label")), F.lit(0))["body"], F.lit(""))})
    body, embedded = F.col("body"), blocks.body_of(F.col("bs"), "Arabic")
    longest, total = chars.longest(chars.runs(body, chars.ARABIC_BLOCK)), chars.count(body, chars.ARABIC_LETTERS)
    many = (total > F.greatest(F.lit(4.0), F.length(body) * 0.005)) & (longest < 3) & (total > 60)
    looped = duplicates.top_window(rows.filter(F.length(body) > 500).select(F.struct("page", "layer").alias("of"), "body"), "of", "body").filter("looped")
    return union([
        finding(looped.select("of.page", "of.layer", "top", "top_count"), "degenerate-repetition", F.lit(True), metric=F.col("top_count"), detail=F.col("top")),
        finding(rows, "label-count", F.col("n_label") != 1, metric=F.col("n_label")), finding(rows, "empty-target", body == ""),
        finding(rows, "embedded-differs", embedded.isNotNull() & (text.fold_space(embedded) != text.fold_space(F.col("source")))),
        finding(rows, "scratchpad", F.col("raw").rlike(text.SCRATCH), metric=F.regexp_count(F.col("raw"), F.lit(text.SCRATCH))),
        finding(rows, "untranslated", (longest >= 12) | many, metric=longest), finding(rows, "truncation", truncated(body)),
        finding(rows, "ratio", too_short(body, F.col("n")), metric=F.length(body).cast("double") / F.nullif(F.col("n"), F.lit(0))),
    ])
