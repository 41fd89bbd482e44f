"""Sweeps over labelled target files: what each page's file holds against its source. Files are (page, layer, content), sources (page, body)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quire.functions import chars, dims, text
from quire.functions.folio import folio
from quire.operators import blocks, checks


def parsed(files: DataFrame, sources: DataFrame) -> DataFrame:
    """(page, layer, source, label, formed, embedded, body): each file's blocks next to its page's source; formed files have just the two blocks in order."""
    src = sources.select(F.col("page").alias("source_page"), text.clean(F.col("body")).alias("source"))
    rows = files.withColumn("bs", blocks.parse_context(text.clean(F.col("content")))).withColumn("label", checks.by_lang(F.col("layer"), lambda g: F.lit(dims.LANGS[g])))
    own = F.get(F.filter("bs", lambda b: b["label"] == F.col("label")), F.lit(0))["body"]
    formed = blocks.labels_of(F.col("bs")) == F.array(F.lit("Arabic"), F.col("label"))
    rows = rows.select("page", "layer", "label", formed.alias("formed"), blocks.body_of(F.col("bs"), "Arabic").alias("embedded"), own.alias("body"))
    return rows.join(src, F.col("page") == F.col("source_page")).drop("source_page")


def untranslated_sweep(files: DataFrame, sources: DataFrame) -> DataFrame:
    """(page, layer, kind, longest, total, sample): well-formed files whose body still holds Arabic runs, prose or cells of a grid."""
    rows = parsed(files, sources).filter("formed").select("page", "layer", checks.untranslated(F.col("body")).alias("u"))
    return rows.filter("u.longest > 0").select("page", "layer", "u.kind", "u.longest", "u.total", "u.sample")


def worst_first(sweep: DataFrame, n: int = 12) -> DataFrame:
    """The n worst rows of a sweep with their place: by longest, then total, both from the top."""
    order = [F.col("longest").desc(), F.col("total").desc(), F.col("page"), F.col("layer")]
    return sweep.orderBy(*order).limit(n).withColumn("place", F.row_number().over(W.partitionBy(F.lit(0)).orderBy(*order)))


def completeness(files: DataFrame, sources: DataFrame) -> DataFrame:
    """Findings on well-formed files: another source embedded, Arabic letters over max(4, 0.5 %), a truncation marker, a body too short for its source."""
    rows = parsed(files, sources).filter("formed").withColumns({"n": checks.letters(F.col("source")), "n_arabic": chars.count(F.col("body"), chars.ARABIC_LETTERS)})
    body = F.col("body")
    return checks.union([
        checks.finding(rows, "embedded-differs", text.fold_space(F.col("embedded")) != text.fold_space(F.col("source"))),
        checks.finding(rows, "arabic-share", F.col("n_arabic") > F.greatest(F.lit(4.0), F.length(body) * 0.005), metric=F.col("n_arabic")),
        checks.finding(rows, "truncation", checks.truncated(body, "completeness")),
        checks.finding(rows, "ratio", checks.too_short(body, F.col("n")), metric=F.length(body).cast("double") / F.nullif(F.col("n"), F.lit(0))),
    ])


def documents_damage(body: Column) -> Column:
    """Whether a body explains the damage of its source, in any language or in a bracketed note."""
    return body.rlike(text.DAMAGE_NOTE)


def degenerate_audit(files: DataFrame, sources: DataFrame) -> DataFrame:
    """(page, layer, kind, n_unclear, n_letters, state) of pages whose source is degenerate: AR-WRONG, NO-TRANSLATION, documented or undocumented."""
    bad = checks.degenerate(sources.select("page", text.clean(F.col("body")).alias("body")), "page", "body").withColumnRenamed("page", "bad_page")
    rows = parsed(files, sources).join(bad, F.col("page") == F.col("bad_page"))
    state = (
        F.when(F.col("embedded").isNull() | (F.col("embedded") != F.col("source")), "AR-WRONG").when(F.coalesce("body", F.lit("")) == "", "NO-TRANSLATION")
        .when(documents_damage(F.col("body")), "documented").otherwise("undocumented")
    )
    return rows.select("page", "layer", "kind", "n_unclear", "n_letters", state.alias("state"))


def digit_audit(files: DataFrame, sources: DataFrame, over: int = 20) -> DataFrame:
    """(page, layer, source_longest, n_runs, longest, verdict) of well-formed files of pages whose source has a run of over so many digits."""
    found = lambda c: chars.runs(F.col(c), chars.DIGITS)
    rows = parsed(files, sources).filter("formed").withColumns({"source_longest": chars.longest(found("source")), "runs": found("body")})
    rows = rows.filter(F.col("source_longest") > over)
    return rows.select("page", "layer", "source_longest", F.size("runs").alias("n_runs"), chars.longest(F.col("runs")).alias("longest"), checks.digit_shrink(F.col("source"), F.col("body")).alias("verdict"))


def own_text(files: DataFrame, sources: DataFrame, stop: tuple[str, ...] = ()) -> DataFrame:
    """(page, layer, state, n_terms, ratio, same_folio): whether a file looks like its own page: OK, MALFORMED or EMPTY, with the source's fingerprint and the lengths' ratio."""
    rows = parsed(files, sources)
    state = F.when(~F.col("formed"), "MALFORMED").when(F.length("body") < checks.MIN_CHECKED["short"], "EMPTY").otherwise("OK")
    ok, body, source = state == "OK", F.col("body"), F.col("source")
    ratio = F.length(body).cast("double") / F.greatest(F.length(source), F.lit(1))
    terms = F.size(fingerprint(source, stop))
    return rows.select("page", "layer", state.alias("state"), terms.alias("n_terms"), F.when(ok, ratio).alias("ratio"), F.when(ok, folio(source, "digits_only") == folio(body, "digits_only")).alias("same_folio"))


# Words that say nothing of the page they stand on.
COMMON_WORDS = (
    "الله", "تعالى", "صلى", "عليه", "وسلم", "الذي", "التي", "هذا",
    "هذه", "ذلك", "كان", "كانت", "بسم", "الرحمن", "الرحيم", "وقال",
)


def own_terms(sources: DataFrame, stop: tuple[str, ...] = COMMON_WORDS) -> DataFrame:
    """(page, place from 1, term): the words that tell a source page from others, by which a reader checks its targets."""
    rows = sources.select("page", F.posexplode(fingerprint(text.clean(F.col("body")), stop)).alias("at", "term"))
    return rows.select("page", (F.col("at") + 1).alias("place"), "term")


def fingerprint(source: Column, stop: tuple[str, ...] = ()) -> Column:
    from quire.operators.duplicates import fingerprint_terms

    return fingerprint_terms(source, list(stop))


def restore_sources(files: DataFrame, sources: DataFrame, tolerance: int = 1) -> DataFrame:
    """(page, layer, verdict, delta, content): embedded sources that differ by tolerance characters at most get the canonical one back, others escalate; content is the repaired file."""
    rows = parsed(files, sources).withColumn("delta", F.length("embedded") - F.length("source"))
    verdict = F.when(F.col("embedded").isNull(), "no Arabic block").when(F.col("embedded") == F.col("source"), "ok").when(F.abs("delta") > tolerance, "escalate").when(F.col("body").isNull(), "no target block").otherwise("fixed")
    fixed = F.when(verdict == "fixed", blocks.render(F.col("source"), F.col("label"), F.col("body")))
    return rows.select("page", "layer", verdict.alias("verdict"), "delta", fixed.alias("content"))


def restore_truncated(files: DataFrame, sources: DataFrame, least: int = 200, head: int = 200) -> DataFrame:
    """(page, layer, shortfall, content): files whose embedded source is the source's beginning and lacks `least` characters or more get the whole back.

    White space counts as one space on both sides; the target's block stays, or is empty where there is none.
    """
    rows = parsed(files, sources).withColumn("shortfall", F.length("source") - F.length("embedded"))
    flat = rows.withColumns({"a": text.fold_space(F.col("embedded")), "b": text.fold_space(F.col("source"))})
    cut = (F.col("embedded") != F.col("source")) & (F.col("shortfall") > 0) & F.startswith("b", F.substring("a", 1, head)) & (F.length("b") - F.length("a") >= least)
    return flat.filter(cut).select("page", "layer", "shortfall", blocks.render(F.col("source"), F.col("label"), F.coalesce("body", F.lit(""))).alias("content"))


def _versions(before: DataFrame, after: DataFrame, sources: DataFrame) -> DataFrame:
    """Both versions' bodies with their Arabic letters; only files that differ."""
    was = before.select(F.col("page").alias("b_page"), F.col("layer").alias("b_layer"), F.col("content").alias("b_content"))
    changed = after.join(was, (F.col("page") == F.col("b_page")) & (F.col("layer") == F.col("b_layer"))).filter("content != b_content")
    now = parsed(changed.select("page", "layer", "content"), sources).select("page", "layer", "label", "source", "body")
    old = parsed(changed.select("page", "layer", F.col("b_content").alias("content")), sources).select(F.col("page").alias("o_page"), F.col("layer").alias("o_layer"), F.col("body").alias("old_body"))
    both = now.join(old, (F.col("page") == F.col("o_page")) & (F.col("layer") == F.col("o_layer"))).drop("o_page", "o_layer")
    n = lambda c: F.coalesce(chars.count(F.col(c), chars.ARABIC_LETTERS), F.lit(-1))
    return both.withColumns({"before": n("old_body"), "after": n("body")})


def regressions(before: DataFrame, after: DataFrame, sources: DataFrame) -> DataFrame:
    """(page, layer, before, after, change): Arabic letters left in the bodies of rewritten files, before and after; -1 without a body."""
    change = F.when(F.col("after") <= 0, "now clean").when(F.col("after") > F.col("before"), "worse").when(F.col("after") < F.col("before"), "cleaner").otherwise("unchanged")
    return _versions(before, after, sources).select("page", "layer", "before", "after", change.alias("change"))


def restore_upstream(before: DataFrame, after: DataFrame, sources: DataFrame, margin: int = 3) -> DataFrame:
    """(page, layer, before, after, content): files made worse by more than margin letters, with the earlier body under the canonical source."""
    rows = _versions(before, after, sources).filter((F.col("before") >= 0) & (F.col("after") > 0) & (F.col("before") < F.col("after") - margin))
    return rows.select("page", "layer", "before", "after", blocks.render(F.col("source"), F.col("label"), F.col("old_body")).alias("content"))


def misfiled(coverage: DataFrame, key: str, least: float = 0.5) -> DataFrame:
    """Pages whose target holds less than so much of their rare terms, the worst first."""
    return coverage.filter(F.col("coverage") < least).orderBy("coverage", key)
