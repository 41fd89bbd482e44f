"""Repair planners. Each returns a plan as a DataFrame or Column; nothing is written in place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions import chars, dims, text
from quire.functions.folio import folio
from quire.operators import blocks
from quire.operators.checks import by_lang



def plan_block(sibling: Column, label: str, lang: str, kind: str = "enriched") -> Column:
    """recover a labelled block of the sibling file, relabel a file that already is one, or translate."""

    def planned(x: Column) -> Column:
        found = F.struct(F.lit("recover").alias("action"), text.strip_artifacts(x["first"]).alias("body"), F.concat(F.lit(f"the sibling holds a fitting {label} block of "), F.length(x["first"]).cast("string"), F.lit(" characters")).alias("reason"))
        whole = F.struct(F.lit("relabel").alias("action"), text.strip_artifacts(x["bare"]).alias("body"), F.lit(f"the {kind} text reads as {label} but has no label").alias("reason"))
        none = F.struct(F.lit("translate").alias("action"), F.lit("").alias("body"), F.lit(f"nothing in the sibling reads as {label}").alias("reason"))
        return F.when(x["first"].isNotNull(), found).when(text.is_translation_like(x["bare"], lang), whole).otherwise(none)

    def parts(cleaned: Column) -> Column:
        candidates = F.filter(blocks.bodies(blocks.parse_context(cleaned), label), lambda b: text.is_translation_like(b, lang))
        bare = text.strip(F.regexp_replace(cleaned, rf"(?m)^[ \t]*({blocks.ANY})[ \t]*:", ""))
        return F.struct(F.get(candidates, F.lit(0)).alias("first"), bare.alias("bare"))

    return chars.let(chars.let(text.strip_artifacts(text.clean(sibling)), parts), planned)


def plan_missing(files: DataFrame, sources: DataFrame, lang: str) -> DataFrame:
    """(page, action, body, reason, folio_match) for a target layer from its own and its sibling's files.

    A file whose own block is already fine is "ok". folio_match compares printed numbers with the source.
    """
    label, other = dims.LANGS[lang], "id" if lang == "en" else "en"
    own = files.filter(F.col("layer") == lang).select(F.col("page").alias("own_page"), F.col("content").alias("own"))
    sibling = files.filter(F.col("layer") == other).select(F.col("page").alias("sib_page"), F.col("content").alias("sibling"))
    rows = sources.join(own, F.col("page") == F.col("own_page"), "left").join(sibling, F.col("page") == F.col("sib_page"), "left")
    mine = blocks.body_of(blocks.parse_context(text.clean(F.col("own"))), label)
    rows = rows.withColumn("plan", plan_block(F.coalesce("sibling", F.lit("")), label, lang))
    fine = text.is_translation_like(mine, lang)
    body = F.when(fine, mine).otherwise(F.col("plan.body"))
    return rows.select(
        "page", F.when(fine, "ok").otherwise(F.col("plan.action")).alias("action"), body.alias("body"), F.when(fine, "own block is fine").otherwise(F.col("plan.reason")).alias("reason"),
        F.coalesce(folio(body, "top_three") == folio(F.col("body"), "top_three"), F.lit(False)).alias("folio_match"),
    )


def choose(id_copy: Column, en_copy: Column) -> Column:
    """Which of two copies wins: one without Arabic letters beats one with them; length never decides, and in doubt en stays."""
    a, b = chars.count(id_copy, chars.ARABIC_LETTERS), chars.count(en_copy, chars.ARABIC_LETTERS)
    return (
        F.when((a == 0) & (b > 0), F.struct(F.lit("id").alias("winner"), F.lit("id-copy has no Arabic script").alias("reason")))
        .when((b == 0) & (a > 0), F.struct(F.lit("en").alias("winner"), F.lit("en-copy has no Arabic script").alias("reason")))
        .when((a == 0) & (b == 0), F.struct(F.lit("en").alias("winner"), F.lit("both compliant").alias("reason")))
        .otherwise(F.struct(F.lit("en").alias("winner"), F.lit("both copies have Arabic script: review").alias("reason")))
    )


def strip_labels(files: DataFrame) -> DataFrame:
    """(page, layer, foreign, duplicated, safe): files with labels that are not theirs, and whether dropping them loses nothing.

    A block is safe to drop if the sibling file has the same valid body, or if it is no translation at all.
    """
    own = by_lang(F.col("layer"), lambda g: F.lit(dims.LANGS[g]))
    rows = files.withColumns({"bs": blocks.parse_context(text.clean(F.col("content"))), "own": own})
    rows = rows.withColumn("foreign", F.array_sort(F.array_except(blocks.labels_of(F.col("bs")), F.array(F.lit("Arabic"), F.col("own"))))).withColumn("duplicated", blocks.duplicate_labels(F.col("bs")))
    other = files.select(F.col("page").alias("sib_page"), F.when(F.col("layer") == "en", "id").otherwise("en").alias("sib_layer"), blocks.parse_context(text.clean(F.col("content"))).alias("sib"))
    rows = rows.filter((F.size("foreign") > 0) | (F.size("duplicated") > 0)).join(other, (F.col("page") == F.col("sib_page")) & (F.col("layer") == F.col("sib_layer")), "left")
    touched = F.filter("bs", lambda b: F.array_contains(F.col("foreign"), b["label"]) | F.array_contains(F.col("duplicated"), b["label"]))

    def unsafe(b: Column) -> Column:
        like = F.when(b["label"] == "English", text.is_translation_like(b["body"], "en")).otherwise(text.is_translation_like(b["body"], "id"))
        copies = F.filter(F.coalesce(F.col("sib"), F.array().cast(f"array<{blocks.BLOCK}>")), lambda x: (x["label"] == b["label"]) & (x["body"] == b["body"]))
        return like & (F.size(copies) == 0)

    return rows.select("page", "layer", "foreign", "duplicated", (~F.exists(touched, unsafe)).alias("safe"))


def collapse(candidates: Column, source: Column) -> Column:
    """(body, reason) from several blocks of one label: the one with the source's printed number, else the longest."""
    want = folio(source, "top_three")
    exact = F.filter(candidates, lambda b: folio(b, "top_three") == want)
    longest = F.get(F.filter(candidates, lambda b: F.length(b) == F.array_max(F.transform(candidates, lambda x: F.length(x)))), F.lit(0))
    return F.when(F.size(candidates) == 0, F.struct(F.lit("").alias("body"), F.lit("no valid block").alias("reason"))).when(
        F.size(exact) > 0, F.struct(F.get(exact, F.lit(0)).alias("body"), F.lit("folio match").alias("reason"))
    ).otherwise(F.struct(longest.alias("body"), F.lit("longest candidate").alias("reason")))


def source_drift(embedded: Column, canonical: Column) -> Column:
    """same, fixable (one character at most), truncated (a prefix, 200 short or more) or escalate."""
    a, b = text.fold_space(embedded), text.fold_space(canonical)
    short = (F.length(b) - F.length(a) >= 200) & b.startswith(F.substring(a, 1, 200)) & b.startswith(a)
    return F.when(a == b, "same").when(short, "truncated").when(F.abs(F.length(a) - F.length(b)) <= 1, "fixable").otherwise("escalate")


def filler_drift(embedded: Column, canonical: Column) -> Column:
    """Filler glyphs in the embedded source less those in the canonical one."""
    n = lambda t: F.regexp_count(t, F.lit(chars.FILLER_GLYPH))
    return n(embedded) - n(canonical)


def blank_plan(pages: DataFrame) -> DataFrame:
    """(page, layer, marker) of blank pages (page, layer, source, body) without their exact marker."""
    marker = by_lang(F.col("layer"), lambda g: F.lit(dims.BLANK_MARKERS[g]))
    blank = (F.length(text.clean(F.col("source"))) <= 200) & F.col("source").rlike(text.BLANK_NOTE)
    return pages.withColumn("marker", marker).filter(blank & (text.strip(F.coalesce("body", F.lit(""))) != F.col("marker"))).select("page", "layer", "marker")


def cell_plan(source: Column, body: Column, source_cell: str, cell: str, note: str = r"\s*\[[^\]\n]*(wafq|tak terbaca|OCR)[^\]\n]*\]\s*\z") -> Column:
    """(verdict, want, got, body): cells of a grid page as many as the source's, OK, DOUBLED or TRUNCATED; a trailing note stays."""
    times = lambda t, c: F.floor((F.length(t) - F.length(F.replace(t, F.lit(c), F.lit("")))) / len(c)).cast("int")
    want, got = times(source, source_cell), times(body, cell)
    tail = text.strip(F.regexp_extract(body, note, 0))
    bare = F.regexp_replace(F.regexp_replace(F.replace(body, F.lit(cell), F.lit("")), r"\n{3,}", "\n\n"), r"\s+\z", "")
    run = F.array_join(F.array_repeat(F.lit(cell), want), "\n")
    new = F.concat(bare, F.lit("\n"), run, F.when(tail != "", F.concat(F.lit("\n"), tail)).otherwise(""))
    verdict = F.when(got == want, "OK").when(got > want, "DOUBLED").otherwise("TRUNCATED")
    return F.struct(verdict.alias("verdict"), want.alias("want"), got.alias("got"), F.when(got == want, body).otherwise(new).alias("body"))


def verb_frame(body: Column) -> Column:
    """The honorific where it stands as a verb, put as one."""
    return F.regexp_replace(body, text.VERB_FRAME, "$1He is exalted")


def doubled_tails(body: Column, table: dict[str, str]) -> Column:
    """(body, idempotent, problems): names in their one form, checked again on their own."""
    new = text.canonical_tokens(body, table)
    bare = lambda t: F.regexp_replace(t, r"[.,;:!?)]+\z", "")
    wrong = F.filter(F.split(new, r"\s+", -1), lambda t: F.exists(
        F.array(*[F.struct(F.lit(k).alias("k"), F.lit(v).alias("v")) for k, v in table.items()]), lambda e: F.startswith(bare(t), e["k"]) & (bare(t) != e["v"])))
    return F.struct(new.alias("body"), (text.canonical_tokens(new, table) == new).alias("idempotent"), wrong.alias("problems"))


def assemble(draft: Column, canonical: Column, lang: str) -> Column:
    """(content, problem): the two-block file of a body-only draft; a draft that has labels or is no translation is refused."""

    def judged(body: Column) -> Column:
        problem = F.when(body == "", "empty draft").when(blocks.labelled(body), "draft carries labels").when(~text.is_translation_like(body, lang), "not a translation")
        made = lambda p: F.struct(F.when(p.isNull(), blocks.render(canonical, dims.LANGS[lang], body)).alias("content"), p.alias("problem"))
        return chars.let(problem, made)

    return chars.let(text.strip_artifacts(text.clean(draft)), judged)


def stray_bodies(files: DataFrame) -> DataFrame:
    """(page, layer, own_chars, stray): files (page, layer, content) that are not canonical, with the length of their own block and the blocks of other labels, as (label, chars), that read as their language."""
    own = by_lang(F.col("layer"), lambda g: F.lit(dims.LANGS[g]))
    rows = files.withColumns({"bs": blocks.parse_context(text.clean(F.col("content"))), "own": own}).filter(blocks.labels_of(F.col("bs")) != F.array(F.lit("Arabic"), F.col("own")))

    def fits(b: Column) -> Column:
        like = F.when(F.col("layer") == "en", text.is_translation_like(b["body"], "en")).otherwise(text.is_translation_like(b["body"], "id"))
        return (b["label"] != "Arabic") & (b["label"] != F.col("own")) & like

    stray = F.transform(F.filter("bs", fits), lambda b: F.struct(b["label"].alias("label"), F.length(b["body"]).alias("chars")))
    mine = F.coalesce(F.length(F.get(F.filter("bs", lambda b: b["label"] == F.col("own")), F.lit(0))["body"]), F.lit(0))
    return rows.select("page", "layer", mine.alias("own_chars"), stray.alias("stray")).filter((F.col("own_chars") > 0) | (F.size("stray") > 0))


def verb_contexts(pages: DataFrame, body: str, before: int = 40, after: int = 20) -> DataFrame:
    """(page, context): each place where the honorific reads like a verb, with the text around it on one line, for a reader to judge."""
    pattern = rf"(?s)(.{{0,{before}}}God Most High(?=\s*(?i:above|over|beyond)\b).{{0,{after}}})"
    found = F.regexp_extract_all(F.col(body), F.lit(pattern), F.lit(1))
    return pages.select("page", F.explode(F.transform(found, lambda c: F.replace(c, F.lit("\n"), F.lit(" ")))).alias("context"))


def title_patch(records: DataFrame, titles: DataFrame) -> DataFrame:
    """records (page, ..., title) with the titles of a patch (page, title) put in."""
    t = titles.select(F.col("page").alias("t_page"), F.col("title").alias("t_title"))
    return records.join(t, F.col("page") == F.col("t_page"), "left").withColumn("title", F.coalesce("t_title", "title")).drop("t_page", "t_title")


def apply_plan(files: DataFrame, plan: DataFrame, sources: DataFrame, lang: str) -> DataFrame:
    """(page, content) after a plan: rewritten for actions that bring a body, unchanged otherwise. The caller writes it elsewhere."""
    p = plan.filter(F.col("action").isin("recover", "relabel")).select(F.col("page").alias("plan_page"), F.col("body").alias("plan_body"))
    s = sources.select(F.col("page").alias("source_page"), F.col("body").alias("source"))
    rows = files.filter(F.col("layer") == lang).join(p, F.col("page") == F.col("plan_page"), "left").join(s, F.col("page") == F.col("source_page"), "left")
    new = blocks.render(F.col("source"), dims.LANGS[lang], F.col("plan_body"))
    return rows.select("page", F.when(F.col("plan_body").isNotNull(), new).otherwise(F.col("content")).alias("content"))
