"""Exact and near duplicates, shingles, term statistics and alignment of pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quire.functions import chars, text, udf

#: Latin words with accents; profile "compat" leaves out the letters between the two Latin ranges.
WORDS = {"fixed": "[a-zà-öø-ɏ']+", "compat": "[a-zĀ-ɏ']+"}
SHINGLE = 12
NEAR = 0.60
#: Parts to which the sets of pages in pairs are dealt; a worker holds the sets of one.
PARTS = 64
# Names by which pages are aligned.
LEMMAS = r"\b(Allah|Muhammad|Musa|Yahya|Ibrahim|Ismail|Adam|Yunus|Isa|Iblis|Jibril|Mika'il)\b"


def exact_groups(pages: DataFrame, key: str, body: str, least: int = 0) -> DataFrame:
    """(key, first_page, n_pages) of pages whose folded body occurs more than once."""
    folded = text.fold_space(F.col(body))
    hashed = pages.filter(F.length(folded) >= max(least, 1)).select(key, F.md5(folded).alias("digest"))
    groups = hashed.groupBy("digest").agg(F.min(key).alias("first_page"), F.count(F.lit(1)).alias("n_pages")).filter("n_pages > 1")
    return hashed.join(groups, "digest").select(key, "first_page", "n_pages")


def words(body: Column, profile: str = "fixed") -> Column:
    return F.regexp_extract_all(F.lower(body), F.lit(WORDS[profile]), F.lit(0))


def shingle_hashes(tokens: Column, k: int = SHINGLE) -> Column:
    """The set of hashes of k words in a row; none for fewer words."""

    def hashes(ts: Column) -> Column:
        every = F.transform(F.sequence(F.lit(0), F.size(ts) - k), lambda i: F.xxhash64(*[F.get(ts, i + j) for j in range(k)]))
        return F.when(F.size(ts) < k, F.array().cast("array<bigint>")).otherwise(F.array_distinct(every))

    return chars.let(tokens, hashes)


def near_pairs(pages: DataFrame, key: str, body: str, k: int = SHINGLE, least: float = NEAR, profile: str = "fixed") -> DataFrame:
    """(page_a, page_b, shared, containment) of pages whose larger share of common shingles is above least.

    Copies of one body are compared once, through the first of them. A pair above the limit shares
    more than that share of the smaller set, so one of the smaller set's rarest shingles, as many as
    it can miss and one more, must be common: only these look for partners. Shingles of one page
    alone are the rarest and meet nobody; a passage that very many pages share is looked up only by
    pages that hold little else. Candidates are then counted in full, so the result is exact. Texts and
    shingles are shuffled once; what follows goes on with the shingles that two pages hold. Keys are whole numbers.
    """
    firsts = pages.select(F.col(key).alias("page"), F.col(body).alias("body")).groupBy(F.md5(text.fold_space(F.col("body"))).alias("digest"))
    one = firsts.agg(F.min("page").alias("page"), F.min_by("body", "page").alias("body"))
    sets = one.select("page", shingle_hashes(words(F.col("body"), profile), k).alias("hs"))
    sized = F.transform("hs", lambda h: F.struct(h.alias("h"), F.size("hs").alias("n")))
    rows = sets.select("page", F.explode(sized).alias("x")).select("page", "x.h", "x.n")
    # Joins below would add these two conditions to some of their sides: then equal shuffles would not be told for equal.
    rows = rows.withColumn("df", F.count(F.lit(1)).over(W.partitionBy("h"))).filter("df > 1 AND h IS NOT NULL AND page IS NOT NULL")
    # Each page's common shingles, the rarest first, and how many it holds in all: what no other page holds is in no pair's count.
    rarest = F.array_sort(F.collect_list(F.struct("df", "h"))).alias("hs")
    held = rows.repartition("page").groupBy("page").agg(F.first("n").alias("n"), rarest).withColumn("hs", F.col("hs.h"))
    may_miss = F.col("n") - F.floor(least * F.col("n"))  # with one more than `least` of n common, the rarest n - that + 1 hold one
    asks = F.slice("hs", F.lit(1), F.greatest(may_miss - (F.col("n") - F.size("hs")), F.lit(0)).cast("int"))
    asking = held.select(F.explode(asks).alias("h"), F.col("page").alias("small"), F.col("n").alias("n_small"))
    larger = (F.col("n") > F.col("n_small")) | ((F.col("n") == F.col("n_small")) & (F.col("page") > F.col("small")))
    met = asking.join(rows.select("h", "page", "n"), "h").filter(larger).select("small", "page").distinct()
    counted = udf.count_common(dealt_sets(met, held)).withColumn("containment", F.col("shared").cast("double") / F.col("n"))
    pair = F.least("small", "page").alias("page_a"), F.greatest("small", "page").alias("page_b")
    return counted.filter(F.col("containment") > least).select(*pair, "shared", "containment")


def dealt_sets(met: DataFrame, held: DataFrame) -> DataFrame:
    """(part, page, n, hs, partners): sets (page, n, hs) dealt to PARTS, where pairs (small, page) can be compared.

    Each page of a pair stands once in a part of its own, without partners; each small one comes once to every part in
    which it has partners, however many they are.
    """
    part = F.pmod(F.xxhash64("page"), F.lit(PARTS)).cast("int").alias("part")
    theirs = held.join(met.select("page").distinct(), "page", "left_semi").select(part, "page", "n", "hs", F.lit(None).cast("array<long>").alias("partners"))
    asked = met.groupBy("small", part).agg(F.collect_list(F.col("page").cast("long")).alias("partners")).withColumnRenamed("small", "page")
    return theirs.union(asked.join(held, "page").select("part", "page", "n", "hs", "partners"))


def containment(pages: DataFrame, key: str, body: str, refs: DataFrame, ref_key: str, ref_body: str, k: int, profile: str = "fixed") -> DataFrame:
    """(key, ref_key, shared, share) of the reference's shingles that each page holds."""
    h = lambda df, i, b: df.select(F.col(i), shingle_hashes(words(F.col(b), profile), k).alias("hs"))
    numbered = F.transform("hs", lambda x: F.struct(x.alias("h"), F.size("hs").alias("n_ref")))
    ref = h(refs, ref_key, ref_body).select(ref_key, F.explode(numbered).alias("x")).select(ref_key, "x.h", "x.n_ref")
    own = h(pages, key, body).select(key, F.explode("hs").alias("h"))
    hits = own.join(ref, "h").groupBy(key, ref_key).agg(F.count(F.lit(1)).alias("shared"), F.first("n_ref").alias("n_ref"))
    return hits.select(key, ref_key, "shared", (F.col("shared").cast("double") / F.col("n_ref")).alias("share"))


def best_slot(pages: DataFrame, key: str, refs: DataFrame, ref_key: str, first: int = 8) -> DataFrame:
    """(key, best, jaccard) by common tokens; both sides are (key, tokens). Of equal slots the lowest wins; pages that share no token with any slot have no row.

    A page's rarest tokens find slots to begin with. A slot as good as the best of them shares at
    least that similarity's part of the page's tokens, so it holds one of the rarest that it cannot miss, and
    its size lies within the same bounds: only such slots are compared in the second round. Frequent
    tokens take part only for pages that fit nothing well.
    """
    own = pages.select(F.col(key), F.array_distinct("tokens").alias("ts"))
    ref = refs.select(F.col(ref_key).alias("slot"), F.array_distinct("tokens").alias("rs"))
    terms = ref.select("slot", F.size("rs").alias("m"), F.explode("rs").alias("t"))
    df = terms.groupBy("t").agg(F.count(F.lit(1)).alias("df"))
    mine = own.select(key, F.size("ts").alias("n"), F.explode("ts").alias("t")).join(df, "t", "left").withColumn("df", F.coalesce("df", F.lit(0)))
    whole = W.partitionBy(key)
    ranked = mine.withColumns({"place": F.row_number().over(whole.orderBy("df", "t")), "absent": F.count_if(F.col("df") == 0).over(whole)}).filter("df > 0")

    def scored(met: DataFrame) -> DataFrame:
        both = met.select(key, "slot").distinct().join(own, key).join(ref, "slot").withColumn("both", F.size(F.array_intersect("ts", "rs")))
        return both.select(key, "slot", (F.col("both").cast("double") / (F.size("ts") + F.size("rs") - F.col("both"))).alias("jaccard"))

    begun = scored(ranked.filter(F.col("place") - F.col("absent") <= first).join(terms, "t")).groupBy(key).agg(F.max("jaccard").alias("least"))
    most = F.col("n") - F.ceil(F.col("least") * F.col("n") - 1e-9) + 1
    sized = (F.col("m") >= F.col("least") * F.col("n") - 1e-9) & (F.col("m") * F.col("least") <= F.col("n") + 1e-9)
    found = scored(ranked.join(begun, key).filter(F.col("place") <= most).join(terms, "t").filter(sized))
    best = F.max_by(F.struct("slot", "jaccard"), F.struct(F.col("jaccard"), -F.col("slot")))
    return found.groupBy(key).agg(best.alias("b")).select(key, F.col("b.slot").alias("best"), F.col("b.jaccard").alias("jaccard"))


def document_frequency(pages: DataFrame, key: str, tokens: Column) -> DataFrame:
    """(term, df): pages that hold each term."""
    return pages.select(key, F.explode(F.array_distinct(tokens)).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def rare_coverage(pages: DataFrame, key: str, tokens: Column, target: str, rare: int = 3, least: int = 4) -> DataFrame:
    """(key, n_rare, n_found, coverage): how many of a page's rare terms its target body holds."""
    terms = pages.select(key, F.explode(F.array_distinct(tokens)).alias("term"))
    few = terms.groupBy("term").agg(F.count(F.lit(1)).alias("df")).filter(F.col("df") <= rare).select("term")
    # Rare terms go back to their page as an array, so that no body travels with its terms.
    rarest = terms.join(few, "term").groupBy(F.col(key).alias("rare_key")).agg(F.collect_list("term").alias("rarest"))
    found = F.size(F.filter("rarest", lambda t: F.contains(F.col(target), t)))
    own = pages.join(rarest, F.col(key) == F.col("rare_key")).select(key, F.size("rarest").cast("long").alias("n_rare"), found.cast("long").alias("n_found"))
    return own.filter(F.col("n_rare") >= least).withColumn("coverage", F.col("n_found").cast("double") / F.col("n_rare"))


def signature(body: Column) -> Column:
    """(header, frames, lemmas): dashed number, ornate brackets, names."""
    from quire.functions.folio import folio

    names = F.regexp_extract_all(body, F.lit(LEMMAS), F.lit(1))
    return F.struct(folio(body, "dashed_line").alias("header"), F.regexp_count(body, F.lit("﴾")).alias("frames"), F.array_sort(names).alias("lemmas"))


def signature_score(a: Column, b: Column) -> Column:
    """0 to 1: headers weigh two if both are there, frames and lemmas one each."""
    headers = a["header"].isNotNull() & b["header"].isNotNull()
    same_names = (F.array_distinct(a["lemmas"]) == F.array_distinct(b["lemmas"])) & (F.size(a["lemmas"]) == F.size(b["lemmas"]))
    points = F.when(headers & (a["header"] == b["header"]), 2).otherwise(0) + (a["frames"] == b["frames"]).cast("int") + same_names.cast("int")
    return points.cast("double") / F.when(headers, 4).otherwise(2)


def alignment(targets: DataFrame, sources: DataFrame) -> DataFrame:
    """(page, own_score, best, best_score) of targets that do not fit the source of their own number.

    Both sides are (page, body). A failing target may belong to a source that shares its header, or frames
    and names where it has either: without a header a score of one needs both of them equal, and what
    shares neither is no place for it. What such a source scores depends only on which of the three it
    shares and on whether it has a header, so of all sources that share the same the one with the lowest page
    stands for them, and a signature meets six sources at most, however many pages have it. Targets
    without a partner have no row.
    """
    t = targets.select("page", signature(F.col("body")).alias("sig"))
    s = sources.select(F.col("page").alias("slot"), signature(F.col("body")).alias("source_sig"))
    signal = F.col("sig.header").isNotNull() | (F.col("sig.frames") > 0) | (F.size("sig.lemmas") > 0)
    own = t.filter(signal).join(s, F.col("page") == F.col("slot")).select("page", "sig", signature_score(F.col("sig"), F.col("source_sig")).alias("own_score"))
    failing = own.filter("own_score < 0.999")

    def shared(sig: str, headed: list[Column]) -> Column:
        """Keys of what is shared: header, frames and names in their combinations, or the latter two by whether the source has a header."""
        header, frames, lemmas = (F.col(f"{sig}.{c}") for c in ("header", "frames", "lemmas"))
        names = F.concat(F.array_join(F.array_distinct(lemmas), " "), F.lit(":"), F.size(lemmas).cast("string"))
        f, both = frames.cast("string"), F.concat(frames.cast("string"), F.lit(":"), names)
        with_header = [F.concat(F.lit(f"{k}|"), header, *[x for c in rest for x in (F.lit("|"), c)]) for k, rest in (("hfl", [both]), ("hf", [f]), ("hl", [names]), ("h", []))]
        plain = [F.when(((frames > 0) | (F.size(lemmas) > 0)) & when, F.concat(F.lit(kind), both)) for kind, when in zip(("with|", "without|"), headed, strict=True)]
        return F.array_compact(F.array(*with_header, *plain))

    has = F.col("source_sig.header").isNotNull()
    kinds = s.groupBy("source_sig").agg(F.min("slot").alias("slot")).withColumn("k", F.explode(shared("source_sig", [has, ~has])))
    first = kinds.groupBy("k").agg(F.min_by(F.struct("slot", "source_sig"), "slot").alias("s")).select("k", "s.slot", "s.source_sig")
    asked = failing.select("sig").distinct().withColumn("k", F.explode(shared("sig", [F.lit(True), F.lit(True)])))
    scored = asked.join(first, "k").select("sig", "slot", signature_score(F.col("sig"), F.col("source_sig")).alias("score"))
    best = scored.groupBy(F.col("sig").alias("of")).agg(F.max_by(F.struct("slot", "score"), F.struct("score", -F.col("slot"))).alias("b"))
    return failing.join(best, F.col("sig").eqNullSafe(F.col("of"))).select("page", "own_score", F.col("b.slot").alias("best"), F.col("b.score").alias("best_score"))


def header_plan(targets: DataFrame, sources: DataFrame) -> DataFrame:
    """(page, to_page, collides, overwrites): where each target's header says that it belongs.

    Both sides are (page, header). A place claimed twice collides; one that holds another target that
    stays overwrites.
    """
    true = sources.filter("header is not null").groupBy("header").agg(F.min("page").alias("to_page"))
    plan = targets.filter("header is not null").join(true, "header").filter("page != to_page").select("page", "to_page")
    claims = plan.groupBy("to_page").agg((F.count(F.lit(1)) > 1).alias("collides"))
    staying = targets.select("page").join(plan.select("page"), "page", "left_anti").select(F.col("page").alias("to_page"), F.lit(True).alias("stays"))
    return plan.join(claims, "to_page").join(staying, "to_page", "left").select("page", "to_page", "collides", F.coalesce("stays", F.lit(False)).alias("overwrites"))


def top_line(pages: DataFrame, key: str, body: str) -> DataFrame:
    """(key, n_lines, top, top_count): the most frequent line with text; at a tie the smallest text."""
    rows = pages.select(key, F.explode(F.split(text.clean(F.col(body)), "\n", -1)).alias("line")).filter("line rlike '(?U)\\\\S'")
    counts = rows.groupBy(key, "line").agg(F.count(F.lit(1)).alias("n"))
    order = W.partitionBy(key).orderBy(F.col("n").desc(), "line")
    ranked = counts.withColumns({"r": F.row_number().over(order), "n_lines": F.sum("n").over(W.partitionBy(key))})
    return ranked.filter("r = 1").select(key, "n_lines", F.col("line").alias("top"), F.col("n").alias("top_count"))


def top_window(pages: DataFrame, key: str, body: str, size: int = 12) -> DataFrame:
    """(key, top, top_count, looped): the most frequent window of characters, and whether a body is mostly that.

    looped needs a body over 500 characters of which a third is starts of a window that does not look like words.
    Windows are counted within a page's row: bodies of one key and length together, of others by themselves.
    """
    own = pages.filter(F.length(body) > size).groupBy(key, F.length(body).alias("n_body")).agg(F.collect_list(body).alias("bodies"))
    counts = own.select(key, "n_body", udf.top_window(F.col("bodies"), size).alias("c"))
    most = F.max_by(F.struct("c.w", "c.n", "n_body"), F.struct(F.col("c.n").alias("n"), F.hex(F.col("c.w")).alias("tie")))
    top = counts.groupBy(key).agg(most.alias("t"))
    letters = F.regexp_count(F.col("t.w"), F.lit("[A-Za-z ]"))
    worded = F.col("t.w").contains(" ") & (2 * letters > size)
    looped = (F.col("t.n_body") > 500) & (3 * F.col("t.n") > F.col("t.n_body")) & ~worded
    return top.select(key, F.col("t.w").alias("top"), F.col("t.n").alias("top_count"), looped.alias("looped"))


def fingerprint_terms(body: Column, stop: list[str], k: int = 6) -> Column:
    """The k longest distinct Arabic words of five letters or more; of equal lengths the smallest come first."""
    found = F.array_distinct(F.regexp_extract_all(body, F.lit(f"[{chars.ARABIC_BLOCK}]{{5,}}"), F.lit(0)))
    kept = F.filter(found, lambda w: ~w.isin(*stop)) if stop else found
    ranked = F.array_sort(F.transform(kept, lambda w: F.struct((-F.length(w)).alias("n"), w.alias("w"))))
    return F.transform(F.slice(ranked, 1, k), lambda x: x["w"])
