"""Text functions, character classes and printed numbers."""

import html.entities
import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from quire.functions import chars, entities, folding, text, udf
from quire.functions.folio import DIALECTS, folio

T = F.col("t")


def test_clean_strips_all_white_space(column):
    assert column(text.clean(T), "t string", [("  a\r\nb\rc  \n",), (None,), ("",)]) == ["a\nb\nc", "", ""]


def test_fold_and_escape(column):
    assert column(text.fold_space(T), "t string", [(" a \n\tb ",)]) == ["a b"]
    assert column(text.html_escape(T), "t string", [("<a & b>",)]) == ["&lt;a &amp; b&gt;"]
    assert column(text.html_to_text(T), "t string", [("<p>a<b>b</b>&lt;x&gt;</p><i>&amp;lt;</i>",)]) == [" ab<x> &lt;"]


def test_crlf_in_bytes(column):
    rows = [(bytearray(b"\xff\r\n\r\xd0\xd0\n\x0d\x0a"),), (bytearray(b"\x10\xd0\xa0"),)]
    assert [bytes(b) for b in column(text.crlf_to_lf(T), "t binary", rows)] == [b"\xff\n\r\xd0\xd0\n\n", b"\x10\xd0\xa0"]


def test_artifacts(column):
    assert column(text.strip_artifacts(T), "t string", [("a\n--- PAGE 3 TRANSLATION ---\n\n\n\nb [Combined output x] c",)]) == ["a\n\nb  c"]


ART = "𐍈" * 400
PROSE = "The master said that the names were written in the book of letters."
INDO = "Dan nama itu tidak ada dalam kitab ini untuk yang lain dengan huruf."


@pytest.mark.parametrize(
    ("body", "lang", "want"),
    [
        (PROSE, "en", True), (INDO, "id", True), (PROSE, "id", False), (INDO, "en", False), (ART, "en", False), ("", "en", False), ("too short", "en", False),
        ("(No English text on this page)", "en", False), ("[NO VISIBLE TEXT]", "en", True), ("[no visible text]", "id", False),
        ("Tidak ada teks pada halaman ini.", "id", False), ("بسم الله الرحمن الرحيم " * 4, "en", False), (PROSE + " — ٥٣ —", "en", True), (PROSE, None, True),
    ],
)
def test_translation_like(column, body, lang, want):
    assert column(text.is_translation_like(T, lang), "t string", [(body,)]) == [want]


def test_contamination_runs(column):
    rows = [("a ب ت b",), ("ﷲ x",), ("٣ 4",), ("é ā ∑ × —",), ("\U0001ee00",), ("مِن",)]
    assert column(chars.runs(T, chars.ARABIC_FULL), "t string", rows) == [["ب", "ت"], ["ﷲ"], ["٣"], [], ["\U0001ee00"], ["مِن"]]


def test_ratios_and_digits(column):
    assert column(chars.arabic_ratio(T), "t string", [("",), ("ابab",), ("١٢",)]) == [0.0, 0.5, 0.0]
    assert column(chars.ascii_digits(T), "t string", [("١٢ ۳4",)]) == ["12 34"]
    assert column(chars.longest(chars.runs(T, chars.DIGITS)), "t string", [("a12 ٣٤٥",), ("",)]) == [3, 0]
    assert column(chars.symbol_load(T), "t string", [("ab—",), ("a○",), ("  ",)]) == [0.0, 0.5, 0.0]


@pytest.mark.parametrize(
    ("source", "want"),
    [
        ("قال الله تعالى", True), ("قال اللَّه تعالى", True), ("وبالله\nتعالى", True), ("لله تعالى", True), ("ﷲ تعالى", True),
        ("الله عز تعالى", False), ("xالله تعالى", False), ("عبدالله تعالى", False), ("الله تعالىx", False), ("الله", False),
    ],
)
def test_honorific(column, source, want):
    assert column(udf.needs_honorific(T), "t string", [(source,)]) == [want]


def test_folds(column):
    assert column(folding.fold(T), "t string", [("Élan ’x",), (None,), ("",), ("ÀÉ e\u0301 Straße",)]) == ["elan 'x", None, "", "ae e straße"]
    assert column(udf.casefold(T), "t string", [("Straße",)]) == ["strasse"]
    assert column(folding.fold_ratio(T), "t string", [("",), ("مَ",), ("ﬁ",), ("abcﷺ",)]) == [0.0, 0.5, 2.0, 21 / 4]


def test_folding_by_the_standard(column):
    codes = [*range(0x80, 0x3000, 3), *range(0xF900, 0xFFFF, 5), *range(0x1D400, 0x1D800, 7)]
    texts = [chr(c) + "x" for c in codes]
    marks = lambda x: "".join(c for c in unicodedata.normalize("NFD", x.lower()) if unicodedata.category(c) != "Mn").translate({0x2019: "'", 0x02BB: "'", 0x02BE: "'"})
    for t, got in zip(texts, column(folding.fold(T), "t string", [(t,) for t in texts]), strict=True):
        assert got == marks(t) or len(unicodedata.normalize("NFD", t.lower())) > 2, t
    plain = lambda x: [c for c in unicodedata.normalize("NFKD", x) if unicodedata.category(c)[0] != "M" and c != "ـ"]
    assert column(folding.fold_length(T), "t string", [(t,) for t in texts]) == [len(plain(t)) for t in texts]
    assert column(folding.contains(T, "ETÉ"), "t string", [("l'été",), ("thé",), ("",), (None,)]) == [True, False, False, None]


def test_references_as_the_standard_library_reads_them(column):
    rnd = random.Random(1)
    texts = ["&" + n for n in sorted(html.entities.html5)] + [f"&#{k};" for k in [*range(300), 0xD800, 0xFDD0, 0xFFFE, 0x1FFFF, 0x10FFFF, 0x110000, 99999999999]] + ["&notit;", "&", "&&amp;&", "&#x;", "& amp;", "&amp;lt;", "&#0000000000065;", ""]
    bits = ["&", "#", "x", "4", "1", ";", "amp", "lt", "not", "it", " ", "é", "eacute", "NotEqualTilde", "\n", "<", "&quot"]
    texts += ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 12))) for _ in range(1500)]
    assert column(entities.unescape(T), "t string", [(t,) for t in texts] + [(None,)]) == [html.unescape(t) for t in texts] + [None]


@pytest.mark.parametrize(
    ("body", "want"),
    [
        ("\n16\ntext", ("16", None, "16", "16", None, None, "16")), ("— ٥٣ —\nx", ("53", "53", "53", "53", "53", None, "53")),
        ("no number\n7", (None, None, "7", "?", None, None, None)), ("(12)\n", ("12", "12", "12", "12", None, "12", "12")), ("", (None,) * 3 + ("?",) + (None,) * 3),
        ("a-1 b22\n", ("1", "1", "122", "122", None, None, None)), ("1234\nx", ("123", None, "1234", "1234", None, None, None)),
    ],
)
def test_seven_folios(column, body, want):
    for name, w in zip(DIALECTS, want, strict=True):
        assert column(folio(T, name, F.lit(20)), "t string", [(body,)]) == [w], name


def test_snippets_and_ages(column):
    cut, at = text.snippet(T, F.lit(70), F.lit(4))
    [got] = column(F.struct(cut, at), "t string", [("a" * 70 + "word" + "b" * 100,)])
    assert got[0] == "…" + "a" * 60 + "word" + "b" * 80 + "…" and got[1] == 60
    now = F.lit("2024-01-02 00:00:00").cast("timestamp")
    assert column(text.age_seconds(T, now), "t string", [("2024-01-01T23:59:00",), ("2024-01-01T22:00:00+00:00",), ("junk",), (None,)]) == [60.0, 7200.0, float("inf"), float("inf")]
    assert column(text.page_list(T), "t string", [("1-3, 7",), ("x, 4-2",)]) == [[1, 2, 3, 7], []]


def test_verb_frame(column):
    from quire.operators import repair

    assert column(repair.verb_frame(T), "t string", [("x. God Most High above all",), ("by God Most High. above",)]) == ["x. He is exalted above all", "by God Most High. above"]


def test_collations_are_compared_once_for_each_spelling(spark):
    """Pages of one class of spellings meet under one plain string, counted once, and no page takes part in comparing collations."""
    from quire.operators import search

    rows = [(1, "Élan elan x"), (1, "ELAN"), (2, "élan Straße"), (3, "strasse y"), (None, "elan"), (4, None)]
    found = search.loose_terms(spark.createDataFrame(rows, "page int, body string"), "page", "body")
    got = {r.term: (r.n_pages, r.n) for r in found.collect()}
    assert got["ELAN"] == (2, 5) and got["x"] == (1, 1) and got["y"] == (1, 1)
    grouped = [line for line in found._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Aggregate" in line and "collate" in line]
    assert grouped and not any("page#" in line for line in grouped)


def test_terms_meet_where_their_page_is(spark):
    """The index shuffles texts by page, once, and cuts them into terms once; pages of one number still count together."""
    from quire.operators import search

    rows = [(1, "b a b"), (1, "A"), (2, None), (3, ""), (None, "x x")]
    index = search.inverted_index(spark.createDataFrame(rows, "page int, body string"), "page", "body")
    plan = index._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert plan.count("Exchange hashpartitioning") == 1 and "hashpartitioning(term" not in plan and plan.count("regexp_extract_all") == 1
    assert sorted((r.term, r.page or 0, r.positions) for r in index.collect()) == [("a", 1, [0, 1]), ("b", 1, [0, 2]), ("x", 0, [0, 1])]


def test_symbols_and_words_are_counted_as_by_one_pattern_each(column):
    rng = random.Random(3)
    texts = ["", None, "K a b c", "a'b c-d e’f 'g", "abcdefgh", "a b c", "a b c d", "1a2b3c4d", "éaébécéd", "a\nb\nc\nd e"]
    texts += ["".join(rng.choices("ab '’-  　\x85\t\n\x1cé—–٣२9ابجx\U00010348😀ß", k=rng.randint(0, 60))) for _ in range(400)]
    rows, run = [(t,) for t in texts], lambda c: column(c, "t string", rows)
    assert run(chars.prose_from(T, 4)) == [None if n is None else n >= 4 for n in run(chars.prose_score(T))]
    pattern = r"(?U)[^\x00-\x7F" + chars.ARABIC_LETTERS + r"\s\p{Nd}—–]"
    assert run(chars.symbol_count(T)) == run(F.regexp_count(T, F.lit(pattern)))
    solid = run(F.length(T) - F.regexp_count(T, F.lit(r"(?U)\s")))
    assert run(chars.symbol_load(T)) == [n / s if s else 0.0 for n, s in zip(run(chars.symbol_count(T)), solid, strict=True)]
