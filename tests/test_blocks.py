"""Parsers of labelled blocks, layout, and repair plans."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quire.functions import text
from quire.operators import blocks, layout, repair

T = F.col("t")


def parsed(column, body, profile="fixed"):
    [got] = column(blocks.parse_context(T, profile), "t string", [(body,)])
    return [(b.label, b.body, b.start_line) for b in got]


def test_own_line(column):
    assert parsed(column, "Arabic:\r\nنص\r\n\r\nEnglish:\r\nText\nmore\n") == [("Arabic", "نص", 0), ("English", "Text\nmore", 3)]


def test_inline_after_source_text(column):
    assert parsed(column, "Arabic: كتاب Indonesia: buku\nlagi") == [("Arabic", "كتاب", 0), ("Indonesia", "buku\nlagi", 0)]


def test_label_inside_prose_is_prose(column):
    assert parsed(column, "English:\nIts meaning in Arabic: I am He\nEnd") == [("English", "Its meaning in Arabic: I am He\nEnd", 0)]


def test_text_before_a_later_label(column):
    body = "Arabic:\nاول\nثاني Indonesia: dua"
    assert parsed(column, body) == [("Arabic", "اول\nثاني", 0), ("Indonesia", "dua", 2)]
    assert parsed(column, body, "compat") == [("Arabic", "اول", 0), ("Indonesia", "dua", 2)]


def test_repeated_and_missing(column):
    bs = blocks.parse_lines(T)
    rows = [("English:\na\nEnglish:\nb\nArabic: x\n",), ("none",), ("",), (None,)]
    assert column(blocks.duplicate_labels(bs), "t string", rows) == [["English"], [], [], []]
    assert column(blocks.body_of(bs, "English"), "t string", rows) == ["a", None, None, None]
    assert column(F.size(blocks.first_blocks(bs)), "t string", rows) == [1, 0, 0, 0]


def test_sections(column):
    body = "Arabic:\nا\nEnglish:\nhello\nNotes:\nn\nIndonesia：\nbuku"
    for dialect, label, want in (("line", "English", "hello\nNotes:\nn\nIndonesia：\nbuku"), ("colon_optional", "Indonesia", "buku"), ("first_english", "English", "hello"), ("bare", "Arabic", "ا"), ("lookahead", "English", "hello\nNotes:\nn\nIndonesia：\nbuku")):
        assert column(blocks.section(T, label, dialect), "t string", [(body,)]) == [want], dialect


@given(st.text("ab\n :AE", max_size=30), st.text("xy\n z", max_size=30))
@settings(max_examples=15, deadline=None)
def test_render_then_parse(spark, a, b):
    rows = spark.createDataFrame([(a, b)], "a string, b string").select(blocks.parse_lines(blocks.render(F.col("a"), "English", F.col("b"))).alias("p"))
    assert [(x.label, x.body) for x in rows.first().p] == [("Arabic", a.strip()), ("English", b.strip())]


def test_pages_of_a_chapter(column):
    [got] = column(blocks.split_pages(T), "t string", [("x\n=== PAGE 3 ===\nabc\n=== PAGE 4 ===\n\n=== PAGE 5 ===\nd",)])
    assert [tuple(p) for p in got] == [(3, "abc", 3), (5, "d", 1)]


def test_responses(column):
    marked = "--- PAGE 1 TRANSLATION ---\nEnglish:\na\n--- PAGE 2 TRANSLATION ---\nEnglish:\nb"
    split = lambda t, p, **k: column(blocks.split_response(T, F.lit(p), F.lit(False), **k), "t string", [(t,)])[0]
    assert split(marked, 2) == "English:\nb"
    assert split("--- PAGE 7 ---\nhi", 7) == "hi"
    assert split("junk", 1).startswith("Arabic:\n[combined output")
    assert split("junk", 1, profile="id") is None
    assert split("Arabic: [x]\nArabic:\nنص\nIndonesia:\nbuku", 1, profile="id") == "Arabic:\nنص\nIndonesia:\nbuku"


def test_line_kinds(column):
    want = {"": "blank", "— 24 —": "page_number", "❖ Notice": "ornament_heading", "(Section one": "section_heading", "12": "short_num", "○ ○ ○ ○": "grid", "1 2 3 4 5 6 7": "grid", "two words": "short_line", "a b c d": "prose"}
    assert column(layout.line_kind(T), "t string", [(k,) for k in want]) == list(want.values())


def test_paragraphs_join_lines(spark):
    body = "First line of words here\ncontinues on.\n\n(Section two\nshort\n○ ○ ○ ○\n○ ○ ○ ○\nA long sentence that ends here.\nNext one starts anew now"
    rows = layout.paragraphs(layout.lines(spark.createDataFrame([(1, body)], "page int, body string"), "page", "body"), "page").orderBy("paragraph").collect()
    assert [(r.kind, r.body) for r in rows] == [
        ("prose", "First line of words here continues on."), ("section_heading", "(Section two"), ("prose", "short"), ("grid", "○ ○ ○ ○ ○ ○ ○ ○"),
        ("prose", "A long sentence that ends here."), ("prose", "Next one starts anew now"),
    ]


def test_tables(column):
    body = "| a | b |\n|---|---|\n| c |\n"
    assert column(layout.table_rows(T), "t string", [(body,), ("no table",)]) == [[["a", "b"], ["c", ""]], []]
    assert column(layout.tokens(T), "t string", [(body + "x y",)]) == [["a", "b", "c", "x", "y"]]
    assert column(layout.first_difference(F.split(T, " "), F.array(F.lit("a"), F.lit("b"))), "t string", [("a c",), ("a b",), ("a",), ("a b c",)]) == [1, None, 1, 2]


def test_block_kinds(column):
    cases = [("— 9 —", 0, 9, "folio"), ("[NO VISIBLE TEXT]", 0, 1, "blank_notice"), ("| a | b |", 1, 9, "table"), ("[Row 1]\nx", 1, 84, "names_row"), ("[Inside the circle]\nx", 1, 9, "diagram"), ("x", 1, 6, "imprint"), ("*", 1, 9, "asterisk"), ("❖ x", 1, 9, "ornament"), ("## x", 1, 9, "heading"), ("a * b\nc * d", 1, 9, "verse"), ("a b", 1, 9, "prose")]
    got = column(layout.block_kind(T, F.col("i"), F.col("p")), "t string, i int, p int", [c[:3] for c in cases])
    assert got == [c[3] for c in cases]


PROSE = "The master said that the names were written in the book of letters."


@pytest.mark.parametrize(
    ("sibling", "action", "body"),
    [
        (f"Arabic:\nنص\n\nEnglish:\n{PROSE}", "recover", PROSE), (f"نص طويل English: {PROSE}", "recover", PROSE), (PROSE, "relabel", PROSE),
        ("", "translate", ""), ("English:\nshort", "translate", ""), ("نص " * 40, "translate", ""), (f"English:\n--- PAGE 1 TRANSLATION ---\n{PROSE}", "recover", PROSE),
    ],
)
def test_plans(column, sibling, action, body):
    [got] = column(repair.plan_block(T, "English", "en"), "t string", [(sibling,)])
    assert (got.action, got.body) == (action, body)


@pytest.mark.parametrize(("a", "b", "winner"), [("short", "long نص", "id"), ("نص", "x", "en"), ("x", "y", "en"), ("نص", "نصوص", "en")])
def test_choose(column, a, b, winner):
    assert column(repair.choose(F.col("a"), F.col("b"))["winner"], "a string, b string", [(a, b)]) == [winner]


def test_plan_and_apply(spark):
    src = spark.createDataFrame([(1, "— 1 —\nنص"), (2, "نص"), (3, "نص")], "page int, body string")
    files = spark.createDataFrame([(1, "id", f"Arabic:\nنص\n\nEnglish:\n— 1 —\n{PROSE}"), (2, "en", f"Arabic:\nنص\n\nEnglish:\n{PROSE}"), (1, "en", "old")], "page int, layer string, content string")
    plan = repair.plan_missing(files, src, "en")
    got = {r.page: (r.action, r.folio_match) for r in plan.collect()}
    assert got == {1: ("recover", True), 2: ("ok", False), 3: ("translate", False)}
    new = {r.page: r.content for r in repair.apply_plan(files, plan, src, "en").collect()}
    assert new[1] == f"Arabic:\n— 1 —\nنص\n\nEnglish:\n— 1 —\n{PROSE}\n" and new[2].endswith(f"English:\n{PROSE}")
    again = spark.createDataFrame([(p, "en", c) for p, c in new.items()], "page int, layer string, content string")
    assert {r.page: r.action for r in repair.plan_missing(again, src, "en").collect()} == {1: "ok", 2: "ok", 3: "translate"}


def test_labels_to_strip(spark):
    files = spark.createDataFrame([(1, "en", f"Arabic:\nا\nEnglish:\n{PROSE}\nIndonesia:\nx"), (2, "en", f"Arabic:\nا\nEnglish:\n{PROSE}\nEnglish:\n{PROSE} Other words."), (3, "en", f"Arabic:\nا\nEnglish:\n{PROSE}")], "page int, layer string, content string")
    got = {r.page: (r.foreign, r.duplicated, r.safe) for r in repair.strip_labels(files).collect()}
    assert got == {1: (["Indonesia"], [], True), 2: ([], ["English"], False)}


def test_other_repairs(column):
    [got] = column(repair.cell_plan(F.col("s"), F.col("b"), "[?]", "[?]"), "s string, b string", [("[?]" * 3, "head\n[?]\n[tak terbaca OCR]")])
    assert (got.verdict, got.want, got.got) == ("TRUNCATED", 3, 1) and got.body.count("[?]") == 3 and got.body.endswith("[tak terbaca OCR]")
    table = {"Dard": "Dardail", "Sam": "Samail"}
    [got] = column(repair.doubled_tails(T, table), "t string", [("by Dardaililil, and Samail.",)])
    assert (got.body, got.idempotent, got.problems) == ("by Dardail, and Samail.", True, [])
    assert column(repair.source_drift(F.col("a"), F.col("b")), "a string, b string", [("x y", "x  y"), ("ab", "abc"), ("a" * 300, "a" * 600), ("a", "zzzz")]) == ["same", "fixable", "truncated", "escalate"]
    [got] = column(repair.collapse(F.array(F.lit("— 3 —\nx"), F.lit("— 4 —\nlonger")), T), "t string", [("— 3 —\n",)])
    assert (got.body, got.reason) == ("— 3 —\nx", "folio match")
    [ok, bad] = column(repair.assemble(T, F.lit("نص"), "en"), "t string", [(PROSE,), (f"English:\n{PROSE}",)])
    assert ok.content == f"Arabic:\nنص\n\nEnglish:\n{PROSE}\n" and bad.content is None and bad.problem == "draft carries labels"


def test_batches(column):
    assert column(blocks.packed(T, 3), "t string", [("x" * 5001,), (" ",), ("a",)]) == ["x" * 5000 + "\n[truncated]", "[empty page]", "a"]
    assert column(text.wrap_arabic(T), "t string", [("a نص اخر b",)]) == ['a <span class="ar">نص اخر</span> b']
    nested = '{"output": [{"type": "message", "content": [{"type": "output_text", "text": "a"}, {"type": "output_text", "text": "b"}]}]}'
    assert column(blocks.payload_text(T), "t string", [(nested,), ("{}",)]) == ["ab", None]


def test_a_draft_is_judged_once(spark):
    rows = spark.createDataFrame([(1, PROSE), (2, f"English:\n{PROSE}"), (3, "")], "page long, t string").repartition(2)
    made = rows.select("page", repair.assemble(T, F.lit("نص"), "en").alias("a")).select("page", F.col("a.problem").alias("problem"), F.md5("a.content").alias("digest"))
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    # Once for the draft and once in the judgement of it; before, for each use of either.
    assert plan.count("TRANSLATION") == 2
    assert {r.page: (r.problem, r.digest is None) for r in made.collect()} == {1: (None, False), 2: ("draft carries labels", True), 3: ("empty draft", True)}


def test_labelled_is_whether_blocks_are_found(column):
    bodies = ["", "x", "English", "English : y", "a English: b", "بابEnglish: b", "Eng\x01lish: z", "\x01", "Arabic:", "Indonesia\n:", "english: n", "x\nIndonesia\t: y"]
    want = [len(x) > 0 for x in column(blocks.parse_context(T), "t string", [(b,) for b in bodies])]
    assert column(blocks.labelled(T), "t string", [(b,) for b in bodies]) == want and True in want and False in want
