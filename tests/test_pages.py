"""A small book on disk: readers, joins, validators, audits, search and sinks."""

import json
import random

import pytest
from pyspark.sql import functions as F

from quire.functions import dims
from quire.operators import checks, duplicates, relate, search
from quire.sources import scan, sinks

PROSE = "— 1 —\nThe master said that the names were written in the book of letters and of numbers."
INDO = "— 1 —\nGuru itu berkata bahwa nama tersebut ditulis dalam kitab huruf serta bilangan besar."
SOURCE = "— ١ —\nقال الشيخ في كتاب الحروف"


def book(tmp_path, **change):
    files = {
        "ar/page_001.txt": SOURCE, "en/page_001.txt": f"Arabic:\n{SOURCE}\n\nEnglish:\n{PROSE}\n", "id/page_001.txt": f"Arabic:\n{SOURCE}\n\nIndonesia:\n{INDO}\n",
        "ar/page_002.txt": "---\nThere is no text on this page.\n---", "en/page_002.txt": "Arabic:\n---\nThere is no text on this page.\n---\n\nEnglish:\n[NO VISIBLE TEXT]\n",
        "id/page_002.txt": "Arabic:\n---\nThere is no text on this page.\n---\n\nIndonesia:\n[TIDAK ADA TEKS TERLIHAT]\n",
    } | change
    for name, body in files.items():
        if body is not None:
            (tmp_path / name).parent.mkdir(exist_ok=True)
            (tmp_path / name).write_bytes(body if isinstance(body, bytes) else body.encode())
    return tmp_path


def load(spark, root):
    src = scan.layer(spark, str(root / "ar"), "ar").select("page", F.col("content").alias("body"))
    files = scan.layers(spark, {"en": str(root / "en"), "id": str(root / "id")})
    return src, files


def dataset(spark, root):
    src, files = load(spark, root)
    from quire.operators import blocks

    body = lambda g: files.filter(F.col("layer") == g).select("page", blocks.body_of(blocks.parse_lines(F.col("content")), dims.LANGS[g]).alias("body"))
    return scan.records(scan.dense_pages(spark, 2, {"ar": src, "en": body("en"), "id": body("id")}))


def test_valid_book(spark, tmp_path):
    root = book(tmp_path)
    src, files = load(spark, root)
    reports = checks.validate(files, src, dataset(spark, root))
    assert [(r.page, r.ok, r.blank_source, r.errors) for r in reports.orderBy("page").collect()] == [(1, True, False, []), (2, True, True, [])]
    assert tuple(checks.sweep_totals(reports).first()) == (2, 2, 0)
    assert checks.triage(files, src).filter("page = 1").collect() == []


@pytest.mark.parametrize(
    ("change", "want"),
    [
        ({"en/page_001.txt": f"English:\n{PROSE}"}, "missing required labels: Arabic"),
        ({"en/page_001.txt": f"Arabic:\n{SOURCE}\n\nEnglish:\n{PROSE}\nEnglish:\nx"}, "duplicate labels: English"),
        ({"en/page_001.txt": f"Arabic:\n{SOURCE}x\n\nEnglish:\n{PROSE}"}, "embedded Arabic differs"),
        ({"en/page_001.txt": f"Arabic:\n{SOURCE}\n\nEnglish:\n(No English text on this page)"}, "fallback text is not allowed"),
        ({"id/page_001.txt": None}, "id: file missing"),
        ({"en/page_001.txt": f"Arabic:\n{SOURCE}\n\nEnglish:\n"}, "block is empty"),
        ({"id/page_001.txt": f"Arabic:\n{SOURCE}\n\nIndonesia:\n{INDO}\nEnglish:\nx"}, "unexpected labels: English"),
    ],
)
def test_one_mutation_one_error(spark, tmp_path, change, want):
    root = book(tmp_path, **change)
    src, files = load(spark, root)
    [r] = checks.validate(files, src, dataset(spark, root)).filter("page = 1").collect()
    assert not r.ok and any(want in e for e in r.errors)


def test_blank_pages_want_their_marker(spark, tmp_path):
    root = book(tmp_path, **{"en/page_002.txt": "Arabic:\n---\nThere is no text on this page.\n---\n\nEnglish:\nNo text here at all"})
    src, files = load(spark, root)
    [r] = checks.validate(files, src, dataset(spark, root)).filter("page = 2").collect()
    assert any("exact marker" in e for e in r.errors)


def test_triage_findings(spark, tmp_path):
    bad = f"Arabic:\n{SOURCE}\n\nEnglish:\n— 9 —\nexalted is He above all that they say نص of him and more words."
    src, files = load(spark, book(tmp_path, **{"en/page_001.txt": bad, "id/page_001.txt": "Indonesia:\nx"}))
    got = {(r.rule, r.layer) for r in checks.triage(files, src).filter("page = 1").collect()}
    assert got == {("untranslated", "en"), ("wrong-page", "en"), ("banned-honorific", "en"), ("malformed-labels", "id")}


def test_worker_output(spark):
    rows = [(1, "en", f"Arabic:\n{SOURCE}\n\nEnglish:\n{PROSE}", SOURCE), (2, "en", f"Arabic:\nx\n\nEnglish:\nwhat what [...] قال الشيخ في كتابالحروفكلها", SOURCE), (3, "en", "none", SOURCE)]
    got = {(r.page, r.rule) for r in checks.worker_output(spark.createDataFrame(rows, "page int, layer string, raw string, source string")).collect()}
    assert got == {(2, "embedded-differs"), (2, "scratchpad"), (2, "truncation"), (2, "untranslated"), (3, "label-count"), (3, "empty-target")}


def test_scans(spark, tmp_path):
    root = book(tmp_path, **{"ar/page_003.txt": b"a\xffb", "ar/notes.txt": "x"})
    got = {r.page: r.content for r in scan.layer(spark, str(root / "ar"), "ar").collect()}
    assert set(got) == {1, 2, 3} and got[3] == "a�b"
    dense = scan.dense_pages(spark, 4, {"ar": scan.layer(spark, str(root / "ar"), "ar").select("page", "content")})
    assert {r.page: r.ar == "" for r in dense.collect()} == {1: False, 2: False, 3: False, 4: True}
    stages = scan.stage_of(spark, {"raw": str(root / "ar"), "translated": str(root / "en")}, 4)
    assert {r.page: r.status for r in stages.collect()} == {1: "translated", 2: "translated", 3: "pending", 4: "pending"}
    (root / "manifest.json").write_text('{"total_pages": 7}')
    assert scan.total_pages(str(root / "manifest.json")) == 7 and scan.total_pages(str(root / "none")) == 604
    (root / "log.jsonl").write_text('{"action": "claim", "page": 1}\n\n{"action": "start", "page": 1}\n')
    assert [r.action for r in scan.event_log(spark, str(root / "log.jsonl")).collect()] == ["claim", "start"]


def test_tolerant_import(spark):
    shapes = [[{"page": 1, "text": {"en": "a"}}, {"p": 2, "en": "b"}, {"n": 99, "en": "x"}, {"page": 1, "body": {"en": "c"}}], {"pages": [{"number": 3, "translation": {"id": "d"}, "scan": "s"}]}]
    df = spark.createDataFrame([(json.dumps(s),) for s in shapes], "j string")
    got = {r.page: (r.en, r.id, r.scan) for r in scan.tolerant_records(df, "j", 10).collect()}
    assert got == {1: ("c", "", None), 2: ("b", "", None), 3: ("", "d", "s")}
    with pytest.raises(Exception, match="no pages found"):
        scan.require_rows(df.filter("j is null"), "j").collect()
    with pytest.raises(Exception, match="must have one record"):
        scan.one_record(spark.createDataFrame([(1,), (1,)], "page int"), 1).collect()


def test_versions(spark):
    a = spark.createDataFrame([("x", b"1"), ("y", b"2"), ("z", b"3")], "path string, content binary")
    b = spark.createDataFrame([("x", b"1"), ("y", b"9"), ("w", b"4")], "path string, content binary")
    assert {r.path: r.change for r in scan.snapshot_changes(a, b).collect()} == {"y": "changed", "z": "removed", "w": "added"}
    v = spark.createDataFrame([(1, 1, "a"), (1, 2, None), (2, 1, None)], "page int, version int, title string")
    assert [tuple(r) for r in scan.newest_filled(v, "page", "version", "title").collect()] == [(1, "a")]


def test_near_copies_and_slots(spark):
    words = [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(60)]
    body = " ".join(words)
    rows = [(1, "en", body), (2, "en", " ".join(words[:50]) + " other end here"), (3, "en", body), (4, "en", "— 7 —\n" + "unrelated text " * 10)]
    pages = spark.createDataFrame(rows, "page long, layer string, body string")
    src = spark.createDataFrame([(4, "— 9 —\n")], "page long, body string")
    got = {(r.rule, r.page, r.other_page) for r in checks.copy_forward(pages, src).collect()}
    assert got == {("exact-duplicate", 3, 1), ("near-duplicate", 1, 2), ("near-duplicate", 2, 1), ("folio-mismatch", 4, None)}
    t = spark.createDataFrame([(1, "— 2 —\nAllah Musa"), (2, "— 2 —\nMusa")], "page long, body string")
    s = spark.createDataFrame([(1, "— 1 —\n"), (2, "— 2 —\nMusa"), (3, "— 2 —\nAllah Musa")], "page long, body string")
    assert [(r.page, r.best, r.best_score) for r in duplicates.alignment(t, s).collect()] == [(1, 3, 1.0)]
    plan = duplicates.header_plan(spark.createDataFrame([(1, "2"), (2, "3"), (5, "3"), (3, "3")], "page long, header string"), spark.createDataFrame([(2, "2"), (3, "3")], "page long, header string"))
    assert {(r.page, r.to_page, r.collides, r.overwrites) for r in plan.collect()} == {(1, 2, False, False), (2, 3, True, True), (5, 3, True, True)}


def test_degenerate_and_loops(spark):
    pages = spark.createDataFrame([(1, "\n".join(["[?]"] * 6 + ["x"])), (2, "\n".join(["○"] * 5 + ["y"])), (3, "a\nb\nc\nd"), (4, "x" * 600), (5, "word word " * 80)], "page int, body string")
    assert {(r.page, r.kind) for r in checks.degenerate(pages, "page", "body").collect()} == {(1, "unclear-marker"), (2, "repeated-glyph")}
    assert {r.page: r.looped for r in duplicates.top_window(pages.filter("page > 3"), "page", "body").collect()} == {4: True, 5: False}


def test_search(spark):
    pages = spark.createDataFrame([(1, "The Book of Letters"), (2, "letters of light"), (3, "nothing"), (4, "Letters, light and letters")], "page int, body string")
    assert [r.page for r in search.substring_search(pages, "page", "body", " LETTERS ").collect()] == [1, 2, 4]
    assert search.substring_search(pages, "page", "body", "l").collect() == []
    index = search.inverted_index(pages, "page", "body")
    assert {r.page: r.hits for r in search.match(index, "page", "Light letters").collect()} == {2: 2, 4: 3}
    assert search.match(index, "page", "!!").collect() == []
    assert [(r.page, r.total) for r in search.search_total(pages, "page", "body", "Letters", 2).collect()] == [(1, 3), (2, 3)]


def test_sinks(spark, tmp_path):
    pages = spark.createDataFrame([(1, "a" * 40, "s1"), (2, "b" * 40, "s1"), (3, "short", "s2")], "page int, body string, slug string")
    assert [tuple(r) for r in sinks.chapter_files(pages).collect()] == [("s1", f"===== PAGE 1 =====\n{'a' * 40}\n\n===== PAGE 2 =====\n{'b' * 40}")]
    store = pages.select(F.lit(1).alias("chapter_num"), F.col("page").alias("page_num"), F.col("body").alias("content"))
    sinks.analytical_store(store, spark.createDataFrame([(1, "s1")], "chapter_num int, slug string"), str(tmp_path / "db"))
    assert spark.read.parquet(str(tmp_path / "db" / "pages")).count() == 3
    assert json.loads(sinks.page_tree_json(store).first().data)[2] == {"page_num": 3, "content": "short"}
    merged = sinks.merged_pages(spark.createDataFrame([(1, "ا", "e", None)], "page int, ar string, en string, id string")).first().content
    assert merged == "Arabic:\nا\n\nEnglish:\ne\n\nIndonesia:\n[missing]"
    html = sinks.html_blocks(spark.createDataFrame([(1, 1, "prose", "a < نص")], "page int, paragraph int, kind string, body string")).first().html
    assert html == '<p>a &lt; <span class="ar">نص</span></p>'
    sinks.dataset_json(spark.createDataFrame([(1, "x")], "page int, t string"), str(tmp_path / "ds"))
    assert spark.read.json(str(tmp_path / "ds")).count() == 1


def test_relations(spark):
    base = spark.createDataFrame([(1, "a", "x"), (2, None, "y")], "k int, v string, w string")
    over = spark.createDataFrame([(2, "b"), (3, "c")], "k int, v string")
    assert {tuple(r) for r in relate.override(base, over, "k").collect()} == {(1, "a", "x"), (2, "b", "y"), (3, "c", None)}
    assert {tuple(r) for r in relate.restore(base, over, "k", "v").collect()} == {(1, "a", "x"), (2, "b", "y")}
    assert [r.chapter_num for r in relate.as_of(spark.createDataFrame([(5,), (11,), (604,)], "page long"), "page", dims.chapters(spark)).orderBy("page").collect()] == [0, 1, 40]
    figures = spark.createDataFrame([(1, 9)], "page int, after_block int")
    bl = spark.createDataFrame([(1, 1, "p"), (1, 2, "q")], "page int, block int, kind string")
    assert relate.nearest_block(figures, bl, "page").first().kind == "q"
    cases = [(0, 0), (3, 0), (3, 1), (2, 2), (1, 4)]
    got = spark.createDataFrame(cases, "a int, b int").coalesce(1).select(relate.bucket_delta(F.col("a"), F.col("b"))).collect()
    assert [r[0] for r in got] == ["clean", "now clean", "cleaner", "unchanged", "worse"]


def test_dataset_audit(spark):
    long_en = "The master said that the names were written in the book. " * 5
    rows = [(1, "ar", "— 1 —\nنص"), (1, "en", "— 3 —\n" + long_en), (2, "ar", "— 2 —"), (2, "en", "— 3 —\n" + long_en), (3, "en", "Dan nama itu tidak ada dalam kitab ini untuk yang lain dengan huruf dan angka yang ada di situ juga."), (4, "en", ""), (5, "id", "قال الشيخ الحروفكلهافيالكتاب [combined output x]"), (6, "en", "blank page")]
    got = {(r.rule, r.page, r.detail) for r in checks.dataset_audit(spark.createDataFrame(rows, "page long, layer string, body string")).collect()}
    assert got == {
        ("misfiled", 1, "1 vs 3"), ("off-by-one", 2, "2 vs 3"), ("duplicate-body", 2, None), ("coverage", 3, "not-translation-like"), ("wrong-language", 3, None), ("coverage", 4, "empty"),
        ("coverage", 5, "not-translation-like"), ("arabic-run", 5, None), ("batch-artifact", 5, None), ("coverage", 6, "placeholder"),
    }
    assert tuple(checks.blocking(checks.dataset_audit(spark.createDataFrame(rows, "page long, layer string, body string"))).first()) == (9, 0, True)


def test_large_dimensions_are_joined_by_cells(spark, monkeypatch):
    from quire.functions import dims
    from quire.operators import relate

    pages = spark.range(0, 700).withColumnRenamed("id", "page")
    want = relate.as_of(pages, "page", dims.chapters(spark)).select("page", "chapter_num")
    monkeypatch.setattr(relate, "SMALL_DIM", 3)
    got = relate.as_of(pages, "page", dims.chapters(spark)).select("page", "chapter_num")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    gaps = spark.createDataFrame([(5, 9, "a"), (20, 20, "b"), (30, None, "c")] + [(100 * k, 100 * k + 5, f"d{k}") for k in range(1, 3)], "start_page long, end_page long, name string").filter("name != 'c'")
    assert [r.name for r in relate.as_of(pages, "page", gaps).orderBy("page").collect()] == ["a" if 5 <= p <= 9 else "b" if p == 20 else f"d{p // 100}" if 100 <= p <= 205 and p % 100 <= 5 else None for p in range(700)]


def test_grid_art(column):
    from quire.operators import layout

    assert column(layout.is_grid_art(F.col("t")), "t string", [("☩" * 20,), ("☩" * 19,), ("a" * 30,)]) == [True, False, False]


def test_windows_are_counted_within_the_row(spark):
    """No window is a row of its own, bodies of one key and length count together, and ties go to the highest characters."""
    from collections import Counter

    from quire.functions import udf

    rnd = random.Random(3)
    for _ in range(60):
        texts = ["".join(rnd.choice(rnd.choice(["ab", "aé漢😀z", "abc \n"])) for _ in range(rnd.randint(0, 90))) for _ in range(rnd.randint(1, 3))]
        want = Counter(t[i : i + 12] for t in texts for i in range(len(t) - 12))
        assert udf.window_counts(texts, 12) == (max(((w, n) for w, n in want.items()), key=lambda x: (x[1], x[0])) if want else (None, 0))
    wide = "".join(map(chr, range(0x4E00, 0x4E00 + 9000)))
    assert udf.window_counts([wide + wide], 12)[1] == 2
    pages = spark.createDataFrame([(1, "ab" * 40), (1, "ba" * 40), (2, "abcdefghijklm"), (None, "x" * 20), (3, "x" * 12)], "page int, body string")
    found = duplicates.top_window(pages, "page", "body")
    assert sorted(found.collect(), key=str) == [(1, "ba" * 6, 68, False), (2, "abcdefghijkl", 1, False), (None, "x" * 12, 8, False)]
    assert "explode" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_triage_parses_each_file_once(spark):
    files = spark.createDataFrame([(1, "en", "Arabic:\nنص\n\nEnglish:\nshort\n")], "page int, layer string, content string")
    found = checks.triage(files, spark.createDataFrame([(1, "نص")], "page int, body string"))
    assert "Union" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert [(r.rule, r.severity, r.metric) for r in found.collect()] == [("empty", "error", 5.0)]


def test_near_pairs_shuffles_each_shingle_once_and_sets_by_parts(spark):
    rng = random.Random(7)
    passage = [f"p{c}" + "x" * rng.randint(1, 5) + chr(97 + rng.randint(0, 25)) for c in "abcdefghijklmnopqrstuvwxyz" * 3]
    word = lambda: "".join(rng.choices("abcdefghijklm", k=6))
    # A passage with little else on some pages, with much else on many: every page of the first kind pairs with all that hold it.
    texts = [" ".join([*passage, *(word() for _ in range(rng.randint(0, 20)))]) for _ in range(6)] + [" ".join([*(word() for _ in range(rng.randint(40, 200))), *passage]) for _ in range(200)]
    texts += [texts[0].replace(" ", "  "), " ".join(passage[:11]), "", None]
    pages = spark.createDataFrame([(3 * i + 1, t) for i, t in enumerate(texts)], "page long, body string").repartition(3)
    sets = {}
    for i, t in enumerate(texts[:206]):
        ws = "".join(c if c.isalpha() else " " for c in t).split()
        sets[3 * i + 1] = {tuple(ws[k : k + 12]) for k in range(len(ws) - 11)}
    keys = sorted(sets)
    want = {(a, b): len(sets[a] & sets[b]) for x, a in enumerate(keys) for b in keys[x + 1 :] if len(sets[a] & sets[b]) / min(len(sets[a]), len(sets[b])) > 0.6}
    assert len(want) > 1000
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = duplicates.near_pairs(pages, "page", "body")
        got = found.collect()
        plan = found._jdf.queryExecution().executedPlan().toString().split("\n")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert {(r.page_a, r.page_b): r.shared for r in got} == want and len(got) == len(want)
    assert all(r.containment == r.shared / min(len(sets[r.page_a]), len(sets[r.page_b])) for r in got)
    dealt = [line.split("Exchange hashpartitioning(")[1] for line in plan if "Exchange hashpartitioning(" in line and "ReusedExchange" not in line]
    # Before: texts twice, shingles to be counted and again to be joined, and a set with every pair.
    assert sum(x.startswith("_groupingexpression") for x in dealt) == 1 and sum(x.startswith("h#") for x in dealt) == 2
    held = spark.createDataFrame([(k, len(s), [hash(x) for x in s]) for k, s in sets.items()], "page long, n int, hs array<long>")
    met = spark.createDataFrame([(1, k) for k in keys[6:]], "small long, page long")
    assert duplicates.dealt_sets(met, held).filter("partners is not null").count() <= duplicates.PARTS < met.count()
