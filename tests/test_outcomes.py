"""Structure findings and their verdict, figures in place, cut-off sources, alignment with hot signatures."""

from quire.operators import checks, duplicates, relate, sweeps


def test_structure_and_verdict(spark):
    records = [(1, "t", "s"), (2, " ", "s"), (3, "t", None), (3, "t", "s"), (9, "t", "s")]
    found = checks.structure(spark.createDataFrame(records, "page long, title string, scan string"), spark.createDataFrame([(k,) for k in range(1, 5)], "page long"))
    assert sorted((r.rule, r.page) for r in found.collect()) == [("missing-page", 4), ("no-scan", 3), ("repeated-page", 3), ("unexpected-page", 9), ("untitled", 2)]
    assert {r.reason: r.n_findings for r in checks.verdict(found).collect()} == {"record count/contiguity": 3, "untitled pages": 1}
    clean = checks.structure(spark.createDataFrame(records[:1], "page long, title string, scan string"), spark.createDataFrame([(1,)], "page long"))
    assert checks.verdict(clean).collect() == []


def test_figures_in_place(spark):
    figures = spark.createDataFrame([(1, 7, -1), (2, 7, 0), (3, 7, 99), (4, 7, 0), (5, 8, 0), (6, 8, -1), (7, 9, 1)], "figure int, page long, after_block int")
    blocks = spark.createDataFrame([(7, 0), (7, 1), (9, 0), (10, 0)], "page long, block int")
    got = sorted(map(tuple, relate.place_figures(figures, blocks, "page").collect()), key=lambda r: r[:2])
    assert got == [(7, 1, 1, None), (7, 2, None, 0), (7, 3, 2, None), (7, 4, 4, None), (7, 5, None, 1), (7, 6, 3, None), (8, 1, 6, None), (9, 1, None, 0), (9, 2, 7, None), (10, 1, None, 0)]


def test_cut_off_sources(spark):
    whole = "سطر\n" * 200
    files = {1: whole[:300], 2: whole.strip(), 3: "x" + whole[:300], 4: whole[:700], 5: whole[:300].replace("\n", " ")}
    content = [(k, "en", f"Arabic:\n{v}\n\nEnglish:\nkept\n") for k, v in files.items()]
    sources = [(k, whole) for k in files]
    got = {r.page: r.content for r in sweeps.restore_truncated(spark.createDataFrame(content, "page long, layer string, content string"), spark.createDataFrame(sources, "page long, body string")).collect()}
    assert set(got) == {1, 5} and all(c == f"Arabic:\n{whole.strip()}\n\nEnglish:\nkept\n" for c in got.values())


def test_alignment_of_hot_signatures(spark):
    """By brute force: all targets share frames, headers are off by seven, some have none."""
    n = 60
    body = lambda k, shift: (f"— {k + shift} —\n" if k % 3 else "") + "﴾ x" + (" Adam" if k % 4 == 0 else "")
    frame = lambda shift: spark.createDataFrame([(k, body(k, shift)) for k in range(n)], "page long, body string")
    got = {r.page: (r.own_score, r.best, r.best_score) for r in duplicates.alignment(frame(7), frame(0)).collect()}
    sig = lambda k, shift: (k + shift if k % 3 else None, 1, ("Adam",) if k % 4 == 0 else ())

    def score(a, b):
        headed = a[0] is not None and b[0] is not None
        return ((2 if headed and a[0] == b[0] else 0) + (a[1] == b[1]) + (a[2] == b[2])) / (4 if headed else 2)

    want = {}
    for k in range(n):
        own = score(sig(k, 7), sig(k, 0))
        met = [s for s in range(n) if (sig(k, 7)[0] is not None and sig(k, 7)[0] == sig(s, 0)[0]) or sig(k, 7)[1:] == sig(s, 0)[1:]]
        if own < 0.999 and met:
            best = max(met, key=lambda s: (score(sig(k, 7), sig(s, 0)), -s))
            want[k] = (own, best, score(sig(k, 7), sig(best, 0)))
    assert got == want and len(got) > 20
