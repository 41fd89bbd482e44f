"""Parts of the operators on their own: limits, splits and incremental runs."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quire.llm import _io, pieces, quality_model, repeats, secret_scan, shards, simhash, substring_dedup, suffix_dedup, topk


@given(st.binary(max_size=300))
@settings(max_examples=60, deadline=None)
def test_suffix_array_and_prefixes(raw):
    t = np.r_[np.frombuffer(raw, np.uint8).astype(np.uint16) + 2, np.uint16(0)].astype(np.uint16)
    sa = suffix_dedup.suffix_array(t)
    want = sorted(range(len(t)), key=lambda k: t[k:].tolist())
    assert sa.tolist() == want
    for length in (1, 3, 7):
        got = suffix_dedup.common_prefixes(t[sa - 1], length)
        same = [k > 0 and t[want[k] : want[k] + length].tolist() == t[want[k - 1] : want[k - 1] + length].tolist() for k in range(len(t))]
        assert got.tolist() == same


@pytest.mark.parametrize("limit", [100, 1000, 1 << 20])
@pytest.mark.parametrize("kind", [suffix_dedup.KIND, substring_dedup.KIND])
def test_index_over_small_and_large_groups(monkeypatch, limit, kind):
    rnd = random.Random(2)
    monkeypatch.setattr(repeats, "INDEX_SYMBOLS", limit)
    n = kind.window
    base = [rnd.choice(["a", "b", "c", "d"]) for _ in range(120)]
    lists = [base[a : a + rnd.randint(n, n + 30)] for a in range(60)] + [base[5:60] + ["z", "z"], base[:50], *[base[20 : 20 + n] + [str(k)[-1], str(k)[0]] for k in range(100)]]
    glue = "" if kind is suffix_dedup.KIND else " "
    texts = sorted({glue.join(x).encode() for x in lists if len(x) >= n})
    symbols = [list(t.decode()) if glue == "" else t.decode().split() for t in texts]
    low, count = np.array([rnd.randint(0, 9) for _ in texts]), np.array([rnd.randint(1, 2) for _ in texts])
    values, offset = repeats._find(kind, texts, np.zeros(len(texts), np.int64), low, count)
    least, times = {}, {}
    for x, i, c in zip(symbols, low.tolist(), count.tolist(), strict=True):
        for k in range(len(x) - n + 1):
            w = tuple(x[k : k + n])
            least[w], times[w] = min(i, least.get(w, i)), times.get(w, 0) + c
    for x, at in zip(symbols, offset, strict=True):
        windows = [tuple(x[k : k + n]) for k in range(len(x) - n + 1)]
        want = [(0 if times[w] > 1 else repeats.NO_ID) if kind.same_document else least[w] for w in windows]
        assert values[at : at + len(windows)].tolist() == want


@pytest.mark.parametrize("group", [3, 1 << 16])
def test_subtrees(monkeypatch, group):
    rnd = random.Random(3)
    monkeypatch.setattr(substring_dedup, "GROUP", group)
    words = [rnd.choice("abcd") for _ in range(90)]
    texts = [" ".join(words[a : a + n]).encode() for a, n in ((0, 60), (10, 50), (30, 60), (40, 36))] + [b" ".join([b"a"] * 50)]
    got = substring_dedup._index(texts).tolist()
    seen = [tuple(t.split()[k : k + 35]) for t in texts for k in range(len(t.split()) - 34)]
    assert len(set(zip(got, seen, strict=True))) == len(set(got)) == len(set(seen)) < len(seen)


@pytest.mark.parametrize("bits", [3, 7])
def test_large_buckets_are_split(monkeypatch, bits):
    import pandas as pd

    monkeypatch.setattr(simhash, "_SMALL", 4)
    rnd = random.Random(4)
    flip = lambda x, n: x ^ sum(1 << b for b in rnd.sample(range(64), n))
    centre = rnd.getrandbits(64)
    fp = np.array(sorted({flip(centre, rnd.randint(0, bits)) for _ in range(300)} | {rnd.getrandbits(64) for _ in range(50)}), np.uint64)
    rows = np.column_stack([simhash._keys(fp, bits), np.tile(fp, 64)])
    every, large = simhash._edges(rows, None, bits)
    some, rest = simhash._edges(rows, 5, bits)
    assert not large and rest
    rest = np.concatenate(rest).view(np.int64)
    read = lambda frames: [np.frombuffer(x, np.uint64).reshape(-1, 2) for pdf in frames for x in pdf["pairs"]]
    for blob in read(simhash._split_large(4, bits)(iter([pd.DataFrame({"a": rest[:, 0], "b": rest[:, 1]})]))):
        some += simhash._edges(blob, None, bits)[0]
    # The same with all keys known to be common beforehand: none is gathered whole, and what was split is not split again.
    at_once = [np.zeros((0, 2), np.uint64)]
    for blob in read(simhash._pack(4, bits, np.unique(rows[:, 0]))(iter([pd.DataFrame({"fp": fp.view(np.int64)})]))):
        found, large = simhash._edges(blob, 5, bits)
        assert not large
        at_once += found
    want = [(a, b) for a in fp.tolist() for b in fp.tolist() if (a ^ b).bit_count() <= bits]
    classes = []
    for links in (want, np.concatenate(every).tolist(), np.concatenate(some).tolist(), np.concatenate(at_once).tolist()):
        root = {x: x for x in fp.tolist()}

        def find(x, root=root):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in links:
            root[find(a)] = find(b)
        own = {}
        for x in root:
            own.setdefault(find(x), set()).add(x)
        classes.append(sorted(map(sorted, own.values())))
    assert classes[0] == classes[1] == classes[2] == classes[3]


def test_common_keys_change_no_component(spark, monkeypatch):
    rnd = random.Random(14)
    centre = rnd.getrandbits(63)
    fps = sorted({centre ^ sum(1 << b for b in rnd.sample(range(63), rnd.randint(0, 4))) for _ in range(400)} | {rnd.getrandbits(63) for _ in range(400)})
    nodes = spark.createDataFrame([(x,) for x in fps], "fp long")
    want = {tuple(r) for r in simhash.components(simhash.links(nodes, len(fps))).collect()}
    monkeypatch.setattr(simhash, "SAMPLE", 200)
    monkeypatch.setattr(simhash, "COMMON", 3)
    assert len(simhash._common_keys(nodes, len(fps), 3))
    assert {tuple(r) for r in simhash.components(simhash.links(nodes, len(fps))).collect()} == want and want


@pytest.mark.parametrize("chunk", [1, 7, 64])
def test_fingerprints_of_chunks(monkeypatch, chunk):
    rnd = random.Random(15)
    texts = ["", " \n ", "one", "One two", "A b\tC", "é\u2003x  y\x0bz" * 9, *(" ".join("w" * rnd.randint(1, 30) for _ in range(rnd.randint(1, 60))) for _ in range(30))]
    want = [simhash.fingerprint(t, w) for t in texts for w in (1, 3, 5)]
    monkeypatch.setattr(_io, "CHUNK", chunk)
    assert [simhash.fingerprint(t, w) for t in texts for w in (1, 3, 5)] == want
    assert [simhash.fingerprint(memoryview(t.encode()), w) for t in texts for w in (1, 3, 5)] == want


def test_memory_of_long_texts_is_bounded():
    import tracemalloc

    raw = b"some words of a very long text indeed " * 550_000  # 21 MB, 4.4 million words
    small = simhash.fingerprint(raw[: 38 * 1000])
    tracemalloc.start()
    assert simhash.fingerprint(raw).bit_count() - small.bit_count() < 8
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 48 << 20


def test_components(spark):
    rnd = random.Random(8)
    edges = [(rnd.randint(0, 60), rnd.randint(0, 60)) for _ in range(45)] + [(100 + k, 101 + k) for k in range(30)]
    got = {r.node: r.root for r in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {n: n for e in edges for n in e}
    for _ in range(100):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    assert got == {n: r for n, r in root.items() if n != r}


def test_ledger_is_incremental(spark):
    first = spark.createDataFrame([("a.txt", "token=abcdefgh1"), ("b.txt", "nothing"), ("c.txt", "token=abcdefgh1")], "path string, content string")
    ledger = secret_scan.scan_new(first).cache()
    assert ledger.count() == 2
    assert secret_scan.scan_new(first, ledger).count() == 0
    second = first.union(spark.createDataFrame([("d.txt", "AKIA" + "Z" * 16)], first.schema))
    assert secret_scan.scan_new(second, ledger).count() == 1
    changed = (secret_scan.Rule("access", r"AKIA[A-Z0-9]{13,}", 0, 17), *secret_scan.RULES[:1], *secret_scan.RULES[2:])
    again = secret_scan.scan_new(second, ledger, changed)
    assert {tuple(r.versions) for r in again.filter(F.col("blob") == secret_scan.address(F.lit("nothing"))).collect()} == {(changed[0].version,)}
    paths = secret_scan.secrets_by_path(first, ledger)
    assert {r.path: len(r.spans) for r in paths.collect()} == {"a.txt": 1, "b.txt": 0, "c.txt": 1}


def test_masked(column):
    span = "text string, s array<struct<start:bigint,rank:int,end:bigint,kind:string>>"
    rows = [("ab secret cd", [(3, 0, 9, "x")]), ("secret", [(0, 0, 6, "x"), (2, 1, 4, "y")]), ("😀ab", [(0, 0, 1, "x"), (1, 1, 2, "y")]), ("none", [])]
    assert column(secret_scan.masked(F.col("text"), F.col("s")), span, rows) == ["ab [SECRET] cd", "[SECRET]", "[SECRET]b", "none"]


def test_many_secrets_in_one_text(column, monkeypatch):
    monkeypatch.setattr(secret_scan, "FOLD", 3)
    monkeypatch.setattr(secret_scan, "SEGMENT", 7)
    rnd = random.Random(19)
    word = lambda: "".join(rnd.choice("aé😀 \n.") for _ in range(rnd.randint(0, 9)))
    texts = ["".join(word() + rnd.choice(["token=" + "abcdefgh" * rnd.randint(1, 3), "AKIA" + "Q" * 14, "f0" * 16, "token=abc "]) + " " for _ in range(rnd.randint(0, 25))) + word() for _ in range(20)]
    rule = secret_scan.RULES[0]
    rows = [(t,) for t in texts]
    found = column(secret_scan.spans(F.col("text"), rule, 0), "text string", rows)
    import re

    for t, spans in zip(texts, found, strict=True):
        assert [(s.start, s.end) for s in spans] == [m.span() for m in re.finditer(rule.pattern.replace("(?i:", "(?:"), t) if len(m[2]) >= 8]
    every = F.array_sort(F.concat(*[secret_scan.spans(F.col("text"), r, k) for k, r in enumerate(secret_scan.RULES)]))
    for t, got, spans in zip(texts, column(secret_scan.masked(F.col("text"), every), "text string", rows), column(every, "text string", rows), strict=True):
        want, end = "", 0
        for s in spans:
            if s.start > end or s.start == end == 0:
                want += t[end : s.start] + "[SECRET]"
            end = max(end, s.end)
        assert got == want + t[end:]


def test_groups_stay_together(spark):
    members = [(k, f"g{k // 4}") for k in range(400)] + [(1000 + k, f"only{k}") for k in range(400)] + [(5000 + k, "hot") for k in range(400)]
    rows = shards.assign(spark.createDataFrame(members, "id long, group string"), 6).collect()
    where, count = {}, {}
    for r in rows:
        where.setdefault(r.group, set()).add(r.shard)
        count[r.shard] = count.get(r.shard, 0) + 1
    assert sorted(count.values()) == [200] * 6
    small = [len(s) for g, s in where.items() if g.startswith("g")]
    assert sum(n > 1 for n in small) <= 10


def test_forest_learns():
    rnd = np.random.default_rng(1)
    x = rnd.normal(size=(2000, 5))
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] > 0)).astype(float)
    forest = quality_model.train(x[:1500], y[:1500])
    assert ((forest.score(x[1500:]) > 0.5) == y[1500:]).mean() > 0.95
    assert quality_model.train(x[:0], y[:0]).score(x[:3]).tolist() == [0.5] * 3


def test_cover_tree_bounds():
    rnd = np.random.default_rng(2)
    points = np.concatenate([rnd.integers(-9, 9, (150, 4)), np.zeros((20, 4), int)]).astype(float)
    tree = topk.build(points, 3)
    assert sorted(tree.order.tolist()) == list(range(len(points))) and len(tree.sizes) > 2
    for level, n in enumerate(tree.sizes):
        d = np.sqrt(((points - tree.centres[tree.leaf_of[level]]) ** 2).sum(1))
        assert (d <= tree.radius[level][tree.leaf_of[level]] + 1e-9).all() and tree.leaf_of[level].max() < n
    queries = rnd.integers(-9, 9, (30, 4)).astype(float)
    qt = topk.build(queries, 2)
    score = queries @ points.T
    worst = np.sort(score, 1)[:, -5]
    a, b, bound = topk.survivors(qt, tree, worst)
    pairs = dict(zip(zip(a.tolist(), b.tolist(), strict=True), bound.tolist(), strict=True))
    assert len(pairs) == len(a) < qt.sizes[-1] * tree.sizes[-1]
    for q, p in np.argwhere(score >= worst[:, None]):
        assert pairs[qt.leaf_of[-1][q], tree.leaf_of[-1][p]] >= score[q, p]


@pytest.mark.parametrize("spread", [0.5, 8, 400])
def test_dual_tree_search_is_exact_and_scores_fewer_pairs(spread):
    rnd = np.random.default_rng(3)
    centres = rnd.integers(-200, 200, (20, 6))
    points = (centres[rnd.integers(0, 20, 3000)] + rnd.normal(0, spread, (3000, 6))).astype(np.int64)
    ids = rnd.integers(0, 2500, 3000)
    queries, own = points[:200], ids[:200]
    q, i, s, scored = topk.search(queries, own, points, ids, 5, np.full(200, topk.NONE))
    for k in range(200):
        want = sorted((-int(points[j] @ queries[k]), int(ids[j])) for j in range(3000) if ids[j] != own[k])[:5]
        assert sorted(zip((-s[q == k]).tolist(), i[q == k].tolist(), strict=True)) == want
    assert scored < 200 * 3000 * (0.9 if spread < 100 else 1.01)


def test_huge_components_stay_at_the_limits():
    points = np.array([[2**62, 2**62], [1, 1], [-(2**62), -(2**62)]])
    _, i, s, _ = topk.search(points[:1], np.array([9]), points, np.arange(3), 3, np.full(1, topk.NONE))
    assert i.tolist() == [0, 1, 2] and s.tolist() == [2**63 - 1, 2**63 - 1, -(2**63) + 1]


@given(st.text(max_size=80))
@settings(max_examples=200, deadline=None)
def test_round_trip(text):
    v = _vocabulary()
    assert v.decode(v.encode(text)) == text


_kept = []


def _vocabulary():
    if not _kept:
        _kept.append(pieces.Vocabulary.load())
    return _kept[0]


def test_viterbi_finds_the_best_sum():
    vocabulary = [(k, p, s) for k, (p, s) in enumerate([("a", -3.0), ("b", -3.5), ("ab", -4.0), ("abc", -9.0), ("bc", -4.5), ("ca", -5.0), (" ", -1.0), (" a", -2.0)])]
    v = pieces.Vocabulary(vocabulary, list(range(100, 356)))
    score = {p: s for _, p, s in vocabulary}

    def best(t):
        if not t:
            return 0.0
        return max([best(t[:-n]) + score[t[-n:]] for n in range(1, 4) if t[-n:] in score and n <= len(t)] + ([best(t[:-1]) + v.unknown] if t[-1] not in score else []))

    total = lambda ids: sum(score[p] for i in ids for k, p, _ in vocabulary if k == i)
    rnd = random.Random(9)
    for _ in range(200):
        t = "".join(rnd.choice("abc ") for _ in range(rnd.randint(1, 9)))
        ids = v.viterbi(t)
        unknown = sum(i >= 100 for i in ids)
        assert abs(total(ids) + unknown * v.unknown - best(t)) < 1e-9


def test_a_large_part_does_not_shut_out_small_ones(spark):
    """Quotas of 48 rows: G's parts fit nowhere, H's two rows fit into the room of three, and must move."""
    parts = {"G": (40, 10, 1), "H": (5, 2, 0), "F": (0, 0, 47)}
    rows = [(g, s) for g, counts in parts.items() for s, n in enumerate(counts) for _ in range(n)]
    rows += [("single", 1)] * (144 - len(rows))
    linked = spark.createDataFrame([(k, g, s) for k, (g, s) in enumerate(rows) if g != "single"], "id long, group string, shard int")
    moves = 1
    while moves:
        linked, moves = shards._propagate(linked, 144, 3)
    found = {(r.group, r.shard): r.n for r in linked.groupBy("group", "shard").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert found["H", 0] == 7 and ("H", 1) not in found
    assert max(sum(n for (_, s), n in found.items() if s == k) for k in range(3)) <= 48


@pytest.mark.parametrize("times", [1, 4])
def test_trees_go_only_where_they_are_asked_for(spark, monkeypatch, times):
    """Clustered vectors: rows sent grow with the pairs of trees and query groups that bounds leave, not with trees times groups."""
    monkeypatch.setattr(topk, "TREE", 20)
    monkeypatch.setattr(topk, "QUERIES", 5)
    monkeypatch.setattr(topk, "PIVOTS", 8 * times)
    rnd = np.random.default_rng(7)
    n = 200 * times
    centres = rnd.normal(size=(8, 16))
    points = np.floor(256 * (centres[np.arange(n) % 8] + 0.01 * rnd.normal(size=(n, 16)))).astype(int)
    df = spark.createDataFrame([(k, p.tolist()) for k, p in enumerate(points)], "id long, v array<long>")
    sent, real = [], topk._sent

    def counted(data, asked):
        out = real(data, asked)
        sent.append((out.count(), data.count(), asked.select("chunk", "part").distinct().count()))
        return out

    monkeypatch.setattr(topk, "_sent", counted)
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in topk.top_k(df, df.filter("id % 5 = 0")).collect()}
    scores = points @ points.T
    for q in range(0, n, 5):
        order = sorted((-int(scores[q, c]), c) for c in range(n) if c != q)[: topk.K]
        assert [got[q, k + 1] for k in range(topk.K)] == [(c, -s) for s, c in order]
    groups = -(-n // 5 // topk.QUERIES)
    for rows, whole, met in sent:
        assert rows <= met * 3 * topk.TREE and rows < whole * groups / 2


def test_bytes_shared_by_chance_are_not_dealt_out():
    """Texts that share 20 bytes, far fewer than a window has, have no anchor in common."""
    rnd = random.Random(8)
    texts = [b"".join([rnd.randbytes(90), b"the licence of these", rnd.randbytes(90)]) for _ in range(60)]
    block = repeats.Block(np.arange(60), np.zeros(60, bool), np.cumsum([0, *map(len, texts)]), b"".join(texts))
    kind = suffix_dedup.KIND
    assert not repeats._anchors(block, repeats.pieces(block, kind, 64), kind)[2].any()


def test_an_index_is_full_at_its_kinds_size():
    """Short pieces of many anchors go through indexes that fit the cache."""
    seen = []
    kind = suffix_dedup.KIND._replace(index=lambda pieces: seen.append(sum(map(len, pieces))) or suffix_dedup.KIND.index(pieces))
    texts = [np.random.default_rng(k).bytes(80) for k in range(4000)]
    repeats._find(kind, texts, np.arange(4000), np.zeros(4000, np.int64), np.ones(4000, np.int64))
    assert sum(seen) == 320_000 and max(seen) <= 1 << 17
