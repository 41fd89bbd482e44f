"""Results that are whole: nothing that a stage or operator promises is left undone."""

import random

import numpy as np
import pandas as pd
import pytest

import corpus_pipeline
from quire.llm import repeats, shingle_sets, simhash, substring_dedup, suffix_dedup


def shingle_set(text):
    w = text.lower().split()
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))}


def edited(rnd, words, times):
    """words with some of them replaced; each spoils five shingles at most."""
    out = list(words)
    for k in rnd.sample(range(len(out)), times):
        out[k] = f"new{rnd.randint(0, 10**6)}"
    return out


def test_every_pair_alike_is_linked(spark):
    rnd = random.Random(11)
    fresh = lambda n: [f"w{rnd.randint(0, 3000)}" for _ in range(n)]
    texts = []
    for _ in range(30):  # pairs on both sides of the threshold
        words = fresh(rnd.randint(60, 300))
        texts += [" ".join(words), " ".join(edited(rnd, words, len(words) * rnd.randint(0, 5) // 100))]
    centre, passage = fresh(200), fresh(20)
    texts += [" ".join(edited(rnd, centre, rnd.randint(1, 8))) for _ in range(60)]  # a large group, of which the outer ones are linked over others
    texts += [" ".join(passage + fresh(rnd.randint(5, 40))) for _ in range(60)]  # one passage in many texts that are not alike
    texts += ["One two", "one  TWO", "one", "", " \n"]
    sets = [shingle_set(t) if t.strip() else set() for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    far = 0
    for a in range(len(texts)):
        for b in range(a):
            if (5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])) if sets[a] and sets[b] else sets[a] == sets[b]:
                far += (simhash.fingerprint(texts[a]) ^ simhash.fingerprint(texts[b])).bit_count() > 7
                root[find(a)] = find(b)
    assert far
    least = {}
    for k in range(len(texts)):
        least.setdefault(find(k), k)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = simhash.near_duplicates(docs, words=corpus_pipeline.WORDS, alike=corpus_pipeline.ALIKE).collect()
    assert {r.doc_id: r.component_id for r in rows} == {k: least[find(k)] for k in range(len(texts))}


def test_parity_maps_never_exceed_the_difference():
    rnd = np.random.default_rng(12)
    pool = rnd.integers(1, 2**63, 3000, np.uint64)
    for _ in range(200):
        a, b = (np.unique(rnd.choice(pool[: rnd.integers(1, 3000)], rnd.integers(0, 2000))) for _ in range(2))
        assert shingle_sets.differing(shingle_sets.parity(a), shingle_sets.parity(b)) <= len(np.setxor1d(a, b))


def test_bodies_of_private_keys_are_masked(spark):
    begin, end = "-----BEGIN RSA PRIVATE KEY-----", "-----END RSA PRIVATE KEY-----"
    body = "\n".join(["MIIEowIBAAKCAQEA" + "aB3/" * 12] * 20 + ["Qx9+short=="])
    texts = [
        f"before {begin}\n{body}\n{end} after", f"before {begin}\n{body}\n after all", f"before {begin}\r\nProc-Type: 4,ENCRYPTED\r\nDEK-Info: AES-128-CBC,00FF\r\n\r\n{body}\r\n{end}\nafter",
        f"before {begin}" + "\\n" + body.replace("\n", "\\n") + f"\\n{end} after", f"before {begin} after", f"before {begin}\n{body}\n\nplain words between them\n{begin}\n{body}\n{end} after",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.text for r in corpus_pipeline.mask_secrets(spark, docs, "").collect()}
    for k, t in got.items():
        assert t.startswith("before [SECRET]") and "after" in t, (k, t)
        assert not any(s in t for s in ("MIIE", "aB3", "Qx9", "END")), (k, t)
    assert "plain words between them" in got[5] and got[5].count("[SECRET]") == 2


def test_one_row_of_each_group_under_repeated_ids(spark):
    rnd = random.Random(13)
    a, b, c = (" ".join(f"w{rnd.randint(0, 3000)}" for _ in range(80)) for _ in range(3))
    # Id 5 names the groups of a and b; c's smallest id is 2, so its row with id 5 goes.
    rows = [(5, a), (5, a), (5, b), (6, b), (7, a), (2, c), (5, c), (None, "no id here"), (None, "no id here"), (None, a)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.text) for r in corpus_pipeline.deduplicate(spark, docs, "").collect())
    assert got == sorted([(5, a), (5, b), (2, c), (0, "no id here")])


def test_columns_of_any_name_pass_through(spark):
    """Names that stages and operators use for themselves, held by the documents too."""
    taken = (
        "keep_id keep_node node times root component_id least_id doc spans secret_spans found_blob blob secret_blob masked copy_no row_no first_no mix_id mix_digest "
        "mix_source alike id no size part target copies taken words fp prefix parity x score label_id quality held_out u v m key a b name line col"
    ).split()
    rnd = random.Random(16)
    words = lambda: " ".join(f"w{rnd.randint(0, 3000)}" for _ in range(60))
    a = words()
    rows = [(1, a, "s", 0), (2, a + " tail", "s", 0), (3, "token=abcdefgh12 " + words(), None, 0), (4, words(), "s", 0), (5, None, "t", 0)]
    docs = spark.createDataFrame([(*r, *[f"{k}-{c}" for c in taken]) for k, r in enumerate(rows)], f"doc_id long, text string, source string, n_chars long, {', '.join(f'`{c}` string' for c in taken)}")
    for name, stage in corpus_pipeline.STAGES[1:-1]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns, name
        for r in out.collect():
            assert all(r[c] == f"{r.doc_id - 1}-{c}" for c in taken), name
    assert sorted(r.doc_id for r in corpus_pipeline.deduplicate(spark, docs, "").collect()) == [1, 3, 4, 5]


def repeated_texts(rnd):
    glue = lambda n: " ".join(f"{rnd.choice('abcde')}{rnd.randint(0, 50)}" for _ in range(n))
    shared = [glue(50) for _ in range(3)]
    return [f"{glue(rnd.randint(0, 60))} {rnd.choice(shared)} {glue(rnd.randint(0, 60))}" for _ in range(30)] + [shared[0], shared[0], None, "", glue(400) * 2]


@pytest.mark.parametrize("hot", [0, 2, 1 << 10])
@pytest.mark.parametrize("kind", [suffix_dedup.KIND, substring_dedup.KIND])
def test_anchors_of_many_blocks_are_cut_again(monkeypatch, kind, hot):
    """The whole way from blocks to removed symbols, in this process."""
    monkeypatch.setattr(repeats, "HOT_BLOCKS", hot)
    texts = repeated_texts(random.Random(17))
    blocks, ranges = [], 5
    for k in range(0, len(texts), 3):
        own = [kind.clean((t or "").encode()) for t in texts[k : k + 3]]
        ids = np.arange(k, k + len(own))
        blocks.append((k, repeats.Block(ids, np.zeros(len(own), bool), np.cumsum([0, *map(len, own)]), b"".join(own)).packed()))
    blocks = pd.DataFrame(blocks, columns=["block", "payload"])
    grouped = lambda frames, key: pd.concat(list(frames)).groupby(key)
    levels = pd.concat([x for r, g in grouped(repeats._send_anchors(kind, ranges)(iter([blocks])), "range") for x in repeats._shared((r,), iter([g]))])
    if not hot:
        assert any(np.frombuffer(repeats.zstandard.decompress(x), np.uint8).max() == 2 for x in levels["levels"])
    sent = pd.concat([repeats._send_pieces(kind, ranges)((b,), own, levels[levels["block"] == b]) for b, own in blocks.groupby("block")])
    runs = pd.concat([x for r, g in sent.groupby("range") for x in repeats._match(kind)((r,), iter([g]))])
    gone = {}

    def report(b, removed, starts, ends, firsts):
        for k, x, y in zip(b.ids.tolist(), firsts, np.r_[firsts[1:], len(starts)], strict=True):
            gone[k] = removed[x:y].tolist()
        return pd.DataFrame()

    for b, own in blocks.groupby("block"):
        repeats._finish(kind, ranges, report)((b,), own, runs[runs["block"] == b])
    symbols = [list((t or "").encode()) if kind is suffix_dedup.KIND else (t or "").split() for t in texts]
    n, first, times = kind.window, {}, {}
    for k, x in enumerate(symbols):
        for a in range(len(x) - n + 1):
            w = tuple(x[a : a + n])
            first.setdefault(w, k)
            times[w] = times.get(w, 0) + 1
    for k, x in enumerate(symbols):
        want = [False] * len(x)
        for a in range(len(x) - n + 1):
            w = tuple(x[a : a + n])
            if times[w] > 1 if kind.same_document else first[w] < k:
                want[a : a + n] = [True] * n
        assert gone[k] == want, k
    assert any(any(v) for v in gone.values())


@pytest.mark.parametrize("operator", [suffix_dedup.suffix_dedup, substring_dedup.substring_dedup])
def test_frames_of_any_origin(spark, tmp_path, operator):
    rows = list(enumerate(repeated_texts(random.Random(18))))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    frame.write.parquet(f"{tmp_path}/d")
    file = spark.read.parquet(f"{tmp_path}/d")
    joined = file.select("doc_id").join(file, "doc_id")
    rdd = spark.sparkContext.parallelize(rows, 3).toDF("doc_id long, text string")
    want = sorted(map(repr, operator(file).collect()))
    assert len(want) == len(rows) and any("n_removed=0" not in r for r in want)
    for other in (frame, joined, rdd):
        assert sorted(map(repr, operator(other).collect())) == want
