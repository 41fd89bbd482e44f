"""Quality classifier: histogram gradient-boosted trees over document statistics."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm._io import small_batches, table, trimmed

#: Bound of the sample of labelled rows that training gathers on the driver.
MAX_TRAIN_ROWS = 20_000
THRESHOLD = 0.3

FEATURES = (
    "log_bytes", "log_words", "log_lines", "word_bytes", "longest_word", "line_bytes", "upper", "lower", "digit", "space",
    "sentence_marks", "exclamation", "symbol", "bar", "other_marks", "non_ascii", "distinct_words", "distinct_pairs",
    "echoed_words", "top_word", "repeated_lines", "capitalised", "plain_words", "closed_lines", "byte_entropy", "late_repeats",
)


def _byte_classes() -> np.ndarray:
    names = "upper lower digit space sentence exclamation symbol bar other high".split()
    rows = np.zeros((len(names), 256))
    for b in range(256):
        c = chr(b)
        kind = (
            "high" if b > 127 else "upper" if c.isupper() else "lower" if c.islower() else "digit" if c.isdigit()
            else "space" if c.isspace() else "sentence" if c in ".,;:?'\"()-" else "exclamation" if c == "!"
            else "bar" if c == "|" else "symbol" if c in "#*$%&<>@^~_=+\\/{}[]`" else "other"
        )
        rows[names.index(kind), b] = 1
    return rows


_CLASSES = _byte_classes()


def statistics(text: str | None) -> list[float]:
    """FEATURES of one whole text; a null text counts as empty, and all shares of nothing are 0."""
    raw = (text or "").encode("utf-8", "replace")
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    n = max(len(raw), 1)
    upper, lower, digit, space, sentence, exclamation, symbol, bar, other, high = (_CLASSES @ counts) / n
    share = counts[counts > 0] / n
    words, lines = raw.split(), [x for x in raw.split(b"\n") if x.strip()]
    n_words, n_lines = max(len(words), 1), max(len(lines), 1)
    pairs = list(zip(words, words[1:], strict=False))
    distinct, top = set(words), Counter(words).most_common(1)
    half = set(words[: len(words) // 2])
    return [
        np.log1p(len(raw)), np.log1p(len(words)), np.log1p(len(lines)),
        sum(map(len, words)) / n_words, np.log1p(max(map(len, words), default=0)), np.log1p(len(raw) / n_lines),
        upper, lower, digit, space, sentence, exclamation, symbol, bar, other, high,
        len(distinct) / n_words, len(set(pairs)) / max(len(pairs), 1), sum(a == b for a, b in pairs) / n_words,
        (top[0][1] if top else 0) / n_words, 1 - len(set(lines)) / n_lines if lines else 0.0,
        sum(w[:1].isupper() for w in words) / n_words, sum(w.isalpha() for w in words) / n_words,
        sum(x.rstrip()[-1:] in b".!?" for x in lines) / n_lines, float(-(share * np.log2(share)).sum()),
        len(half & set(words[len(words) // 2 :])) / n_words,
    ]


class Forest(NamedTuple):
    """Complete trees of one depth, level by level in arrays: node k has the children 2k + 1 and 2k + 2."""

    feature: np.ndarray  # trees x inner nodes
    cut: np.ndarray  # go right above it
    value: np.ndarray  # trees x leaves
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """All rows walk down all trees at once, one level a step."""
        trees, depth = np.arange(len(self.feature)), int(np.log2(self.value.shape[1]) + 0.5) if len(self.value) else 0
        node = np.zeros((len(x), len(self.feature)), np.int64)
        for _ in range(depth):
            node = 2 * node + 1 + (np.take_along_axis(x, self.feature[trees, node], 1) > self.cut[trees, node])
        raw = np.full(len(x), self.prior)
        if len(self.value):
            raw += self.value[trees, node - self.feature.shape[1]].sum(1)
        return 1 / (1 + np.exp(-np.clip(raw, -35, 35)))


def train(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.2, bins: int = 64, l2: float = 1.0, least: float = 4.0) -> Forest:
    """Newton boosting of the logistic loss on quantile bins; least is the least hessian of a leaf.

    Without rows of both labels every score is 0.5.
    """
    inner, leaves = 2**depth - 1, 2**depth
    if not len(y) or y.min() == y.max():
        return Forest(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)), 0.0)
    n, f = x.shape
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(f)]
    binned = np.stack([np.searchsorted(cuts[j], x[:, j], side="left") for j in range(f)], 1)
    base = float(np.log(y.mean() / (1 - y.mean())))
    raw, feature, cut, value = np.full(n, base), [], [], []
    columns = np.arange(f)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-raw))
        g, h = p - y, p * (1 - p)
        node = np.zeros(n, np.int64)
        feats, ats = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(depth):
            width, first = 2**level, 2**level - 1
            key = ((node - first)[:, None] * f + columns) * bins + binned
            hist = [np.bincount(key.ravel(), np.repeat(v, f), width * f * bins).reshape(width, f, bins).cumsum(2) for v in (g, h)]
            gl, hl = hist
            gt, ht = gl[:, :, -1:], hl[:, :, -1:]
            gain = gl**2 / (hl + l2) + (gt - gl) ** 2 / (ht - hl + l2) - gt**2 / (ht + l2)
            gain[(hl < least) | (ht - hl < least)] = 0
            best = gain.reshape(width, -1).argmax(1)
            for k in range(width):
                j, b = divmod(int(best[k]), bins)
                if gain[k, j, b] > 1e-6 and b < len(cuts[j]):
                    feats[first + k], ats[first + k] = j, cuts[j][b]
            node = 2 * node + 1 + (x[np.arange(n), feats[node]] > ats[node])
        leaf = node - inner
        value.append(-rate * np.bincount(leaf, g, leaves) / (np.bincount(leaf, h, leaves) + l2))
        raw += value[-1][leaf]
        feature.append(feats)
        cut.append(ats)
    return Forest(np.array(feature), np.array(cut), np.array(value), base)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, max_train_rows: int = MAX_TRAIN_ROWS) -> Forest:
    """A forest from at most max_train_rows labelled rows that are not held out, in the order of a hash.

    Rows whose label or id is null teach nothing; repeated labels count each time.
    """
    sample = (
        labels.select(F.col("doc_id").alias("label_id"), F.col("quality").cast("double").alias("quality"))
        .filter(F.col("label_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("label_id")))
        .orderBy(F.xxhash64("label_id"), "label_id", "quality").limit(max_train_rows)
    )
    stats = F.pandas_udf(lambda s: pd.Series([statistics(t) for t in s]), "array<double>")
    # Broadcast: max_train_rows rows of 16 bytes at most.
    rows = small_batches(docs.select("doc_id", "text")).join(F.broadcast(sample), F.col("doc_id") == F.col("label_id"))
    # Ids may repeat, so the bound holds for what is gathered too.
    got = rows.select("doc_id", "quality", stats("text").alias("x")).orderBy(F.xxhash64("doc_id"), "doc_id", "quality", "x").limit(max_train_rows).toPandas()
    x = np.array(got["x"].tolist(), float).reshape(-1, len(FEATURES))
    return train(x, got["quality"].to_numpy(float))


def scorer(forest: Forest):
    """A Column function from text to score; frames that it is put on should go through small_batches() first."""

    @trimmed
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in parts:
            out = np.empty(len(s))
            for k in range(0, len(s), 512):
                part = s.iloc[k : k + 512]
                out[k : k + len(part)] = forest.score(np.array([statistics(t) for t in part]).reshape(-1, len(FEATURES)))
            yield pd.Series(out)

    return F.pandas_udf(score, "double")


def op4_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores depend on the text alone: null and empty texts share one, repeated rows get the same."""
    docs = small_batches(table(spark, sf_dir, "documents").select("doc_id", "text"))
    forest = fit(docs, table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), scorer(forest)("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
