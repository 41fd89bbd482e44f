"""Exact top-k search by inner product: cover trees of queries and of data, walked together."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quire.llm._io import save, small_batches, table

K = 5
#: Vectors of one data tree, queries that meet it in one task, and points of a leaf of data and of queries: a wide leaf of queries has a low floor.
TREE, QUERIES, LEAF, QUERY_LEAF = 4_096, 4_096, 24, 1
#: Most pivots, by which vectors that are near each other come into one tree; their table goes to every task.
PIVOTS = 256
BASE = 1.4
NONE = np.iinfo(np.int64).min
_FOUND = "no long, query_id long, vec_id long, score long"


class Tree(NamedTuple):
    """A cover tree whose leaves hold some points each.

    Nodes are centres in the order of farthest-first insertion; level l has the first sizes[l] of
    them, so levels are nested. radius[l][j] is the distance from node j to its farthest point, and
    parent[l][j] the node above it. Points begin[j] to begin[j + 1] of order are those of leaf j.
    """

    order: np.ndarray
    begin: np.ndarray
    centres: np.ndarray
    norms: np.ndarray
    sizes: list[int]
    parent: list[np.ndarray]
    radius: list[np.ndarray]
    leaf_of: list[np.ndarray]


def build(points: np.ndarray, leaf: int = LEAF) -> Tree:
    """leaf: about how many points a leaf holds; equal points are one leaf, however many they are."""
    n = len(points)
    square = (points * points).sum(1)
    near, which = np.full(n, np.inf), np.zeros(n, np.int64)
    chosen, gap, at = [], [], 0
    for i in range(max(1, -(-n // leaf))):
        if i and near[at] <= 0:
            break
        chosen.append(at)
        gap.append(near[at])
        away = np.maximum(square + square[at] - 2 * (points @ points[at]), 0)
        away[at] = 0
        closer = away < near
        near[closer], which[closer] = away[closer], i
        at = int(near.argmax())
    centres, gap = points[chosen], np.sqrt(np.array(gap))
    m, scale, sizes = len(chosen), (float(gap[1]) if len(chosen) > 1 else 0.0), [1]
    while sizes[-1] < m:
        scale /= BASE
        grown = int((gap > scale).sum())  # gaps fall along the order
        if scale < 1 or grown >= m:
            grown = m
        if grown > sizes[-1]:
            sizes.append(grown)
    parent, radius, leaf_of = [np.zeros(1, np.int64)], [], []
    for a, b in zip(sizes, sizes[1:], strict=False):
        up = np.arange(b)
        up[a:] = (2 * centres[a:b] @ centres[:a].T - square[chosen[:a]]).argmax(1)
        parent.append(up)
    above = which
    for level in range(len(sizes) - 1, -1, -1):
        r = np.zeros(sizes[level])
        np.maximum.at(r, above, np.sqrt(((points - centres[above]) ** 2).sum(1)))
        radius.insert(0, r)
        leaf_of.insert(0, above)
        above = parent[level][above]
    order = np.argsort(which, kind="stable")
    return Tree(order, np.searchsorted(which[order], np.arange(m + 1)), centres, np.sqrt((centres * centres).sum(1)), sizes, parent, radius, leaf_of)


def _children(parent: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position in nodes, child) of all children."""
    order = np.argsort(parent, kind="stable")
    begin = np.searchsorted(parent[order], nodes)
    count = np.searchsorted(parent[order], nodes, side="right") - begin
    at = np.repeat(begin - np.cumsum(count) + count, count) + np.arange(count.sum())
    return np.repeat(np.arange(len(nodes)), count), order[at]


def survivors(q: Tree, r: Tree, worst: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(q's leaf, r's leaf, bound) of the pairs whose scores may reach a query's worst k-th score.

    A node pair's scores are at most <q, r> + Rq |r| + Rr |q| + Rq Rr, R being covering radii. It
    goes if that is less than the lowest worst score among the queries below q's node. Both trees
    go down a level at each step, and only pairs that are left have children.
    """
    a = b = np.zeros(1, np.int64)
    bound = np.zeros(1)
    for step in range(max(len(q.sizes), len(r.sizes))):
        lq, lr = min(step, len(q.sizes) - 1), min(step, len(r.sizes) - 1)
        if 0 < step < len(q.sizes):
            of, a = _children(q.parent[lq], a)
            b = b[of]
        if 0 < step < len(r.sizes):
            of, b = _children(r.parent[lr], b)
            a = a[of]
        floor = np.full(q.sizes[lq], np.inf)
        np.minimum.at(floor, q.leaf_of[lq], worst)
        bound = np.empty(len(a))
        for k in range(0, len(a), 1 << 14):
            x, y = a[k : k + (1 << 14)], b[k : k + (1 << 14)]
            rq, rr = q.radius[lq][x], r.radius[lr][y]
            bound[k : k + len(x)] = np.einsum("ij,ij->i", q.centres[x], r.centres[y]) + rq * r.norms[y] + rr * q.norms[x] + rq * rr
        # Scores are whole numbers; one unit and a share of the bound's size cover rounding.
        bound += 1 + 1e-9 * np.abs(bound)
        keep = bound >= floor[a]
        a, b, bound = a[keep], b[keep], bound[keep]
    return a, b, bound


def _scores(a: np.ndarray, b: np.ndarray, most: float) -> np.ndarray:
    """Whole inner products, through floats where those hold them exactly; what 64 bits cannot hold stays at their limits."""
    if most < 2**53:
        return (a.astype(float) @ b.T.astype(float)).astype(np.int64)
    return np.clip(a.astype(object) @ b.T.astype(object), NONE + 1, np.iinfo(np.int64).max).astype(np.int64)


def _best(q: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best rows of each q, ties to smaller ids."""
    order = np.lexsort((ids, -score, q))
    q, ids, score = q[order], ids[order], score[order]
    first = np.flatnonzero(np.r_[True, q[1:] != q[:-1]]) if len(q) else np.zeros(0, np.int64)
    rank = np.arange(len(q)) - np.repeat(first, np.diff(np.r_[first, len(q)]))
    return q[rank < k], ids[rank < k], score[rank < k]


def search(queries: np.ndarray, own: np.ndarray, points: np.ndarray, ids: np.ndarray, k: int, worst: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(query, id, score) of each query's k best points of another id that reach its worst score so far, and how many pairs were scored.

    Each leaf of queries takes the leaves of data that survive, best bound first and ever more at a
    time, until no bound reaches the lowest of its queries' worst k-th scores, which rise meanwhile.
    """
    qt, rt = build(queries.astype(float), QUERY_LEAF), build(points.astype(float))
    most = float(np.abs(queries.astype(float)).max(initial=0)) * float(np.abs(points.astype(float)).max(initial=0)) * max(queries.shape[1], 1)
    a, b, bound = survivors(qt, rt, worst)
    order = np.lexsort((-bound, a))
    a, b, bound = a[order], b[order], bound[order]
    cuts = np.searchsorted(a, np.arange(qt.sizes[-1] + 1))
    found, scored = [(np.zeros(0, np.int64),) * 3], 0
    for leaf in range(qt.sizes[-1]):
        rows = qt.order[qt.begin[leaf] : qt.begin[leaf + 1]]
        floor, best, at, take = worst[rows].copy(), (np.zeros(0, np.int64),) * 3, cuts[leaf], 4
        while at < cuts[leaf + 1] and bound[at] >= floor.min():
            leaves = b[at : min(at + take, cuts[leaf + 1])]
            leaves = leaves[bound[at : at + len(leaves)] >= floor.min()]
            at, take = at + take, 2 * take
            some = np.concatenate([rt.order[rt.begin[x] : rt.begin[x + 1]] for x in leaves])
            score = _scores(queries[rows], points[some], most)
            scored += score.size
            score[own[rows][:, None] == ids[some]] = NONE
            kth = np.partition(score, -k, axis=1)[:, -k] if score.shape[1] >= k else np.full(len(rows), NONE + 1)
            x, y = np.nonzero(score >= np.maximum(np.maximum(kth, floor), NONE + 1)[:, None])
            best = _best(*(np.concatenate(v) for v in zip(best, (x, ids[some][y], score[x, y]), strict=True)), k)
            full = np.flatnonzero(np.bincount(best[0], minlength=len(rows)) == k)
            floor[full] = np.maximum(floor[full], best[2][np.searchsorted(best[0], full, side="right") - 1])
        found.append((rows[best[0]], best[1], best[2]))
    return *(np.concatenate(v) for v in zip(*found, strict=True)), scored


def _matrix(rows: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(rows), width), np.int64)
    for k, v in enumerate(rows):
        out[k, : len(v)] = v
    return out


def _search(k: int):
    def run(_: tuple, data: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(data) or not len(queries):
            return pd.DataFrame({c: pd.Series(dtype="int64") for c in ("no", "query_id", "vec_id", "score")})
        width = max(int(data["v"].map(len).max()), int(queries["v"].map(len).max()))
        own = queries["id"].to_numpy()
        q, ids, score, _ = search(_matrix(queries["v"], width), own, _matrix(data["v"], width), data["id"].to_numpy(), k, queries["worst"].to_numpy())
        return pd.DataFrame({"no": queries["no"].to_numpy()[q], "query_id": own[q], "vec_id": ids, "score": score})

    return run


class Pivots(NamedTuple):
    """Vectors with their norms and, once data are assigned, the radius and the first and last tree of each; PIVOTS rows at most."""

    points: np.ndarray
    radius: np.ndarray
    first: np.ndarray
    end: np.ndarray

    def nearest(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        square = (v * v).sum(1)[:, None] + (self.points * self.points).sum(1) - 2 * v @ self.points.T
        which = square.argmin(1)
        return which, np.sqrt(((v - self.points[which]) ** 2).sum(1))


def _wide(rows: pd.Series, width: int) -> np.ndarray:
    return _matrix(rows, width).astype(float)


def _assigned(df: DataFrame, pivots: Pivots, width: int) -> DataFrame:
    """df with its vectors' nearest pivot and the distance."""

    def run(batches):
        for pdf in batches:
            which, away = pivots.nearest(_wide(pdf["v"], width))
            yield pdf.assign(pivot=which, away=away)

    return small_batches(df).mapInPandas(run, ", ".join(f"`{c}` {t}" for c, t in df.dtypes) + ", pivot long, away double")


def _wanted(pivots: Pivots, width: int):
    """A row for each query and each tree, but its first one, of a pivot whose bound reaches the query's worst k-th score."""

    def run(batches):
        for pdf in batches:
            for k in range(0, len(pdf), 256):
                part = pdf.iloc[k : k + 256]
                v = _wide(part["v"], width)
                bound = v @ pivots.points.T + np.sqrt((v * v).sum(1))[:, None] * pivots.radius
                bound += 1 + 1e-9 * np.abs(bound)
                q, p = np.nonzero((bound >= part["worst"].to_numpy()[:, None]) & (pivots.end > pivots.first))
                count = pivots.end[p] - pivots.first[p]
                chunk = np.repeat(pivots.first[p] - np.cumsum(count) + count, count) + np.arange(count.sum())
                q = np.repeat(q, count)
                other = chunk != part["chunk"].to_numpy()[q]
                yield part.iloc[q[other]].assign(chunk=chunk[other])[["no", "id", "v", "worst", "chunk"]]

    return run


def _parted(asked: DataFrame) -> DataFrame:
    """asked (chunk, no, ...) with a part of its own chunk: as many parts as its queries fill, however many ask elsewhere."""
    counts = asked.groupBy(F.col("chunk").alias("n_chunk")).agg(F.ceil(F.count(F.lit(1)) / QUERIES).alias("n_parts"))
    joined = asked.join(counts, F.col("chunk") == F.col("n_chunk"))
    return joined.withColumn("part", F.pmod(F.xxhash64("no", F.lit(1)), F.col("n_parts")).cast("int")).drop("n_chunk", "n_parts")


def _sent(data: DataFrame, asked: DataFrame) -> DataFrame:
    """data (chunk, ...) once for each part of its chunk that holds a query; trees that nobody asks for stay where they are."""
    return data.join(asked.select("chunk", "part").distinct(), "chunk")


def whole_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, v): floor(256 x) of every component; vectors null or with null or non-finite components, and rows without id, go."""
    v, finite = F.col(vector_col), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = df.filter(F.col(id_col).isNotNull() & v.isNotNull() & F.forall(v, lambda x: F.coalesce(finite(x), F.lit(False))))
    return rows.select(F.col(id_col).alias("id"), F.transform(v, lambda x: F.floor(x.cast("double") * 256)).alias("v"))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score) of each query's k best rows of another id; both inputs have id and v.

    Vectors near one pivot make trees of about TREE rows, however many they are. Each query first meets one
    tree of its own pivot, which gives a k-th score to start with; then the trees of every pivot
    whose bound reaches that. A task holds a tree and up to QUERIES queries or so and returns k rows a query,
    which one window by query merges; a tree goes to as many tasks as its own queries fill, so what is
    sent grows with the pairs of trees and groups of queries that no bound rules out. Shorter vectors count as filled up with zeros. Repeated
    queries are answered one by one, repeated rows are candidates of their own.
    """
    spark = vectors.sparkSession
    vectors, queries = (save(x.select("id", "v", F.monotonically_increasing_id().alias("no")), "vectors") for x in (vectors, queries))
    rows = vectors.count()
    width = max([1, *(x.agg(F.max(F.size("v"))).first()[0] or 0 for x in (vectors, queries))])
    picked = vectors.orderBy(F.xxhash64("v", "no"), "no").limit(max(1, min(PIVOTS, rows // TREE))).select("v").collect()
    points = np.unique(_wide(pd.Series([r.v for r in picked], dtype=object), width), axis=0) if picked else np.zeros((1, width))
    pivots = Pivots(points, *[np.zeros(0)] * 3)
    data = save(_assigned(vectors, pivots, width), "assigned")
    here = {r.pivot: (r.n, r.away) for r in data.groupBy("pivot").agg(F.count(F.lit(1)).alias("n"), F.max("away").alias("away")).collect()}
    trees = np.array([-(-here.get(p, (0, 0))[0] // TREE) for p in range(len(points))], np.int64)
    pivots = Pivots(points, np.array([here.get(p, (0, 0.0))[1] for p in range(len(points))]), np.cumsum(trees) - trees, np.cumsum(trees))
    rows_of = [(p, int(pivots.first[p]), int(trees[p])) for p in range(len(points))]
    of = F.broadcast(spark.createDataFrame(rows_of, "p_pivot long, p_first long, p_trees long"))  # a row for each pivot

    def dealt(df: DataFrame) -> DataFrame:
        chunk = F.col("p_first") + F.pmod(F.xxhash64("no"), F.greatest("p_trees", F.lit(1)))
        return df.join(of, F.col("pivot") == F.col("p_pivot")).withColumn("chunk", chunk).drop("p_pivot", "p_first", "p_trees", "pivot", "away")

    def met(data: DataFrame, asked: DataFrame) -> DataFrame:
        asked = _parted(asked)
        columns = ("id", "v", F.col("chunk").alias("of_chunk"), F.col("part").alias("of_part"))  # names of its own: both sides come from one table
        return _sent(data, asked).select(*columns).groupBy("of_chunk", "of_part").cogroup(asked.groupBy("chunk", "part")).applyInPandas(_search(k), _FOUND)

    data = dealt(data).select("id", "v", "chunk")
    asked = save(dealt(_assigned(queries, pivots, width)).withColumn("worst", F.lit(NONE)), "asked")
    first = save(met(data, asked), "found")
    best = W.partitionBy("no", "query_id").orderBy(F.col("score").desc(), "vec_id")
    kth = save(first.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") == k).select(F.col("no").alias("k_no"), F.col("score").alias("kth")), "kth")
    known = asked.join(kth, F.col("no") == F.col("k_no"), "left").withColumn("worst", F.coalesce("kth", F.lit(NONE))).drop("k_no", "kth")
    wanted = save(small_batches(known).mapInPandas(_wanted(pivots, width), "no long, id long, v array<long>, worst long, chunk long"), "wanted")
    found = first.union(met(data, wanted))
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op7_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each query's 5 best rows, ranked from 1; ties go to the smaller vec_id.

    Null vectors, those with null or non-finite components, and rows without id take no part; empty
    vectors score 0; repeated rows count each, but no row of the query's own id. An empty table
    gives no rows. Columns other than vec_id and embedding are not read.
    """
    vectors = whole_vectors(table(spark, sf_dir, "embeddings"))
    return top_k(vectors, vectors.filter("id % 50 = 0"))


def oracle() -> str:
    return f"""
WITH v AS (SELECT row_number() OVER () AS no, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.no, q.vec_id AS query_id, c.vec_id, coalesce(list_sum(list_transform(range(1, least(len(q.e), len(c.e)) + 1), lambda i: q.e[i] * c.e[i])), 0)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY no ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {K}
"""
