"""Nearest neighbours by vantage-point trees, one per shard, with relaxed triangle-inequality pruning.

Equal vectors are one point: it keeps its k + 1 smallest ids, the only ones that can be among any query's k nearest.  Points
are dealt to the nearest of at most ``PIVOTS`` pivots (a hash sample of the points; the origin for lengths that no pivot has),
then cut by range of (length, pivot, distance to the pivot) into shards of about ``SHARD_ROWS``: a crowded pivot gives many shells,
thin ones share a shard.  Each shard's tree halves the points at the median distance to a vantage point, down to leaves
of ``LEAF`` points.  A subtree on the far side of the vantage sphere is skipped when

    |distance to the vantage point - radius| * factor > distance of the k-th best found

With ``factor`` 1 that is the triangle inequality and the result is exact; larger factors skip more.  Queries are searched twice: first
in the shard whose shell of their own pivot is nearest, then, with the k-th distance found there as bound, in every other shard
that the same inequality admits, of the two bounds |distance to the pivot - shell| and half of (distance to the pivot - distance to
the query's own pivot), since a point is no nearer to another pivot than to its own.  ``QUERY_BLOCK`` queries walk a tree together.

Every (shard, query block) pair is one task group of about SHARD_ROWS points and QUERY_BLOCK queries,
whatever the table holds; copies of one vector beyond k + 1 are left out before a group is formed.
How many shards a query visits depends on the data: few where vectors cluster, all of them where all distances are alike.
A query's k best of all shards are picked by a window whose input each task has cut to k rows first.

Edge cases: null, empty and zero vectors and vectors with null or non-finite components take no part; vectors meet
only vectors of their own length; rows with the query's own vec_id (repeated rows) and null ids are not candidates; a query with fewer
than k candidates gets them all; ties go to the smaller vec_id; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.sequence import range_parts

K = 10
FACTOR = 2.0
SHARD_ROWS = 4096
QUERY_BLOCK = 2048
LEAF = 64
PIVOTS = 64
STEP = 1 << 21  # distances worked on at once
ROUNDING = 1e-12  # so that rounded distances do not skip a point as near as the k-th


def valid(vectors: DataFrame) -> DataFrame:
    """vec_id, vector (doubles) of the rows that take part."""
    v = F.col("embedding")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return (vectors.filter(F.col("vec_id").isNotNull() & v.isNotNull()).filter(finite & F.exists(v, lambda x: x != 0))
            .select("vec_id", v.cast("array<double>").alias("vector")))


def points(rows: DataFrame, k: int) -> DataFrame:
    """Distinct vectors with their k + 1 smallest ids."""
    place = F.row_number().over(W.partitionBy("vector").orderBy("vec_id"))
    return (rows.distinct().withColumn("place", place).filter(F.col("place") <= k + 1)
            .groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")))


class Tree:
    """Vantage-point tree over the rows of a matrix."""

    def __init__(self, data: np.ndarray, leaf: int = LEAF):
        self.data, self.leaf = data, leaf
        self.nodes: list[tuple] = []  # (vantage row, radius, inner node, outer node) or (rows,)
        self.root = self._build(np.arange(len(data)))

    def _build(self, rows: np.ndarray) -> int:
        if len(rows) <= self.leaf:
            self.nodes.append((rows,))
            return len(self.nodes) - 1
        middle = self.data[rows].mean(axis=0)
        vantage = rows[np.argmax(((self.data[rows] - middle) ** 2).sum(axis=1))]  # an outlying point separates well
        rest = rows[rows != vantage]
        d = distances(self.data[vantage][None], self.data[rest])[0]
        radius = float(np.median(d))
        near = d <= radius
        if near.all():
            near = np.arange(len(rest)) < len(rest) // 2
            radius = float(d.max())
        node = len(self.nodes)
        self.nodes.append(())
        inner, outer = self._build(rest[near]), self._build(rest[~near])
        gap = float(d[~near].min())
        self.nodes[node] = (vantage, radius, gap, inner, outer)
        return node


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of all rows of a to all rows of b, from differences."""
    out = np.empty((len(a), len(b)))
    step = max(1, STEP // max(1, b.size))
    for i in range(0, len(a), step):
        d = a[i:i + step, None, :] - b[None, :, :]
        out[i:i + step] = np.sqrt(np.einsum("ijk,ijk->ij", d, d))
    return out


class Search:
    """The k + 1 nearest points of each query in one tree, of equally near ones those of the first rows.

    Points beyond a query's ``bound`` need not be found.  ``compared`` counts the distances taken.
    """

    def __init__(self, tree: Tree, queries: np.ndarray, k: int, factor: float, bound: np.ndarray | None = None):
        self.tree, self.queries, self.factor, self.compared = tree, queries, factor, 0
        self.bound = np.full(len(queries), np.inf) if bound is None else bound
        self.best = np.full((len(queries), k + 1), np.inf)  # a query's own point may be among them
        self.row = np.full((len(queries), k + 1), -1)
        self._visit(tree.root, np.arange(len(queries)))

    def _offer(self, q: np.ndarray, rows: np.ndarray, d: np.ndarray) -> None:
        self.compared += d.size
        keep = self.best.shape[1]
        dist = np.concatenate((self.best[q], d), axis=1)
        row = np.concatenate((self.row[q], np.broadcast_to(rows, d.shape)), axis=1)
        order = np.lexsort((row, dist), axis=1)[:, :keep]  # rows stand in the order of their smallest ids
        self.best[q] = np.take_along_axis(dist, order, axis=1)
        self.row[q] = np.take_along_axis(row, order, axis=1)

    def _visit(self, node: int, q: np.ndarray) -> None:
        if not len(q):
            return
        at = self.tree.nodes[node]
        if len(at) == 1:
            if len(at[0]):
                self._offer(q, at[0], distances(self.queries[q], self.tree.data[at[0]]))
            return
        vantage, radius, gap, inner, outer = at
        d = distances(self.queries[q], self.tree.data[vantage][None])
        self._offer(q, np.array([vantage]), d)
        d = d[:, 0]
        first = d <= (radius + gap) / 2
        self._visit(inner, q[first])
        self._visit(outer, q[~first])
        tau = np.minimum(self.best[q, -1], self.bound[q])
        self._visit(outer, q[first & ((gap - d) * self.factor <= tau + ROUNDING * (gap + d))])
        self._visit(inner, q[~first & ((d - radius) * self.factor <= tau + ROUNDING * (radius + d))])


def dealer(pivots: list[np.ndarray]) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Adds size, pivot, reach (the nearest pivot and its distance), names and away (all pivots of the vector's length)."""
    known = {size: ([i for i, v in enumerate(pivots) if len(v) == size], np.stack([v for v in pivots if len(v) == size]))
             for size in {len(v) for v in pivots}}

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sizes = batch["vector"].map(len)
            for size in sizes.unique():
                rows = batch[sizes == size]
                names, at = known.get(size, ([-1], np.zeros((1, size))))
                away = distances(np.stack(rows["vector"]), at)
                near = away.argmin(axis=1)
                yield rows.assign(size=size, pivot=np.array(names)[near], reach=away[np.arange(len(rows)), near],
                                  names=[names] * len(rows), away=list(away))
    return deal


def shards_of(index: DataFrame, pivots: list[np.ndarray]) -> DataFrame:
    """The points with size, pivot, reach and the shard each is dealt to."""
    dealt = index.mapInPandas(dealer(pivots), "vector array<double>, ids array<bigint>, size int, pivot int, reach double,"
                                              " names array<int>, away array<double>").drop("names", "away")
    dealt = dealt.withColumn("first", F.col("ids")[0])
    return range_parts(dealt, ["size", "pivot"], "reach", ["first"], max(1, -(-index.count() // SHARD_ROWS)), "shard").drop("first")


def walk(index: DataFrame, pairs: DataFrame, asked: DataFrame, k: int, factor: float) -> DataFrame:
    """query_id, vec_id, score: the k nearest of each (vec_id, shard, bound) pair's shard."""
    blocks = pairs.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / F.lit(QUERY_BLOCK)).cast("int").alias("blocks"))
    left = index.join(blocks, "shard").select(F.col("shard").alias("of"), "vector", "ids", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    right = (pairs.join(blocks, "shard").join(asked.select("vec_id", "vector"), "vec_id")
             .select(F.col("shard").alias("of"), F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int").alias("block"), "vec_id", "vector", "bound"))

    def run(own: pd.DataFrame, asks: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(own) and len(asks):
            own_size, ask_size = own["vector"].map(len), asks["vector"].map(len)
            for size in np.unique(own_size):
                mine, theirs = own[own_size == size], asks[ask_size == size]
                mine = mine.iloc[np.argsort([i[0] for i in mine["ids"]])]
                if not len(theirs):
                    continue
                found = Search(Tree(np.stack(mine["vector"])), np.stack(theirs["vector"]), k, factor, theirs["bound"].to_numpy(dtype=float))
                ids = mine["ids"].to_numpy()
                for query, rows, dist in zip(theirs["vec_id"], found.row, found.best):
                    got = sorted((d, i) for r, d in zip(rows, dist) if r >= 0 for i in ids[r] if i != query)[:k]
                    out += [(query, i, d) for d, i in got]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    return (left.groupBy("of", "block").cogroup(right.groupBy("of", "block"))
            .applyInPandas(run, "query_id bigint, vec_id bigint, score double"))


def admitted(asked: DataFrame, cells: DataFrame, first: DataFrame, taus: DataFrame, factor: float) -> DataFrame:
    """vec_id, shard, bound: the shards besides the first one that may hold a point as near as the bound."""
    def within(gap: Column, size: Column) -> Column:
        return gap * factor <= F.col("bound") + size * ROUNDING
    far = (asked.join(taus, "vec_id", "left").withColumn("bound", F.coalesce("bound", F.lit(float("inf"))))
           .select("vec_id", "size", "reach", "bound", F.explode(F.arrays_zip("names", "away")).alias("p"))
           .select("vec_id", "size", "reach", "bound", F.col("p.names").alias("pivot"), F.col("p.away").alias("away"))
           .filter(within((F.col("away") - F.col("reach")) / 2, F.col("away"))))
    gap = F.greatest(F.col("low") - F.col("away"), F.col("away") - F.col("high"))
    return (far.join(cells, ["size", "pivot"]).filter(within(gap, F.col("away") + F.col("high"))).select("vec_id", "shard", "bound").distinct()
            .join(first.select("vec_id", "shard"), ["vec_id", "shard"], "left_anti"))


def prepare(vectors: DataFrame, queries: DataFrame, k: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """The points in shards, the shards' shells (low to high, by pivot), the queries with their pivots, and each query's first shard."""
    distinct = points(valid(vectors), k).checkpoint()
    pivots = [np.array(r["vector"]) for r in distinct.select("vector").orderBy(F.xxhash64("vector"), "vector").limit(PIVOTS).collect()]
    index = shards_of(distinct, pivots)
    cells = index.groupBy("shard", "size", "pivot").agg(F.min("reach").alias("low"), F.max("reach").alias("high")).checkpoint()
    asked = (valid(queries).dropDuplicates(["vec_id"])
             .mapInPandas(dealer(pivots), "vec_id bigint, vector array<double>, size int, pivot int, reach double, names array<int>, away array<double>")
             .checkpoint())
    gap = F.greatest(F.lit(0.0), F.col("low") - F.col("reach"), F.col("reach") - F.col("high"))
    first = (asked.select("vec_id", "size", "pivot", "reach").join(cells, ["size", "pivot"]).groupBy("vec_id")
             .agg(F.min(F.struct(gap.alias("gap"), "shard")).alias("m"))
             .select("vec_id", F.col("m.shard").alias("shard"), F.lit(float("inf")).alias("bound")))
    return index, cells, asked, first


def bounds(near: DataFrame, k: int) -> DataFrame:
    """vec_id, bound: the k-th distance of queries that have found k."""
    return near.groupBy(F.col("query_id").alias("vec_id")).agg(F.count(F.lit(1)).alias("n"), F.max("score").alias("far")).select(
        "vec_id", F.when(F.col("n") >= k, F.col("far")).alias("bound"))


def search(vectors: DataFrame, queries: DataFrame, k: int = K, factor: float = FACTOR) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows of ``vectors`` for each row of ``queries`` (both vec_id, embedding)."""
    index, cells, asked, first = prepare(vectors, queries, k)
    near = walk(index, first, asked, k, factor).checkpoint()
    rest = walk(index, admitted(asked, cells, first, bounds(near, k), factor), asked, k, factor)
    rank = F.row_number().over(W.partitionBy("query_id").orderBy("score", "vec_id"))
    return (near.unionByName(rest).withColumn("rank", rank).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def report(vectors: DataFrame) -> DataFrame:
    """The nearest of every row whose vec_id is divisible by 100."""
    return search(vectors, vectors.filter("vec_id % 100 = 0"))
