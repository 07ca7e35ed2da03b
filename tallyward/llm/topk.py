"""Operator 3: exact top-k search by inner product, with a ball tree a shard.

Components are scaled to integers, floor(scale * x), so that scores are exact and ties are real. Vectors are dealt to at least
SHARDS shards, of about SHARD rows each, by a hash of their row. Each shard's ball tree (nodes halve along the coordinate of
largest spread) is built once and written to the shared folder, as its nodes and its vectors in the tree's order. Queries are
sent to shards; a task reads a tree and answers the queries as they stream by. For each it opens nodes in the order of the
bound <q, centre> + |q| radius, until no open node's bound reaches the current kth score. The kth score is shared between
shards: a first wave searches each query's home shard only, and the second, all others, starts from the kth score found there.

Components count as the nearest 64-bit integer to floor(scale * x). Scores are summed as float64 while all partial sums stay
below 2**53, else as Python integers; a score beyond 64 bits counts as the nearest of them.

Defined cases: vectors that are null or empty, or hold null or non-finite components, take no part; a shorter vector counts as
filled up with zeros; a query's own row is no candidate for it, others with its id are; repeated query rows ask each; null ids
take no part; fewer candidates than k give all; no rows give none; other columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, free_name, materialize, ship, with_rows
from .shards import ITEM, QUERY, matrix, search_shards

SHARD = 16_384
SHARDS = 16
LEAF = 64
NODE, VECTOR = 0, 1


class BallTree:
    """Nodes lo:hi of the rows in the tree's order, with centre, radius and children (left 0: a leaf)."""

    def __init__(self, x: np.ndarray):
        self.order = np.arange(len(x))
        self.lo: list[int] = []
        self.hi: list[int] = []
        self.left: list[int] = []
        self.right: list[int] = []
        self.centres: list[np.ndarray] = []
        self.radii: list[float] = []
        self._build(x, 0, len(x))

    def _build(self, x: np.ndarray, lo: int, hi: int) -> int:
        own = x[self.order[lo:hi]]
        centre = own.mean(0)
        me = len(self.lo)
        for held, value in ((self.lo, lo), (self.hi, hi), (self.left, 0), (self.right, 0), (self.centres, centre), (self.radii, float(np.sqrt(((own - centre) ** 2).sum(1).max())))):
            held.append(value)
        if hi - lo > LEAF:
            axis = int(np.argmax(own.max(0) - own.min(0)))
            if own[:, axis].max() > own[:, axis].min():
                mid = (hi - lo) // 2
                self.order[lo:hi] = self.order[lo:hi][np.argpartition(own[:, axis], mid)]
                self.left[me] = self._build(x, lo, lo + mid)
                self.right[me] = self._build(x, lo + mid, hi)
        return me


_TREE = "shard int, part int, at long, id long, file long, row long, v array<double>, lo int, hi int, left int, right int, radius double"


def _planted(table: pa.Table) -> pa.Table:
    """The tree of one shard as rows: its nodes by number, then its vectors in the tree's order."""
    x = matrix(table.column("v"))
    tree = BallTree(x)
    nodes, n = len(tree.lo), len(x)
    lists = lambda m: pa.ListArray.from_arrays(pa.array(np.arange(0, m.size + 1, m.shape[1], dtype=np.int32)), pa.array(m.ravel()))
    own = [table.column(c).take(pa.array(tree.order)).combine_chunks() for c in ("id", "file", "row")]
    whole = lambda a, b, kind: pa.concat_arrays([pa.array(a, kind), b if isinstance(b, pa.Array) else pa.concat_arrays(b.chunks)])
    none = lambda m, kind: pa.nulls(m, kind)
    shard = table.column("shard")[0].as_py()
    cols = [pa.array(np.full(nodes + n, shard, np.int32)), pa.array(np.repeat(np.array([NODE, VECTOR], np.int32), [nodes, n])), pa.array(np.r_[np.arange(nodes), np.arange(n)])]
    cols += [whole([None] * nodes, c, pa.int64()) for c in own]
    cols += [pa.concat_arrays([lists(np.array(tree.centres)), lists(x[tree.order])])]
    cols += [whole(c, none(n, pa.int32()), pa.int32()) for c in (tree.lo, tree.hi, tree.left, tree.right)]
    cols += [whole(tree.radii, none(n, pa.float64()), pa.float64())]
    return pa.Table.from_arrays(cols, ["shard", "part", "at", "id", "file", "row", "v", "lo", "hi", "left", "right", "radius"])


class Shard:
    """A tree as it is read back."""

    def __init__(self, table: pa.Table):
        part, at = table.column("part").to_numpy(), table.column("at").to_numpy()
        nodes, vectors = (np.flatnonzero(part == p) for p in (NODE, VECTOR))
        nodes, vectors = nodes[np.argsort(at[nodes])], vectors[np.argsort(at[vectors])]
        all_rows = matrix(table.column("v"))
        self.centres, self.x = all_rows[nodes], all_rows[vectors]
        own = lambda rows, *names: (table.column(c).take(pa.array(rows)).to_numpy() for c in names)
        self.ids, self.file, self.row = own(vectors, "id", "file", "row")
        self.lo, self.hi, self.left, self.right, self.radii = own(nodes, "lo", "hi", "left", "right", "radius")
        self.most = max(float(np.abs(self.x).max(initial=0)), 1)

    def best(self, q: np.ndarray, file: int, row: int, floor: float, k: int) -> list[tuple[int, int]]:
        """(score, id) of the best k candidates that score `floor` at least. q: whole floats."""
        dims = max(self.x.shape[1], len(q))
        exact = self.most * max(float(np.abs(q).max(initial=0)), 1) * dims < 2**53
        q = np.pad(q, (0, dims - len(q)))[: self.x.shape[1]]  # components that no vector here has count for nothing
        norm = float(np.sqrt((q * q).sum()))
        bounds = self.centres @ q + norm * self.radii
        bounds = bounds + 1e-9 * (np.abs(bounds) + norm * (np.abs(self.radii) + 1)) + 1  # what rounding may take away
        best: list[tuple] = []  # a heap of (score, -id), the worst on top
        heap = [(-bounds[0], 0)]
        while heap:
            bound, node = heapq.heappop(heap)
            if -bound < floor:
                break
            if self.left[node]:
                for c in (self.left[node], self.right[node]):
                    if bounds[c] >= floor:
                        heapq.heappush(heap, (-bounds[c], c))
                continue
            lo, hi = self.lo[node], self.hi[node]
            x = self.x[lo:hi]
            s = x @ q if exact else np.array([max(-(2**63), min(2**63 - 1, sum(int(a) * int(b) for a, b in zip(r, q, strict=True)))) for r in x], object)
            other = (self.file[lo:hi] != file) | (self.row[lo:hi] != row)
            for j in np.flatnonzero((s >= floor) & other):
                item = (int(s[j]), -int(self.ids[lo + j]))
                if len(best) < k:
                    heapq.heappush(best, item)
                elif item > best[0]:
                    heapq.heapreplace(best, item)
            if len(best) == k:
                floor = max(floor, best[0][0])
        return [(s, -i) for s, i in best]


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 1024
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best candidates of each row where is_query holds."""
    spark = vectors.sparkSession
    ship(spark)
    value = F.col(vector_col)
    sound = (F.size(value) > 0) & ~F.exists(value, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    name = free_name(vectors, "row")
    rows = with_rows(vectors, name).where(F.col(id_col).isNotNull() & value.isNotNull()).where(sound).select(
        F.col(id_col).cast("long").alias("id"), F.col(f"{name}.file").alias("file"), F.col(f"{name}.at").alias("row"), F.coalesce(is_query, F.lit(False)).alias("asks"),
        F.transform(value, lambda v: F.floor(v.cast("double") * scale).cast("double")).alias("v"),
    )
    rows = materialize(rows, "vectors")
    shards = max(SHARDS, -(-rows.count() // SHARD))
    place = F.pmod(F.xxhash64("file", "row"), F.lit(shards)).cast("int")
    # a shard is of about SHARD rows, so that its group is bounded
    planted = rows.drop("asks").withColumn("shard", place).repartition(2 * shards, "shard").groupBy("shard").applyInArrow(_planted, _TREE)
    trees = materialize(planted, "trees")
    asked = rows.where("asks").select("id", "file", "row", "v", place.alias("home"))

    def answer(shard: Shard, table: pa.Table) -> pa.Table:
        ids, file, row = (table.column(c).to_numpy() for c in ("id", "file", "row"))
        floors = [-np.inf if f is None else f for f in table.column("floor").to_pylist()]
        got = [(int(ids[i]), int(file[i]), int(row[i]), d, s) for i, q in enumerate(matrix(table.column("v"))) for s, d in shard.best(q, file[i], row[i], floors[i], k)]
        cols = zip(*got, strict=True) if got else [[]] * 5
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in cols], ["query_id", "file", "row", "vec_id", "score"])

    def run(asked: DataFrame) -> DataFrame:
        items = trees.withColumn("kind", F.lit(ITEM))
        both = items.unionByName(asked.withColumn("kind", F.lit(QUERY)), allowMissingColumns=True)
        return search_shards(both, shards, Shard, answer, "query_id long, file long, row long, vec_id long, score long")

    best = Window.partitionBy("file", "row").orderBy(F.desc("score"), "vec_id")  # k rows of each shard at most

    def cut(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    own = ["id", "file", "row", "v"]
    first = materialize(run(asked.select(*own, F.col("home").alias("shard"), F.lit(None).cast("double").alias("floor"))), "found")
    low = F.min("score").cast("double")  # a score as a float may be rounded: one less is surely not above the kth score
    floors = first.groupBy("file", "row").agg(F.count("*").alias("n"), (low - F.greatest(F.lit(1.0), F.abs(low) * 1e-12)).alias("floor")).where(F.col("n") >= k).drop("n")
    others = asked.join(floors, ["file", "row"], "left").withColumn("shard", F.explode(F.sequence(F.lit(1), F.lit(shards - 1))))
    others = others.select(*own, F.pmod(F.col("home") + F.col("shard"), F.lit(shards)).cast("int").alias("shard"), "floor")
    return cut(first.unionByName(run(others))).select("query_id", "rank", "vec_id", "score")
