"""Operator 11: centroid clustering in exact whole numbers, with a vantage-point tree over the centroids.

Components are scaled to integers, floor(scale * x). Each round builds a vantage-point tree over the centroids and broadcasts
it (the number of centroids, a parameter, bounds its size). Tasks assign their vectors by best-first branch and bound: each
vector opens the node with the smallest lower bound on the distance until that bound is above its best distance; at equality
the node is opened, so that ties are seen and go to the smaller number. All vectors of a batch take a step together, grouped
by the node that each opens. Tasks give sums a cluster and component, whose totals (centroids x components) reach the driver.

Distances at vantage points and leaves are exact: whole float64 numbers while they stay below 2**53, else 64-bit integers, else
Python's. Sums are kept in two halves, so that they are exact for any components.

Defined cases: vectors that are null, of another length, or hold null or non-finite components take no part; components
count as the nearest 64-bit integer, and so do distances and inertia beyond 64 bits; fewer vectors than k are a centroid each;
repeated rows and ids are vectors of their own (as first centroids, equal ids go by their components); a null id has no hash
and goes after all others as a first centroid; no vectors give no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, ship

LEAF = 4
CELLS = 1 << 22  # bounds of a batch that are held at once
MOST = 2**63 - 1


def exact_kind(x: np.ndarray, c: np.ndarray) -> type:
    """In what squared distances of rows of x to rows of c are exact: float, int64 or Python's integers."""
    most = max(max(int(a.max(initial=0)), -int(a.min(initial=0))) for a in (x, c))
    room = 4 * most * most * x.shape[1]
    return float if room < 2**53 else np.int64 if room < 2**63 else object


def squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of x to all rows of c, both of exact_kind."""
    if x.dtype == float:
        return (x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)[None, :]
    return np.stack([((x - row) ** 2).sum(1) for row in c], 1)


class VantageTree:
    """Nodes as lists: the centroids of a leaf, or one vantage point and its children with the range of their distances to it."""

    def __init__(self, centroids: list[list[int]]):
        self.c = np.array(centroids, np.int64)
        self.exact = self.c.astype(exact_kind(self.c, self.c))
        self.members: list[np.ndarray] = []
        self.kids: list[list[tuple[int, float, float]]] = []
        self._build(np.arange(len(self.c)))

    def _build(self, members: np.ndarray) -> int:
        me = len(self.members)
        self.kids.append([])
        if len(members) <= LEAF:
            self.members.append(members)
            return me
        far = squares(self.exact[members], self.exact[members[:1]])[:, 0]
        top = int(np.argmax(far))
        self.members.append(members[top : top + 1])
        rest = np.delete(members, top)
        away = np.sqrt(squares(self.exact[rest], self.exact[members[top : top + 1]])[:, 0].astype(float))
        order = np.argsort(away, kind="stable")
        for half in np.array_split(order, 2):
            self.kids[me].append((self._build(np.sort(rest[half])), float(away[half].min()), float(away[half].max())))
        return me

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(centroid, exact squared distance) of each row."""
        step = max(1, CELLS // len(self.members))
        got = [self._nearest(x[lo : lo + step]) for lo in range(0, len(x), step)]
        return (np.concatenate(part) for part in zip(*got, strict=True)) if got else (np.zeros(0, np.int64), np.zeros(0, np.int64))

    def _nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        kind = exact_kind(x, self.c)
        x, c = x.astype(kind), self.c.astype(kind)
        who = np.full(len(x), len(c))
        best = np.full(len(x), {float: np.inf, np.int64: MOST, object: 2**200}[kind], kind)
        radius = np.full(len(x), np.inf)
        bound = np.full((len(x), len(self.members)), np.inf)
        bound[:, 0] = 0
        live = np.arange(len(x))
        while len(live):
            node = bound[live].argmin(1)
            low = bound[live, node]
            more = (low <= radius[live]) & (low < np.inf)
            live, node = live[more], node[more]
            bound[live, node] = np.inf
            for t in np.unique(node):
                rows = live[node == t]
                members = self.members[t]
                d = squares(x[rows], c[members])
                at = d.argmin(1)  # members ascend: of equal distances the smaller number
                near, number = d[np.arange(len(rows)), at], members[at]
                wins = ((near < best[rows]) | ((near == best[rows]) & (number < who[rows]))).astype(bool)
                won = rows[wins]
                best[won], who[won] = near[wins], number[wins]
                radius[won] = np.sqrt(best[won].astype(float)) * (1 + 1e-9)
                if self.kids[t]:
                    away = np.sqrt(d[:, 0].astype(float))
                    for kid, lo, hi in self.kids[t]:
                        bound[rows, kid] = np.maximum(0, np.maximum(away - hi, lo - away) - 1e-9 * (away + hi))
        return who, best


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _sums(tree, k: int, dims: int):
    """Kernel: for each cluster and component the sum of upper and lower halves; component -1 counts the vectors."""

    def kernel(batches):
        high, low, n = np.zeros((k, dims), np.int64), np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(0), dims)
            who, _ = tree.value.nearest(x)
            order = np.argsort(who, kind="stable")
            x, who = x[order], who[order]
            start = np.flatnonzero(np.r_[True, who[1:] != who[:-1]])
            own = who[start]
            n[own] += np.diff(np.r_[start, len(who)])
            high[own] += np.add.reduceat(x >> 32, start, 0)
            low[own] += np.add.reduceat(x & 0xFFFFFFFF, start, 0)
        own = np.flatnonzero(n)
        cluster = np.repeat(own, dims + 1)
        at = np.tile(np.arange(-1, dims), len(own))
        both = [np.concatenate([first[own, None], rest[own]], 1).ravel() for first, rest in ((np.zeros(k, np.int64), high), (n, low))]
        yield pa.RecordBatch.from_arrays([pa.array(cluster, pa.int32()), pa.array(at, pa.int32()), *(pa.array(b, pa.int64()) for b in both)], ["cluster", "at", "high", "low"])

    return kernel


def _assigned(tree, dims: int):
    def kernel(batches):
        for batch in batches:
            who, best = tree.value.nearest(_matrix(batch.column(1), dims))
            far = pa.array([min(MOST, int(b)) for b in best], pa.int64()) if best.dtype == object else pa.array(best.astype(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(who.astype(np.int32)), far], ["vec_id", "cluster", "distance"])

    return kernel


def cluster(
    vectors: DataFrame, k: int = 8, rounds: int = 10, dims: int = 64, seed: str = "3:", scale: int = 1024, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector of `dims` components. The first
    centroids are the k vectors with the smallest SHA-256 of seed and id; an empty cluster keeps its centroid."""
    spark = vectors.sparkSession
    ship(spark)
    value = F.col(vector_col)
    sound = (F.size(value) == dims) & ~F.exists(value, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    rows = vectors.where(value.isNotNull()).where(sound)
    rows = rows.select(F.col(id_col).alias("vec_id"), F.transform(value, lambda v: F.floor(v.cast("double") * scale)).alias("v"))
    rows = materialize(rows, "vectors")
    digest = F.sha2(F.concat(F.lit(seed), F.col("vec_id").cast("string")), 256)
    centroids = [list(r.v) for r in rows.orderBy(F.asc_nulls_last(digest), "v").limit(k).collect()]
    if not centroids:
        return rows.selectExpr("vec_id", "0 AS cluster", "0L AS distance", "0L AS cluster_inertia", "0L AS inertia", "'' AS centroid_sha256")

    def total(column: str):
        return F.sum(F.col(column).cast("decimal(20, 0)")).alias(column)

    for _ in range(rounds):
        tree = spark.sparkContext.broadcast(VantageTree(centroids))
        sums = rows.select("v").mapInArrow(_sums(tree, len(centroids), dims), "cluster int, at int, high long, low long")
        sums = {(r.cluster, r["at"]): (int(r.high) << 32) + int(r.low) for r in sums.groupBy("cluster", "at").agg(total("high"), total("low")).collect()}
        centroids = [[sums[c, i] // sums[c, -1] for i in range(dims)] if (c, -1) in sums else old for c, old in enumerate(centroids)]
        tree.unpersist()

    tree = spark.sparkContext.broadcast(VantageTree(centroids))
    kind = rows.schema["vec_id"].dataType.simpleString()
    done = materialize(rows.mapInArrow(_assigned(tree, dims), f"vec_id {kind}, cluster int, distance long"), "assigned")
    inertia = {r.cluster: int(r.distance) for r in done.groupBy("cluster").agg(total("distance")).collect()}
    every = sum(inertia.values())
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    facts = [(c, min(MOST, inertia.get(c, 0)), min(MOST, every), names[c]) for c in range(len(centroids))]
    facts = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return done.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
