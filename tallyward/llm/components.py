"""Links to connected components: union-find inside the tasks, whose forests Spark merges; nothing is gathered on the driver."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, materialize

PER_TASK = 50_000
FOREST = 500_000  # links that one task's union-find holds, at about 100 bytes each


def tasks_for(rows: int, spark: SparkSession) -> int:
    """As many tasks as `rows` small rows ask for, at most the session's shuffle partitions."""
    return max(1, min(-(-rows // PER_TASK), int(spark.conf.get("spark.sql.shuffle.partitions", "200"))))


def union_find(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, root) of the links (u, v): root is the smallest node of its tree; roots themselves are left out."""
    names, flat = np.unique(np.concatenate([u, v]), return_inverse=True)
    parent = list(range(len(names)))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]  # path halving
        return x

    for a, b in zip(flat[: len(u)].tolist(), flat[len(u) :].tolist(), strict=True):
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    root = np.array(parent, np.int64)
    while True:
        above = root[root]
        if (above == root).all():
            break
        root = above
    own = np.flatnonzero(root != np.arange(len(names)))
    return names[own], names[root[own]]


def _forest(it):
    """The links of a partition to the trees of its union-find; begun anew with the trees so far after FOREST links."""
    u = v = np.zeros(0, np.int64)
    for batch in it:
        u = np.concatenate([u, batch.column(0).to_numpy(zero_copy_only=False)])
        v = np.concatenate([v, batch.column(1).to_numpy(zero_copy_only=False)])
        if len(u) > 2 * FOREST:
            u, v = union_find(u, v)
            if len(u) > FOREST:  # trees that are too many to hold are handed on
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])
                u = v = np.zeros(0, np.int64)
    if len(u):
        u, v = union_find(u, v)
        yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for the nodes of `edges` (long) that are not the smallest of their component, which names it.

    FOREST links at most are turned into a forest by the union-find of one task. As long as there are more, a large-star and a
    small-star step tie trees together (grouped minima and joins on the node, in which adaptive execution splits hot nodes),
    and each task's union-find makes a forest of what they leave it; when nothing changes any more, the links are stars. Each
    round is written to the shared folder.
    Nulls link nothing; loops and repeated links are allowed; no links give no rows.
    """
    clean = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v")))
    links = materialize(clean, "links")

    def state(links: DataFrame):
        return links.agg(F.count("*").alias("n"), F.sum(F.hash("u", "v").cast("long")).alias("s"), F.sum(F.xxhash64("v", "u").cast("decimal(20,0)")).alias("x")).first()

    now = None if (n := links.count()) <= FOREST else state(links)
    while n > FOREST:
        # large star: every larger neighbour of u is tied to u's smallest neighbour
        both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: the smaller neighbours of u and u itself are tied to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        old, links = links, materialize(small.mapInArrow(_forest, "u long, v long").distinct(), "forests")
        before, now = now, state(links)
        n = now["n"]
        discard(old)
        if now == before:
            return _named(links)
    whole = materialize(links.coalesce(1).mapInArrow(_forest, "u long, v long"), "forest")
    discard(links)
    return _named(whole)


def _named(links: DataFrame) -> DataFrame:
    out = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    out.scratch_path = links.scratch_path
    return out
