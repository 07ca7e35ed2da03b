"""Rings as adaptive quadtree cells, so that points find by equality which rings they may be in."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..folders import shared_folder, written

DEPTH, MOST, BAND = 12, 16, 32
RING, CELL, ENDS = ["state", "ring"], ["level", "cx", "cy"], ["x1", "y1", "x2", "y2"]
OFFSET = 0.01370177  # of the root's size, so that cell borders and centres miss round coordinates


class Cells(NamedTuple):
    """leaves: state, ring, level, cx, cy, edge (whether segments touch the cell), sides (the segments that do; null for a cell of
    the last level that more touch than cells are split for), odd (whether its centre is inside the ring); cells outside their
    ring, which nothing touches, are left out. crowds: the segments of edge cells without sides, a row each; None without such
    cells. A root square, of which a cell of a level is a 2**level-th part each way, and the levels that occur."""

    leaves: DataFrame
    crowds: DataFrame | None
    x0: float
    y0: float
    size: float
    levels: list[int]

    def centre(self, cell: str, low: float) -> Column:
        return F.lit(low) + (F.col(cell) + 0.5) * self.size / F.pow(F.lit(2.0), "level")


def _crossings(x: Column, y: Column, to: Column | None = None, end: Callable[[str], Column] = F.col) -> Column:
    """Whether a segment, whose ends `end` gets by their names, crosses the ray from (x, y) to the right, or its part up to `to`
    (to the right or left)."""
    x1, y1, x2, y2 = map(end, ENDS)
    at = (x2 - x1) * (y - y1) / F.when(y2 == y1, F.lit(1e-12)).otherwise(y2 - y1) + x1
    reach = x < at if to is None else (F.least(x, to) < at) & (at <= F.greatest(x, to))
    return ((y1 > y) != (y2 > y)) & reach


def _rises(x: Column, y: Column, to: Column, end: Callable[[str], Column] = F.col) -> Column:
    """Whether a segment crosses the upright way from (x, y) to (x, to). A point at a crossing's height is above it, as for rays."""
    x1, y1, x2, y2 = map(end, ENDS)
    at = (y2 - y1) * (x - x1) / F.when(x2 == x1, F.lit(1e-12)).otherwise(x2 - x1) + y1
    return ((x1 > x) != (x2 > x)) & (F.least(y, to) < at) & (at <= F.greatest(y, to))


def inside_rings(points: DataFrame, segs: DataFrame, key: list[str]) -> DataFrame:
    """(key, state, ring, odd) of points (key, state, ring, x, y) that name the ring they are held against: an odd number of
    crossings to the right. Segments meet points in bands of height, as many as leave BAND segments to each."""
    shape = segs.groupBy(*RING).agg(F.min(F.least("y1", "y2")).alias("low"), F.max(F.greatest("y1", "y2")).alias("high"), F.count("*").alias("n"))
    shape = shape.withColumn("h", F.greatest((F.col("high") - F.col("low")) * BAND / F.greatest(F.col("n"), F.lit(BAND)), F.lit(1e-9))).select(*RING, "low", "h")
    band = lambda y: F.floor((F.col(y) - F.col("low")) / F.col("h"))
    parts = segs.join(shape, RING).withColumn("band", F.explode(F.sequence(F.least(band("y1"), band("y2")), F.greatest(band("y1"), band("y2"))))).select(*RING, "band", *ENDS)
    near = points.join(shape, RING).withColumn("band", band("y")).select(*key, *RING, "band", "x", "y")
    met = near.join(parts, [*RING, "band"], "left")
    return met.groupBy(*key, *RING).agg((F.count_if(_crossings(F.col("x"), F.col("y"))) % 2 == 1).alias("odd"))


def ring_cells(segs: DataFrame, depth: int = DEPTH, most: int = MOST, least: int = 0) -> Cells:
    """The cells of each ring of segs (state, ring, seq, x1, y1, x2, y2). A ring begins with the cells, four at most, of the
    level whose cells are no smaller than its box; cells that more than `most` segments touch are split, `depth` times at
    most. Any that a segment touches is split `least` times (`depth` at most), which fits the cells to their ring where many
    points are held against each: there are more cells, with less ground to those on the edge. Each round of splits is
    written to the shared folder; only whether there is another one comes to the driver. Rings are dealt to all cores at first,
    as each makes many more rows than it has."""
    spark = segs.sparkSession
    path = shared_folder(spark, "cells")
    segs = segs.select(*RING, *ENDS).repartition(spark.sparkContext.defaultParallelism, *RING)
    low = segs.agg(*[F.min(F.least(a, b)) for a, b in (("x1", "x2"), ("y1", "y2"))], *[F.max(F.greatest(a, b)) for a, b in (("x1", "x2"), ("y1", "y2"))]).first()
    x0, y0, x1, y1 = (0.0, 0.0, 1.0, 1.0) if low[0] is None else low
    size = max(x1 - x0, y1 - y0, 1e-9) * (1 + 2 * OFFSET)
    x0, y0 = x0 - size * OFFSET, y0 - size * OFFSET

    def touching(df: DataFrame) -> DataFrame:
        """Rows of segments and cells where the one reaches into the other."""
        side = F.lit(size) / F.pow(F.lit(2.0), "level")
        lo_x, lo_y = F.lit(x0) + F.col("cx") * side, F.lit(y0) + F.col("cy") * side
        slack = side * 1e-9
        lo_x, lo_y, hi_x, hi_y = lo_x - slack, lo_y - slack, lo_x + side + slack, lo_y + side + slack
        x1, y1, x2, y2 = (F.col(c) for c in ENDS)
        near = (F.least(x1, x2) <= hi_x) & (F.greatest(x1, x2) >= lo_x) & (F.least(y1, y2) <= hi_y) & (F.greatest(y1, y2) >= lo_y)
        sides = [(x2 - x1) * (b - y1) - (y2 - y1) * (a - x1) for a in (lo_x, hi_x) for b in (lo_y, hi_y)]  # of the cell's corners to the segment's line
        return df.where(near & (F.least(*sides) <= 0) & (F.greatest(*sides) >= 0))

    span = F.greatest(F.max(F.greatest("x1", "x2")) - F.min(F.least("x1", "x2")), F.max(F.greatest("y1", "y2")) - F.min(F.least("y1", "y2")))
    box = segs.groupBy(*RING).agg(F.min(F.least("x1", "x2")).alias("bx"), F.min(F.least("y1", "y2")).alias("by"), F.max(F.greatest("x1", "x2")).alias("tx"), F.max(F.greatest("y1", "y2")).alias("ty"), span.alias("span"))
    box = box.withColumn("level", F.greatest(F.lit(0), F.least(F.lit(40), F.floor(F.log2(F.lit(size) / F.greatest("span", F.lit(size * 2.0**-40)))))).cast("int"))
    place = lambda c, low: F.floor((F.col(c) - low) * F.pow(F.lit(2.0), "level") / size)
    first = box.withColumn("cx", F.explode(F.sequence(place("bx", x0), place("tx", x0)))).withColumn("cy", F.explode(F.sequence(place("by", y0), place("ty", y0)))).select(*RING, *CELL)
    cells = written(first, f"{path}/cells0")
    parts = written(touching(segs.join(cells, RING)), f"{path}/parts0")
    at, blank, edges, many = [*RING, *CELL], [], [], None
    for step in range(depth + 1):
        counts = parts.groupBy(*at).agg(F.count("*").alias("n"))
        blank.append(cells.join(counts, at, "left_anti"))
        full = counts.where(F.lit(step < depth) & (F.lit(step < least) | (F.col("n") > most))).select(*at)
        edges.append(parts.join(full, at, "left_anti"))
        if step == depth and not (crowded := counts.where(F.col("n") > most)).isEmpty():
            many, edges[-1] = parts.join(crowded, at, "left_semi"), parts.join(crowded, at, "left_anti")
        if full.isEmpty():
            break
        split = lambda df: df.withColumn("q", F.explode(F.array(*map(F.lit, range(4))))).withColumns({"level": F.col("level") + 1, "cx": F.col("cx") * 2 + F.col("q") % 2, "cy": F.col("cy") * 2 + F.floor(F.col("q") / 2)}).drop("q")
        cells = written(split(full), f"{path}/cells{step + 1}")
        parts = written(touching(split(parts.join(full, at, "left_semi"))), f"{path}/parts{step + 1}")
    sides = reduce(DataFrame.unionByName, edges).groupBy(*at).agg(F.collect_list(F.struct(*ENDS)).alias("sides"))
    leaves = reduce(DataFrame.unionByName, blank).withColumn("edge", F.lit(False)).unionByName(sides.withColumn("edge", F.lit(True)), allowMissingColumns=True)
    if many is not None:
        many = written(many, f"{path}/crowds")
        leaves = leaves.unionByName(many.select(*at).distinct().withColumn("edge", F.lit(True)), allowMissingColumns=True)
    leaves = written(leaves, f"{path}/found")
    out = Cells(leaves, many, x0, y0, size, [])
    refs = leaves.withColumns({"x": out.centre("cx", x0), "y": out.centre("cy", y0)})
    leaves = written(leaves.join(inside_rings(refs, segs, CELL), at).where("edge or odd"), f"{path}/leaves")
    levels = sorted(r[0] for r in leaves.select("level").distinct().collect())  # 53 at most
    return out._replace(leaves=leaves, levels=levels)


def inside(points: DataFrame, cells: Cells, key: list[str]) -> DataFrame:
    """(key, ring) for points (key, state, x, y) and the rings of their state that they are in. A point finds the leaf that it
    lies in by state, level and place. In a leaf that nothing touches it is inside; in an edge leaf the segments there that
    are crossed on the way to the leaf's centre tell, first level with the point, then upright. A leaf's row holds its segments,
    so that a point and a leaf are settled where they meet and no pair is shuffled, save for the leaves of crowds. Points are
    dealt to as many tasks as the session shuffles to, as the work is in the pairs and not in the bytes."""
    spark = points.sparkSession
    spot = lambda c, low: F.floor((F.col(c) - low) * F.pow(F.lit(2.0), "level") / cells.size)
    levels = F.explode(F.array(*map(F.lit, cells.levels)) if cells.levels else F.array().cast("array<int>"))
    own = points.select(*key, "state", "x", "y", levels.alias("level")).withColumns({"cx": spot("x", cells.x0), "cy": spot("y", cells.y0)})
    sides, flat = F.col("sides"), [(e, i) for i in (0, 1) for e in ENDS]  # most leaves have one or two: as plain columns they cost a pair the least
    leaves = cells.leaves.withColumns({"rx": cells.centre("cx", cells.x0), "ry": cells.centre("cy", cells.y0), "crowd": F.col("edge") & sides.isNull()} | {f"{e}_{i}": F.get(sides, i)[e] for e, i in flat})
    leaves = leaves.withColumn("sides", F.when(F.size(sides) > 2, F.slice(sides, 3, F.greatest(F.size(sides), F.lit(1)))))
    met = own.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "state", *CELL).join(leaves.hint("merge"), ["state", *CELL])
    rx, ry = F.col("rx"), F.col("ry")
    way = lambda *end: _crossings(F.col("x"), F.col("y"), rx, *end).cast("int") + _rises(rx, F.col("y"), ry, *end).cast("int")
    two = sum((F.coalesce(way(lambda e, i=i: F.col(f"{e}_{i}")), F.lit(0)) for i in (0, 1)), F.lit(0))
    ways = F.when(sides.isNull(), two).otherwise(F.aggregate(sides, two, lambda n, s: n + way(s.getField)))
    found = met.where(~F.col("edge") | (~F.col("crowd") & ((ways % 2 == 1) != F.col("odd")))).select(*key, "ring")
    if cells.crowds is None:
        return found
    odd = met.where("crowd").join(cells.crowds, ["state", "ring", *CELL]).groupBy(*key, "ring").agg(F.sum(way()).alias("__ways"), F.first("odd").alias("__odd"))
    return found.unionByName(odd.where((F.col("__ways") % 2 == 1) != F.col("__odd")).select(*key, "ring"))
