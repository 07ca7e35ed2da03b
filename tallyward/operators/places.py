"""Map labels: names, tiers, projection, points in polygons, and labels brought ashore."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .quadtree import Cells, inside, ring_cells

# Legal suffixes by the order in which they are tried; tiers (level, floor, sure rank, last rank); distances.
SUFFIXES = (
    "city", "town", "village", "borough", "municipality", "township", "CDP", "comunidad", "zona urbana", "urbana", "plantation", "gore",
    "grant", "location", "purchase", "reservation",
)
TIERS = ((1, 250_000, 12, 25), (2, 50_000, 40, 80), (3, 10_000, 150, 300))
SNAP_MULTIPLE, SNAP_LEAST, SNAP_MOST, RING_LEAST = 3.0, 2_000, 40_000, 3_000
RADII, DIRECTIONS = (400, 900, 1_800, 3_500, 7_000), 16


def bare_name(name: Column) -> Column:
    """A place's name without its legal suffix."""
    return F.regexp_replace(name, f" ({'|'.join(SUFFIXES)})$", "")


def tiers(df: DataFrame, by: str, pop: str, area: str, tie: str, levels=TIERS) -> DataFrame:
    """df with rank (by population, then area, then the tie column) and tier within each group."""
    df = df.withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy(F.desc(pop), F.desc(area), F.asc(tie))))
    tier = F.lit(4)
    for level, floor, sure, last in reversed(levels):
        tier = F.when((F.col("rank") <= sure) | ((F.col(pop) >= floor) & (F.col("rank") <= last)), level).otherwise(tier)
    return df.withColumn("tier", tier)


def albers(lon: Column, lat: Column, lon0: Column, lat0: Column, lat1: Column, lat2: Column, radius: float = 6_370_997.0) -> tuple[Column, Column]:
    """Albers equal-area conic coordinates in metres, by columns of parameters (a row of a region table each)."""
    rad = math.pi / 180
    n = (F.sin(lat1 * rad) + F.sin(lat2 * rad)) / 2
    c = F.cos(lat1 * rad) * F.cos(lat1 * rad) + 2 * n * F.sin(lat1 * rad)
    rho = lambda p: radius * F.sqrt(c - 2 * n * F.sin(p * rad)) / n
    theta = n * (lon - lon0) * rad
    return rho(lat) * F.sin(theta), rho(lat0) - rho(lat) * F.cos(theta)


def decode_arcs(arcs: DataFrame, scale: tuple[float, float], shift: tuple[float, float]) -> DataFrame:
    """(arc, seq, x, y) from delta-coded arcs (arc, seq, dx, dy): running sums, then scale and shift."""
    w = Window.partitionBy("arc").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    return arcs.select("arc", "seq", (F.sum("dx").over(w) * scale[0] + shift[0]).alias("x"), (F.sum("dy").over(w) * scale[1] + shift[1]).alias("y"))


def segments(rings: DataFrame, arcs: DataFrame) -> DataFrame:
    """(state, ring, seq, x1, y1, x2, y2) of closed rings. rings: state, ring, refs (arc numbers in order; -1 - n is arc n
    backwards). arcs: arc, seq, x, y."""
    ref = rings.select("state", "ring", F.posexplode("refs").alias("part", "ref")).withColumn("arc", F.when(F.col("ref") < 0, -1 - F.col("ref")).otherwise(F.col("ref")))
    points = ref.join(arcs, "arc").withColumn("at", F.when(F.col("ref") < 0, -F.col("seq")).otherwise(F.col("seq")))
    order = Window.partitionBy("state", "ring").orderBy("part", "at")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    nxt = lambda c: F.coalesce(F.lead(c).over(order), F.first(c).over(whole))
    return points.select("state", "ring", F.row_number().over(order).alias("seq"), F.col("x").alias("x1"), F.col("y").alias("y1"), nxt("x").alias("x2"), nxt("y").alias("y2"))


def boxes(segs: DataFrame) -> DataFrame:
    """The bounding box and the span of each ring."""
    b = segs.groupBy("state", "ring").agg(F.min("x1").alias("bx0"), F.min("y1").alias("by0"), F.max("x1").alias("bx1"), F.max("y1").alias("by1"))
    return b.withColumn("span", F.hypot(F.col("bx1") - F.col("bx0"), F.col("by1") - F.col("by0")))


def on_land(points: DataFrame, segs: DataFrame, key: list[str], cells: Cells | None = None) -> DataFrame:
    """key of the points (key, state, x, y) inside a ring of their state, by the rings' quadtree cells, which may be given where
    they are used more than once."""
    return inside(points, cells or ring_cells(segs), key).select(*key).distinct()


def nearest_coast(points: DataFrame, segs: DataFrame, key: str, within: float, least_span: float = RING_LEAST) -> DataFrame:
    """(key, distance, qx, qy): the nearest place on the rings of a point's state that span least_span at least, for points
    that have one within that distance. Segments meet points in square cells of that size."""
    big = segs.join(boxes(segs).where(F.col("span") >= least_span).select("state", "ring"), ["state", "ring"])
    cells = lambda a, b: F.explode(F.sequence(F.floor(F.least(a, b) / within) - 1, F.floor(F.greatest(a, b) / within) + 1))
    big = big.withColumn("cx", cells("x1", "x2")).withColumn("cy", cells("y1", "y2"))
    own = points.withColumn("cx", F.floor(F.col("x") / within)).withColumn("cy", F.floor(F.col("y") / within))
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    t = F.when(dx * dx + dy * dy == 0, 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((F.col("x") - F.col("x1")) * dx + (F.col("y") - F.col("y1")) * dy) / (dx * dx + dy * dy))))
    q = own.join(big, ["state", "cx", "cy"]).select(key, "x", "y", "ring", "seq", (F.col("x1") + t * dx).alias("qx"), (F.col("y1") + t * dy).alias("qy"))
    q = q.withColumn("distance", F.hypot(F.col("x") - F.col("qx"), F.col("y") - F.col("qy"))).where(F.col("distance") <= within)
    best = q.groupBy(key).agg(F.min_by(F.struct("distance", "qx", "qy"), F.struct("distance", "ring", "seq")).alias("b"))
    return best.select(key, "b.*")


def anchor(points: DataFrame, segs: DataFrame, key: str) -> DataFrame:
    """points (key, state, x, y, area) with placed: land, inland (moved to the first solid ground around the landfall),
    coast (the landfall itself) or dropped, and their new x and y."""
    cells = ring_cells(segs)
    ashore = on_land(points, segs, [key], cells).withColumn("dry", F.lit(True))
    allowed = F.least(F.lit(float(SNAP_MOST)), F.greatest(F.lit(float(SNAP_LEAST)), F.sqrt("area") * SNAP_MULTIPLE))
    at_sea = points.join(ashore, key, "left_anti")
    hit = at_sea.join(nearest_coast(at_sea, segs, key, float(SNAP_MOST)), key, "left").withColumn("ok", F.coalesce(F.col("distance") <= allowed, F.lit(False)))
    tries = [(i * DIRECTIONS + s, r * math.cos(2 * math.pi * s / DIRECTIONS), r * math.sin(2 * math.pi * s / DIRECTIONS)) for i, r in enumerate(RADII) for s in range(DIRECTIONS)]
    offsets = F.explode(F.array(*[F.struct(F.lit(n).alias("n"), F.lit(a).alias("a"), F.lit(b).alias("b")) for n, a, b in tries])).alias("o")
    search = hit.where("ok").select(key, "state", "qx", "qy", offsets).select(key, "state", F.col("o.n").alias("n"), (F.col("qx") + F.col("o.a")).alias("x"), (F.col("qy") + F.col("o.b")).alias("y"))
    solid = search.join(on_land(search, segs, [key, "n"], cells), [key, "n"]).groupBy(key).agg(F.min_by(F.struct(F.col("x").alias("sx"), F.col("y").alias("sy")), "n").alias("s"))
    moved = hit.join(solid, key, "left").select(
        key, F.when(~F.col("ok"), "dropped").when(F.col("s").isNotNull(), "inland").otherwise("coast").alias("placed"),
        F.when(F.col("ok"), F.coalesce("s.sx", "qx")).alias("x"), F.when(F.col("ok"), F.coalesce("s.sy", "qy")).alias("y"),
    )
    return points.join(ashore, key, "left_semi").select(key, F.lit("land").alias("placed"), "x", "y").unionByName(moved)
