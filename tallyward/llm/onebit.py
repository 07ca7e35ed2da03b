"""Operator 12: approximate nearest neighbours by inner product, with randomly rotated one-bit codes.

The index: a vector's offset from a centre (the mean of SAMPLE rows) is filled up with zeros to `bits` components, turned by a
random rotation, and kept as the signs of its components, packed, with two scalars: its length, and the inner product `align`
of its direction with the direction of the signs. Every row is indexed; the index is a table in the shared folder.

The search: a query is turned alike and rounded to four bits a component. Its inner product with the signs is then four ANDs
and popcounts, and the estimate of <query, vector> is <query, centre> + length * that / align. It is off by no more than
length * SURE standard deviations of what rotation and rounding may do, all but surely. In each shard the vectors with the
largest upper bounds are scored first; then all whose upper bound reaches the kth score so far. Scores are exact inner products
of the original vectors, summed in the order of the components in double precision.

Vectors are dealt to shards by a hash of their row, at least SHARDS and of about SHARD rows each; queries are sent to the shards.

Defined cases: vectors that are null, empty or zero, or hold null or non-finite components take no part; a shorter vector
counts as filled up with zeros; a query's own row is no candidate for it, others with its id are; repeated query rows ask each;
null ids take no part; fewer candidates than k give all; no rows give none; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import free_name, materialize, ship, with_rows
from .shards import ITEM, QUERY, matrix, search_shards

SHARD = 65_536
SHARDS = 16
SAMPLE = 4096
SURE = 3.0
PLANES = 4


def rotation(dims: int, bits: int, seed: int = 12) -> np.ndarray:
    """bits x dims, orthonormal columns: what a random rotation of `bits` components does to the first `dims`."""
    q, r = np.linalg.qr(np.random.Generator(np.random.PCG64(seed)).standard_normal((bits, dims)))
    return q * np.sign(np.diag(r))


def encode(x: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes as rows of uint64 words, lengths, aligns)."""
    off = x - centre
    length = np.sqrt((off * off).sum(1))
    turned = off @ turn.T
    codes = np.packbits(turned > 0, axis=1, bitorder="little").view("<u8")
    with np.errstate(invalid="ignore", divide="ignore"):
        align = np.abs(turned).sum(1) / (math.sqrt(len(turn)) * length)
    return codes, length, np.where(length > 0, align, 1.0)


class Codes:
    """A shard's codes, and its vectors for the final scores."""

    def __init__(self, table: pa.Table, centre: np.ndarray, turn: np.ndarray):
        self.x, self.centre, self.turn = matrix(table.column("v"), len(centre)), centre, turn
        self.ids, self.file, self.at = (table.column(c).to_numpy() for c in ("id", "file", "at"))
        self.length, align = (table.column(c).to_numpy() for c in ("length", "align"))
        self.codes = np.frombuffer(b"".join(table.column("code").to_pylist()), "<u8").reshape(len(self.ids), -1)
        self.ones = np.bitwise_count(self.codes).sum(1, dtype=np.int64)
        self.factor = self.length / align
        self.spread = self.length * np.sqrt(np.maximum(0, 1 - align * align)) / align

    def bounds(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(estimates, how far they may be off) of <q, every vector>."""
        bits = len(self.turn)
        turned = self.turn @ q
        low = turned.min()
        step = (turned.max() - low) / (2**PLANES - 1) or 1.0
        level = np.rint((turned - low) / step).astype(np.uint8)
        total = np.zeros(len(self.codes), np.int64)
        for plane in range(PLANES):
            word = np.packbits((level >> plane) & 1, bitorder="little").view("<u8")
            total += np.bitwise_count(self.codes & word).sum(1, dtype=np.int64) << plane
        rounded = low + step * level
        signed = (2 * (low * self.ones + step * total) - rounded.sum()) / math.sqrt(bits)
        lost = math.sqrt(((turned - rounded) ** 2).sum() / bits)
        norm = math.sqrt((q * q).sum())
        off = SURE * (self.spread * norm / math.sqrt(bits - 1) + self.factor * lost)
        return float(self.centre @ q) + self.factor * signed, off

    def scores(self, q: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return np.cumsum(self.x[rows] * q, axis=1)[:, -1]

    def best(self, q: np.ndarray, file: int, at: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the k best candidates here, ties to smaller ids."""
        estimate, off = self.bounds(q)
        upper = estimate + off
        upper[(self.file == file) & (self.at == at)] = -np.inf
        n = min(len(upper), 3 * k)
        rows = np.argpartition(upper, len(upper) - n)[len(upper) - n :]
        s = self.scores(q, rows)
        s[upper[rows] == -np.inf] = -np.inf
        if n == 3 * k:
            floor = np.partition(s, n - k)[n - k]
            more = upper >= floor
            more[rows] = False
            more = np.flatnonzero(more)
            rows, s = np.concatenate([rows, more]), np.concatenate([s, self.scores(q, more)])
        rows, s = rows[s > -np.inf], s[s > -np.inf]
        order = np.lexsort((self.ids[rows], -s))[:k]
        return self.ids[rows][order], s[order]


def _encoder(centre: np.ndarray, turn: np.ndarray):
    def kernel(batches):
        for batch in batches:
            codes, length, align = encode(matrix(batch.column("v"), len(centre)), centre, turn)
            code = pa.array([c.tobytes() for c in codes], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, code, pa.array(length), pa.array(align)], [*batch.schema.names, "code", "length", "align"])

    return kernel


def nearest(
    vectors: DataFrame, is_query: Column, k: int = 20, bits: int = 256, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k nearest found of each row where is_query holds. Codes have `bits` bits, or as
    many as vectors have components if that is more."""
    spark = vectors.sparkSession
    ship(spark)
    value = F.col(vector_col)
    sound = F.exists(value, lambda v: v != 0) & ~F.exists(value, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    row = free_name(vectors, "row")
    rows = with_rows(vectors, row).where(F.col(id_col).isNotNull() & value.isNotNull()).where(sound)
    rows = rows.select(F.col(id_col).cast("long").alias("id"), F.col(f"{row}.file").alias("file"), F.col(f"{row}.at").alias("at"), F.coalesce(is_query, F.lit(False)).alias("asks"), value.alias("v"))
    size = rows.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("dims")).first()
    out = "query_id long, file long, at long, vec_id long, score double"
    dims = size["dims"] or 1
    bits = 64 * -(-max(bits, dims) // 64)
    sample = rows.select("v").orderBy(F.xxhash64("file", "at")).limit(SAMPLE).toArrow()
    centre = matrix(sample.column("v"), dims).mean(0) if sample.num_rows else np.zeros(dims)
    turn = rotation(dims, bits)
    shared = spark.sparkContext.broadcast((centre, turn))
    kind = rows.schema["v"].dataType.simpleString()
    index = rows.mapInArrow(_encoder(centre, turn), f"id long, file long, at long, asks boolean, v {kind}, code binary, length double, align double")
    index = materialize(index, "codes")

    shards = max(SHARDS, -(-size["n"] // SHARD))
    items = index.drop("asks").withColumns({"shard": F.pmod(F.xxhash64("file", "at"), F.lit(shards)).cast("int"), "kind": F.lit(ITEM)})
    asked = index.where("asks").select("id", "file", "at", "v").withColumns({"shard": F.explode(F.sequence(F.lit(0), F.lit(shards - 1))), "kind": F.lit(QUERY)})

    def build(table: pa.Table) -> Codes:
        return Codes(table, *shared.value)

    def answer(codes: Codes, table: pa.Table) -> pa.Table:
        own = [table.column(c).to_numpy() for c in ("id", "file", "at")]
        x = matrix(table.column("v"), len(codes.centre))
        found = [codes.best(q, own[1][i], own[2][i], k) for i, q in enumerate(x)]
        n = [len(f[0]) for f in found]
        cols = [pa.array(np.repeat(c, n), pa.int64()) for c in own]
        cols += [pa.array(np.concatenate([f[j] for f in found]), t) for j, t in enumerate((pa.int64(), pa.float64()))]
        return pa.Table.from_arrays(cols, ["query_id", "file", "at", "vec_id", "score"])

    found = search_shards(items.unionByName(asked, allowMissingColumns=True), shards, build, answer, out)
    best = Window.partitionBy("file", "at").orderBy(F.desc("score"), "vec_id")  # k rows of each shard at most
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
