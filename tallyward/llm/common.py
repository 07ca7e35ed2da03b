"""What the corpus operators share: scratch tables, Arrow text kernels and hashing.

The kernels work on Arrow's own string buffers (all texts of a batch end to end, with offsets), cut into slices of
bounded size, so that the memory of a task follows SLICE_BYTES and the longest single text, not the batch.
"""

from __future__ import annotations

import contextlib
import contextvars
import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE_BYTES = 1 << 19
BLOCK = 1 << 14  # numbers that are worked on at once, so that they stay in the cache
_M64 = (1 << 64) - 1


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def scratch(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir. Where that is unset, a local master gets a temporary folder (tests); on a
    cluster the executors could not write where the driver reads, so it must be set there."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="spark-checkpoint-")
        spark.conf.set("spark.checkpoint.dir", base)
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/tallyward-{uuid.uuid4().hex}"


_recording: contextvars.ContextVar[tuple[list[str], ...]] = contextvars.ContextVar("recording", default=())


@contextlib.contextmanager
def recording(paths: list[str]):
    """Note the scratch tables that are made meanwhile, by this thread or task alone."""
    before = _recording.set((*_recording.get(), paths))
    try:
        yield paths
    finally:
        _recording.reset(before)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write df as Parquet in the shared folder and read it again. Its shuffle files go once it is written."""
    spark = df.sparkSession
    path = f"{scratch(spark)}/{name}"
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    for paths in _recording.get():
        paths.append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def with_rows(docs: DataFrame, name: str) -> DataFrame:
    """docs with the column `name`, a struct of two longs that names each row alike at every read, whatever the session's
    parallelism: in Parquet tables the file (hashed) and the row's place in it; other frames are written once with numbers."""
    if "_metadata" not in docs.columns and docs._jdf.queryExecution().analyzed().nodeName().startswith("LogicalRelation"):
        try:
            return docs.select("*", F.struct(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at")).alias(name))
        except AnalysisException:  # files of another format
            pass
    return materialize(docs.select("*", F.struct(F.lit(0).cast("long").alias("file"), F.monotonically_increasing_id().alias("at")).alias(name)), "rows")


ROW = "struct<file: bigint, at: bigint>"


def free_name(df: DataFrame, name: str) -> str:
    """`name`, with underscores before it until no column of df has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def delete(spark: SparkSession, paths: list[str]) -> None:
    """Delete scratch tables, by the file system that Spark wrote them to."""
    for path in paths:
        where = spark._jvm.org.apache.hadoop.fs.Path(path).getParent()
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def discard(*tables: DataFrame) -> None:
    """Delete tables of materialize() that nothing lazy reads any more."""
    for df in tables:
        delete(df.sparkSession, [df.scratch_path])


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser, on uint64."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def mix_here(x: np.ndarray, spare: np.ndarray) -> None:
    """mix() in place; spare is an array of the same length to work in."""
    np.right_shift(x, np.uint64(30), out=spare)
    np.bitwise_xor(x, spare, out=x)
    np.multiply(x, np.uint64(0xBF58476D1CE4E5B9), out=x)
    np.right_shift(x, np.uint64(27), out=spare)
    np.bitwise_xor(x, spare, out=x)
    np.multiply(x, np.uint64(0x94D049BB133111EB), out=x)
    np.right_shift(x, np.uint64(31), out=spare)
    np.bitwise_xor(x, spare, out=x)


def as_long(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64, copy=False).view(np.int64)


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = 0x9E3779B97F4A7C55  # odd, so that it has an inverse modulo 2**64
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, n of each."""
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            full = np.full(max(n, SLICE_BYTES + 1), base, np.uint64)
            full[0] = 1
            _powers[k] = np.multiply.accumulate(full)
    return _powers[0], _powers[1]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """C with C[i] = sum of byte codes times powers before i; span_hash turns two of its entries into a span's hash."""
    up, _ = power_tables(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    for x, y in batches(len(data), BLOCK):
        np.take(_BYTE, data[x:y], out=out[x + 1 : y + 1], mode="clip")
        out[x + 1 : y + 1] *= up[x:y]
    return np.cumsum(out, out=out)


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of data[start:end], equal for equal bytes wherever they stand."""
    _, down = power_tables(len(prefix))
    return mix((prefix[end] - prefix[start]) * down[start] + (end - start).astype(np.uint64))


def text_slices(column: pa.ChunkedArray | pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) for runs of texts of at most SLICE_BYTES, or one longer text. Null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    n = len(column)
    if not n:
        return
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, where, data = column.buffers()
    kind = np.int64 if wide else np.int32
    offsets = np.frombuffer(where, kind, n + 1 + column.offset)[column.offset :].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SLICE_BYTES, side="right")) - 1)
        yield at, raw[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def end_to_end(column: pa.Array, kind) -> tuple[np.ndarray, np.ndarray]:
    """What the rows of a binary column hold, one after the other, as numbers of that kind; and how many each row holds."""
    kind = np.dtype(kind)
    where = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1 + column.offset)[column.offset :] if len(column) else np.zeros(1, np.int32)
    n = np.diff(where) // kind.itemsize
    if not n.sum():
        return np.zeros(0, kind), n
    return np.frombuffer(column.buffers()[2], kind, int(n.sum()), int(where[0])), n


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def words(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, first word of each text): maximal runs of bytes outside `space`, never across two texts."""
    off = space[data]
    cut = np.ones(len(data) + 1, bool)
    cut[1:-1] = off[:-1]
    cut[offsets] = True
    start = np.flatnonzero(~off & cut[:-1])
    stop = np.ones(len(data) + 1, bool)
    stop[:-1] = off
    stop[offsets] = True
    end = np.flatnonzero(~off & stop[1:]) + 1
    return start, end, np.searchsorted(start, offsets)


def batches(n_rows: int, step: int) -> Iterator[tuple[int, int]]:
    for at in range(0, n_rows, step):
        yield at, min(n_rows, at + step)


_shipped: set[str] = set()
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once a session, so that their Python finds it wherever the driver runs. Where the
    session leaves the bytes of an Arrow batch at Spark's 64 MB, they are bounded by 8 MB: a batch is held several times over,
    in the JVM and in Python."""
    import os
    import shutil

    app = spark.sparkContext.applicationId
    if spark.conf.get(_BATCH).rstrip("b") == str(64 << 20):
        spark.conf.set(_BATCH, str(8 << 20))
    if app not in _shipped:
        root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        base = os.path.join(tempfile.mkdtemp(prefix="tallyward-"), "tallyward")
        shutil.copytree(os.path.join(root, "tallyward"), os.path.join(base, "tallyward"), ignore=shutil.ignore_patterns("__pycache__"))
        spark.sparkContext.addPyFile(shutil.make_archive(base, "zip", base))
        _shipped.add(app)
