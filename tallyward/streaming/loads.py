"""Incremental loads: file streams that stop when all is read, folded into tables by key, batch by batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.merge import merge_keyed


def above_mark(rows: DataFrame, stored: DataFrame, group: list[str], number: str) -> DataFrame:
    """Rows numbered above what is stored for their group (0 where nothing is)."""
    marks = stored.groupBy(*group).agg(F.max(number).alias("__mark"))
    return rows.join(marks, group, "left").where(F.col(number) > F.coalesce("__mark", F.lit(0))).drop("__mark")


def _files(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def replay(
    spark: SparkSession, source: DataFrame, path: str, fold: Callable[[DataFrame | None, DataFrame], DataFrame], keys: list[str], buckets: int = 32
) -> DataFrame:
    """Run a stream to its end; each batch is folded into the table so far, and a batch that comes again changes nothing.

    The table is parted into buckets of its keys. A batch writes the buckets that it touches anew, as version v<batch>, and
    m<batch>, which says which version of each bucket counts; so a repeated batch starts from what was before it. Versions
    that neither this batch nor the one before refers to are deleted.
    """
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")

    def versions(session: SparkSession, number: int) -> dict[int, int]:
        files, where = _files(session, f"{path}/m{number}")
        return {r.bucket: r.version for r in session.read.schema("bucket int, version long").json(f"{path}/m{number}").collect()} if files.exists(where) else {}

    def one(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        held, older = versions(session, number - 1), versions(session, number - 2)
        batch = batch.persist()
        try:
            touched = [r[0] for r in batch.select(bucket.alias("bucket")).distinct().collect()]  # `buckets` at most
            own = [f"{path}/v{held[b]}/bucket_of_key={b}" for b in touched if b in held]
            before = session.read.parquet(*own) if own else None
            fold(before, batch).withColumn("bucket_of_key", bucket).write.mode("overwrite").partitionBy("bucket_of_key").parquet(f"{path}/v{number}")
        finally:
            batch.unpersist()
        now = held | dict.fromkeys(touched, number)
        session.createDataFrame(list(now.items()), "bucket int, version long").coalesce(1).write.mode("overwrite").json(f"{path}/m{number}")
        for b, v in older.items():
            if held.get(b, v) != v:
                files, where = _files(session, f"{path}/v{v}/bucket_of_key={b}")
                files.delete(where, True)

    query = source.writeStream.foreachBatch(one).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    files, where = _files(spark, f"{path}/m*")
    numbers = [int(f.getPath().getName()[1:]) for f in files.globStatus(where)]
    if not numbers:
        return spark.createDataFrame([], source.schema)
    now = versions(spark, max(numbers))
    return spark.read.parquet(*[f"{path}/v{v}/bucket_of_key={b}" for b, v in sorted(now.items())])


def amend(keys: list[str], policy: dict, order: list[str]) -> Callable[[DataFrame | None, DataFrame], DataFrame]:
    """A fold by which the later record of a key, by `order`, takes the earlier one's place, in whatever order they come."""

    def fold(before: DataFrame | None, batch: DataFrame) -> DataFrame:
        empty = batch.limit(0) if before is None else before
        return merge_keyed(empty, batch, keys, policy, order, newer_only=True)

    return fold


def windowed_counts(events: DataFrame, ts: str, by: str, late: str = "1 hour", size: str = "1 day") -> DataFrame:
    """Counts by event-time window with a bound for late rows; works on streams and tables alike."""
    return events.withWatermark(ts, late).groupBy(F.window(ts, size), by).agg(F.count("*").alias("n"))
