"""Published snapshots: a Parquet table each, a manifest of rows and content hashes, packed columns and thin facts."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..folders import files


def content_hash(df: DataFrame):
    """An aggregate that does not depend on the order of rows, but on how often each occurs and on the columns' names."""
    cells = [c for name in sorted(df.columns) for c in (F.lit(name), F.to_json(F.struct(name)))]
    return F.sum(F.xxhash64(*cells).cast("decimal(20,0)")).cast("string")


def manifest(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, rows, content_hash) of every table, one aggregate each; the hash of no rows is that of the columns' names."""
    one = [
        df.agg(F.count("*").alias("rows"), content_hash(df).alias("h")).select(F.lit(n).alias("table"), "rows", F.sha2(F.concat_ws("|", F.lit(",".join(sorted(df.columns))), "h"), 256).alias("content_hash"))
        for n, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, one)


def write_snapshot(tables: dict[str, DataFrame], path: str, backlog: int = 0, ceiling: int | None = None) -> DataFrame:
    """Write all tables below path and give their manifest, with bytes; refused while exportable rows are unscreened. The
    manifest, which says that a snapshot is whole, is written last, and not at all if the tables hold more than `ceiling` bytes."""
    if backlog:
        raise ValueError(f"{backlog} exportable rows are not screened yet")
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")
    spark = next(iter(tables.values())).sparkSession
    sizes = [spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/{n}").select(F.lit(n).alias("table"), "length") for n in tables]
    sizes = reduce(DataFrame.unionByName, sizes).groupBy("table").agg(F.sum("length").alias("bytes"))
    out = manifest({n: spark.read.parquet(f"{path}/{n}") for n in tables}).join(sizes, "table", "left")
    total = out.agg(F.sum("bytes")).first()[0] or 0
    if ceiling is not None and total > ceiling:
        raise ValueError(f"the snapshot holds {total} bytes, more than {ceiling}")
    out.write.mode("overwrite").parquet(f"{path}/_manifest_table")
    return out


def pack_columns(df: DataFrame, by: str, order: str, columns: list[str], span: int | None = None) -> DataFrame:
    """Per group an array for each column, all in one order. Without `span` a group is one row: groups are states and the like,
    of bounded size. With it, `order` is a whole number and a group is cut into pieces of `span` numbers (piece 0 from 0 on),
    so that one that holds a third of all rows is packed by many tasks; pieces without rows are left out, rows with a null
    `order` have a piece of their own, null."""
    if span is None:
        own, keys = df, [by]
    else:
        own, keys = df.withColumn("piece", F.expr(f"(`{order}` - pmod(`{order}`, {span}L)) div {span}L")), [by, "piece"]
    rows = own.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(order, *[c for c in columns if c != order]))).alias("r"))
    return rows.select(*keys, *[F.col(f"r.{c}").alias(c) for c in columns])


def split_dimension(df: DataFrame, key: str, wide: list[str]) -> tuple[DataFrame, DataFrame]:
    """(facts without the wide columns, one row a key with them)."""
    return df.drop(*wide), df.groupBy(key).agg(*[F.min(c).alias(c) for c in wide])


def _commits(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """(number, version) of the commits below path, oldest first; a marker whose writer died before it wrote counts as none."""
    system, where = files(spark, f"{path}/commits")
    if not system.exists(where):
        return []
    said = spark.read.text(f"{path}/commits").select("value", F.col("_metadata.file_name").alias("n")).collect()  # one a commit that is kept
    return sorted((int(r.n), r.value) for r in said if r.n.isdigit() and r.value)


def publish(tables: dict[str, DataFrame], path: str, gates: dict[str, DataFrame] | None = None, ceiling: int | None = None, keep: int = 2) -> DataFrame:
    """Write named tables as one snapshot that is seen whole or not at all, and give its manifest: table, rows, content_hash, bytes.

    gates: name -> rows that forbid publishing; any such row refuses it before anything is written. All tables go to a new
    version's folder, then the manifest beside them; the commit is a numbered marker that names the version and that only one
    writer can create. Readers take the version of the last marker, so a failure at any point leaves the snapshot before in
    place. Of older versions `keep` - 1 stay for readers; what no marker names is deleted with them by clean().
    """
    spark = next(iter(tables.values())).sparkSession
    shut = [name for name, rows in (gates or {}).items() if not rows.isEmpty()]
    if shut:
        raise ValueError(f"not published: {', '.join(sorted(shut))}")
    version = f"v-{uuid.uuid4().hex}"
    before = _commits(spark, path)
    number = before[-1][0] + 1 if before else 1
    out = write_snapshot(tables, f"{path}/versions/{version}", ceiling=ceiling)
    system, marker = files(spark, f"{path}/commits/{number:08d}")
    stream = system.create(marker, False)  # fails where another writer was first
    stream.write(bytearray(f"{version}\n".encode()))
    stream.close()
    clean(spark, path, keep)
    return out


def clean(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Delete what the last `keep` commits do not name: older versions with their markers, and what failed writers left. Not to
    be run while another writer publishes."""
    commits = _commits(spark, path)
    live = {v for _, v in commits[-keep:]}
    system, where = files(spark, f"{path}/versions")
    for f in system.listStatus(where) if system.exists(where) else ():
        if f.getPath().getName() not in live:
            system.delete(f.getPath(), True)
    for n, _ in commits[:-keep]:
        system.delete(files(spark, f"{path}/commits/{n:08d}")[1], True)


def published(spark: SparkSession, path: str, table: str | None = None) -> DataFrame:
    """A table of the snapshot that stands, or its manifest."""
    commits = _commits(spark, path)
    if not commits:
        raise FileNotFoundError(f"nothing is published below {path}")
    return spark.read.parquet(f"{path}/versions/{commits[-1][1]}/{table or '_manifest_table'}")
