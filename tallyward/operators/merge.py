"""Keyed merges of immutable tables, and what else changes rows by key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

POLICIES = ("overwrite", "keep", "coalesce_new", "greatest", "const")


def merge_keyed(target: DataFrame, updates: DataFrame, keys: list[str], policy: dict[str, str | tuple], order_by: list[Column] | None = None, newer_only: bool = False) -> DataFrame:
    """target with updates folded in by null-safe keys; a full outer join, written anew by the caller.

    policy by column: overwrite (the new value), keep (the first value), coalesce_new (new unless null), greatest, or
    ("const", value) where a row is updated; columns without one are overwritten. Several updates of a key: the last by
    order_by counts; without order_by, the greatest by all its columns (of map columns: their entries). A key that only one
    side has keeps that side's values. newer_only: an update counts only if it is not before the target's row by order_by
    (names of columns that both sides have), so that batches may come in any order.
    """
    if newer_only and not (order_by and all(isinstance(c, str) for c in order_by)):
        raise ValueError("newer_only needs order_by as names of columns")
    if order_by:
        w = Window.partitionBy(*keys).orderBy(*[c.desc() if isinstance(c, Column) else F.desc(c) for c in order_by])
        updates = updates.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")
    else:
        updates = one_each(updates, keys)
    columns = [c for c in target.columns if c not in keys]
    t, u = target.withColumn("__t", F.lit(True)).alias("t"), updates.withColumn("__u", F.lit(True)).alias("u")
    on = [F.col(f"t.{k}").eqNullSafe(F.col(f"u.{k}")) for k in keys]
    has_t, has_u = F.col("t.__t").isNotNull(), F.col("u.__u").isNotNull()
    late = F.struct(*[F.col(f"u.{c}") for c in order_by]) < F.struct(*[F.col(f"t.{c}") for c in order_by]) if newer_only else F.lit(False)
    out = [F.when(has_t, F.col(f"t.{k}")).otherwise(F.col(f"u.{k}")).alias(k) for k in keys]
    for c in columns:
        old, new = F.col(f"t.{c}"), F.col(f"u.{c}") if c in updates.columns else F.lit(None)
        rule = policy.get(c, "overwrite" if c in updates.columns else "keep")
        kind, *rest = rule if isinstance(rule, tuple) else (rule,)
        if kind not in POLICIES:
            raise ValueError(f"policy of {c} must be one of {POLICIES}")
        both = {"overwrite": new, "keep": old, "coalesce_new": F.coalesce(new, old), "greatest": F.greatest(old, new), "const": F.lit(rest[0]) if rest else new}[kind]
        out.append(F.when(has_t & has_u, F.when(late, old).otherwise(both)).when(has_t, old).otherwise(new).alias(c))
    return t.join(u, on, "full_outer").select(*out)


def one_each(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row of each key, the greatest by its other columns in their order, whatever the order of the rows."""
    rest = [c for c in rows.columns if c not in keys]
    if not rest:
        return rows.distinct()
    entries = lambda c: F.array_sort(F.map_entries(c)) if rows.schema[c].dataType.typeName() == "map" else F.col(c)
    best = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*[entries(c) for c in rest])).alias("__best"))
    return best.select(*[c if c in keys else F.col(f"__best.{c}").alias(c) for c in rows.columns])


def insert_if_absent(target: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """target and those of rows whose key it lacks, one a key."""
    return target.unionByName(one_each(rows, keys).join(target.select(*keys), keys, "left_anti"))


def captured(stored: DataFrame, payloads: DataFrame, kind: str = "kind", payload: str = "payload") -> tuple[DataFrame, DataFrame]:
    """(stored with what is new, payloads with source_id): a payload is known by its kind and the hash of its content, which also
    names it, so that capturing it again gives the same id. stored: source_id, kind, content_hash."""
    named = payloads.withColumn("content_hash", F.sha2(F.coalesce(F.col(payload).cast("string"), F.lit("")), 256))
    named = named.withColumn("source_id", F.sha2(F.concat_ws("/", F.coalesce(kind, F.lit("")), "content_hash"), 256))
    return insert_if_absent(stored, named.select("source_id", kind, "content_hash"), ["source_id"]).select(*stored.columns), named


def replace_groups(target: DataFrame, rows: DataFrame, group: list[str], groups: DataFrame | None = None) -> DataFrame:
    """target without the rows of the groups that `groups` (rows, where not given) names, and with rows: a document's
    promises before they are extracted anew. A group that is named and has no rows is emptied."""
    named = (rows if groups is None else groups).select(*group).distinct()
    return target.join(named, group, "left_anti").unionByName(rows)


def repoint(df: DataFrame, links: DataFrame, key: str) -> DataFrame:
    """df with its key replaced where links (old, new) says so."""
    return df.join(links.select(F.col("old").alias(key), "new"), key, "left").withColumn(key, F.coalesce("new", key)).drop("new")


def current_only_one(log: DataFrame, by: list[str], order: list[Column]) -> DataFrame:
    """An append-only log with is_current: the last row of each subject."""
    w = Window.partitionBy(*by).orderBy(*[c.desc() for c in order])
    return log.withColumn("is_current", F.row_number().over(w) == 1)


def appended_only(old: DataFrame, new: DataFrame, key: str, may_change: list[str]) -> DataFrame:
    """Rows of `old` that `new` lacks or shows otherwise than in may_change: key, problem."""
    fixed = [c for c in old.columns if c != key and c not in may_change]
    o = old.select(key, F.struct(*fixed).alias("o"))
    n = new.select(key, F.struct(*fixed).alias("n"), F.lit(True).alias("there"))
    return o.join(n, key, "left").where(F.col("there").isNull() | ~F.col("o").eqNullSafe(F.col("n"))).select(
        key, F.when(F.col("there").isNull(), "removed").otherwise("changed").alias("problem")
    )


def refresh(tables: dict[str, DataFrame], path: str) -> DataFrame:
    """Compute rollups anew and put each in its table's place below path; (table, rows) of what stands there now.

    A table may be read while it is computed: each is written beside its place, and all are moved when all are written. The
    table before is moved aside first and stays at _last until the new one is in its place.
    """
    spark = next(iter(tables.values())).sparkSession
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path}/_next/{name}")
    counts = []
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    for name in tables:
        new, old, aside = path_of(f"{path}/_next/{name}"), path_of(f"{path}/{name}"), path_of(f"{path}/_last/{name}")
        files = new.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(aside.getParent())
        if files.exists(old):
            files.delete(aside, True)
            if not files.rename(old, aside):
                raise OSError(f"{name} could not be moved aside below {path}")
        if not files.rename(new, old):
            files.rename(aside, old)
            raise OSError(f"{name} could not be moved into its place below {path}")
        files.delete(aside, True)
        counts.append(spark.read.parquet(f"{path}/{name}").agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), "rows"))
    return reduce(DataFrame.unionByName, counts)
