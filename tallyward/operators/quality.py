"""Expectations on tables: row predicates, unique keys, references, publish gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def violations(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """(check, rows) for every check, in one pass; a predicate that is null counts as kept, as in a table constraint."""
    counts = df.agg(*[F.count_if(~F.coalesce(p, F.lit(True))).alias(n) for n, p in checks.items()])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(n).alias("check"), F.col(n).alias("rows")) for n in checks])).alias("x")).select("x.*")


def repeated_keys(df: DataFrame, keys: list[str], where: Column | None = None) -> DataFrame:
    """Keys that more than one row holds (of those that `where` picks)."""
    return (df if where is None else df.where(where)).groupBy(*keys).agg(F.count("*").alias("rows")).where("rows > 1")


def dangling(df: DataFrame, key: str, parents: DataFrame, parent_key: str) -> DataFrame:
    """(key, rows) of references that have no parent; null refers to nothing."""
    return df.where(F.col(key).isNotNull()).join(parents.select(F.col(parent_key).alias(key)).distinct(), key, "left_anti").groupBy(key).agg(F.count("*").alias("rows"))


def publish_gate(rows: DataFrame, unscreened: Column) -> DataFrame:
    """One row: rows, backlog, may_publish (no exportable row is left unscreened)."""
    return rows.agg(F.count("*").alias("rows"), F.count_if(unscreened).alias("backlog")).withColumn("may_publish", F.col("backlog") == 0)
