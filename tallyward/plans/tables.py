"""The driver's tables, and the public-record entities that they stand for."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..folders import shared_folder as shared_folder

MONEY = "decimal(14,2)"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def gifts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """recipient, item, amount, kind (six values), day: one row a line item."""
    return read(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.col("l_suppkey").alias("recipient"), F.col("l_partkey").alias("item"), F.col("l_extendedprice").cast(MONEY).alias("amount"),
        F.concat("l_returnflag", "l_linestatus").alias("kind"), F.to_date("l_shipdate").alias("day"),
    )


def donations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """gifts with contributor and cycle, which the orders hold."""
    orders = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("contributor"), F.year("o_orderdate").alias("cycle"))
    return gifts(spark, sf_dir).join(orders, "l_orderkey").drop("l_orderkey")


DONATIONS_SQL = """donations AS (
  SELECT l_suppkey AS recipient, l_partkey AS item, CAST(l_extendedprice AS DECIMAL(14,2)) AS amount, l_returnflag || l_linestatus AS kind,
    CAST(l_shipdate AS DATE) AS day, o_custkey AS contributor, year(o_orderdate) AS cycle
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vote_id, member, position, bill, ts, day: one row an event."""
    return read(spark, sf_dir, "events").select(
        F.col("event_id").alias("vote_id"), F.col("user_id").alias("member"), F.col("event_type").alias("position"),
        F.get_json_object("props", "$.k").cast("long").alias("bill"), "ts", F.to_date("ts").alias("day"),
    )


VOTES_SQL = """votes AS (SELECT event_id AS vote_id, user_id AS member, event_type AS position, CAST(json_extract_string(props, '$.k') AS BIGINT) AS bill,
  ts, CAST(ts AS DATE) AS day FROM events)"""


def bills(spark: SparkSession, sf_dir: str) -> DataFrame:
    """bill, area, subjects, question."""
    return read(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("bill"), F.col("p_brand").alias("area"), F.split("p_name", " ").alias("subjects"), F.col("p_type").alias("question")
    )


BILLS_SQL = "bills AS (SELECT p_partkey AS bill, p_brand AS area, string_split(p_name, ' ') AS subjects, p_type AS question FROM part)"
