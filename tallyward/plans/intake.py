"""Loading as queries: committees, transactions, candidates, seats."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.intake import committees, counted, races, route_candidates, transactions
from .tables import read


def committee_rows(spark, sf_dir):
    k = F.col("c_custkey")
    raw = read(spark, sf_dir, "customer").select(
        F.concat(F.lit(" C"), k.cast("string")).alias("cmte_id"), F.when(k % 6 == 0, "  ").otherwise(F.col("c_name")).alias("name"), F.lit("N").alias("kind"), F.when(k % 2 == 0, "P").otherwise("").alias("designation"),
        F.col("c_mktsegment").alias("party"), F.lit(" ").alias("cand_id"), F.when(k % 3 == 0, "XYZ").otherwise("NY").alias("state"),
    )
    return committees(raw)


def _transactions(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem")
    k = F.col("l_orderkey")
    raw = li.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("sub_id"), F.col("l_partkey").cast("string").alias("cmte_id"), F.lit("R").alias("other_id"), F.col("l_suppkey").cast("string").alias("cand_id"),
        F.when(F.col("l_returnflag") == "A", "24A").when(F.col("l_returnflag") == "R", "24E").otherwise("15").alias("kind"), F.when(k % 50 == 0, "n/a").otherwise(F.col("l_extendedprice").cast("decimal(14,2)").cast("string")).alias("amount"),
        F.when(k % 40 == 0, "99999999").otherwise(F.date_format("l_shipdate", "MMddyyyy")).alias("day"), F.lit("").alias("name"),
    )
    targets = read(spark, sf_dir, "supplier").where("s_suppkey % 4 != 0").select(F.col("s_suppkey").cast("string").alias("cand_id"), (F.col("s_suppkey") * 10).alias("candidacy"))
    return transactions(raw, targets, read(spark, sf_dir, "part").where("p_partkey % 3 != 0").select(F.col("p_partkey").cast("string").alias("cmte_id")))


def transaction_rows(spark, sf_dir):
    good, _ = _transactions(spark, sf_dir)
    return good.groupBy("candidacy", "kind").agg(F.count("*").alias("rows"), F.sum("amount").cast("double").alias("amount"), F.count("day").alias("dated"), F.count("contributor_id").alias("known"), F.count("recipient_id").alias("received"))


def transaction_rejects(spark, sf_dir):
    return counted(_transactions(spark, sf_dir)[1], "reason")


def _seats(spark, sf_dir):
    n = read(spark, sf_dir, "nation")
    state = F.col("n_name").alias("state")
    return n.where("n_nationkey % 6 != 5").select(state, (F.col("n_nationkey") % 4 + 1).cast("int").alias("seats")), n.where("n_nationkey % 3 = 0").select(state, F.lit(2).alias("class"))


def race_seats(spark, sf_dir):
    return races(*_seats(spark, sf_dir))


def candidate_routing(spark, sf_dir):
    k = F.col("c_custkey")
    c = read(spark, sf_dir, "customer").join(read(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    rows = c.select(k.alias("id"), (k % 700).alias("person"), F.when(k % 10 == 0, "P").when(k % 2 == 0, "H").otherwise("S").alias("office"), F.col("n_name").alias("state"), (k % 6).cast("string").alias("district"), F.when(k % 7 == 0, 2024).otherwise(2026).alias("year"))
    return route_candidates(rows, 2026, *_seats(spark, sf_dir))


QUERIES = {f.__name__: f for f in (committee_rows, transaction_rows, transaction_rejects, race_seats, candidate_routing)}

_T = """t AS (SELECT l_suppkey * 10 AS candidacy, CASE l_returnflag WHEN 'A' THEN '24A' WHEN 'R' THEN '24E' ELSE '15' END AS kind, l_extendedprice, l_orderkey, l_partkey,
  CASE WHEN l_suppkey % 4 = 0 THEN 'no_target' WHEN l_orderkey % 50 = 0 THEN 'bad_amount' END AS reason FROM lineitem)"""
_S = "seats AS (SELECT n_name AS state, CAST(n_nationkey % 4 + 1 AS INTEGER) AS seats FROM nation WHERE n_nationkey % 6 <> 5), senate AS (SELECT n_name AS state, 2 AS class FROM nation WHERE n_nationkey % 3 = 0)"

ORACLES = {
    "committee_rows": "SELECT 'C' || c_custkey AS cmte_id, CASE WHEN c_custkey % 6 = 0 THEN 'C' || c_custkey ELSE c_name END AS name, 'N' AS kind, CASE WHEN c_custkey % 2 = 0 THEN 'P' END AS designation, c_mktsegment AS party, CAST(NULL AS VARCHAR) AS cand_id, CASE WHEN c_custkey % 3 <> 0 THEN 'NY' END AS state FROM customer",
    "transaction_rows": f"WITH {_T} SELECT candidacy, kind, count(*) AS rows, CAST(sum(CAST(l_extendedprice AS DECIMAL(14,2))) AS DOUBLE) AS amount, count(*) FILTER (l_orderkey % 40 <> 0) AS dated, count(*) FILTER (l_partkey % 3 <> 0) AS known, count(*) FILTER (kind = '15') AS received FROM t WHERE reason IS NULL GROUP BY 1, 2",
    "transaction_rejects": f"WITH {_T} SELECT reason, count(*) AS rows FROM t WHERE reason IS NOT NULL GROUP BY 1",
    "race_seats": f"WITH {_S} SELECT 'H' AS office, state, CASE WHEN seats = 1 THEN '00' ELSE lpad(CAST(n AS VARCHAR), 2, '0') END AS district, CAST(NULL AS INTEGER) AS class FROM (SELECT state, seats, unnest(range(1, seats + 1)) AS n FROM seats) UNION ALL SELECT 'S', state, NULL, class FROM senate",
    "candidate_routing": f"""WITH {_S}, c AS (SELECT c_custkey AS id, c_custkey % 700 AS person, CASE WHEN c_custkey % 10 = 0 THEN 'P' WHEN c_custkey % 2 = 0 THEN 'H' ELSE 'S' END AS office, n_name AS state, c_custkey % 6 AS d, c_custkey % 7 = 0 AS old FROM customer JOIN nation ON c_nationkey = n_nationkey),
j AS (SELECT c.*, seats, class, CASE WHEN office = 'H' THEN CASE WHEN seats = 1 THEN '00' WHEN d BETWEEN 1 AND seats THEN lpad(CAST(d AS VARCHAR), 2, '0') END END AS district FROM c LEFT JOIN seats USING (state) LEFT JOIN senate USING (state)),
r AS (SELECT *, CASE WHEN office = 'P' THEN 'office' WHEN old THEN 'year' WHEN seats IS NULL THEN 'territory' WHEN office = 'H' AND district IS NULL THEN 'district' WHEN office = 'S' AND class IS NULL THEN 'senate' END AS reason FROM j),
f AS (SELECT *, min(id) FILTER (reason IS NULL) OVER (PARTITION BY state, office, district, person) AS first FROM r)
SELECT id, person, office, state, district, CASE WHEN office = 'S' THEN class END AS class, CASE WHEN reason IS NULL AND id <> first THEN 'duplicate' ELSE reason END AS skip_reason FROM f""",
}
