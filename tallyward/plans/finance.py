"""Money per recipient: rollups, ranked contributors, coverage and shares."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalars import at_least_zero, ratio
from ..operators.aggregates import filtered_sums, key_collisions, reconcile, top_sums
from .tables import DONATIONS_SQL, donations, gifts, read

D = "double"


def top_contributors(spark, sf_dir):
    df = donations(spark, sf_dir).where(F.col("kind") != "RF")
    top = top_sums(df, ["recipient"], "contributor", "amount", 15)
    names = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("contributor"), F.col("c_name").alias("name"))
    return top.join(names, "contributor").select("recipient", "rank", "contributor", "name", F.col("total").cast(D).alias("total"), "n_rows")


def outside_spenders(spark, sf_dir):
    df = donations(spark, sf_dir).where(F.col("kind").isin("AF", "RF")).withColumn("stance", F.when(F.col("kind") == "AF", "support").otherwise("oppose"))
    return top_sums(df, ["recipient", "stance"], "contributor", "amount", 10).withColumn("total", F.col("total").cast(D))


def top_conduits(spark, sf_dir):
    brands = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("item"), F.col("p_brand").alias("conduit"))
    net = gifts(spark, sf_dir).join(brands, "item").withColumn("amount", F.when(F.col("kind") == "RF", -F.col("amount")).otherwise(F.col("amount")))
    return top_sums(net, ["recipient"], "conduit", "amount", 10, positive=True).withColumn("total", F.col("total").cast(D))


def _rollup(spark, sf_dir):
    """Conditional sums a recipient; what came after its official coverage end counts apart."""
    df = gifts(spark, sf_dir)
    ends = read(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("recipient"), F.when(F.col("s_suppkey") % 7 != 0, F.date_add(F.lit("1996-01-01").cast("date"), (F.col("s_suppkey") % 700).cast("int"))).alias("coverage_end")
    )
    df = df.join(ends, "recipient", "left")
    k = F.col("kind")
    inside = F.col("coverage_end").isNull() | (F.col("day") <= F.col("coverage_end"))
    return filtered_sums(
        df, ["recipient"],
        {"pac": ("amount", k == "NO"), "individual": ("amount", k.isin("NF", "AO")), "own": ("amount", k == "RO"), "support": ("amount", k == "AF"),
         "oppose": ("amount", k == "RF"), "in_window": ("amount", inside & (k != "RF"))},
        {"n_individual": k.isin("NF", "AO"), "n_late": ~inside},
    )


def _official(rollup):
    """rollup with official: totals that recipients report themselves, what fell into their coverage, in whole hundreds."""
    own = F.col("in_window")
    return rollup.withColumn("official", (F.floor(own / 100) * 100 + F.when(F.col("recipient") % 5 == 0, own).otherwise(0)).cast("decimal(24,2)"))


def finance_rollup(spark, sf_dir):
    r = _rollup(spark, sf_dir)
    who = read(spark, sf_dir, "supplier").join(read(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    who = who.select(F.col("s_suppkey").alias("recipient"), F.col("s_name").alias("name"), F.col("n_name").alias("state"))
    money = [c for c in r.columns if r.schema[c].dataType.typeName() == "decimal"]
    return who.join(r, "recipient", "left").withColumns({c: F.coalesce(F.col(c), F.lit(0)).cast(D) for c in money})


def coverage_window(spark, sf_dir):
    r = _official(_rollup(spark, sf_dir))
    percent = F.round(100 * F.col("in_window").cast(D) / F.col("official").cast(D))
    return r.where("official > 0").select(
        "recipient", F.least(percent, F.lit(100.0)).alias("coverage_pct"), (F.col("in_window").cast(D) > 1.01 * F.col("official").cast(D)).alias("ahead"), "n_late"
    )


def funding_mix(spark, sf_dir):
    r = _rollup(spark, sf_dir)
    parts = ["pac", "individual", "own"]
    known = sum((at_least_zero(F.col(p)) for p in parts[1:]), at_least_zero(F.col(parts[0])))
    return r.select("recipient", *[ratio(at_least_zero(F.col(p)), known).alias(f"{p}_share") for p in parts], known.cast(D).alias("known"))


def divergence_report(spark, sf_dir):
    r = _official(_rollup(spark, sf_dir))
    share = ratio(F.col("in_window"), F.col("official"))
    return r.select("recipient", share.alias("ratio"), F.coalesce(F.abs(share - 1) > 0.15, F.lit(False)).alias("diverges"))


def spend_reconciliation(spark, sf_dir):
    head = _rollup(spark, sf_dir).select("recipient", "support")
    parts = outside_spenders(spark, sf_dir).where("stance = 'support'").withColumn("total", F.col("total").cast("decimal(24,2)"))
    return reconcile(head, parts, ["recipient"], "support", "total").withColumns({"support": F.col("support").cast(D), "listed": F.col("listed").cast(D)})


def committee_map_union(spark, sf_dir):
    """Authorised committees by linkage, and every committee's own segment where it has no linkage; distinct."""
    orders = read(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("committee"), F.col("o_orderstatus").alias("target"))
    cust = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("committee"), F.col("c_mktsegment").alias("target"))
    return orders.unionByName(cust.join(orders, "committee", "left_anti")).distinct()


def contested_keys(spark, sf_dir):
    return key_collisions(read(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey"), "l_partkey", "l_suppkey")


def seat_status(spark, sf_dir):
    """What is known of each seat: researched, collected, funded or bare; seats are (nation, account band)."""
    s = read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", (F.col("s_suppkey") % 4).cast("int").alias("seat"))
    r = _rollup(spark, sf_dir)
    flags = s.join(r, s.s_suppkey == r.recipient, "left").groupBy("s_nationkey", "seat").agg(
        F.bool_or(F.coalesce(F.col("oppose") > F.col("support"), F.lit(False))).alias("researched"),
        F.bool_or(F.coalesce(F.col("own") > F.col("pac"), F.lit(False))).alias("collected"),
        F.bool_or(F.coalesce(F.col("pac") > 0, F.lit(False))).alias("funded"),
    )
    status = F.when(F.col("researched"), "researched").when(F.col("collected"), "collected").when(F.col("funded"), "funded").otherwise("bare")
    return flags.groupBy("s_nationkey").agg(
        F.count("*").alias("seats"), *[F.count_if(status == x).alias(x) for x in ("researched", "collected", "funded", "bare")]
    )


QUERIES = {f.__name__: f for f in (top_contributors, outside_spenders, top_conduits, finance_rollup, coverage_window, funding_mix, divergence_report, spend_reconciliation, committee_map_union, contested_keys, seat_status)}

_ROLLUP = f"""{DONATIONS_SQL},
ends AS (SELECT s_suppkey AS recipient, CASE WHEN s_suppkey % 7 <> 0 THEN DATE '1996-01-01' + CAST(s_suppkey % 700 AS INTEGER) END AS coverage_end FROM supplier),
d AS (SELECT donations.*, coverage_end, coverage_end IS NULL OR day <= coverage_end AS inside FROM donations LEFT JOIN ends USING (recipient)),
r AS (SELECT recipient, coalesce(sum(amount) FILTER (kind = 'NO'), 0) AS pac, coalesce(sum(amount) FILTER (kind IN ('NF', 'AO')), 0) AS individual,
  coalesce(sum(amount) FILTER (kind = 'RO'), 0) AS own, coalesce(sum(amount) FILTER (kind = 'AF'), 0) AS support,
  coalesce(sum(amount) FILTER (kind = 'RF'), 0) AS oppose, coalesce(sum(amount) FILTER (inside AND kind <> 'RF'), 0) AS in_window,
  count(*) FILTER (kind IN ('NF', 'AO')) AS n_individual, count(*) FILTER (NOT inside) AS n_late FROM d GROUP BY recipient),
o AS (SELECT recipient, floor(in_window / 100) * 100 + CASE WHEN recipient % 5 = 0 THEN CAST(in_window AS DOUBLE) ELSE 0 END AS official FROM r)"""


def _top(by: str, item: str, n: int, source: str, where: str = "", having: str = "") -> str:
    return f"""SELECT * FROM (SELECT {by}, {item}, CAST(sum(amount) AS DOUBLE) AS total, count(*) AS n_rows,
  row_number() OVER (PARTITION BY {by} ORDER BY sum(amount) DESC, {item}) AS rank FROM {source} {where} GROUP BY {by}, {item} {having}) WHERE rank <= {n}"""


NOT_RF = "WHERE kind <> 'RF'"

ORACLES = {
    "top_contributors": f"WITH {DONATIONS_SQL}, t AS ({_top('recipient', 'contributor', 15, 'donations', NOT_RF)}) SELECT recipient, rank, contributor, c_name AS name, total, n_rows FROM t JOIN customer ON c_custkey = contributor",
    "outside_spenders": f"WITH {DONATIONS_SQL}, s AS (SELECT *, CASE WHEN kind = 'AF' THEN 'support' ELSE 'oppose' END AS stance FROM donations WHERE kind IN ('AF', 'RF')) {_top('recipient, stance', 'contributor', 10, 's')}",
    "top_conduits": f"WITH {DONATIONS_SQL}, s AS (SELECT recipient, p_brand AS conduit, CASE WHEN kind = 'RF' THEN -amount ELSE amount END AS amount FROM donations JOIN part ON p_partkey = item) {_top('recipient', 'conduit', 10, 's', having='HAVING sum(amount) > 0')}",
    "finance_rollup": f"""WITH {_ROLLUP} SELECT s_suppkey AS recipient, s_name AS name, n_name AS state,
  {', '.join(f'CAST(coalesce({c}, 0) AS DOUBLE) AS {c}' for c in ('pac', 'individual', 'own', 'support', 'oppose', 'in_window'))}, n_individual, n_late
  FROM supplier JOIN nation ON s_nationkey = n_nationkey LEFT JOIN r ON recipient = s_suppkey""",
    "coverage_window": f"""WITH {_ROLLUP} SELECT recipient, least(round(100 * CAST(in_window AS DOUBLE) / official), 100) AS coverage_pct,
  CAST(in_window AS DOUBLE) > 1.01 * official AS ahead, n_late FROM r JOIN o USING (recipient) WHERE official > 0""",
    "funding_mix": f"""WITH {_ROLLUP}, k AS (SELECT recipient, greatest(pac, 0) AS a, greatest(individual, 0) AS b, greatest(own, 0) AS c FROM r)
SELECT recipient, {', '.join(f'round(CASE WHEN a + b + c <> 0 THEN CAST({x} AS DOUBLE) / CAST(a + b + c AS DOUBLE) END, 4) AS {n}_share' for x, n in zip('abc', ('pac', 'individual', 'own'), strict=True))},
  CAST(a + b + c AS DOUBLE) AS known FROM k""",
    "divergence_report": f"""WITH {_ROLLUP}, x AS (SELECT recipient, round(CASE WHEN official <> 0 THEN CAST(in_window AS DOUBLE) / official END, 4) AS ratio FROM r JOIN o USING (recipient))
SELECT recipient, ratio, coalesce(abs(ratio - 1) > 0.15, false) AS diverges FROM x""",
    "spend_reconciliation": f"""WITH {_ROLLUP}, s AS (SELECT recipient, contributor, sum(amount) AS total FROM donations WHERE kind = 'AF' GROUP BY 1, 2),
t AS (SELECT *, row_number() OVER (PARTITION BY recipient ORDER BY total DESC, contributor) AS k FROM s), l AS (SELECT recipient, sum(total) AS listed FROM t WHERE k <= 10 GROUP BY 1)
SELECT recipient, CAST(support AS DOUBLE) AS support, CAST(coalesce(listed, 0) AS DOUBLE) AS listed, coalesce(listed, 0) <= support AS ok FROM r LEFT JOIN l USING (recipient)""",
    "committee_map_union": """WITH o AS (SELECT o_custkey AS committee, o_orderstatus AS target FROM orders WHERE o_orderpriority = '1-URGENT')
SELECT committee, target FROM o UNION SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey NOT IN (SELECT committee FROM o)""",
    "contested_keys": "SELECT l_partkey, min(l_suppkey) AS winner, count(DISTINCT l_suppkey) AS owners FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_suppkey) > 1",
    "seat_status": f"""WITH {_ROLLUP}, f AS (SELECT s_nationkey, s_suppkey % 4 AS seat, bool_or(coalesce(oppose > support, false)) AS a, bool_or(coalesce(own > pac, false)) AS b,
  bool_or(coalesce(pac > 0, false)) AS c FROM supplier LEFT JOIN r ON recipient = s_suppkey GROUP BY 1, 2)
SELECT s_nationkey, count(*) AS seats, count(*) FILTER (a) AS researched, count(*) FILTER (NOT a AND b) AS collected, count(*) FILTER (NOT a AND NOT b AND c) AS funded,
  count(*) FILTER (NOT a AND NOT b AND NOT c) AS bare FROM f GROUP BY 1""",
}
