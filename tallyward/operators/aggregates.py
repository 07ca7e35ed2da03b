"""Grouped sums with conditions, ranked groups, and checks that reconcile them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def filtered_sums(df: DataFrame, keys: list[str], sums: dict[str, tuple[str, Column | None]], counts: dict[str, Column] | None = None) -> DataFrame:
    """One pass of grouped conditional sums (name -> (column, condition)) and counts (name -> condition); no match: 0."""
    aggs = [F.coalesce(F.sum(F.col(c) if cond is None else F.when(cond, F.col(c))), F.lit(0)).alias(name) for name, (c, cond) in sums.items()]
    aggs += [F.count(F.when(cond, 1)).alias(name) for name, cond in (counts or {}).items()]
    return df.groupBy(*keys).agg(*aggs)


def top_n(df: DataFrame, by: list[str], order: list[Column], n: int, rank: str = "rank") -> DataFrame:
    """The first n rows of each group with their place. The order must be total for a defined result. Catalyst cuts each
    task's rows to n a group before the shuffle."""
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col(rank) <= n)


def top_sums(df: DataFrame, by: list[str], item: str, amount: str, n: int, positive: bool = False) -> DataFrame:
    """Per group the n items with the largest sums: by, item, total, n_rows, rank. Ties go to the smaller item."""
    sums = df.groupBy(*by, item).agg(F.sum(amount).alias("total"), F.count("*").alias("n_rows"))
    if positive:
        sums = sums.where("total > 0")
    return top_n(sums, by, [F.desc("total"), F.asc(item)], n)


def first_by(df: DataFrame, by: list[str], order: list[Column]) -> DataFrame:
    """The first row of each group by a total order."""
    return top_n(df, by, order, 1, "__first").drop("__first")


def reconcile(headline: DataFrame, parts: DataFrame, keys: list[str], total: str, part: str) -> DataFrame:
    """keys, total, listed (sum of the parts), ok: the parts never exceed the headline."""
    listed = parts.groupBy(*keys).agg(F.sum(part).alias("listed"))
    return headline.select(*keys, total).join(listed, keys, "left").select(
        *keys, total, F.coalesce("listed", F.lit(0)).alias("listed"), (F.coalesce("listed", F.lit(0)) <= F.col(total)).alias("ok")
    )


def key_collisions(df: DataFrame, key: str, owner: str) -> DataFrame:
    """Keys that several owners claim: key, winner (the smallest owner), owners."""
    return df.groupBy(key).agg(F.min(owner).alias("winner"), F.count_distinct(owner).alias("owners")).where("owners > 1")


def ordered_list(df: DataFrame, by: list[str], order: str, columns: list[str], name: str) -> DataFrame:
    """The rows of each group as an array of structs, in order; groups are bounded by their subject (turns of one talk)."""
    return df.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct(order, *columns))).alias(name))


def procedure_scores(df: DataFrame, truth: str, decisions: dict[str, str], by: list[str] | None = None) -> DataFrame:
    """Confusion counts, precision and retention of keep/drop procedures (name -> boolean column), in one pass.

    truth: boolean, whether a row should be kept. Rows: procedure, tp, fp, fn, tn, precision, retention.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("procedure"), F.col(c).alias("keep")) for n, c in decisions.items()]))
    rows = df.select(*(by or []), F.col(truth).alias("truth"), pairs.alias("p")).select(*(by or []), "truth", "p.procedure", "p.keep")
    n = lambda keep, truth: F.count_if((F.col("keep") == keep) & (F.col("truth") == truth))
    out = rows.groupBy(*(by or []), "procedure").agg(n(True, True).alias("tp"), n(True, False).alias("fp"), n(False, True).alias("fn"), n(False, False).alias("tn"))
    return out.withColumns(
        {
            "precision": F.round(F.when(F.col("tp") + F.col("fp") > 0, F.col("tp") / (F.col("tp") + F.col("fp"))), 4),
            "retention": F.round(F.when(F.col("tp") + F.col("fn") > 0, F.col("tp") / (F.col("tp") + F.col("fn"))), 4),
        }
    )


def vote_report(votes: DataFrame, by: list[str], position: str = "position", at: str = "day", words: tuple[str, ...] = ("yea", "nay", "present", "not_voting")) -> DataFrame:
    """(by, votes_recorded, a count for each word, latest_vote)."""
    return votes.groupBy(*by).agg(F.count("*").alias("votes_recorded"), *[F.count_if(F.col(position) == w).alias(w) for w in words], F.max(at).alias("latest_vote"))


def coverage_totals(candidates: DataFrame, researched: DataFrame, house: str = "house") -> DataFrame:
    """One row: candidates, states, researched (states with a candidate that `researched` names by person), and of the House
    seats (state, district; a null district is one) how many there are and how many have such a candidate.

    candidates: person, state, office, district.
    """
    df = candidates.join(researched.select("person").distinct().withColumn("__hit", F.lit(True)), "person", "left").withColumn("__hit", F.col("__hit").isNotNull())
    seats = df.where(F.col("office") == house).groupBy("state", "district").agg(F.bool_or("__hit").alias("covered"))
    seats = seats.agg(F.count("*").alias("seats"), F.count_if("covered").alias("seats_covered"))
    whole = df.agg(F.count("*").alias("candidates"), F.count_distinct("state").alias("states"), F.count_distinct(F.when(F.col("__hit"), F.col("state"))).alias("researched"))
    return whole.withColumn("__one", F.lit(1)).join(seats.withColumn("__one", F.lit(1)), "__one").drop("__one")  # one row each


def any_member(df: DataFrame, **keys: DataFrame) -> DataFrame:
    """Rows whose value in any of the named columns is among the values of that name in its table. Each table is one semi join,
    as a flag, so that a row is kept once."""
    columns, flags = df.columns, []
    for i, (column, table) in enumerate(keys.items()):
        flags.append(f"__in{i}")
        df = df.join(table.select(column).distinct().withColumn(flags[-1], F.lit(True)), column, "left")
    return df.where(F.coalesce(*[F.col(f) for f in flags], F.lit(False))).select(*columns)
