"""From landed rows to typed records: committees, transactions, candidates, seats, and answers of a model."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import blank_to_null, money, month_day_year, seat_district


def committees(raw: DataFrame) -> DataFrame:
    """cmte_id, name (the id where blank), kind, designation, party, state (only of two letters), cand_id."""
    state = F.trim("state")
    return raw.select(
        F.trim("cmte_id").alias("cmte_id"), F.coalesce(blank_to_null(F.col("name")), F.trim("cmte_id")).alias("name"),
        *[blank_to_null(F.col(c)).alias(c) for c in ("kind", "designation", "party", "cand_id")], F.when(F.length(state) == 2, state).alias("state"),
    )


def one_owner(owners: DataFrame, key: str, *rest: str) -> DataFrame:
    """One row a key: its lowest owner, by the columns in their order. Null keys go."""
    return owners.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(*rest)).alias("o")).select(key, "o.*")


def transactions(raw: DataFrame, targets: DataFrame, known: DataFrame, independent: tuple[str, ...] = ("24A", "24E")) -> tuple[DataFrame, DataFrame]:
    """(transactions, rejects with reason) of raw rows of text.

    raw: sub_id, cmte_id, other_id, cand_id, kind, amount, day (MMDDYYYY), name. targets: cand_id, candidacy. Rows of other
    candidates are no_target, unreadable amounts bad_amount; of several candidacies the lowest counts (one_owner). Contributors that no committee is known by become null, and so
    does the recipient of an independent expenditure, which its target never receives.
    """
    k = known.select(F.col("cmte_id").alias("cmte_id"), F.lit(True).alias("known")).distinct()
    df = raw.join(one_owner(targets, "cand_id", "candidacy"), "cand_id", "left").join(k, "cmte_id", "left")
    df = df.withColumns({"value": money(F.col("amount")), "date": month_day_year(F.col("day"))})
    df = df.withColumn("reason", F.when(F.col("candidacy").isNull(), "no_target").when(F.col("value").isNull(), "bad_amount"))
    good = df.where("reason is null").select(
        "sub_id", "candidacy", "kind", F.col("value").alias("amount"), F.col("date").alias("day"), blank_to_null(F.col("name")).alias("contributor"),
        F.when(F.col("known"), F.col("cmte_id")).alias("contributor_id"), F.when(~F.col("kind").isin(*independent), blank_to_null(F.col("other_id"))).alias("recipient_id"),
    )
    return good, df.where("reason is not null").select("sub_id", "reason")


#: Columns of an individual's transaction that are kept as they are but for blanks.
DONOR = ("contributor", "entity", "election", "employer", "occupation", "city", "state", "zip", "image", "memo_code", "memo")


def individual_transactions(raw: DataFrame, committee_map: DataFrame, known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(transactions, rejects with reason) of individuals' gifts to the committees of candidates.

    raw: sub_id, cmte_id (who received it), other_id (who passed it on), kind, amount, day (MMDDYYYY) and DONOR, all text.
    committee_map: cmte_id, cand_id, candidacy; of a committee's several candidates the lowest counts, so that no gift counts
    twice, and aggregates.key_collisions reports them. Gifts to other committees are no_target, unreadable amounts bad_amount. A
    conduit that no committee (known: cmte_id) is known by becomes null; the donor is never a committee.
    """
    k = known.select(F.col("cmte_id").alias("other"), F.lit(True).alias("known")).distinct()
    to = one_owner(committee_map.select(F.col("cmte_id").alias("recipient_id"), "cand_id", "candidacy"), "recipient_id", "cand_id", "candidacy")
    df = raw.withColumns({"recipient_id": F.trim("cmte_id"), "other": F.trim("other_id"), "value": money(F.col("amount")), "date": month_day_year(F.col("day"))})
    df = df.join(to, "recipient_id", "left").join(k, "other", "left")
    df = df.withColumn("reason", F.when(F.col("cand_id").isNull(), "no_target").when(F.col("value").isNull(), "bad_amount"))
    good = df.where("reason is null").select(
        F.trim("sub_id").alias("sub_id"), "recipient_id", "cand_id", "candidacy", F.lit(None).cast("string").alias("contributor_id"),
        F.when(F.col("known"), F.col("other")).alias("conduit_id"), F.col("value").alias("amount"), F.col("date").alias("day"), blank_to_null(F.col("kind")).alias("kind"),
        *[blank_to_null(F.col(c)).alias(c) for c in DONOR],
    )
    return good, df.where("reason is not null").select("sub_id", "reason")


def route_candidates(rows: DataFrame, year: int, seats: DataFrame, senate: DataFrame) -> DataFrame:
    """rows with district, class and skip_reason (null: taken), by the first reason that holds: office, year, territory,
    district, senate, duplicate (of a person in a race the smallest id stays).

    rows: id, person, office, state, district, year. seats: state, seats. senate: state, class.
    """
    df = rows.join(seats, "state", "left").join(senate, "state", "left")
    df = df.withColumn("district", seat_district(F.col("office"), F.col("district"), F.col("seats")))
    reason = (
        F.when(F.col("office").isNull() | ~F.col("office").isin("H", "S"), "office")
        .when(~F.col("year").eqNullSafe(F.lit(year)), "year")
        .when(F.col("seats").isNull(), "territory")
        .when((F.col("office") == "H") & F.col("district").isNull(), "district")
        .when((F.col("office") == "S") & F.col("class").isNull(), "senate")
    )
    df = df.withColumn("class", F.when(F.col("office") == "S", F.col("class"))).withColumn("skip_reason", reason)
    race = ["state", "office", "district", "person"]
    first = df.where("skip_reason is null").groupBy(*race).agg(F.min("id").alias("first_id"))
    joined = df.alias("d").join(first.alias("f"), [F.col(f"d.{c}").eqNullSafe(F.col(f"f.{c}")) for c in race], "left")
    last = F.when(F.col("skip_reason").isNull() & (F.col("id") != F.col("first_id")), "duplicate").otherwise(F.col("skip_reason"))
    return joined.select("d.id", "d.person", "d.office", "d.state", "d.district", "d.class", last.alias("skip_reason"))


def races(seats: DataFrame, senate: DataFrame) -> DataFrame:
    """A row per House seat (00 where a state has one) and per Senate race: office, state, district, class."""
    number = F.explode(F.sequence(F.lit(1), F.col("seats")))
    house = seats.where("seats > 0").select(F.lit("H").alias("office"), "state", "seats", number.alias("n"))
    house = house.select("office", "state", F.when(F.col("seats") == 1, "00").otherwise(F.lpad(F.col("n").cast("string"), 2, "0")).alias("district"), F.lit(None).cast("int").alias("class"))
    return house.unionByName(senate.select(F.lit("S").alias("office"), "state", F.lit(None).cast("string").alias("district"), F.col("class").cast("int").alias("class")))


def counted(rows: DataFrame, reason: Column | str) -> DataFrame:
    """(reason, rows): the counters of a load, from one grouped count; null is `loaded`."""
    c = F.col(reason) if isinstance(reason, str) else reason
    return rows.groupBy(F.coalesce(c, F.lit("loaded")).alias("reason")).agg(F.count("*").alias("rows"))


def ask_model(prompts: DataFrame, model: Callable[[pd.Series], pd.Series], key: str, prompt: str = "prompt") -> DataFrame:
    """key, answer, error: a batch model over prompts. A batch that fails is asked row by row, so that one bad row costs only
    itself; its error is kept as text."""
    kind = prompts.schema[key].dataType.simpleString()

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in it:
            try:
                answers, errors = list(model(batch[prompt])), [None] * len(batch)
            except Exception:
                answers, errors = [], []
                for i in range(len(batch)):
                    try:
                        answers += list(model(batch[prompt].iloc[i : i + 1]))
                        errors.append(None)
                    except Exception as e:  # the row's own failure is its result
                        answers.append(None)
                        errors.append(f"{type(e).__name__}: {e}")
            yield pd.DataFrame({key: batch[key].to_numpy(), "answer": answers, "error": errors})

    return prompts.select(key, prompt).mapInPandas(run, f"`{key}` {kind}, answer string, error string")
