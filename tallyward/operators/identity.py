"""Records of one person under several ids: pairing by filed name, and the ladder that decides a link."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pair_ids(rows: DataFrame) -> DataFrame:
    """(name, incumbent, other) pairs of a group of equal name, state and party with at least two offices and just one
    incumbent. rows: id, name, state, party, office, incumbent (boolean). Blank keys pair with nothing."""
    key = ["name", "state", "party"]
    clean = rows.select("id", *[F.nullif(F.trim(F.col(k)), F.lit("")).alias(k) for k in key], F.trim("office").alias("office"), F.coalesce("incumbent", F.lit(False)).alias("incumbent")).dropna(subset=key)
    groups = clean.groupBy(*key).agg(F.count_distinct("office").alias("offices"), F.count_if("incumbent").alias("n"), F.min(F.when(F.col("incumbent"), F.col("id"))).alias("inc"))
    groups = groups.where("offices >= 2 and n = 1").select(*key, F.col("inc").alias("incumbent_id"))
    return clean.where(~F.col("incumbent")).join(groups, key).select("name", F.col("incumbent_id").alias("incumbent"), F.col("id").alias("other"))


def decide_links(pairs: DataFrame, candidacies: DataFrame, people: DataFrame, votes: DataFrame, linked: DataFrame) -> DataFrame:
    """pairs with outcome: no_candidacy, already_linked, no_bioguide, no_votes, target_has_votes or linked.

    candidacies: id, person. people: person, bioguide. votes: person (a row a vote). linked: other (ids linked before).
    Vote counts are grouped once and joined, not looked up by pair.
    """
    n = votes.groupBy("person").agg(F.count("*").alias("n"))
    who = candidacies.join(people, "person", "left").join(n, "person", "left")
    side = lambda s: who.select(F.col("id").alias(s), F.col("person").alias(f"{s}_person"), F.col("bioguide").alias(f"{s}_bio"), F.coalesce("n", F.lit(0)).alias(f"{s}_votes"))
    df = pairs.join(side("incumbent"), "incumbent", "left").join(side("other"), "other", "left").join(linked.select("other", F.lit(True).alias("done")).distinct(), "other", "left")
    outcome = (
        F.when(F.col("incumbent_person").isNull() | F.col("other_person").isNull(), "no_candidacy")
        .when(F.col("done").isNotNull() | (F.col("incumbent_person") == F.col("other_person")), "already_linked")
        .when(F.coalesce("incumbent_bio", F.lit("")) == "", "no_bioguide")
        .when(F.col("incumbent_votes") == 0, "no_votes")
        .when(F.col("other_votes") > 0, "target_has_votes")
        .otherwise("linked")
    )
    return df.select(*pairs.columns, outcome.alias("outcome"), F.when(outcome == "linked", F.col("incumbent_person")).alias("person"), F.when(outcome == "linked", F.col("other_person")).alias("superseded"))
