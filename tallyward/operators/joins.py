"""Joins by key, by array membership, by topic, by overlapping spans, by name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PIECES = 4096  # pieces of a run that are numbered at once
STEP = 3  # spans of so many neighbouring levels share the cells of the highest


def flag_known(df: DataFrame, known: DataFrame, on: str, name: str) -> DataFrame:
    """df with a boolean column: whether the key is in `known` (distinct keys)."""
    return df.join(known.select(on).distinct().withColumn("__k", F.lit(True)), on, "left").withColumn(name, F.col("__k").isNotNull()).drop("__k")


def array_member_join(df: DataFrame, arrays: DataFrame, value: str, array: str) -> DataFrame:
    """df joined to rows of `arrays` whose array holds df's value; the array is exploded, so that the join is on equality."""
    return df.join(arrays.withColumn("__e", F.explode(F.array_distinct(array))), F.col(value) == F.col("__e")).drop("__e")


def resolve_alias(filters: DataFrame, topic: str = "topic", canonical: str = "canonical_topic") -> DataFrame:
    """Each topic with the areas and subjects of the topic that it stands for (one level; its own if it is no alias)."""
    base = filters.select(F.col(topic).alias("__t"), F.col("areas").alias("__a"), F.col("subjects").alias("__s"))
    return (
        filters.join(base, F.col(canonical) == F.col("__t"), "left")
        .select(topic, F.coalesce("__a", "areas").alias("areas"), F.coalesce("__s", "subjects").alias("subjects"))
    )


def topic_bills(filters: DataFrame, bills: DataFrame) -> DataFrame:
    """(topic, bill) where the bill's area is among the topic's areas or a subject among its subjects.

    Both kinds of terms become rows, so the theta join turns into one equality join on (kind, term).
    """
    terms = filters.select("topic", F.explode(F.concat(F.transform(F.coalesce("areas", F.array()), lambda x: F.concat(F.lit("a:"), x)), F.transform(F.coalesce("subjects", F.array()), lambda x: F.concat(F.lit("s:"), x)))).alias("term"))
    held = bills.select("bill", F.explode(F.concat(F.array(F.concat(F.lit("a:"), "area")), F.transform("subjects", lambda x: F.concat(F.lit("s:"), x)))).alias("term"))
    return held.join(terms, "term").select("topic", "bill").distinct()


def _level(start: Column, end: Column) -> Column:
    """The smallest multiple l of STEP with 2**l at least the span's length."""
    least = F.length(F.bin(F.greatest(end - start, F.lit(1)).cast("long") - 1)) - F.when(end - start <= 1, 1).otherwise(0)
    return (F.ceil(least / STEP) * STEP).cast("int")


def overlapping(a: DataFrame, b: DataFrame, key: str, share: float = 0.5) -> DataFrame:
    """Pairs of spans (start, end) of one key that overlap by at least `share` of the shorter one: key, a_id, b_id, chars.

    a and b: key, id, start, end. Cells are 2**level long, levels the multiples of STEP. A span lies in two cells at most of its
    own level, the smallest whose cells are no shorter than it is. A pair meets at the level of its longer span, in the first cell that both touch:
    so each span is a row for its own cells, and looks into two cells at most of each level from its own on that the other
    side has. Spans of any length cost ten rows or so; empty and null spans overlap with nothing.
    """
    def cells(df: DataFrame, side: str) -> DataFrame:
        return df.withColumn("cell", F.explode(F.sequence(F.expr(f"shiftright({side}_start, level)"), F.expr(f"shiftright({side}_end - 1, level)"))))

    spans, levels = {}, {}
    for side, df in (("a", a), ("b", b)):
        lo, hi = F.col("start").cast("long"), F.col("end").cast("long")
        df = df.where(lo < hi).select(key, F.col("id").alias(f"{side}_id"), lo.alias(f"{side}_start"), hi.alias(f"{side}_end"), _level(lo, hi).alias(f"{side}_level"))
        spans[side] = df
        levels[side] = sorted(r[0] for r in df.select(f"{side}_level").distinct().collect())  # 22 at most

    def met(own: str, guest: str, equal: bool) -> DataFrame:
        """own's cells at its level, and guest's at that level: guest is no longer (equal) or shorter."""
        at = F.array(*[F.lit(x) for x in levels[own]]) if levels[own] else F.array().cast("array<int>")
        home = cells(spans[own].withColumn("level", F.col(f"{own}_level")), own)
        fits = (lambda x: x >= F.col(f"{guest}_level")) if equal else (lambda x: x > F.col(f"{guest}_level"))
        visits = cells(spans[guest].withColumn("level", F.explode(F.filter(at, fits))), guest)
        return home.join(visits, [key, "level", "cell"])

    chars = F.least("a_end", "b_end") - F.greatest("a_start", "b_start")
    shorter = F.least(F.col("a_end") - F.col("a_start"), F.col("b_end") - F.col("b_start"))
    first = F.col("cell") == F.expr("shiftright(greatest(a_start, b_start), level)")
    columns = [key, "a_id", "b_id", chars.alias("chars")]
    both = [met("a", "b", True), met("b", "a", False)]
    return both[0].where(first & (chars > 0) & (chars >= shorter * share)).select(columns).unionByName(both[1].where(first & (chars > 0) & (chars >= shorter * share)).select(columns))


def overlapping_pieces(runs: DataFrame, b: DataFrame, key: str, share: float = 0.5) -> DataFrame:
    """As overlapping(), for stretches that are cut into pieces of one size from their start on, of which the last may be shorter:
    key, a_id, piece (from 0), b_id, chars. runs: key, id, start, end, size; b: key, id, start, end.

    The pieces that a span touches follow from its place, so that they become rows after the join only: what is shuffled are
    the runs and the spans. Pieces are numbered in blocks of PIECES, so that no array grows with a span. A run meets all spans
    of its key; empty and null ones overlap with nothing, a run without a size above 0 has no pieces.
    """
    def sides(df: DataFrame, side: str, *more: str) -> DataFrame:
        lo, hi = F.col("start").cast("long"), F.col("end").cast("long")
        return df.where(lo < hi).select(key, F.col("id").alias(f"{side}_id"), lo.alias(f"{side}_start"), hi.alias(f"{side}_end"), *[F.col(c).cast("long").alias(c) for c in more])

    met = sides(runs, "a", "size").where("size > 0").join(sides(b, "b"), key).where("a_start < b_end and b_start < a_end")
    met = met.withColumn("first", F.expr("(greatest(a_start, b_start) - a_start) div size")).withColumn("last", F.expr("(least(a_end, b_end) - 1 - a_start) div size"))
    met = met.withColumn("block", F.explode(F.sequence(F.expr(f"first div {PIECES}"), F.expr(f"last div {PIECES}"))))
    met = met.withColumn("piece", F.explode(F.sequence(F.greatest("first", F.col("block") * PIECES), F.least("last", F.col("block") * PIECES + PIECES - 1))))
    start = F.col("a_start") + F.col("piece") * F.col("size")
    met = met.withColumn("p_start", start).withColumn("p_end", F.least(start + F.col("size"), "a_end"))
    chars = F.least("p_end", "b_end") - F.greatest("p_start", "b_start")
    shorter = F.least(F.col("p_end") - F.col("p_start"), F.col("b_end") - F.col("b_start"))
    return met.where(chars >= shorter * share).select(key, "a_id", "piece", "b_id", chars.alias("chars"))


def span_outcomes(found: DataFrame, gold: DataFrame, key: str, share: float, wanted: str = "wanted") -> DataFrame:
    """Labelled and found spans by what became of them: key, id, outcome.

    A gold span that a found one overlaps is retained if `wanted`, else leaked; a found span that overlaps no gold one is
    novel. found and gold: key, id, start, end; ids are unique within their key.
    """
    hits = overlapping(gold, found, key, share)
    matched = gold.join(hits.select(key, F.col("a_id").alias("id")), [key, "id"], "left_semi").select(key, "id", F.when(F.col(wanted), "retained").otherwise("leaked").alias("outcome"))
    novel = found.join(hits.select(key, F.col("b_id").alias("id")), [key, "id"], "left_anti").select(key, "id", F.lit("novel").alias("outcome"))
    return matched.unionByName(novel)


def by_name(names: DataFrame, people: DataFrame) -> DataFrame:
    """For each `name`: the person of exactly that name, else of that name in any case, if there is just one.

    Rows: name, person, outcome (exact, folded, ambiguous, unknown). people: person, name.
    """
    p = people.select("person", F.col("name").alias("p_name"), F.lower("name").alias("folded"))
    hit = names.select("name").distinct().withColumn("folded", F.lower("name")).join(p, "folded", "left")
    exact = F.col("p_name") == F.col("name")
    got = hit.groupBy("name").agg(F.count_if(exact).alias("ne"), F.count("person").alias("nf"), F.min(F.when(exact, F.col("person"))).alias("e"), F.min("person").alias("f"))
    outcome = F.when(F.col("ne") == 1, "exact").when((F.col("ne") == 0) & (F.col("nf") == 1), "folded").when(F.col("nf") == 0, "unknown").otherwise("ambiguous")
    return got.select("name", F.when(outcome == "exact", F.col("e")).when(outcome == "folded", F.col("f")).alias("person"), outcome.alias("outcome"))


def optional_filter(df: DataFrame, **wanted) -> DataFrame:
    """Keep rows that equal each parameter that is given; None and 'ALL' ask for nothing."""
    for column, value in wanted.items():
        if value is not None and value != "ALL":
            df = df.where(F.col(column) == value)
    return df


def stale(df: DataFrame, stamps: dict[str, str]) -> Column:
    """Whether any stamp column differs from the current version (null counts as different)."""
    out = F.lit(False)
    for column, now in stamps.items():
        out |= ~F.col(column).eqNullSafe(F.lit(now))
    return out
