"""Claims and the record they cite: checks with a reason each, what a verdict needs, and what its prose must not hold."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Statuses and the direction that they need; what a vote says by a bill's effect; kinds of records.
STATUS_NEEDS = {"completed": "supports", "in_progress": "supports", "broken": "contradicts"}
UNEVIDENCED = ("pending", "unverifiable")
CONTEXT_KINDS = ("donation", "lobbying_filing")
DIRECTIONS = ("supports", "contradicts", "contextual")
BY_EFFECT = {("yea", "advances"): "supports", ("yea", "reverses"): "contradicts", ("nay", "advances"): "contradicts", ("nay", "reverses"): "supports"}
CONTESTED = {
    "Abortion": ["abortion", "reproductive rights", "reproductive_choice"],
    "Sex and reproductive health": ["abortion", "reproductive rights", "reproductive_choice"],
    "Sex, gender, sexual orientation discrimination": ["lgbtq", "lgbtq_rights", "civil_rights", "equality", "gender_equality", "womens_rights"],
    "Religion": [],
    "Firearms and explosives": ["guns", "gun_violence", "gun violence", "gun_safety"],
    "Immigration status and procedures": ["immigration", "border_security", "border"],
    "Racial and ethnic relations": ["civil_rights", "racial_justice"],
}
BILL_IN_PROSE = r"(?i)\b(?:H\.?\s?R\.?|S\.?|HJ\s?RES|HR|HRES|SRES)[\s.-]?(\d{3,})\b"
SCRATCHPAD = (
    r"(?i)(wait,|let me re-?check|let me re-?evaluate|let'?s say|on second thought|I need to reconsider|re-?reading:|hmm\b|actually,\s+(?:I|let))"
)
MAX_PROSE = 1200
CLAIM = ("evaluation", "kind", "record", "direction")


def direction(position: Column, effect: Column) -> Column:
    """What a vote says about a promise; anything unclear is context."""
    cases = [(position == p) & (effect == e) for p, e in BY_EFFECT]
    out = F.lit("contextual")
    for case, value in zip(cases, BY_EFFECT.values(), strict=True):
        out = F.when(case, value).otherwise(out)
    return out


def contested_block(subjects: Column, topic: Column, rules: dict[str, list[str]] = CONTESTED) -> Column:
    """The first subject, by name, that the promise's topic may not be judged by; null if there is none."""
    t = F.lower(F.trim(F.coalesce(topic, F.lit(""))))
    bars = lambda s: reduce(Column.__or__, [(s == k) & (~t.isin(v) if v else F.lit(True)) for k, v in rules.items()])
    return F.get(F.filter(F.array_sort(F.coalesce(subjects, F.array().cast("array<string>"))), bars), 0)


def distinct_claims(claims: DataFrame, order: str) -> DataFrame:
    """Claims without repeats of (evaluation, kind, record, direction); the first by `order` stays."""
    w = Window.partitionBy(*CLAIM).orderBy(order)
    return claims.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def without_repeats(claims: DataFrame) -> DataFrame:
    """One row of each (evaluation, kind, record, direction), the least by its other columns, whatever the order of the rows."""
    rest = [c for c in claims.columns if c not in CLAIM]
    if not rest:
        return claims.distinct()
    # dealt by claim first: a partial minimum of structs would sort all rows once more, beside the sorts of the join that made them
    first = claims.repartition(*CLAIM).groupBy(*CLAIM).agg(F.min(F.struct(*rest)).alias("__first"))
    return first.select(*[F.col(c) if c in CLAIM else F.col(f"__first.{c}").alias(c) for c in claims.columns])


def check_claims(claims: DataFrame, facts: DataFrame, offered: DataFrame | None = None, contested: dict[str, list[str]] = CONTESTED) -> DataFrame:
    """claims with reason (ok or the first rule broken) and accepted.

    claims: evaluation, member, topic, kind, record, direction, claimed. facts: record, member, position, omnibus,
    procedural, subjects. offered (evaluation, record): what the model was shown; None leaves that check out, as a later
    audit does, and with it the claimed position. Repeats of a citation count once: a vote that is cited three times is no
    three pieces of evidence.
    """
    claims = without_repeats(claims)
    f = facts.select("record", F.col("member").alias("f_member"), F.col("position").alias("f_position"), "omnibus", "procedural", F.col("subjects").alias("f_subjects"), F.lit(True).alias("f_known"))
    df = claims.join(f, "record", "left")
    d, kind = F.col("direction"), F.col("kind")
    firm = d != "contextual"
    ladder = (
        F.when(d.isNull() | ~d.isin(*DIRECTIONS), "bad_direction")
        .when(kind.isin(*CONTEXT_KINDS) & firm, F.concat(kind, F.lit("_not_contextual")))
        .when(kind.isin(*CONTEXT_KINDS), "kind_not_validatable_yet")
        .when(kind.isNull() | (kind != "vote"), "unsupported_kind")
        .when(F.col("f_known").isNull(), "unknown_record")
        .when(~F.col("f_member").eqNullSafe(F.col("member")), "wrong_politician")
    )
    if offered is not None:
        df = df.join(offered.select("evaluation", "record", F.lit(True).alias("shown")).distinct(), ["evaluation", "record"], "left")
        ladder = ladder.when(F.col("shown").isNull(), "not_offered").when(F.col("claimed").isNotNull() & ~F.col("claimed").eqNullSafe(F.col("f_position")), "position_mismatch")
    ladder = (
        ladder.when(F.col("omnibus") & firm, "omnibus_not_contextual")
        .when(F.col("procedural") & firm, "procedural_not_contextual")
        .when(firm & contested_block(F.col("f_subjects"), F.col("topic"), contested).isNotNull(), "contested_subject_not_contextual")
        .otherwise("ok")
    )
    return df.withColumn("reason", ladder).withColumn("accepted", F.col("reason") == "ok").select(*claims.columns, "reason", "accepted")


def status_support(evaluations: DataFrame, checks: DataFrame) -> DataFrame:
    """evaluations (evaluation, status) with verdict: ok, or why the status does not agree with the checked claims."""
    sums = checks.groupBy("evaluation").agg(
        F.count("*").alias("cited"), F.count_if("accepted").alias("good"),
        *[F.count_if(F.col("accepted") & (F.col("direction") == d)).alias(d) for d in ("supports", "contradicts")],
    )
    df = evaluations.join(sums, "evaluation", "left").fillna(0, ["cited", "good", "supports", "contradicts"])
    s = F.col("status")
    verdict = F.when(s.isin(*UNEVIDENCED), F.when(F.col("cited") > 0, "unevidenced_status_with_citations").otherwise("ok"))
    verdict = verdict.when(s.isNull() | ~s.isin(*STATUS_NEEDS), "unknown_status").when(F.col("good") == 0, "no_valid_evidence")
    for status, need in STATUS_NEEDS.items():
        verdict = verdict.when((s == status) & (F.col(need) == 0), f"no_{need}_evidence")
    return df.withColumn("verdict", verdict.otherwise("ok")).select(*evaluations.columns, "cited", "good", "verdict")


def prose_defects(prose: Column, cited_keys: Column) -> Column:
    """Defects of a verdict's prose, in order; the first bad bill number ends the search for more."""
    t = F.coalesce(prose, F.lit(""))
    cited = F.transform(F.coalesce(cited_keys, F.array().cast("array<string>")), lambda k: F.element_at(F.split(k, "-"), -1))
    numbers = F.transform(F.regexp_extract_all(t, F.lit(BILL_IN_PROSE), F.lit(1)), lambda n: F.regexp_replace(n, "^0+", ""))
    bad = lambda n: F.when(F.length(n) >= 5, "impossible_bill_number").when((F.size(cited) > 0) & ~F.array_contains(cited, n), "uncited_bill_reference")
    first = F.get(F.filter(F.transform(numbers, bad), lambda x: x.isNotNull()), 0)
    found = F.array_compact(F.array(F.when(F.length(t) > MAX_PROSE, "overlong"), F.when(t.rlike(SCRATCHPAD), "scratchpad"), first))
    return F.when(~t.rlike(r"(?U)\S"), F.array(F.lit("empty"))).otherwise(found)


def route(checks: DataFrame, storable: tuple[str, ...] = ("ok", "omnibus_not_contextual", "procedural_not_contextual", "contested_subject_not_contextual", "position_mismatch", "wrong_politician", "not_offered")) -> DataFrame:
    """checks with target: evidence (a row that can refer to its record) or rejects."""
    return checks.withColumn("target", F.when((F.col("kind") == "vote") & F.col("reason").isin(*storable), "evidence").otherwise("rejects"))


def revalidate(evidence: DataFrame, facts: DataFrame, contested: dict[str, list[str]] = CONTESTED) -> DataFrame:
    """Stored evidence (with validated) against today's facts; checks only tighten: flipped where it was valid and is not.
    Stored repeats count once (without_repeats)."""
    was = F.coalesce("validated", F.lit(False))
    checked = check_claims(evidence.withColumn("validated", was), facts, contested=contested)
    return checked.withColumn("flipped", was & ~F.col("accepted")).withColumn("valid", was & F.col("accepted"))


def changed_keys(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Keys whose rows differ between two versions of a table, were added or went. Rows are compared by a digest of all
    columns in the order of their names; of repeated keys the digests are summed."""
    columns = sorted(c for c in new.columns if c != key)
    digest = F.sum(F.xxhash64(*[F.to_json(F.struct(c)) for c in columns]).cast("decimal(20, 0)")).alias("digest")
    o, n = (df.groupBy(key).agg(digest) for df in (old, new))
    both = o.withColumnRenamed("digest", "before").join(n.withColumnRenamed("digest", "after"), key, "full_outer")
    return both.where(~F.col("before").eqNullSafe(F.col("after"))).select(key)


def revalidate_changed(evidence: DataFrame, before: DataFrame, old: DataFrame, new: DataFrame, contested: dict[str, list[str]] = CONTESTED) -> tuple[DataFrame, DataFrame]:
    """(evidence as revalidate(evidence, new) gives it, evaluations that were touched), from `before`, which is
    revalidate(evidence, old): only evidence whose record changed between the two versions of the facts is checked again."""
    changed = changed_keys(old, new, "record")
    only = lambda df, how: df.join(changed, "record", how).select(*df.columns)
    again = revalidate(only(evidence, "left_semi"), only(new, "left_semi"), contested)
    rest = only(before, "left_anti")
    return rest.unionByName(again), again.select("evaluation").distinct()


def exportable_promises(promises: DataFrame, junk: DataFrame) -> DataFrame:
    """Verified, not reviewed as junk, and not dropped by the gate (unscreened counts as kept)."""
    return promises.where(F.col("verified") & F.coalesce("gate_keep", F.lit(True))).join(junk.select("promise"), "promise", "left_anti")


def exportable_evaluations(evaluations: DataFrame, evidence: DataFrame) -> DataFrame:
    """Current, with evidence of which none is unvalidated; `broken` only when signed."""
    sums = evidence.groupBy("evaluation").agg(F.min(F.coalesce("validated", F.lit(False))).alias("all_valid"))
    return evaluations.join(sums, "evaluation").where(F.col("is_current") & F.col("all_valid") & ((F.col("status") != "broken") | F.col("reviewed_by").isNotNull())).drop("all_valid")
