"""What is evaluated next, what an evaluation stores, and what a later audit takes back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .evidence import CONTESTED, UNEVIDENCED, check_claims, exportable_evaluations, status_support

# Review verdicts that rule a promise out, the score of an evidenced status without one, and a prompt's words.
RULED_OUT = ("opinion", "fragment", "not_a_promise")
NO_SCORE = 50
NO_VOTES = "No roll-call votes related to this topic were found in the legislator's record for this Congress."
SUMMARY_CHARS = 400
OMNIBUS = " [OMNIBUS: bundles many unrelated provisions]"
PROCEDURAL = " [PROCEDURAL: a vote on process, not policy]"
NO_SUMMARY = "(no summary available; judge the title with caution)"


def eligible_promises(promises: DataFrame, reviews: DataFrame, evaluations: DataFrame, votes: DataFrame, model: str, version: str) -> DataFrame:
    """Promises to evaluate: verified, scoreable, kept by the gate (unscreened ones wait), not ruled out by a review, without
    a current evaluation of this model and prompt version, of a member with votes.

    promises: promise, member, verified, scoreable, gate_keep. reviews: promise, verdict. evaluations: promise, is_current,
    model, version. votes: member. Nulls among the flags count as no.
    """
    done = evaluations.where(F.col("is_current") & (F.col("model") == model) & (F.col("version") == version)).select("promise")
    return (
        promises.where(F.col("verified") & F.col("scoreable") & F.col("gate_keep"))
        .join(reviews.where(F.col("verdict").isin(*RULED_OUT)).select("promise"), "promise", "left_anti")
        .join(done, "promise", "left_anti")
        .join(votes.select("member").distinct(), "member", "left_semi")
    )


def pending_members(eligible: DataFrame, people: DataFrame) -> DataFrame:
    """(member, name, pending) of members with promises to evaluate. people: member, name."""
    return eligible.groupBy("member").agg(F.count("*").alias("pending")).join(people.select("member", "name"), "member").select("member", "name", "pending")


def render_votes(votes: DataFrame, by: list[str], limit: int = SUMMARY_CHARS) -> DataFrame:
    """(by, prompt): the votes of a promise as the model reads them, by rank.

    votes: by, rank, vote_id, bill_key, position, question, day, omnibus, procedural, title, summary. A summary above `limit`
    characters ends before the word that the limit cuts. Groups hold a ranked cut of votes.
    """
    text = F.regexp_replace(F.coalesce("summary", F.lit("")), r"(?U)^\s+|\s+\z", "")
    short = F.concat(F.regexp_replace(F.substr(text, F.lit(1), F.lit(limit)), r" [^ ]*\z", ""), F.lit("..."))
    does = F.when(text == "", NO_SUMMARY).when(F.length(text) > limit, short).otherwise(text)
    flags = F.concat(F.when(F.col("omnibus"), OMNIBUS).otherwise(""), F.when(F.col("procedural"), PROCEDURAL).otherwise(""))
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    block = F.concat(
        F.lit("[vote_id: "), said("vote_id"), F.lit("] "), said("bill_key"), F.lit(" | voted "), said("position"), F.lit(" on '"), said("question"), F.lit("' | "), said("day"), flags,
        F.lit("\n    TITLE: "), F.coalesce(F.nullif("title", F.lit("")), F.lit("(untitled)")), F.lit("\n    WHAT IT DOES: "), does,
    )
    rows = votes.select(*by, F.struct("rank", block.alias("block")).alias("r")).groupBy(*by).agg(F.array_sort(F.collect_list("r")).alias("r"))
    return rows.select(*by, F.array_join(F.transform("r", lambda x: x["block"]), "\n").alias("prompt"))


def stored_evaluations(results: DataFrame, checks: DataFrame, related: DataFrame) -> DataFrame:
    """Rows to append: promise, status, score, reasoning, is_current, note.

    results: promise, evaluation, status, score, reasoning, defects (array). checks: claims of check_claims(), by evaluation.
    related: promise, for promises that have votes on their topic. A promise without any is stored as pending (no_related_votes).
    The score of an unevidenced status is dropped; an evidenced status without one gets NO_SCORE and is not current. Current
    is what is supported, with no rejected claim and no defect in its prose.
    """
    judged = status_support(results.select("evaluation", "status"), checks).select("evaluation", F.col("verdict").alias("__verdict"), (F.col("cited") > F.col("good")).alias("__rejected"))
    df = results.join(judged, "evaluation", "left").join(related.select("promise").distinct().withColumn("__related", F.lit(True)), "promise", "left")
    bare, alone = F.coalesce(F.col("status").isin(*UNEVIDENCED), F.lit(False)), F.col("__related").isNull()
    sound = (F.col("__verdict") == "ok") & ~F.col("__rejected") & (F.coalesce(F.size("defects"), F.lit(0)) <= 0)
    lacks = ~bare & F.col("score").isNull()
    return df.select(
        "promise", F.when(alone, "pending").otherwise(F.col("status")).alias("status"),
        F.when(alone | bare, F.lit(None)).otherwise(F.coalesce("score", F.lit(NO_SCORE))).cast("int").alias("score"),
        F.when(alone, NO_VOTES).otherwise(F.col("reasoning")).alias("reasoning"), F.coalesce(alone | (sound & ~lacks), F.lit(False)).alias("is_current"),
        F.when(alone, "no_related_votes").when(bare & F.col("score").isNotNull(), "score_dropped_for_unevidenced_status").when(lacks, "missing_score_for_evidenced_status").alias("note"),
    )


def evidence_rows(checks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(evidence, rejects) of routed claims (route()): evidence with the one id column of its kind set and validated, and what
    no row could refer to, with its reason."""
    of = lambda kind, name: F.when(F.col("kind") == kind, F.col("record")).alias(name)
    ids = [of("vote", "vote_id"), of("donation", "donation_id"), of("lobbying_filing", "filing_id"), of("document", "document_id")]
    good = checks.where("target = 'evidence'").select("evaluation", "kind", *ids, "direction", F.col("accepted").alias("validated"))
    return good, checks.where("target = 'rejects'").select("evaluation", "kind", F.col("record").alias("cited_record"), "direction", "reason")


def audit(evaluations: DataFrame, evidence: DataFrame, facts: DataFrame, contested: dict[str, list[str]] = CONTESTED) -> tuple[DataFrame, DataFrame]:
    """(evidence with reason, valid, flipped; evaluations with demoted and is_current as it is from now on).

    evaluations: evaluation, status, is_current. evidence: evaluation, member, topic, kind, record, direction, claimed,
    validated. valid is what today's facts say, flipped where that differs from validated. A current evaluation is demoted if
    its status is no longer supported or any of its claims is not accepted; none is promoted. Evaluations without evidence
    are left alone.
    """
    checked = check_claims(evidence, facts, contested=contested)
    checked = checked.withColumn("valid", F.col("accepted")).withColumn("flipped", F.coalesce("validated", F.lit(False)) != F.col("accepted"))
    support = status_support(evaluations.select("evaluation", "status"), checked).where("cited > 0")
    bad = support.where("verdict != 'ok' or good < cited").select("evaluation", F.lit(True).alias("__bad"))
    df = evaluations.join(bad, "evaluation", "left").withColumn("demoted", F.coalesce(F.col("is_current") & F.col("__bad"), F.lit(False)))
    return checked, df.withColumn("is_current", F.col("is_current") & ~F.col("demoted")).drop("__bad")


def record_reviews(evaluations: DataFrame, reviews: DataFrame) -> DataFrame:
    """evaluations with reviewed_by, and is_current withdrawn where the review rejects. reviews: evaluation, reviewer, approved."""
    df = evaluations.drop("reviewed_by").join(reviews.select("evaluation", F.col("reviewer").alias("reviewed_by"), F.col("approved").alias("__ok")), "evaluation", "left")
    return df.withColumn("is_current", F.col("is_current") & F.coalesce("__ok", F.lit(True))).drop("__ok")


def evaluation_summary(evaluations: DataFrame, evidence: DataFrame) -> DataFrame:
    """By version, model and status: evaluations, current and exportable ones, and the share of current that is exportable."""
    out = exportable_evaluations(evaluations, evidence).select("evaluation", F.lit(True).alias("__out")).distinct()
    sums = evaluations.join(out, "evaluation", "left").groupBy("version", "model", "status").agg(
        F.count("*").alias("evaluations"), F.count_if("is_current").alias("current"), F.count("__out").alias("exportable")
    )
    return sums.withColumn("pct", F.round(F.when(F.col("current") > 0, 100 * F.col("exportable") / F.col("current")), 2))


def fetch_outcome(stored: Column, fetched: Column, allowed: Column) -> Column:
    """What became of reading a site, from its counts."""
    return F.when(~allowed, "robots_disallowed").when(stored > 0, "documents_stored").when(fetched > 0, "no_content").otherwise("unreachable")


def discovery_outcome(usable: Column, others: Column) -> Column:
    """What became of looking for a candidate's website."""
    return F.when(usable > 0, "candidates_with_website").when(others > 0, "social_or_donation_only").otherwise("no_website_declared")


def holdings(documents: DataFrame, by: str, waiting: Column) -> DataFrame:
    """(by, documents, pending): documents held, and those not read yet."""
    return documents.groupBy(by).agg(F.count("*").alias("documents"), F.count_if(F.coalesce(waiting, F.lit(False))).alias("pending"))


def roster(listed: DataFrame, known: DataFrame, on_ballot: DataFrame | None = None) -> DataFrame:
    """Listed people (key, url) with a URL, whose key is known (key, person), and who stand for office where that is asked."""
    df = listed.where(F.col("url").isNotNull() & (F.trim("url") != "")).join(known.where("key is not null").select("key", "person"), "key")
    return df if on_ballot is None else df.join(on_ballot.select("key").distinct(), "key", "left_semi")


def work_state(people: DataFrame, harvested: DataFrame, promises: DataFrame) -> DataFrame:
    """people (person) with state: gap (documents but no promise), done (both) or open (no documents yet)."""
    mark = lambda df, name: df.select("person").distinct().withColumn(name, F.lit(True))
    df = people.join(mark(harvested, "__h"), "person", "left").join(mark(promises, "__p"), "person", "left")
    return df.withColumn("state", F.when(F.col("__h").isNull(), "open").when(F.col("__p").isNull(), "gap").otherwise("done")).drop("__h", "__p")


def relevant(items: DataFrame, needle: Column, fields: list[str], key: str, order: list[Column]) -> DataFrame:
    """The first row of each key by `order`, where the needle stands, in any case, in the fields joined by blanks; the first
    row counts whether it is relevant or not. Null and empty keys go."""
    joined = F.lower(F.concat_ws(" ", *[F.coalesce(F.col(f).cast("string"), F.lit("")) for f in fields]))
    rest = [c for c in items.columns if c != key]
    first = items.where(F.col(key).isNotNull() & (F.col(key).cast("string") != "")).withColumn("__hit", F.contains(joined, F.lower(needle)))
    first = first.groupBy(key).agg(F.min_by(F.struct("__hit", *rest), F.struct(*order)).alias("r"))
    return first.where("r.__hit").select(*[F.col(c) if c == key else F.col(f"r.{c}").alias(c) for c in items.columns])
