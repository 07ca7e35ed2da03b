"""Evaluations, rosters, individual gifts and bookkeeping as queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..folders import written
from ..operators import evaluations as ev
from ..operators.aggregates import top_n
from ..operators.evidence import check_claims, contested_block, revalidate, revalidate_changed, route
from ..operators.evidence import distinct_claims as first_claims
from ..operators.intake import DONOR, counted, individual_transactions
from ..operators.joins import optional_filter, stale
from ..operators.merge import merge_keyed, refresh, replace_groups
from ..operators.text import reject_log, verify_quotes
from ..sources.readers import read_lines, write_lines
from .tables import BILLS_SQL, DONATIONS_SQL, VOTES_SQL, bills, donations, read, shared_folder, votes

CONTESTED = {"gadget": ["hardware"]}
STATUS = {"1-URGENT": "completed", "2-HIGH": "in_progress", "3-MEDIUM": "broken", "4-NOT SPECIFIED": "pending", "5-LOW": "unverifiable"}


def _status():
    out = F.lit(None).cast("string")
    for k, v in STATUS.items():
        out = F.when(F.col("o_orderpriority") == k, v).otherwise(out)
    return out


def _evaluations(spark, sf_dir):
    """Orders as evaluations and as the promises that they judge."""
    o, k = read(spark, sf_dir, "orders"), F.col("o_custkey")
    return o.select(
        F.col("o_orderkey").alias("evaluation"), F.col("o_orderkey").alias("promise"), k.alias("member"), _status().alias("status"), F.when(F.year("o_orderdate") % 2 == 0, "m1").otherwise("m2").alias("model"),
        F.col("o_orderstatus").alias("version"), (k % 3 != 0).alias("is_current"), F.when(k % 2 == 0, "ann").alias("reviewed_by"), F.when(k % 4 != 0, F.floor(F.col("o_totalprice")) % 100).cast("int").alias("score"),
        (F.col("o_orderstatus") != "P").alias("verified"), (F.col("o_orderpriority") != "5-LOW").alias("scoreable"), F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("o_totalprice") > 50_000).alias("gate_keep"),
    )


def _evidence(spark, sf_dir):
    """Line items as citations of votes (by part number) and donations; one in five names another member."""
    v = votes(spark, sf_dir).select(F.col("vote_id").alias("record"), F.col("member").alias("m"))
    li = read(spark, sf_dir, "lineitem").join(v, F.col("l_partkey") == F.col("record"), "left")
    n = F.col("l_linenumber")
    return li.select(
        F.col("l_orderkey").alias("evaluation"), F.when(F.col("l_suppkey") % 5 == 0, F.col("m") + 1).otherwise(F.col("m")).alias("member"), F.when(n == 2, "hardware").otherwise("other").alias("topic"),
        F.when((F.col("l_returnflag") == "R") & (n == 1), "donation").otherwise("vote").alias("kind"), F.col("l_partkey").alias("record"),
        F.when(F.col("l_linestatus") == "O", "supports").when(n % 2 == 1, "contradicts").otherwise("contextual").alias("direction"), F.lit(None).cast("string").alias("claimed"), (F.col("l_discount") < 0.05).alias("validated"),
    )


def _facts(spark, sf_dir):
    v = votes(spark, sf_dir).join(bills(spark, sf_dir).select("bill", "subjects"), "bill", "left")
    return v.select(F.col("vote_id").alias("record"), "member", "position", F.lit(False).alias("omnibus"), (F.col("position") == "error").alias("procedural"), "subjects")


def _checks(spark, sf_dir):
    return check_claims(_evidence(spark, sf_dir), _facts(spark, sf_dir), contested=CONTESTED)


def _eligible(spark, sf_dir):
    e = _evaluations(spark, sf_dir)
    verdict = F.when((F.col("l_returnflag") == "A") & (F.col("l_linenumber") == 1), "opinion").when((F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 2), "fragment").otherwise("good")
    reviews = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("promise"), verdict.alias("verdict"))
    return ev.eligible_promises(e, reviews, e, votes(spark, sf_dir), "m1", "F")


def eligible_promises(spark, sf_dir):
    return _eligible(spark, sf_dir).select("promise", "member")


def pending_members(spark, sf_dir):
    return ev.pending_members(_eligible(spark, sf_dir), read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("member"), F.col("c_name").alias("name")))


def evaluation_summary(spark, sf_dir):
    return ev.evaluation_summary(_evaluations(spark, sf_dir), _evidence(spark, sf_dir))


def vote_prompts(spark, sf_dir):
    """Each member's 25 latest votes as prompt text; the bills' summaries are whole documents."""
    v = votes(spark, sf_dir).join(bills(spark, sf_dir), "bill")
    v = v.select("member", "vote_id", "bill", F.concat(F.lit("HR-"), "bill").alias("bill_key"), "position", "question", "day", (F.size("subjects") > 2).alias("omnibus"), (F.col("position") == "error").alias("procedural"), F.array_join("subjects", " ").alias("title"))
    latest = top_n(v, ["member"], [F.desc("day"), F.desc("vote_id")], 25)  # before summaries come to the votes, so that no text is sorted with those that go
    summaries = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("bill"), F.col("text").alias("summary"))
    return ev.render_votes(latest.join(summaries, "bill", "left"), ["member"])


def stored_evaluations(spark, sf_dir):
    e = _evaluations(spark, sf_dir)
    results = e.select("promise", "evaluation", "status", "score", F.lit("said").alias("reasoning"), F.when(F.col("member") % 10 == 1, F.array(F.lit("overlong"))).otherwise(F.array().cast("array<string>")).alias("defects"))
    related = e.join(votes(spark, sf_dir).select((F.col("member") * 7).alias("member")).distinct(), "member", "left_semi")
    return ev.stored_evaluations(results, _checks(spark, sf_dir), related).select("promise", "status", "score", "is_current", "note")


def evidence_inserts(spark, sf_dir):
    good, _ = ev.evidence_rows(route(_checks(spark, sf_dir)))
    return good.groupBy("kind", "direction").agg(F.count("*").alias("rows"), F.count("vote_id").alias("votes"), F.count("donation_id").alias("donations"), F.count_if("validated").alias("validated"))


def citation_rejects(spark, sf_dir):
    return ev.evidence_rows(route(_checks(spark, sf_dir)))[1].groupBy("kind", "reason").agg(F.count("*").alias("rows"), F.sum("cited_record").alias("records"))


def audit_evidence(spark, sf_dir):
    checked, _ = ev.audit(_evaluations(spark, sf_dir), _evidence(spark, sf_dir), _facts(spark, sf_dir), CONTESTED)
    return checked.groupBy("reason").agg(F.count("*").alias("rows"), F.count_if("valid").alias("valid"), F.count_if("flipped").alias("flipped"))


def audit_demotions(spark, sf_dir):
    _, after = ev.audit(_evaluations(spark, sf_dir), _evidence(spark, sf_dir), _facts(spark, sf_dir), CONTESTED)
    return after.groupBy("status").agg(F.count("*").alias("evaluations"), F.count_if("demoted").alias("demoted"), F.count_if("is_current").alias("current"))


def audit_changed(spark, sf_dir):
    """The audit of stored evidence after some facts changed, some went and some came, from the audit before: only evidence of
    those records is checked again."""
    path = shared_folder(spark, "audit")
    evidence, new = _evidence(spark, sf_dir), _facts(spark, sf_dir)
    k = F.col("record")
    old = new.where(k % 31 != 0).withColumn("procedural", F.when(k % 17 == 0, ~F.col("procedural")).otherwise(F.col("procedural"))).unionByName(new.where(k % 31 == 0).withColumn("record", -k))
    revalidate(evidence, old, CONTESTED).write.parquet(f"{path}/before")
    after, _ = revalidate_changed(evidence, spark.read.parquet(f"{path}/before"), old, new, CONTESTED)
    return after.groupBy("reason").agg(F.count("*").alias("rows"), F.count_if("valid").alias("valid"), F.count_if("flipped").alias("flipped"), F.count_distinct("evaluation").alias("evaluations"))


def recorded_reviews(spark, sf_dir):
    reviews = read(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("evaluation")).agg(F.min("l_suppkey").cast("string").alias("reviewer"), (F.max("l_quantity") < 45).alias("approved"))
    after = ev.record_reviews(_evaluations(spark, sf_dir), reviews)
    return after.groupBy("status").agg(F.count("reviewed_by").alias("reviewed"), F.count_if("is_current").alias("current"))


def held_documents(spark, sf_dir):
    d = read(spark, sf_dir, "documents").join(read(spark, sf_dir, "labels"), "doc_id", "left")
    return ev.holdings(d, "source", F.col("quality").isNull())


def topic_counts(spark, sf_dir):
    return _evaluations(spark, sf_dir).groupBy("member").agg(F.count_distinct("status").alias("topics"), F.count_if("scoreable").alias("measurable"))


def second_cut(spark, sf_dir):
    """Of each recipient's fifteen largest contributors the first three, in whole units."""
    sums = donations(spark, sf_dir).groupBy("recipient", "contributor").agg(F.sum("amount").alias("total"))
    ranked = top_n(sums, ["recipient"], [F.desc("total"), F.asc("contributor")], 15)
    return ranked.where("rank <= 3").select("recipient", "contributor", "rank", F.round("total", 0).cast("double").alias("total"))


def global_top(spark, sf_dir):
    """The fifty largest orders."""
    return read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(50)


def null_placement(spark, sf_dir):
    """Customers ranked within their nation: balances below nothing are unknown and last, unknown segments first."""
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("balance"), F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"))
    return top_n(c, ["c_nationkey"], [F.desc_nulls_last("balance"), F.asc_nulls_first("segment"), F.asc("c_custkey")], 1 << 30).select("c_custkey", "rank")


def roster(spark, sf_dir):
    k = F.col("c_custkey")
    listed = read(spark, sf_dir, "customer").select(k.alias("key"), F.when(k % 9 != 0, F.concat(F.lit("https://"), "c_name")).when(k % 2 == 0, " ").alias("url"))
    known = read(spark, sf_dir, "customer").where("c_mktsegment != 'BUILDING'").select(k.alias("key"), (k * 10).alias("person"))
    ballot = read(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("key"))
    people = ev.roster(listed, known, ballot)
    harvested = read(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select((F.col("o_custkey") * 10).alias("person"))
    promises = read(spark, sf_dir, "orders").where("o_totalprice > 200000").select((F.col("o_custkey") * 10).alias("person"))
    return ev.work_state(people, harvested, promises).select("key", "person", "url", "state")


def relevant_items(spark, sf_dir):
    """Documents whose first row of a source and length names the word, in any case, in text, language or source."""
    d = read(spark, sf_dir, "documents").withColumn("video", F.concat_ws("-", "source", "n_chars"))
    return ev.relevant(d, F.lit("The"), ["text", "lang", "source"], "video", [F.col("doc_id")]).select("video", "doc_id")


def _individuals(spark, sf_dir):
    k = F.col("l_orderkey")
    raw = read(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", F.lit(" "), "l_orderkey", "l_linenumber", "l_partkey").alias("sub_id"), F.concat(F.lit(" "), "l_suppkey", F.lit(" ")).alias("cmte_id"), F.col("l_partkey").cast("string").alias("other_id"), F.col("l_returnflag").alias("kind"),
        F.when(k % 50 == 0, "??").otherwise(F.col("l_extendedprice").cast("decimal(14,2)").cast("string")).alias("amount"), F.date_format("l_shipdate", "MMddyyyy").alias("day"),
        *[(F.when(F.col("l_linenumber") % 3 == 0, "  ").otherwise(F.concat(F.lit(f" {c} "), "l_linestatus")) if i % 2 else F.lit(None).cast("string")).alias(c) for i, c in enumerate(DONOR)],
    )
    s = read(spark, sf_dir, "supplier").where("s_acctbal > 0").select(F.col("s_suppkey").cast("string").alias("cmte_id"), F.concat(F.lit("S"), "s_suppkey").alias("cand_id"), (F.col("s_suppkey") * 10).alias("candidacy"))
    return individual_transactions(raw, s, read(spark, sf_dir, "part").where("p_size > 10").select(F.col("p_partkey").cast("string").alias("cmte_id")))


def individual_rows(spark, sf_dir):
    good, _ = _individuals(spark, sf_dir)
    return good.groupBy("recipient_id", "cand_id", "candidacy", "kind", "employer").agg(F.count("*").alias("rows"), F.sum("amount").cast("double").alias("amount"), F.count("conduit_id").alias("passed_on"), F.count("contributor_id").alias("from_committees"), F.count("contributor").alias("named"), F.min("day").cast("string").alias("first_day"))


def individual_rejects(spark, sf_dir):
    return counted(_individuals(spark, sf_dir)[1], "reason")


def json_lines(spark, sf_dir):
    """Labels with their documents' texts written as JSON lines and read back, with counts of damaged lines."""
    path = shared_folder(spark, "lines")
    rows = read(spark, sf_dir, "labels").join(read(spark, sf_dir, "documents"), "doc_id").select("doc_id", "text", F.col("quality").cast("int").alias("quality"), F.col("toxic").cast("int").alias("toxic"))
    write_lines(rows, path)
    good, damaged = read_lines(spark, path, "doc_id long, text string, quality int, toxic int")
    got = good.groupBy("quality", "toxic").agg(F.count("*").alias("rows"), F.sum(F.length("text")).alias("chars"))
    return got.crossJoin(damaged.agg(F.count("*").alias("damaged")))  # one row of counts


def quote_rejects(spark, sf_dir):
    """Quotes from the middle of each document, every other one with a word that it lacks; those that are not found are logged."""
    d = read(spark, sf_dir, "documents").where("text is not null").select("doc_id", "text")
    n = F.length("text")
    quote = F.substr("text", F.floor(n / 3).cast("int") + 1, F.least(F.lit(40), n))
    q = d.select("doc_id", F.when(F.col("doc_id") % 2 == 0, F.concat(quote, F.lit(" qzx§"))).otherwise(quote).alias("quote"), F.lit(0).alias("offset"), F.lit(0).alias("quote_start"), F.lit(0).alias("quote_end"))
    found, log = reject_log(verify_quotes(q, d, "doc_id"), ["doc_id", "quote"])
    return log.select("doc_id", "reason").unionByName(found.where("method is null").select("doc_id", F.lit("?").alias("reason")))


def replaced_promises(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    new = read(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_orderkey").alias("l_orderkey"), F.lit(0).cast("long").alias("l_linenumber"), F.lit(1.0).alias("l_quantity"))
    kinds = {c: li.schema[c].dataType for c in li.columns}
    named = read(spark, sf_dir, "orders").where("o_orderpriority in ('1-URGENT', '2-HIGH')").select(F.col("o_orderkey").alias("l_orderkey"))
    after = replace_groups(li, new.select(*[F.col(c).cast(t).alias(c) for c, t in kinds.items()]), ["l_orderkey"], named)
    return after.groupBy("l_orderkey").agg(F.count("*").alias("rows"), F.sum("l_quantity").cast("double").alias("quantity"))


def extracted_marks(spark, sf_dir):
    """Documents marked as extracted by a run, and when they were last read."""
    d = read(spark, sf_dir, "documents").select("doc_id", F.lit(None).cast("string").alias("run"), F.lit(0).alias("reads"))
    done = read(spark, sf_dir, "labels").select("doc_id", F.concat(F.lit("r"), F.col("quality").cast("int")).alias("run"), F.col("toxic").cast("int").alias("reads")).distinct()
    return merge_keyed(d, done, ["doc_id"], {"run": "coalesce_new", "reads": "greatest"}, ["run", "reads"]).groupBy("run").agg(F.count("*").alias("documents"), F.sum("reads").alias("reads"))


def run_log(spark, sf_dir):
    """Runs that are begun, ended and begun anew, as an append-only log; the last entry of each counts."""
    e = read(spark, sf_dir, "events").select(F.col("user_id").alias("run"), F.col("event_id").alias("entry"), F.col("event_type").alias("state"))
    last = top_n(e, ["run"], [F.desc("entry")], 1)
    rejects = e.where("state = 'error'").groupBy("run").agg(F.count("*").alias("rejects"))
    return last.join(rejects, "run", "left").select("run", "entry", "state", F.coalesce("rejects", F.lit(0)).alias("rejects"))


def id_lookups(spark, sf_dir):
    """From a filed number to the person and the person's state, where both are known."""
    to = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.concat(F.lit("B"), "c_custkey").alias("member"), "c_nationkey")
    state = read(spark, sf_dir, "nation").where("n_regionkey != 2").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("state"))
    return read(spark, sf_dir, "orders").join(to, "o_custkey", "left").join(state, "c_nationkey", "left").groupBy("state").agg(F.count("*").alias("filings"), F.count_distinct("member").alias("members"))


def refreshed_rollups(spark, sf_dir):
    """All rollups computed anew and put in their tables' places, twice, the second time from what the first wrote."""
    path = shared_folder(spark, "rollups")
    d = written(donations(spark, sf_dir).select("recipient", "contributor", "cycle", "kind", "amount"), f"{path}/_gifts")  # joined once for all rollups
    by = lambda *c: d.groupBy(*c).agg(F.sum("amount").alias("total"), F.count("*").alias("gifts"))
    refresh({"finance": by("recipient", "cycle"), "contributors": by("recipient", "contributor"), "kinds": by("recipient", "kind")}, path)
    again = {"finance": spark.read.parquet(f"{path}/finance").groupBy("recipient").agg(F.sum("total").alias("total"), F.sum("gifts").alias("gifts")), "contributors": by("contributor")}
    counts = refresh(again, path)
    return counts.unionByName(spark.read.parquet(f"{path}/finance").agg(F.sum("gifts").alias("rows")).select(F.lit("gifts").alias("table"), "rows"))


def site_outcomes(spark, sf_dir):
    """Sites by what became of reading them: pages of a customer's orders as counts."""
    o = read(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count_if(F.col("o_orderstatus") == "F").alias("stored"), F.count_if(F.col("o_orderstatus") == "O").alias("fetched"), F.count_if(F.col("o_orderpriority") == "5-LOW").alias("low"))
    c = read(spark, sf_dir, "customer").join(o, F.col("c_custkey") == F.col("o_custkey"), "left").fillna(0, ["stored", "fetched", "low"])
    return c.groupBy(ev.fetch_outcome(F.col("stored"), F.col("fetched"), F.col("c_mktsegment") != "BUILDING").alias("outcome"), ev.discovery_outcome(F.col("low"), F.col("fetched")).alias("discovery")).agg(F.count("*").alias("sites"))


def distinct_claims(spark, sf_dir):
    """Line items as claims of suppliers: repeats of a claim go, the one with the smallest number stays."""
    claims = read(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("evaluation"), F.col("l_returnflag").alias("kind"), (F.col("l_suppkey") % 10).alias("record"), F.col("l_linestatus").alias("direction"), (F.col("l_partkey") * 100 + F.col("l_linenumber")).alias("n")
    )
    return first_claims(claims, "n")


def chosen_rows(spark, sf_dir):
    """Orders by parameters of which one asks for nothing, and whether their stamps are of this version."""
    rows = optional_filter(read(spark, sf_dir, "orders"), o_orderstatus="F", o_orderpriority=None)
    return rows.groupBy(stale(rows, {"o_orderpriority": "1-URGENT", "o_orderstatus": "F"}).alias("stale")).agg(F.count("*").alias("rows"), F.sum("o_orderkey").alias("keys"))


def contested_subjects(spark, sf_dir):
    """The subject by which each vote's bill may not be judged, by the topic of the promise."""
    v = votes(spark, sf_dir).join(bills(spark, sf_dir), "bill")
    topic = F.when(F.col("member") % 3 == 0, " Hardware ").when(F.col("member") % 3 == 1, "other")
    return v.groupBy(contested_block(F.col("subjects"), topic, CONTESTED | {"widget": []}).alias("block")).agg(F.count("*").alias("votes"), F.count_distinct("member").alias("members"))


QUERIES = {
    f.__name__: f
    for f in (eligible_promises, pending_members, evaluation_summary, vote_prompts, stored_evaluations, evidence_inserts, citation_rejects, audit_evidence, audit_demotions, audit_changed, recorded_reviews, held_documents, topic_counts,
              second_cut, global_top, null_placement, roster, relevant_items, individual_rows, individual_rejects, json_lines, quote_rejects, replaced_promises, extracted_marks, run_log, id_lookups, refreshed_rollups, site_outcomes, distinct_claims, chosen_rows, contested_subjects)
}

_E = """ev AS (SELECT o_orderkey AS evaluation, o_custkey AS member, CASE o_orderpriority WHEN '1-URGENT' THEN 'completed' WHEN '2-HIGH' THEN 'in_progress' WHEN '3-MEDIUM' THEN 'broken' WHEN '4-NOT SPECIFIED' THEN 'pending' WHEN '5-LOW' THEN 'unverifiable' END AS status,
  CASE WHEN year(o_orderdate) % 2 = 0 THEN 'm1' ELSE 'm2' END AS model, o_orderstatus AS version, o_custkey % 3 <> 0 AS is_current, CASE WHEN o_custkey % 2 = 0 THEN 'ann' END AS reviewed_by,
  CASE WHEN o_custkey % 4 <> 0 THEN CAST(floor(o_totalprice) AS BIGINT) % 100 END AS score, o_orderstatus <> 'P' AS verified, o_orderpriority <> '5-LOW' AS scoreable, CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_totalprice > 50000 END AS gate_keep FROM orders)"""
_C = f"""{VOTES_SQL}, {BILLS_SQL}, cites AS (SELECT l_orderkey AS evaluation, CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN 'donation' ELSE 'vote' END AS kind, l_partkey AS record, l_linenumber = 2 AS hardware, l_suppkey % 5 = 0 AS other,
  CASE WHEN l_linestatus = 'O' THEN 'supports' WHEN l_linenumber % 2 = 1 THEN 'contradicts' ELSE 'contextual' END AS direction, l_discount < 0.05 AS validated FROM lineitem),
firsts AS (SELECT * FROM cites QUALIFY row_number() OVER (PARTITION BY evaluation, kind, record, direction ORDER BY other, hardware DESC, validated) = 1),
checks AS (SELECT evaluation, kind, record, direction, validated, CASE WHEN kind = 'donation' AND direction <> 'contextual' THEN 'donation_not_contextual' WHEN kind = 'donation' THEN 'kind_not_validatable_yet' WHEN vote_id IS NULL THEN 'unknown_record'
  WHEN other THEN 'wrong_politician' WHEN position = 'error' AND direction <> 'contextual' THEN 'procedural_not_contextual' WHEN direction <> 'contextual' AND list_contains(subjects, 'gadget') AND NOT hardware THEN 'contested_subject_not_contextual' ELSE 'ok' END AS reason
  FROM firsts LEFT JOIN votes ON vote_id = record LEFT JOIN bills USING (bill)),
sums AS (SELECT evaluation, count(*) AS cited, count(*) FILTER (reason = 'ok') AS good, count(*) FILTER (reason = 'ok' AND direction = 'supports') AS s, count(*) FILTER (reason = 'ok' AND direction = 'contradicts') AS c FROM checks GROUP BY 1),
verdicts AS (SELECT ev.*, coalesce(cited, 0) AS cited, coalesce(good, 0) AS good, CASE WHEN status IN ('pending', 'unverifiable') THEN coalesce(cited, 0) = 0 WHEN coalesce(good, 0) = 0 THEN false WHEN status = 'broken' THEN c > 0 ELSE s > 0 END AS sound FROM ev LEFT JOIN sums USING (evaluation))"""
_ELIGIBLE = f"""WITH {_E}, {VOTES_SQL}, out AS (SELECT l_orderkey FROM lineitem WHERE (l_returnflag = 'A' AND l_linenumber = 1) OR (l_returnflag = 'R' AND l_linenumber = 2)),
el AS (SELECT evaluation AS promise, member FROM ev WHERE verified AND scoreable AND gate_keep AND evaluation NOT IN (SELECT l_orderkey FROM out) AND member IN (SELECT member FROM votes)
  AND NOT EXISTS (SELECT 1 FROM ev d WHERE d.evaluation = ev.evaluation AND d.is_current AND d.model = 'm1' AND d.version = 'F'))"""
_I = "i AS (SELECT *, CASE WHEN s_suppkey IS NULL THEN 'no_target' WHEN l_orderkey % 50 = 0 THEN 'bad_amount' END AS reason FROM lineitem LEFT JOIN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0) ON s_suppkey = l_suppkey LEFT JOIN (SELECT p_partkey FROM part WHERE p_size > 10) ON p_partkey = l_partkey)"

ORACLES = {
    "audit_changed": f"WITH {_E}, {_C} SELECT reason, count(*) AS rows, count(*) FILTER (validated AND reason = 'ok') AS valid, count(*) FILTER (validated AND reason <> 'ok') AS flipped, count(DISTINCT evaluation) AS evaluations FROM checks GROUP BY 1",
    "distinct_claims": "SELECT l_orderkey AS evaluation, l_returnflag AS kind, l_suppkey % 10 AS record, l_linestatus AS direction, min(l_partkey * 100 + l_linenumber) AS n FROM lineitem GROUP BY ALL",
    "chosen_rows": "SELECT o_orderpriority <> '1-URGENT' AS stale, count(*) AS rows, sum(o_orderkey)::BIGINT AS keys FROM orders WHERE o_orderstatus = 'F' GROUP BY 1",
    "contested_subjects": f"WITH {VOTES_SQL}, {BILLS_SQL} SELECT list_sort(list_filter(subjects, lambda s: s = 'widget' OR (s = 'gadget' AND member % 3 <> 0)))[1] AS block, count(*) AS votes, count(DISTINCT member) AS members FROM votes JOIN bills USING (bill) GROUP BY 1",
    "eligible_promises": f"{_ELIGIBLE} SELECT promise, member FROM el",
    "pending_members": f"{_ELIGIBLE} SELECT member, c_name AS name, count(*) AS pending FROM el JOIN customer ON c_custkey = member GROUP BY 1, 2",
    "evaluation_summary": f"""WITH {_E}, {_C}, fine AS (SELECT evaluation FROM cites GROUP BY 1 HAVING bool_and(validated)),
x AS (SELECT ev.*, is_current AND (status <> 'broken' OR reviewed_by IS NOT NULL) AND f.evaluation IS NOT NULL AS fit FROM ev LEFT JOIN fine f USING (evaluation))
SELECT version, model, status, count(*) AS evaluations, count(*) FILTER (is_current) AS current, count(*) FILTER (fit) AS exportable, CASE WHEN count(*) FILTER (is_current) > 0 THEN round(100 * count(*) FILTER (fit) / count(*) FILTER (is_current)::DOUBLE, 2) END AS pct FROM x GROUP BY 1, 2, 3""",
    "vote_prompts": f"""WITH {VOTES_SQL}, {BILLS_SQL}, t AS (SELECT v.*, subjects, question, regexp_replace(coalesce(text, ''), '^\\s+|\\s+$', '', 'g') AS text, row_number() OVER (PARTITION BY member ORDER BY day DESC, vote_id DESC) AS k FROM votes v JOIN bills USING (bill) LEFT JOIN documents ON doc_id = bill)
SELECT member, string_agg('[vote_id: ' || vote_id || '] HR-' || bill || ' | voted ' || position || ' on ''' || question || ''' | ' || day || CASE WHEN len(subjects) > 2 THEN '{ev.OMNIBUS}' ELSE '' END || CASE WHEN position = 'error' THEN '{ev.PROCEDURAL}' ELSE '' END
  || chr(10) || '    TITLE: ' || array_to_string(subjects, ' ') || chr(10) || '    WHAT IT DOES: ' || CASE WHEN text = '' THEN '{ev.NO_SUMMARY}' WHEN length(text) > 400 THEN regexp_replace(substring(text, 1, 400), ' [^ ]*\\z', '') || '...' ELSE text END, chr(10) ORDER BY k) AS prompt
FROM t WHERE k <= 25 GROUP BY 1""",
    "stored_evaluations": f"""WITH {_E}, {_C}, r AS (SELECT v.*, member IN (SELECT member * 7 FROM votes) AS related, status IN ('pending', 'unverifiable') AS bare FROM verdicts v)
SELECT evaluation AS promise, CASE WHEN NOT related THEN 'pending' ELSE status END AS status, CAST(CASE WHEN related AND NOT bare THEN coalesce(score, 50) END AS INTEGER) AS score,
  NOT related OR (sound AND cited = good AND member % 10 <> 1 AND (bare OR score IS NOT NULL)) AS is_current,
  CASE WHEN NOT related THEN 'no_related_votes' WHEN bare AND score IS NOT NULL THEN 'score_dropped_for_unevidenced_status' WHEN NOT bare AND score IS NULL THEN 'missing_score_for_evidenced_status' END AS note FROM r""",
    "evidence_inserts": f"WITH {_E}, {_C} SELECT kind, direction, count(*) AS rows, count(*) AS votes, 0::BIGINT AS donations, count(*) FILTER (reason = 'ok') AS validated FROM checks WHERE kind = 'vote' AND reason <> 'unknown_record' GROUP BY 1, 2",
    "citation_rejects": f"WITH {_E}, {_C} SELECT kind, reason, count(*) AS rows, sum(record)::BIGINT AS records FROM checks WHERE kind <> 'vote' OR reason = 'unknown_record' GROUP BY 1, 2",
    "audit_evidence": f"WITH {_E}, {_C} SELECT reason, count(*) AS rows, count(*) FILTER (reason = 'ok') AS valid, count(*) FILTER (validated <> (reason = 'ok')) AS flipped FROM checks GROUP BY 1",
    "audit_demotions": f"WITH {_E}, {_C} SELECT status, count(*) AS evaluations, count(*) FILTER (is_current AND cited > 0 AND NOT (sound AND cited = good)) AS demoted, count(*) FILTER (is_current AND NOT (cited > 0 AND NOT (sound AND cited = good))) AS current FROM verdicts GROUP BY 1",
    "recorded_reviews": f"WITH {_E}, r AS (SELECT l_orderkey AS evaluation, max(l_quantity) < 45 AS ok FROM lineitem GROUP BY 1) SELECT status, count(r.evaluation) AS reviewed, count(*) FILTER (is_current AND coalesce(ok, true)) AS current FROM ev LEFT JOIN r USING (evaluation) GROUP BY 1",
    "held_documents": "SELECT source, count(*) AS documents, count(*) FILTER (quality IS NULL) AS pending FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1",
    "topic_counts": f"WITH {_E} SELECT member, count(DISTINCT status) AS topics, count(*) FILTER (scoreable) AS measurable FROM ev GROUP BY 1",
    "second_cut": f"WITH {DONATIONS_SQL}, s AS (SELECT recipient, contributor, sum(amount) AS total FROM donations GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY recipient ORDER BY total DESC, contributor) AS rank FROM s) SELECT recipient, contributor, rank, CAST(round(total, 0) AS DOUBLE) AS total FROM r WHERE rank <= 3",
    "global_top": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50",
    "null_placement": "SELECT c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY CASE WHEN c_acctbal >= 0 THEN c_acctbal END DESC NULLS LAST, nullif(c_mktsegment, 'BUILDING') ASC NULLS FIRST, c_custkey) AS rank FROM customer",
    "roster": """SELECT c_custkey AS key, c_custkey * 10 AS person, 'https://' || c_name AS url, CASE WHEN c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F') THEN 'open'
  WHEN c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 200000) THEN 'gap' ELSE 'done' END AS state
FROM customer WHERE c_custkey % 9 <> 0 AND c_mktsegment <> 'BUILDING' AND c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')""",
    "relevant_items": "SELECT video, doc_id FROM (SELECT concat_ws('-', source, n_chars) AS video, doc_id, contains(lower(concat_ws(' ', coalesce(text, ''), coalesce(lang, ''), coalesce(source, ''))), 'the') AS hit, row_number() OVER (PARTITION BY concat_ws('-', source, n_chars) ORDER BY doc_id) AS k FROM documents) WHERE k = 1 AND hit AND video <> ''",
    "individual_rows": f"""WITH {_I} SELECT CAST(l_suppkey AS VARCHAR) AS recipient_id, 'S' || l_suppkey AS cand_id, l_suppkey * 10 AS candidacy, l_returnflag AS kind, CASE WHEN l_linenumber % 3 <> 0 THEN 'employer ' || l_linestatus END AS employer,
  count(*) AS rows, CAST(sum(CAST(l_extendedprice AS DECIMAL(14,2))) AS DOUBLE) AS amount, count(p_partkey) AS passed_on, 0::BIGINT AS from_committees, 0::BIGINT AS named, strftime(min(l_shipdate), '%Y-%m-%d') AS first_day FROM i WHERE reason IS NULL GROUP BY ALL""",
    "individual_rejects": f"WITH {_I} SELECT reason, count(*) AS rows FROM i WHERE reason IS NOT NULL GROUP BY 1",
    "json_lines": "SELECT quality::INTEGER AS quality, toxic::INTEGER AS toxic, count(*) AS rows, sum(length(text))::BIGINT AS chars, 0::BIGINT AS damaged FROM labels JOIN documents USING (doc_id) GROUP BY 1, 2",
    "quote_rejects": "SELECT doc_id, 'quote_not_in_document' AS reason FROM documents WHERE text IS NOT NULL AND (doc_id % 2 = 0 OR trim(text) = '')",
    "replaced_promises": "SELECT l_orderkey, count(*) AS rows, CAST(sum(l_quantity) AS DOUBLE) AS quantity FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')) GROUP BY 1 UNION ALL SELECT o_orderkey, count(*), count(*) FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1",
    "extracted_marks": "WITH l AS (SELECT doc_id, max(quality::INTEGER * 10 + toxic::INTEGER) AS m FROM labels GROUP BY 1) SELECT CASE WHEN m IS NOT NULL THEN 'r' || (m // 10) END AS run, count(*) AS documents, sum(coalesce(m % 10, 0))::BIGINT AS reads FROM documents LEFT JOIN l USING (doc_id) GROUP BY 1",
    "run_log": "SELECT user_id AS run, max(event_id) AS entry, arg_max(event_type, event_id) AS state, count(*) FILTER (event_type = 'error') AS rejects FROM events GROUP BY 1",
    "id_lookups": "SELECT n_name AS state, count(*) AS filings, count(DISTINCT 'B' || c_custkey) AS members FROM orders LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey AND n_regionkey <> 2 GROUP BY 1",
    "refreshed_rollups": f"WITH {DONATIONS_SQL} SELECT 'finance' AS \"table\", count(DISTINCT recipient) AS rows FROM donations UNION ALL SELECT 'contributors', count(DISTINCT contributor) FROM donations UNION ALL SELECT 'gifts', count(*) FROM donations",
    "site_outcomes": """WITH o AS (SELECT o_custkey, count(*) FILTER (o_orderstatus = 'F') AS stored, count(*) FILTER (o_orderstatus = 'O') AS fetched, count(*) FILTER (o_orderpriority = '5-LOW') AS low FROM orders GROUP BY 1)
SELECT CASE WHEN c_mktsegment = 'BUILDING' THEN 'robots_disallowed' WHEN coalesce(stored, 0) > 0 THEN 'documents_stored' WHEN coalesce(fetched, 0) > 0 THEN 'no_content' ELSE 'unreachable' END AS outcome,
  CASE WHEN coalesce(low, 0) > 0 THEN 'candidates_with_website' WHEN coalesce(fetched, 0) > 0 THEN 'social_or_donation_only' ELSE 'no_website_declared' END AS discovery, count(*) AS sites FROM customer LEFT JOIN o ON o_custkey = c_custkey GROUP BY 1, 2""",
}
