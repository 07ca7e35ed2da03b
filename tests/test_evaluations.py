"""Evaluations: what is eligible, stored, audited; rosters, individual gifts, JSON lines, rollups."""

from pyspark.sql import functions as F

from tallyward import plans
from tallyward.operators import evaluations as ev
from tallyward.operators import evidence, gate
from tallyward.operators.evidence import prose_defects
from tallyward.operators.intake import DONOR, individual_transactions
from tallyward.operators.merge import refresh
from tallyward.sources.readers import cached_spans, read_lines, write_lines


def test_each_rule_of_eligibility(spark):
    rows = [(1, 7, True, True, True), (2, 7, False, True, True), (3, 7, True, False, True), (4, 7, True, True, None), (5, 7, True, True, False), (6, 7, True, True, True), (7, 7, True, True, True), (8, 9, True, True, True), (9, 7, True, True, True)]
    promises = spark.createDataFrame(rows, "promise int, member int, verified boolean, scoreable boolean, gate_keep boolean")
    reviews = spark.createDataFrame([(6, "opinion"), (1, "good")], "promise int, verdict string")
    done = spark.createDataFrame([(7, True, "m", "v"), (9, False, "m", "v"), (1, True, "m", "old")], "promise int, is_current boolean, model string, version string")
    votes = spark.createDataFrame([(7,), (7,)], "member int")
    got = ev.eligible_promises(promises, reviews, done, votes, "m", "v")
    assert sorted(r.promise for r in got.collect()) == [1, 9]
    people = spark.createDataFrame([(7, "Ann"), (9, "Bo")], "member int, name string")
    assert [tuple(r) for r in ev.pending_members(got, people).collect()] == [(7, "Ann", 2)]


def test_prompt_blocks(spark):
    long = "word " * 100
    rows = [(1, 2, 20, "HR-2", "nay", "On Passage", "2024-01-01", True, True, "", None), (1, 1, 10, "HR-1", "yea", "On Passage", "2024-01-02", False, False, "A title", f"  {long}")]
    df = spark.createDataFrame(rows, "p int, rank int, vote_id int, bill_key string, position string, question string, day string, omnibus boolean, procedural boolean, title string, summary string")
    lines = ev.render_votes(df, ["p"]).first().prompt.split("\n")
    assert lines[0] == "[vote_id: 10] HR-1 | voted yea on 'On Passage' | 2024-01-02" and lines[1] == "    TITLE: A title"
    assert lines[2] == "    WHAT IT DOES: " + ("word " * 80).rsplit(" ", 1)[0] + "..."
    assert lines[3].endswith("2024-01-01" + ev.OMNIBUS + ev.PROCEDURAL) and lines[4] == "    TITLE: (untitled)" and lines[5].endswith(ev.NO_SUMMARY)


def _checks(spark, rows):
    return spark.createDataFrame(rows, "evaluation int, kind string, record int, direction string, reason string, accepted boolean")


def test_what_an_evaluation_stores(spark):
    rows = [(1, 1, "completed", 80, []), (2, 2, "completed", None, []), (3, 3, "pending", 50, []), (4, 4, "broken", 10, ["overlong"]), (5, 5, "completed", 70, []), (6, 6, "completed", 60, [])]
    results = spark.createDataFrame([(*r[:4], "said", r[4]) for r in rows], "promise int, evaluation int, status string, score int, reasoning string, defects array<string>")
    checks = _checks(spark, [(1, "vote", 9, "supports", "ok", True), (2, "vote", 9, "supports", "ok", True), (4, "vote", 9, "contradicts", "ok", True), (5, "vote", 9, "supports", "ok", True), (5, "vote", 8, "supports", "not_offered", False)])
    related = spark.createDataFrame([(k,) for k in (1, 2, 3, 4, 5)], "promise int")
    got = {r.promise: (r.status, r.score, r.is_current, r.note) for r in ev.stored_evaluations(results, checks, related).collect()}
    assert got == {
        1: ("completed", 80, True, None), 2: ("completed", 50, False, "missing_score_for_evidenced_status"), 3: ("pending", None, True, "score_dropped_for_unevidenced_status"),
        4: ("broken", 10, False, None), 5: ("completed", 70, False, None), 6: ("pending", None, True, "no_related_votes"),
    }


def test_an_audit_demotes_and_never_promotes(spark):
    evaluations = spark.createDataFrame([(1, "completed", True), (2, "completed", True), (3, "completed", False), (4, "pending", True)], "evaluation int, status string, is_current boolean")
    evidence = spark.createDataFrame([(1, 7, "t", "vote", 10, "supports", None, True), (2, 7, "t", "vote", 11, "supports", None, True), (3, 7, "t", "vote", 10, "supports", None, False)], "evaluation int, member int, topic string, kind string, record int, direction string, claimed string, validated boolean")
    facts = spark.createDataFrame([(10, 7, "yea", False, False, ["x"]), (11, 8, "yea", False, False, ["x"])], "record int, member int, position string, omnibus boolean, procedural boolean, subjects array<string>")
    checked, after = ev.audit(evaluations, evidence, facts)
    assert {(r.evaluation, r.valid, r.flipped) for r in checked.collect()} == {(1, True, False), (2, False, True), (3, True, True)}
    assert {(r.evaluation, r.demoted, r.is_current) for r in after.collect()} == {(1, False, True), (2, True, False), (3, False, False), (4, False, True)}
    reviewed = ev.record_reviews(evaluations, spark.createDataFrame([(1, "ann", False), (4, "bo", True)], "evaluation int, reviewer string, approved boolean"))
    assert {(r.evaluation, r.reviewed_by, r.is_current) for r in reviewed.collect()} == {(1, "ann", False), (2, None, True), (3, None, False), (4, "bo", True)}


def test_individual_gifts(spark):
    donor = {c: " x " for c in DONOR} | {"employer": "", "state": "ME"}
    rows = [("s1", " C1 ", "", "15", "250", "05202026"), ("s2", "C1", "C9", "15", "1", "x"), ("s3", "C1", "C8", "15", "1", None), ("s4", "C5", "", "15", "1", None), ("s5", "C1", "", "15", "??", None)]
    raw = spark.createDataFrame([(*r, *[donor[c] for c in DONOR]) for r in rows], "sub_id string, cmte_id string, other_id string, kind string, amount string, day string, " + ", ".join(f"{c} string" for c in DONOR))
    to = spark.createDataFrame([("C1", "S1", 5)], "cmte_id string, cand_id string, candidacy int")
    good, bad = individual_transactions(raw, to, spark.createDataFrame([("C9",)], "cmte_id string"))
    got = {r.sub_id: r for r in good.collect()}
    assert set(got) == {"s1", "s2", "s3"} and got["s1"].amount == 250 and str(got["s1"].day) == "2026-05-20" and got["s1"].employer is None and got["s1"].state == "ME" and got["s1"].contributor == "x"
    assert {k: r.conduit_id for k, r in got.items()} == {"s1": None, "s2": "C9", "s3": None} and all(r.contributor_id is None for r in got.values())
    assert {(r.sub_id, r.reason) for r in bad.collect()} == {("s4", "no_target"), ("s5", "bad_amount")}


def test_json_lines_and_cached_spans(spark, tmp_path):
    path = str(tmp_path / "lines")
    write_lines(spark.createDataFrame([(1, "a\nb"), (2, None)], "id int, text string"), path)
    (tmp_path / "lines" / "extra.json").write_text('{"id": "x"}\n\n not json\n')
    good, bad = read_lines(spark, path, "id int, text string")
    assert {tuple(r) for r in good.collect()} == {(1, "a\nb"), (2, None)} and bad.count() == 2
    once = spark.createDataFrame([(1,)], "n int")
    assert cached_spans(once, str(tmp_path / "c"), "v1").count() == 1
    assert cached_spans(once.union(once), str(tmp_path / "c"), "v1").count() == 1 and cached_spans(once.union(once), str(tmp_path / "c"), "v2").count() == 2


def test_rollups_are_refreshed_from_what_they_hold(spark, tmp_path):
    path = str(tmp_path / "r")
    refresh({"t": spark.createDataFrame([(1, 2), (1, 3)], "k int, n int")}, path)
    counts = refresh({"t": spark.read.parquet(f"{path}/t").groupBy("k").agg(F.sum("n").cast("int").alias("n"))}, path)
    assert [tuple(r) for r in counts.collect()] == [("t", 1)] and [tuple(r) for r in spark.read.parquet(f"{path}/t").collect()] == [(1, 5)]


def test_rosters_outcomes_and_relevance(spark):
    people = ev.roster(
        spark.createDataFrame([("a", "u"), ("b", " "), ("c", "u"), ("d", "u")], "key string, url string"), spark.createDataFrame([("a", 1), ("b", 2), ("d", 4), (None, 5)], "key string, person int"),
        spark.createDataFrame([("a",), ("a",), ("d",)], "key string"),
    )
    state = ev.work_state(people, spark.createDataFrame([(1,), (1,)], "person int"), spark.createDataFrame([(4,)], "person int"))
    assert {(r.person, r.state) for r in state.collect()} == {(1, "gap"), (4, "open")}
    items = spark.createDataFrame([("v", 1, "no"), ("v", 2, "ANN"), ("w", 3, "see ann"), (None, 4, "ann"), ("", 5, "ann")], "video string, n int, title string")
    assert [(r.video, r.n) for r in ev.relevant(items, F.lit("Ann"), ["title"], "video", [F.col("n")]).collect()] == [("w", 3)]


def test_white_space_of_unicode_counts(spark):
    quote = "I think families deserve better and I will fight for them."
    row = spark.createDataFrame([(quote, "\n \n")], "q string, p string").select(gate.screen(F.col("q"))["reason"].alias("r"), prose_defects(F.col("p"), F.array()).alias("d")).first()
    assert row.r == "kept" and row.d == ["empty"]


def _below(plan: str, node: str) -> list[str]:
    """The lines of a plan below the first one that names a node."""
    lines = plan.split("\n")
    depth = lambda s: len(s) - len(s.lstrip(" :+-*()0123456789"))
    at = next(i for i, line in enumerate(lines) if node in line)
    rest = lines[at + 1 :]
    return rest[: next((i for i, line in enumerate(rest) if depth(line) <= depth(lines[at])), len(rest))]


def test_claims_are_dealt_before_they_are_sorted(spark):
    claims = spark.range(100).selectExpr("id % 7 AS evaluation", "concat('v', id % 2) AS kind", "id % 5 AS record", "concat('d', id % 5) AS direction", "cast(id AS string) AS topic")
    plan = evidence.without_repeats(claims)._jdf.queryExecution().executedPlan().toString()
    assert not [line for line in _below(plan, "Exchange hashpartitioning") if "Sort" in line]
    assert evidence.without_repeats(claims).count() == 70


def test_prompts_rank_votes_without_texts(spark):
    plan = plans.queries()["vote_prompts"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "text#" in plan and not [line for line in _below(plan, "Window ") if "text#" in line]
