"""Streams with state, spans of any length, quotes by automaton, rule masks, repeats and change sets."""

import datetime as dt
import math
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from tallyward import plans
from tallyward.operators import evidence, gate, intake, joins, quadtree, text
from tallyward.plans import records
from tallyward.plans.text import QUOTES
from tallyward.streaming import state
from tallyward.streaming.loads import above_mark


def test_marks_survive_a_restart(spark, tmp_path):
    """Three runs of a stream give what the batch form gives against all that was loaded before, and each row once."""
    schema, src = "chamber string, number long, member string", str(tmp_path / "in")
    runs = [
        [("h", 1, "a"), ("h", 1, "b"), ("h", 2, "a"), ("s", 5, "a"), (None, 1, "n")],
        [("h", 2, "late"), ("h", 3, "a"), ("h", 3, "b"), ("s", 4, "late"), ("x", 0, "never"), ("x", None, "no number"), (None, 2, "n")],
        [("h", 1, "a"), ("s", 6, "a"), ("h", 3, "again"), ("x", 7, "a")],
    ]
    stored = spark.createDataFrame([("s", 4)], "chamber string, number long")
    have, known = spark.createDataFrame([], schema), stored.withColumn("member", F.lit("stored"))
    for rows in runs:
        new = spark.createDataFrame(rows, schema)
        key = [F.coalesce("chamber", F.lit("?")).alias("chamber"), "number", "member"]
        fresh = above_mark(new.where("number is not null").select(*key), have.unionByName(known).select(*key), ["chamber"], "number")
        have = spark.createDataFrame(sorted(map(tuple, have.select(*key).unionByName(fresh.select("chamber", "number", "member")).collect())), schema)
        new.coalesce(1).write.mode("append").parquet(src)
        stream = state.above_marks(spark.readStream.schema(schema).parquet(src), ["chamber"], "number", stored)
        got = state.run(stream, str(tmp_path / "out"))
    assert sorted(map(tuple, got.select(*key).collect())) == sorted(map(tuple, have.collect()))
    assert len(have.collect()) == 10


def test_payloads_come_once_and_are_forgotten(spark, tmp_path):
    schema, src = "kind string, body string, at timestamp", str(tmp_path / "in")
    day = lambda n: dt.datetime(2024, 1, 1) + dt.timedelta(days=n)
    steps = [[("a", "x", day(0)), ("b", "x", day(0)), ("a", None, day(0)), ("a", "", day(0))], [("a", "x", day(0.5)), ("a", "y", day(0.6))], *[[("a", f"z{i}", day(10 + 10 * i))] for i in range(4)], [("a", "x", day(1)), ("a", "x", day(41))]]
    sizes = []
    for rows in steps:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        stream = state.new_payloads(spark.readStream.schema(schema).parquet(src), "kind", "body", "at", "1 day")
        query = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
        query.awaitTermination()
        sizes.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    got = sorted((r.kind, r.body or "", r.at) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    # null and empty bodies are one content; the repeat of x within a day is dropped, the late one too, the one after a month is new
    assert got == sorted([("a", "x", day(0)), ("b", "x", day(0)), ("a", "", day(0)), ("a", "y", day(0.6)), *[("a", f"z{i}", day(10 + 10 * i)) for i in range(4)], ("a", "x", day(41))])
    assert max(sizes[3:]) <= 2 and sizes[1] >= 3


@pytest.mark.parametrize("share", [0.5, 0.0001, 1.0])
def test_spans_of_any_length_overlap(spark, share):
    rng = random.Random(7)

    def spans(n):
        out = []
        for i in range(n):
            start, size = rng.randint(-50, 3000), rng.choice([0, 1, 2, 3, 4, 7, 8, 9, 64, 100, 1000, 5000])
            out.append((rng.choice(["d", "e"]), i, start, start + size))
        return out

    a, b = spans(150) + [("d", 900, 0, 10_000_000), ("d", 901, None, 5), (None, 902, 0, 5)], spans(150) + [("d", 900, 4_000_000, 9_999_999), ("d", 901, 9_999_999, 10_000_005)]
    names = "doc string, id int, start int, end int"
    got = sorted((r.doc, r.a_id, r.b_id, r.chars) for r in joins.overlapping(spark.createDataFrame(a, names), spark.createDataFrame(b, names), "doc", share).collect())
    want = []
    for d, i, s, e in a:
        for o, j, t, f in b:
            if d is not None and d == o and s is not None and s < e and t < f:
                chars = min(e, f) - max(s, t)
                if chars > 0 and chars >= min(e - s, f - t) * share:
                    want.append((d, i, j, chars))
    assert got == sorted(want)


def test_no_spans(spark):
    none = spark.createDataFrame([], "doc string, id int, start int, end int")
    assert joins.overlapping(none, none, "doc").count() == 0


@pytest.mark.parametrize(("share", "block"), [(0.5, 4096), (0.0001, 3), (1.0, 1)])
def test_pieces_of_runs_overlap(spark, share, block, monkeypatch):
    monkeypatch.setattr(joins, "PIECES", block)
    rng = random.Random(5)
    runs = [("d", 1, 0, 500, 7), ("d", 2, -3, 498, 500), ("d", 3, 100, 101, 1), ("d", 4, 30, 490, 1000), ("e", 1, 0, 77, 11), ("e", 2, 5, 5, 3), ("e", 3, 0, 9, 0), ("e", 4, None, 9, 2), (None, 5, 0, 9, 2)]
    b = [(rng.choice(["d", "e"]), i, s, s + rng.choice([0, 1, 3, 7, 20, 90, 600])) for i in range(60) for s in [rng.randint(-20, 510)]] + [("d", 90, None, 5), (None, 91, 0, 5)]
    got = joins.overlapping_pieces(spark.createDataFrame(runs, "doc string, id int, start int, end int, size int"), spark.createDataFrame(b, "doc string, id int, start int, end int"), "doc", share)
    want = []
    for d, i, s, e, size in runs:
        for n, p in enumerate(range(s, e, size) if s is not None and size else []):
            for o, j, t, f in b:
                if d is not None and d == o and t is not None and t < f:
                    q = min(p + size, e)
                    chars = min(q, f) - max(p, t)
                    if chars > 0 and chars >= min(q - p, f - t) * share:
                        want.append((d, i, n, j, chars))
    assert sorted(map(tuple, got.collect())) == sorted(want)


def shuffled_rows(spark):
    """Rows that the session's stages have written to shuffles so far."""
    gateway = spark.sparkContext._gateway
    stages = spark.sparkContext._jsc.sc().statusStore().stageList(None, False, False, gateway.new_array(spark.sparkContext._jvm.double, 0), None)
    return {stages.apply(i).stageId(): stages.apply(i).shuffleWriteRecords() for i in range(stages.size())}


@pytest.fixture
def merge_joins(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_pieces_become_rows_after_the_shuffle(spark, tmp_path, merge_joins):
    spark.createDataFrame([(1, "\n".join(["x" * 99] * 300)), (2, None), (3, "")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    before = shuffled_rows(spark)
    got = records.span_nesting(spark, str(tmp_path)).collect()
    assert [(r.doc_id, r.lines) for r in got] == [(1, 300)] and got[0].pairs > 4_000
    assert sum(n for k, n in shuffled_rows(spark).items() if k not in before) < 2_000  # 300 lines and 5 sizes, 15,773 rows with pieces among them


def test_spans_of_any_length_are_few_rows(spark, merge_joins):
    """A short span looks into a few levels of the other side only."""
    a = spark.createDataFrame([(1, i, 7 * i, 7 * i + 7) for i in range(1000)], "doc int, id int, start int, end int")
    b = spark.createDataFrame([(1, i, 0, 2**i) for i in range(20)], "doc int, id int, start int, end int")
    before = shuffled_rows(spark)
    joins.overlapping(a, b, "doc").collect()
    assert sum(n for k, n in shuffled_rows(spark).items() if k not in before) < 12_000  # 18,547 with a level for each power of two


FOLD = {"‘": "'", "’": "'", "“": '"', "”": '"', "–": "-", "—": "-", "\u00a0": " "}


def plain_verdict(doc, offset, quote, lo, hi):
    """One quote at a time, character by character."""
    if not quote or doc is None:
        return ("rejected", -1, -1)
    lo, hi = offset + lo, offset + hi
    if 0 <= lo < hi and doc[lo:hi] == quote:
        return ("exact", lo, hi)
    if quote in doc:
        return ("relocated", doc.index(quote), doc.index(quote) + len(quote))

    def flat(t):
        out = []
        for i, c in enumerate(t):
            c = FOLD.get(c, c)
            if not c.isspace():
                out.append((c, i))
            elif not out or out[-1][0] != " ":
                out.append((" ", i))
        return out

    body, want = flat(doc), "".join(c for c, _ in flat(quote)).strip()
    at = "".join(c for c, _ in body).find(want) if want else -1
    return ("rejected", -1, -1) if at < 0 else ("normalized", body[at][1], body[at + len(want) - 1][1] + 1)


def test_quotes_equal_the_plain_way(spark, monkeypatch):
    monkeypatch.setattr(text, "QUOTES_AT_ONCE", 40)
    rng = random.Random(3)
    letters = ["a", "b", "'", "’", "“", '"', "–", "-", " ", "  ", "\n", "\u00a0", "\u2009", "\u3000", "\t ", "😀", "\x1c"]
    docs = [(i, "".join(rng.choices(letters, k=rng.choice([0, 5, 60, 400])))) for i in range(30)] + [(30, None), (31, "\u00a0 x")]
    rows = []
    for _ in range(900):
        k = rng.choice([0, 1, 2, 3, *range(34)])  # a few documents have most quotes
        doc = dict(docs).get(k) or ""
        lo = rng.randint(0, max(0, len(doc) - 1))
        quote = doc[lo : lo + rng.randint(0, 12)]
        for _ in range(rng.choice([0, 0, 1, 3])):
            quote = re.sub(r"\s+", lambda m: rng.choice([" ", "\u00a0", " \n"]), quote.replace("’", "'").replace("–", "—"))
        rows.append((k, quote if rng.random() < 0.9 else rng.choice(["", " ", None, "zz"]), rng.choice([0, 2]), rng.choice([lo, lo - 2, -1]), lo + len(quote) - rng.choice([0, 2]), "kept"))
    quotes = spark.createDataFrame(rows, "doc int, quote string, offset int, quote_start int, quote_end int, more string").repartition(4)
    got = text.verify_quotes(quotes, spark.createDataFrame(docs, "doc int, text string"), "doc")
    assert got.columns == [*quotes.columns, "method", "start", "end"]
    found = [tuple(r) for r in got.collect()]
    want = [(*r, *plain_verdict(dict(docs).get(r[0]), r[2], r[1], r[3], r[4])) for r in rows]
    assert sorted(map(repr, found)) == sorted(map(repr, want))
    assert {w[-3] for w in want} == {"exact", "relocated", "normalized", "rejected"}


def test_no_quotes(spark):
    quotes = spark.createDataFrame([], "doc int, quote string, offset int, quote_start int, quote_end int")
    assert text.verify_quotes(quotes, spark.createDataFrame([(1, "x")], "doc int, text string"), "doc").count() == 0


def test_masks_judge_as_the_ladder_does(spark):
    extra = ["", "  ", None, "I will.", "Maybe the end.", "By fighting for roads and all that comes along", "We are hoping to see it, and I think so. \"Yes\" he said"]
    quotes = [(q,) for _, q in QUOTES] + [(q,) for q in extra]
    df = spark.createDataFrame(quotes, "quote string")
    mask = df.select("quote", gate.hits(F.col("quote"), ["think"]).alias("m"))
    for name, off in gate.procedures().items():
        if name in ("keep_all", "phrases"):
            continue
        rules = [r for r in gate.RULES if gate.BIT[r] & off]
        want = {r.quote: r.g for r in df.select("quote", gate.screen(F.col("quote"), disabled=rules, escape=name != "gate_no_escape")["reason"].alias("g")).collect()}
        got = {r.quote: r.g for r in mask.select("quote", gate.judged(F.col("m"), F.lit(off)).alias("g")).collect()}
        assert got == want, name


def test_sweep_counts(spark):
    df = spark.createDataFrame([(q, r == "kept") for r, q in QUOTES], "quote string, truth boolean").withColumn("m", gate.hits(F.col("quote"), ["think"]))
    got = {r.procedure: r for r in gate.sweep(df, "m", "truth").collect()}
    n = len(QUOTES)
    assert set(got) == set(gate.procedures()) and all(r.tp + r.fp + r.fn + r.tn == n for r in got.values())
    assert (got["gate"].fp, got["gate"].fn) == (0, 0) and got["keep_all"].tn == got["keep_all"].fn == 0
    assert all(got["gate"].tp <= got[f"without_{r}"].tp + got[f"without_{r}"].fp for r in gate.RULES)


def test_gate_runs_by_version(spark):
    df = spark.createDataFrame([("I will vote for the roads of this state.", None), ("I will vote for the roads of this state.", "old"), ("Really?", gate.VERSION)], "quote string, version string")
    assert [(r.keep, r.version) for r in gate.run(df, "quote", "version").collect()] == [(True, gate.VERSION)] * 2


FACTS = "record long, member long, position string, omnibus boolean, procedural boolean, subjects array<string>"
CLAIMS = "evaluation long, member long, topic string, kind string, record long, direction string, claimed string, validated boolean"


def test_repeated_citations_count_once(spark):
    facts = spark.createDataFrame([(1, 7, "yea", False, False, [])], FACTS)
    rows = [(1, 7, "t", "vote", 1, "supports", None, True)] * 3 + [(1, 7, "t", "vote", 1, "contextual", None, True), (1, 7, "t", "vote", None, "supports", None, True), (1, 7, "t", "vote", None, "supports", None, True)]
    claims = spark.createDataFrame(rows, CLAIMS)
    checks = evidence.check_claims(claims.drop("validated"), facts)
    assert sorted((r.direction, r.record, r.reason) for r in checks.collect() if r.record) == [("contextual", 1, "ok"), ("supports", 1, "ok")]
    assert checks.count() == 3
    support = evidence.status_support(spark.createDataFrame([(1, "completed")], "evaluation long, status string"), checks).first()
    assert (support.cited, support.good, support.verdict) == (3, 2, "ok")
    again = evidence.revalidate(claims, facts)
    assert sorted((r.record or 0, r.direction, r.valid, r.flipped) for r in again.collect()) == [(0, "supports", False, True), (1, "contextual", True, False), (1, "supports", True, False)]


def test_changed_facts_only_touch_their_evidence(spark):
    rng = random.Random(5)
    fact = lambda i: (i, rng.choice([1, 2]), rng.choice(["yea", "nay"]), rng.random() < 0.1, rng.random() < 0.2, rng.choice([[], ["Religion"], None]))
    old = [fact(i) for i in range(60)]
    new = [fact(i) if i % 9 == 0 else r for i, r in enumerate(old) if i % 13] + [fact(60), fact(61)]
    ev = [(rng.randint(0, 15), rng.choice([1, 2]), rng.choice(["religion", None]), rng.choice(["vote", "vote", "donation"]), rng.choice([None, *range(63)]), rng.choice(["supports", "contextual"]), None, rng.choice([True, False, None])) for _ in range(250)]
    old, new, ev = spark.createDataFrame(old, FACTS), spark.createDataFrame(new, FACTS), spark.createDataFrame(ev, CLAIMS)
    after, touched = evidence.revalidate_changed(ev, evidence.revalidate(ev, old), old, new)
    assert sorted(map(repr, after.collect())) == sorted(map(repr, evidence.revalidate(ev, new).collect()))
    changed = {r.record for r in evidence.changed_keys(old, new, "record").collect()}
    assert {13, 26, 60, 61} <= changed and 1 not in changed and 0 < touched.count() <= 16
    assert {r.evaluation for r in touched.collect()} == {r.evaluation for r in ev.collect() if r.record in changed}
    same, none = evidence.revalidate_changed(ev, evidence.revalidate(ev, old), old, old)
    assert none.count() == 0 and same.count() == evidence.revalidate(ev, old).count()


def test_a_committee_with_two_candidacies_counts_once(spark):
    names = ["sub_id", "cmte_id", "other_id", "kind", "amount", "day", *intake.DONOR]
    raw = spark.createDataFrame([("1", "C1", None, "15", "100", "01022024", *[None] * len(intake.DONOR))], ", ".join(f"{n} string" for n in names))
    owners = spark.createDataFrame([("C1", "S9", 90), ("C1", "H3", 30), ("C1", "H3", 31), (None, "H0", 1)], "cmte_id string, cand_id string, candidacy long")
    good, bad = intake.individual_transactions(raw, owners, spark.createDataFrame([], "cmte_id string"))
    assert [(r.sub_id, r.cand_id, r.candidacy) for r in good.collect()] == [("1", "H3", 30)] and bad.count() == 0
    other = spark.createDataFrame([("1", "C1", None, "H3", "15", "100", "01022024", "x")], "sub_id string, cmte_id string, other_id string, cand_id string, kind string, amount string, day string, name string")
    good, _ = intake.transactions(other, owners.select("cand_id", "candidacy"), spark.createDataFrame([], "cmte_id string"))
    assert [r.candidacy for r in good.collect()] == [30]


def plain_inside(x, y, ring):
    odd = False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
        if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
            odd = not odd
    return odd


@pytest.mark.parametrize("most,depth", [(16, 12), (2, 5)])
def test_points_find_their_rings(spark, most, depth):
    """Rings of very different sizes and shapes in several states, points at random, on corners, edges and far away."""
    rng = random.Random(4)
    rings = {("a", 0): [(0, 0), (100, 0), (100, 100), (0, 100)], ("a", 1): [(20, 20), (40, 20), (40, 40), (20, 40)], ("b", 0): [(0, 0), (50, 90), (100, 0), (50, 20)]}
    rings[("a", 2)] = [(50 + (30 + rng.uniform(-9, 9)) * math.cos(t / 90), 50 + (30 + rng.uniform(-9, 9)) * math.sin(t / 90)) for t in range(0, 565, 2)]
    rings[("b", 1)] = [(900 + x, 900 + y) for x, y in [(0, 0), (0.01, 0), (0.01, 0.02)]]
    rings[("c", 0)] = [(x * 7.0, (x % 2) * 80.0) for x in range(60)] + [(x * 7.0, (x % 2) * 80.0 + 9) for x in reversed(range(60))]
    rows = [(s, r, i, *map(float, p), *map(float, q)) for (s, r), ps in rings.items() for i, (p, q) in enumerate(zip(ps, ps[1:] + ps[:1]))]
    segs = spark.createDataFrame(rows, "state string, ring int, seq int, x1 double, y1 double, x2 double, y2 double")
    spots = [(rng.uniform(-20, 430), rng.uniform(-20, 120)) for _ in range(600)] + [(float(x), float(y)) for x in range(0, 101, 20) for y in range(0, 101, 20)] + [(900.005, 900.001), (900.0, 900.0), (1e6, -1e6)]
    points = [(i, s, x, y) for i, (x, y) in enumerate(spots) for s in ("a", "b", "c", "none")]
    cells = quadtree.ring_cells(segs, depth, most)
    got = {tuple(r) for r in quadtree.inside(spark.createDataFrame(points, "id int, state string, x double, y double"), cells, ["id", "state"]).collect()}
    assert got == {(i, s, r) for i, s, x, y in points for (t, r), ps in rings.items() if s == t and plain_inside(x, y, ps)}
    kinds = {r.edge for r in cells.leaves.collect()}
    assert kinds == {True, False} and cells.leaves.count() < 3000


def test_cells_split_to_fit_their_ring(spark):
    """A diamond of four segments: unsplit, all cells are edge cells; split twice, less ground is left to them, and some cells lie inside."""
    ring = [(50.0, 0.0), (100.0, 50.0), (50.0, 100.0), (0.0, 50.0)]
    rows = [("a", r, i, *[c * s for c in (*p, *q)]) for r, s in ((0, 1.0), (1, 8.0)) for i, (p, q) in enumerate(zip(ring, ring[1:] + ring[:1]))]
    segs = spark.createDataFrame(rows, "state string, ring int, seq int, x1 double, y1 double, x2 double, y2 double")
    points = [(10 * i + j, "a", 3.7 + 11.3 * i, 2.9 + 10.7 * j) for i in range(10) for j in range(10)]
    ground, found = [], []
    for least in (0, 2):
        cells = quadtree.ring_cells(segs, least=least)
        found.append({tuple(r) for r in quadtree.inside(spark.createDataFrame(points, "id int, state string, x double, y double"), cells, ["id"]).collect()})
        ground.append({r.edge: r.g for r in cells.leaves.groupBy("edge").agg(F.sum(F.pow(F.lit(4.0), -F.col("level"))).alias("g")).collect()})
    want = {(i, r) for i, _, x, y in points for r, s in ((0, 1.0), (1, 8.0)) if plain_inside(x, y, [(a * s, b * s) for a, b in ring])}
    assert found == [want, want]
    assert set(ground[0]) == {True} and ground[1][False] > 0 and ground[1][True] < ground[0][True] * 0.75


def test_pairs_of_points_and_rings_are_not_shuffled(spark):
    """Points and leaves meet in one join, and nothing is grouped after it, save for leaves that more segments touch than cells are
    split for; all points are held against a star whose spikes end in its middle as well."""
    star = [p for i in range(30) for p in ((50 + 40 * math.cos(i / 30 * 2 * math.pi), 50 + 40 * math.sin(i / 30 * 2 * math.pi)), (50.0, 50.0 + i / 1e9))]
    rings = {0: [(20.0, 20.0), (70.0, 30.0), (60.0, 90.0)], 1: star}
    rng = random.Random(3)
    points = [(i, "a", rng.gauss(50, 15), rng.gauss(50, 15)) for i in range(400)] + [(i, "a", rng.gauss(50, 0.01), rng.gauss(50, 0.01)) for i in range(400, 500)]
    at = spark.createDataFrame(points, "id int, state string, x double, y double")
    for names, depth, crowded in (([0], 12, False), ([0, 1], 4, True)):
        rows = [("a", r, i, *p, *q) for r in names for i, (p, q) in enumerate(zip(rings[r], rings[r][1:] + rings[r][:1]))]
        cells = quadtree.ring_cells(spark.createDataFrame(rows, "state string, ring int, seq int, x1 double, y1 double, x2 double, y2 double"), depth)
        found = quadtree.inside(at, cells, ["id"])
        plan = found._jdf.queryExecution().sparkPlan().toString()
        assert crowded or (plan.count("Join [") == 1 and "Aggregate" not in plan)
        assert {tuple(r) for r in found.collect()} == {(i, r) for i, _, x, y in points for r in names if plain_inside(x, y, rings[r])}
        assert (cells.crowds is not None) == crowded


def test_no_rings(spark):
    cells = quadtree.ring_cells(spark.createDataFrame([], "state string, ring int, seq int, x1 double, y1 double, x2 double, y2 double"))
    assert quadtree.inside(spark.createDataFrame([(1, "a", 0.0, 0.0)], "id int, state string, x double, y double"), cells, ["id"]).count() == 0


def test_marks_lose_no_events_of_many_files(spark, tmp_path):
    e = spark.range(1, 4001).select(F.col("id").alias("event_id"), (F.col("id") % 50).alias("user_id"), F.when(F.col("id") % 7 == 0, "error").when(F.col("id") % 2 == 0, "click").otherwise("view").alias("event_type"))
    for k in (3, 11, 0, 7, 5, 10, 1, 9, 2, 8, 4, 6):  # files in no order of their numbers
        e.where(f"event_id % 12 = {k}").coalesce(1).write.mode("append").parquet(f"{tmp_path}/events.parquet")
    before = spark.conf.get("spark.sql.files.minPartitionNum", None)
    spark.conf.set("spark.sql.files.minPartitionNum", "12")
    try:
        got = plans.queries()["stream_marks"](spark, str(tmp_path))
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum") if before is None else spark.conf.set("spark.sql.files.minPartitionNum", before)
    db = duckdb.connect()
    db.sql(f"CREATE VIEW events AS SELECT * FROM read_parquet('{tmp_path}/events.parquet/*.parquet')")
    assert sorted(map(tuple, got.collect())) == sorted(db.sql(plans.oracle_sql()["stream_marks"]).fetchall())
