"""Loading: rejects with reasons, routing in order, and a model whose failures stay with their rows."""

import pandas as pd
from pyspark.sql import functions as F

from tallyward.operators import intake, joins


def test_transactions_and_rejects(spark):
    raw = [
        ("1", "C1", "R1", "P1", "24K", "10.50", "02032024", " A "), ("2", "C9", "R1", "P1", "24E", "7", "99999999", ""), ("3", "C1", "R1", "P9", "24K", "1", "02032024", "x"),
        ("4", "C1", "R1", "P1", "24K", "1x", "02032024", "x"), ("5", None, None, "P1", "15", "-3", None, None),
    ]
    names = "sub_id string, cmte_id string, other_id string, cand_id string, kind string, amount string, day string, name string"
    good, bad = intake.transactions(spark.createDataFrame(raw, names), spark.createDataFrame([("P1", 11)], "cand_id string, candidacy int"), spark.createDataFrame([("C1",)], "cmte_id string"))
    assert {r.sub_id: r.reason for r in bad.collect()} == {"3": "no_target", "4": "bad_amount"}
    got = {r.sub_id: (float(r.amount), r.day and str(r.day), r.contributor, r.contributor_id, r.recipient_id) for r in good.collect()}
    assert got == {"1": (10.5, "2024-02-03", "A", "C1", "R1"), "2": (7.0, None, None, None, None), "5": (-3.0, None, None, None, None)}


def test_routing_gives_the_first_reason(spark):
    rows = [
        (1, "a", "P", "AA", "1", 2026), (2, "a", "H", "AA", "1", 2024), (3, "a", "H", "ZZ", "1", 2026), (4, "a", "H", "AA", "9", 2026), (5, "a", "S", "BB", None, 2026),
        (6, "a", "H", "AA", "1", 2026), (7, "a", "H", "AA", "01", 2026), (8, "b", "S", "AA", None, 2026), (9, "c", "H", "BB", None, 2026),
    ]
    df = spark.createDataFrame(rows, "id int, person string, office string, state string, district string, year int")
    seats = spark.createDataFrame([("AA", 3), ("BB", 1)], "state string, seats int")
    senate = spark.createDataFrame([("AA", 2)], "state string, class int")
    got = {r.id: (r.skip_reason, r.district, r["class"]) for r in intake.route_candidates(df, 2026, seats, senate).collect()}
    assert [got[i][0] for i in range(1, 10)] == ["office", "year", "territory", "district", "senate", None, "duplicate", None, None]
    assert got[6][1] == "01" and got[8][2] == 2 and got[9][1] == "00"
    assert intake.races(seats, senate).count() == 5


def test_a_bad_row_costs_only_itself(spark):
    def model(prompts: pd.Series) -> pd.Series:
        if (prompts == "bad").any():
            raise ValueError("no answer")
        return prompts.str.upper()

    df = spark.createDataFrame([(1, "a"), (2, "bad"), (3, "c")], "id long, prompt string").coalesce(1)
    got = {r.id: (r.answer, r.error) for r in intake.ask_model(df, model, "id").collect()}
    assert got == {1: ("A", None), 2: (None, "ValueError: no answer"), 3: ("C", None)}


def test_overlaps_are_found_once(spark):
    a = [(1, i, i * 37, i * 37 + n) for i, n in enumerate((10, 300, 700, 5, 90))]
    b = [(1, i, i * 41, i * 41 + n) for i, n in enumerate((300, 20, 256, 600))] + [(2, 9, 0, 50)]
    names = "doc int, id int, start int, end int"
    got = sorted((r.a_id, r.b_id, r.chars) for r in joins.overlapping(spark.createDataFrame(a, names), spark.createDataFrame(b, names), "doc").collect())
    want = []
    for _, i, s, e in a:
        for d, j, t, f in b:
            n = min(e, f) - max(s, t)
            if d == 1 and n > 0 and n >= 0.5 * min(e - s, f - t):
                want.append((i, j, n))
    assert got == sorted(want)


def test_optional_filters_and_stale_stamps(spark):
    df = spark.createDataFrame([("AA", 1, "v1"), ("BB", 2, None)], "state string, n int, version string")
    assert joins.optional_filter(df, state="ALL", n=None).count() == 2 and joins.optional_filter(df, state="BB").count() == 1
    assert [r.n for r in df.where(joins.stale(df, {"version": "v1"})).collect()] == [2]
    assert df.select(F.count_if(joins.stale(df, {"version": "v2"}))).first()[0] == 2
