"""Small operators of reports and intake: websites, totals, bill paths, coverage, membership, capture."""

import json

from pyspark.sql import functions as F

from tallyward.functions.scalars import split_bill_key
from tallyward.operators import aggregates, merge
from tallyward.sources import readers


def test_declared_sites(spark):
    c = lambda i, d, w: {"committee_id": i, "designation": d, "website": w}
    payload = {"results": [c("C0", "U", "a.example"), c("C1", "P", "none"), c("C2", "A", " Www.A.example/ "), c("C3", "P", "https://www.a.example"), c(None, "P", "b.example"), c("C4", "P", None), c("C5", "P", "b.example/x")]}
    df = spark.createDataFrame([(1, json.dumps(payload)), (2, '{"results": []}'), (3, None), (4, "no json")], "k int, payload string")
    got = sorted(tuple(r) for r in readers.declared_sites(df, "k").collect())
    assert got == [(1, "C2", "Www.A.example/", "https://www.a.example"), (1, "C5", "b.example/x", "https://b.example/x")]


def test_totals(spark):
    rows = [('{"candidate_id": "S1", "cycle": 2026, "receipts": 10.005, "last_debts_owed_by_committee": 3, "coverage_end_date": "2026-03-31T00:00:00"}',), ("{}",)]
    got = readers.finance_totals(spark.createDataFrame(rows, "payload string")).collect()
    assert [(str(r.receipts), str(r.debts_owed), r.cash_on_hand, str(r.coverage_end)) for r in got] == [("10.01", "3.00", None, "2026-03-31"), ("None", "None", None, "None")]


def test_bill_paths(spark):
    rows = [("HR-8595", ("hr", 8595)), ("sjres-7", ("sjres", 7)), ("PN-1", None), ("HR", None), ("HR-", None), ("HR-1-2", None), ("S-x", None), (None, None)]
    got = spark.createDataFrame([(k,) for k, _ in rows], "k string").select("k", split_bill_key(F.col("k")).alias("b")).collect()
    assert {(r.k, tuple(r.b) if r.b else None) for r in got} == set(rows)


def test_vote_report_and_coverage(spark):
    votes = spark.createDataFrame([("a", "yea", "2024-01-02"), ("a", "nay", "2024-03-01"), ("a", None, None), ("b", "other", None)], "m string, position string, day string")
    assert sorted(map(tuple, aggregates.vote_report(votes, ["m"]).collect())) == [("a", 3, 1, 1, 0, 0, "2024-03-01"), ("b", 1, 0, 0, 0, 0, None)]
    people = spark.createDataFrame([(1, "X", "house", "01"), (2, "X", "house", "01"), (3, "X", "house", None), (4, "Y", "house", None), (5, "Z", "senate", None)], "person int, state string, office string, district string")
    assert tuple(aggregates.coverage_totals(people, spark.createDataFrame([(2,), (5,), (5,), (99,)], "person int")).first()) == (5, 3, 2, 3, 1)
    assert tuple(aggregates.coverage_totals(people.limit(0), spark.createDataFrame([], "person int")).first()) == (0, 0, 0, 0, 0)


def test_any_member(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (None, "c"), (1, "c")], "x int, y string")
    got = aggregates.any_member(df, x=spark.createDataFrame([(1,), (1,)], "x int"), y=spark.createDataFrame([("c",), (None,)], "y string"))
    assert got.columns == ["x", "y"] and sorted(map(repr, got.collect())) == sorted(map(repr, df.where("x = 1 or y = 'c'").collect()))


def test_capture_gives_one_id(spark):
    none = spark.createDataFrame([], "source_id string, kind string, content_hash string")
    rows = spark.createDataFrame([("page", "x"), ("page", "x"), ("bill", "x"), ("page", None), (None, "x")], "kind string, payload string")
    stored, named = merge.captured(none, rows)
    assert stored.count() == 4 and named.count() == 5 and named.select("source_id").distinct().count() == 4
    again, same = merge.captured(stored, rows.unionByName(spark.createDataFrame([("page", "y")], rows.schema)))
    assert again.count() == 5 and same.join(stored, "source_id", "left_anti").count() == 1
