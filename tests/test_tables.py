"""Merges, ranked groups, readers, pages, places and streams on small rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyward.functions.scalars import bill_key, display_name, iso_day, money, month_day_year, seat_district, vote_position
from tallyward.operators import aggregates, joins, merge, places, quality, web
from tallyward.plans import oracle_sql, queries
from tallyward.sources import readers, snapshot
from tallyward.functions.scalars import display_name
from tallyward.sources.readers import gazetteer
from tallyward.streaming.loads import above_mark, amend, replay


def test_merging_twice_is_merging_once(spark):
    t = spark.createDataFrame([(1, None, "a", 5), (2, "x", "b", 7)], "k int, n string, v string, g int")
    u = spark.createDataFrame([(1, None, None, 9), (3, None, "c", 1), (2, "y", "d", 2)], "k int, n string, v string, g int")
    policy = {"v": "coalesce_new", "g": "greatest"}
    once = merge.merge_keyed(t, u, ["k", "n"], policy)
    twice = merge.merge_keyed(once, u, ["k", "n"], policy)
    want = {(1, None, "a", 9), (2, "x", "b", 7), (3, None, "c", 1), (2, "y", "d", 2)}
    assert {tuple(r) for r in once.collect()} == want == {tuple(r) for r in twice.collect()}


def test_scalars(spark):
    rows = [("H.R. 8595", "HR-8595"), ("S.J.Res. 10", "SJRES-10"), ("PN11-22", None), (None, None)]
    assert [tuple(r) for r in spark.createDataFrame(rows, "k string, e string").select(bill_key(F.col("k")), "e").collect() if r[0] != r[1]] == []
    one = spark.range(1).select(
        month_day_year(F.lit("02032024")).alias("d"), month_day_year(F.lit("13992024")).alias("bad"), iso_day(F.lit("2024-02-03T10")).alias("i"), money(F.lit("1x")).alias("m"),
        vote_position(F.lit(" Not  Voting ")).alias("v"), seat_district(F.lit("H"), F.lit("7"), F.lit(9)).alias("s"), seat_district(F.lit("H"), F.lit("0"), F.lit(1)).alias("l"),
        display_name(F.lit("DOE, JANE")).alias("n"),
    ).first()
    assert tuple(one) == (dt.date(2024, 2, 3), None, dt.date(2024, 2, 3), None, "not_voting", "07", "00", "Jane Doe")


def test_top_sums_never_exceed_totals(spark):
    df = spark.createDataFrame([(g, i % 7, float(i)) for g in range(3) for i in range(40)], "g int, item int, amount double")
    top = aggregates.top_sums(df, ["g"], "item", "amount", 3)
    head = df.groupBy("g").agg(F.sum("amount").alias("all"))
    assert aggregates.reconcile(head, top, ["g"], "all", "total").where("not ok").count() == 0
    assert top.groupBy("g").count().where("count != 3").count() == 0


def test_pipe_file(spark, tmp_path):
    (tmp_path / "f.txt").write_bytes("A|caf\xe9 \"x\"|1\n\nB|only\n".encode("latin-1"))
    got = readers.read_pipe(spark, str(tmp_path / "f.txt"), ["a", "b", "c"]).collect()
    assert [tuple(r) for r in got] == [("A", 'café "x"', "1"), ("B", "only", None)]


def test_preamble_file(spark, tmp_path):
    (tmp_path / "c.txt").write_text("Some text\n\nCatcode\tCatname\tSector\nA1000\tCrops\tAgri\n\nB\tC\tD\n")
    got = readers.read_after_preamble(spark, str(tmp_path / "c.txt"), ["catcode", "catname"])
    assert got.columns == ["catcode", "catname", "sector"] and sorted(tuple(r) for r in got.collect()) == [("A1000", "Crops", "Agri"), ("B", "C", "D")]


def test_scan_observes_counts(spark):
    df, wanted = spark.range(100).withColumnRenamed("id", "k"), spark.createDataFrame([(3,), (5,), (500,)], "k long")
    rows, seen, kept = readers.scan_wanted(df, "k", wanted)
    assert rows.count() == 2 and kept.get["rows"] == 2 and seen.get["rows"] >= 2


HTML = """<nav><a href="/issues">Issues</a><a href='/issues#top'>again</a><a href="/contact/plan">Plan</a></nav>
<a href="https://www.a.example/about/">About <b>us</b></a><a href="mailto:x@a.example">mail</a><a href="https://b.example/plan">other</a>
<a href="/news/press-releases">News</a><a href="/x.pdf">plan</a><a href="/">home</a><script>"</p>"</script>"""


def test_links_and_frontier(spark):
    pages = spark.createDataFrame([(1, "https://a.example/", HTML), (2, None, None)], "page_id long, url string, html string")
    site = web.same_site(pages)
    assert [r.link for r in web.issue_links(site).orderBy("rank").collect()] == ["https://a.example/issues", "https://www.a.example/about"]
    assert [r.link for r in web.press_index(site).collect()] == ["https://a.example/news/press-releases"]
    got = web.frontier(pages.where("page_id = 1"), ("/issues", "/platform"), cap=5).orderBy("rank").collect()
    assert [r.origin for r in got][:2] == ["page", "issue"] and len({r.link for r in got}) == len(got) == 5
    asked = spark.createDataFrame([(3, "https://a.example/es/?utm=feed#top", "<p>no links</p>")], "page_id long, url string, html string")
    assert [(r.link, r.origin) for r in web.frontier(asked, ("/issues",)).orderBy("rank").collect()] == [("https://a.example/es/?utm=feed#top", "page"), ("https://a.example/es/issues", "probe")]


def test_anchor_moves_or_drops_labels(spark):
    segs = [(0, 0, 1, 0.0, 0.0, 1e5, 0.0), (0, 0, 2, 1e5, 0.0, 1e5, 1e5), (0, 0, 3, 1e5, 1e5, 0.0, 1e5), (0, 0, 4, 0.0, 1e5, 0.0, 0.0)]
    segs = spark.createDataFrame(segs, "state int, ring int, seq int, x1 double, y1 double, x2 double, y2 double")
    pts = spark.createDataFrame([(1, 0, 5e4, 5e4, 1e6), (2, 0, -1500.0, 5e4, 0.0), (3, 0, -50_000.0, 5e4, 1e12), (4, 1, 0.0, 0.0, 1.0)], "id int, state int, x double, y double, area double")
    got = {r.id: (r.placed, r.x) for r in places.anchor(pts, segs, "id").collect()}
    assert got[1][0] == "land" and got[2][0] == "inland" and 0 < got[2][1] < 7000 and got[3] == ("dropped", None) and got[4] == ("dropped", None)


def test_tiers_are_bounded(spark):
    df = spark.range(1000).select(F.lit("S").alias("s"), F.lit(300_000).alias("p"), F.col("id").alias("a"), "id")
    got = {r.tier: r.n for r in places.tiers(df, "s", "p", "a", "id").groupBy("tier").agg(F.count("*").alias("n")).collect()}
    assert got == {1: 25, 2: 55, 3: 220, 4: 700}


def test_expectations(spark):
    df = spark.createDataFrame([(1, 5), (1, None), (2, -1)], "k int, v int")
    assert {r.check: r.rows for r in quality.violations(df, {"positive": F.col("v") > 0, "small": F.col("v") < 3}).collect()} == {"positive": 1, "small": 1}
    assert quality.repeated_keys(df, ["k"]).count() == 1
    assert [(r.k, r.rows) for r in quality.dangling(df, "k", spark.createDataFrame([(2,)], "id int"), "id").collect()] == [(1, 2)]


def test_content_hash_ignores_order(spark, tmp_path):
    df = spark.range(50).withColumn("x", F.col("id") % 7)
    a, b = (snapshot.manifest({"t": d}).first() for d in (df, df.orderBy(F.desc("id"))))
    assert a == b
    written = snapshot.write_snapshot({"t": df}, str(tmp_path / "s")).first()
    assert written[:3] == a[:3] and written.bytes > 0
    with pytest.raises(ValueError, match="more than 10"):
        snapshot.write_snapshot({"t": df}, str(tmp_path / "s"), ceiling=10)


def test_stream_amends_and_repeats_change_nothing(spark, tmp_path):
    src = str(tmp_path / "in")
    spark.createDataFrame([(1, 1, "a"), (2, 2, "b")], "k int, seq int, v string").coalesce(1).write.parquet(src)
    read = lambda: spark.readStream.schema("k int, seq int, v string").parquet(src)
    fold = amend(["k"], {}, ["seq"])
    assert replay(spark, read(), str(tmp_path / "t"), fold, ["k"]).count() == 2
    spark.createDataFrame([(1, 3, "c")], "k int, seq int, v string").coalesce(1).write.mode("append").parquet(src)
    got = {tuple(r) for r in replay(spark, read(), str(tmp_path / "t"), fold, ["k"]).collect()}
    assert got == {(1, 3, "c"), (2, 2, "b")}
    assert {tuple(r) for r in replay(spark, read(), str(tmp_path / "t"), fold, ["k"]).collect()} == got


def test_batches_may_come_in_any_order(spark, tmp_path):
    """An older event that comes in a later batch does not take the newer one's place; old versions are deleted."""
    src, table = str(tmp_path / "in"), str(tmp_path / "t")
    fold, want = amend(["k"], {}, ["seq"]), {}
    for batch in ([(1, 9, "new"), (2, 1, "a")], [(1, 3, "old"), (3, 5, "c"), (None, 1, "n")], [(2, 2, "b"), (1, 9, "newest"), (None, 0, "o")], [(1, 1, "z")]):
        spark.createDataFrame(batch, "k int, seq int, v string").coalesce(1).write.mode("append").parquet(src)
        got = {tuple(r) for r in replay(spark, spark.readStream.schema("k int, seq int, v string").parquet(src), table, fold, ["k"], 3).select("k", "seq", "v").collect()}
        for k, seq, v in batch:
            if k not in want or (seq, v) >= want[k]:
                want[k] = (seq, v) if k not in want or seq > want[k][0] or v == "newest" else want[k]
        assert got == {(k, *x) for k, x in want.items()}
    kept = [p for p in (tmp_path / "t").glob("v*/bucket_of_key=*")]
    assert len(kept) <= 6  # three buckets, of two versions each at most


def test_one_of_equal_keys_does_not_hang_on_the_order(spark):
    rows = [(1, "b", 2), (1, "a", 9), (2, None, 1), (2, "x", None)]
    for df in (spark.createDataFrame(rows, "k int, v string, n int"), spark.createDataFrame(rows[::-1], "k int, v string, n int")):
        assert {tuple(r) for r in merge.one_each(df, ["k"]).collect()} == {(1, "b", 2), (2, "x", None)}
    old = spark.createDataFrame([("d1", "a"), ("d1", "b"), ("d2", "c")], "doc string, v string")
    new = spark.createDataFrame([("d1", "z")], "doc string, v string")
    assert {tuple(r) for r in merge.replace_groups(old, new, ["doc"]).collect()} == {("d1", "z"), ("d2", "c")}
    assert merge.replace_groups(old, new.limit(0), ["doc"], new).count() == 1


def test_hash_tells_repeated_rows_and_names(spark):
    one = spark.createDataFrame([(1, 2), (1, 2)], "a int, b int")
    hashes = {snapshot.manifest({"t": d}).first().content_hash for d in (one, one.limit(0), one.union(one), one.toDF("a", "c"), one.toDF("b", "a"))}
    assert len(hashes) == 5


def test_words_and_geoids_are_whole(spark):
    long = "x" * 3000
    df = spark.createDataFrame([(f"{long}, ANN", f"1600000US{'7' * 150}", "5")], "name string, geo_id string, value string")
    assert df.select(display_name(F.col("name"))).first()[0] == f"Ann X{'x' * 2999}"
    assert gazetteer(df, "1600000US").first().geoid == "7" * 150


def test_above_mark(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 5), ("b", 2)], "g string, n int")
    assert {tuple(r)[:2] for r in above_mark(rows, rows.where("g = 'a' and n = 1"), ["g"], "n").collect()} == {("a", 5), ("b", 2)}


def test_every_oracle_belongs_to_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_every_order_is_parsed_from_xml(spark, tmp_path):
    orders = spark.createDataFrame([(k, 100 + k % 7) for k in [*range(1, 41), 40]], "o_orderkey long, o_custkey long")
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    got = {(r.vote_number, r.vote, r.member, r.day) for r in queries()["xml_votes"](spark, str(tmp_path)).collect()}
    assert got == {x for k in range(1, 41) for x in ((k, "Yea", f"S{100 + k % 7}", "2024-02-03"), (k, "Not Voting", "S0", "2024-02-03"))}


def test_spans_leak_are_retained_or_are_novel(spark):
    gold = spark.createDataFrame([("d", 1, 0, 100, True), ("d", 2, 300, 400, False), ("d", 3, 700, 800, True), ("e", 1, 0, 100, False)], "doc string, id int, start int, end int, wanted boolean")
    found = spark.createDataFrame([("d", 1, 40, 120), ("d", 2, 350, 900), ("d", 3, 1000, 1010), ("e", 1, 60, 200), ("e", 2, 90, 95)], "doc string, id int, start int, end int")
    got = {tuple(r) for r in joins.span_outcomes(found, gold, "doc", 0.5).collect()}
    assert got == {("d", 1, "retained"), ("d", 2, "leaked"), ("d", 3, "retained"), ("d", 3, "novel"), ("e", 1, "leaked"), ("e", 1, "novel")}
