"""Snapshots that are seen whole or not at all, and menus of roll calls."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallyward.folders import files
from tallyward.sources import readers, snapshot


def test_a_failed_snapshot_leaves_the_one_before(spark, tmp_path):
    path = str(tmp_path / "s")
    with pytest.raises(FileNotFoundError):
        snapshot.published(spark, path)
    first = snapshot.publish({"a": spark.range(3), "b": spark.range(5)}, path)
    assert {(r.table, r.rows) for r in first.collect()} == {("a", 3), ("b", 5)} and first.where("bytes > 0 and content_hash is not null").count() == 2
    broken = spark.range(1).select(F.raise_error(F.lit("lost")).cast("long").alias("id"))
    with pytest.raises(PySparkException):
        snapshot.publish({"a": spark.range(100), "b": broken}, path)  # a is written, b fails
    assert snapshot.published(spark, path, "a").count() == 3
    with pytest.raises(ValueError, match="not published: unscreened"):
        snapshot.publish({"a": spark.range(100)}, path, {"unscreened": spark.range(1), "fine": spark.range(0)})
    with pytest.raises(ValueError, match="more than 10"):
        snapshot.publish({"a": spark.range(100)}, path, ceiling=10)
    assert snapshot.published(spark, path, "b").count() == 5
    for n in (7, 8, 9):
        snapshot.publish({"a": spark.range(n)}, path)
        assert snapshot.published(spark, path, "a").count() == n
    system, where = files(spark, f"{path}/versions")
    assert len(system.listStatus(where)) == 2  # what failed, and all but two versions, went


def test_one_writer_wins_a_number(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "s")
    snapshot.publish({"a": spark.range(1)}, path)
    stale = snapshot._commits(spark, path)
    snapshot.publish({"a": spark.range(2)}, path)
    monkeypatch.setattr(snapshot, "_commits", lambda *_: stale)  # a writer that has not seen the second commit
    with pytest.raises(Exception, match="exist"):
        snapshot.publish({"a": spark.range(3)}, path)
    monkeypatch.undo()
    assert snapshot.published(spark, path, "a").count() == 2


def test_a_dead_marker_counts_as_none(spark, tmp_path):
    path = str(tmp_path / "s")
    snapshot.publish({"a": spark.range(1)}, path)
    system, marker = files(spark, f"{path}/commits/00000002")
    system.create(marker, False).close()
    assert snapshot.published(spark, path, "a").count() == 1


def test_menu_and_details(spark, tmp_path):
    (tmp_path / "m.xml").write_text(
        "<vote_summary><votes><vote><vote_number>00012</vote_number><issue> H.R.\n 5 </issue><result>Passed</result></vote><vote><issue>no number</issue></vote>"
        "<vote><vote_number>13</vote_number></vote><vote><vote_number>14</vote_number></vote><vote><vote_number>12</vote_number></vote></votes></vote_summary>"
    )
    menu = readers.vote_menu(spark, str(tmp_path / "m.xml"))
    assert sorted((r.number, r.issue or "", r.result or "") for r in menu.collect()) == [(12, "", ""), (12, "H.R. 5", "Passed"), (13, "", ""), (14, "", "")]
    detail = "<roll_call_vote><vote_number>{}</vote_number><members><member><lis_member_id>S1</lis_member_id><vote_cast>Yea</vote_cast></member></members></roll_call_vote>"
    details = spark.createDataFrame([(n, detail.format(n)) for n in (12, 13, 99)], "number int, payload string")
    got = readers.new_roll_calls(menu, details, spark.createDataFrame([(13,)], "number int"))
    assert [(r.vote_number, r.member, r.vote) for r in got.collect()] == [(12, "S1", "Yea")]


def test_a_large_group_is_packed_in_pieces(spark):
    rows = [("hot" if i % 3 else "b", i, None if i % 50 == 0 else i * 2) for i in range(1000)] + [("hot", 7, -1), ("hot", None, 3), (None, -1, 4)]
    df = spark.createDataFrame(rows, "g string, k long, v long")
    whole = {r.g: (r.k, r.v) for r in snapshot.pack_columns(df, "g", "k", ["k", "v"]).collect()}
    got = snapshot.pack_columns(df, "g", "k", ["v", "k"], span=64).collect()
    assert got[0].__fields__ == ["g", "piece", "v", "k"] and max(len(r.k) for r in got) <= 64
    for g in ("hot", "b", None):
        pieces = sorted((r for r in got if r.g == g), key=lambda r: (r.piece is not None, r.piece))
        assert ([x for r in pieces for x in r.k], [x for r in pieces for x in r.v]) == whole[g]
        assert all(x // 64 == r.piece for r in pieces for x in r.k if x is not None)
    assert snapshot.pack_columns(df.limit(0), "g", "k", ["k", "v"], span=64).count() == 0
