"""Quotes: verification arms, the gate's rules, chunks, evidence."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from tallyward import plans
from tallyward.operators import evidence, gate, text
from tallyward.plans.text import QUOTES

DOC = "I will fight.\nWe’ll   protect “our”  water – always. The end, and I will vote no."


def test_gate_gives_the_expected_reason(spark):
    df = spark.createDataFrame(QUOTES, "expected string, quote string").withColumn("g", gate.screen(F.col("quote")))
    assert [(r.quote, r.g.reason) for r in df.collect() if r.g.reason != r.expected] == []


@pytest.mark.parametrize("quote", [None, "", "   "])
def test_gate_drops_empty_quotes_as_fragments(spark, quote):
    r = spark.createDataFrame([(quote,)], "q string").select(gate.screen(F.col("q")).alias("g")).first().g
    assert (r.keep, r.reason) == (False, "fragment")


def test_leaving_a_rule_out_never_keeps_fewer(spark):
    df = spark.createDataFrame(QUOTES, "expected string, quote string")
    kept = lambda **o: df.where(gate.screen(F.col("quote"), **o)["keep"]).count()
    base = kept()
    assert all(kept(disabled=(r,)) >= base for r in gate.RULES)
    assert kept(escape=False) <= base


def test_quote_verification_arms(spark):
    docs = spark.createDataFrame([(1, DOC), (2, None)], "doc long, text string")
    rows = [
        (1, "exact", "I will fight.", 0, 0, 13), (1, "relocated", "The end", 0, 3, 9), (1, "normalized", "We'll protect \"our\" water - always.", 0, 0, 5),
        (1, "rejected", "never said", 0, 0, 5), (1, "rejected", "", 0, 0, 0), (1, "rejected", None, 0, 0, 0), (2, "rejected", "x", 0, 0, 1), (1, "relocated", "I will fight.", 0, -5, 3),
        (1, "normalized", " . ", 0, 0, 1), (1, "exact", "fight", 5, 2, 7),
    ]
    quotes = spark.createDataFrame(rows, "doc long, expected string, quote string, offset int, quote_start int, quote_end int")
    got = text.verify_quotes(quotes, docs, "doc").collect()
    assert [(r.quote, r.method) for r in got if r.method != r.expected] == []
    for r in got:
        if r.method in ("exact", "relocated"):
            assert DOC[r.start : r.end] == r.quote
        elif r.method == "normalized":
            assert DOC[r.start : r.end].startswith("We’ll   protect") or DOC[r.start : r.end] == "."
        else:
            assert (r.start, r.end) == (-1, -1)


@pytest.mark.parametrize("n", [0, 1, 99, 100, 101, 180, 181, 1000])
def test_chunks_cover_the_text(spark, n):
    body = "".join(chr(97 + i % 26) for i in range(n))
    got = text.chunk_text(spark.createDataFrame([(body,)], "t string"), "t", 100, 20).orderBy("chunk_no").collect()
    covered = set()
    for r in got:
        assert body[r.chunk_offset : r.chunk_offset + 100] == r.chunk
        covered |= set(range(r.chunk_offset, r.chunk_offset + len(r.chunk)))
    assert covered == set(range(n))


def test_prose_defects(spark):
    rows = [("Wait, HR 99999 is new.", ["HR-1"], ["scratchpad", "impossible_bill_number"]), (" ", [], ["empty"]), ("HR 1234 passed.", ["HR-1234"], []), (None, None, ["empty"])]
    df = spark.createDataFrame(rows, "p string, k array<string>, e array<string>")
    assert [r for r in df.withColumn("d", evidence.prose_defects(F.col("p"), F.col("k"))).collect() if r.d != r.e] == []


def test_direction(spark):
    rows = [("yea", "advances", "supports"), ("nay", "advances", "contradicts"), ("nay", "reverses", "supports"), ("present", "advances", "contextual"), (None, "advances", "contextual")]
    df = spark.createDataFrame(rows, "p string, e string, d string")
    assert df.where(evidence.direction(F.col("p"), F.col("e")) != F.col("d")).count() == 0


def _odd_texts(n: int) -> list[str]:
    """Sentences of rule words that touch letters, marks and blanks beyond ASCII."""
    rng = random.Random(11)
    words = ["Ining", "doómi", "élan", "ñi will", "I", "we", "will", "think", "ſhould", "shoulſd", "must be", "THINK", "Tİon ", "ceİling", "ſpring", "bring", "hope to", "Óis running to", "Ana believes", "is", "do", "ünis", "call our office",
             "said", "he", "’ll", "éi’ll", "my first", "b", "¤", "§", "†", "It’s past time", "x²", "日本", "would have", "and", "Maria is a lifelong", "not working on the", "endeavour", "Kelly favors"]
    blanks = [" ", " ", " ", " ", " ", "\x0b", "\u0085", "\t", "\r", ". ", ", ", "", " ", "́"]
    return ["".join(rng.choice(words) + rng.choice(blanks) for _ in range(rng.randint(1, 12))) + rng.choice(["", ".", "!", "”", " ", " "]) for _ in range(n)]


@pytest.mark.parametrize("name", ["gate_sentences", "gate_screen", "gate_ablation"])
def test_gate_agrees_with_its_sql_beyond_ascii(spark, tmp_path, name):
    texts = [(i, t) for i, t in enumerate(_odd_texts(3000))] + [(3000, " Ining onnt, erou eahean El osll rrbo doómi con la cióncióndo que arco."), (3001, None), (3002, "")]
    tables = {
        "documents": spark.createDataFrame(texts, "doc_id long, text string"), "labels": spark.createDataFrame([(i, i % 2, 0) for i, _ in texts], "doc_id long, quality int, toxic int"),
        "conversations": spark.createDataFrame([(i, t) for i, t in texts if i % 3 == 0], "conv_id long, text string"),
    }
    db = duckdb.connect()
    for table, df in tables.items():
        df.write.parquet(f"{tmp_path}/{table}.parquet")
        db.sql(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{tmp_path}/{table}.parquet/*.parquet')")
    got = plans.queries()[name](spark, str(tmp_path))
    want = db.sql(f"SELECT {', '.join(got.columns)} FROM ({plans.oracle_sql()[name]})").fetchall()
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_sentences_that_repeat_a_pattern_need_no_deep_stack(spark, tmp_path):
    """Sentences of thousands of words that a pattern repeats, which ended the JVM, and of very many blanks."""
    texts = ["and, " * 20_000 + "I really think so", "I " + "really " * 20_000 + "think", "we " + "don't " * 9_000, "a" * 100_000 + "ing here", "xx " + " \t" * 40_000 + "y", "by " + "so, so\u00a0" * 9_000 + "end!"]
    tables = {"documents": spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "conversations": spark.createDataFrame([(1, texts[0])], "conv_id long, text string")}
    db = duckdb.connect()
    for table, df in tables.items():
        df.write.parquet(f"{tmp_path}/{table}.parquet")
        db.sql(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{tmp_path}/{table}.parquet/*.parquet')")
    got = plans.queries()["gate_sentences"](spark, str(tmp_path))
    want = db.sql(f"SELECT {', '.join(got.columns)} FROM ({plans.oracle_sql()['gate_sentences']})").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want) and "hedged_opinion" in {w[0] for w in want}


def test_every_item_of_a_residue_is_looked_for(spark, tmp_path):
    items = [(i, f"the item of number {i:03d}") for i in range(200)]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(1, "before. the item of number 041, after"), (79, None), (80, items[160][1])], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = [r for r in plans.queries()["quote_verification"](spark, str(tmp_path)).collect() if r.item_id >= 0]
    assert sorted((r.doc_id, r.item_id) for r in got) == [(d, i) for d in (1, 79, 80) for i in range(d % 40, 200, 40)]
    assert {(r.doc_id, r.item_id): r.method for r in got if r.method != "rejected"} == {(1, 41): "relocated", (80, 160): "exact"}
