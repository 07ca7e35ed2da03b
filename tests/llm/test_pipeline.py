"""The pipeline's stages: each against brute force over random near copies, and their edge cases."""

import random
import time
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallyward.llm import langid

from .test_near_duplicates import components, five_grams, line_set

STAGES = dict(corpus_pipeline.STAGES)
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus(seed):
    """Texts of two languages: with copies, near copies, shared lines, passages of benchmark, junk, nulls and repeats."""
    rng = random.Random(seed)
    word = lambda v: "".join(rng.choice("bdgklmnrst") + rng.choice(v) for _ in range(rng.randrange(1, 4)))
    items = [" ".join(word("aeiou") for _ in range(25)) for _ in range(3)]
    texts = []
    for i in range(60):
        v = "aeiou" if i % 2 else "äöüyø"
        texts.append("\n".join(" ".join(word(v) for _ in range(rng.randrange(4, 40))) for _ in range(rng.randrange(1, 5))))
    for _ in range(25):
        w = rng.choice(texts).split(" ")
        w[rng.randrange(len(w))] = word("aeiou")
        texts.append(" ".join(w))
    texts += [rng.choice(texts) for _ in range(8)] + [f"{word('aeiou')} {items[k]} {word('aeiou')}" for k in range(3)]
    for size in (37, 41, 60):  # the same words in other lines, which no line dedup takes out
        w = [word("aeiou") for _ in range(240)]
        for step in (60, size):
            texts.append("\n".join(" ".join(w[k : k + step]) for k in range(0, 240, step)))
            w[rng.randrange(240)] = word("aeiou")
    texts += ["", None, " \n", "12 34", "%%%", "Ab", "\u6f22" * 30]
    langs = ["xx" if i % 2 else "yy" for i in range(60)]
    rows = [(i, t, langs[i] if i < 60 else None, "s", len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], (None, texts[5], None, None, None), (None, "bada gulo keri " * 9, None, None, None)]
    return rows, items


@pytest.fixture(scope="module")
def given(spark, tmp_path_factory):
    rows, items = corpus(21)
    path = str(tmp_path_factory.mktemp("sf"))
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({"score": F.lit("kept"), "lang_pred": F.lit(1), "row": F.col("doc_id"), "key": F.lit("k"), "component": F.lit(2.5), "dropped": F.array(F.lit(0)), "bits": F.lit("b")})
    docs.coalesce(2).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return spark.read.parquet(f"{path}/documents.parquet"), path, items


def seen(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def test_every_stage_against_brute_force(spark, given, tmp_path):
    docs, path, items = given
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = [(r.doc_id, r.text) for r in docs.collect()]
        after = stage(spark, docs, path)
        assert after.columns == docs.columns
        after.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        got = seen(docs)
        if name == "language_id":  # the odd alphabet is in no learned language
            want = [(i, t) for i, t in before if t and re.search(r"[^\W\d_]", t) and "\u6f22" not in t]
        elif name == "line_dedup":
            want = lines_by_hand(before)
        elif name == "ngram_jaccard":
            sets = {k: five_grams(t) for k, (_, t) in enumerate(before)}
            comp = components(sets, lambda c, u: 10 * c >= 8 * u)
            groups = {}
            for k, (i, t) in enumerate(before):
                groups.setdefault(comp[k] if sets[k] else ("empty", k), []).append((i is None, i or 0, k))
            want = [before[min(g)[2]] for g in groups.values()]
            got, want = [(str(i), len(five_grams(t))) for i, t in got], sorted(((str(i), len(five_grams(t))) for i, t in want))
            got.sort()
        else:
            plain = [" ".join(x.split()) for x in items]
            want = [(i, t) for i, t in before if not any(x in " ".join((t or "").lower().split()) for x in plain)]
        assert got == (want if name == "ngram_jaccard" else sorted(want, key=str)), name
        assert len(got) < len(before) or name == "line_dedup"
        assert {tuple(r) for r in docs.select("score", "lang_pred", "bits").distinct().collect()} == {("kept", 1, "b")}


def lines_by_hand(before):
    """Of lines that links connect the first by (id, nulls last) stays; equal rows are told apart by any order of their own."""
    ordered = sorted(range(len(before)), key=lambda k: (before[k][0] is None, before[k][0] or 0, k))
    sets = {}
    for k in ordered:
        for line in (before[k][1] or "").split("\n"):
            if s := line_set(line):
                sets.setdefault(frozenset(s), s)
    keys = {k: n for n, k in enumerate(sets)}
    comp = components({n: s for n, s in enumerate(sets.values())}, lambda c, u: 10 * c >= 8 * u)
    used, out = set(), []
    for k in ordered:
        kept, solid = [], False
        text = before[k][1]
        for line in (text or "").split("\n"):
            s = line_set(line)
            if not s or comp[keys[frozenset(s)]] not in used:
                kept.append(line)
            if s:
                solid = True
                used.add(comp[keys[frozenset(s)]])
        if not solid or any(line_set(x) for x in kept):
            out.append((before[k][0], text if text is None else "\n".join(kept)))
    return out


def test_stages_of_no_rows(spark, given):
    docs, path, _ = given
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), path).count() == 0, name


def test_run_of_no_documents(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_texts_stay_where_no_language_is_known(spark, given):
    docs, path, _ = given
    kept = STAGES["language_id"](spark, docs.withColumn("lang", F.lit(None).cast("string")), path)
    assert kept.count() == docs.where(F.col("text").rlike(r"\p{L}")).count() > 60


def test_very_long_texts_pass_the_stages(spark, given, tmp_path):
    docs, path, _ = given
    rng = random.Random(4)
    long = " ".join("".join(rng.choice("bdgk") + rng.choice("aeiou") for _ in range(3)) for _ in range(120_000))
    rows = [(900, long, "xx", "s", len(long)), (901, long + " bada", "xx", "s", len(long)), (902, "gukidabo " * 90_000, "xx", "s", 1)]
    got = spark.createDataFrame(rows, SCHEMA)
    for name in STAGES:
        got = STAGES[name](spark, got, path)
        got.write.parquet(str(tmp_path / name))
        got = spark.read.parquet(str(tmp_path / name))
    assert sorted(r.doc_id for r in got.collect()) == [900, 902]


def test_outputs_need_names_of_their_own(spark, given):
    docs, _, _ = given
    with pytest.raises(ValueError, match="other names"):
        langid.predict(docs, langid.fit(docs), keep=("score",))


def test_half_a_million_lines_of_one_text(spark, tmp_path):
    """One text of many equal lines and many of its own: dropping takes time in proportion to the lines."""
    rng = random.Random(6)
    own = ["".join(rng.choices("bcdfghjklm", k=12)) for _ in range(100_000)]
    lines = [own[i // 5] if i % 5 == 0 else f"the same line no. {i % 3}" for i in range(500_000)]
    df = spark.createDataFrame([(1, "\n".join(lines), "xx", "s", 1), (2, "the same line no. 0\nanother one is here", "xx", "s", 1)], SCHEMA)
    spark.sparkContext.setLogLevel("ERROR")
    began = time.time()
    STAGES["line_dedup"](spark, df, "").write.parquet(str(tmp_path / "out"))
    assert time.time() - began < 150
    got = {r.doc_id: r.text.split("\n") for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got[2] == ["another one is here"]
    assert got[1][:1] == own[:1] and sum("the same" in x for x in got[1]) <= 3 and set(own) >= {x for x in got[1] if "the same" not in x} and len(got[1]) > 95_000
