"""Operators 7 and 9 by held-out accuracy and against a plain reading of their definitions; the pipeline."""

import math
import pickle
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallyward.llm import langid, toxicity
from tallyward.llm.common import mix, prefix_hash, span_hash

VOWELS = {"xx": "aeiou", "yy": "äöüyø"}


def sample(rng, lang, n):
    return " ".join("".join(rng.choice("bdgklmnrst") + rng.choice(VOWELS[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def test_language_is_found_on_held_out_texts(spark):
    rng = random.Random(1)
    rows = [(i, sample(rng, lang, rng.choice([2, 8, 60])), lang) for i, lang in enumerate(["xx", "yy"] * 150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("clash"))
    trees = langid.fit(docs.where("doc_id < 200"))
    got = langid.predict(docs.where("doc_id >= 200"), trees, keep=("lang",))
    assert got.where("lang != lang_pred").count() == 0 and got.where("score < 0.5 or score > 1").count() == 0
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 !?"), (None, "ba ba"), (4, "é"), (5, "漢")], "doc_id long, text string")
    said = {r.doc_id: r.lang_pred for r in langid.predict(odd, trees).collect()}
    assert said[1] == said[2] == said[3] == "und" and said[None] == "xx" and "und" not in (said[4], said[5])
    none = langid.fit(docs.limit(0))
    assert {r.lang_pred for r in langid.predict(docs.limit(3), none).collect()} == {"und"}


def test_code_lengths_follow_the_definition():
    texts = {"a": ["abracadabra banana", "abab"], "b": ["xyzzy xyxy"]}
    counts = {}
    for lang, ts in texts.items():
        data = np.frombuffer("".join(ts).encode(), np.uint8)
        offsets = np.cumsum([0, *map(len, ts)])
        counts[lang] = np.unique(langid._grams(data, offsets), return_counts=True)
    trees = langid.Trees(counts)

    def plain(lang, text):
        tables = [{} for _ in range(langid.ORDER + 1)]
        total = [{} for _ in range(langid.ORDER + 1)]
        for l, ts in texts.items():
            for t in ts:
                t = " " * langid.ORDER + t
                for i in range(langid.ORDER, len(t)):
                    for k in range(langid.ORDER + 1):
                        ctx = t[i - k : i]
                        total[k][ctx] = total[k].get(ctx, 0) + 1
                        if l == lang:
                            node = tables[k].setdefault(ctx, {})
                            node[t[i]] = node.get(t[i], 0) + 1
        bits, t = 0.0, " " * langid.ORDER + text
        for i in range(langid.ORDER, len(t)):
            gone = set()
            top = next(k for k in range(langid.ORDER, -1, -1) if k == 0 or total[k].get(t[i - k : i], 0) >= langid.KEEP)
            for k in range(top, -1, -1):
                own = {c: n for c, n in tables[k].get(t[i - k : i], {}).items() if c not in gone} if k == 0 or total[k].get(t[i - k : i], 0) >= langid.KEEP else {}
                n, q = sum(own.values()), len(own)
                if t[i] in own:
                    bits -= math.log2(own[t[i]] / (n + q))
                    break
                if q:
                    bits -= math.log2(q / (n + q))
                gone |= set(own)
            else:
                bits += math.log2(256 - len(gone))
        return bits

    for text in ("abra", "xyzzy", "banana split", "q", "ab xy"):
        data = np.frombuffer(text.encode(), np.uint8)
        got = trees.lengths(data, np.array([0, len(data)]))[0]
        assert np.allclose(got, [plain(lang, text) for lang in trees.langs], atol=1e-3), text


def test_sixty_scripts_stay_small():
    """60 languages, each of 40 letters of its own: tables grow with the grams, and what is remembered has a bound."""
    rng = np.random.default_rng(5)
    counts, probes = {}, []
    for lang in range(60):
        letters = np.array([f"{chr(0x400 + 40 * lang + k)}".encode() for k in range(40)])
        rank = rng.permutation(40)
        weight = 1 / (1 + rank)
        make = lambda n: b"".join(np.concatenate([letters, [b" "]])[rng.choice(41, n, p=np.append(weight, 1) / (weight.sum() + 1))])  # noqa: B023, E731
        data = np.frombuffer(make(20_000), np.uint8)
        counts[f"l{lang:02}"] = np.unique(langid._grams(data, np.array([0, len(data)])), return_counts=True)
        probes.append(make(80))
    trees = langid.Trees(counts)
    grams = sum(len(kinds) for kinds, _ in counts.values())
    assert len(pickle.dumps(trees)) < 250 * grams  # a few numbers a gram; contexts x bytes x languages would be a thousand times that
    data = np.frombuffer(b"".join(probes), np.uint8)
    offsets = np.cumsum([0, *map(len, probes)])
    bits = trees.lengths(data, offsets)
    assert bits.argmin(1).tolist() == list(range(60))
    assert sum(x.nbytes for x in trees._remembered) <= langid.MEMORY
    assert np.array_equal(pickle.loads(pickle.dumps(trees)).lengths(data, offsets), bits)


def test_remembered_grams_change_nothing(monkeypatch):
    """Places that many grams share: each text by itself, and all in one go, cost what the tables say."""
    monkeypatch.setattr(langid, "MEMORY", 1 << 13)
    rng = np.random.default_rng(6)
    learned = [rng.integers(0, 256, 3000, dtype=np.uint8) & mask for mask in (0x3F, 0x7F, 0xFF)]
    trees = langid.Trees({str(i): np.unique(langid._grams(d, np.array([0, len(d)])), return_counts=True) for i, d in enumerate(learned)})
    data = np.concatenate([rng.integers(0, 256, 5000, dtype=np.uint8), learned[0], np.zeros(50, np.uint8), learned[2]])
    offsets = np.array([0, 7, 7, 4000, 8050, len(data)])
    code = langid._grams(data, offsets)
    want = np.stack([[trees._bits(t, code)[a:b].astype(float).sum() for a, b in zip(offsets, offsets[1:])] for t in trees.tables], 1)
    for _ in range(3):
        assert np.allclose(trees.lengths(data, offsets), want)
    assert len(trees._known) == 1 << 10


def test_toxicity_by_held_out_labels_and_sentences(spark):
    rng = random.Random(2)
    docs, labels = [], []
    for i in range(600):
        lines = [sample(rng, "xx", 6) + "." for _ in range(rng.randrange(1, 8))]
        toxic = i % 5 == 0
        if toxic:
            k = rng.randrange(len(lines))
            lines[k] = f"ba {rng.choice(['grobian', 'dummkopf'])} " + lines[k]
        docs.append((i, " ".join(lines)))
        labels.append((i, int(toxic)))
    d = spark.createDataFrame([*docs, (900, None), (901, ""), (None, "ba ba")], "doc_id long, text string").withColumn("score", F.lit("clash"))
    lab = spark.createDataFrame([*labels, (None, 1), (5, None)], "doc_id long, toxic int")
    model = toxicity.fit(d, lab.where("doc_id < 400"))
    got = {r.doc_id: r for r in toxicity.score(d, model, spans=True).collect()}
    held = [(got[i].score >= 0.5) == bool(y) for i, y in labels if i >= 400]
    assert sum(held) / len(held) > 0.97 and all(0 <= r.score <= 1 for r in got.values())
    hits = [s.sentence for i, y in labels if i >= 400 and y for s in got[i].sentences]
    assert hits and all("grobian" in s or "dummkopf" in s for s in hits)
    assert got[900].score == got[901].score < 0.5
    flat = toxicity.fit(d, lab.limit(0))
    assert {r.score for r in toxicity.score(d, flat).collect()} == {0.0}


def test_toxicity_scores_follow_the_definition(spark):
    """Every text by loops over its sentences and words, with the model's own weights."""
    rng = random.Random(9)
    words = ["bad", "grobian", "grobianisch", "été", "ÀÉ", "fine", "Longerword1", "x"]
    texts = ["".join(rng.choice([*words, " ", " ", ". ", "!", "\n", "|", ", ", "?"]) + rng.choice(["", " "]) for _ in range(rng.randrange(0, 40))) for _ in range(200)] + [None, "", "...", "word " * 200_000]
    model = toxicity.Model(np.array([rng.gauss(0, 1) for _ in range(1 << toxicity.BITS)]).astype(np.float32), -1.5, 0.03)

    def place(word, stem):
        data = np.frombuffer(word, np.uint8)
        h = span_hash(prefix_hash(data), np.array([0]), np.array([len(word)]))
        return int((mix(h) if stem else h)[0] >> np.uint64(64 - toxicity.BITS))

    def plain(text):
        keep = 1 - model.leak
        for sentence in re.split(rb"[.!?\n|]", text.encode()):
            found = re.findall(rb"[0-9a-z\x80-\xff]+", sentence.lower())
            if found:
                places = {place(w, False) for w in found} | {place(w[: toxicity.STEM], True) for w in found if len(w) > toxicity.STEM}
                keep *= 1 - min(1 / (1 + math.exp(-(model.bias + sum(float(model.weights[p]) for p in places)))), 1 - 1e-12)
        return 1 - keep

    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.score for r in toxicity.score(df, model).collect()}
    assert len(got) == len(texts) and all(math.isclose(got[i], plain(t or ""), abs_tol=1e-9) for i, t in enumerate(texts))
    assert toxicity.score(df.limit(0), model).count() == 0
    clash = toxicity.score(df.withColumn("held", F.lit(1)).withColumn("__x", F.lit(2)), model, keep=("held",))
    assert clash.columns == ["doc_id", "held", "score"]
    taken = df.withColumn("Score", F.lit("mine")).withColumn("text_in", F.lit(2))
    with pytest.raises(ValueError, match="other names"):
        toxicity.score(taken, model, keep=("Score",))
    other = toxicity.score(taken, model, keep=("Score", "text_in"), spans=True, outputs=("toxicity", "found"))
    assert other.columns == ["doc_id", "Score", "text_in", "toxicity", "found"] and {r.doc_id: r.toxicity for r in other.collect()} == got


def test_pipeline_stages(spark, tmp_path):
    rng = random.Random(7)
    base = [sample(rng, "xx", 30) + ".\n" + sample(rng, "xx", 40) + "." for _ in range(30)]
    near = sample(rng, "xx", 200).split()
    other = [*near[:100], "zz", *near[101:]]
    item = sample(rng, "xx", 20)
    rows = [(i, t, "xx", "s", len(t)) for i, t in enumerate(base)]
    rows += [(40, base[0], "xx", "s", 1), (41, " ".join(near), "xx", "s", 1), (42, "\n".join([" ".join(other[:60]), " ".join(other[60:])]), "xx", "s", 1), (43, "12 34", "xx", "s", 5), (44, None, None, None, None), (45, "ba " + item + " ba", "xx", "s", 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    seen, columns = [], docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        path = str(tmp_path / name)
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
        seen.append({r.doc_id for r in docs.select("doc_id").collect()})
        assert name == "bpe_tokens" or docs.columns == columns
    everyone = set(range(30)) | {40, 41, 42, 43, 44, 45}
    assert everyone - seen[0] == {43, 44} and seen[0] - seen[1] == {40} and seen[1] - seen[2] == {42} and seen[2] - seen[3] == {45} and seen[3] == seen[4]
    got = {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert got == seen[4]
