"""Operators 11, 12 and 13 against brute force."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyward.llm import centroids, divergence, onebit


def floats(v):
    return [float(np.float32(x)) for x in v]


def brute_clusters(rows, k, rounds, dims):
    kept = [(i, [max(-(2**63), min(2**63 - 1, math.floor(1024 * x))) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    named = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))
    c = [v for _, v in named[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, w, strict=True)), i) for i, w in enumerate(c))

    for _ in range(rounds):
        own = [near(v)[1] for _, v in kept]
        for i in set(own):
            group = [v for (_, v), o in zip(kept, own, strict=True) if o == i]
            c[i] = [sum(x) // len(group) for x in zip(*group, strict=True)]
    got = [(i, *near(v)) for i, v in kept]
    inertia = Counter()
    for _, d, i in got:
        inertia[i] += d
    most = 2**63 - 1
    return [(i, o, min(most, d), min(most, inertia[o]), min(most, sum(inertia.values())), hashlib.sha256(",".join(map(str, c[o])).encode()).hexdigest()) for i, d, o in got]


@pytest.mark.parametrize("size,k,rounds", [(1.0, 8, 10), (1.0, 40, 3), (2.0**20, 8, 4), (2.0**60, 5, 3)])
def test_clusters(spark, size, k, rounds):
    rng = random.Random(11)
    spots = [[rng.uniform(-1, 1) for _ in range(6)] for _ in range(12)]
    rows = [(i, floats(size * (s + rng.gauss(0, 0.1)) for s in rng.choice(spots))) for i in range(300)]
    rows += [(i, rows[0][1]) for i in range(300, 450)]  # a third of all rows is one vector
    rows += [(7, rows[3][1]), (7, rows[4][1]), (None, rows[5][1]), (500, None), (501, []), (502, [1.0] * 5), (503, [1.0] * 7), (504, [1.0] * 5 + [None]), (505, [float("nan")] * 6), (506, [float("inf")] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({"cluster": F.lit("clash"), "v": F.lit(1)}).repartition(5)
    got = centroids.cluster(df, k=k, rounds=rounds, dims=6)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, brute_clusters(rows, k, rounds, 6)))


def test_clusters_of_ties_and_few_rows(spark):
    rows = [(i, [float(x), float(y)]) for i, (x, y) in enumerate([(x, y) for x in range(7) for y in range(7)])]  # many equal distances
    for part in (rows, rows[:3], rows[:1]):
        got = centroids.cluster(spark.createDataFrame(part, "vec_id long, embedding array<double>"), k=8, rounds=3, dims=2)
        assert sorted(map(tuple, got.collect())) == sorted(brute_clusters(part, 8, 3, 2))
    none = centroids.cluster(spark.createDataFrame([], "vec_id long, embedding array<float>"))
    assert none.count() == 0 and none.dtypes == got.dtypes


def test_tree_prunes(spark):
    rng = np.random.default_rng(0)
    c = rng.integers(-50, 50, (200, 2))
    tree = centroids.VantageTree(c.tolist())
    x = rng.integers(-60, 60, (500, 2))
    who, far = tree.nearest(x)
    d = ((x[:, None] - c[None]) ** 2).sum(2)
    assert (who == d.argmin(1)).all() and (far == d.min(1)).all()


def inner(v, w):
    """In the order of the components; Python's sum() would make up for rounding."""
    total = 0.0
    for a, b in zip(v, w):
        total += a * b
    return total


def brute_nearest(rows, is_query, k):
    kept = [(n, i, v) for n, (i, v) in enumerate(rows) if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = []
    for n, q, v in kept:
        if is_query(q):
            best = sorted((-inner(v, w), i) for m, i, w in kept if m != n)[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return out


def test_nearest(spark):
    rng = random.Random(12)
    rows = [(i, floats(rng.gauss(0.2, 1) for _ in range(40))) for i in range(900)]
    rows += [(i, rows[20][1]) for i in range(1000, 1300)]  # copies of one vector, ties
    rows += [(40, rows[7][1]), (60, rows[9][1][:10]), (None, rows[0][1]), (2000, None), (2020, []), (2040, [0.0] * 40), (2060, [1.0, None]), (2080, [float("nan")] * 40), (2100, [float("-inf")] * 40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({"row": F.lit("clash"), "score": F.lit(1), "shard": F.lit(0)}).repartition(5)
    got = {tuple(r) for r in onebit.nearest(df, F.col("vec_id") % 20 == 0, k=20).collect()}
    want = brute_nearest(rows, lambda i: i % 20 == 0, 20)
    assert len(got & set(want)) >= 0.99 * len(set(want))
    by_id = {}
    for i, v in rows:
        by_id.setdefault(i, []).append(v)
    for q, _, i, s in got:  # exact scores of original vectors, with no row as its own neighbour
        assert any(s == inner(v, w) for v in by_id[q] for w in by_id[i])
    assert not any(q == i for q, _, i, _ in got if len(by_id[q]) == 1)


def test_nearest_of_few_rows(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0, 3.0]), (20, [-1.0])], "vec_id long, embedding array<double>")
    assert sorted(map(tuple, onebit.nearest(df, F.col("vec_id") % 20 == 0).collect())) == [(0, 1, 1, 2.0), (0, 2, 20, -1.0), (20, 1, 0, -1.0), (20, 2, 1, -2.0)]
    assert onebit.nearest(df.limit(0), F.col("vec_id") == 0).count() == 0


def test_bounds_hold_and_choose(spark):
    """Estimates are off by more than the bound in few cases, and the bound leaves most vectors out."""
    rng = np.random.default_rng(1)
    x = rng.standard_normal((4000, 64))
    turn = onebit.rotation(64, 256)
    codes, length, align = onebit.encode(x, x.mean(0), turn)
    import pyarrow as pa

    table = pa.table({"v": pa.array(x.tolist()), "id": range(4000), "file": [0] * 4000, "at": range(4000), "length": length, "align": align, "code": [c.tobytes() for c in codes]})
    shard = onebit.Codes(table, x.mean(0), turn)
    off, left = [], []
    for q in x[:50]:
        estimate, bound = shard.bounds(q)
        off.append(np.mean(np.abs(x @ q - estimate) > bound))
        left.append(np.mean(estimate + bound >= np.sort(x @ q)[-20]))
    assert np.mean(off) < 0.005 and np.mean(left) < 0.15


def brute_divergence(rows, least, top):
    rows = [tuple("" if x is None else x for x in r) for r in rows]
    terms = [(lang, source, re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))) for text, lang, source in rows]
    out = []
    for lang in {r[1] for r in rows}:
        df, whole, groups = Counter(), Counter(), {}
        for la, source, ws in terms:
            if la == lang:
                df.update(set(ws))
                whole.update(ws)
                groups.setdefault(source, Counter()).update(ws)
        kept = [t for t in df if df[t] >= least]

        def shares(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 5) // (total + 5 * len(kept)) for t in kept}

        p, q = {s: shares(c) for s, c in groups.items()}, shares(whole)
        for s in groups:
            pairs = sorted((-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode()) for o in groups if o != s)
            out += [(lang, s, "pair", o.decode(), -v, r + 1) for r, (v, o) in enumerate(pairs)]
            more = sorted((q[t] - p[s][t], t.encode()) for t in kept if groups[s][t] and p[s][t] > q[t])[:top]
            out += [(lang, s, "term", t.decode(), -v, r + 1) for r, (v, t) in enumerate(more)]
    return sorted(out)


@pytest.mark.parametrize("chunk,block", [(16_384, 32), (40, 3)])
def test_divergence(spark, monkeypatch, chunk, block):
    monkeypatch.setattr(divergence, "CHUNK", chunk)
    monkeypatch.setattr(divergence, "BLOCK", block)
    monkeypatch.setattr(divergence, "SLAB", 50)
    rng = random.Random(13)
    vocabulary = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)] + ["Straße", "ÉTÉ", "été", "日本", "😀x", "naïve", "THE", "The", "it's"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    rows = []
    for i in range(600):
        source = f"s{i % 9}" if i % 3 else "hot"
        rows.append((rng.choice([" ", "\n", "-", "1"]).join(rng.choices(vocabulary, weights, k=rng.randint(1, 60))), rng.choice(["en", "en", "de", None]), source))
    rows += [(None, "en", "void"), ("", "en", "ünd"), ("\u0000a\u007fb", "en", "s1"), ("wort", "one", "alone"), ("rare", "two", "a"), ("words", "two", "b"), ("x", None, None), (rows[0][0] * 300, "en", "s2")]
    df = spark.createDataFrame(rows, "text string, lang string, source string").withColumns({"term": F.lit("clash"), "n": F.lit(1), "words": F.lit(0)}).repartition(5)
    got = sorted(map(tuple, divergence.source_divergence(df, least_docs=5, top=10).collect()))
    assert got == brute_divergence(rows, 5, 10)


def test_divergence_of_no_rows(spark):
    assert divergence.source_divergence(spark.createDataFrame([], "text string, lang string, source string")).count() == 0
