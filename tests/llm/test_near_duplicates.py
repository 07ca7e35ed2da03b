"""Operators 2 and 5 against brute force over all pairs."""

import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tallyward.llm import components as components_module
from tallyward.llm import jaccard, lines
from tallyward.llm.buckets import packed_buckets
from tallyward.llm.common import ROW, prefix_hash, span_hash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def components(sets, close):
    parent = {k: k for k in sets}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    names = sorted(sets)
    for i, a in enumerate(names):
        for b in names[:i]:
            if sets[a] and sets[b] and find(a) != find(b):
                common = len(sets[a] & sets[b])
                if close(common, len(sets[a]) + len(sets[b]) - common):
                    x, y = sorted((find(a), find(b)))
                    parent[y] = x
    return {k: find(k) for k in names}


def grams(text):
    w = WORD.findall((text or "").translate(FOLD))
    return {tuple(w[k : k + 3]) for k in range(len(w) - 2)} if len(w) >= 3 else {tuple(w)} if w else set()


def near_copies(seed, sizes, copies, rounds):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    out = []
    for _ in range(rounds):
        base = [rng.choice(vocabulary) for _ in range(rng.choice(sizes))]
        for _ in range(rng.choice(copies)):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
                w[rng.randrange(len(w))] = f"m{rng.randrange(40)}"
            out.append(" ".join(w))
    return out


def test_jaccard_components(spark):
    texts = near_copies(3, [1, 2, 3, 5, 11, 12, 14, 30, 80, 300], [1, 2, 6, 14], 40) + ["", None, " \n\t", "A b", "a B", "A\x0bb c"]
    docs = list(enumerate(texts))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    sets = {i: grams(t) for i, t in docs}
    want = components(sets, lambda c, u: 100 * c >= 90 * u)
    assert got == {i: (len(sets[i]), want[i]) for i, _ in docs}


def test_jaccard_nulls_repeats_and_clashing_columns(spark):
    rows = [(None, "a b c d", 1), (7, "a b c d", 2), (7, "a b c d", 3), (9, None, 4), (5, "x y z", 5), (None, "only null ids", 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row long").withColumn("key", F.lit(1)).withColumn("id", F.lit("z"))
    got = sorted(map(str, (tuple(r) for r in jaccard.jaccard_components(docs).collect())))
    assert got == sorted(map(str, [(None, 2, 7), (7, 2, 7), (7, 2, 7), (9, 0, 9), (5, 1, 5), (None, 1, None)]))


def test_jaccard_of_no_rows(spark):
    assert jaccard.jaccard_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def line_set(line):
    s = line.strip(" \t\x0b\x0c\r").translate(FOLD)
    return {s[i : i + lines.CHARS] for i in range(max(1, len(s) - lines.CHARS + 1))} if s else set()


def brute_dropped(docs):
    occur = [(i, n, line) for i, t in docs for n, line in enumerate((t or "").split("\n"))]
    sets = {}
    for _, _, line in occur:
        s = line_set(line)
        if s:
            sets.setdefault(frozenset(s), s)
    keys = {k: n for n, k in enumerate(sets)}
    comp = components({n: s for (k, n), s in zip(keys.items(), sets.values(), strict=True)}, lambda c, u: 10 * c >= 8 * u)
    seen, out = set(), {i: [] for i, _ in docs}
    for i, n, line in sorted(occur):
        s = line_set(line)
        if s:
            c = comp[keys[frozenset(s)]]
            if c in seen:
                out[i].append(n)
            seen.add(c)
    return out


def test_line_verdicts(spark):
    rng = random.Random(8)
    pool = near_copies(5, [4, 12, 25, 60], [1, 2, 5], 25) + ["", "  ", "Short", "short ", "éàü", "a\rb"]
    docs = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randrange(1, 9)))) for i in range(40)] + [(98, None), (99, "")]
    got = {r.doc_id: r for r in lines.line_verdicts(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    want = brute_dropped(docs)
    assert {i: r.dropped for i, r in got.items()} == want
    assert got[98].n_lines == 1 and got[0].n_lines == docs[0][1].count("\n") + 1


def test_drop_lines_keeps_columns_and_clean_rows(spark):
    rows = [(2, "same line here\nown words of two", 1), (1, "Same line here\n\nown words of one", 2), (3, "same line here", 3), (4, None, 4), (5, "", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, dropped long")
    got = {r.doc_id: (r.text, r.dropped) for r in lines.drop_lines(docs).collect()}
    assert got == {1: ("Same line here\n\nown words of one", 2), 2: ("own words of two", 1), 4: (None, 4), 5: ("", 5)}


def test_lines_of_no_rows(spark):
    assert lines.line_verdicts(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def _cut(rng, n, t):
    """A line and what is left of it without characters at its ends: as unlike as similarity t allows."""
    a = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n)).strip().ljust(n, "x")
    k = int((n - lines.CHARS + 1) * (1 - t) + 1e-9)
    front = rng.randrange(k + 1)
    return a, a[front : n - (k - front)]


def test_recall_by_length():
    """The share of pairs just at the threshold that share a band, for lines of 20 to 400 characters."""
    rng = random.Random(1)
    for n in (20, 40, 100, 400):
        for t in (0.8, 0.85, 0.9):
            pairs = [x for _ in range(1500) for x in _cut(rng, n, t)]
            data = np.frombuffer("".join(pairs).encode(), np.uint8)
            end = np.cumsum([len(x) for x in pairs])
            h, line = lines.shingles(data, end - [len(x) for x in pairs], end, prefix_hash(data))
            sig = lines.signatures(h, line, len(pairs))
            assert (sig[0::2] == sig[1::2]).any(1).mean() >= 0.98, (n, t)


def test_shingles_of_any_characters():
    """Each window of each line, where characters have one to four bytes, or one each; short lines are one shingle."""
    for texts in (["éàü xyz öäß 漢字かな交じり文 abc", "é", "abcdefgh", "", "𝄞𝄞𝄞𝄞𝄞𝄞𝄞𝄞𝄞𝄞"], ["abcdefghij", "abcdefgh", "", "abcdefghi"], ["a"], []):
        raw = [t.encode() for t in texts]
        data = np.frombuffer(b"".join(raw), np.uint8)
        end = np.cumsum([len(x) for x in raw]).astype(np.int64)
        h, line = lines.shingles(data, end - np.array([len(x) for x in raw], np.int64), end, prefix_hash(data))
        want = []
        for i, t in enumerate(texts):
            for k in range(max(1, len(t) - lines.CHARS + 1) if t else 0):
                own = np.frombuffer(t[k : k + lines.CHARS].encode(), np.uint8)
                want.append((int(span_hash(prefix_hash(own), np.array([0]), np.array([len(own)]))[0]), i))
        assert list(zip(h.tolist(), line.tolist(), strict=True)) == want


def test_packed_buckets(spark):
    """Sigs of one key, of few and of many, keys that repeat, and a large bucket of which other tasks hold a single posting."""
    rng = np.random.default_rng(6)
    some = rng.integers(-(1 << 63), 1 << 63, 40)
    rows = []
    for r in range(120):
        keys = rng.integers(-(1 << 63), 1 << 63, rng.integers(0, 9)) if r % 3 else rng.integers(0, 40, 5)
        sigs = rng.integers(-(1 << 63), 1 << 63, (len(keys), 3))
        sigs[:, 1] = some[rng.integers(0, 40, len(keys))]
        if 30 < r < 90 or r == 119:
            sigs[:, 2] = some[0]
        rows.append((keys.tolist(), bytearray(sigs.tobytes()), sigs.tolist()))
    of = {}
    for keys, _, sigs in rows:
        for k, own in zip(keys, sigs, strict=True):
            for s in own:
                of.setdefault(s, set()).add(k)
    want = sorted((s, k) for s, keys in of.items() if len(keys) > 1 for k in keys)
    df = spark.createDataFrame([r[:2] for r in rows], "keys array<long>, sigs binary").repartition(5).sortWithinPartitions("keys")
    for chunk, few in ((1_000_000, 64), (100, 64), (100, 4), (1, 1), (1_000_000, 1)):
        got = [tuple(r) for r in packed_buckets(df, 1000, chunk, few).select("sig", "key").collect()]
        assert sorted(got) == want, (chunk, few)
    assert packed_buckets(df.limit(0), 0).count() == 0


def test_postings_of_lines_are_packed(spark):
    """Fewer rows are shuffled than there are postings."""
    rng = random.Random(4)
    docs = [(i, "\n".join("".join(rng.choice("abcdefghij ") for _ in range(30)) for _ in range(50))) for i in range(100)]
    store, gateway = spark.sparkContext._jsc.sc().statusStore(), spark.sparkContext._gateway

    def shuffled():
        stages = store.stageList(None, False, False, gateway.new_array(gateway.jvm.double, 0), None)
        return {stages.apply(i).stageId(): stages.apply(i).shuffleWriteRecords() for i in range(stages.size())}

    before = shuffled()
    assert lines.line_verdicts(spark.createDataFrame(docs, "doc_id long, text string")).count() == 100
    assert sum(n for k, n in shuffled().items() if k not in before) < lines.BANDS * 5000


def test_lines_that_are_there_once_are_not_shuffled(spark):
    """Of lines without a copy or a near copy no row is shuffled for each."""
    rng = random.Random(5)
    docs = [(i, "\n".join("".join(rng.choice("abcdefghij ") for _ in range(30)) for _ in range(100))) for i in range(100)]
    store, gateway = spark.sparkContext._jsc.sc().statusStore(), spark.sparkContext._gateway

    def shuffled():
        stages = store.stageList(None, False, False, gateway.new_array(gateway.jvm.double, 0), None)
        return {stages.apply(i).stageId(): stages.apply(i).shuffleWriteRecords() for i in range(stages.size())}

    before = shuffled()
    assert lines.line_verdicts(spark.createDataFrame(docs, "doc_id long, text string")).count() == 100
    assert sum(n for k, n in shuffled().items() if k not in before) < 5000


def test_places_of_lines(spark):
    """Places of keys that repeat or are in a bucket, of each of the latter one that is asked for, however keys are dealt out."""
    rng = random.Random(7)
    rows, places = [], []
    for r in range(60):
        own = sorted(rng.sample(range(50), rng.randrange(9)))
        keys = [rng.choice([1, 1, 1, 2, 3]) * 0x9E3779B97F4A7C15 % (1 << 63) if rng.random() < 0.5 else rng.getrandbits(63) for _ in own]
        places += [(None if r == 5 else f"id{r}", r % 3, r, spot, key, key ^ 5) for spot, key in zip(own, keys, strict=True)]
        packed = (bytearray(np.array(x, t).tobytes()) for x, t in ((own, np.int32), (keys, np.int64), ([k ^ 5 for k in keys], np.int64)))
        rows.append((None if r == 5 else f"id{r}", (r % 3, r), *packed))
    read = spark.createDataFrame(rows, f"id string, row {ROW}, spots binary, lines binary, checks binary").repartition(4)
    count = Counter(p[4] for p in places)
    inside = {k for i, k in enumerate(sorted(count)) if i % 3 == 0 or count[k] > 20}
    shared = spark.createDataFrame([(1, k) for k in inside] + [(2, k) for k in inside], "sig long, key long")
    want = sorted((p for p in places if count[p[4]] > 1 or p[4] in inside), key=str)
    for chunk, few in ((1_000_000, 64), (20, 3), (1_000_000, 2), (1, 1)):
        got = lines._places(read, shared, len(places), chunk, few).collect()
        assert sorted(((r.id, r.row.file, r.row.at, r.line, r.key, r.check) for r in got), key=str) == want, (chunk, few)
        assert sorted(r.key for r in got if r.asked) == sorted(inside), (chunk, few)
    assert lines._places(read.limit(0), shared.limit(0), 0).count() == 0


def test_buckets_of_the_same_keys_are_one(spark):
    sigs = np.random.default_rng(3).integers(-(1 << 63), 1 << 63, 6)
    rows = [([1, 2], [[0, 1, 2], [0, 1, 3]]), ([3], [[0, 4, 2]]), ([9], [[5, 4, 5]])]  # {1, 2, 3}, {1, 2}, {3, 9} and {1, 3}
    df = spark.createDataFrame([(k, bytearray(sigs[s].tobytes())) for k, s in rows], "keys array<long>, sigs binary")
    again = spark.createDataFrame([([11, 12], bytearray(np.array([[7, 8, 10 << 40], [7, 8, 10 << 40]]).tobytes()))], df.schema)  # {11, 12}, thrice
    of = {}
    for r in packed_buckets(df.unionByName(again), 20, by_members=True).collect():
        of.setdefault(r.sig, []).append(r.key)
    assert sorted(sorted(k) for k in of.values()) == [[1, 2], [1, 2, 3], [1, 3], [3, 9], [11, 12]]
    of = packed_buckets(df.unionByName(again), 20, few=1, by_members=True).select("key").distinct().count()
    assert of == 6


def test_blanks_at_the_ends_of_lines():
    for n in (0, 1, 7, 8, 9, 40):
        texts = [" " * n + "é b" + "\t" * n, " " * n, "\n" + " " * n + "\na" + "\r" * n, "", "x" + " " * n + "\n"]
        raw = [t.encode() for t in texts]
        data = np.frombuffer(b"".join(raw), np.uint8)
        start, end, heads = lines.split_lines(data, np.cumsum([0, *map(len, raw)]))
        got = [data[a:b].tobytes().decode() for a, b in zip(start.tolist(), end.tolist(), strict=True)]
        assert got == [line.strip(" \t\r") for t in texts for line in t.split("\n")]
        assert heads.tolist() == np.cumsum([0, *(t.count("\n") + 1 for t in texts)]).tolist()


def test_components_in_many_forests(spark, monkeypatch):
    """Rounds of merging, with a hot node, long paths, loops, repeats and nulls."""
    monkeypatch.setattr(components_module, "FOREST", 40)
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(150)] + [(1000, 1001 + i) for i in range(200)] + [(rng.randrange(2000, 2300), rng.randrange(2000, 2300)) for _ in range(180)]
    edges += [(7, 7), (3, 4), (None, 5), (6, None)]
    rng.shuffle(edges)
    df = spark.createDataFrame(edges, "a long, b long").repartition(6)
    got = {r.node: r.component for r in components_module.connected_components(df).collect()}
    nodes = {x for e in edges if None not in e for x in e}
    parent = {x: x for x in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and find(a) != find(b):
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    assert got == {x: find(x) for x in nodes if find(x) != x}
    assert components_module.connected_components(df.limit(0)).count() == 0


def five_grams(text):
    w = WORD.findall((text or "").translate(FOLD))
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def test_keep_one_against_brute_force(spark):
    """The pipeline's own parameters: five words, 0.8."""
    rng = random.Random(12)
    texts = near_copies(4, [3, 5, 6, 9, 14, 40, 120, 400], [1, 2, 5, 12], 40)
    for _ in range(60):  # chains, whose ends are far apart
        w = rng.choice(texts).split()
        del w[rng.randrange(len(w)) : rng.randrange(len(w)) + 3]
        texts.append(" ".join(w))
    texts += ["", None, " \n", "A b", "a B"]
    docs = [(i % 270 if i % 11 else i, t, f"r{i}") for i, t in enumerate(texts)]
    df = spark.createDataFrame(docs, "doc_id long, text string, row string").withColumn("key", F.lit("clash")).withColumn("component", F.lit(1))
    kept = jaccard.keep_one(df, n=5, threshold="0.8")
    assert kept.columns == df.columns
    sets = {k: five_grams(t) for k, (_, t, _) in enumerate(docs)}
    comp = components(sets, lambda c, u: 10 * c >= 8 * u)
    groups = {}
    for k, (i, _, _) in enumerate(docs):
        groups.setdefault(comp[k] if sets[k] else ("empty", k), []).append(i)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(min(g) for g in groups.values())


def test_rows_are_the_same_at_any_parallelism(spark, tmp_path):
    """File splits that change between two reads change nothing."""
    rng = random.Random(2)
    texts = near_copies(9, [20, 60], [1, 3], 60)
    rows = [(i, t + "\n" + rng.choice(texts)) for i, t in enumerate(texts)] * 3
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(3).write.option("parquet.block.size", 2000).parquet(str(tmp_path / "docs"))

    def results(size, parallel):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", parallel)
        docs = spark.read.parquet(str(tmp_path / "docs"))
        made = [jaccard.keep_one(docs), lines.drop_lines(docs), lines.line_verdicts(docs)]
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")  # another split when the result is read
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", 2)
        return [sorted(map(str, df.collect())) for df in made]

    try:
        assert results("4k", 9) == results("128m", 1)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.leafNodeDefaultParallelism")


def test_very_long_texts(spark):
    rng = random.Random(3)
    long = " ".join(f"w{rng.randrange(9000)}" for _ in range(150_000))  # one line of about a megabyte
    docs = [(1, long), (2, long + " more words"), (3, "other\n" * 200_000), (4, "own words of this text")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in jaccard.jaccard_components(df).collect()} == {1: 1, 2: 1, 3: 3, 4: 4}
    got = {r.doc_id: len(r.dropped) for r in lines.line_verdicts(df).collect()}
    assert got == {1: 0, 2: 1, 3: 199_999, 4: 0}


def test_null_and_repeated_ids_of_lines(spark):
    rows = [(None, "the same line"), (7, "the same line"), (7, "the same line"), (9, None), (None, "a line of its own")]
    got = sorted((str(r.doc_id), r.dropped) for r in lines.line_verdicts(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == sorted([("None", [0]), ("7", []), ("7", [0]), ("9", []), ("None", [])])
