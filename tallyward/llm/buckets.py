"""Buckets of (sig, key) postings: which are shared, and which pairs of keys to hold against each other."""

from __future__ import annotations

from collections.abc import Callable
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import as_long, discard, end_to_end, materialize, mix
from .components import connected_components, tasks_for

PICKS = 3  # members of a bucket's component that others are held against
PER_RANGE = 400_000  # postings that a task looks through
PER_CHUNK = 1_000_000  # postings that a task packs at once
FEW = 64  # keys of a sig in a chunk that go to the sig's task


SKETCH = 16  # least 64-bit words of a parity sketch


def parity_sketches(hashes: np.ndarray, cuts: np.ndarray) -> pa.ListArray:
    """A sketch of each set hashes[cuts[i]:cuts[i+1]]. Bit b is the parity of the number of members hashed to b: two sketches
    differ in no more bits than the sets differ in members, which bounds the similarity of sets before any set moves. A
    sketch has a power of two of bits, as many as members at least; halves laid on each other give a sketch of half as many."""
    n = np.diff(cuts)
    bits = 64 * SKETCH << np.maximum(0, np.ceil(np.log2(np.maximum(n, 1) / (64 * SKETCH)))).astype(np.int64)
    ends = np.cumsum(bits)
    words = np.zeros(ends[-1] // 64 if len(n) else 0, np.int64)
    for at in range(0, len(n), 1024):
        to = min(len(n), at + 1024)
        low, high = ends[at] - bits[at], ends[to - 1]
        place = np.repeat(ends[at:to] - bits[at:to] - low, n[at:to]) + (hashes[cuts[at] : cuts[to]] & np.repeat(bits[at:to] - 1, n[at:to]).astype(np.uint64)).astype(np.int64)
        odd = np.bincount(place, minlength=high - low) & 1
        words[low // 64 : high // 64] = np.packbits(odd.astype(np.uint8)).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends // 64]).astype(np.int32)), pa.array(words))


def close(t: Fraction) -> Column:
    """What sets of Jaccard similarity >= t surely keep, by their sizes and sketches; x_ and y_ name the sides."""
    p, q = t.numerator, t.denominator
    x, y = F.col("x_sketch"), F.col("y_sketch")

    def fitted(a: Column, b: Column) -> Column:
        half = F.floor(F.size(a) / 2).cast("int")
        return F.when(F.size(a) > F.size(b), F.zip_with(F.slice(a, F.lit(1), half), F.slice(a, half + 1, half), lambda u, v: u.bitwiseXOR(v))).otherwise(a)

    differ = F.aggregate(F.zip_with(fitted(x, y), fitted(y, x), lambda u, v: F.bit_count(u.bitwiseXOR(v))), F.lit(0), lambda n, v: n + v)
    return (
        (F.least("x_n", "y_n") * q >= F.greatest("x_n", "y_n") * p)
        # |x ^ y| <= (n_x + n_y) (1 - t) / (1 + t); sketches whose lengths differ by more than one halving are not compared
        & ((F.greatest(F.size(x), F.size(y)) > 2 * F.least(F.size(x), F.size(y))) | (differ * (q + p) <= (F.col("x_n") + F.col("y_n")) * (q - p)))
    )


def shared_buckets(postings: DataFrame, rows: int) -> DataFrame:
    """A table of the distinct postings (sig long, key long) whose sig has two keys at least, by one range shuffle on (sig, key).

    Ranges part even the largest bucket, so none lands in one task. A task compares neighbours in sorted order; what it
    holds at its two ends may go on in the next range, so those buckets are handed on and counted once more.
    `postings` must be a table, as range bounds are sampled from it; `rows` is its size.
    """

    def neighbours(it):
        parts = [(b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False)) for b in it if b.num_rows]
        if not parts:
            return
        sig, key = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        del parts
        order = np.lexsort((key, sig))
        sig, key = sig[order], key[order]
        new = np.ones(len(sig), bool)
        new[1:] = (sig[1:] != sig[:-1]) | (key[1:] != key[:-1])
        sig, key = sig[new], key[new]
        same = sig[1:] == sig[:-1]
        keep = np.zeros(len(sig), bool)
        keep[1:] |= same
        keep[:-1] |= same
        edge = (sig == sig[0]) | (sig == sig[-1])
        at = np.flatnonzero(keep | edge)
        yield pa.RecordBatch.from_arrays([pa.array(sig[at]), pa.array(key[at]), pa.array(edge[at])], ["sig", "key", "edge"])

    n = max(1, -(-rows // PER_RANGE))
    n = max(n, int(postings.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))
    near = materialize(
        postings.select("sig", "key").repartitionByRange(n, "sig", "key").mapInArrow(neighbours, "sig long, key long, edge boolean"), "near"
    )
    edge = near.where("edge").select("sig", "key").distinct()  # two buckets a range at most begin or end there
    real = edge.groupBy("sig").agg(F.count("*").alias("n")).where("n > 1").select("sig")
    shared = materialize(near.where("not edge").select("sig", "key").unionByName(edge.join(real, "sig").select("sig", "key")), "shared")
    discard(near)
    return shared


def task_of(hashes: np.ndarray, n: int) -> np.ndarray:
    """Which of n tasks a hash belongs to: equal ranges of them, so that tasks stand in the order of hashes."""
    return ((hashes >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def pieces(kind: int, to: np.ndarray, *columns: np.ndarray) -> pa.RecordBatch:
    """A row for each task of `to`, which is in order: task, kind, and of each column what goes there, packed."""
    cuts = np.append(np.flatnonzero(np.diff(to, prepend=-1)), len(to))
    k = len(cuts) - 1
    packed = (pa.Array.from_buffers(pa.binary(), k, [None, pa.py_buffer((cuts * x.itemsize).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(x))]) for x in columns)
    return pa.RecordBatch.from_arrays([pa.array(to[cuts[:-1]].astype(np.int32)), pa.array(np.full(k, kind, np.int32)), *packed], ["task", "kind", *(f"c{i}" for i in range(len(columns)))])


def packed_buckets(postings: DataFrame, rows: int, chunk: int = PER_CHUNK, few: int = FEW, by_members: bool = False) -> DataFrame:
    """As shared_buckets, for postings in rows of (keys: array<long> or packed, sigs binary: of each key equally many, of 64
    bits), which are sent as packed numbers, a row for each task and chunk, instead of a row a posting.

    Sigs are hashes, so that equal ranges of them are equal shares for the tasks, but for large buckets: of a sig with more
    than `few` keys in a chunk these are dealt out by a hash of sig and key, and the sig's own task is told that it is
    shared. So a sig gives its task `few` postings (1 at least) a chunk at most.

    by_members: a bucket that is not large is named by a hash of its keys instead of its sig, so that buckets of the same keys,
    as the bands of near copies give them, are one. (Should two hashes agree, a bucket has the keys of both.)
    """
    n = max(1, -(-rows // PER_RANGE), int(postings.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))
    alone, spread, told = range(3)  # postings of the sig's own task; dealt out; sigs known as shared

    def dealt(sig: np.ndarray, key: np.ndarray):
        order = np.argsort(sig)
        sig, key = sig[order], key[order]
        heads = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
        size = np.diff(np.append(heads, len(sig)))
        if (size > few).any():
            many = np.repeat(size > few, size)
            s, k = sig[many], key[many]
            sig, key = sig[~many], key[~many]
            order = np.lexsort((k, s))  # repeated keys count once
            s, k = s[order], k[order]
            new = np.concatenate([[True], (s[1:] != s[:-1]) | (k[1:] != k[:-1])])
            s, k = s[new], k[new]
            own, size = np.unique(s, return_counts=True)
            own = own[size > few]
            yield pieces(told, task_of(own, n), own, np.zeros(len(own), np.uint64))
            many = np.repeat(size > few, size)
            yield pieces(alone, task_of(s[~many], n), s[~many], k[~many])
            s, k = s[many], k[many]
            to = task_of(mix(s ^ mix(k)), n)
            order = np.argsort(to)
            yield pieces(spread, to[order], s[order], k[order])
        yield pieces(alone, task_of(sig, n), sig, key)

    def packed(it):
        sigs, keys, held = [], [], 0
        for batch in it:
            key = batch.column(0)
            key = end_to_end(key, np.uint64)[0] if pa.types.is_binary(key.type) else key.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            sig = end_to_end(batch.column(1), np.uint64)[0]
            if len(key):
                sigs.append(sig)
                keys.append(np.repeat(key, len(sig) // len(key)))
                held += len(sig)
            if held >= chunk:
                yield from dealt(np.concatenate(sigs), np.concatenate(keys))
                sigs, keys, held = [], [], 0
        if held:
            yield from dealt(np.concatenate(sigs), np.concatenate(keys))

    def shared(it):
        found = ([], [], []), ([], [], [])
        for batch in it:
            for kind, *both in zip(batch.column(1).to_pylist(), batch.column(2), batch.column(3), strict=True):
                for side, x in zip(found, both, strict=True):
                    side[kind].append(np.frombuffer(x.as_buffer(), np.uint64))
        large = np.concatenate(found[0][told]) if found[0][told] else np.zeros(0, np.uint64)
        for kind in (alone, spread):
            if not found[0][kind]:
                continue
            sig, key = (np.concatenate(side[kind]) for side in found)
            if kind == alone:  # most sigs are there once
                order = np.argsort(sig)
                own = sig[order]
                keep = np.isin(own, large) if len(large) else np.zeros(len(own), bool)
                same = own[1:] == own[:-1]
                keep[1:] |= same
                keep[:-1] |= same
                order = order[keep]
                sig, key = sig[order], key[order]
            order = np.lexsort((key, sig))
            sig, key = sig[order], key[order]
            new = np.ones(len(sig), bool)
            new[1:] = (sig[1:] != sig[:-1]) | (key[1:] != key[:-1])
            sig, key = sig[new], key[new]
            heads = np.flatnonzero(np.diff(sig, prepend=~sig[:1]))
            size = np.diff(np.append(heads, len(sig)))
            vast = np.isin(sig[heads], large) if kind == alone else np.ones(len(heads), bool)
            keep = vast | (size > 1)
            if by_members and len(heads):
                name = np.where(vast, sig[heads], mix(np.add.reduceat(mix(key), heads) + size.astype(np.uint64)))
                once = np.zeros(len(heads), bool)
                once[np.unique(name, return_index=True)[1]] = True
                keep &= once
                sig = np.repeat(name, size)
            at = np.repeat(keep, size)
            yield pa.RecordBatch.from_arrays([pa.array(as_long(sig[at])), pa.array(as_long(key[at])), pa.array(np.repeat(vast, size)[at])], ["sig", "key", "large"])

    rows_of = postings.select("keys", "sigs").mapInArrow(packed, "task int, kind int, c0 binary, c1 binary")
    near = rows_of.repartitionById(n, "task").mapInArrow(shared, "sig long, key long, large boolean")
    if by_members:
        return materialize(near.select("sig", "key").distinct(), "shared")
    near = materialize(near, "near")
    large = near.where("large").select("sig", "key")
    if large.isEmpty():
        out = near.select("sig", "key")
        out.scratch_path = near.scratch_path
        return out
    # a posting of a large bucket may have come both ways
    out = materialize(near.where("not large").select("sig", "key").unionByName(large.distinct()), "shared")
    discard(near)
    return out


def bucket_components(
    shared: DataFrame, traits: DataFrame, whole: DataFrame, near: Callable[[], Column], linked: Callable[[DataFrame], DataFrame], light: bool = False
) -> DataFrame:
    """(node, component) by all links between keys that share a bucket; the smallest key of a component is left out.

    shared: (sig, key), distinct. traits: (key, ...), a row per key, on which near() works: an exact bound on columns
    x_<trait> and y_<trait> that every link keeps. whole: (key, ...) with all that linked() needs; linked(pairs with x, y and
    the columns x_<name> and y_<name> of whole): those that link, as (x, y). light: whole holds the traits and is small
    enough to move for pairs that near() will refuse.

    First each key is held against one other only, the most central of the leaders of its buckets (a bucket's leader is the
    member in the most buckets), then against the other leaders that are not in its component yet. What is left outside its
    leader's component is held against PICKS other members of the component, drawn by hashes, so that a member with many
    links to the component finds one of them. Members that are still outside are then held against all members of other
    components. A pair that is never compared is in one component already, so these are the components of all links in the
    buckets, while rows stay in proportion to the members of a bucket of near copies.
    """
    tasks = tasks_for(shared.count() * (4 if light else 1), shared.sparkSession)  # light: rows have all that linked() needs

    def sides(table: DataFrame):
        return (table.select(*[F.col(c).alias(s if c == "key" else f"{s}_{c}") for c in table.columns]) for s in "xy")

    def with_sides(pairs: DataFrame, table: DataFrame) -> DataFrame:
        x, y = sides(table)
        return pairs.join(x, "x").join(y, "y")

    def held(pairs: DataFrame, refused: bool = False) -> DataFrame:
        """Those of the pairs (x, y) that link. refused: what near() refuses is gone already."""
        if not light and not refused:
            pairs = with_sides(pairs, traits).where(near()).select("x", "y").coalesce(tasks)
        both = with_sides(pairs, whole)
        return linked((both.where(near()) if light and not refused else both).coalesce(tasks)).select("x", "y")

    def merged(old: DataFrame | None, new: DataFrame) -> DataFrame:
        """The forest of a forest and further links."""
        return connected_components(new if old is None else new.unionByName(old.select(F.col("node").alias("x"), F.col("component").alias("y"))), "x", "y")

    def of(forest: DataFrame, side: str) -> DataFrame:
        return forest.select(F.col("node").alias(side), F.col("component").alias(f"{side}_comp"))

    def tag(df: DataFrame, forest: DataFrame, *names: str) -> DataFrame:
        """df with <name>_comp, the component of each of the columns."""
        for name in names:
            df = df.join(of(forest, name), name, "left").withColumn(f"{name}_comp", F.coalesce(f"{name}_comp", name))
        return df.coalesce(tasks)

    ranked = shared.withColumn("rank", F.count("*").over(Window.partitionBy("key")))  # a key has no more buckets than its text gives
    leader = ranked.groupBy("sig").agg(F.max(F.struct("rank", "key")).alias("at"), F.count("*").alias("members")).select("sig", "at.rank", F.col("at.key").alias("leader"), "members")
    led = materialize(shared.join(leader, "sig").coalesce(tasks), "led")
    star = led.where("key != leader").groupBy(F.col("key").alias("x"))
    star = materialize(star.agg(F.sort_array(F.collect_set(F.struct("rank", "leader")), False)["leader"].alias("ys")).coalesce(tasks), "stars")
    forest = merged(None, held(star.select("x", F.col("ys")[0].alias("y"))))
    more = tag(star.select("x", F.explode(F.slice("ys", F.lit(2), F.size("ys"))).alias("y")), forest, "x", "y")
    old, forest = forest, merged(forest, held(more.where("x_comp != y_comp").select("x", "y")))
    discard(old, star)

    # what the leaders leave outside, against other members of their components; a bucket of two has no others
    tagged = materialize(tag(led.where("members > 2").drop("members"), forest, "key", "leader"), "tagged")
    out = materialize(tagged.where("key_comp != leader_comp").coalesce(tasks), "outside")
    if not out.isEmpty():
        picks = [F.max(F.struct(F.xxhash64("key", "sig", F.lit(r)), "key"))["key"] for r in range(PICKS)]
        inner = tagged.where("key_comp = leader_comp and key != leader").groupBy("sig").agg(F.array_distinct(F.array(*picks)).alias("picks"))
        drawn = out.join(inner, "sig").select(F.col("key").alias("x"), F.explode("picks").alias("y")).coalesce(tasks).distinct()
        old, forest = forest, merged(forest, held(drawn))
        discard(old)
        last = tag(led.drop("members").join(out.select("sig").distinct(), "sig", "left_semi"), forest, "key", "leader")  # other buckets are done
        last = materialize(last.join(traits, "key").coalesce(tasks), "tagged")
        x, y = sides(last)
        rest = (
            x.where("x_key_comp != x_leader_comp").join(y, F.col("x_sig") == F.col("y_sig"))
            .where("x_key_comp != y_key_comp and y != y_leader and (y_key_comp = y_leader_comp or x < y)")
            .where(near()).select("x", "y").coalesce(tasks).distinct().coalesce(tasks)
        )
        old, forest = forest, merged(forest, held(rest, refused=True))
        discard(old, last)
    discard(led, tagged, out)
    return forest
