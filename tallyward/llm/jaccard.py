"""Operator 2: joins of texts by the Jaccard similarity of their word n-grams, with vertical partitioning.

A text's distinct n-grams are hashed to 64 bits; the order of the hashes is the global order. For a class of set sizes
with largest size N, two sets of the class that link differ in at most D = floor(N * 2(1-t)/(1+t)) grams. The order is
cut at F = D + 1 + S fragments for that class, so two linked sets agree exactly in S + 1 fragments at least: sets that share
the contents of a fragment are candidates, all others are not. Of these S + 1, at most as many are empty as either set has
empty fragments; so a set with S of them or fewer is found by its others, and leaves the empty ones out, which many sets
share. S is such that nearly all sets do. For small D the order is cut at D + m fragments instead, of which m agree: every
choice of m is then looked up as one, m such that hardly any set has m empty fragments. Overlaps of the candidates are
counted fragment by fragment and summed per pair.

Equal sets are one class from the start. buckets.py says how a bucket (class, fragment, contents) of near copies is
worked through without all its pairs and without losing a link.

Sets are named by a 64-bit sum over their grams' hashes together with their size, and checked by another one wherever equal
names put rows together. `docs` is read twice; common.with_rows names its rows alike at both reads.
Defined cases: null or blank text has an empty set and links with nothing (its component is its own id); fewer than n
words give one gram of the whole sequence; rows with null ids take part and never give the component's id unless all ids
of the component are null; repeated rows are copies; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common
from .buckets import bucket_components, close, parity_sketches, shared_buckets
from .common import LOWER, ROW, as_long, free_name, materialize, mix, prefix_hash, span_hash, text_slices, with_rows

PARTS = 8  # vertical fragments in which overlaps of candidate pairs are counted
_GROWTH = Fraction(5, 4)  # ratio of neighbouring size classes


def gram_sets(column: pa.Array, n: int, fold: bool = True) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, sorted distinct gram hashes of all rows of a slice, offsets by row)."""
    for first, data, offsets in text_slices(column):
        data = LOWER[data] if fold else data
        start, end, heads = common.words(data, offsets)
        w = span_hash(prefix_hash(data), start, end)
        counts = np.diff(heads)
        doc = np.repeat(np.arange(len(counts)), counts)
        if n > 1 and len(w) >= n:
            m = len(w) - n + 1
            g = np.zeros(m, np.uint64)
            for k in range(n):
                g = mix(g * np.uint64(0x9E3779B97F4A7C15) + w[k : k + m])
            inside = doc[:m] == doc[n - 1 :]
            g, owner = g[inside], doc[:m][inside]
        elif n == 1:
            g, owner = w, doc
        else:
            g, owner = w[:0], doc[:0]
        few = np.flatnonzero((counts > 0) & (counts < n))
        if len(few):
            extra = np.empty(len(few), np.uint64)
            for i, d in enumerate(few):
                h = np.array([counts[d]], np.uint64)
                for x in w[heads[d] : heads[d + 1]]:
                    h = mix(h * np.uint64(3) + x)
                extra[i] = h[0]
            g, owner = np.concatenate([g, extra]), np.concatenate([owner, few])
        order = np.lexsort((g, owner))
        g, owner = g[order], owner[order]
        new = np.ones(len(g), bool)
        new[1:] = (g[1:] != g[:-1]) | (owner[1:] != owner[:-1])
        g, owner = g[new], owner[new]
        yield first, g, np.searchsorted(owner, np.arange(len(counts) + 1))


def _sums(values: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    c = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=c[1:])
    return c[cuts[1:]] - c[cuts[:-1]]


def size_classes(t: Fraction, most: int = 1 << 40) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """The largest size of each class, and (fragments F, fragments m that are looked up together, spare fragments S). Sizes
    that allow no difference come first: those sets link if equal."""
    slack = 2 * (1 - t) / (1 + t)
    first = int(1 / slack) + (0 if (1 / slack).denominator == 1 else 1)
    tops, cuts = [max(1, first) - 1], [(1, 1, 0)]
    while tops[-1] < most:
        low = tops[-1] + 1
        tops.append(max(low, int(tops[-1] * _GROWTH)))
        differ, m, s = int(tops[-1] * slack), 1, 0
        if differ <= 10:
            while (differ / (differ + m)) ** low > (1e-4 if differ <= 4 else 1e-3) and math.comb(differ + m + 1, m + 1) <= 200:
                m += 1
        else:  # a set at the class's lower end has three deviations more than the mean of empty fragments at most
            while (f := differ + 1 + s) * 2 < low and s < (mean := f * math.exp(-low / f)) + 3 * math.sqrt(mean) and mean > 0.01:
                s += max(1, s // 8)
        cuts.append((differ + m + s, m, s))
    return np.array(tops), cuts


def _keys(g: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, check) of each set: two sums of 64 bits."""
    size = mix(np.diff(cuts).astype(np.uint64))
    return mix(_sums(mix(g), cuts) + size), mix(_sums(mix(g ^ np.uint64(0x5851F42D4C957F2D)), cuts) + size)


def _set_rows(n: int, t: Fraction):
    tops, cut = size_classes(t)
    choices = [np.array(list(combinations(range(f), m))) if m > 1 else None for f, m, _ in cut]

    def rows(it):
        for batch in it:
            for first, g, cuts in gram_sets(batch.column(2), n):
                sizes = np.diff(cuts)
                key, check = _keys(g, cuts)
                # the size class of a set, and that of the largest partner it may have
                low = np.searchsorted(tops, sizes)
                high = np.searchsorted(tops, (sizes * t.denominator) // t.numerator)
                sig_all, sig_cuts = [], [0]
                for d in range(len(sizes)):
                    a = g[cuts[d] : cuts[d + 1]]
                    own = []
                    for c in range(max(1, low[d]), high[d] + 1) if sizes[d] else ():
                        f, m, spare = cut[c]
                        at = np.searchsorted(a >> np.uint64(32), (np.arange(1, f, dtype=np.uint64) << np.uint64(32)) // np.uint64(f))
                        at = np.concatenate([[0], at, [len(a)]])
                        s = mix(_sums(mix(a ^ np.uint64(0xA5A5A5A5A5A5A5A5)), at) + mix(np.arange(f, dtype=np.uint64) + np.uint64(c << 40)))
                        if m > 1:
                            s = mix(s[choices[c]].sum(1, dtype=np.uint64))
                        elif f - np.count_nonzero(at[1:] > at[:-1]) <= spare:
                            s = s[at[1:] > at[:-1]]
                        own.append(s)
                    sig_all += own
                    sig_cuts.append(sig_cuts[-1] + sum(map(len, own)))
                flat = np.concatenate(sig_all) if sig_all else np.zeros(0, np.uint64)
                k = len(sizes)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, k),
                        batch.column(1).slice(first, k),
                        pa.array(sizes.astype(np.int64)),
                        pa.array(as_long(key), mask=sizes == 0),
                        pa.array(as_long(check), mask=sizes == 0),
                        pa.ListArray.from_arrays(pa.array(np.array(sig_cuts, np.int32)), pa.array(as_long(flat))),
                    ],
                    ["id", "row", "n_shingles", "key", "check", "sigs"],
                )

    return rows


def _fragment_rows(n: int):
    """For the texts of candidate sets: key, check, size, parity sketch, and the grams by vertical fragment."""

    def rows(it):
        for batch in it:
            for first, g, cuts in gram_sets(batch.column(1), n):
                k = len(cuts) - 1
                keys = batch.column(0).slice(first, k)
                key, check = _keys(g, cuts)
                if keys.to_pylist() != as_long(key).tolist():
                    raise ValueError("docs gave other rows when read again; write it to a table first")
                owner = np.repeat(np.arange(k), np.diff(cuts))
                inner = np.concatenate([[0], np.cumsum(np.bincount(owner * PARTS + (g >> np.uint64(61)).astype(np.int64), minlength=k * PARTS))])
                parts = pa.ListArray.from_arrays(pa.array(inner.astype(np.int32)), pa.array(as_long(g)))
                yield pa.RecordBatch.from_arrays(
                    [
                        keys,
                        pa.array(as_long(check)),
                        pa.array(np.diff(cuts).astype(np.int64)),
                        parity_sketches(g, cuts),
                        pa.ListArray.from_arrays(pa.array(np.arange(k + 1, dtype=np.int32) * PARTS), parts),
                    ],
                    ["key", "check", "n", "sketch", "parts"],
                )

    return rows


def _linked(pairs: DataFrame, t: Fraction) -> DataFrame:
    """The pairs (x, y) that link: partial overlaps of each vertical fragment, summed per pair."""
    partial = [F.size(F.array_intersect(F.col("x_parts")[k], F.col("y_parts")[k])) for k in range(PARTS)]
    total = pairs.select("x", "y", "x_n", "y_n", reduce(Column.__add__, partial).alias("common"))
    return total.where(F.col("common") * t.denominator >= (F.col("x_n") + F.col("y_n") - F.col("common")) * t.numerator)


def _similar(rows: DataFrame, n: int, threshold: str) -> DataFrame:
    """For rows (id, row, text), read alike each time: id, row, n_shingles, key and check (null: an empty set), and label,
    which is the same for the rows of a component."""
    t = Fraction(threshold)
    common.ship(rows.sparkSession)
    id_type = rows.schema["id"].dataType.simpleString()
    wide = materialize(
        rows.mapInArrow(_set_rows(n, t), f"id {id_type}, row {ROW}, n_shingles long, key long, check long, sigs array<long>"), "sets"
    )
    postings = wide.select("key", F.explode("sigs").alias("sig"))
    shared = shared_buckets(postings, wide.agg(F.coalesce(F.sum(F.size("sigs")), F.lit(0))).first()[0])
    all_sets = materialize(wide.drop("sigs"), "sets")
    common.discard(wide)
    # one text of each set in them
    needed = shared.select("key").distinct()
    sample = all_sets.where("key is not null").groupBy("key").agg(F.min("row").alias("row")).join(needed, "key")
    texts = rows.select("row", "text").join(sample.hint("merge"), "row").select("key", "text")  # a side that grows is not broadcast
    sets = materialize(
        texts.mapInArrow(_fragment_rows(n), "key long, check long, n long, sketch array<long>, parts array<array<long>>"), "fragments"
    )
    forest = bucket_components(shared, sets.select("key", "n", "sketch"), sets.select("key", "n", "parts"), lambda: close(t), lambda pairs: _linked(pairs, t))
    known = sets.select("key", "check").join(forest.withColumnRenamed("node", "key"), "key", "left").select("key", "check", F.coalesce("component", "key").alias("component"))
    # sets beside the buckets, and any that share a key but not its check, are components of their own
    label = F.struct(F.coalesce("component", "key").alias("key"), F.when(F.col("component").isNull(), F.col("check")).otherwise(0).alias("check"))
    found = all_sets.select("id", "row", "n_shingles", "key", "check").join(known, ["key", "check"], "left")
    found = materialize(found.select("id", "row", "n_shingles", "key", "check", F.when(F.col("key").isNotNull(), label).alias("label")), "similar")
    common.discard(all_sets, shared, sets, forest)
    return found


def similar_sets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 3, threshold: str = "0.9") -> DataFrame:
    """A row per row of docs: the id column, n_shingles, set (null for an empty set) and component, structs of two longs;
    component is the same for texts that links of similarity >= threshold connect, directly or through others."""
    found = _similar(_rows(docs, id_col, text_col), n, threshold)
    return found.select(F.col("id").alias(id_col), "n_shingles", F.when(F.col("key").isNotNull(), F.struct("key", "check")).alias("set"), F.col("label").alias("component"))


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    row = free_name(docs, "row")
    return with_rows(docs, row).select(F.col(id_col).alias("id"), F.col(row).alias("row"), F.col(text_col).alias("text"))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 3, threshold: str = "0.9") -> DataFrame:
    """A row per row of docs: the id column, n_shingles and component_id, the smallest id that links reach."""
    found = _similar(_rows(docs, id_col, text_col), n, threshold)
    # a table of its own, so that the join deals both sides anew and adaptive execution can split a hot component
    smallest = materialize(found.where("label is not null").groupBy("label").agg(F.min("id").alias("component_id")), "smallest")
    return found.join(smallest, "label", "left").select(
        F.col("id").alias(id_col), "n_shingles", F.when(F.col("label").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id")
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, threshold: str = "0.8") -> DataFrame:
    """docs without all rows but one of each component; the one with the smallest id (nulls last, then by row) stays, and
    so do all rows with an empty set. Columns stay."""
    name = free_name(docs, "row")
    base = with_rows(docs, name)
    found = _similar(base.select(F.col(id_col).alias("id"), F.col(name).alias("row"), F.col(text_col).alias("text")), n, threshold)
    some = found.where("label is not null")
    at = F.struct(F.col("id").isNull().alias("none"), "id", "row")
    kept = materialize(some.groupBy("label").agg(F.min(at)["row"].alias("kept"), F.count("*").alias("n")).where("n > 1").drop("n"), "kept")
    gone = materialize(some.join(kept, "label").where("row != kept").select(F.col("row").alias(name)), "gone")
    common.discard(found, kept)
    return base.join(gone, name, "left_anti").select(*docs.columns)
