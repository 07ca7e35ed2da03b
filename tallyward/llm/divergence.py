"""Operator 13: how the sources of a language differ in their words, by count-level bitmaps.

A term that a group (language, source) uses n times has the smoothed share p = 1 + floor(scale * (n + smooth) / (N + smooth * V)).
The distance of two groups sums |p - q| over all V kept terms. As p depends on the count only, a group is stored as one bitset
of term numbers for each of its counts. Two groups' joint cell (a, b), the number of terms with count a here and b there, is
the popcount of the AND of two bitsets; it is multiplied by |p(a) - p(b)|. Cells with a zero count have no bitset: they are
what the group's own bitsets, or the vocabulary, leave over.

Terms are numbered within chunks of about CHUNK terms (a hash of the term), the commonest first, so that terms of like counts
share a word of 64 bits; bitsets keep only words that are not empty. Sources are dealt to blocks of about BLOCK by a hash. A
task takes one chunk and one pair of blocks, and gives a partial sum for each pair of sources; these are summed. All numbers
are whole, so that no order of additions matters.

Defined cases: null text, lang and source count as ''; groups without kept terms have the count zero everywhere; a language
without kept terms has distances of 0 and no term rows; a language with one source has no pair rows; repeated rows count each;
no rows give no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, materialize, ship

CHUNK = 16_384
BLOCK = 32
SLAB = 1 << 16
BREAKS = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"  # ASCII but its letters: what stands between terms
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences, and documents of the group that hold the term. Each document gives its terms
    and once more its distinct terms, so that one aggregate, combined before the shuffle, counts both."""
    # lower() would change letters beyond ASCII too; where there are none, it is the faster one
    plain = F.when(F.octet_length("text") == F.length("text"), F.lower("text")).otherwise(F.translate("text", UPPER, LOWER))
    words = docs.select("lang", "source", F.split(plain, BREAKS).alias("words"))
    each = words.select("lang", "source", F.size("words").alias("size"), F.posexplode(F.concat("words", F.array_distinct("words"))).alias("at", "term"))
    own = F.col("at") < F.col("size")
    return each.where(F.col("term") != "").groupBy("lang", "source", "term").agg(F.count_if(own).alias("n"), F.count_if(~own).alias("docs"))


def _joint(smooth: int, scale: int):
    """The kernel of a tile: partial distances of all its pairs of sources over one chunk of terms."""

    def share(n: int, total: int, size: int) -> int:
        return 1 + scale * (n + smooth) // (total + smooth * size) if size else 0

    def kernel(key: tuple, table: pa.Table) -> pa.Table:
        lang, _, first, second = (k.as_py() for k in key)
        names = table.column("source").combine_chunks()
        names = (names.chunk(0) if isinstance(names, pa.ChunkedArray) else names).dictionary_encode()
        code, names = names.indices.to_numpy(), names.dictionary.to_pylist()
        block, word, n = (table.column(c).to_numpy() for c in ("block", "word", "n"))
        groups = len(names)
        facts = word < 0
        at = np.flatnonzero(facts)
        side, total = np.zeros(groups, np.int64), [0] * groups
        size, part = (int(table.column(c)[int(at[0])].as_py()) for c in ("size", "part"))
        for i in at:
            side[code[i]], total[code[i]] = block[i], int(n[i])
        zero = np.array([share(0, t, size) for t in total], np.int64)
        rows = np.flatnonzero(~facts)
        rows = rows[np.lexsort((code[rows], word[rows]))]
        code, word = code[rows], word[rows]
        bits = table.column("bits").to_numpy(zero_copy_only=False)[rows].astype(np.int64).view(np.uint64)
        p = np.array([share(int(x), total[c], size) for x, c in zip(n[rows], code, strict=True)], np.int64)
        here = np.bitwise_count(bits).astype(np.int64)

        # one[g, h]: the terms of g against the count zero in h; used[g]: how many terms g has
        one, used = np.zeros((groups, groups), np.int64), np.bincount(code, here, groups).astype(np.int64)
        for lo in range(0, len(rows), SLAB):
            cut = slice(lo, lo + SLAB)
            np.add.at(one, code[cut], here[cut, None] * np.abs(p[cut, None] - zero[None, :]))
        # every joint cell of two counts above zero, as what it adds to the cells with a zero that `one` and `none` count it in
        none = np.abs(zero[:, None] - zero[None, :])
        both = np.zeros(groups * groups)
        edges = np.flatnonzero(np.r_[True, word[1:] != word[:-1], True]) if len(word) else np.zeros(1, np.int64)
        for lo, hi in zip(edges, edges[1:]):
            own = np.arange(lo, hi)
            left, right = (own, own) if first == second else (own[side[code[own]] == first], own[side[code[own]] == second])
            cells = bits[left][:, None] & bits[right][None, :]
            i, j = np.nonzero(cells)
            found = np.bitwise_count(cells[i, j]).astype(np.int64)
            i, j = left[i], right[j]
            g, h = code[i], code[j]
            f = np.abs(p[i] - p[j]) - np.abs(p[i] - zero[h]) - np.abs(zero[g] - p[j]) + none[g, h]
            both += np.bincount(g * groups + h, found * f, groups * groups)  # sums of whole numbers below 2**53
        value = one - used[:, None] * none
        value = value + value.T + part * none
        both = both.reshape(groups, groups).astype(np.int64)
        value += both if first == second else both + both.T
        pairs = (side[:, None] == first) & (side[None, :] == second)
        g, h = np.nonzero((pairs | pairs.T) & ~np.eye(groups, dtype=bool))
        named = np.array(names, object)
        return pa.table({"lang": pa.array([lang] * len(g), pa.string()), "source": pa.array(named[g], pa.string()), "item": pa.array(named[h], pa.string()), "value": pa.array(value[g, h], pa.int64())})

    return kernel


def source_divergence(
    docs: DataFrame, least_docs: int = 30, smooth: int = 5, scale: int = 10**9, top: int = 50, text_col: str = "text", lang_col: str = "lang", source_col: str = "source"
) -> DataFrame:
    """(lang, source, part, item, value, rank). Part `pair`: each other source of the language with its distance, farthest
    first. Part `term`: the `top` terms whose share in the group most exceeds their share in the language. Terms in fewer than
    least_docs documents of the language are left out."""
    ship(docs.sparkSession)
    docs = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((text_col, "text"), (lang_col, "lang"), (source_col, "source"))))
    counts = materialize(term_counts(docs), "counts")
    kept = counts.groupBy("lang", "term").agg(F.sum("n").alias("all"), F.sum("docs").alias("docs")).where(F.col("docs") >= least_docs)
    kept = materialize(kept.select("lang", "term", "all"), "kept")
    groups = materialize(docs.select("lang", "source").distinct(), "groups")
    langs = kept.groupBy("lang").agg(F.count("*").alias("size"), F.sum("all").alias("lang_total"))
    chunks = max(1, -(-(langs.agg(F.max("size")).first()[0] or 0) // CHUNK))
    blocks = max(1, -(-(groups.groupBy("lang").count().agg(F.max("count")).first()[0] or 0) // BLOCK))

    chunk = F.pmod(F.xxhash64("term"), F.lit(chunks)).cast("int")
    within = Window.partitionBy("lang", "chunk").orderBy(F.desc("all"), "term")  # about CHUNK rows at most
    numbered = kept.withColumn("chunk", chunk).withColumn("place", F.row_number().over(within) - 1)
    cells = materialize(counts.select("lang", "source", "term", "n").join(numbered, ["lang", "term"]), "cells")
    discard(counts)
    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    facts = groups.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0, ["total", "size", "lang_total"])
    facts = materialize(facts, "facts")

    levels = cells.groupBy("lang", "source", "chunk", "n", F.expr("place div 64").cast("int").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, place % 64)")).alias("bits")
    )
    block = F.pmod(F.xxhash64("source"), F.lit(blocks)).cast("int")
    parts = kept.groupBy("lang", chunk.alias("chunk")).agg(F.count("*").alias("part"))
    heads = facts.select("lang", "source", F.col("total").alias("n"), "size", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"))
    heads = heads.join(parts, ["lang", "chunk"], "left").na.fill(0, ["part"]).withColumns({"word": F.lit(-1), "bits": F.lit(0).cast("long")})
    tile = F.transform(F.sequence(F.lit(0), F.lit(blocks - 1)), lambda b: F.struct(F.least("block", b).alias("first"), F.greatest("block", b).alias("second")))
    tiles = levels.unionByName(heads, allowMissingColumns=True).withColumn("block", block).withColumn("tile", F.explode(tile))
    tiles = tiles.select("lang", "chunk", "tile.first", "tile.second", "source", "block", "n", "word", "bits", "size", "part")
    pairs = tiles.groupBy("lang", "chunk", "first", "second").applyInArrow(_joint(smooth, scale), "lang string, source string, item string, value long")
    pairs = pairs.groupBy("lang", "source", "item").agg(F.sum("value").alias("value")).withColumn("part", F.lit("pair"))

    def share(n: str, total: str):
        return F.expr(f"1 + ({scale} * cast({n} + {smooth} as decimal(20, 0))) div cast({total} + {smooth} * size as decimal(20, 0))")

    terms = cells.join(facts, ["lang", "source"]).select("lang", "source", F.col("term").alias("item"), (share("n", "total") - share("`all`", "lang_total")).alias("value"))
    terms = terms.where(F.col("value") > 0).withColumn("part", F.lit("term"))

    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = [pairs.withColumn("rank", F.row_number().over(order)), terms.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)]
    return ranked[0].unionByName(ranked[1]).select("lang", "source", "part", "item", "value", "rank")
