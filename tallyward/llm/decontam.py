"""Operator 6: benchmark decontamination by spaced-seed hashing.

A mask fixes which of SPAN neighbouring word positions count; the others may hold any word. Items and texts are cut into
lower-cased words (runs of ASCII letters, digits and characters above 127); each mask gives a hash at every position, and equal hashes
of an item and a text are hits. Around a hit the two are laid upon each other without gaps: it is an overlap if at least
`share` of the item's words (all of its words, at their own places) stand in the text, or a stretch of it in
which agreeing words outweigh others (1 against 2 each) by STRETCH; substituted words are tolerated between seeds. Items of fewer than LEAST words are sought whole: all their words must stand in the text in a row.

No overlap by either rule is missed: a row of n words that no mask of MASKS hits at any place has n - 3 * (words that differ)
of 3 at most (test_masks_hit_every_overlap counts them out). A stretch needs STRETCH of that; SHARE of n words leaves n / 10,
which is more than 3 beyond 30 words, and the test holds each length up to there. A smaller `share` seeks with single words.

The join of test and training hashes is a broadcast join: equal item texts become one first, and these are dealt to blocks by
a hash; blocks are made smaller until each holds BLOCK_WORDS words at most (or one longer item), as counted before anything
is broadcast. Each block is one pass over the texts, in which sorted tables of its hashes meet those of the texts; hits and
verification stay in the task, so that nothing of the texts is shuffled. The ids of equal items are joined to the result.

Defined cases: null or blank texts and items overlap with nothing; equal items are all reported; repeated rows are each
reported; null ids are carried along; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, ROW, free_name, materialize, mix, prefix_hash, ship, span_hash, text_slices, with_rows, words

#: Positions that count (1) and positions that may differ (0).
MASKS = ("1111", "11011", "110101", "101011")
LEAST = 11  # words from which on an item may differ
SHARE = 0.7
STRETCH = 13  # score from which a part of an item is an overlap, see _stretch
BLOCK_WORDS = 400_000
LOOK = 1_000_000  # hits, or words of diagonals, that are looked at at once

_GAP = np.ones(256, bool)
_GAP[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def _words(column):
    """(first row, word hashes, first word of each text) of each slice."""
    for first, data, offsets in text_slices(column):
        data = LOWER[data]
        # capital letters of Latin-1 in UTF-8 are C3 80 to C3 9E; the sign at C3 97 has no case
        data[1:][(data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)] += 0x20
        start, end, heads = words(data, offsets, _GAP)
        yield first, span_hash(prefix_hash(data), start, end), heads


def _seeds(w: np.ndarray, mask: str, number: int) -> np.ndarray:
    """The hash of the mask at each position from which the whole span is there."""
    n = len(w) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, number + 1, np.uint64)
    for k, c in enumerate(mask):
        if c == "1":
            out = out * np.uint64(0x9E3779B97F4A7C15) + w[k : k + n]
    return mix(out)


def _stretch(same: np.ndarray) -> float:
    """The best stretch's score: a word that agrees adds 1, another takes off 2."""
    c = np.concatenate([[0], np.cumsum(np.where(same, 1, -2))])
    return float((c - np.minimum.accumulate(c)).max())


class Items:
    """A block of items: their words, and sorted tables of seeds."""

    def __init__(self, ids: list, texts: list[str | None], share: float = SHARE):
        self.ids, self.words, self.row = [], [], []
        for first, w, heads in _words(pa.array([t or "" for t in texts], pa.string())):
            for d in range(len(heads) - 1):
                self.words.append(w[heads[d] : heads[d + 1]])
        self.ids, self.share = list(ids), share
        self.size = np.array([len(w) for w in self.words], np.int64)
        self.first = np.cumsum(self.size) - self.size
        self.flat = np.concatenate([np.zeros(0, np.uint64), *self.words])
        self.masks = MASKS if share >= SHARE else ("1",)
        self.tables = []
        for number, mask in enumerate(self.masks):
            self.tables.append(self._table([(_seeds(w, mask, number), i) for i, w in enumerate(self.words) if len(w) >= LEAST]))
        # short items: by length, the hash of all their words
        self.short = {}
        for n in sorted({len(w) for w in self.words if 0 < len(w) < LEAST}):
            self.short[n] = self._table([(_seeds(w, "1" * n, 99), i) for i, w in enumerate(self.words) if len(w) == n])

    @staticmethod
    def _table(parts):
        if not parts:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(1 << 16, bool)
        h = np.concatenate([p for p, _ in parts])
        item = np.concatenate([np.full(len(p), i) for p, i in parts])
        at = np.concatenate([np.arange(len(p)) for p, _ in parts])
        order = np.argsort(h, kind="stable")
        bits = max(16, int(len(h)).bit_length() + 5)
        front = np.zeros(1 << bits, bool)  # a first look that most positions fail
        front[(h >> np.uint64(64 - bits)).astype(np.int64)] = True
        return h[order], item[order], at[order], front

    def hits(self, table, seeds: np.ndarray):
        """(item, text position at which it would begin) of equal seeds, about LOOK at a time."""
        h, item, at, front = table
        if not len(h) or not len(seeds):
            return
        bits = np.uint64(64 - (len(front).bit_length() - 1))
        maybe = np.flatnonzero(front[(seeds >> bits).astype(np.int64)])
        low, high = np.searchsorted(h, seeds[maybe], "left"), np.searchsorted(h, seeds[maybe], "right")
        for part in _parts(high - low):
            n = high[part] - low[part]
            row = np.repeat(low[part], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            pos = np.repeat(maybe[part], n)
            yield item[row], pos - at[row], pos

    def overlaps(self, w: np.ndarray, heads: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(text, item, words that agree, first word in the text) of the best overlap of each text and item."""
        tables = [(t, m, k) for k, (m, t) in enumerate(zip(self.masks, self.tables, strict=True))] + [(t, "1" * n, 99) for n, t in self.short.items()]
        best: dict[tuple[int, int], tuple[int, int]] = {}
        for table, mask, number in tables:
            for item, begin, pos in self.hits(table, _seeds(w, mask, number)):
                # one look at each diagonal: where the item would begin
                diagonals = np.unique(np.stack([item, begin, np.searchsorted(heads, pos, "right") - 1], 1), axis=0)
                for part in _parts(self.size[diagonals[:, 0]]):
                    self._look(w, heads, diagonals[part], best)
        return [(t, i, a, p) for (t, i), (a, p) in best.items()]

    def _look(self, w: np.ndarray, heads: np.ndarray, diagonals: np.ndarray, best: dict) -> None:
        """Compare the words of each diagonal, and keep what agrees most in best, the first place of equal ones."""
        item, begin, text = diagonals.T
        own = self.size[item]
        low, high = np.maximum(begin, heads[text]), np.minimum(begin + own, heads[text + 1])
        n = high - low  # 1 at least: the hit lies in both
        start = np.cumsum(n) - n
        pos = np.arange(n.sum()) - np.repeat(start - low, n)
        same = w[pos] == self.flat[pos + np.repeat(self.first[item] - begin, n)]
        agree = np.add.reduceat(same.astype(np.int64), start)
        whole = agree >= np.where(own >= LEAST, self.share, 1.0) * own
        for k in np.flatnonzero(whole | (agree >= STRETCH)).tolist():
            if whole[k] or _stretch(same[start[k] : start[k] + n[k]]) >= STRETCH:
                key, a, p = (int(text[k]), int(item[k])), int(agree[k]), int(low[k] - heads[text[k]])
                if (a, -p) > (best[key][0], -best[key][1]) if key in best else a > 0:
                    best[key] = (a, p)


def _parts(n: np.ndarray):
    """Slices of about LOOK in sum, one entry at least."""
    if len(n):
        ends = np.unique(np.concatenate([np.flatnonzero(np.diff(np.cumsum(n) // LOOK)) + 1, [len(n)]]))
        yield from map(slice, [0, *ends[:-1].tolist()], ends.tolist())


def _blocks(own: DataFrame) -> tuple[DataFrame, int]:
    """A table of the distinct item texts (key, text, block), and the number of blocks."""
    texts = own.where(F.col("text").rlike(r"[0-9A-Za-z\x{80}-\x{10FFFF}]")).groupBy("key").agg(F.first("text").alias("text"))
    texts = materialize(texts.withColumn("n", F.size(F.split("text", r"[^0-9A-Za-z\x{80}-\x{10FFFF}]+")).cast("long")), "items")
    total = texts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    blocks = max(1, -(-total // BLOCK_WORDS))
    while True:
        block = F.pmod(F.xxhash64("key"), F.lit(blocks))
        if texts.groupBy(block.alias("block")).agg(F.sum("n").alias("n"), F.count("*").alias("items")).where((F.col("n") > BLOCK_WORDS) & (F.col("items") > 1)).isEmpty():
            return texts.withColumn("block", block), blocks
        blocks *= 2


def _overlaps(rows: DataFrame, items: DataFrame, item_col: str, item_text: str, share: float) -> DataFrame:
    """For rows (row, id, text): row, id, item, agree, n_words and word_pos of each overlap."""
    spark = rows.sparkSession
    ship(spark)
    own = items.select(F.col(item_col).alias("item"), F.col(item_text).alias("text")).where("text is not null")
    own = own.withColumn("key", F.sha2(F.col("text").cast("binary"), 256))
    texts, blocks = _blocks(own)
    id_type, out = rows.schema["id"].dataType.simpleString(), None
    for b in range(blocks):
        part = texts.where(F.col("block") == b).select("key", "text").toPandas()  # BLOCK_WORDS words at most, or one item
        shared = spark.sparkContext.broadcast((part["key"].tolist(), part["text"].tolist()))
        cache: dict = {}

        def search(it, shared=shared, cache=cache):
            if "items" not in cache:
                cache["items"] = Items(*shared.value, share)
            block = cache["items"]
            for batch in it:
                for first, w, heads in _words(batch.column(2)):
                    got = block.overlaps(w, heads)
                    if got:
                        at = pa.array([first + t for t, _, _, _ in got], pa.int64())
                        yield pa.RecordBatch.from_arrays(
                            [
                                batch.column(0).take(at), batch.column(1).take(at), pa.array([block.ids[i] for _, i, _, _ in got], pa.string()),
                                pa.array([a for _, _, a, _ in got], pa.int64()), pa.array([len(block.words[i]) for _, i, _, _ in got], pa.int64()),
                                pa.array([p for _, _, _, p in got], pa.int64()),
                            ],
                            ["row", "id", "key", "agree", "n_words", "word_pos"],
                        )

        one = rows.mapInArrow(search, f"row {ROW}, id {id_type}, key string, agree long, n_words long, word_pos long")
        out = one if out is None else out.unionByName(one)
    return out.join(own.select("key", "item"), "key").select("row", "id", "item", "agree", "n_words", "word_pos")


def _rows(base: DataFrame, row: str, id_col: str, text_col: str) -> DataFrame:
    return base.select(F.col(row).alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))


def find_overlaps(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", share: float = SHARE
) -> DataFrame:
    """A row per text and item that overlap: the text's id, the item's id, the number of words that agree (agree), the
    item's words (n_words) and the text's word at which the overlap begins (word_pos)."""
    rows = docs.select(F.struct(F.lit(0).cast("long").alias("file"), F.lit(0).cast("long").alias("at")).alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    found = _overlaps(rows, items, item_col, item_text, share)
    return found.select(F.col("id").alias(id_col), F.col("item").alias(item_col), "agree", "n_words", "word_pos")


def clean(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", share: float = SHARE
) -> DataFrame:
    """docs without the rows that overlap with an item; columns and repeated rows stay."""
    row = free_name(docs, "row")
    base = with_rows(docs, row)
    bad = _overlaps(_rows(base, row, id_col, text_col), items, item_col, item_text, share).select(F.col("row").alias(row)).distinct()
    return base.join(materialize(bad, "overlapping"), row, "left_anti").select(*docs.columns)
