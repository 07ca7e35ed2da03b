"""Operator 9: language identification by prediction by partial matching (PPM).

Each language has a tree of byte contexts of order 0 to ORDER, kept where a context was seen KEEP times. The frozen counts
give code lengths by escape method C with exclusion: in a context with n symbols of q kinds a seen byte costs
-log2(c / (n + q)), any other costs the escape -log2(q / (n + q)) and is then coded in the next shorter context without
the bytes already ruled out; after order 0 all remaining byte values are alike. A text goes to the language with the
smallest total; its score is that language's share when the code lengths are read as likelihoods.

The trees are learned from at most `per_language` labelled texts of each language, picked by a hash of the id (a bounded
sample, whole texts). Counts are summed by Spark; the tables made of them are sparse, with a few numbers for each distinct
gram of a language's sample, and are broadcast. Every text is scored whole.

Defined cases: null text or text without a letter is `und` with score 0; without any labelled text all are `und`; equal
code lengths go to the first language by name; null ids are never learned from; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWER, ship, text_slices

ORDER = 3
KEEP = 3
SLICES = 16  # in which the learned texts of a language are picked
MEMORY = 1 << 26  # bytes of remembered code lengths a Python worker
_START = 32  # what stands before a text


def remainder(id_col: str, m: int) -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % m


def _grams(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each byte, the three bytes before it and itself in one integer; texts start after blanks."""
    b = LOWER[data].astype(np.uint32)
    code = b.copy()
    for k in range(1, ORDER + 1):
        prev = np.full(len(b), _START, np.uint32)
        prev[k:] = b[:-k]
        for j in range(k):  # the first k bytes of each text
            at = offsets[:-1] + j
            prev[at[at < offsets[1:]]] = _START
        code |= prev << np.uint32(8 * k)
    return code


def _gram(code: np.ndarray, k: int) -> np.ndarray:
    """The last k + 1 bytes of grams."""
    return code & np.uint32((1 << 8 * (k + 1)) - 1)


def _context(code: np.ndarray, k: int) -> np.ndarray:
    """The k bytes before the last one."""
    return (code >> np.uint32(8)) & np.uint32((1 << 8 * k) - 1)


def _sum_by(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    kinds, which = np.unique(key, return_inverse=True)
    return kinds, np.bincount(which, n, len(kinds)).astype(np.float64)


def _find(table: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a place in the sorted table, whether the key stands there) of each key."""
    if not len(table):
        return np.zeros(len(key), np.int64), np.zeros(len(key), bool)
    at = np.minimum(np.searchsorted(table, key), len(table) - 1)
    return at, table[at] == key


def _escape(total: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Bits of an escape; a context that holds nothing is passed over for none."""
    return np.where(kinds > 0, np.log2((total + kinds) / np.maximum(kinds, 1), where=kinds > 0, out=np.zeros(len(kinds))), 0.0)


class Trees:
    """Code lengths of all languages. Each language has its own sorted tables, by order, of the grams and contexts that its
    sample holds; their size follows the sample's distinct grams, whatever the number of languages and of byte values."""

    def __init__(self, counts: dict[str, tuple[np.ndarray, np.ndarray]]):
        self.langs = sorted(counts)
        kept = [np.zeros(1, np.uint32)]  # by order, the contexts seen often enough over all languages
        for k in range(1, ORDER + 1):
            seen, total = _sum_by(
                np.concatenate([_context(c, k) for c, _ in counts.values()] or [np.zeros(0, np.uint32)]),
                np.concatenate([n for _, n in counts.values()] or [np.zeros(0)]),
            )
            kept.append(seen[total >= KEEP])
        self.tables = [self._table(*counts[lang], kept) for lang in self.langs]

    @staticmethod
    def _table(code: np.ndarray, n: np.ndarray, kept: list[np.ndarray]) -> list[dict[str, np.ndarray]]:
        """By order: grams and their counts; contexts, their denominators and escapes, both as they are where coding begins in
        them and (lower_...) as the next shorter context's are once their own bytes are ruled out. The bytes of a context are
        bytes of every shorter one, so what is ruled out in an order is what the next longer context holds."""
        out: list[dict[str, np.ndarray]] = []
        for k in range(ORDER + 1):
            gram, c = _sum_by(_gram(code, k), n)
            ok = _find(kept[k], _context(gram, k))[1]
            gram, c = gram[ok], c[ok]
            context, head = np.unique(_context(gram, k), return_index=True)  # grams of a context lie together
            owner = np.repeat(np.arange(len(context)), np.diff(np.append(head, len(gram))))
            total, kinds = np.bincount(owner, c, len(context)), np.bincount(owner, minlength=len(context)).astype(np.float64)
            t = {"gram": gram, "count": c, "context": context, "total": total, "kinds": kinds, "size": total + kinds, "escape": _escape(total, kinds)}
            if k:
                below = out[-1]
                at, short = _find(below["gram"], _gram(gram, k - 1))[0], _find(below["context"], _gram(context, k - 2))[0]
                rest = below["total"][short] - np.bincount(owner, below["count"][at], len(context))
                others = below["kinds"][short] - kinds
                t["lower_size"], t["lower_escape"] = rest + others, _escape(rest, others)
            out.append(t)
        return out

    @staticmethod
    def _bits(table: list[dict[str, np.ndarray]], code: np.ndarray) -> np.ndarray:
        """Bits of each gram (three bytes and the one to be coded) in one language."""
        out, escaped = np.zeros(len(code)), np.zeros(len(code))
        unsure, begun = np.ones(len(code), bool), np.zeros(len(code), bool)
        longer = np.zeros(len(code), np.int64)
        for k in range(ORDER, -1, -1):
            t = table[k]
            at, own = _find(t["context"], _context(code, k))
            size, escape = np.where(own, t["size"][at], 1.0), np.where(own, t["escape"][at], 0.0)
            if k < ORDER and len(table[k + 1]["context"]):
                size = np.where(begun, table[k + 1]["lower_size"][longer], size)
                escape = np.where(begun, table[k + 1]["lower_escape"][longer], escape)
            gram, seen = _find(t["gram"], _gram(code, k))
            now = unsure & seen
            out[now] = escaped[now] - np.log2(t["count"][gram[now]] / size[now])
            unsure &= ~now
            escaped += escape
            longer, begun = at, own
        left = max(256 - len(table[0]["gram"]), 1)
        return np.where(unsure, escaped + np.log2(left), out).astype(np.float32)

    def lengths(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bits of each text in each language. Grams met before are remembered, in a place by their hash."""
        out = np.zeros((len(offsets) - 1, len(self.langs)))
        if not len(data):
            return out
        if not hasattr(self, "_known"):
            self._start()
        code = _grams(data, offsets)
        place = self._place(code)
        miss = np.flatnonzero(self._known[place] != code)
        kinds, inverse = np.unique(code[miss], return_inverse=True)
        full = np.flatnonzero(offsets[1:] > offsets[:-1])
        for i, table in enumerate(self.tables):
            bits = self._remembered[i][place]
            if len(miss):
                new = self._bits(table, kinds)
                bits[miss] = new[inverse]
                self._remembered[i][self._place(kinds)] = new
            out[full, i] = np.add.reduceat(bits, offsets[full], dtype=np.float64)
        # of grams that share a place, the last one stays here and above
        self._known[self._place(kinds)] = kinds
        return out

    def _start(self) -> None:
        self._shift = 32 - min(20, max(10, (MEMORY // 4 // len(self.langs)).bit_length() - 1))
        self._known = np.zeros(1 << (32 - self._shift), np.uint32)
        self._remembered = [np.zeros(len(self._known), np.float32) for _ in self.langs]
        for bits, table in zip(self._remembered, self.tables, strict=True):
            bits[0] = self._bits(table, np.zeros(1, np.uint32))[0]  # gram 0 alone is at home where an empty place holds 0

    def _place(self, code: np.ndarray) -> np.ndarray:
        return ((code * np.uint32(0x9E3779B1)) >> np.uint32(self._shift)).astype(np.int64)

    def __getstate__(self) -> dict:
        return {"langs": self.langs, "tables": self.tables}


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = 400) -> Trees:
    """Trees of the languages in lang_col, from at most per_language texts of each."""
    ship(docs.sparkSession)
    # the smallest hashes of each of SLICES slices of a language, so that no task sees all rows of a large one
    best = Window.partitionBy("lang", F.pmod("h", F.lit(SLICES))).orderBy("h", "id")
    sample = (
        docs.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull() & F.col(id_col).isNotNull())
        .select(F.col(lang_col).alias("lang"), F.col(id_col).alias("id"), F.xxhash64(F.col(id_col)).alias("h"))
        .withColumn("k", F.row_number().over(best))
        .where(F.col("k") <= -(-per_language // SLICES))
        .select("lang", "id")
        .distinct()
    )
    texts = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).join(
        F.broadcast(sample), ["id", "lang"]  # per_language rows of each language at most
    )

    def count(it):
        for batch in it:
            langs = batch.column(0).to_pylist()
            for first, data, offsets in text_slices(batch.column(1)):
                code = _grams(data, offsets)
                owner = np.array(langs[first : first + len(offsets) - 1])
                per = np.repeat(np.arange(len(owner)), np.diff(offsets))
                for lang in set(owner.tolist()):
                    kinds, n = np.unique(code[(owner == lang)[per]], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(kinds), pa.string()), pa.array(kinds.astype(np.int64)), pa.array(n.astype(np.int64))], ["lang", "gram", "n"]
                    )

    sums = texts.select("lang", "text").mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    table = sums.toPandas()
    return Trees(
        {lang: (g["gram"].to_numpy().astype(np.uint32), g["n"].to_numpy()) for lang, g in table.groupby("lang")} if len(table) else {}
    )


def predict(
    docs: DataFrame, trees: Trees, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (),
    outputs: tuple[str, ...] = ("lang_pred", "score"),
) -> DataFrame:
    """A row per row of docs: the id column and `keep`, and under the names of `outputs` the language, its score and, if a
    third name is given, the bits a byte that the best tree takes (null for `und`)."""
    ship(docs.sparkSession)
    names = [id_col, *keep]
    if len({n.lower() for n in (*names, *outputs)}) < len(names) + len(outputs):
        raise ValueError(f"give the outputs other names than {names}")
    shared = docs.sparkSession.sparkContext.broadcast(trees)
    head = ", ".join(f"`{n}` {docs.schema[n].dataType.simpleString()}" for n in names)
    at = names.index(text_col) if text_col in names else len(names)

    def score(it):
        trees = shared.value
        for batch in it:
            text = batch.column(at)
            for first, data, offsets in text_slices(text):
                k = len(offsets) - 1
                pred, conf, rate = ["und"] * k, np.zeros(k), np.full(k, np.nan)
                low = LOWER[data]
                ascii_letter = np.concatenate([[0], np.cumsum((low >= 97) & (low <= 122))])
                has = ascii_letter[offsets[1:]] > ascii_letter[offsets[:-1]]
                for i in np.flatnonzero(~has):
                    has[i] = any(map(str.isalpha, data[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8", "replace")))
                if trees.langs:
                    bits = trees.lengths(data, offsets)
                    best = bits.argmin(1)
                    share = 1 / np.exp2(np.maximum(bits.min(1, keepdims=True) - bits, -1000)).sum(1)
                    for i in np.flatnonzero(has):
                        pred[i], conf[i], rate[i] = trees.langs[best[i]], share[i], bits[i, best[i]] / (offsets[i + 1] - offsets[i])
                cols = [batch.column(j).slice(first, k) for j in range(len(names))]
                more = [pa.array(rate, mask=np.isnan(rate))] if len(outputs) > 2 else []
                yield pa.RecordBatch.from_arrays([*cols, pa.array(pred, pa.string()), pa.array(conf), *more], [*names, *outputs])

    more = [] if text_col in names else [F.col(text_col).alias("__text")]
    kinds = ", ".join(f"`{n}` {kind}" for n, kind in zip(outputs, ("string", "double", "double"), strict=False))
    return docs.select(*names, *more).mapInArrow(score, f"{head}, {kinds}")
