"""Operator 8: token counts of sections, attributed by offsets.

A text is encoded once, whole, by a byte-level BPE of the tokenizers library. The character spans of its tokens are then
interval-joined to the sections of the text (sorted spans, binary search), a slice of texts at a time. A token counts for
the sections that its span touches by one of these rules:

  most   the section with the most characters of it; of equal ones the first (the default)
  start  the section that holds its first character
  split  every section, by its share of the token's characters that lie in sections

Tokens that touch no section (or, by `start`, begin in none) are counted as outside. A token that touches two sections or
more is counted as crossing. Tokens that are parts of one character all have that character as their span.

Equal stretches of a slice (blanks and the solid characters after them) are encoded once. That gives the whole text's
tokens: the pattern by which these files part words has no branch that goes on from a solid character to a blank, so there
is a cut before each stretch; its lookahead after blanks ends at the next solid character, which the same stretch holds; and
merges never cross a cut. Added tokens (special ones among them) are found in the text as the library finds them: they hold
no blank, so one lies in one stretch, and what stands before or after it ends where the stretch does; files whose added
tokens hold or swallow blanks are refused. No stretch begins after a byte that may end a blank beyond ASCII, so such blanks stay whole.
test_stretches_are_the_whole holds this against the library for every white space of Unicode. A byte-level token is as many
bytes as its name has characters, an added one as many as its content, and tokens lie end to end, so lengths give all spans. Without this, the library alone
takes about 800 CPU seconds a GB for encoding and 230 for reading its offsets.

Defined cases: null and empty text has no tokens; sections must be sorted and not overlap, what lies beyond the text is cut
off, empty sections get no tokens, null sections count as none; repeated rows and ids give a row each; other columns are
ignored; a text is held whole, with 16 bytes for each of its tokens.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import prefix_hash, ship, span_hash, text_slices

CACHE = 400_000  # remembered stretches a Python worker
RULES = ("most", "start", "split")
_BLANK = np.zeros(256, bool)
_BLANK[[*range(9, 14), 32]] = True
# The last bytes, in UTF-8, of the white space of Unicode beyond ASCII.
_MAYBE_BLANK = np.zeros(256, bool)
_MAYBE_BLANK[[0x85, 0xA0, *range(0x80, 0x8B), 0xA8, 0xA9, 0xAF, 0x9F]] = True
_SOLID = ~(_BLANK | _MAYBE_BLANK)


class Lengths:
    """Byte lengths of the tokens of texts, by one tokenizer file."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        steps = spec["pre_tokenizer"] or {}
        if spec["normalizer"] or steps.get("type") != "ByteLevel" or steps.get("add_prefix_space"):
            raise ValueError(f"{path} is no plain byte-level tokenizer")
        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        added = {t["id"]: t["content"].encode() for t in spec.get("added_tokens") or []}
        if any(t["lstrip"] or t["rstrip"] for t in spec.get("added_tokens") or []) or any(_BLANK[list(t)].any() for t in added.values()):
            raise ValueError(f"{path} has added tokens with blanks")
        vocab = self.tok.get_vocab(with_added_tokens=False)
        self.size = np.zeros(max([*vocab.values(), *added], default=0) + 1, np.int32)
        for name, i in vocab.items():
            self.size[i] = len(name)
        for i, content in added.items():
            self.size[i] = len(content)
        self._clear()

    def _clear(self) -> None:
        self.known: dict[bytes, int] = {}
        self.first, self.count = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)  # by stretch
        self.flat, self.used = np.zeros(1 << 18, np.int32), 0  # lengths of their tokens, end to end

    @staticmethod
    def _room(a: np.ndarray, n: int) -> np.ndarray:
        return a if n <= len(a) else np.concatenate([a, np.zeros(max(n - len(a), len(a)), a.dtype)])

    def _learn(self, new: list[bytes]) -> None:
        """Encode stretches: in one string those that begin with a blank and end without one, apart all others."""
        led, rest = [], []
        for w in new:
            (led if _BLANK[w[0]] and _SOLID[w[-1]] else rest).append(w)
        parts = ([b"".join(led).decode()] if led else []) + [w.decode() for w in rest]
        ids = [e.ids for e in self.tok.encode_batch_fast(parts, add_special_tokens=False)]
        got = self.size[np.concatenate([np.asarray(i, np.int64) for i in ids])]
        ends = np.cumsum([len(w) for w in led + rest])
        cuts = np.concatenate([[0], np.searchsorted(np.cumsum(got), ends) + 1])
        at, k = len(self.known), len(new)
        self.first, self.count, self.flat = self._room(self.first, at + k), self._room(self.count, at + k), self._room(self.flat, self.used + len(got))
        self.first[at : at + k] = self.used + cuts[:-1]
        self.count[at : at + k] = np.diff(cuts)
        self.flat[self.used : self.used + len(got)] = got
        self.used += len(got)
        self.known.update(zip(led + rest, range(at, at + k), strict=True))

    def of(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(byte length of each token, end to end; first token of each text) of texts."""
        begins = np.zeros(len(data), bool)
        begins[1:] = _BLANK[data[1:]] & _SOLID[data[:-1]]
        begins[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
        start = np.flatnonzero(begins)
        if not len(start):
            return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
        end = np.append(start[1:], len(data))
        _, one, kind = np.unique(span_hash(prefix_hash(data), start, end), return_index=True, return_inverse=True)
        one = self._settled(data, start, end, one, kind)
        raw = data.tobytes()
        names = [raw[a:b] for a, b in zip(start[one].tolist(), end[one].tolist(), strict=True)]
        new = list({w for w in names if w not in self.known})
        if len(self.known) + len(new) > CACHE:
            self._clear()
            new = list(set(names))
        if new:
            self._learn(new)
        place = np.fromiter((self.known[w] for w in names), np.int64, len(names))[kind]
        n = self.count[place]
        ends = np.cumsum(n)
        sizes = self.flat[np.arange(ends[-1]) + np.repeat(self.first[place] - (ends - n), n)]
        return sizes, np.concatenate([[0], ends])[np.searchsorted(start, offsets)]

    @staticmethod
    def _settled(data: np.ndarray, start: np.ndarray, end: np.ndarray, one: np.ndarray, kind: np.ndarray) -> np.ndarray:
        """`one`, after making sure that stretches of a kind are equal byte for byte; kinds that are not are parted."""
        n = end - start
        shift = np.repeat(start[one][kind] - start, n)  # the slice is covered from its first stretch to its end
        where = np.arange(start[0], start[0] + len(shift))
        same = np.logical_and.reduceat(data[where] == data[np.minimum(where + shift, len(data) - 1)], np.cumsum(n) - n)
        same &= n == n[one][kind]
        odd = np.flatnonzero(~same)
        kind[odd] = len(one) + np.arange(len(odd))
        return np.concatenate([one, odd])


def attribute(start: np.ndarray, end: np.ndarray, lo: np.ndarray, hi: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(tokens of each section, whether each token is outside, whether it crosses) for sorted sections [lo, hi)."""
    full = np.flatnonzero(hi > lo)
    counts = np.zeros(len(lo))
    if not len(full) or not len(start):
        return counts, np.ones(len(start), bool), np.zeros(len(start), bool)
    a, b = lo[full], hi[full]
    first, last = np.searchsorted(b, start, "right"), np.searchsorted(a, end, "left") - 1
    touched = last - first + 1
    own = np.zeros(len(full))
    cross = touched > 1
    if rule == "start":
        k = np.minimum(first, len(a) - 1)
        outside = ~((touched > 0) & (a[k] <= start))
        own += np.bincount(first[~outside], minlength=len(full))
    else:
        outside = touched <= 0
        own += np.bincount(first[touched == 1], minlength=len(full))
        at = np.flatnonzero(cross)
        n = touched[at]
        head = np.cumsum(n) - n
        token = np.repeat(at, n)
        s = np.arange(n.sum()) - np.repeat(head - first[at], n)
        chars = np.minimum(b[s], end[token]) - np.maximum(a[s], start[token])
        if len(at) and rule == "split":
            own += np.bincount(s, chars / np.repeat(np.add.reduceat(chars, head), n), len(full))
        elif len(at):
            best = np.flatnonzero(chars == np.repeat(np.maximum.reduceat(chars, head), n))
            own += np.bincount(s[best[np.unique(token[best], return_index=True)[1]]], minlength=len(full))
    counts[full] = own
    return counts, outside, cross


_lengths: dict[str, Lengths] = {}


def _lists(column: pa.Array, first: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(values, offsets from 0) of n lists from `first` on; null lists are empty."""
    part = column.slice(first, n)
    part = part.fill_null([]) if part.null_count else part
    cuts = part.offsets.to_numpy().astype(np.int64)
    return part.values.slice(cuts[0], cuts[-1] - cuts[0]).to_numpy(zero_copy_only=False).astype(np.int64), cuts - cuts[0]


def count_tokens(
    docs: DataFrame, path: str, sections: Column | None = None, id_col: str = "doc_id", text_col: str = "text", rule: str = "most"
) -> DataFrame:
    """A row per row of docs: the id column, n_tokens, section_tokens (array<double>, one a section), outside, crossing.

    `sections`: a column of array<struct<start: int, end: int>> over docs, in code points, end exclusive; without it the
    sections are the lines of the text, without their line feeds. `path`: a tokenizers JSON file with a byte-level BPE model
    without normalization, present on every executor.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    ship(docs.sparkSession)
    id_type = docs.schema[id_col].dataType.simpleString()
    by_line = sections is None

    def rows(it):
        if path not in _lengths:
            _lengths[path] = Lengths(path)
        lengths = _lengths[path]
        for batch in it:
            for first, data, offsets in text_slices(batch.column(1)):
                k = len(offsets) - 1
                sizes, heads = lengths.of(data, offsets)
                char = np.cumsum((data & 0xC0) != 0x80)  # characters up to and with a byte
                ends = np.cumsum(sizes)
                start, end = char[ends - sizes] - 1, char[ends - 1]
                edge = np.concatenate([[0], char])[offsets]
                if by_line:
                    feeds = np.flatnonzero(data == 10)
                    feed = char[feeds] - 1
                    lo, hi = np.sort(np.concatenate([edge[:-1], feed + 1])), np.sort(np.concatenate([feed, edge[1:]]))
                    cuts = np.searchsorted(feeds, offsets) + np.arange(k + 1)
                else:
                    (lo, cuts), (hi, _) = _lists(batch.column(2), first, k), _lists(batch.column(3), first, k)
                    base, most = np.repeat(edge[:-1], np.diff(cuts)), np.repeat(edge[1:], np.diff(cuts))
                    lo, hi = np.minimum(base + lo, most), np.minimum(base + hi, most)
                counts, outside, cross = attribute(start, end, lo, hi, rule)
                sums = [np.concatenate([[0], np.cumsum(x)])[heads] for x in (outside, cross)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, k), pa.array(np.diff(heads)), pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(counts)),
                        pa.array(np.diff(sums[0]).astype(float)), pa.array(np.diff(sums[1])),
                    ],
                    [id_col, "n_tokens", "section_tokens", "outside", "crossing"],
                )

    spans_of = F.lit(None).cast("array<struct<start: int, end: int>>") if by_line else F.filter(sections, lambda x: x.isNotNull())
    rows_in = docs.select(id_col, F.col(text_col).alias("__text"), spans_of.alias("__s")).select(
        id_col, "__text", F.col("__s.start").alias("__lo"), F.col("__s.end").alias("__hi")
    )
    return rows_in.mapInArrow(rows, f"`{id_col}` {id_type}, n_tokens long, section_tokens array<double>, outside double, crossing long")
