"""Operator 1: BPE encoding and decoding of whole texts, exact to the tokenizers library.

Short stretches between ASCII blanks (which no token crosses) are encoded once each and remembered. A stretch without a
break is encoded by tree concatenation: cut in halves down to LEAF symbols, the leaves encoded apart, and neighbours
joined by encoding anew a window around the seam. The window doubles until its first AGREE tokens are those that the
left part had and its last AGREE those that the right part had. Every adjacent pair of the joined row of tokens then
occurs in a row that BPE itself made; BPE's result is the only row of which that holds, so the join is exact.

Texts with a stretch above SPREAD symbols leave the plain path: their leaves become rows that Spark deals over the
cluster, and a second pass joins them per text.

Defined cases: null and empty text give no tokens; repeated rows and ids give a row each; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship

LEAF = 512  # symbols in a leaf
SPREAD = 200_000  # symbols in a stretch above which leaves are encoded as rows of their own
AGREE = 2  # tokens that must agree on each side of a seam
CACHE = 150_000  # remembered stretches a Python worker


# Characters that normalization leaves alone but for case: printable ASCII, and Latin letters and signs up to U+024F.
_LATIN = re.compile("[!-~\u00a1-\u024f]+")


def _byte_chars() -> list[str]:
    """The printable stand-ins of byte-level models: a printable byte is itself, the others follow from U+0100."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return [chr(b) if b in printable else chr(256 + rest.index(b)) for b in range(256)]


_BYTE_CHARS = _byte_chars()


def _split_of(spec: dict) -> regex.Pattern | None:
    """The split pattern, if the file lower-cases, parts words by one pattern and maps bytes; else None."""
    kinds = [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])]
    steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
    if kinds == ["NFC", "Replace", "Lowercase"] and [x["type"] for x in steps] == ["Split", "ByteLevel"] and steps[0]["invert"]:
        return regex.compile(steps[0]["pattern"]["Regex"])
    return None


class Codec:
    """One tokenizer file: encoding of stretches, tree concatenation, decoding."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.models import BPE

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        spec = json.load(open(path, encoding="utf-8"))
        model = spec["model"]
        self.ending = self.tok.model
        # the same merges for a part that does not end its word
        self.inner = BPE(vocab=model["vocab"], merges=[tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.suffix = model.get("end_of_word_suffix") or ""
        self.size = self.tok.get_vocab_size(with_added_tokens=True)
        self.names = [self.tok.id_to_token(i) for i in range(self.size)]
        self.known: dict[bytes, tuple[bytes, str]] = {}
        self.pieces_known: dict[str, tuple[bytes, str]] = {}
        self.split = _split_of(spec)

    # tokens below are (id, surface) with surface the mapped characters without the word-end mark
    def leaf(self, part: str, last: bool) -> list[tuple[int, str]]:
        return [(t.id, part[t.offsets[0] : t.offsets[1]]) for t in (self._tokens(self.ending if last else self.inner, part))]

    @staticmethod
    def _tokens(model, part: str):
        from types import SimpleNamespace

        out, at = [], 0
        for t in model.tokenize(part):
            # offsets of a model count bytes; widths in characters follow from the surface
            width = len(part.encode()[t.offsets[0] : t.offsets[1]].decode())
            out.append(SimpleNamespace(id=t.id, offsets=(at, at + width)))
            at += width
        return out

    def join(self, left: list, right: list, last: bool) -> list:
        """The tokens of the two parts' concatenation; `last`: the right part ends the word."""
        k = 4 * AGREE
        while True:
            a, b = min(k, len(left)), min(k, len(right))
            whole_left, whole_right = a == len(left), b == len(right)
            window = self.leaf("".join(s for _, s in left[len(left) - a :] + right[:b]), last and whole_right)
            if (whole_left or window[:AGREE] == left[len(left) - a :][:AGREE]) and (whole_right or window[-AGREE:] == right[:b][-AGREE:]):
                return left[: len(left) - a] + window + right[b:]
            k *= 2

    def tree(self, parts: list[list], ends: bool = True) -> list:
        """Join neighbouring parts pairwise until one is left."""
        while len(parts) > 1:
            n = len(parts)
            parts = [self.join(parts[i], parts[i + 1], ends and i + 2 >= n) if i + 1 < n else parts[i] for i in range(0, n, 2)]
        return parts[0] if parts else []

    def pieces(self, stretch: str) -> Iterator[int | str]:
        """Ids of special tokens, and the pre-tokenized pieces as the model sees them."""
        for part in self.cut.split(stretch) if self.cut else [stretch]:
            if part in self.special:
                yield self.special[part]
            elif part:
                if self.tok.normalizer is not None:
                    part = self.tok.normalizer.normalize_str(part)
                for piece, _ in self.tok.pre_tokenizer.pre_tokenize_str(part):
                    yield piece

    @staticmethod
    def leaves(piece: str) -> list[str]:
        return [piece[i : i + LEAF] for i in range(0, len(piece), LEAF)]

    def long(self, stretch: str) -> list[int]:
        ids: list[int] = []
        for piece in self.pieces(stretch):
            if isinstance(piece, int):
                ids.append(piece)
            else:
                cut = self.leaves(piece)
                ids += [i for i, _ in self.tree([self.leaf(p, j == len(cut) - 1) for j, p in enumerate(cut)])]
        return ids

    def stretch(self, w: str) -> tuple[bytes, str]:
        """A short stretch. Latin letters and ASCII, which most are, keep their remembered pieces; the library does others."""
        if self.split is None or not _LATIN.fullmatch(w) or (self.cut and self.cut.search(w)):
            return self.packed(self.tok.encode(w, add_special_tokens=False).ids)
        got = []
        for piece in self.split.findall(w.lower()):
            if piece not in self.pieces_known:
                if len(self.pieces_known) > CACHE:
                    self.pieces_known.clear()
                mapped = piece if piece.isascii() else "".join([_BYTE_CHARS[b] for b in piece.encode()])
                self.pieces_known[piece] = self.packed([t.id for t in self.ending.tokenize(mapped)])
            got.append(self.pieces_known[piece])
        return got[0] if len(got) == 1 else (b"".join([g[0] for g in got]), " ".join([g[1] for g in got]))

    def packed(self, ids: list[int]) -> tuple[bytes, str]:
        return np.asarray(ids, "<u4").tobytes(), self.decode(ids if isinstance(ids, list) else ids.tolist())

    def decode(self, ids: list[int]) -> str:
        """As decode(ids, skip_special_tokens=False); without a decoder in the file that is the tokens, parted by blanks."""
        return self.tok.decode(ids, skip_special_tokens=False) if self.tok.decoder else " ".join([self.names[i] for i in ids])

    def text(self, raw: bytes) -> tuple[bytes, str]:
        """(ids as little-endian unsigned 32-bit integers, decoded text) of a whole text."""
        known = self.known
        stretches = raw.split()  # ASCII blanks
        new = {w for w in stretches if w not in known}
        if new:
            if len(known) + len(new) > CACHE:
                known.clear()
                new = set(stretches)
            for w in new:
                if len(w) <= LEAF:
                    known[w] = self.stretch(w.decode())
            for w in new:
                if len(w) > LEAF:
                    known[w] = self.packed(self.long(w.decode()))
        got = [known[w] for w in stretches]
        return b"".join([g[0] for g in got]), " ".join([g[1] for g in got if g[1]])


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


_KINDS = {
    "n_tokens": ("long", pa.int64(), lambda i, d: len(i) // 4),
    "ids": ("array<int>", pa.list_(pa.int32()), lambda i, d: np.frombuffer(i, "<i4")),
    "decoded": ("string", pa.string(), lambda i, d: d),
    "ids_sha256": ("string", pa.string(), lambda i, d: hashlib.sha256(i).hexdigest()),
    "decoded_sha256": ("string", pa.string(), lambda i, d: hashlib.sha256(d.encode()).hexdigest()),
}
OUTPUTS = ("n_tokens", "ids", "decoded")
_LONG = rf"[^\x20\x09-\x0D]{{{SPREAD},}}"


def encode_decode(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", outputs: tuple[str, ...] = OUTPUTS
) -> DataFrame:
    """A row per row of docs: the id column and `outputs` (of n_tokens, ids, decoded, ids_sha256, decoded_sha256).

    `path`: a tokenizers JSON file with a BPE model, present on every executor.
    """
    ship(docs.sparkSession)
    kinds = [_KINDS[o] for o in outputs]
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = ", ".join([f"`{id_col}` {id_type}"] + [f"`{o}` {k[0]}" for o, k in zip(outputs, kinds, strict=True)])

    def out_batch(ids, results):
        arrays = [ids] + [pa.array([k[2](*r) for r in results], k[1]) for k in kinds]
        return pa.RecordBatch.from_arrays(arrays, [id_col, *outputs])

    def plain(it):
        c = codec(path)
        for batch in it:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                yield out_batch(part.column(0), [c.text((t or "").encode()) for t in part.column(1).to_pylist()])

    rows = docs.select(id_col, F.col(text_col).alias("__text"))
    is_long = (F.length("__text") >= SPREAD) & F.col("__text").rlike(_LONG)
    usual = rows.where(F.coalesce(~is_long, F.lit(True))).mapInArrow(plain, schema)
    return usual.unionByName(_spread(rows.where(is_long), path, id_col, id_type, schema, out_batch))


def _spread(rows: DataFrame, path: str, id_col: str, id_type: str, schema: str, out_batch) -> DataFrame:
    """Texts with very long stretches: leaves as rows, encoded wherever Spark deals them, then joined per text."""
    head = f"`{id_col}` {id_type}, row long, stretch long, piece long, leaf long, last boolean, special int, part string"

    def cut(it):
        c = codec(path)
        for batch in it:
            for key, row, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                out = []
                for s, w in enumerate(text.encode().split()):
                    for p, piece in enumerate(c.pieces(w.decode())):
                        if isinstance(piece, int):
                            out.append((key, row, s, p, 0, True, piece, None))
                        else:
                            parts = c.leaves(piece)
                            out += [(key, row, s, p, j, j == len(parts) - 1, None, x) for j, x in enumerate(parts)]
                for at in range(0, len(out), 20_000):
                    cols = list(zip(*out[at : at + 20_000], strict=True))
                    kinds = [batch.schema.field(0).type, *[pa.int64()] * 4, pa.bool_(), pa.int32(), pa.string()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(v, k) for v, k in zip(cols, kinds, strict=True)],
                        [id_col, "row", "stretch", "piece", "leaf", "last", "special", "part"],
                    )

    def leaves(it):
        c = codec(path)
        for batch in it:
            col = {n: batch.column(n).to_pylist() for n in ("last", "special", "part")}
            got = [[(sp, "")] if sp is not None else c.leaf(t, la) for la, sp, t in zip(col["last"], col["special"], col["part"], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in (id_col, "row", "stretch", "piece", "leaf")), pa.array([[i for i, _ in g] for g in got], pa.list_(pa.int32())), pa.array([[s for _, s in g] for g in got], pa.list_(pa.string()))],
                [id_col, "row", "stretch", "piece", "leaf", "ids", "parts"],
            )

    def join(table: pa.Table) -> pa.Table:
        c = codec(path)
        table = table.sort_by([(n, "ascending") for n in ("stretch", "piece", "leaf")])
        at = [table.column(n).to_pylist() for n in ("stretch", "piece")]
        tokens = [list(zip(i, s, strict=True)) for i, s in zip(table.column("ids").to_pylist(), table.column("parts").to_pylist(), strict=True)]
        ids, begin = [], 0
        for j in range(1, len(tokens) + 1):
            if j == len(tokens) or (at[0][j], at[1][j]) != (at[0][begin], at[1][begin]):
                ids += [i for i, _ in c.tree(tokens[begin:j])]
                begin = j
        key = table.column(id_col).combine_chunks().slice(0, 1)
        return pa.Table.from_batches([out_batch(key if isinstance(key, pa.Array) else key.chunk(0), [c.packed(ids)])])

    cut_rows = rows.select(id_col, F.monotonically_increasing_id().alias("__row"), "__text").mapInArrow(cut, head)
    encoded = cut_rows.repartition("row", "stretch", "piece", "leaf").mapInArrow(
        leaves, f"`{id_col}` {id_type}, row long, stretch long, piece long, leaf long, ids array<int>, parts array<string>"
    )
    return encoded.groupBy("row").applyInArrow(join, schema)
