"""Operator 5: fuzzy line dedup over all texts.

A line is what stands between line feeds, taken without ASCII blanks at its ends and with A-Z in lower case. Its set holds
the distinct shingles of CHARS characters (a shorter line is one shingle). A one-permutation MinHash signature (BANDS x ROWS
bins, empty bins filled from a bin drawn by a hash of the bin and the try) is cut into bands; lines that share a band are
candidates; candidates link if the exact Jaccard similarity of their sets is `threshold` or more. Of each component the
occurrence with the smallest (id, row, line number) stays, all others are dropped.

With 12 bands of 5 rows of independent hashes a pair of similarity 0.8 would become a candidate with probability 0.991;
test_recall_by_length measures what this signature reaches. Equal lines are one key (a 64-bit hash) from the start; a second
hash (BLAKE2) is compared wherever equal keys put lines together. Components are found by union-find (components.py). Null or
blank texts and blank lines are never dropped and link with nothing; rows with null ids come after all others; repeated rows are copies, of which one keeps its lines; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
from fractions import Fraction
from functools import cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .buckets import FEW, bucket_components, close, packed_buckets, parity_sketches, pieces, task_of
from .common import BLOCK, LOWER, ROW, as_long, batches, discard, end_to_end, free_name, materialize, mix, mix_here, power_tables, prefix_hash, ship, span_hash, text_slices, with_rows

CHARS = 9
BANDS, ROWS = 12, 5
_BINS = BANDS * ROWS
PER_TASK = 200_000  # lines that a task looks through for repeats, and that are packed at once
_PLACE = np.dtype([("key", np.uint64), ("check", np.int64), ("file", np.int64), ("at", np.int64), ("line", np.int32)])
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def split_lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, first line of each text); blanks at the ends are off, a blank line has end <= start."""
    feeds = np.flatnonzero(data == 10)
    # a text of n feeds has n + 1 lines: starts are the texts' own and those after feeds
    start = np.sort(np.concatenate([offsets[:-1], feeds + 1]), kind="stable")
    owner = np.sort(np.concatenate([np.arange(len(offsets) - 1), np.searchsorted(offsets, feeds, "right") - 1]), kind="stable")
    heads = np.searchsorted(owner, np.arange(len(offsets)))
    stop = np.append(start[1:] - 1, len(data))
    last = heads[1:] - 1
    stop[last] = offsets[1:]
    return *_stripped(data, start, stop), heads


def _stripped(data: np.ndarray, start: np.ndarray, stop: np.ndarray, tries: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """The first byte of each line that is no blank, and the end of the last; both alike if all are blank."""
    first, end = start.copy(), stop.copy()
    at = np.flatnonzero(first < end)
    for _ in range(tries):  # most lines have few blanks at their ends
        at = at[_BLANK[data[first[at]]]]
        first[at] += 1
        at = at[first[at] < end[at]]
    left = np.flatnonzero(first < end)
    for _ in range(tries):
        left = left[_BLANK[data[end[left] - 1]]]
        end[left] -= 1
        left = left[first[left] < end[left]]
    if len(at) or len(left):
        solid = np.append(np.flatnonzero(~_BLANK[data]), len(data))
        first = np.minimum(solid[np.searchsorted(solid, start)], stop)
        back = np.searchsorted(solid, stop) - 1
        end = np.where(back >= 0, solid[np.maximum(back, 0)] + 1, 0)
        end = np.where(end > first, end, first)
    return first, end


def shingles(data: np.ndarray, start: np.ndarray, end: np.ndarray, prefix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, line) of every shingle of every line, in order, with repeats. prefix: prefix_hash(data). Lines stand in order."""
    _, down = power_tables(len(prefix))
    # the hash of the CHARS bytes from each byte on, as span_hash has it
    every, spare = np.zeros(len(prefix), np.uint64), np.empty(BLOCK, np.uint64)
    for x, y in batches(len(prefix) - CHARS, BLOCK):
        own = every[x:y]
        np.subtract(prefix[x + CHARS : y + CHARS], prefix[x:y], out=own)
        own *= down[x:y]
        own += np.uint64(CHARS)
        mix_here(own, spare[: y - x])
    # bytes that begin no character, but for the first of a line
    more = (data & 0xC0) == 0x80
    more[start[end > start]] = False
    rest = np.flatnonzero(more)
    before = start - np.searchsorted(rest, start)  # characters before the line
    chars = end - np.searchsorted(rest, end) - before
    n = np.where(end > start, np.maximum(chars - CHARS + 1, 1), 0)
    stop = start + n
    if len(rest):
        heads = np.append(np.flatnonzero(~more), np.full(CHARS, len(data)))
        for x, y in batches(len(heads) - CHARS, BLOCK):
            at = x + np.flatnonzero(heads[x + CHARS : y + CHARS] - heads[x:y] != CHARS)
            a, b = heads[at], heads[at + CHARS]
            every[a] = mix((prefix[b] - prefix[a]) * down[a] + (b - a).view(np.uint64))
        stop = np.where(n > 0, heads[before + np.maximum(n, 1) - 1] + 1, start)
    some = np.flatnonzero(n)
    cuts = np.stack([start[some], stop[some]], 1).ravel()
    within = np.repeat(np.arange(len(cuts) + 1) % 2 == 1, np.diff(cuts, prepend=0, append=len(prefix)))
    within[rest] = False
    h = every[within]
    short = np.flatnonzero((end > start) & (chars < CHARS))
    h[(np.cumsum(n) - n)[short]] = span_hash(prefix, start[short], end[short])
    return h, np.repeat(np.arange(len(start)), n)


@cache
def _probes(turn: int) -> np.ndarray:
    """The bin that each bin is filled from at a try."""
    return (mix(np.arange(_BINS, dtype=np.uint64) * np.uint64(1 << 32) + np.uint64(turn)) % np.uint64(_BINS)).astype(np.int64)


def signatures(h: np.ndarray, line: np.ndarray, n_lines: int) -> np.ndarray:
    """n_lines x BANDS band hashes; lines without shingles get none that mean anything."""
    table = np.full(n_lines * _BINS, _NONE, np.uint64)
    spare, value, place = np.empty(BLOCK, np.uint64), np.empty(BLOCK, np.uint64), np.empty(BLOCK, np.int64)
    for a, b in batches(len(h), BLOCK):
        bins, own, at = spare[: b - a], value[: b - a], place[: b - a]
        own[:] = h[a:b]
        mix_here(own, bins)
        np.right_shift(h[a:b], np.uint64(32), out=bins)
        bins *= np.uint64(_BINS)
        bins >>= np.uint64(32)
        np.multiply(line[a:b], _BINS, out=at)
        at += bins.view(np.int64)
        np.minimum.at(table, at, own)
    table = table.reshape(n_lines, _BINS)
    empty = table == _NONE
    some = ~empty.all(1)
    filled = table.copy()
    row, col = np.nonzero(empty & some[:, None])
    turn = 1
    while len(row):
        got = table[row, _probes(turn)[col]]
        ok = got != _NONE
        filled[row[ok], col[ok]] = got[ok]
        row, col, turn = row[~ok], col[~ok], turn + 1
    filled = filled.reshape(n_lines, BANDS, ROWS)
    out = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (n_lines, BANDS))
    for r in range(ROWS):
        out = mix(out * np.uint64(3) + filled[:, :, r])
    return out


def _check(raw: bytes, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A second hash of each line."""
    own = [hashlib.blake2b(raw[a:b], digest_size=8).digest() for a, b in zip(start.tolist(), end.tolist(), strict=True)]
    return np.frombuffer(b"".join(own), np.int64)


def _packed(counts: np.ndarray, values: np.ndarray) -> pa.Array:
    """A binary for each row: the rows' values end where counts say."""
    width = values.nbytes // max(len(values), 1)
    return pa.Array.from_buffers(pa.binary(), len(counts) - 1, [None, pa.py_buffer((counts * width).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


def _read(it):
    """Per row: id, row, the number of lines; packed, number, key and check of each line that is not blank; and of keys that are
    new in the slice the key and BANDS sigs."""
    for batch in it:
        for first, data, offsets in text_slices(batch.column(2)):
            data = np.frombuffer(data.tobytes().lower(), np.uint8)
            start, end, heads = split_lines(data, offsets)
            own = np.flatnonzero(end > start)
            prefix = prefix_hash(data)
            key = span_hash(prefix, start[own], end[own])
            new = np.zeros(len(own), bool)
            new[np.unique(key, return_index=True)[1]] = True
            h, line = shingles(data, start[own[new]], end[own[new]], prefix)
            sig = signatures(h, line, np.count_nonzero(new))
            k = len(offsets) - 1
            solid = np.searchsorted(own, heads)
            spots = (own - np.repeat(heads[:-1], np.diff(solid))).astype(np.int32)
            fresh = np.concatenate([[0], np.cumsum(new)])[solid]
            packed = _packed(solid, spots), _packed(solid, key), _packed(solid, _check(data.tobytes(), start[own], end[own])), _packed(fresh, key[new]), _packed(fresh, sig)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(first, k), batch.column(1).slice(first, k), pa.array(np.diff(heads)), pa.array(np.diff(solid)), pa.array(np.diff(fresh)), *packed],
                ["id", "row", "n_lines", "n_solid", "n_new", "spots", "lines", "checks", "keys", "sigs"],
            )


def _places(read: DataFrame, shared: DataFrame, rows: int, chunk: int = PER_TASK, few: int = FEW) -> DataFrame:
    """A table (id, row, line, key, check, asked) of the places of lines whose key is in `shared` or has several places; of each
    key in shared, one place is `asked`.

    All places (`rows` of them) go to the tasks of their keys as packed numbers, a row for each task and chunk; what no other
    place and no bucket asks for ends there. Of a key with more than `few` places in a chunk, one goes to the key's task, which
    is told that there are more, and the others are dealt out by a hash of the place.
    """
    n = max(1, -(-rows // PER_TASK))
    id_type = read.schema["id"].dataType.simpleString()
    alone, spread, told, wanted = range(4)  # places in their key's task; dealt out; keys known to be repeated; keys in shared

    def keys_alone(kind: int, key: np.ndarray, ids: pa.Array):
        batch = pieces(kind, task_of(key, n), key)
        return sent(batch, pa.ListArray.from_arrays(pa.array(np.zeros(batch.num_rows + 1, np.int32)), ids.slice(0, 0)))

    def sent(batch: pa.RecordBatch, ids: pa.Array):
        return pa.RecordBatch.from_arrays([*batch.columns[:2], ids, batch.column(2)], ["task", "kind", "ids", "data"])

    def places(kind: int, to: np.ndarray, place: np.ndarray, ids: pa.Array):
        cuts = np.append(np.flatnonzero(np.diff(to, prepend=-1)), len(to)).astype(np.int32)
        return sent(pieces(kind, to, place), pa.ListArray.from_arrays(pa.array(cuts), ids))

    def dealt(place: np.ndarray, ids: pa.Array, owner: np.ndarray):
        order = np.argsort(place["key"], kind="stable")
        place, owner = place[order], owner[order]
        key = place["key"]
        head = np.concatenate([[True], key[1:] != key[:-1]])
        size = np.diff(np.append(np.flatnonzero(head), len(key)))
        many = np.repeat(size > few, size) & ~head
        if many.any():
            yield keys_alone(told, key[head][size > few], ids)
            to = task_of(mix(mix(place["file"][many].view(np.uint64) ^ mix(place["at"][many].view(np.uint64))) + place["line"][many].astype(np.uint64)), n)
            order = np.argsort(to, kind="stable")
            yield places(spread, to[order], place[many][order], ids.take(pa.array(owner[many][order])))
            place, owner = place[~many], owner[~many]
        yield places(alone, task_of(place["key"], n), place, ids.take(pa.array(owner)))

    def packed(it):
        parts, ids, held, texts = [], [], 0, 0
        owners = []
        for batch in it:
            key, solid = end_to_end(batch.column(3), np.uint64)
            place = np.empty(len(key), _PLACE)
            place["key"], place["check"], place["line"] = key, end_to_end(batch.column(4), np.int64)[0], end_to_end(batch.column(2), np.int32)[0]
            for name, x in zip(("file", "at"), batch.column(1).flatten(), strict=True):
                place[name] = np.repeat(x.to_numpy(zero_copy_only=False), solid)
            parts.append(place)
            ids.append(batch.column(0))
            owners.append(np.repeat(np.arange(texts, texts + len(solid)), solid))
            held, texts = held + len(place), texts + len(solid)
            if held >= chunk:
                yield from dealt(np.concatenate(parts), pa.concat_arrays(ids), np.concatenate(owners))
                parts, ids, owners, held, texts = [], [], [], 0, 0
        if held:
            yield from dealt(np.concatenate(parts), pa.concat_arrays(ids), np.concatenate(owners))

    def asked(it):
        for batch in it:
            key = np.unique(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64))
            yield pa.RecordBatch.from_arrays(pieces(wanted, task_of(key, n), key).columns, ["task", "kind", "data"])

    def found(it):
        parts, ids, keys = ([], []), ([], []), ([], [])
        for batch in it:
            for kind, own, data in zip(batch.column(1).to_pylist(), batch.column(2), batch.column(3), strict=True):
                if kind in (alone, spread):
                    parts[kind].append(np.frombuffer(data.as_buffer(), _PLACE))
                    ids[kind].append(own.values)
                else:
                    keys[kind - told].append(np.frombuffer(data.as_buffer(), np.uint64))
        more, inside = (np.concatenate([*k, np.zeros(0, np.uint64)]) for k in keys)
        for kind in (alone, spread):
            if not parts[kind]:
                continue
            place = np.concatenate(parts[kind])
            at, first = np.arange(len(place)), np.zeros(len(place), bool)
            if kind == alone:
                order = np.argsort(place["key"])
                key = place["key"][order]
                same = key[1:] == key[:-1]
                keep = np.isin(key, np.concatenate([more, inside]))
                keep[1:] |= same
                keep[:-1] |= same
                at = order[keep]
                kept = place[at]
                at = at[np.lexsort((kept["line"], kept["at"], kept["file"], kept["key"]))]
                key = place["key"][at]
                first = np.isin(key, inside) & np.concatenate([[True], key[1:] != key[:-1]])[: len(key)]
            place = place[at]
            row = pa.StructArray.from_arrays([pa.array(place["file"]), pa.array(place["at"])], ["file", "at"])
            yield pa.RecordBatch.from_arrays(
                [pa.concat_arrays(ids[kind]).take(pa.array(at)), row, pa.array(place["line"]), pa.array(as_long(place["key"])), pa.array(place["check"]), pa.array(first)],
                ["id", "row", "line", "key", "check", "asked"],
            )

    schema = f"task int, kind int, ids array<{id_type}>, data binary"
    sent_places = read.select("id", "row", "spots", "lines", "checks").mapInArrow(packed, schema)
    sent_keys = shared.select("key").mapInArrow(asked, "task int, kind int, data binary").select("task", "kind", F.lit(None).cast(f"array<{id_type}>").alias("ids"), "data")
    both = sent_places.unionByName(sent_keys).repartitionById(n, "task")
    return materialize(both.mapInArrow(found, f"id {id_type}, row {ROW}, line int, key long, check long, asked boolean"), "places")


def _pick(it):
    """Rows of (text, wanted: array of (line number, key)) to (key, check, folded line, number of shingles, sketch)."""
    for batch in it:
        wanted = batch.column(1)
        for first, data, offsets in text_slices(batch.column(0)):
            part = wanted.slice(first, len(offsets) - 1)
            spot, asked = (x.to_numpy(zero_copy_only=False) for x in part.flatten().flatten())
            owner = np.repeat(np.arange(len(part)), np.diff(part.offsets.to_numpy()))
            # what stands before the line feed of that number in the text and after the one before it, line after line
            feeds = np.append(np.flatnonzero(data == 10), len(data))
            n = np.searchsorted(feeds, offsets[owner]) + spot
            a = np.where(spot > 0, feeds[np.clip(n - 1, 0, len(feeds) - 1)] + 1, offsets[owner])
            b = np.minimum(feeds[np.minimum(n, len(feeds) - 1)], offsets[owner + 1])
            data = LOWER[np.concatenate([data[:0], *(data[x:y] for x, y in zip(a.tolist(), b.tolist(), strict=True))])]
            start, end, _ = split_lines(data, np.concatenate([[0], np.cumsum(np.maximum(b - a, 0))]))
            prefix = prefix_hash(data)
            if not np.array_equal(as_long(span_hash(prefix, start, end)), asked):
                raise ValueError("docs gave other rows when read again; write it to a table first")
            raw = data.tobytes()
            h, line = shingles(data, start, end, prefix)
            cuts = np.searchsorted(line, np.arange(len(asked) + 1)).tolist()
            for x, y in pairwise(cuts):
                h[x:y].sort()
            fresh = np.ones(len(h), bool)
            fresh[1:] = (h[1:] != h[:-1]) | (line[1:] != line[:-1])
            h, line = h[fresh], line[fresh]
            cuts = np.searchsorted(line, np.arange(len(asked) + 1))
            texts = [raw[x:y].decode("utf-8", "replace") for x, y in zip(start.tolist(), end.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(asked, pa.int64()), pa.array(_check(raw, start, end)), pa.array(texts, pa.string()), pa.array(np.diff(cuts)), parity_sketches(h, cuts)],
                ["key", "check", "line", "n", "sketch"],
            )


def _jaccard(t: Fraction):
    def shingled(s):
        return {s[i : i + CHARS] for i in range(max(1, len(s) - CHARS + 1))}

    def rows(it):
        last, y = None, set()
        for batch in it:
            keep = []
            for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if b != last:  # pairs with one leader often stand together
                    last, y = b, shingled(b)
                x = shingled(a)
                common = len(x & y)
                keep.append(common * t.denominator >= (len(x) + len(y) - common) * t.numerator)
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return rows


def _verdicts(base: DataFrame, threshold: str) -> DataFrame:
    """For rows (id, row, text), read alike each time: row, id, n_lines and dropped."""
    t = Fraction(threshold)
    ship(base.sparkSession)
    id_type = base.schema["id"].dataType.simpleString()
    read = f"id {id_type}, row {ROW}, n_lines long, n_solid long, n_new long, spots binary, lines binary, checks binary, keys binary, sigs binary"
    read = materialize(base.mapInArrow(_read, read), "lines")
    n_solid, n_new = read.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("n_solid", "n_new")]).first()
    shared = packed_buckets(read, BANDS * n_new, by_members=True)
    places = _places(read, shared, n_solid)
    # the text of each key in a shared bucket, from one of its places
    wanted = places.where("asked").groupBy("row").agg(F.collect_list(F.struct(F.col("line").alias("spots"), "key")).alias("wanted"))  # a list per text
    texts = materialize(  # a text's list is small beside the text, which need not be sorted then
        base.select("row", "text").join(wanted.hint("shuffle_hash"), "row").select("text", "wanted").mapInArrow(_pick, "key long, check long, line string, n long, sketch array<long>"), "texts"
    )

    def linked(pairs: DataFrame) -> DataFrame:
        return pairs.select("x", "y", "x_line", "y_line").mapInArrow(_jaccard(t), "x long, y long")

    forest = bucket_components(shared, texts.select("key", "n", "sketch"), texts.drop("check"), lambda: close(t), linked, light=True)
    # each line's first place and number of places, then those of its component
    at = F.struct(F.col("id").isNull().alias("none"), "id", "row", "line")
    alike = places.groupBy("key", "check").agg(F.min(at).alias("first"), F.count("*").alias("n"))
    known = texts.select("key", "check").join(forest.withColumnRenamed("node", "key"), "key", "left").select("key", "check", F.coalesce("component", "key").alias("component"))
    # a line beside the buckets, or one that shares a key but not its check, is a component of its own
    alike = materialize(alike.join(known, ["key", "check"], "left").where("n > 1 or component is not null"), "alike")
    # a table of its own, so that the join deals both sides anew and adaptive execution can split a hot component
    whole = materialize(alike.where("component is not null").groupBy("component").agg(F.min("first").alias("kept"), F.sum("n").alias("all")), "whole")
    kept = alike.join(whole, "component", "left").where("coalesce(all, n) > 1").select("key", "check", F.coalesce("kept", "first").alias("kept"))
    kept = materialize(kept, "kept")
    discard(shared, texts, forest)
    gone = (
        places.join(kept, ["key", "check"]).where("row != kept.row or line != kept.line")
        .groupBy("row").agg(F.array_sort(F.collect_list("line")).alias("dropped"))  # one text's lines
    )
    gone = materialize(gone, "gone")
    discard(alike, whole, kept, places)
    out = read.select("row", "id", "n_lines").join(gone, "row", "left")
    out = out.select("row", "id", "n_lines", F.coalesce("dropped", F.array().cast("array<int>")).alias("dropped"))
    out.gone, out.read = gone, read
    return out


def line_verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: str = "0.8") -> DataFrame:
    """A row per row of docs: the id column, n_lines and dropped, the numbers (from 0) of the lines that go, in order."""
    row = free_name(docs, "row")
    base = with_rows(docs, row).select(F.col(id_col).alias("id"), F.col(row).alias("row"), F.col(text_col).alias("text"))
    return _verdicts(base, threshold).select(F.col("id").alias(id_col), "n_lines", "dropped")


def _without(text: Column, dropped: Column) -> Column:
    """The text without the lines of those numbers (ascending): what stands between two of them is taken in one piece, so that
    the work is in proportion to the lines."""

    def cut(lines):
        def piece(k):
            before = F.coalesce(F.get(dropped, k - 1), F.lit(-1))
            return F.slice(lines, before + 2, F.coalesce(F.get(dropped, k), F.size(lines)) - before - 1)

        return F.array_join(F.flatten(F.transform(F.sequence(F.lit(0), F.size(dropped)), piece)), "\n")

    return F.transform(F.array(F.split(text, "\n", -1)), cut)[0]  # an array of one, so that the lines are split once


def drop_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: str = "0.8") -> DataFrame:
    """docs with the dropped lines taken out of text_col; rows that lose every solid line go. Other columns stay."""
    row, dropped = free_name(docs, "row"), free_name(docs, "dropped")
    base = with_rows(docs, row)
    found = _verdicts(base.select(F.col(id_col).alias("id"), F.col(row).alias("row"), F.col(text_col).alias("text")), threshold)
    discard(found.read)
    gone = found.gone.select(F.col("row").alias(row), F.col("dropped").alias(dropped))
    cut = _without(F.col(text_col), F.col(dropped))
    return (
        base.join(gone.hint("merge"), row, "left")  # it grows with docs: no broadcast
        .withColumn(text_col, F.when(F.col(dropped).isNull(), F.col(text_col)).otherwise(cut))
        .where(F.col(dropped).isNull() | F.col(text_col).rlike(r"[^\x20\x09-\x0D]"))
        .select(*docs.columns)
    )
