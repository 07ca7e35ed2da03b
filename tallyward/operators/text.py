"""Quotes and the documents they come from: chunks, verification, context, overlap with labelled spans."""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..shipping import ship

#: Typographic characters and what they count as; each is one character, the last a no-break space.
FOLD_FROM = "‘’“”–—\u00a0"
FOLD_TO = "''\"\"-- "
_FOLD = str.maketrans(FOLD_FROM, FOLD_TO)
QUOTES_AT_ONCE = 512


def chunk_text(df: DataFrame, text: str, size: int = 10_000, overlap: int = 800) -> DataFrame:
    """A row per chunk: chunk_no, chunk_offset, chunk. Chunks start size - overlap apart; the last one ends with the text.
    Null and empty texts have none."""
    step, n = size - overlap, F.length(text)
    count = F.when(n <= size, F.lit(1)).otherwise(F.ceil((n - size) / step) + 1).cast("int")
    rows = df.where(n > 0).withColumn("chunk_no", F.explode(F.sequence(F.lit(0), count - 1))).withColumn("chunk_offset", F.col("chunk_no") * step)
    return rows.withColumn("chunk", F.substr(F.col(text), F.col("chunk_offset") + 1, F.lit(size)))


def context(text: Column, start: Column, end: Column, before: int, after: int) -> tuple[Column, Column]:
    """The characters before and after a span, clipped at the text's ends."""
    lo = F.greatest(start - before, F.lit(0))
    return F.substr(text, lo + 1, start - lo), F.substr(text, end + 1, F.lit(after))


def flattened(text: str) -> tuple[str, np.ndarray, np.ndarray]:
    """The text with typography folded and each run of white space (Unicode's) as one blank, with where the runs of several
    characters end in it, and how many characters were lost up to there."""
    folded = text.translate(_FOLD)
    runs = np.array([m.span() for m in re.finditer(r"\s\s+", folded)], np.int64).reshape(-1, 2)
    lost = np.cumsum(runs[:, 1] - runs[:, 0] - 1)
    return re.sub(r"\s+", " ", folded), runs[:, 1] - lost, lost


def first_places(text: str, quotes: list[str]) -> dict[str, int]:
    """Where each quote occurs first, by one automaton over all of them."""
    if len(quotes) <= 2:
        return {q: at for q in quotes if (at := text.find(q)) >= 0}
    automaton = ahocorasick.Automaton()
    for q in quotes:
        automaton.add_word(q, q)
    automaton.make_automaton()
    found: dict[str, int] = {}
    for end, q in automaton.iter(text):
        if q not in found:
            found[q] = end - len(q) + 1
            if len(found) == len(quotes):
                break
    return found


def verdicts(text: str | None, quotes: list[tuple[str | None, int | None, int | None]]) -> list[tuple[str, int, int]]:
    """(method, start, end) for each (quote, reported start, reported end) of one document."""
    out: list[tuple[str, int, int]] = [("rejected", -1, -1)] * len(quotes)
    if not text:
        return out
    open_, loose = {}, {}
    for i, (q, lo, hi) in enumerate(quotes):
        if q and lo is not None and hi is not None and 0 <= lo < hi and text[lo:hi] == q:
            out[i] = ("exact", lo, hi)
        elif q:
            open_.setdefault(q, []).append(i)
    places = first_places(text, list(open_))
    for q, rows in open_.items():
        if q in places:
            for i in rows:
                out[i] = ("relocated", places[q], places[q] + len(q))
        elif flat := flattened(q)[0].strip():
            loose.setdefault(flat, []).extend(rows)
    if loose:
        flat, ends, lost = flattened(text)
        origin = lambda i: i + int(np.concatenate([[0], lost])[np.searchsorted(ends, i, side="right")])
        for q, at in first_places(flat, list(loose)).items():
            for i in loose[q]:
                out[i] = ("normalized", origin(at), origin(at + len(q) - 1) + 1)
    return out


def verify_quotes(quotes: DataFrame, docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """quotes with method, start and end in the whole document: exact (at the reported place), relocated (its first
    occurrence), normalized (up to white space and typography, first occurrence) or rejected (-1, -1).

    quotes: key, quote, offset (of the chunk), quote_start, quote_end (in the chunk). Empty and null quotes are rejected, and so
    are those of unknown or null documents. A document's text is read once for up to QUOTES_AT_ONCE of its quotes, which are
    looked for together; a document with more is worked on in several tasks.
    """
    ship(quotes.sparkSession)
    names = [c for c in quotes.columns if c not in ("method", "start", "end")]
    lo, hi = F.col("offset") + F.col("quote_start"), F.col("offset") + F.col("quote_end")
    rows = quotes.select(*names, lo.cast("long").alias("__lo"), hi.cast("long").alias("__hi"))
    counts = rows.groupBy(F.col(key).alias("__key")).agg(F.count("*").alias("__n"))
    slot = F.pmod(F.xxhash64("quote", "__lo"), F.ceil(F.col("__n") / QUOTES_AT_ONCE))
    rows = rows.join(counts, F.col(key).eqNullSafe(F.col("__key"))).withColumn("__slot", slot)
    packed = rows.groupBy(key, "__slot").agg(F.collect_list(F.struct(*names, "__lo", "__hi")).alias("__quotes"))
    packed = packed.join(docs.select(key, F.col(text).alias("__text")), key, "left").select("__text", "__quotes")

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            columns = lists.flatten().flatten()
            own = {n: c.to_pylist() for n, c in zip([*names, "__lo", "__hi"], columns, strict=True) if n in ("quote", "__lo", "__hi")}
            spans = list(zip(own["quote"], own["__lo"], own["__hi"], strict=True))
            found, at = [], 0
            for t, size in zip(batch.column(0), lists.value_lengths().to_pylist(), strict=True):
                found += verdicts(t.as_py(), spans[at : at + size])
                at += size
            method, start, end = zip(*found, strict=True) if found else ((), (), ())
            out = [*columns[: len(names)], pa.array(method, pa.string()), pa.array(start, pa.int32()), pa.array(end, pa.int32())]
            yield pa.RecordBatch.from_arrays(out, [*names, "method", "start", "end"])

    fields = quotes.select(*names).schema.add("method", "string").add("start", "integer").add("end", "integer")
    return packed.mapInArrow(kernel, fields)


def stored_span(text: Column, start: Column, end: Column) -> Column:
    """What is kept of a verified quote: the document's own characters."""
    return F.when(start >= 0, F.substr(text, start + 1, end - start))


def topic_or_other(topic: Column) -> Column:
    return F.coalesce(F.nullif(F.lower(F.trim(topic)), F.lit("")), F.lit("other"))


def reject_log(verified: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """(quotes that were found, log of those that were not) of verify_quotes()."""
    return verified.where("method != 'rejected'"), verified.where("method = 'rejected'").select(*columns, F.lit("quote_not_in_document").alias("reason"))
