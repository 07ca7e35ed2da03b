"""Operator 4: secret scans, in DataFrame functions only.

Base kinds are patterns (assign, access, hex). The method adds spans of high entropy: over candidate strings of a character
class a window slides one character at a time, and the Shannon entropy of its characters follows from counts that each step
changes in two places: with g(c) = c log2 c, H = log2(w) - sum(g(count)) / w. The counts are state of the walk, a string with
a count at the place of each character's code; a step reads and writes the two of the characters that leave and enter. The
sum is kept in whole millionths, so that thresholds compare exactly. A span runs from the first window at or above the
threshold to the end of the last.

Suppression is by span: base spans and marks of the allow-list cut a candidate, and windows slide over each piece that is
left, so that one mark does not hide the rest of a run; pieces that are no secret as a whole (numbers, words) go. Base spans
always stay. SMALL has further classes for the alphabets of 32 to 36 symbols, whose windows seldom reach 4.1 bits.

A kind's places follow from the lengths of the text's pieces between its matches and of the matches, in code points.
Texts without a match, nearly all, only pay for the search. Work is in proportion to the text, but for a binary search of
each candidate among the base spans.

Defined cases: null text is empty; repeated rows and ids give a row each; other columns are ignored.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Name, pattern, group that counts, its least length. For access and hex the length stands in the pattern:
#: their matches are whole runs, so a run that is too short holds no match of the longer form either.
BASE = (
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", r"AKIA[A-Z0-9]{14,}", 0, 18),
    ("hex", r"[0-9a-f]{16,}", 0, 16),
)
#: name, candidate pattern, alphabet (characters count alike beyond case as listed), window, threshold in bits
CLASSES = (
    ("entropy_hex", r"[0-9A-Fa-f]{20,}", "0123456789abcdefABCDEF", 20, 3.2),
    ("entropy_base64", r"[A-Za-z0-9+/=_-]{24,}", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/=_-", 24, 4.1),
)
#: Further classes: of random keys of 32 characters, about 99 % reach the threshold (24: 97 and 93 %).
SMALL = (
    ("entropy_base36", r"[a-z0-9]{24,}", "abcdefghijklmnopqrstuvwxyz0123456789", 24, 3.7),
    ("entropy_base32", r"[A-Z0-9]{24,}", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", 24, 3.7),
)
#: The allow-list by span: what cuts a candidate wherever it stands, and pieces that as a whole are no secret.
MARKS = r"(?i:example|placeholder|changeme|xxxx+)|0123456789|abcdefghij|ABCDEFGHIJ|[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"
WHOLE = (r"^[0-9]+$", r"^([a-z_-]+|[A-Z_-]+)$")
_MILLION = 1_000_000
_KINDS = [b[0] for b in BASE] + [c[0] for c in CLASSES + SMALL] + ["mark"]
BLOCK = 128  # matches whose places are summed together
CHUNK = 256  # windows that are walked together
STRETCH = 4096  # characters of a run that are cut out of together
_SPAN = "array<struct<start:int,kind:int,end:int,text:string>>"


def g_table(window: int) -> list[int]:
    """g(0) ... g(window) in whole millionths."""
    return [round(_MILLION * c * math.log2(c)) if c else 0 for c in range(window + 1)]


def most_g(window: int, bits: float) -> int:
    """The largest sum of g with which a window reaches the threshold."""
    return math.floor(_MILLION * window * (math.log2(window) - bits))


def _let(value: Column, use) -> Column:
    """use(value), with value evaluated once."""
    return F.transform(F.array(value), use)[0]


def _found(text: Column, kind: str, pattern: str, group: int, least: int) -> Column:
    """(start, kind, end, text) of the matches whose group has `least` characters, in order. Places are running sums, first
    over blocks of BLOCK matches, then within each, so that no array grows match by match."""
    p = F.lit(pattern)
    parts = F.arrays_zip(
        F.transform(F.split(text, pattern, -1), F.length).alias("gap"),
        F.regexp_extract_all(text, p, F.lit(0)).alias("m"),
        F.regexp_extract_all(text, p, F.lit(group)).alias("v"),
    )
    none = F.array().cast(_SPAN)

    def size(x):  # the last part is a gap alone
        return x["gap"] + F.coalesce(F.length(x["m"]), F.lit(0))

    def step(acc, x):
        start = acc["at"] + x["gap"]
        end = start + F.coalesce(F.length(x["m"]), F.lit(0))
        hit = F.array(F.struct(start.alias("start"), F.lit(_KINDS.index(kind)).alias("kind"), end.alias("end"), x["m"].alias("text")))
        return F.struct(end.alias("at"), F.when(F.length(x["v"]) >= least, F.concat(acc["out"], hit)).otherwise(acc["out"]).alias("out"))

    def placed(blocks):
        ends = F.aggregate(blocks, F.array(F.lit(0)), lambda acc, b: F.concat(acc, F.array(F.element_at(acc, -1) + F.aggregate(b, F.lit(0), lambda n, x: n + size(x)))))
        return _let(ends, lambda e: F.flatten(F.transform(blocks, lambda b, k: F.aggregate(b, F.struct(e[k].alias("at"), none.alias("out")), step)["out"])))

    blocks = _let(parts, lambda ps: F.transform(F.sequence(F.lit(0), F.floor((F.size(ps) - 1) / BLOCK).cast("int")), lambda k: F.slice(ps, k * BLOCK + 1, BLOCK)))
    return F.when(text.rlike(pattern), _let(blocks, placed)).otherwise(none)


def _window_span(text: Column, window: int, bits: float) -> Column:
    """(first, last) window start, from 0, at or above the threshold; nulls if there is none. The windows that begin in a
    chunk of CHUNK characters are walked together. The state holds the counts of the window's characters, by code, and the sum
    of their g; when a character leaves or enters, its count and its share of the sum change."""
    g = F.array(*[F.lit(x) for x in g_table(window)])
    limit = most_g(window, bits)
    zero = ord("0")  # counts are kept as characters from here on

    def change(state, code, by):
        """state with the count of the character of this code raised or lowered by one; as it is where code is null."""

        def changed(n):
            total = state["sum"] + F.element_at(g, n + 1 + by) - F.element_at(g, n + 1)
            counts = F.overlay(state["counts"], F.chr(n + zero + by), code + 1, F.lit(1))
            return F.struct(F.coalesce(total, state["sum"]).cast("int").alias("sum"), F.coalesce(counts, state["counts"]).alias("counts"))

        return _let(F.ascii(F.substr(state["counts"], code + 1, F.lit(1))) - zero, changed)

    def walk(piece):
        def code(i):
            return F.ascii(F.substr(piece, i, F.lit(1)))

        def step(acc, i):
            left = _let(F.when(i > window, code(i - window)), lambda c: change(acc, c, -1))
            entered = _let(left, lambda state: _let(code(i), lambda c: change(state, c, 1)))
            return _let(
                entered,
                lambda now: F.struct(
                    now["sum"].alias("sum"), now["counts"].alias("counts"),
                    F.when((i >= window) & (now["sum"] <= limit) & acc["first"].isNull(), i - window).otherwise(acc["first"]).cast("int").alias("first"),
                    F.when((i >= window) & (now["sum"] <= limit), i - window).otherwise(acc["last"]).cast("int").alias("last"),
                ),
            )

        null = F.lit(None).cast("int")
        return F.aggregate(F.sequence(F.lit(1), F.length(piece)), F.struct(F.lit(0).alias("sum"), F.lit(chr(zero) * 128).alias("counts"), null.alias("first"), null.alias("last")), step)

    def chunked(chunks):
        def one(chunk, k):
            piece = F.concat(chunk, F.substr(F.coalesce(F.get(chunks, k + 1), F.lit("")), F.lit(1), F.lit(window - 1)))
            return _let(_let(piece, walk), lambda w: F.struct((k * CHUNK + w["first"]).alias("first"), (k * CHUNK + w["last"]).alias("last")))

        return _let(F.transform(chunks, one), lambda ws: F.struct(F.array_min(F.transform(ws, lambda w: w["first"])).alias("first"), F.array_max(F.transform(ws, lambda w: w["last"])).alias("last")))

    return _let(F.regexp_extract_all(text, F.lit(f".{{1,{CHUNK}}}"), F.lit(0)), chunked)


def _allowed(text: Column, rules: tuple[str, ...]) -> Column:
    return reduce(Column.__or__, [text.rlike(a) for a in rules])


def _first_beyond(spans: Column, place: Column) -> Column:
    """The index, from 0, of the first of the spans of a kind (in order, apart from each other) that ends behind place."""

    def halve(acc, _):
        middle = F.floor((acc["lo"] + acc["hi"]) / 2).cast("int")
        beyond = F.get(spans, middle)["end"] > place
        return F.when(acc["lo"] >= acc["hi"], acc).otherwise(F.struct(F.when(beyond, acc["lo"]).otherwise(middle + 1).alias("lo"), F.when(beyond, middle).otherwise(acc["hi"]).alias("hi")))

    steps = F.sequence(F.lit(1), F.length(F.bin(F.size(spans))))
    return F.aggregate(steps, F.struct(F.lit(0).alias("lo"), F.size(spans).alias("hi")), halve)["lo"]


def _pieces(x: Column, kinds: list[str]) -> Column:
    """What is left of the span x without the spans of the columns. Those within x are worked through in blocks, each from the
    place that all before it reach to, and characters are cut out of stretches, so that no array or text grows piece by piece."""
    none = F.array().cast(_SPAN)

    def inside(kind):
        spans = F.col(kind)
        return _let(_first_beyond(spans, x["start"]), lambda a: F.slice(spans, a + 1, F.greatest(_first_beyond(spans, x["end"] - 1) + 1 - a, F.lit(0))))

    def cut_out(stretches, start, end):
        """Characters start to end of x, from the few stretches that they lie in."""
        lo, hi = start - x["start"], end - x["start"]
        first = F.floor(lo / STRETCH).cast("int")
        some = F.transform(F.sequence(first, F.floor((hi - 1) / STRETCH).cast("int")), lambda k: F.get(stretches, k))
        return F.substr(F.array_join(some, ""), lo - first * STRETCH + 1, hi - lo)

    def left_over(cuts, stretches):
        def piece(start, end):
            return F.array(F.struct(start.alias("start"), x["kind"].alias("kind"), end.alias("end"), cut_out(stretches, start, end).alias("text")))

        def step(acc, b):
            out = F.when(b["start"] > acc["at"], F.concat(acc["out"], piece(acc["at"], b["start"]))).otherwise(acc["out"])
            return F.struct(F.greatest(acc["at"], b["end"]).alias("at"), out.alias("out"))

        def worked(blocks):
            reach = F.aggregate(blocks, F.array(x["start"]), lambda acc, b: F.concat(acc, F.array(F.greatest(F.element_at(acc, -1), F.array_max(F.transform(b, lambda c: c["end"]))))))

            def pieces(at):
                before = F.flatten(F.transform(blocks, lambda b, k: F.aggregate(b, F.struct(F.get(at, k).alias("at"), none.alias("out")), step)["out"]))
                end = F.element_at(at, -1)
                return F.when(end < x["end"], F.concat(before, piece(end, x["end"]))).otherwise(before)

            return _let(reach, pieces)

        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(cuts) - 1) / BLOCK).cast("int")), lambda k: F.slice(cuts, k * BLOCK + 1, BLOCK))
        return _let(blocks, worked)

    cuts = F.filter(F.array_sort(F.concat(*[inside(k) for k in kinds])), lambda b: _overlap(x, b))
    some = _let(cuts, lambda cs: _let(F.regexp_extract_all(x["text"], F.lit(f".{{1,{STRETCH}}}"), F.lit(0)), lambda parts: left_over(cs, parts)))
    return F.when(F.size(cuts) > 0, some).otherwise(F.array(F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end"), x["text"].alias("text"))))


def _high(spans: Column, window: int, bits: float) -> Column:
    """The part of each span from its first window at or above the threshold to its last; spans without one go."""
    with_span = F.transform(spans, lambda x: F.struct(x.alias("x"), _window_span(x["text"], window, bits).alias("w")))
    return F.transform(
        F.filter(with_span, lambda y: y["w"]["first"].isNotNull()),
        lambda y: F.struct(
            (y["x"]["start"] + y["w"]["first"]).alias("start"),
            y["x"]["kind"].alias("kind"),
            (y["x"]["start"] + y["w"]["last"] + window).alias("end"),
            F.substr(y["x"]["text"], y["w"]["first"] + 1, y["w"]["last"] - y["w"]["first"] + window).alias("text"),
        ),
    )


def _overlap(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


_BASES = [f"__b{k}" for k in range(len(BASE))]


def _base(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The id column, __t (the text) and __b0 ...: its base spans by kind."""
    rows = docs.select(id_col, F.coalesce(F.col(text_col), F.lit("")).alias("__t"))
    return rows.select(id_col, "__t", *[_found(F.col("__t"), *b).alias(name) for name, b in zip(_BASES, BASE, strict=True)])


def _result(got: DataFrame, id_col: str, classes: int) -> DataFrame:
    names = F.array(*[F.lit(k) for k in _KINDS])

    def named(column: Column) -> Column:
        return F.transform(
            F.array_sort(column),
            lambda s: F.struct(s["start"].alias("start"), F.element_at(names, s["kind"] + 1).alias("kind"), s["end"].alias("end"), s["text"].alias("text")),
        )

    base, added = F.concat(*_BASES), F.concat(*[f"__c{k}" for k in range(classes)])
    return got.select(id_col, named(base).alias("base"), named(added).alias("added"), named(F.concat(base, added)).alias("all_spans"))


def scan(docs: DataFrame, classes: tuple = CLASSES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per row of docs: the id column, base and added: arrays of (start, kind, end, text), kind by name."""
    base, text, parts = _base(docs, id_col, text_col), F.col("__t"), []
    any_run = reduce(Column.__or__, [text.rlike(c[1]) for c in classes])
    marks = F.when(any_run, _found(text, "mark", MARKS, 0, 0)).otherwise(F.array().cast(_SPAN))
    cut = base.select(id_col, "__t", *_BASES, marks.alias("__marks"))
    for k, (name, pattern, _, window, bits) in enumerate(classes):
        pieces = F.flatten(F.transform(_found(text, name, pattern, 0, window), lambda x: _pieces(x, [*_BASES, "__marks"])))
        fresh = F.filter(pieces, lambda x: (F.length(x["text"]) >= window) & ~_allowed(x["text"], WHOLE))  # noqa: B023
        parts.append(F.when(text.rlike(pattern), _high(fresh, window, bits)).otherwise(F.array().cast(_SPAN)).alias(f"__c{k}"))
    return _result(cut.select(id_col, *_BASES, *parts), id_col, len(classes))


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts of the base kinds, the digest of the base spans, and all spans, joined."""
    count = [F.size(F.filter("base", lambda s: s["kind"] == b[0])).cast("long").alias(f"n_{b[0]}") for b in BASE]  # noqa: B023
    return found.select(id_col, *count, F.sha2(joined(F.col("base")).cast("binary"), 256).alias("base_sha256"), joined(F.col("all_spans")).alias("spans"))
