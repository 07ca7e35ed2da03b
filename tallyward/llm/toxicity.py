"""Operator 7: toxicity by multiple-instance learning.

A text is a bag of sentences. A sentence scores p = sigmoid(bias + sum of its words' weights); a text scores the noisy-or
1 - prod(1 - leak) prod(1 - p) over its sentences, so that only document labels are needed to train sentence scores. Each
distinct word, and the first STEM bytes of each longer one, count once a sentence; weights stand in a table of 2**BITS hashed places. Training minimises the
cross-entropy of the texts' scores with L1-shrunk Adagrad steps on at most `rows` labelled texts (a bounded sample, picked
by a hash of the id; whole texts). Scoring is one pass over the whole texts; the weights (2**BITS numbers) are broadcast.

Defined cases: null or empty text scores the leak alone; without labelled rows of both kinds all texts score the share of
label 1 (0 if there are no labels); null labels and ids are not learned from; repeated rows and ids score alike; other
columns are ignored, and kept ones may have any name but those of the outputs, which can be changed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, free_name, mix, prefix_hash, ship, span_hash, text_slices, words

BITS = 18
STEM = 6  # bytes of a longer word's beginning, which count as a word of their own
_GAP = np.ones(256, bool)
_GAP[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".!?\n|"]] = True


def bags(column) -> tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first row, place of each distinct word of a sentence, its sentence, text of each sentence, (start, end) bytes)."""
    for first, data, offsets in text_slices(column):
        low = LOWER[data]
        start, end, _ = words(low, offsets, _GAP)
        prefix = prefix_hash(low)
        place = (span_hash(prefix, start, end) >> np.uint64(64 - BITS)).astype(np.int64)
        long = np.flatnonzero(end - start > STEM)
        stem = (mix(span_hash(prefix, start[long], start[long] + STEM)) >> np.uint64(64 - BITS)).astype(np.int64)
        ends = np.flatnonzero(_STOP[low]) + 1
        cut = np.unique(np.concatenate([offsets[:-1], ends, offsets[-1:]]))
        sentence = np.searchsorted(cut, start, "right") - 1
        used, sentence = np.unique(sentence, return_inverse=True)
        pair = np.unique(np.concatenate([sentence * (1 << BITS) + place, sentence[long] * (1 << BITS) + stem]))
        text = np.searchsorted(offsets, cut[used], "right") - 1
        span = np.stack([cut[used], cut[np.minimum(used + 1, len(cut) - 1)]], 1) if len(used) else np.zeros((0, 2), np.int64)
        yield first, pair & ((1 << BITS) - 1), pair >> BITS, text, span, offsets


def _sums(values: np.ndarray, group: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(group, values, n) if len(group) else np.zeros(n)


class Model:
    def __init__(self, weights: np.ndarray, bias: float, leak: float):
        self.weights, self.bias, self.leak = weights, bias, leak

    def sentences(self, place: np.ndarray, sentence: np.ndarray, n: int) -> np.ndarray:
        z = _sums(self.weights[place], sentence, n) + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -700, 700)))

    def texts(self, p: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
        return 1 - (1 - self.leak) * np.exp(_sums(np.log1p(-np.minimum(p, 1 - 1e-12)), text, n))


def train(place: np.ndarray, sentence: np.ndarray, text: np.ndarray, label: np.ndarray, rounds: int = 300, l1: float = 3e-4) -> Model:
    """Full-batch training; place/sentence: words of sentences, text: the text of each sentence, label: of each text."""
    share = float(label.mean()) if len(label) else 0.0
    if len(label) == 0 or share in (0.0, 1.0):
        return Model(np.zeros(1 << BITS), -700.0, share)
    n_s, n_t = len(text), len(label)
    # places that one text alone holds can only be learned by heart
    holders = np.unique(place * n_t + text[sentence]) // n_t
    often = np.bincount(holders, minlength=1 << BITS) >= 5
    keep = often[place]
    place, sentence = place[keep], sentence[keep]
    w, g2 = np.zeros(1 << BITS), np.full(1 << BITS, 1e-8)
    model = Model(w, -6.0, 0.5 * share)
    b2 = l2 = 1e-8
    balance = np.where(label == 1, 0.5 / share, 0.5 / (1 - share)) ** 0.5
    balance /= balance.sum()
    for r in range(rounds):
        p = model.sentences(place, sentence, n_s)
        score = np.clip(model.texts(p, text, n_t), 1e-9, 1 - 1e-9)
        # d loss / d log(1 - score), then by sentence: d log(1 - p) / dz = -p
        up = balance * (np.where(label == 1, (1 - score) / score, -1.0))
        dz = -up[text] * p
        grad = _sums(dz[sentence], place, 1 << BITS)
        g2 += grad**2
        step = 0.5 / np.sqrt(g2)
        w -= step * grad
        w[:] = np.sign(w) * np.maximum(np.abs(w) - step * l1 * (grad != 0), 0)
        d = dz.sum()
        b2 += d * d
        model.bias -= 0.3 * d / np.sqrt(b2)
        d = (-up).sum() / (1 - model.leak)
        l2 += d * d
        model.leak = float(np.clip(model.leak - 0.02 * d / np.sqrt(l2), 1e-4, 0.4))
    return model


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", rows: int = 6_000) -> Model:
    """Train on at most about `rows` labelled texts. `labels` holds those that may be learned from."""
    ship(docs.sparkSession)
    usable = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(id_col).agg(F.max(label_col).cast("int").alias("y"))
    sample = usable.orderBy(F.xxhash64(id_col), id_col).limit(rows)
    texts = docs.select(F.col(id_col), F.col(text_col).alias("text")).join(F.broadcast(sample), id_col)  # `rows` rows at most

    def words_of(it):
        for batch in it:
            y = batch.column(1)
            for first, place, sentence, text, _, offsets in bags(batch.column(0)):
                bounds = np.searchsorted(sentence, np.searchsorted(text, np.arange(len(offsets))))
                n = np.diff(bounds)
                kinds = pa.ListArray.from_arrays
                head = pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32))
                first_s = np.searchsorted(text, np.arange(len(offsets)))
                own = sentence - np.repeat(first_s[:-1], n)
                yield pa.RecordBatch.from_arrays(
                    [y.slice(first, len(n)), kinds(head, pa.array(place.astype(np.int32))), kinds(head, pa.array(own.astype(np.int32)))], ["y", "place", "sentence"]
                )

    got = texts.select("text", "y").mapInArrow(words_of, "y int, place array<int>, sentence array<int>").toArrow().combine_chunks()
    label = np.array(got.column("y").to_pylist(), np.int64)

    def flat(name):
        chunks = got.column(name).chunks
        return np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in chunks]).astype(np.int64) if chunks else np.zeros(0, np.int64)

    sizes = np.array([len(x) if x is not None else 0 for c in got.column("place").chunks for x in c], np.int64)
    place, own = flat("place"), flat("sentence")
    doc = np.repeat(np.arange(len(label)), sizes)
    pair, sentence = np.unique(doc * (1 << 32) + own, return_inverse=True)
    return train(place, sentence, pair >> 32, label)


def score(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), spans: bool = False,
    outputs: tuple[str, str] = ("score", "sentences"),
) -> DataFrame:
    """A row per row of docs: the id column and `keep`, and under the names of `outputs` the score and, with `spans`, the
    offending sentences: an array of (text, score) of sentences that score 0.5 or more, in order."""
    ship(docs.sparkSession)
    outputs = outputs[: 1 + spans]
    if len({n.lower() for n in (id_col, *keep, *outputs)}) < 1 + len(keep) + len(outputs):
        raise ValueError(f"give the outputs other names than {[id_col, *keep]}")
    shared = docs.sparkSession.sparkContext.broadcast((model.weights.astype(np.float32), model.bias, model.leak))
    names = [id_col, *keep]
    head = ", ".join(f"`{n}` {docs.schema[n].dataType.simpleString()}" for n in names) + f", `{outputs[0]}` double"
    kind = pa.list_(pa.struct([("sentence", pa.string()), ("score", pa.float64())]))

    def rows(it):
        model = Model(*shared.value)
        for batch in it:
            column = batch.column(len(names))
            for first, place, sentence, text, span, offsets in bags(column):
                n = len(offsets) - 1
                p = model.sentences(place, sentence, len(text))
                cols = [batch.column(j).slice(first, n) for j in range(len(names))]
                out = [*cols, pa.array(model.texts(p, text, n))]
                if spans:
                    found: list[list] = [[] for _ in range(n)]
                    for s in np.flatnonzero(p >= 0.5):
                        t = int(text[s])
                        raw = column[first + t].as_py().encode()[span[s][0] - offsets[t] : span[s][1] - offsets[t]]
                        found[t].append({"sentence": raw.decode("utf-8", "replace").strip(), "score": float(p[s])})
                    out.append(pa.array(found, kind))
                yield pa.RecordBatch.from_arrays(out, [*names, *outputs])

    schema = head + (f", `{outputs[1]}` array<struct<sentence: string, score: double>>" if spans else "")
    return docs.select(*names, F.col(text_col).alias(free_name(docs, "text_in"))).mapInArrow(rows, schema)
