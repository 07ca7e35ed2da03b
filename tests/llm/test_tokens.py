"""Operators 1 and 8 against the tokenizers library."""

import hashlib
import json
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyward.llm import bpe, token_counts

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
ALPHABETS = ["ab", "abcdefghij", "aéüñ漢字😀", "the ", "12 3", "!?.'s't", "İıßſΣςé́", "\n \t\x1c\x85\xa0"]


def texts(seed, n):
    rng = random.Random(seed)
    out = ["", None, "  \n", "<|endoftext|>", "a<|startoftext|>b", "x" * 5000, "aé" * 900]
    for _ in range(n):
        size = rng.choice([3, 20, 700, 3000])
        t = "".join(rng.choice(rng.choice(ALPHABETS)) for _ in range(size))
        out.append(t.replace(" ", "") if rng.random() < 0.3 else t)
    return out


def test_encoding_is_the_library_s(spark):
    tok = Tokenizer.from_file(WORD)
    docs = list(enumerate(texts(1, 120)))
    got = {r.doc_id: r for r in bpe.encode_decode(spark.createDataFrame(docs, "doc_id long, text string"), WORD, outputs=("n_tokens", "ids", "decoded", "ids_sha256", "decoded_sha256")).collect()}
    for i, t in docs:
        ids = tok.encode(t or "", add_special_tokens=False).ids
        said = tok.decode(ids, skip_special_tokens=False)
        assert (got[i].n_tokens, got[i].ids, got[i].decoded) == (len(ids), ids, said), t
        assert got[i].ids_sha256 == hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(said.encode()).hexdigest()


def test_very_long_stretches_go_by_rows(spark, monkeypatch):
    monkeypatch.setattr(bpe, "_LONG", r"[^\x20\x09-\x0D]{2000,}")
    monkeypatch.setattr(bpe, "SPREAD", 2000)
    tok = Tokenizer.from_file(WORD)
    rng = random.Random(4)
    long = ["".join(rng.choice("abcdeé1.") for _ in range(n)) + " end<|endoftext|>" for n in (2500, 9000)] + ["b" * 6000]
    docs = [(None, long[0]), (7, long[1]), (7, long[2]), (8, "short one"), (9, None)]
    got = sorted((str(r.doc_id), r.ids) for r in bpe.encode_decode(spark.createDataFrame(docs, "doc_id long, text string"), WORD).collect())
    assert got == sorted((str(i), tok.encode(t or "", add_special_tokens=False).ids) for i, t in docs)


def test_join_agrees_with_the_whole(spark):
    c = bpe.Codec(WORD)
    rng = random.Random(9)
    for _ in range(200):
        s = "".join(rng.choice("ab" if rng.random() < 0.5 else "abcdefghijklmnop") for _ in range(rng.randrange(2, 90)))
        k = rng.randrange(1, len(s))
        assert c.tree([c.leaf(s[:k], False), c.leaf(s[k:], True)]) == c.leaf(s, True)


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_token_counts(spark, rule):
    tok = Tokenizer.from_file(BYTE)
    docs = list(enumerate(texts(2, 60)))
    cut = F.array(*[F.struct(F.lit(a).alias("start"), F.lit(b).alias("end")) for a, b in ((0, 2), (3, 3), (3, 9), (9, 400))])
    got = {r.doc_id: r for r in token_counts.count_tokens(spark.createDataFrame(docs, "doc_id long, text string"), BYTE, cut, rule=rule).collect()}
    for i, t in docs:
        spans = tok.encode(t or "", add_special_tokens=False).offsets
        want, outside, crossing = [0.0] * 4, 0, 0
        for a, b in spans:
            share = [max(0, min(b, hi) - max(a, lo)) for lo, hi in ((0, 2), (3, 3), (3, 9), (9, 400))]
            crossing += sum(x > 0 for x in share) > 1
            if rule == "start":
                inside = [k for k, (lo, hi) in enumerate(((0, 2), (3, 3), (3, 9), (9, 400))) if lo <= a < hi]
                if inside:
                    want[inside[0]] += 1
                outside += not inside
            elif not sum(share):
                outside += 1
            elif rule == "most":
                want[share.index(max(share))] += 1
            else:
                want = [w + x / sum(share) for w, x in zip(want, share, strict=True)]
        assert got[i].n_tokens == len(spans) and np.allclose(got[i].section_tokens, want) and (got[i].outside, got[i].crossing) == (outside, crossing), t


def test_lines_are_the_default_sections(spark):
    docs = spark.createDataFrame([(1, "one two\n\nthree"), (2, None), (None, "")], "doc_id long, text string").withColumn("n_tokens", F.lit("clash"))
    got = {r.doc_id: (r.n_tokens, r.section_tokens, r.outside) for r in token_counts.count_tokens(docs, BYTE).collect()}
    assert got[1][1][0] == 2 and got[1][1][1] == 0 and got[1][1][2] >= 1 and got[1][0] == sum(got[1][1]) + got[1][2]
    assert got[2] == (0, [0.0], 0.0) == got[None]


def test_no_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.encode_decode(empty, WORD).count() == 0 and token_counts.count_tokens(empty, BYTE).count() == 0


def test_stretches_are_the_whole():
    """Every white space of Unicode (and the separators that are none to the tokenizer) beside solid characters, blanks and
    special tokens, which count as the library counts them."""
    import pyarrow as pa

    from tallyward.llm.common import text_slices

    tok = Tokenizer.from_file(BYTE)
    blanks = [chr(c) for c in range(0x3001) if chr(c).isspace()] + ["\u200b", "\ufeff", "\u2060", "\u1680"]
    rng = random.Random(6)
    cases = [x + b + y + c + z for b in blanks for c in (" ", "\n", "\r\n", "\t ", b, "  ") for x in ("a", "", " ", "é.", "\u2019") for y in ("", "b") for z in ("", "1", "\n", "'s")]
    cases += ["".join(rng.choice([*blanks, " ", "\n", "<|endoftext|>", "<|endoftext|", "a", "Z9", "'ll", "漢", "À", "\u2005\u2029", "…", "‟"]) for _ in range(rng.randrange(1, 60))) for _ in range(3000)]
    lengths = token_counts.Lengths(BYTE)
    for first, data, offsets in text_slices(pa.array(cases)):
        sizes, heads = lengths.of(data, offsets)
        for d in range(len(offsets) - 1):
            text = cases[first + d]
            want = [lengths.size[i] for i in tok.encode(text, add_special_tokens=False).ids]
            assert sizes[heads[d] : heads[d + 1]].tolist() == want, text


def test_special_tokens_are_tokens_and_files_whose_ones_take_blanks_are_refused(spark, tmp_path):
    docs = spark.createDataFrame([(1, "abc <|endoftext|> def"), (2, "<|endoftext|><|endoftext|>x\n")], "doc_id long, text string")
    tok = Tokenizer.from_file(BYTE)
    got = {r.doc_id: (r.n_tokens, r.section_tokens, r.outside) for r in token_counts.count_tokens(docs, BYTE).collect()}
    assert got[1][0] == 4 == len(tok.encode("abc <|endoftext|> def").ids) and got[2] == (4, [3.0, 0.0], 1.0)
    with open(BYTE, encoding="utf-8") as f:
        spec = json.load(f)
    for change in ({"rstrip": True}, {"lstrip": True}, {"content": "<two words>"}):
        odd = spec | {"added_tokens": [spec["added_tokens"][0] | change]}
        (tmp_path / "odd.json").write_text(json.dumps(odd))
        with pytest.raises(ValueError, match="added tokens"):
            token_counts.Lengths(str(tmp_path / "odd.json"))


def test_token_counts_of_long_texts_sections_and_clashing_names(spark):
    tok = Tokenizer.from_file(BYTE)
    text = "word one\n" * 120_000 + "x" * 3000
    docs = spark.createDataFrame([(1, text, 7, "s"), (1, text, 7, "s"), (2, "ab cd", 8, "t")], "doc_id long, text string, outside long, __s string")
    got = sorted(token_counts.count_tokens(docs, BYTE).collect())
    assert got[0] == got[1] and got[0].n_tokens == len(tok.encode(text, add_special_tokens=False).ids)
    assert len(got[0].section_tokens) == 120_001 and sum(got[0].section_tokens) + got[0].outside == got[0].n_tokens
    sections = F.array(F.struct(F.lit(1).alias("start"), F.lit(99).alias("end")), F.lit(None).cast("struct<start: int, end: int>"))
    got = [r for r in token_counts.count_tokens(docs, BYTE, sections, rule="split").collect() if r.doc_id == 2]
    assert sum(got[0].section_tokens) + got[0].outside == got[0].n_tokens  # what lies beyond the text is cut off
