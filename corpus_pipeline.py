"""From raw documents to token ids: five stages, each a Spark job over all that the one before kept.

Every stage but the last returns the columns of documents. A stage's result is written as Parquet in the shared folder and
read again, which also cuts the lineage, so that a lost executor costs at most the stage at hand.

Defined cases of all stages: columns beyond those of documents are carried along, whatever their names (the last stage
leaves them); repeated rows are rows of their own until ngram_jaccard keeps one of them; null ids are carried along, and go
after all others where a smallest id stays; no rows give no rows; very long texts are worked through whole. Each stage's
docstring says what becomes of null and empty texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.llm import bpe, decontam, jaccard, langid, lines
from tallyward.llm.common import delete, free_name, materialize, recording


BITS = 8.0  # bits a byte from which on a text is in no learned language: as long as the raw text
LEAST_BYTES = 32  # shorter texts say too little to be rejected by their rate


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a recognisable language go: those that are null or have no letter, and those that even the best tree
    codes with BITS bits a byte or more (of LEAST_BYTES bytes at least). Where no text has a label to learn from, all texts with a letter stay."""
    trees = langid.fit(docs)
    if not trees.langs:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    names = tuple(free_name(docs, n) for n in ("lang_pred", "score", "bits"))
    found = langid.predict(docs, trees, keep=tuple(c for c in docs.columns if c != "doc_id"), outputs=names)
    return found.where((F.col(names[0]) != "und") & ((F.col(names[2]) < BITS) | (F.octet_length("text") < LEAST_BYTES))).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near-equal lines one stays in the whole corpus; texts that lose all their lines go. Null and blank texts, which have
    no line, stay. n_chars follows the text."""
    kept = lines.drop_lines(docs)
    return kept.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), "n_chars")).select(*docs.columns)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that five-word shingles connect at 0.8 or more, the one with the smallest doc_id stays. Null and blank texts
    are connected with nothing."""
    return jaccard.keep_one(docs, n=5, threshold="0.8")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that overlap with a benchmark item go. Null and blank texts overlap with nothing."""
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def bpe_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left, with the digest of their decoding. Null and empty texts have no ids."""
    import public_tokenizers

    return bpe.encode_decode(docs, public_tokenizers.path("word_bpe_49k.json"), outputs=("n_tokens", "ids", "decoded_sha256"))


STAGES = [(f.__name__, f) for f in (language_id, line_dedup, ngram_jaccard, decontamination, bpe_tokens)]
ORACLE_SQL = None  # no SQL for trees and merges; tests/llm/test_pipeline.py holds every stage against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents. What they write meanwhile is deleted, but for the last result, which is returned."""
    docs, paths = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    with recording(paths):
        for name, stage in STAGES:
            docs = materialize(stage(spark, docs, sf_dir), name)
            delete(spark, paths[:-1])
            del paths[:-1]
    return docs
