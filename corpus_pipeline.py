"""Corpus pipeline: quality, near copies, repeated passages, personal data, packing.

``run(spark, sf_dir)`` applies STAGES to the table ``documents``. A stage reads
all that its predecessor kept; its result is written as Parquet below
``spark.checkpoint.dir`` and read again as the next one's input. All but the
last return the columns of ``documents``; ``n_chars`` follows the text.

- quality_classifier: documents whose score says quality 0 go.
- simhash_near_dedup: one document of each group of near copies stays.
- suffix_array_dedup: bytes that repeated strings cover go; what is left of a
  character cut in two goes with them.
- pii: personal data is masked.
- packing: the texts as sequences of at most 2048 tokens, a row for each piece.

Null texts count as empty (and stay null where a stage leaves the text alone);
empty tables give empty results with the same columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradestar.llm import packing, pii, quality, simhash, suffix_dedup
from tradestar.llm.queries import remainder, table
from tradestar.llm.scratch import Scratch

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _documents(df: DataFrame, text) -> DataFrame:
    return df.withColumn("text", text).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps what the classifier predicts as quality 1."""
    docs = docs.select(*COLUMNS)
    scored = quality.score(docs, table(spark, sf_dir, "labels"), learn=remainder("id", 5) != 0)
    return scored.filter("quality.predicted = 1").select(*COLUMNS)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest id of each group linked by 3 or fewer of 64 bits."""
    return simhash.keep_one(docs.select(*COLUMNS), n_words=3, radius=3)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes the bytes that strings of 200 bytes found elsewhere cover."""
    done = suffix_dedup.remove_repeats(docs.select(*COLUMNS), length=200,
                                       carry=["doc_id", "lang", "source"], with_text=True)
    return _documents(done, F.col("dedup.text"))


def pii_masking(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind in brackets."""
    return _documents(pii.mask(docs.select(*COLUMNS)), F.col("text"))


def packing_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences, each with its token ids."""
    import public_tokenizers
    return packing.pack(docs.select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json")).select(
        "doc_id", "piece.*")


STAGES = [
    ("quality_classifier", quality_classifier),
    ("simhash_near_dedup", simhash_near_dedup),
    ("suffix_array_dedup", suffix_array_dedup),
    ("pii", pii_masking),
    ("packing", packing_sequences),
]

#: SQL has no trained network, no SimHash and no tokenizer; tests/llm compares
#: the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the table ``documents`` of ``sf_dir``."""
    work = Scratch(spark)
    docs = table(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES:
        docs = work.stored(stage(spark, docs, sf_dir), name)
        if before:
            work.drop(before)
        before = name
    return docs
