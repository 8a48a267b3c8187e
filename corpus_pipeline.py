"""From raw documents to packed training sequences, in stages that are each written and read again.

Quality rules drop documents; of near copies (five-word shingles, Jaccard 0.8 or more) one stays; passages of 50
words or more that an earlier document has are cut out; the rest is tokenized and packed.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from keytide.llm import ngram_join, packing, passages, quality
from keytide.settings import new_folder, scratch

PASSAGE_WORDS = 50
SHINGLE_WORDS, NEAR_PERCENT = 5, 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that no quality rule rejects."""
    return quality.kept(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of every group of near copies."""
    return ngram_join.without_copies(docs, words=SHINGLE_WORDS, per=NEAR_PERCENT)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier document has; those with nothing left go."""
    return passages.cleaned(docs, window=PASSAGE_WORDS, length_col="n_chars")


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of a tokenized document lies in the training sequences."""
    return packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_copies", near_copies),
    ("repeated_passages", repeated_passages),
    ("packed_sequences", packed_sequences),
]

# Components of links and the search for few sequences have no SQL form that runs on whole tables.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of a folder; each stage's result is written and read as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        folder = new_folder(spark, name)
        with scratch(spark):  # what a stage writes on the way goes with it
            stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
