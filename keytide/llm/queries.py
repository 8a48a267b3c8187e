"""The registered queries of this folder: each operator over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from keytide.llm import alignment, chat, fingerprints, hard_negatives, ngram_join, packing, passages, pieces, quality, substrings, token_counts, toxicity, warc
from keytide.llm.oracles import ORACLES

__all__ = ["ORACLES", "QUERIES"]


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def op1_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.remove_repeats(documents(spark, folder))


def op2_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    found = ngram_join.near_documents(documents(spark, folder), words=3, per=90)
    return found.select("doc_id", "n_shingles", "component_id")


def op3_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.encoded(documents(spark, folder), public_tokenizers.path("piece_bpe_32k.model"))


def op4_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.fingerprinted(documents(spark, folder))


def op5_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.records(warc.archive(spark.read.parquet(f"{folder}/pages.parquet")))


def op6_chat(spark: SparkSession, folder: str) -> DataFrame:
    turns = spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    added = [(-1, 0, "user", said), (-1, 1, "assistant", said)]
    return chat.read_back(chat.formatted(turns.unionByName(spark.createDataFrame(added, turns.schema))))


def op7_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.rate(documents(spark, folder))


def op8_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, folder), public_tokenizers.path("byte_bpe_50k.json"))


def op10_best_fit(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(documents(spark, folder), public_tokenizers.path("word_bpe_49k.json"))


def op9_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return passages.remove_passages(documents(spark, folder))


def op11_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet")
    return toxicity.scored(docs, toxicity.learned(docs, labels.select("doc_id", "toxic")))


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = spark.read.parquet(f"{folder}/embeddings.parquet")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mined(rows.withColumn("label", moved), F.col("id") % 50 == 0)


def op13_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    files = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    return alignment.aligned(documents(spark, folder), *files)


QUERIES = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_ngram_join": op2_ngram_join,
    "op3_pieces": op3_pieces,
    "op4_fingerprints": op4_fingerprints,
    "op5_warc": op5_warc,
    "op6_chat": op6_chat,
    "op7_quality_rules": op7_quality_rules,
    "op8_token_counts": op8_token_counts,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_best_fit": op10_best_fit,
    "op11_toxicity": op11_toxicity,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_token_alignment": op13_token_alignment,
}
