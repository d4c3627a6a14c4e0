"""Documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next
stage's docs. All but the last return the columns of documents. Nulls, empty tables and repeated rows are treated as the operators'
docstrings say; n_chars follows the text where lines are removed.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from threadloom.llm import line_dedup, near_dups, packing, quality, toxicity
from threadloom.llm.common import store

# SQL can't express the toxicity model and the tokenizer; tests/llm holds the stages against brute-force versions.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_documents(docs)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    learned = docs.where(~toxicity.held_out(F.col("doc_id").cast("string")))
    model = toxicity.fit(toxicity.labelled(learned, labels, "doc_id", "text", "toxic"))
    return toxicity.drop_toxic(docs, model)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    left = line_dedup.drop_repeated_lines(docs, min_words=1)
    return left.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars"))) if "n_chars" in docs.columns else left


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dups.drop_near_duplicates(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("near_duplicates", drop_near_duplicates),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; the rows of the last."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), name)
    return docs
