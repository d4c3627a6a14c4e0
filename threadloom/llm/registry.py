"""Queries of the operators, and their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

import corpus_pipeline
from threadloom.llm import ann, bpe, html_text, licenses, line_dedup, near_dups, negatives, oracles, packing, pieces, quality, toxicity, urls, whitening

URL_RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line with a word, with its earliest equal or near line."""
    judged = line_dedup.judge_lines(table(spark, sf_dir, "documents"), min_words=1)
    return judged.select(F.col("id").alias("doc_id"), "line", F.col("first_id").alias("first_doc_id"), "first_line", "kept")


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = urls.judge_urls(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    apart = toxicity.held_out(F.col("doc_id").cast("string"))
    model = toxicity.fit(toxicity.labelled(docs.where(~apart), table(spark, sf_dir, "labels"), "doc_id", "text", "toxic"))
    scored = toxicity.score_documents(docs, model)
    return scored.select("doc_id", apart.alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"), "evidence")


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_text.extract(table(spark, sf_dir, "pages"), carry=("url",))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge_quality(table(spark, sf_dir, "documents"))
    return judged.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op7_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return found.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join("base_labels", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), "score",
    )


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.near_duplicates(table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(table(spark, sf_dir, "embeddings").withColumn("label", moved))


def op12_piece_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pieces.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return found.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_nearest_vectors, op2_line_dedup, op3_url_filters, op4_toxicity, op5_html_text, op6_quality_rules,
        op7_bpe_round_trip, op8_license_scan, op9_packing, op10_near_duplicates,
        op11_hard_negatives, op12_piece_round_trip, op13_whitening,
    )
} | {"pipeline": corpus_pipeline.run}

ALL = {name: (query, oracles.SQL.get(name)) for name, query in QUERIES.items()}
