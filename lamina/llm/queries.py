"""Queries over the given tables, one for each operator, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.llm import (
    embedding_graph,
    hard_negatives,
    inner_topk,
    license_join,
    mixing,
    pii_disclosure,
    quality_gam,
    quality_rules,
    sentencepiece_codec,
    simhash_cover,
    token_counts,
    toxicity_cnn,
    turn_repair,
)
from lamina.llm.common import fold, table

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTE_PAIRS = public_tokenizers.path("byte_bpe_50k.json")


def op1_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    rows = sentencepiece_codec.encode_documents(table(spark, folder, "documents"), PIECES, decoded=True)
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        F.array_max("ends").cast("long").alias("covered_bytes"),
    )


def op2_licenses(spark: SparkSession, folder: str) -> DataFrame:
    rows = license_join.scan(table(spark, folder, "documents"))
    joined = {name: F.array_join(name, ",") for name in ("base_labels", "labels")}
    return rows.withColumns(joined).drop("text_key")


def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = quality_gam.train(docs, table(spark, folder, "labels"), fold(5, 0))
    rows = quality_gam.score_quality(docs, model)
    return rows.select("doc_id", fold(5, 0).alias("held_out"), "score", "predicted")


def op4_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    rows = token_counts.count_tokens(table(spark, folder, "documents"), BYTE_PAIRS)
    return rows.withColumn("over_limit", F.col("n_tokens") > 1024)


def op5_pii(spark: SparkSession, folder: str) -> DataFrame:
    rows = pii_disclosure.detect(table(spark, folder, "documents"))
    counts = [
        pii_disclosure.count_of(i).alias(f"n_{pattern.kind}") for i, pattern in enumerate(pii_disclosure.PATTERNS)
    ]
    listed = pii_disclosure.listed
    return rows.select(
        "doc_id",
        *counts,
        F.sha2(listed(F.col("spans")), 256).alias("base_sha256"),
        listed(F.col("spans"), F.col("added")).alias("spans"),
    )


def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    detector = toxicity_cnn.train(docs, table(spark, folder, "labels"), fold(4, 2))
    rows = toxicity_cnn.score_toxicity(docs, detector)
    return rows.select("doc_id", fold(4, 2).alias("held_out"), "score", "predicted", "flagged")


def op7_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    rows = quality_rules.apply_rules(table(spark, folder, "documents").select("doc_id", "text"))
    measures = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return rows.select("doc_id", *measures, "base_failed", "kept")


def op8_mixing(spark: SparkSession, folder: str) -> DataFrame:
    rows = mixing.measured(table(spark, folder, "documents"))
    mixed = mixing.taken(rows, mixing.thresholds(rows.select("source", "size", "place")))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"))


def op9_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_graph.near_duplicates(table(spark, folder, "embeddings"))


def op10_simhash(spark: SparkSession, folder: str) -> DataFrame:
    rows = simhash_cover.near_duplicates(table(spark, folder, "documents"))
    return rows.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    id = F.col("vec_id")
    label = F.col("label").cast("long")
    moved = F.when(id % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives.hard_negatives(table(spark, folder, "embeddings"), id % 100 == 0, moved)


def op12_exact_topk(spark: SparkSession, folder: str) -> DataFrame:
    return inner_topk.top_products(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


def op13_turn_repair(spark: SparkSession, folder: str) -> DataFrame:
    return turn_repair.repair(table(spark, folder, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_licenses": op2_licenses,
    "op3_quality": op3_quality,
    "op4_token_counts": op4_token_counts,
    "op5_pii": op5_pii,
    "op6_toxicity": op6_toxicity,
    "op7_quality_rules": op7_quality_rules,
    "op8_mixing": op8_mixing,
    "op9_embeddings": op9_embeddings,
    "op10_simhash": op10_simhash,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_exact_topk": op12_exact_topk,
    "op13_turn_repair": op13_turn_repair,
}

ORACLES: dict[str, str] = {
    "op2_licenses": license_join.oracle(),
    "op5_pii": pii_disclosure.oracle(),
    "op7_quality_rules": quality_rules.oracle(),
    "op11_hard_negatives": hard_negatives.oracle(),
    "op12_exact_topk": inner_topk.oracle(),
}
