"""Registered queries of this subpackage: each applies its operator to a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    collocations,
    decontamination,
    language_id,
    near_dedup,
    packing,
    pivot_search,
    quality_classifier,
    quality_rules,
    secret_scan,
    token_counts,
    token_files,
    vector_codes,
    warc,
)
from .common import crc32_mod, table


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    conf = near_dedup.NearDup(percent=85, bands=26, rows=5)
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), conf)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judged(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "failures",
    )


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    counted = token_counts.with_token_counts(table(spark, sf_dir, "documents"), path)
    return counted.withColumn("over_limit", F.col("n_tokens") > 512)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc32_mod("doc_id", 5) == 0
    dictionaries = language_id.learn(docs.where(~held_out).select("doc_id", "text", "lang"))
    rows = docs.select("doc_id", "text", held_out.alias("held_out"))
    return language_id.identify(rows, dictionaries, 0.01, ("doc_id", "held_out"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    return token_files.read(spark, token_files.write(table(spark, sf_dir, "documents"), path, end_id=2))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secret_scan.scan(docs, secret_scan.fit(docs))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    counted = token_counts.with_token_counts(table(spark, sf_dir, "documents"), path)
    return packing.pack(counted.select("doc_id", "n_tokens"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read(spark, warc.write(table(spark, sf_dir, "pages")))


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc32_mod("doc_id", 3) == 1
    net = quality_classifier.learn(docs.where(~held_out), table(spark, sf_dir, "labels"))
    rows = docs.select("doc_id", "text", held_out.alias("held_out"))
    return quality_classifier.scored(rows, net, ("doc_id", "held_out"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_pivot_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_search.search(table(spark, sf_dir, "embeddings"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = vector_codes.compress(table(spark, sf_dir, "embeddings"))
    return coded.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_quality_classifier,
        op2_decontamination,
        op3_near_dedup,
        op4_token_counts,
        op5_token_files,
        op6_language_id,
        op7_secret_scan,
        op8_quality_rules,
        op9_packing,
        op10_warc,
        op11_pivot_search,
        op12_collocations,
        op13_vector_codes,
    )
    return {f.__name__: f for f in found}
