"""The training-data pipeline: documents in, packed segments out.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame that is written as Parquet and read again as the next
stage's documents. All but the last give the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cartwheel.llm import decontamination, near_dedup, packing, quality_rules, secret_scan, token_counts
from cartwheel.llm.common import scratch, shared_folder, stored, table


def reject_by_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current rule policy keeps."""
    return quality_rules.kept_documents(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, similarity 0.8 or more)."""
    return near_dedup.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced."""
    return secret_scan.redact(docs, secret_scan.fit(docs))


def pack_by_length(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Segments of all documents with their length bucket, batch and place."""
    import public_tokenizers

    counted = token_counts.with_token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return packing.pack(counted.select("doc_id", "n_tokens"))


STAGES = [
    ("quality_rules", reject_by_rules),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secret_scan", redact_secrets),
    ("packing", pack_by_length),
]

#: Signatures, tokenizers and randomness tests are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_folder(spark, name)
        with scratch(spark):  # what the stage stores on its way goes once its result is written
            docs = stored(stage(spark, docs, sf_dir), name, path)
    return docs
