"""Kafka envelope sources: the broker (needs the spark-sql-kafka connector) or files holding the same records.

Offsets are tracked in the streaming checkpoint, not committed to the consumer group, so a restarted query
resumes exactly where its last committed micro-batch ended.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schemas import ENVELOPE_SCHEMA, EVENTS_TOPIC


def kafka_source_options(
    bootstrap_servers: str,
    topic: str = EVENTS_TOPIC,
    starting_offsets: str = "latest",
    max_offsets_per_trigger: int | None = None,
    group_id_prefix: str | None = "ecommerce-clickstream-consumer",
    fail_on_data_loss: bool = True,
) -> dict[str, str]:
    """Options for ``readStream.format("kafka")``: subscribe to the topic, start at the latest offsets,
    read uncommitted records (no transactional producer upstream), bound each micro-batch. Offsets that the
    broker no longer has stop the query unless ``fail_on_data_loss`` is set to false."""
    opts = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "kafka.isolation.level": "read_uncommitted",
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if group_id_prefix:
        opts["groupIdPrefix"] = group_id_prefix
    return opts


def read_kafka_stream(spark: SparkSession, bootstrap_servers: str, **kw) -> DataFrame:
    """Streaming DataFrame of Kafka records (key, value, topic, partition, offset, timestamp, ...)."""
    reader = spark.readStream.format("kafka")
    for k, v in kafka_source_options(bootstrap_servers, **kw).items():
        reader = reader.option(k, v)
    return reader.load()


def read_envelope_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame over Parquet files that hold Kafka-shaped records (same columns as the broker)."""
    reader = spark.readStream.schema(ENVELOPE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(path)
