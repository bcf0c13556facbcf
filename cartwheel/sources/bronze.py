"""Bronze table: an append-only Parquet dataset partitioned by event date.

Layout ``<path>/event_date=YYYY-MM-DD/[ingest_batch=N/]part-*.parquet``. Reads use the explicit schema (no
inference, no footer scan of every file) and a predicate on ``event_date`` prunes whole directories.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import BRONZE_SCHEMA

PARTITION_COL = "event_date"
BRONZE_TABLE_SCHEMA = T.StructType(BRONZE_SCHEMA.fields + [T.StructField(PARTITION_COL, T.DateType())])


def with_event_date(df: DataFrame) -> DataFrame:
    return df.withColumn(PARTITION_COL, F.to_date("event_timestamp"))


def read_bronze(spark: SparkSession, path: str, batch_partitions: bool = False) -> DataFrame:
    """Scan the bronze dataset with its declared schema (``event_date`` comes from the directory names)."""
    schema = BRONZE_TABLE_SCHEMA
    if batch_partitions:
        schema = T.StructType(schema.fields + [T.StructField("ingest_batch", T.LongType())])
    return spark.read.schema(schema).option("basePath", path).parquet(path)


def write_bronze(df: DataFrame, path: str, mode: str = "append") -> None:
    """Append bronze rows, one directory per event date, rows clustered by user inside each file."""
    out = with_event_date(df) if PARTITION_COL not in df.columns else df
    (
        # by range over (day, user): a large day is spread over many tasks and files
        out.repartitionByRange(PARTITION_COL, "user_id", "event_type")
        .sortWithinPartitions(PARTITION_COL, "user_id", "event_type")
        .write.mode(mode)
        .partitionBy(PARTITION_COL)
        .parquet(path)
    )
