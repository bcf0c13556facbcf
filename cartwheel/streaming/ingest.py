"""Structured Streaming ingest: Kafka-shaped records -> bronze table + dead-letter table.

The transform is the same column expressions as the batch path (``operators.ingest``); there is no Python in
the per-record path. Each micro-batch is written once to both outputs through ``foreachBatch``:

* rows are partitioned by ``event_date`` and by the micro-batch id (``ingest_batch``);
* writes use dynamic partition overwrite, so a micro-batch replayed after a failure replaces exactly the
  directories it wrote the first time -- the sink is idempotent and the pipeline is effectively exactly-once;
* offsets live in the query checkpoint (a shared, durable folder), not in consumer-group commits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..operators import ingest
from ..schemas import BRONZE_COLUMNS


def parse_stream(envelope_stream: DataFrame, processing_time: str | None = None) -> DataFrame:
    """Parsed records with ``reject_reason`` plus named observed metrics ``ingest`` (rows, rows_ok, rows_failed)."""
    return ingest.observe_stream(ingest.parse_events(envelope_stream, processing_time=processing_time), "ingest")


def _write_batch(parsed: DataFrame, batch_id: int, bronze_path: str, dead_letter_path: str) -> None:
    parsed = parsed.persist()
    try:
        good = (
            parsed.where(F.col("reject_reason").isNull())
            .select(*BRONZE_COLUMNS)
            .withColumn("event_date", F.to_date("event_timestamp"))
            .withColumn("ingest_batch", F.lit(batch_id).cast("long"))
        )
        (
            good.sortWithinPartitions("event_date", "user_id", "event_type")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("event_date", "ingest_batch")
            .parquet(bronze_path)
        )
        bad = ingest.dead_letter(parsed).withColumn("ingest_batch", F.lit(batch_id).cast("long"))
        (
            bad.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("ingest_batch")
            .parquet(dead_letter_path)
        )
    finally:
        parsed.unpersist()


def start_bronze_ingest(
    envelope_stream: DataFrame,
    bronze_path: str,
    dead_letter_path: str,
    checkpoint_path: str,
    trigger: dict | None = None,
    processing_time: str | None = None,
    query_name: str = "bronze_ingest",
) -> StreamingQuery:
    """Start the ingest query. ``trigger`` e.g. ``{"processingTime": "10 seconds"}`` (micro-batch cadence of the
    upstream sink) or ``{"availableNow": True}`` (drain what is there, then stop)."""
    parsed = parse_stream(envelope_stream, processing_time)
    writer = (
        parsed.writeStream.queryName(query_name)
        .option("checkpointLocation", checkpoint_path)
        .foreachBatch(lambda df, bid: _write_batch(df, bid, bronze_path, dead_letter_path))
    )
    writer = writer.trigger(**(trigger or {"processingTime": "10 seconds"}))
    return writer.start()


class IngestMetricsListener(StreamingQueryListener):
    """Accumulates the ``ingest`` observed metrics: rows ok / failed, batches, last error, success rate."""

    def __init__(self, name: str = "ingest"):
        self.name = name
        self.rows_ok = 0
        self.rows_failed = 0
        self.batches = 0
        self.last_error: str | None = None

    def onQueryStarted(self, event):  # noqa: N802
        pass

    def onQueryProgress(self, event):  # noqa: N802
        metrics = event.progress.observedMetrics.get(self.name)
        if metrics is None:
            return
        self.rows_ok += int(metrics["rows_ok"] or 0)
        self.rows_failed += int(metrics["rows_failed"] or 0)
        self.batches += 1

    def onQueryIdle(self, event):  # noqa: N802
        pass

    def onQueryTerminated(self, event):  # noqa: N802
        if event.exception:
            self.last_error = str(event.exception)

    def stats(self) -> dict:
        total = self.rows_ok + self.rows_failed
        return {
            "rows_inserted": self.rows_ok,
            "rows_failed": self.rows_failed,
            "batches_sent": self.batches,
            "last_error": self.last_error,
            "success_rate": self.rows_ok / max(total, 1),
        }


def attach_metrics(spark: SparkSession, name: str = "ingest") -> IngestMetricsListener:
    listener = IngestMetricsListener(name)
    spark.streams.addListener(listener)
    return listener
