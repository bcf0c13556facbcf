"""Stream-ingest transforms: one set of column expressions shared by batch and Structured Streaming.

Kafka record (key, value, topic, partition, offset, timestamp) -> typed bronze row + ``reject_reason``.
Nothing here leaves the JVM: JSON is parsed with ``from_json``, not Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.columns import iso_text, ts_literal, to_ntz
from ..schemas import BRONZE_COLUMNS, EVENTS_TOPIC, FUNNEL_EVENT_TYPES, REQUIRED_EVENT_FIELDS

# Reject reasons, in the order they are tested.
MALFORMED = "malformed_json"
MISSING = "missing_{}"
INVALID_TYPE = "invalid_event_type"
EMPTY_USER = "empty_user_id"
INVALID_TIME = "invalid_event_timestamp"
INVALID_PRICE = "invalid_price"

END_MARK = "~end of record"
STRICT_JSON = {"allowSingleQuotes": "false"}


def _processing_time(envelope: DataFrame, processing_time: str | Column | None) -> Column:
    if processing_time is None:
        return F.current_timestamp().cast("timestamp_ntz")
    if isinstance(processing_time, Column):
        return processing_time
    if processing_time == "broker":
        return F.col("timestamp").cast("timestamp_ntz")
    return ts_literal(processing_time)


def parse_events(
    envelope: DataFrame,
    processing_time: str | Column | None = "broker",
    strict: bool = False,
) -> DataFrame:
    """Decode Kafka values into bronze columns and tag every record with ``reject_reason`` (NULL = accepted).

    * every field is read as text, then typed with ``try_cast`` (a quoted number still becomes a price);
    * ``processing_timestamp``: ``"broker"`` = the record's broker time, ``None`` = now, or a fixed literal;
    * a missing ``event_id`` *key* becomes ``kafka-{topic}-{partition}-{offset}``; an explicit JSON null stays
      NULL (silver drops it);
    * reasons, first match wins: malformed JSON (not an object, or text after it), a required key absent, event
      type outside the funnel, empty user id, an event time or price that is present but cannot be read.
    ``strict=True`` fails the query on the first malformed record or missing key instead of dead-lettering it.
    """
    # A record is decoded once, into its keys and values. Typed columns and reason come out of a generator of one row:
    # filters on them stay above it, where a pushed-down copy would decode the text again.
    decoded = envelope.select(
        "topic",
        "partition",
        "offset",
        F.col("key").cast("string").alias("kafka_key"),
        F.col("value").cast("string").alias("raw_value"),
        _processing_time(envelope, processing_time).alias("_processing_ts"),
    )
    # one object and nothing after it: the end mark that follows the text must come out as the second of two
    marked = F.concat(F.lit("["), F.col("raw_value"), F.lit(f',{{"{END_MARK}":""}}]'))
    decoded = decoded.withColumn("_found", F.from_json(marked, "array<map<string,string>>", STRICT_JSON))
    whole = (F.size("_found") == 2) & F.map_contains_key(F.get("_found", F.lit(1)), END_MARK)
    decoded = decoded.withColumn("_record", F.when(whole, F.get("_found", F.lit(0))))
    # of a repeated key the last value counts
    decoded = decoded.withColumns(
        {"_keys": F.reverse(F.map_keys("_record")), "_values": F.reverse(F.map_values("_record"))}
    )
    keys = F.col("_keys")
    # All fields are looked up by one expression: a search written out for each of them makes a method of more than
    # 8,000 bytes, which the JVM interprets and never compiles. Keys named twice stay a column of their own.
    names = [c for c in BRONZE_COLUMNS if c != "processing_timestamp"]
    places = F.transform(F.array(*map(F.lit, names)), lambda n: F.array_position(keys, n).cast("int") - 1)
    decoded = decoded.withColumn("_places", F.when(keys.isNotNull(), places))
    place = {c: F.get("_places", F.lit(i)) for i, c in enumerate(names)}
    j = {c: F.get("_values", place[c]) for c in names}
    decoded = decoded.withColumns(
        {"_event_time": to_ntz(j["event_timestamp"]), "_price": j["price"].try_cast("double")}
    )

    def has(k: str) -> Column:
        return F.coalesce(place[k] >= 0, F.lit(False))

    synthetic_id = F.concat_ws("-", F.lit("kafka"), F.col("topic"), F.col("partition"), F.col("offset"))
    reason = F.when(keys.isNull(), F.lit(MALFORMED))
    for field in REQUIRED_EVENT_FIELDS:
        reason = reason.when(~has(field), F.lit(MISSING.format(field)))
    reason = reason.when(
        ~F.coalesce(j["event_type"].isin(FUNNEL_EVENT_TYPES), F.lit(False)), F.lit(INVALID_TYPE)
    ).when(F.coalesce(j["user_id"], F.lit("")) == "", F.lit(EMPTY_USER))
    reason = reason.when(j["event_timestamp"].isNotNull() & F.col("_event_time").isNull(), F.lit(INVALID_TIME))
    reason = reason.when(j["price"].isNotNull() & F.col("_price").isNull(), F.lit(INVALID_PRICE))
    if strict:
        fatal = keys.isNull()
        for field in REQUIRED_EVENT_FIELDS:
            fatal = fatal | ~has(field)
        reason = F.when(
            fatal, F.raise_error(F.concat(F.lit("bad record at offset "), F.col("offset").cast("string")))
        ).otherwise(reason)

    cols = []
    for c in BRONZE_COLUMNS:
        if c == "event_id":
            cols.append(
                F.when(keys.isNull(), F.lit(None).cast("string")).when(has("event_id"), j[c]).otherwise(synthetic_id).alias(c)
            )
        elif c == "event_timestamp":
            cols.append(F.col("_event_time").alias(c))
        elif c == "processing_timestamp":
            cols.append(F.col("_processing_ts").alias(c))
        elif c == "price":
            cols.append(F.col("_price").alias(c))
        else:
            cols.append(j[c].alias(c))
    typed = F.inline(F.array(F.struct(*cols, reason.alias("reject_reason"))))
    return decoded.select("topic", "partition", "offset", "kafka_key", "raw_value", typed)


def accepted(parsed: DataFrame) -> DataFrame:
    """Records that pass every check, as bronze rows (19 columns)."""
    return parsed.where(F.col("reject_reason").isNull()).select(*BRONZE_COLUMNS)


def dead_letter(parsed: DataFrame) -> DataFrame:
    """Rejected records with their raw value and reason, for the dead-letter table."""
    return parsed.where(F.col("reject_reason").isNotNull()).select(
        "topic", "partition", "offset", "kafka_key", "raw_value", "reject_reason"
    )


def missing_required(parsed: DataFrame) -> DataFrame:
    """Records whose JSON lacks a required key."""
    return parsed.where(F.col("reject_reason").startswith("missing_")).select(
        "topic", "partition", "offset", "reject_reason"
    )


def event_ids(parsed: DataFrame) -> DataFrame:
    """Resolved event id of every well-formed record (own id or the synthetic Kafka coordinate)."""
    return parsed.where(F.col("reject_reason").isNull() | (F.col("reject_reason") != MALFORMED)).select(
        "topic", "partition", "offset", "event_id"
    )


def ingest_stats(parsed: DataFrame) -> DataFrame:
    """Rows accepted / rejected and the success rate ``ok / max(ok + failed, 1)`` in one aggregate."""
    ok = F.count_if(F.col("reject_reason").isNull())
    bad = F.count_if(F.col("reject_reason").isNotNull())
    return parsed.agg(ok.alias("rows_ok"), bad.alias("rows_failed")).select(
        "rows_ok",
        "rows_failed",
        (F.col("rows_ok") / F.greatest(F.col("rows_ok") + F.col("rows_failed"), F.lit(1))).alias("success_rate"),
    )


def observe_ingest(parsed: DataFrame, name: str = "ingest") -> tuple[DataFrame, Observation]:
    """Attach ingest counters to a (batch or streaming) plan without a second pass over the data.

    In streams the metrics arrive per micro-batch in ``StreamingQueryListener.onQueryProgress``
    (``event.progress.observedMetrics[name]``); for batch they are read from the returned ``Observation``.
    """
    obs = Observation(name)
    observed = parsed.observe(
        obs,
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("reject_reason").isNull()).alias("rows_ok"),
        F.count_if(F.col("reject_reason").isNotNull()).alias("rows_failed"),
    )
    return observed, obs


def observe_stream(parsed: DataFrame, name: str = "ingest") -> DataFrame:
    """Named observed metrics for a streaming plan (read them from the query listener)."""
    return parsed.observe(
        name,
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("reject_reason").isNull()).alias("rows_ok"),
        F.count_if(F.col("reject_reason").isNotNull()).alias("rows_failed"),
    )


def sink_row_prep(bronze: DataFrame) -> DataFrame:
    """Rows as the warehouse sink sends them: timestamps as ISO-8601 text, price as DOUBLE."""
    cols = []
    for c in BRONZE_COLUMNS:
        if c in ("event_timestamp", "processing_timestamp"):
            cols.append(iso_text(c).alias(c))
        elif c == "price":
            cols.append(F.col(c).cast("double").alias(c))
        else:
            cols.append(F.col(c))
    return bronze.select(*cols)


def publish_envelope(events: DataFrame, topic: str = EVENTS_TOPIC) -> DataFrame:
    """Events as keyed Kafka records: key = user_id (keeps a user's events in one partition), value = JSON.

    NULL fields are left out of the JSON; timestamps are ISO text and the price is written as it is. ``publish`` and
    ``publish_stream`` write the result.
    """
    fields = []
    for c in BRONZE_COLUMNS:
        if c in ("event_timestamp", "processing_timestamp"):
            fields.append(iso_text(c).alias(c))
        else:
            fields.append(F.col(c))
    return events.select(
        F.col("user_id").alias("key"),
        F.to_json(F.struct(*fields)).alias("value"),
        F.lit(topic).alias("topic"),
    )


def kafka_producer_options(bootstrap_servers: str, topic: str = EVENTS_TOPIC) -> dict[str, str]:
    """Options for the Kafka sink: all replicas acknowledge, snappy-compressed batches."""
    return {
        "kafka.bootstrap.servers": bootstrap_servers,
        "topic": topic,
        "kafka.acks": "all",
        "kafka.compression.type": "snappy",
    }


def publish(
    events: DataFrame,
    bootstrap_servers: str,
    topic: str = EVENTS_TOPIC,
    sink: str = "kafka",
    options: dict[str, str] | None = None,
) -> None:
    """Write a batch of events to the topic, one keyed record each.

    ``options`` are added to ``kafka_producer_options`` and win over them; ``sink`` names another data source.
    """
    records = publish_envelope(events, topic)
    every = {**kafka_producer_options(bootstrap_servers, topic), **(options or {})}
    records.write.format(sink).options(**every).mode("append").save()


def publish_stream(
    events: DataFrame,
    bootstrap_servers: str,
    checkpoint_path: str,
    topic: str = EVENTS_TOPIC,
    trigger: dict | None = None,
    sink: str = "kafka",
    options: dict[str, str] | None = None,
    query_name: str = "publish_events",
):
    """Start a query that writes a stream of events to the topic; it goes on from its checkpoint after a failure.

    A batch that is written again after a failure repeats its records: event ids let readers drop them.
    """
    every = {**kafka_producer_options(bootstrap_servers, topic), **(options or {})}
    writer = publish_envelope(events, topic).writeStream.format(sink).queryName(query_name).outputMode("append")
    return writer.options(**every).option("checkpointLocation", checkpoint_path).trigger(**(trigger or {"availableNow": True})).start()
