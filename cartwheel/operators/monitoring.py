"""Stream health monitoring over the bronze table: volume, latency, freshness, type mix, new-data trigger.

Each monitor is one aggregate (partial aggregation on the executors, a single row at the end), so its cost is
one scan of the recent slice; on a date-partitioned bronze table the time filter prunes old partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import interval, iso_text, seconds_between, minutes_between, ts_literal
from .silver import RunTime, now_or

# Alert limits of the monitors (fixed values).
MIN_EVENTS_PER_HOUR = 100
MAX_AVG_LATENCY_SECONDS = 60
MAX_SILENCE_SECONDS = 300
STALE_AFTER_MINUTES = 30
SENSOR_LOOKBACK = "2 hours"
SENSOR_WARN_AFTER = "10 minutes"


def _recent(bronze: DataFrame, as_of: Column, window: str, ts_col: str = "event_timestamp") -> DataFrame:
    recent = bronze.where(F.col(ts_col) >= as_of - interval(window))
    if "event_date" in bronze.columns:  # stored bronze: open only the date partitions that can hold such rows
        recent = recent.where(F.col("event_date") >= F.to_date(as_of - interval(window)))
    return recent


def bronze_health(bronze: DataFrame, as_of: RunTime | None = None, window: str = "1 hour") -> DataFrame:
    """Events, distinct users, mean ingest latency (whole seconds, truncated), newest and oldest event time."""
    now = now_or(as_of)
    return _recent(bronze, now, window).agg(
        F.count(F.lit(1)).alias("events_last_hour"),
        F.count_distinct("user_id").alias("unique_users"),
        F.avg(seconds_between("event_timestamp", "processing_timestamp")).alias("avg_latency_seconds"),
        F.max("event_timestamp").alias("latest_event"),
        F.min("event_timestamp").alias("earliest_event"),
    )


def bronze_health_warnings(health: DataFrame, as_of: RunTime | None = None) -> DataFrame:
    """One row per raised warning: low volume, high latency (NULL latency counts as 0), stream silent."""
    now = now_or(as_of)
    latency = F.coalesce(F.col("avg_latency_seconds"), F.lit(0.0))
    silence = seconds_between(F.col("latest_event"), now).cast("double")

    def warn(name: str, cond: Column, measured: Column, limit: float) -> Column:
        return F.when(
            cond,
            F.struct(
                F.lit(name).alias("warning"),
                measured.cast("double").alias("measured"),
                F.lit(float(limit)).alias("threshold"),
            ),
        )

    items = F.array(
        warn("low_volume", F.col("events_last_hour") < MIN_EVENTS_PER_HOUR, F.col("events_last_hour"), MIN_EVENTS_PER_HOUR),
        warn("high_latency", latency > MAX_AVG_LATENCY_SECONDS, latency, MAX_AVG_LATENCY_SECONDS),
        warn("stream_silent", F.coalesce(silence > MAX_SILENCE_SECONDS, F.lit(False)), silence, MAX_SILENCE_SECONDS),
    )
    return health.select(F.inline(F.filter(items, lambda x: x.isNotNull())))


def bronze_event_counts(bronze: DataFrame, as_of: RunTime | None = None, window: str = "1 hour") -> DataFrame:
    """Events per type in the recent window, most frequent first (ties by type name)."""
    now = now_or(as_of)
    return (
        _recent(bronze, now, window)
        .groupBy("event_type")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.col("count").desc(), F.col("event_type").asc_nulls_last())
    )


def funnel_ratios(event_counts: DataFrame) -> DataFrame:
    """Step-to-step ratios x100 from per-type counts, 0 when the base step is 0, 2 decimals (half-even)."""
    def n(t: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("event_type") == t, F.col("count"))), F.lit(0))

    def ratio(a: str, b: str) -> Column:
        return F.when(F.col(b) == 0, F.lit(0.0)).otherwise(F.bround(F.col(a) / F.col(b) * 100, 2))

    counts = event_counts.agg(
        n("page_view").alias("pv"), n("view_item").alias("vi"), n("add_to_cart").alias("atc"), n("purchase").alias("pur")
    )
    return counts.select(
        ratio("vi", "pv").alias("page_view_to_view_item"),
        ratio("atc", "vi").alias("view_item_to_add_to_cart"),
        ratio("pur", "atc").alias("add_to_cart_to_purchase"),
    )


def bronze_freshness(bronze: DataFrame, as_of: RunTime | None = None, window: str = "1 hour") -> DataFrame:
    """Newest event over the whole table, minutes since it, events in the recent window, and a stale flag.

    The newest event is taken over all data (an empty recent hour still yields a time); no data at all is stale.
    """
    now = now_or(as_of)
    since = now - interval(window)
    if "event_date" in bronze.columns:
        # Stored bronze: the recent partitions, and the older ones only if no event is in those. The scalar is a
        # partition filter that is known before the older files are listed for reading.
        recent = bronze.where(F.col("event_date") >= F.to_date(since))
        found = recent.agg(F.count("event_timestamp").alias("n")).scalar() > 0
        before = F.when(found, F.lit("0001-01-01").cast("date")).otherwise(F.to_date(since))
        bronze = recent.unionByName(bronze.where(F.col("event_date") < before))
    agg = bronze.agg(
        F.max("event_timestamp").alias("last_event"),
        F.count_if(F.col("event_timestamp") >= since).alias("events_last_hour"),
    )
    return agg.select(
        "last_event",
        minutes_between(F.col("last_event"), now).alias("minutes_stale"),
        "events_last_hour",
        F.coalesce(minutes_between(F.col("last_event"), now) > STALE_AFTER_MINUTES, F.lit(True)).alias("is_stale"),
    )


class StaleStream(RuntimeError):
    pass


def assert_fresh(bronze: DataFrame, as_of: RunTime | None = None) -> dict:
    """Raise ``StaleStream`` when the newest event is older than 30 minutes (or there is none)."""
    row = bronze_freshness(bronze, as_of).first()
    if row is None or row["is_stale"]:
        raise StaleStream(f"bronze stale: last event {row['last_event'] if row else None}")
    return {"status": "healthy", "minutes_stale": row["minutes_stale"]}


def new_data_since(
    bronze: DataFrame,
    cursor: RunTime | None,
    as_of: RunTime | None = None,
    lookback: str = SENSOR_LOOKBACK,
    warn_after: str = SENSOR_WARN_AFTER,
) -> DataFrame:
    """Trigger decision: is there an event newer than ``cursor`` among the last ``lookback`` of data?

    Returns one row (last_event, should_run, run_key, stale_warning). The caller stores ``last_event`` as the
    new cursor only after the triggered run succeeds.
    """
    now = now_or(as_of)
    cur = ts_literal("1970-01-01 00:00:00") if cursor is None else (
        cursor if isinstance(cursor, Column) else ts_literal(cursor)
    )
    last = _recent(bronze, now, lookback).agg(F.max("event_timestamp").alias("last_event"))
    return last.select(
        "last_event",
        F.coalesce(F.col("last_event") > cur, F.lit(False)).alias("should_run"),
        F.when(F.col("last_event").isNotNull(), F.concat(F.lit("bronze_fresh_"), iso_text("last_event"))).alias("run_key"),
        F.coalesce(F.col("last_event") < now - interval(warn_after), F.lit(False)).alias("stale_warning"),
    )
