"""Silver layer: lookback slice, typing, latest-record dedup, validation, catalogue and enrichment."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import in_half_open, interval, to_ntz, ts_literal
from ..schemas import BRONZE_COLUMNS, FUNNEL_EVENT_TYPES, PRODUCT_COLUMNS
from .joins import DEFAULT_BROADCAST_MAX_BYTES, left_join_dimension

RunTime = str | _dt.datetime | Column


def _run_col(run_started_at: RunTime) -> Column:
    return run_started_at if isinstance(run_started_at, Column) else ts_literal(run_started_at)


def now_or(as_of: RunTime | None) -> Column:
    """The run's clock: a fixed ``as_of`` for reproducible output, else the query's current time."""
    if as_of is None:
        return F.current_timestamp().cast("timestamp_ntz")
    return _run_col(as_of)


# ---------------------------------------------------------------------------------------------------------
# O-17 / O-18 lookback slice
# ---------------------------------------------------------------------------------------------------------
def lookback_window(
    df: DataFrame,
    run_started_at: RunTime,
    start: str | int = "1 hour 30 minutes",
    end: str | int = "30 minutes",
    ts_col: str = "event_timestamp",
    date_partition_col: str | None = None,
) -> DataFrame:
    """Rows with ``run - start <= ts < run - end`` (half-open, so hourly runs tile time exactly).

    With ``date_partition_col`` (the ``event_date`` partition column of a stored bronze table) the derived
    date bounds are added as well, so the scan prunes whole directories instead of reading every day.
    """
    run = _run_col(run_started_at)
    lo = run - interval(start)
    hi = run - interval(end)
    out = df.where(in_half_open(ts_col, lo, hi))
    if date_partition_col is not None:
        out = out.where((F.col(date_partition_col) >= F.to_date(lo)) & (F.col(date_partition_col) <= F.to_date(hi)))
    return out


def lookback_macro_window(
    df: DataFrame,
    run_started_at: RunTime,
    hours: int = 2,
    minutes: int = 30,
    lookback_hours: int | None = None,
    ts_col: str = "event_timestamp",
) -> DataFrame:
    """The configurable variant: ``[run - hours, run - minutes)``; a ``lookback_hours`` variable wins."""
    h = lookback_hours if lookback_hours is not None else hours
    return lookback_window(df, run_started_at, start=f"{h} hours", end=f"{minutes} minutes", ts_col=ts_col)


# ---------------------------------------------------------------------------------------------------------
# O-19 typed projection, O-23 audit columns
# ---------------------------------------------------------------------------------------------------------
def typed_projection(raw: DataFrame) -> DataFrame:
    """Typed bronze columns: timestamps through ``timestamp(x)``, price through ``cast(... as double)``."""
    exprs = []
    for c in BRONZE_COLUMNS:
        if c in ("event_timestamp", "processing_timestamp"):
            exprs.append(to_ntz(c).alias(c))
        elif c == "price":
            exprs.append(F.col(c).cast("double").alias(c))
        else:
            exprs.append(F.col(c).cast("string").alias(c))
    return raw.select(*exprs)


def add_audit_columns(
    df: DataFrame, as_of: RunTime | None = None, invocation_id: str | None = None, prefix: str = "dbt_"
) -> DataFrame:
    """Processing time and run id of the build that wrote the rows."""
    return df.withColumn(f"{prefix}processed_at", now_or(as_of)).withColumn(
        f"{prefix}invocation_id", F.lit(invocation_id).cast("string")
    )


# ---------------------------------------------------------------------------------------------------------
# O-42 latest-record dedup, O-20 validation, O-27 final projection
# ---------------------------------------------------------------------------------------------------------
def dedup_latest(
    df: DataFrame,
    key: str = "event_id",
    order_by: list[str] | None = None,
) -> DataFrame:
    """Keep the newest row per ``key``: ``row_number() over (partition by key order by processing desc) = 1``.

    * Rows with a NULL key are removed first: they would all hash into one task and are dropped by
      validation anyway.
    * Ties are broken by ``event_timestamp desc`` then a hash of the whole row, so the result is deterministic.
    * Catalyst turns the ``rn = 1`` filter into a partial ``WindowGroupLimit`` that runs before the shuffle,
      so a key repeated millions of times ships one row per map task, not all of them.
    """
    order_by = order_by or ["processing_timestamp", "event_timestamp"]
    cols = df.columns
    tie = F.xxhash64(*[F.col(c) for c in cols])
    w = Window.partitionBy(key).orderBy(*[F.col(c).desc_nulls_last() for c in order_by], tie.desc())
    return (
        df.where(F.col(key).isNotNull())
        .withColumn("rn", F.row_number().over(w))
        .where(F.col("rn") == 1)
        .drop("rn")
    )


def validity_condition() -> Column:
    return (
        F.col("event_id").isNotNull()
        & F.col("user_id").isNotNull()
        & F.col("event_type").isin(FUNNEL_EVENT_TYPES)
        & F.col("event_timestamp").isNotNull()
    )


def validate_silver(df: DataFrame) -> DataFrame:
    """Required ids and time present, event type one of the four funnel steps (NULL type drops)."""
    return df.where(validity_condition())


def stg_clickstream(
    bronze: DataFrame,
    run_started_at: RunTime | None = None,
    lookback_start: str | int = "1 hour 30 minutes",
    lookback_end: str | int = "30 minutes",
    as_of: RunTime | None = None,
    invocation_id: str | None = None,
    audit: bool = False,
    date_partition_col: str | None = None,
) -> DataFrame:
    """Silver clickstream: [lookback slice] -> typed -> latest copy per event_id -> valid rows.

    ``run_started_at=None`` processes the whole input (backfill). Validation runs *after* dedup: when the
    newest copy of an event is invalid the event is dropped, as in the warehouse model.
    """
    copies = newest_copies(
        bronze, run_started_at, lookback_start, lookback_end, as_of, invocation_id, audit, date_partition_col
    )
    return validate_silver(copies)


def newest_copies(
    bronze: DataFrame,
    run_started_at: RunTime | None = None,
    lookback_start: str | int = "1 hour 30 minutes",
    lookback_end: str | int = "30 minutes",
    as_of: RunTime | None = None,
    invocation_id: str | None = None,
    audit: bool = False,
    date_partition_col: str | None = None,
) -> DataFrame:
    """``stg_clickstream`` before validation: the newest copy of each event, be it valid or not.

    A run that merges a slice into stored rows compares copies first and validates what is left.
    """
    df = bronze
    if run_started_at is not None:
        df = lookback_window(df, run_started_at, lookback_start, lookback_end, date_partition_col=date_partition_col)
    df = dedup_latest(typed_projection(df))
    if audit:
        df = add_audit_columns(df, as_of if as_of is not None else run_started_at, invocation_id)
    return df


# ---------------------------------------------------------------------------------------------------------
# O-21 products, O-22 rename, O-28 enrichment
# ---------------------------------------------------------------------------------------------------------
def stg_products(products: DataFrame, as_of: RunTime | None = None, audit: bool = False) -> DataFrame:
    """Active catalogue rows, typed (``is_active = true``; NULL drops)."""
    df = products.select(
        *[
            (F.col(c).cast("double") if c == "price" else to_ntz(c) if c in ("created_at", "updated_at") else F.col(c)).alias(c)
            for c in PRODUCT_COLUMNS
        ]
    ).where(F.col("is_active"))
    if audit:
        df = df.withColumn("dbt_processed_at", now_or(as_of))
    return df


def enrich_with_products(
    clickstream: DataFrame,
    products: DataFrame,
    broadcast_max_bytes: int = DEFAULT_BROADCAST_MAX_BYTES,
) -> DataFrame:
    """Left join events to the active catalogue on product_id; the event's own value wins, the catalogue fills gaps.

    The catalogue is broadcast only when its size is proven to be at most ``broadcast_max_bytes``; a larger
    catalogue goes through a sort-merge join whose NULL product ids are spread over all tasks.
    """
    filled = ("category_id", "category_name", "brand", "price", "currency")
    catalogue = products.select(F.col("product_id").alias("_key"), F.struct(*filled).alias("_known"))
    joined = left_join_dimension(clickstream, catalogue, "product_id", "_key", "event_id", broadcast_max_bytes)
    known = F.col("_known")
    return joined.select(
        *[F.coalesce(c, known[c]).alias(c) if c in filled else F.col(c) for c in clickstream.columns]
    )


def silver_and_enriched(
    bronze: DataFrame,
    products: DataFrame,
    run_started_at: RunTime | None = None,
    broadcast_max_bytes: int = DEFAULT_BROADCAST_MAX_BYTES,
) -> DataFrame:
    """``int_enriched_clickstream`` from bronze and the raw catalogue."""
    return enrich_with_products(
        stg_clickstream(bronze, run_started_at), stg_products(products), broadcast_max_bytes=broadcast_max_bytes
    )


__all__ = [
    "lookback_window",
    "lookback_macro_window",
    "typed_projection",
    "add_audit_columns",
    "dedup_latest",
    "validate_silver",
    "stg_clickstream",
    "newest_copies",
    "stg_products",
    "enrich_with_products",
    "silver_and_enriched",
]
