"""Exact distinct users as stored partial states that merge.

Users are numbered once, and a state is a bitmap of the numbers seen in an hour: ``PART`` numbers a row. States of hours,
late events and re-deliveries are merged by OR, and a day's distinct users are the bits of its hours' states OR-ed together. A
late event adds a state of its own; no old event is read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SHARES = 1024


def numbered(values: DataFrame, column: str, known: DataFrame | None = None) -> DataFrame:
    """(value, number) of every non-null value of ``column``: those of ``known`` stay, new ones get the numbers after them.

    Numbers run from 1 without gaps. They are given in two levels, places inside hash shares plus the sizes of the shares
    before, so no task holds all values.
    """
    new = values.where(F.col(column).isNotNull()).select(F.col(column).alias("value")).distinct()
    last = 0
    if known is not None:
        last = known.agg(F.max("number")).first()[0] or 0
        new = new.join(known.select("value"), "value", "left_anti")
    new = new.withColumn("_share", F.pmod(F.xxhash64("value"), F.lit(SHARES)))
    sizes = new.groupBy("_share").agg(F.count("*").alias("_n"))
    earlier = Window.orderBy("_share").rowsBetween(Window.unboundedPreceding, -1)  # SHARES rows at most
    sizes = sizes.select("_share", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_share").orderBy("value"))
    fresh = new.withColumn("_place", place).join(F.broadcast(sizes), "_share")
    fresh = fresh.select("value", (F.lit(last).cast("long") + F.col("_before") + F.col("_place")).alias("number"))
    return fresh if known is None else known.select("value", "number").union(fresh)


def user_states(
    events: DataFrame, numbers: DataFrame, column: str = "user_id", ts_col: str = "event_timestamp",
    by: tuple[str, ...] = (), grain: str = "hour",
) -> DataFrame:
    """One row for each hour, ``by`` and part of the numbers: ``period``, ``by``, ``part`` and ``bits``.

    Repeats are dropped before the join, so a user with a third of all events brings one row an hour.
    """
    period = F.date_trunc(grain, F.col(ts_col)).cast("timestamp_ntz").alias("period")
    seen = events.where(F.col(column).isNotNull() & F.col(ts_col).isNotNull())
    seen = seen.select(period, *by, F.col(column).alias("value")).distinct().join(numbers, "value")
    return seen.groupBy("period", *by, F.bitmap_bucket_number("number").alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits")
    )


def merged(states: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """States of the same period, ``by`` and part as one; the same state twice changes nothing."""
    return states.groupBy("period", *by, "part").agg(F.bitmap_or_agg("bits").alias("bits"))


def unique_users(states: DataFrame, period: str = "day", by: tuple[str, ...] = ()) -> DataFrame:
    """Exact distinct users of every ``period`` (column of that name) and ``by``, from states alone."""
    when = F.date_trunc(period, F.col("period")).cast("date" if period in ("day", "week", "month", "year") else "timestamp_ntz")
    parts = states.groupBy(when.alias(period), *by, "part").agg(F.bitmap_or_agg("bits").alias("bits"))
    return parts.groupBy(period, *by).agg(F.sum(F.bitmap_count("bits")).alias("unique_users"))
