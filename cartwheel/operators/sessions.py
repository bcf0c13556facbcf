"""Sessions: inactivity-gap sessionization, per-session funnel depth, session-id consistency checks.

A session continues while the gap to the user's previous event is *strictly less* than ``gap`` (30 minutes);
a gap of exactly ``gap`` starts a new session.

Scale: a plain ``lag() over (partition by user order by ts)`` sends each user's whole history to one task,
which is a straggler (or a spill storm) when one user is a large share of all events. ``sessionize`` instead
works in two levels, like a parallel prefix sum:

1. partition by (user, time bucket) of fixed width (``buckets.py``) and find session starts inside each bucket;
2. a small per-(user, bucket) summary (first/last event, number of starts) gets a running count per user,
   which numbers the sessions across buckets, and decides whether a bucket's first event continues the
   previous bucket's last session;
3. the summary is joined back (it is no longer than the events and far narrower) and the in-bucket count is added.

No group is larger than one user's events in one bucket. Building the plan starts no job; the input is read by two
branches (the rows, and the summary's few columns), so pass a stored table where it is costly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import duration_micros, epoch_micros
from ..schemas import FUNNEL_STEP
from .buckets import DEFAULT_BUCKET, running_max, time_bucket

DEFAULT_GAP = "30 minutes"


def sessionize(
    events: DataFrame,
    user_col: str = "user_id",
    ts_col: str = "event_timestamp",
    gap: str | int = DEFAULT_GAP,
    bucket: str | int = DEFAULT_BUCKET,
    tiebreak_col: str = "event_id",
) -> DataFrame:
    """Add ``session_seq`` (1, 2, ... per user, in time order) and ``is_session_start`` to every event.

    Rows with a NULL user or time are left out (they belong to no session).
    """
    gap_us = duration_micros(gap)
    ev = events.where(F.col(user_col).isNotNull() & F.col(ts_col).isNotNull()).withColumn("_t", epoch_micros(ts_col))
    ev = ev.withColumn("_b", time_bucket("_t", duration_micros(bucket)))
    w_in = Window.partitionBy(user_col, "_b").orderBy("_t", tiebreak_col)
    ev = ev.withColumn("_prev_t", F.lag("_t").over(w_in))
    ev = ev.withColumn(
        "_start_in", (F.col("_prev_t").isNotNull() & (F.col("_t") - F.col("_prev_t") >= gap_us)).cast("long")
    )
    summary = ev.groupBy(user_col, "_b").agg(
        F.min("_t").alias("_first_t"), F.max("_t").alias("_last_t"), F.sum("_start_in").alias("_starts_in")
    )
    w_user = Window.partitionBy(user_col).orderBy("_b")
    prev_last = F.lag("_last_t").over(w_user)
    summary = summary.withColumn(
        "_first_starts", (prev_last.isNull() | (F.col("_first_t") - prev_last >= gap_us)).cast("long")
    ).withColumn(
        "_offset",
        F.coalesce(
            F.sum(F.col("_starts_in") + F.col("_first_starts")).over(w_user.rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        ),
    )
    joined = ev.join(summary.select(user_col, "_b", "_first_starts", "_offset"), [user_col, "_b"])
    is_start = F.when(F.col("_prev_t").isNull(), F.col("_first_starts")).otherwise(F.col("_start_in"))
    joined = joined.withColumn("is_session_start", is_start == 1)
    seq = F.col("_offset") + F.sum(is_start).over(w_in.rowsBetween(Window.unboundedPreceding, 0))
    return joined.withColumn("session_seq", seq.cast("long")).drop(
        "_t", "_b", "_prev_t", "_start_in", "_first_starts", "_offset"
    )


def _step() -> Column:
    """Funnel step of an event, 1 to 4; NULL outside the funnel."""
    return F.element_at(F.create_map(*[F.lit(x) for kv in FUNNEL_STEP.items() for x in kv]), F.col("event_type"))


def session_progress(
    sessionized: DataFrame,
    user_col: str = "user_id",
    ts_col: str = "event_timestamp",
    bucket: str | int = DEFAULT_BUCKET,
    tiebreak_col: str = "event_id",
) -> DataFrame:
    """Add ``current_step``: the deepest funnel step that the session has reached so far, this event included.

    0 until a step is reached. A session without end (a bot that never pauses) is split by time like any hot key.
    """
    rows = sessionized.withColumn("_t", epoch_micros(ts_col)).withColumn("_step", F.coalesce(_step(), F.lit(0)))
    keys = [user_col, "session_seq"]
    out = running_max(rows, keys, "_t", ["_t", tiebreak_col], "_step", duration_micros(bucket), "current_step")
    return out.drop("_t", "_step")


def sessions(sessionized: DataFrame, user_col: str = "user_id", ts_col: str = "event_timestamp") -> DataFrame:
    """One row per session: start, end, events and funnel depth (deepest step reached, 0..4)."""
    return sessionized.groupBy(user_col, "session_seq").agg(
        F.min(ts_col).alias("session_start"),
        F.max(ts_col).alias("session_end"),
        F.count(F.lit(1)).alias("events"),
        F.coalesce(F.max(_step()), F.lit(0)).alias("funnel_depth"),
    )


def session_funnel_depth(sessionized: DataFrame, user_col: str = "user_id") -> DataFrame:
    """Per session: deepest funnel step and whether it reached each step (view, cart, purchase)."""
    s = sessions(sessionized, user_col)
    return s.select(
        user_col,
        "session_seq",
        "session_start",
        "events",
        "funnel_depth",
        (F.col("funnel_depth") >= 2).alias("reached_view_item"),
        (F.col("funnel_depth") >= 3).alias("reached_cart"),
        (F.col("funnel_depth") >= 4).alias("reached_purchase"),
    )


def session_consistency_literal(df: DataFrame, user_col: str = "user_id", session_col: str = "session_id") -> DataFrame:
    """The upstream test as written: (user, session) groups with more than one distinct session -- never any."""
    return (
        df.groupBy(user_col, session_col)
        .agg(F.count_distinct(session_col).alias("session_count"))
        .where(F.col("session_count") > 1)
    )


def session_consistency_violations(
    df: DataFrame,
    user_col: str = "user_id",
    session_col: str = "session_id",
    ts_col: str = "event_timestamp",
    bucket: str | int = DEFAULT_BUCKET,
) -> DataFrame:
    """Meaningful form of the test. Violations are:

    * ``shared_session``: one session id used by more than one user;
    * ``interleaved``: a user's session id comes back after another session id started (sessions interleave).

    The second is computed per (user, session) from first/last times (one row per session, not per event) and
    a two-level running max over the user's sessions, so neither a user's events nor a user's sessions gather in
    one task.
    """
    shared = (
        df.where(F.col(session_col).isNotNull())
        .groupBy(session_col)
        .agg(F.count_distinct(user_col).alias("n"))
        .where(F.col("n") > 1)
        .select(F.lit(None).cast("string").alias(user_col), session_col, F.lit("shared_session").alias("violation"))
    )
    spans = (
        df.where(F.col(session_col).isNotNull() & F.col(user_col).isNotNull())
        .groupBy(user_col, session_col)
        .agg(F.min(ts_col).alias("_first"), F.max(ts_col).alias("_last"))
    )
    # the greatest end of the sessions that started earlier; a user with very many sessions is split by start time
    spans = running_max(
        spans.withColumn("_t", epoch_micros("_first")),
        [user_col],
        "_t",
        ["_first", session_col],
        "_last",
        duration_micros(bucket),
        "_ended",
        last=-1,
    )
    inter = spans.where(F.col("_ended") > F.col("_first")).select(
        user_col, session_col, F.lit("interleaved").alias("violation")
    )
    return shared.unionByName(inter)
