"""Streaming analytics on the clickstream: late data, dedup, minute revenue, sessions, cart outcomes.

Event time in streams is ``TIMESTAMP`` (watermarks do not accept ``TIMESTAMP_NTZ``); ``as_event_time`` casts
the NTZ column with the session time zone, which must be UTC.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.columns import duration_micros, money

LATE_HOLD = "30 minutes"


def as_event_time(df: DataFrame, col: str = "event_timestamp") -> DataFrame:
    return df.withColumn(col, F.col(col).cast("timestamp"))


def with_late_data_bound(df: DataFrame, delay: str = LATE_HOLD, col: str = "event_timestamp") -> DataFrame:
    """Event-time watermark: state older than ``max(event time) - delay`` is finalised and dropped; events later
    than that are ignored by stateful operators (same 30-minute hold-back as the batch lookback)."""
    return as_event_time(df, col).withWatermark(col, delay)


def dedup_within_watermark(df: DataFrame, key: str = "event_id", delay: str = LATE_HOLD) -> DataFrame:
    """Drop repeated deliveries of an event inside the watermark delay (keeps the first; silver keeps the latest)."""
    return with_late_data_bound(df, delay).dropDuplicatesWithinWatermark([key])


def minute_revenue_stream(events: DataFrame, width: str = "1 minute", delay: str = LATE_HOLD) -> DataFrame:
    """Purchase revenue per tumbling event-time window; a window is emitted once the watermark passes it."""
    p = with_late_data_bound(events, delay).where(
        (F.col("event_type") == "purchase") & F.col("price").isNotNull() & (F.col("price") > 0)
    )
    agg = p.groupBy(F.window("event_timestamp", width).alias("w")).agg(
        F.sum(money("price")).alias("_rev"), F.count(F.lit(1)).alias("orders_count")
    )
    return agg.select(
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        F.round(F.col("_rev").cast("double"), 6).alias("revenue"),
        "orders_count",
    )


def session_stream(events: DataFrame, gap: str = "30 minutes", delay: str = LATE_HOLD) -> DataFrame:
    """Per-user sessions with a dynamic gap window.

    ``session_window`` merges two events whose gap equals the window exactly, while the batch rule starts a
    new session at a gap of exactly 30 minutes; a gap one microsecond shorter gives the batch rule.
    """
    gap_us = duration_micros(gap) - 1
    gap_text = f"{gap_us // 1_000_000} seconds {gap_us % 1_000_000} microseconds"
    e = with_late_data_bound(events, delay).where(F.col("user_id").isNotNull())
    return e.groupBy("user_id", F.session_window("event_timestamp", gap_text).alias("s")).agg(
        F.count(F.lit(1)).alias("events")
    ).select("user_id", F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"), "events")


# ---------------------------------------------------------------------------------------------------------
# Cart outcomes in a stream (streaming form of the 24-hour cart -> purchase match)
# ---------------------------------------------------------------------------------------------------------
CART_OUTCOME_SCHEMA = (
    "event_id string, user_id string, product_id string, category_id string, category_name string, "
    "cart_at timestamp, price double, n_purchases long, first_purchase_at timestamp"
)
_STATE_SCHEMA = (
    "cart_ids array<string>, cart_t array<long>, cart_cat array<string>, cart_cat_name array<string>, "
    "cart_price array<double>, purchase_t array<long>"
)


def _cart_outcomes_fn(within_us: int):
    def fn(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        user_id, product_id = key
        if state.exists:
            (ids, ct, cat, catn, price, pt) = state.get
            ids, ct, cat, catn, price, pt = list(ids), list(ct), list(cat), list(catn), list(price), list(pt)
        else:
            ids, ct, cat, catn, price, pt = [], [], [], [], [], []
        if not state.hasTimedOut:
            for pdf in batches:
                is_p = pdf["is_purchase"].to_numpy(dtype=bool)
                t = pdf["t"].to_numpy(dtype=np.int64)
                pt.extend(t[is_p].tolist())
                carts = pdf[~is_p]
                ids.extend(carts["event_id"].tolist())
                ct.extend(carts["t"].astype("int64").tolist())
                cat.extend(carts["category_id"].tolist())
                catn.extend(carts["category_name"].tolist())
                price.extend(carts["price"].tolist())
        wm_us = state.getCurrentWatermarkMs() * 1000
        ct_a = np.asarray(ct, dtype=np.int64)
        pt_a = np.sort(np.asarray(pt, dtype=np.int64))
        done = ct_a + within_us <= wm_us  # no purchase at or after the watermark can still reach these carts
        out = None
        if done.any():
            lo = np.searchsorted(pt_a, ct_a[done], side="left")
            hi = np.searchsorted(pt_a, ct_a[done] + within_us, side="left")
            n = hi - lo
            first = np.zeros(len(n), dtype=np.int64)
            has = n > 0
            first[has] = pt_a[lo[has]]
            idx = np.nonzero(done)[0]
            out = pd.DataFrame(
                {
                    "event_id": [ids[i] for i in idx],
                    "user_id": user_id,
                    "product_id": product_id,
                    "category_id": [cat[i] for i in idx],
                    "category_name": [catn[i] for i in idx],
                    "cart_at": pd.to_datetime(ct_a[done], unit="us"),
                    "price": [price[i] for i in idx],
                    "n_purchases": n.astype("int64"),
                    "first_purchase_at": pd.Series(pd.to_datetime(first, unit="us")).where(has),
                }
            )
        keep = ~done
        ids = [ids[i] for i in np.nonzero(keep)[0]]
        cat = [cat[i] for i in np.nonzero(keep)[0]]
        catn = [catn[i] for i in np.nonzero(keep)[0]]
        price = [price[i] for i in np.nonzero(keep)[0]]
        ct_keep = ct_a[keep]
        # purchases older than every pending cart and than the watermark can never match again
        horizon = min(ct_keep.min() if len(ct_keep) else wm_us, wm_us) if wm_us > 0 else None
        pt_keep = pt_a if horizon is None else pt_a[pt_a >= horizon]
        if len(ids) == 0 and len(pt_keep) == 0:
            state.remove()
        else:
            state.update((ids, ct_keep.tolist(), cat, catn, price, pt_keep.tolist()))
            next_due = int((ct_keep.min() + within_us) // 1000) if len(ct_keep) else int(wm_us // 1000) + 1
            state.setTimeoutTimestamp(max(next_due, int(wm_us // 1000) + 1))
        if out is not None:
            yield out

    return fn


def cart_outcomes_stream(
    enriched_events: DataFrame, within: str = "24 hours", delay: str = LATE_HOLD
) -> DataFrame:
    """Per cart: purchases of the same user and product within ``within``; emitted once the watermark passes
    ``cart_at + within`` (so with the 30-minute hold-back a cart's outcome appears ~24.5 h after the cart).

    State per (user, product) holds only pending carts and the purchases that can still match them; output is
    one row per cart (counts, never cart x purchase pairs). Feed it to ``gold``-style aggregates per day.
    """
    within_us = duration_micros(within)
    e = with_late_data_bound(enriched_events, delay).where(
        F.col("product_id").isNotNull()
        & (
            ((F.col("event_type") == "add_to_cart") & F.col("category_id").isNotNull())
            | (F.col("event_type") == "purchase")
        )
    )
    rows = e.select(
        "user_id",
        "product_id",
        "event_id",
        "category_id",
        "category_name",
        "price",
        (F.col("event_type") == "purchase").alias("is_purchase"),
        F.unix_micros("event_timestamp").alias("t"),
        "event_timestamp",
    )
    return rows.groupBy("user_id", "product_id").applyInPandasWithState(
        _cart_outcomes_fn(within_us),
        CART_OUTCOME_SCHEMA,
        _STATE_SCHEMA,
        "append",
        GroupStateTimeout.EventTimeTimeout,
    )


# ---------------------------------------------------------------------------------------------------------
# The same match as a stream-stream join
# ---------------------------------------------------------------------------------------------------------
def cart_purchase_pairs_stream(enriched_events: DataFrame, within: str = "24 hours", delay: str = LATE_HOLD) -> DataFrame:
    """Every cart with each purchase of the same user and product in ``[cart_at, cart_at + within)``; a cart without one
    comes once, with a null ``purchase_at``, when the watermark shows that none can come any more.

    A left outer interval join of two watermarked streams. Its state lives in the JVM, and the interval lets Spark
    drop carts ``within`` after and purchases right after the watermark has passed them.
    """
    e = with_late_data_bound(enriched_events, delay)
    carts = e.where(
        (F.col("event_type") == "add_to_cart") & F.col("product_id").isNotNull() & F.col("category_id").isNotNull()
    ).select(
        "event_id", "user_id", "product_id", "category_id", "category_name", "price", F.col("event_timestamp").alias("cart_at")
    )
    purchases = e.where((F.col("event_type") == "purchase") & F.col("product_id").isNotNull()).select(
        F.col("user_id").alias("_buyer"), F.col("product_id").alias("_product"), F.col("event_timestamp").alias("purchase_at")
    )
    end = F.col("cart_at") + F.expr(f"INTERVAL '{duration_micros(within) / 1e6:.6f}' SECOND")
    same = (F.col("_buyer") == F.col("user_id")) & (F.col("_product") == F.col("product_id"))
    inside = (F.col("purchase_at") >= F.col("cart_at")) & (F.col("purchase_at") < end)
    return carts.join(purchases, same & inside, "leftOuter").drop("_buyer", "_product")


def cart_outcomes_join_stream(enriched_events: DataFrame, within: str = "24 hours", delay: str = LATE_HOLD) -> DataFrame:
    """The columns of ``cart_outcomes_stream``, from the pairs of ``cart_purchase_pairs_stream`` added up by cart.

    No Python runs. The aggregate's state holds a row a cart and is dropped with the watermark; a cart's outcome comes
    once, when no pair of it can follow. Pairs of one cart exist only between the two operators of a micro-batch. Use the
    stateful form where single carts have very many purchases; here the load of a hot (user, product) is its pairs.
    """
    pairs = cart_purchase_pairs_stream(enriched_events, within, delay)
    cart = ["event_id", "user_id", "product_id", "category_id", "category_name", "cart_at", "price"]
    per_cart = pairs.groupBy(*cart).agg(
        F.count("purchase_at").alias("n_purchases"), F.min("purchase_at").alias("first_purchase_at")
    )
    return per_cart.select(*cart, "n_purchases", "first_purchase_at")
