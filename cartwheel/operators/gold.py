"""Gold layer: daily revenue, conversion funnel, cart abandonment and their building blocks.

All inputs are the enriched silver clickstream (``int_enriched_clickstream``): one row per event_id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import (
    duration_micros,
    epoch_micros,
    from_epoch_micros,
    money,
    percent,
    safe_divide,
)
from ..schemas import FUNNEL_EVENT_TYPES
from .buckets import DEFAULT_BUCKET, time_bucket
from .silver import RunTime, now_or



def _double6(c):
    return F.round(c.cast("double"), 6)


def _with_updated_at(df: DataFrame, as_of: RunTime | None, audit: bool) -> DataFrame:
    return df.withColumn("updated_at", now_or(as_of)) if audit else df


# ---------------------------------------------------------------------------------------------------------
# O-24 / O-31 daily revenue
# ---------------------------------------------------------------------------------------------------------
def revenue_purchases(enriched: DataFrame) -> DataFrame:
    """Purchases with a positive price."""
    return enriched.where(
        (F.col("event_type") == "purchase") & F.col("price").isNotNull() & (F.col("price") > 0)
    ).select(
        F.to_date("event_timestamp").alias("revenue_date"),
        "user_id",
        "event_id",
        "price",
        "event_timestamp",
    )


def fct_daily_revenue(
    enriched: DataFrame,
    as_of: RunTime | None = None,
    audit: bool = True,
    event_ids_unique: bool = True,
) -> DataFrame:
    """Per day: gross revenue, orders, unique buyers, average order value.

    Silver holds one row per event_id, so ``count(distinct event_id)`` equals ``count(*)``; with
    ``event_ids_unique`` the plan keeps a single distinct aggregate (user_id) and needs no Expand, which
    would otherwise triple the rows shuffled. Pass ``False`` for input that may repeat ids.
    """
    p = revenue_purchases(enriched)
    orders = F.count(F.lit(1)) if event_ids_unique else F.count_distinct("event_id")
    agg = p.groupBy("revenue_date").agg(
        F.sum(money("price")).alias("_gross"),
        orders.alias("orders_count"),
        F.count_distinct("user_id").alias("unique_buyers"),
    )
    out = agg.select(
        "revenue_date",
        _double6(F.col("_gross")).alias("gross_revenue"),
        "orders_count",
        "unique_buyers",
        F.round(safe_divide(F.col("_gross").cast("double"), F.col("orders_count")), 6).alias("avg_order_value"),
    )
    return _with_updated_at(out, as_of, audit)


def minute_revenue(enriched: DataFrame, width: str = "1 minute") -> DataFrame:
    """Revenue per tumbling event-time window (the 'minute by minute' view of the daily table)."""
    p = revenue_purchases(enriched)
    agg = p.groupBy(F.window("event_timestamp", width).alias("w")).agg(
        F.sum(money("price")).alias("_rev"), F.count(F.lit(1)).alias("orders_count")
    )
    return agg.select(
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        _double6(F.col("_rev")).alias("revenue"),
        "orders_count",
    )


# ---------------------------------------------------------------------------------------------------------
# O-32 .. O-34 conversion funnel
# ---------------------------------------------------------------------------------------------------------
def daily_event_counts(enriched: DataFrame) -> DataFrame:
    """Per (day, event type): events and distinct users. One distinct aggregate: no Expand in the plan."""
    return (
        enriched.where(F.col("event_type").isin(FUNNEL_EVENT_TYPES))
        .groupBy(F.to_date("event_timestamp").alias("funnel_date"), "event_type")
        .agg(F.count(F.lit(1)).alias("event_count"), F.count_distinct("user_id").alias("unique_users"))
    )


_PIVOT_NAMES = {
    "page_view": ("page_views", "unique_page_viewers"),
    "view_item": ("view_items", "unique_viewers"),
    "add_to_cart": ("add_to_carts", "unique_cart_adders"),
    "purchase": ("purchases", "unique_buyers"),
}


def funnel_pivot(counts: DataFrame) -> DataFrame:
    """Pivot the four steps into columns by conditional sums; a missing step is 0."""
    events, users = [], []
    for et, (ev_name, user_name) in _PIVOT_NAMES.items():
        is_et = F.col("event_type") == et
        events.append(F.coalesce(F.sum(F.when(is_et, F.col("event_count"))), F.lit(0)).alias(ev_name))
        users.append(F.coalesce(F.sum(F.when(is_et, F.col("unique_users"))), F.lit(0)).alias(user_name))
    return counts.groupBy("funnel_date").agg(*events, *users)


def fct_conversion_funnel(enriched: DataFrame, as_of: RunTime | None = None, audit: bool = True) -> DataFrame:
    """Daily funnel counts and step conversion rates (x100) on unique users; NULL rate when the base is 0."""
    p = funnel_pivot(daily_event_counts(enriched))
    out = p.select(
        "funnel_date",
        "page_views",
        "view_items",
        "add_to_carts",
        "purchases",
        percent("unique_viewers", "unique_page_viewers").alias("conversion_rate_view"),
        percent("unique_cart_adders", "unique_viewers").alias("conversion_rate_cart"),
        percent("unique_buyers", "unique_cart_adders").alias("conversion_rate_purchase"),
        percent("unique_buyers", "unique_page_viewers").alias("overall_conversion_rate"),
    )
    return _with_updated_at(out, as_of, audit)


# ---------------------------------------------------------------------------------------------------------
# O-25 / O-29 carts and their purchases
# ---------------------------------------------------------------------------------------------------------
def _is_cart() -> Column:
    return (F.col("event_type") == "add_to_cart") & F.col("product_id").isNotNull() & F.col("category_id").isNotNull()


def _is_purchase() -> Column:
    return (F.col("event_type") == "purchase") & F.col("product_id").isNotNull()


def cart_purchase_matches(
    enriched: DataFrame,
    within: str | int = "24 hours",
    bucket: str | int = DEFAULT_BUCKET,
) -> DataFrame:
    """For every cart: how many purchases of the same user and product fall in ``[cart_at, cart_at + within)``,
    and the first of them.

    This is the many-to-many interval join ``cart ⋈ purchase`` reduced to what the marts consume (the number
    of partners and the first one). No pair is materialised and no purchase is copied:

    * every cart becomes two probes, at ``cart_at`` and at ``cart_at + within``; with ``P(x)`` = purchases of the
      key before ``x``, the cart has ``P(cart_at + within) - P(cart_at)`` partners (a probe sorts before a purchase
      at the same instant, which makes the interval half-open);
    * ``P`` is a running count over (user, product) in time order, computed as a parallel prefix sum: running
      counts inside (key, time bucket) partitions plus the purchases of the key's earlier buckets, taken from a
      one-row-per-bucket summary. The first purchase at or after ``cart_at`` is a suffix minimum built the same
      way.

    Buckets have a fixed width (``buckets.py``), so no task holds a hot key's whole history and building the plan
    starts no job. The input is read by two branches, the probes and the summary's few columns. The two probes of a
    cart are joined up again by one aggregation on the cart (silver event ids are unique).
    """
    w_us = duration_micros(within)
    b_us = duration_micros(bucket)
    keys = ["user_id", "product_id"]
    cart_cols = ["event_id", "analysis_date", "category_id", "category_name", "user_id", "product_id", "cart_at", "price"]
    is_cart, is_purchase = _is_cart(), _is_purchase()
    # one filtered pass over the events feeds both sides (no union of two scans of the same input)
    rows = enriched.where(is_cart | is_purchase).select(
        "event_id",
        F.to_date("event_timestamp").alias("analysis_date"),
        "category_id",
        "category_name",
        "user_id",
        "product_id",
        F.col("event_timestamp").alias("cart_at"),
        "price",
        is_purchase.alias("_is_p"),
        epoch_micros("event_timestamp").alias("_t"),
    )
    # purchases: one row (probe -1); carts: a start probe (0) and an end probe (1)
    probe = F.when(F.col("_is_p"), F.array(F.lit(-1))).otherwise(F.array(F.lit(0), F.lit(1)))
    stacked = rows.withColumn("_probe", F.explode(probe)).withColumn(
        "_pt", F.col("_t") + F.when(F.col("_probe") == 1, F.lit(w_us)).otherwise(F.lit(0))
    )
    bucketed = stacked.withColumn("_b", time_bucket("_pt", b_us))
    is_p = F.col("_is_p")
    p_time = F.when(is_p, F.col("_pt"))
    # time order within a key; at the same instant probes (rank 0) come before purchases (rank 1)
    w_in = Window.partitionBy(*keys, "_b").orderBy("_pt", is_p.cast("int"))
    stacked = bucketed.withColumn(
        "_before", F.sum(is_p.cast("long")).over(w_in.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ).withColumn("_next", F.min(p_time).over(w_in.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
    # Per bucket: its purchases and its first purchase. A plain aggregate of the bucketed rows: partial
    # aggregation ships one row per bucket and map task, not the rows.
    summary = bucketed.groupBy(*keys, "_b").agg(F.sum(is_p.cast("long")).alias("_np"), F.min(p_time).alias("_minp"))
    w_key = Window.partitionBy(*keys).orderBy("_b")
    summary = summary.select(
        *keys,
        "_b",
        F.coalesce(F.sum("_np").over(w_key.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_offset"),
        F.min("_minp").over(w_key.rowsBetween(1, Window.unboundedFollowing)).alias("_later"),
    )
    probes = stacked.where(~is_p).join(summary, [*keys, "_b"])
    before = F.col("_offset") + F.col("_before")
    per_cart = probes.groupBy(*cart_cols, "_t").agg(
        F.sum(F.when(F.col("_probe") == 1, before).otherwise(-before)).alias("_n"),
        F.max(F.when(F.col("_probe") == 0, F.coalesce(F.col("_next"), F.col("_later")))).alias("_first"),
    )
    first = F.when(F.col("_first") < F.col("_t") + F.lit(w_us), F.col("_first"))
    return per_cart.select(
        *cart_cols,
        F.col("_n").cast("long").alias("n_purchases"),
        from_epoch_micros(first).alias("first_purchase_at"),
    )


# ---------------------------------------------------------------------------------------------------------
# O-35 .. O-37 cart abandonment
# ---------------------------------------------------------------------------------------------------------
def _category_day_totals(matches: DataFrame, first_only: bool = False) -> DataFrame:
    """One aggregation over carts gives both the cart totals and the matched-pair totals."""
    n = F.col("n_purchases")
    matched = F.when(n > 0, F.lit(1)).otherwise(F.lit(0)) if first_only else n
    return matches.groupBy("analysis_date", "category_id", "category_name").agg(
        F.count(F.lit(1)).alias("cart_additions"),
        F.sum(money("price")).alias("_cart_value"),
        F.sum(matched).cast("long").alias("_completed"),
        F.sum(F.when(n > 0, money("price") * matched)).alias("_purchased_value"),
    )


def cart_agg(matches: DataFrame) -> DataFrame:
    """Per (day, category id, category name): carts and their value."""
    t = _category_day_totals(matches)
    return t.select(
        "analysis_date", "category_id", "category_name", "cart_additions", _double6(F.col("_cart_value")).alias("cart_value")
    )


def _purchase_totals(totals: DataFrame) -> DataFrame:
    return (
        totals.groupBy("analysis_date", "category_id")
        .agg(F.sum("_completed").alias("completed_purchases"), F.sum("_purchased_value").alias("_realized"))
        .where(F.col("completed_purchases") > 0)
    )


def purchase_agg(matches: DataFrame) -> DataFrame:
    """Per (day, category id): matched cart-purchase pairs and the cart price they carry."""
    p = _purchase_totals(_category_day_totals(matches))
    return p.select(
        "analysis_date",
        "category_id",
        F.col("completed_purchases").cast("long").alias("completed_purchases"),
        _double6(F.col("_realized")).alias("purchased_value"),
    )


def fct_cart_abandonment(
    enriched: DataFrame,
    as_of: RunTime | None = None,
    audit: bool = True,
    first_only: bool = False,
    within: str | int = "24 hours",
    bucket: str | int = DEFAULT_BUCKET,
) -> DataFrame:
    """Cart abandonment per day and category.

    Default: the warehouse semantics, where every (cart, purchase) pair counts, so a cart bought twice adds 2
    completed purchases (abandoned may go negative). ``first_only=True``: each cart converts at most once.
    Purchases are keyed by category id only and joined back to every (id, name) row of carts.
    """
    totals = _category_day_totals(cart_purchase_matches(enriched, within, bucket), first_only)
    # Purchases are keyed by (day, category id) only: every (id, name) row of that id gets the id's totals.
    # The totals are one row per (day, category, name), so a window over them replaces a re-aggregate + join.
    per_id = Window.partitionBy("analysis_date", "category_id")
    j = totals.withColumn("completed_purchases", F.sum("_completed").over(per_id)).withColumn(
        "_realized", F.sum("_purchased_value").over(per_id)
    )
    completed = F.coalesce(F.col("completed_purchases"), F.lit(0)).cast("long")
    realized = F.coalesce(F.col("_realized"), F.lit(0).cast("decimal(28,9)"))
    out = j.select(
        "analysis_date",
        "category_id",
        "category_name",
        "cart_additions",
        completed.alias("completed_purchases"),
        (F.col("cart_additions") - completed).alias("abandoned_carts"),
        _double6(F.col("_cart_value")).alias("cart_value"),
        _double6(realized).alias("revenue_realized"),
        _double6(F.col("_cart_value") - realized).alias("revenue_lost"),
        percent(F.col("cart_additions") - completed, F.col("cart_additions")).alias("abandonment_rate"),
    )
    return _with_updated_at(out, as_of, audit)


__all__ = [
    "revenue_purchases",
    "fct_daily_revenue",
    "minute_revenue",
    "daily_event_counts",
    "funnel_pivot",
    "fct_conversion_funnel",
    "cart_purchase_matches",
    "cart_agg",
    "purchase_agg",
    "fct_cart_abandonment",
]
