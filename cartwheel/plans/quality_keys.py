"""Check sets used by the registered quality queries (shared by the Spark side and the SQL oracle)."""

from __future__ import annotations

from ..quality import checks as C
from ..schemas import CURRENCIES, DEVICE_TYPES, FUNNEL_EVENT_TYPES

NOT_NULL_COLUMNS = ["event_id", "user_id", "session_id", "event_type", "event_timestamp", "processing_timestamp",
                    "ip_country"]
MISSING = [C.missing(c) for c in NOT_NULL_COLUMNS]
DUPLICATES = [C.duplicates("event_id"), C.duplicates("session_id")]
ACCEPTED = [
    C.invalid("event_type", FUNNEL_EVENT_TYPES),
    C.invalid("currency", CURRENCIES),
    C.invalid("device_type", DEVICE_TYPES),
]
BETWEEN = [C.between("price", low=0), C.between("price", low=0, high=50)]
MINS = [C.min_at_least("price", 0), C.min_at_least("price", 5)]
RATES = ["conversion_rate_view", "conversion_rate_cart", "conversion_rate_purchase", "overall_conversion_rate"]
ROW_PREDICATES = [C.row_predicate(f"{c} >= 0") for c in ["page_views", "view_items", "add_to_carts", "purchases"]] + [
    C.row_predicate(f"{c} {op} {v}") for c in RATES for op, v in ((">=", 0), ("<=", 100))
]
CROSS_FUNNEL = [
    C.row_predicate("view_items <= page_views"),
    C.row_predicate("add_to_carts <= view_items"),
    C.row_predicate("purchases <= add_to_carts"),
]
CROSS_ABANDON = [C.row_predicate("abandoned_carts = cart_additions - completed_purchases")]
FRESHNESS = [
    C.freshness("event_timestamp", "2 hours", "1 hour"),
    C.freshness("processing_timestamp", "60 days", "30 days"),
]
ROW_COUNT = [C.row_count_above(100)]
SENSOR_CURSOR = "2024-01-15 11:00:00"
