"""Schemas and fixed value sets of the clickstream data model."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the source system's contracts).
# ---------------------------------------------------------------------------
FUNNEL_EVENT_TYPES = ["page_view", "view_item", "add_to_cart", "purchase"]
DEVICE_TYPES = ["mobile", "desktop", "tablet"]
CURRENCIES = ["BRL", "USD"]
DEFAULT_CURRENCY = "BRL"
DEFAULT_IP_COUNTRY = "BR"
DEFAULT_DEVICE_TYPE = "mobile"
EVENTS_TOPIC = "ecommerce-events"
REQUIRED_EVENT_FIELDS = ["user_id", "event_type", "event_timestamp"]
# Funnel step of each event type (1 = top of the funnel).
FUNNEL_STEP = {"page_view": 1, "view_item": 2, "add_to_cart": 3, "purchase": 4}

# Columns of the raw event / bronze table, in order.
BRONZE_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("session_id", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("event_timestamp", T.TimestampNTZType()),
        T.StructField("processing_timestamp", T.TimestampNTZType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("category_id", T.StringType()),
        T.StructField("category_name", T.StringType()),
        T.StructField("brand", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("currency", T.StringType()),
        T.StructField("page_url", T.StringType()),
        T.StructField("referrer_url", T.StringType()),
        T.StructField("user_agent", T.StringType()),
        T.StructField("ip_country", T.StringType()),
        T.StructField("device_type", T.StringType()),
        T.StructField("os", T.StringType()),
        T.StructField("browser", T.StringType()),
    ]
)
BRONZE_COLUMNS = [f.name for f in BRONZE_SCHEMA.fields]

# Every field of a raw JSON event is first read as text; typing happens after.
RAW_JSON_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in BRONZE_COLUMNS if c != "processing_timestamp"]
)

# Kafka record envelope.
ENVELOPE_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampNTZType()),
    ]
)

# Product catalogue seed.
PRODUCTS_SCHEMA = T.StructType(
    [
        T.StructField("product_id", T.StringType()),
        T.StructField("category_id", T.StringType()),
        T.StructField("category_name", T.StringType()),
        T.StructField("brand", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("currency", T.StringType()),
        T.StructField("is_active", T.BooleanType()),
        T.StructField("created_at", T.TimestampNTZType()),
        T.StructField("updated_at", T.TimestampNTZType()),
    ]
)
PRODUCT_COLUMNS = [f.name for f in PRODUCTS_SCHEMA.fields]

# Columns silver guarantees; the schema contract fails when one is missing.
SILVER_REQUIRED_COLUMNS = [
    "event_id",
    "user_id",
    "session_id",
    "event_type",
    "event_timestamp",
    "processing_timestamp",
    "user_agent",
    "ip_country",
    "device_type",
]
