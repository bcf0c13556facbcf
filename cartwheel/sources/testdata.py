"""Binding of the generated test tables (``events``, ``part``) to the clickstream data model.

The generated ``events`` table is not a clickstream, so a fixed, documented mapping (FIXTURES.md section 2)
turns it into bronze events, a product catalogue and a Kafka envelope. The DuckDB oracle uses the same
expressions in SQL. Everything here is a narrow projection of one parquet scan: no shuffle.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import iso_text, ts_literal
from ..schemas import BRONZE_COLUMNS, EVENTS_TOPIC, PRODUCT_COLUMNS, RAW_JSON_SCHEMA

# Fixed values of the binding.
EVENT_TYPE_MAP = {
    "click": "page_view",
    "view": "view_item",
    "signup": "add_to_cart",
    "purchase": "purchase",
}
PRODUCT_EVENT_TYPES = ["view", "signup", "purchase"]
CATALOGUE_TIMESTAMP = "2024-01-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _pad(c: Column, width: int) -> Column:
    return F.lpad(c.cast("string"), width, "0")


def bronze_from_events(events: DataFrame) -> DataFrame:
    """Bronze clickstream rows (19 columns) from the generated ``events`` table.

    Every tenth event arrives twice; the second copy is processed one hour later with a price one higher,
    so dedup has real work. The copy is made with ``explode`` on the same scan (no union, no second read).
    """
    eid = F.col("event_id")
    k = F.get_json_object("props", "$.k").cast("int") % 10
    base = events.select(
        eid.alias("_eid"),
        F.col("user_id").alias("_uid"),
        F.col("event_type").alias("_type"),
        F.col("ts"),
        F.col("value"),
        k.alias("_k"),
        F.explode(F.when(eid % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"),
    )
    eid, uid, etype, k, copy = (F.col(c) for c in ("_eid", "_uid", "_type", "_k", "_copy"))
    is_product = etype.isin(PRODUCT_EVENT_TYPES)
    type_map = F.create_map(*[F.lit(x) for kv in EVENT_TYPE_MAP.items() for x in kv])
    mapped_type = F.coalesce(F.element_at(type_map, etype), etype)
    device = F.element_at(F.array(*[F.lit(x) for x in ("mobile", "desktop", "tablet")]), (uid % 3 + 1).cast("int"))
    out = base.select(
        F.concat(F.lit("evt_"), _pad(eid, 8)).alias("event_id"),
        F.when(eid % 97 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("user_"), _pad(uid, 6)))
        .alias("user_id"),
        F.concat(F.lit("sess_"), uid.cast("string"), F.lit("_"), F.date_format("ts", "yyyyMMdd")).alias("session_id"),
        mapped_type.alias("event_type"),
        F.col("ts").alias("event_timestamp"),
        F.timestamp_add("SECOND", eid % 120 + copy * 3600, F.col("ts")).alias("processing_timestamp"),
        F.when(is_product, F.concat(F.lit("prod_"), _pad(k, 8))).alias("product_id"),
        F.when(is_product & (eid % 3 != 0), F.concat(F.lit("cat_"), (k % 3).cast("string"))).alias("category_id"),
        F.when(is_product & (eid % 3 != 0), F.concat(F.lit("Category "), (k % 3).cast("string"))).alias(
            "category_name"
        ),
        F.when(is_product & (eid % 4 != 0), F.lit("EventBrand")).alias("brand"),
        F.when(
            is_product & (eid % 7 != 0), F.when(eid % 89 == 0, F.lit(0.0)).otherwise(F.col("value") + copy)
        ).alias("price"),
        F.when(eid % 11 == 0, F.lit(None).cast("string")).otherwise(F.lit("BRL")).alias("currency"),
        F.when(etype == "click", F.concat(F.lit("https://shop.example/p/"), k.cast("string"))).alias("page_url"),
        F.when(eid % 3 == 0, F.lit("https://ref.example/")).alias("referrer_url"),
        F.concat(F.lit("ua_"), (uid % 3).cast("string")).alias("user_agent"),
        F.lit("BR").alias("ip_country"),
        device.alias("device_type"),
        F.concat(F.lit("os_"), (uid % 3).cast("string")).alias("os"),
        F.concat(F.lit("browser_"), (uid % 2).cast("string")).alias("browser"),
    )
    return out.select(*BRONZE_COLUMNS)


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze_from_events(table(spark, sf_dir, "events"))


def products_from_part(part: DataFrame) -> DataFrame:
    """Product catalogue (9 columns of the seed) from the generated ``part`` table."""
    key = F.col("p_partkey")
    return part.select(
        F.concat(F.lit("prod_"), _pad(key, 8)).alias("product_id"),
        F.concat(F.lit("cat_"), F.lower("p_type")).alias("category_id"),
        F.col("p_type").alias("category_name"),
        F.col("p_brand").alias("brand"),
        F.col("p_retailprice").alias("price"),
        F.lit("USD").alias("currency"),
        (key % 10 != 9).alias("is_active"),
        ts_literal(CATALOGUE_TIMESTAMP).alias("created_at"),
        ts_literal(CATALOGUE_TIMESTAMP).alias("updated_at"),
    ).select(*PRODUCT_COLUMNS)


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return products_from_part(table(spark, sf_dir, "part"))


def envelope_from_bronze(bronze_df: DataFrame) -> DataFrame:
    """Kafka records carrying bronze events as JSON, as a producer would publish them.

    All 18 fields of an event are sent, NULL ones left out. Hand-made defects, by the number of the event (the first
    that applies): keys left out (``event_id`` of every 50th, ``event_type`` of every 131st, ``event_timestamp`` of
    every 137th), an empty user (139th), a time three hours behind UTC (107th) or no time at all (109th), a quoted
    price (113th) or no number (127th), text after the JSON (103rd), no JSON (101st).
    """
    num = F.regexp_extract("event_id", r"(\d+)$", 1).cast("long")
    uid_num = F.regexp_extract("session_id", r"^sess_(\d+)_", 1).cast("long")

    def every(n: int) -> Column:
        return num % n == 0

    time = iso_text("event_timestamp")
    made = {
        "event_id": F.when(~every(50), F.col("event_id")),
        "user_id": F.when(every(139), F.lit("")).otherwise(F.col("user_id")),
        "event_type": F.when(~every(131), F.col("event_type")),
        "event_timestamp": F.when(every(107), F.concat(time, F.lit("-03:00")))
        .when(every(109), F.lit("no time"))
        .when(~every(137), time),
    }
    payload = F.to_json(F.struct(*[made.get(c, F.col(c)).alias(c) for c in RAW_JSON_SCHEMA.fieldNames()]))
    price = F.when(every(113), F.lit('"price":"$1"')).when(every(127), F.lit('"price":"free"')).otherwise(F.lit('"price":$1'))
    payload = F.regexp_replace(payload, F.lit('"price":([^,}]+)'), price)
    payload = F.concat(payload, F.when(every(103), F.lit(" trailing")).otherwise(F.lit("")))
    value = F.when(every(101), F.lit("{bad")).otherwise(payload)
    return bronze_df.select(
        F.col("user_id").cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit(EVENTS_TOPIC).alias("topic"),
        (uid_num % 3).cast("int").alias("partition"),
        num.alias("offset"),
        F.col("processing_timestamp").alias("timestamp"),
    )


def envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelope_from_bronze(bronze(spark, sf_dir))
