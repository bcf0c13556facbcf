import datetime as dt
import json
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from cartwheel.operators import ingest, monitoring
from cartwheel.schemas import BRONZE_COLUMNS, ENVELOPE_SCHEMA
from cartwheel.sources import seeds
from cartwheel.sources.bronze import read_bronze, write_bronze
from cartwheel.sources.kafka import kafka_source_options
from cartwheel.sources import testdata as td

from helpers import SF001, SF01

BROKER_TS = dt.datetime(2024, 1, 15, 12, 0, 0)


def _env(spark, values):
    rows = [(b"k", v.encode() if v is not None else None, "ecommerce-events", 1, i, BROKER_TS) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, ENVELOPE_SCHEMA)


def test_json_cases(spark):
    values = [
        '{"user_id":"u1","event_type":"purchase","event_timestamp":"2024-01-15T11:00:00.000001","price":"12.5"}',
        '{"event_id":null,"user_id":"u1","event_type":"purchase","event_timestamp":"2024-01-15T11:00:00"}',
        "{bad",
        "[1,2]",
        '{"event_id":"e5","user_id":"","event_type":"purchase","event_timestamp":"2024-01-15T11:00:00"}',
        '{"event_id":"e6","event_type":"purchase","event_timestamp":"2024-01-15T11:00:00"}',
        '{"event_id":"e7","user_id":"u","event_type":"error","event_timestamp":"2024-01-15T11:00:00"}',
        '{"event_id":"e8","user_id":"u","event_type":"view_item","event_timestamp":"2024-01-15T11:00:00Z","price":3}',
    ]
    p = ingest.parse_events(_env(spark, values)).orderBy("offset").collect()
    got = [(r["offset"], r["event_id"], r["reject_reason"], r["price"]) for r in p]
    assert got == [
        (0, "kafka-ecommerce-events-1-0", None, 12.5),  # absent id synthesised; quoted number still a price
        (1, None, None, None),  # explicit null id stays null (silver drops it)
        (2, None, "malformed_json", None),
        (3, None, "malformed_json", None),
        (4, "e5", "empty_user_id", None),
        (5, "e6", "missing_user_id", None),
        (6, "e7", "invalid_event_type", None),
        (7, "e8", None, 3.0),
    ]
    assert p[0]["event_timestamp"] == dt.datetime(2024, 1, 15, 11, 0, 0, 1)
    assert p[0]["processing_timestamp"] == BROKER_TS
    assert ingest.dead_letter(ingest.parse_events(_env(spark, values))).count() == 5
    stats = ingest.ingest_stats(ingest.parse_events(_env(spark, values))).first()
    assert (stats["rows_ok"], stats["rows_failed"]) == (3, 5) and stats["success_rate"] == 0.375


def test_strict_mode_raises(spark):
    with pytest.raises(Exception):
        ingest.parse_events(_env(spark, ["{bad"]), strict=True).collect()


def test_observe_counts_without_second_pass(spark):
    parsed = ingest.parse_events(td.envelope(spark, SF001))
    observed, obs = ingest.observe_ingest(parsed)
    n = observed.where("reject_reason is null").count()
    m = obs.get
    assert m["rows_ok"] == n and m["rows"] == 1100


def test_publish_then_parse_roundtrip(spark):
    b = td.bronze(spark, SF001).where("user_id is not null and event_type != 'error'")
    pub = ingest.publish_envelope(b)
    env = pub.select(
        F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"), "topic",
        F.lit(0).alias("partition"), F.monotonically_increasing_id().alias("offset"),
        F.lit(BROKER_TS).cast("timestamp_ntz").alias("timestamp"),
    )
    parsed = ingest.parse_events(env, processing_time=None)
    assert parsed.where("reject_reason is not null").count() == 0
    back = ingest.accepted(ingest.parse_events(env, processing_time="broker")).drop("processing_timestamp")
    want = b.drop("processing_timestamp")
    assert back.exceptAll(want).count() == 0 and want.exceptAll(back).count() == 0


def test_offsets_trailing_text_and_unreadable_values(spark):
    base = '"event_id":"e","user_id":"u","event_type":"page_view","event_timestamp":'
    values = [
        '{%s"2024-01-01T10:00:00-03:00"}' % base,
        '{%s"2024-01-01T10:00:00"} trailing' % base,
        '{%s"2024-01-01T10:00:00"} {"a":1}' % base,
        '{%s"yesterday"}' % base,
        '{%s"2024-01-01T10:00:00","price":"ten"}' % base,
    ]
    rows = [(b"u", v.encode(), "t", 0, i) for i, v in enumerate(values)]
    env = spark.createDataFrame(rows, "key binary, value binary, topic string, partition int, offset long")
    env = env.withColumn("timestamp", F.lit(BROKER_TS).cast("timestamp_ntz"))
    got = {r["offset"]: r for r in ingest.parse_events(env).collect()}
    assert str(got[0]["event_timestamp"]) == "2024-01-01 13:00:00" and got[0]["reject_reason"] is None
    reasons = [got[i]["reject_reason"] for i in range(1, 5)]
    assert reasons == ["malformed_json", "malformed_json", "invalid_event_timestamp", "invalid_price"]


def test_json_is_decoded_once_a_record(spark, tmp_dir):
    path = os.path.join(tmp_dir, "envelope")  # stored, so the JSON calls that make the fixture are not in the plan
    td.envelope(spark, SF001).write.parquet(path)
    parsed = ingest.parse_events(spark.read.parquet(path))
    for df in (parsed, ingest.accepted(parsed), ingest.dead_letter(parsed), ingest.missing_required(parsed)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        json_calls = re.findall(r"\b(?:from_?json|json_?\w+|get_?json_?\w+|parse_?json|try_parse_json|variant_get)\(", plan, re.IGNORECASE)
        assert [c.lower() for c in json_calls] == ["from_json("], plan


def test_no_parse_method_is_too_large_to_compile(spark, tmp_dir):
    """The JVM compiles no method of more than 8,000 bytes; one that stays interpreted takes several times as long."""
    path = os.path.join(tmp_dir, "envelope")
    values = ['{"user_id":"u1","event_type":"purchase","event_timestamp":"2024-01-15T11:00:00","price":"12.5"}', "{bad"]
    _env(spark, values).write.parquet(path)
    env = spark.read.parquet(path)
    parsed = ingest.parse_events(env)
    takes = [ingest.accepted, ingest.dead_letter, ingest.missing_required, ingest.event_ids, lambda p: p.select("user_id")]
    for df in (parsed, ingest.parse_events(env, strict=True), *(f(parsed) for f in takes)):
        text = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "codegen")
        sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]
        assert sizes and max(sizes) <= 8000, sizes
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("map_keys(_record") == 1, plan  # not once for each field that is looked up


def test_keys_of_any_order_number_and_repeat_find_their_fields(spark):
    """Every field by its own key: keys shuffled, left out, null, unknown and repeated (the last one counts)."""
    names = [c for c in BRONZE_COLUMNS if c != "processing_timestamp"]
    texts, wants = [], []
    for i in range(60):
        rng = random.Random(i)
        pairs = [(c, rng.choice([None, f"{c} {i}", ""])) for c in rng.sample(names, rng.randint(0, len(names)))]
        pairs += [(c, f"again {i}") for c, _ in rng.sample(pairs, len(pairs) // 3)] + [("other", "x"), ("", "y")]
        pairs = rng.sample(pairs, len(pairs))
        texts.append("{" + ",".join(f"{json.dumps(c)}:{json.dumps(v)}" for c, v in pairs) + "}")
        wants.append(dict(pairs))
    got = ingest.parse_events(_env(spark, texts)).orderBy("offset").collect()
    for i, (row, want) in enumerate(zip(got, wants, strict=True)):
        for c in names:
            if c not in ("event_id", "event_timestamp", "price"):
                assert row[c] == want.get(c), (i, c)
        assert row["event_id"] == want.get("event_id", f"kafka-ecommerce-events-1-{i}")
        assert row["event_timestamp"] is None and row["price"] is None
        missing = [c for c in ("user_id", "event_type", "event_timestamp") if c not in want]
        assert row["reject_reason"] == (f"missing_{missing[0]}" if missing else "invalid_event_type")


def test_only_whole_objects_are_decoded(spark):
    """Against Python's own decoder, on text after a value, repeated keys, nested values and marks inside the text."""
    base = '{"event_id":"e","user_id":"u","event_type":"purchase","event_timestamp":"2024-01-01T10:00:00"'
    good = [
        base + "}", "  " + base + "} ", base + ',"price":"1.5"}', base + ',"price":2.25}', base + ',"price":null}',
        base + ',"user_id":"last"}', base + ',"brand":{"a":[1,2]}}', base + ',"brand":"] , }"}', base + ',"page_url":"\\u00e9\\n"}',
        base.replace('"e"', "null") + "}", base.replace('"event_id":"e",', "") + "}",
    ]
    bad = ["", "5", '"x"', "null", "[]", "[" + base + "}]", base, base + "}}", base + "} x", base + "}] z", base + "},{}", base + "} {}",
           "{'a':1}", base + "},{}] junk"]
    rows = [(b"u", v.encode(), "t", 0, i) for i, v in enumerate(good + bad)]
    env = spark.createDataFrame(rows, "key binary, value binary, topic string, partition int, offset long")
    env = env.withColumn("timestamp", F.lit(BROKER_TS).cast("timestamp_ntz"))
    got = {r["offset"]: r for r in ingest.parse_events(env).collect()}
    for i, text in enumerate(good):
        want = json.loads(text)
        assert got[i]["reject_reason"] is None, text
        assert got[i]["user_id"] == want["user_id"] and got[i]["event_id"] == want.get("event_id", f"kafka-t-0-{i}")
        assert got[i]["price"] == (float(want["price"]) if want.get("price") else None)
        brand = want.get("brand")
        assert got[i]["brand"] == (json.dumps(brand, separators=(",", ":")) if isinstance(brand, dict) else brand)
        assert got[i]["page_url"] == want.get("page_url")
    assert [got[len(good) + k]["reject_reason"] for k in range(len(bad))] == ["malformed_json"] * len(bad)
    assert all(got[len(good) + k]["user_id"] is None for k in range(len(bad)))


def test_publish_writes_keyed_records(spark, tmp_dir, monkeypatch):
    """The sink gets the options of the topic; a Parquet sink shows the records that a batch and a stream write."""
    seen = {}
    real = type(spark.range(1).write).options

    def options(self, **kw):
        seen.update(kw)
        return real(self, **kw)

    monkeypatch.setattr(type(spark.range(1).write), "options", options)
    bronze = td.bronze(spark, SF001)
    out = os.path.join(tmp_dir, "topic")
    ingest.publish(bronze, "broker:9092", "events", sink="parquet", options={"path": out, "kafka.linger.ms": "50"})
    want = {**ingest.kafka_producer_options("broker:9092", "events"), "path": out, "kafka.linger.ms": "50"}
    assert seen == want and want["kafka.acks"] == "all" and want["topic"] == "events"
    records = spark.read.parquet(out)
    expected = ingest.publish_envelope(bronze, "events")
    assert records.columns == ["key", "value", "topic"]
    assert records.exceptAll(expected).count() == 0 and expected.exceptAll(records).count() == 0

    source, stream_out = os.path.join(tmp_dir, "source"), os.path.join(tmp_dir, "stream_topic")
    bronze.write.parquet(source)
    for _ in range(2):  # the second run finds nothing new
        stream = spark.readStream.schema(bronze.schema).parquet(source)
        q = ingest.publish_stream(stream, "broker:9092", os.path.join(tmp_dir, "ckpt"), "events", sink="parquet",
                                  options={"path": stream_out})
        q.awaitTermination(300)
    records = spark.read.parquet(stream_out)
    assert records.exceptAll(expected).count() == 0 and expected.exceptAll(records).count() == 0


def test_envelope_of_the_fixture_holds_every_defect(spark):
    parsed = ingest.parse_events(td.envelope(spark, SF01))
    counts = {r["reject_reason"]: r["count"] for r in parsed.groupBy("reject_reason").count().collect()}
    assert all(counts.get(reason, 0) > 0 for reason in (
        None, "malformed_json", "missing_user_id", "missing_event_type", "missing_event_timestamp",
        "invalid_event_type", "empty_user_id", "invalid_event_timestamp", "invalid_price",
    )), counts


def test_freshness_opens_old_partitions_only_without_recent_events(spark, tmp_dir):
    rows = [("new", "2024-01-15 11:50:00"), ("old", "2024-01-10 00:00:00")]
    b = spark.createDataFrame(rows, "event_id string, t string").select(
        "event_id", F.col("t").cast("timestamp_ntz").alias("event_timestamp")
    )
    path = os.path.join(tmp_dir, "bronze")
    write_bronze(b.unionByName(td.bronze(spark, SF001).limit(0), allowMissingColumns=True), path)
    at = "2024-01-15 12:00:00"
    late = monitoring.bronze_freshness(read_bronze(spark, path), "2024-01-20 12:00:00").first()
    assert str(late["last_event"]) == "2024-01-15 11:50:00" and late["is_stale"] and late["events_last_hour"] == 0
    # an unreadable file in an old partition shows whether it is opened
    with open(os.path.join(path, "event_date=2024-01-10", "part-bad.parquet"), "wb") as f:
        f.write(b"no parquet")
    got = monitoring.bronze_freshness(read_bronze(spark, path), at).first()
    assert str(got["last_event"]) == "2024-01-15 11:50:00" and got["events_last_hour"] == 1 and not got["is_stale"]
    with pytest.raises(Exception):
        monitoring.bronze_freshness(read_bronze(spark, path), "2024-01-20 12:00:00").collect()
    for df in (monitoring.bronze_health(read_bronze(spark, path), at), monitoring.new_data_since(read_bronze(spark, path), None, at)):
        assert "PartitionFilters: [isnotnull(event_date" in df._jdf.queryExecution().executedPlan().toString()
        assert df.first() is not None


def test_kafka_options():
    o = kafka_source_options("broker:9092", max_offsets_per_trigger=1000)
    assert o["subscribe"] == "ecommerce-events" and o["startingOffsets"] == "latest"
    assert o["failOnDataLoss"] == "true"
    assert o["maxOffsetsPerTrigger"] == "1000" and o["kafka.isolation.level"] == "read_uncommitted"
    p = ingest.kafka_producer_options("broker:9092")
    assert p["kafka.acks"] == "all" and p["kafka.compression.type"] == "snappy"


def test_seed_ragged_row_goes_to_rejects(spark, tmp_dir):
    path = os.path.join(tmp_dir, "dim_products.csv")
    with open(path, "w") as f:
        f.write("product_id,category_id,category_name,brand,price,currency,is_active,created_at,updated_at\n")
        f.write("prod_0001,cat_1,Cat 1,B,10.5,BRL,true,2024-01-01 00:00:00,2024-01-01 00:00:00\n")
        f.write("prod_0002,cat_1,Cat 1,B,11.0,BRL,false,2024-01-01 00:00:00,2024-01-01 00:00:00\n")
        f.write("prod_0027,cat_6,Cat 6,B,1,200.0,BRL,true,2024-01-01 00:00:00,2024-01-01 00:00:00\n")
    rows, rejects = seeds.load_products(spark, path)
    assert sorted(r["product_id"] for r in rows.collect()) == ["prod_0001", "prod_0002"]
    assert [r["raw_line"].split(",")[0] for r in rejects.collect()] == ["prod_0027"]
    assert dict(rows.dtypes)["price"] == "double" and dict(rows.dtypes)["created_at"] == "timestamp_ntz"


def test_bronze_roundtrip_and_partition_pruning(spark, tmp_dir):
    path = os.path.join(tmp_dir, "bronze")
    b = td.bronze(spark, SF001)
    write_bronze(b, path)
    back = read_bronze(spark, path)
    assert back.count() == 1100
    q = back.where(F.col("event_date") == F.lit("2024-01-15").cast("date"))
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "event_date" in plan
    assert q.count() == b.where(F.to_date("event_timestamp") == F.lit("2024-01-15").cast("date")).count()
