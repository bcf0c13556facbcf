import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from cartwheel.operators import gold, ingest, silver
from cartwheel.plans import pipeline, tables
from cartwheel.quality import checks as C
from cartwheel.quality import contracts as K
from cartwheel.schemas import BRONZE_COLUMNS
from cartwheel.sources import testdata as td
from cartwheel.sources.bronze import read_bronze, write_bronze
from cartwheel.sources.kafka import read_envelope_stream
from cartwheel.streaming import aggregates as SA
from cartwheel.streaming import ingest as SI

from helpers import SF001, SF01, events

SENTINEL_TS = dt.datetime(2030, 1, 1)


def _write_files(df, path, n=3):
    df.repartition(n).write.mode("overwrite").parquet(path)


def _run_available_now(df, name, checkpoint, mode="append"):
    q = (
        df.writeStream.format("memory").queryName(name).outputMode(mode)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    q.awaitTermination(300)
    return q


def test_stream_ingest_equals_batch_and_is_replay_safe(spark, tmp_dir):
    env = td.envelope(spark, SF001)
    src = os.path.join(tmp_dir, "envelope")
    _write_files(env, src, n=4)
    bronze_path, dl_path, ckpt = (os.path.join(tmp_dir, p) for p in ("bronze", "dead", "ckpt"))
    listener = SI.attach_metrics(spark)
    stream = read_envelope_stream(spark, src, max_files_per_trigger=1)
    q = SI.start_bronze_ingest(stream, bronze_path, dl_path, ckpt, trigger={"availableNow": True},
                               processing_time=None)
    q.awaitTermination(300)
    got = read_bronze(spark, bronze_path, batch_partitions=True)
    want = ingest.accepted(ingest.parse_events(env, processing_time=None))
    cols = [c for c in BRONZE_COLUMNS if c != "processing_timestamp"]
    assert got.select(*cols).exceptAll(want.select(*cols)).count() == 0
    assert want.select(*cols).exceptAll(got.select(*cols)).count() == 0
    assert got.select("ingest_batch").distinct().count() == 4
    dead = spark.read.parquet(dl_path)
    assert dead.count() == ingest.dead_letter(ingest.parse_events(env)).count()
    # restart on the same checkpoint: nothing is re-ingested
    q2 = SI.start_bronze_ingest(read_envelope_stream(spark, src), bronze_path, dl_path, ckpt,
                                trigger={"availableNow": True})
    q2.awaitTermination(300)
    assert read_bronze(spark, bronze_path).count() == got.count()
    time.sleep(2)  # listener events are delivered asynchronously
    stats = listener.stats()
    spark.streams.removeListener(listener)
    assert stats["rows_inserted"] + stats["rows_failed"] in (0, 1100)  # all-or-nothing delivery of progress events


def _enriched_files(spark, tmp_dir, sf=SF001):
    enr = silver.silver_and_enriched(td.bronze(spark, sf), td.products(spark, sf))
    path = os.path.join(tmp_dir, "enriched")
    # one data file, then the sentinel in a later file: no data row is behind the watermark of its batch
    _write_files(enr, path, n=1)
    time.sleep(1.1)
    sentinel = spark.createDataFrame(
        [("sentinel", "u_sentinel", "purchase", SENTINEL_TS, "p_sentinel", 1.0)],
        "event_id string, user_id string, event_type string, event_timestamp timestamp_ntz, product_id string, price double",
    )
    full = enr.unionByName(sentinel, allowMissingColumns=True)
    sentinel_only = full.where(F.col("event_id") == "sentinel")
    sentinel_only.write.mode("append").parquet(path)
    return enr, path, full.schema


def test_streaming_aggregates_match_batch(spark, tmp_dir):
    enr, path, schema = _enriched_files(spark, tmp_dir)
    # file order = partition files first, sentinel last (maxFilesPerTrigger=1 keeps them in separate batches)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)

    _run_available_now(SA.minute_revenue_stream(stream), "minute_rev", os.path.join(tmp_dir, "c1"))
    got = spark.table("minute_rev").where(F.year("window_start") < 2030).select(
        F.col("window_start").cast("timestamp_ntz"), "revenue", "orders_count"
    )
    want = gold.minute_revenue(enr).select("window_start", "revenue", "orders_count")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0

    _run_available_now(SA.cart_outcomes_stream(stream), "cart_out", os.path.join(tmp_dir, "c2"))
    got = spark.table("cart_out").select("event_id", "n_purchases", F.col("first_purchase_at").cast("timestamp_ntz"))
    want = gold.cart_purchase_matches(enr).select("event_id", "n_purchases", "first_purchase_at")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0

    _run_available_now(SA.session_stream(stream), "sess", os.path.join(tmp_dir, "c3"))
    got = spark.table("sess").where("user_id != 'u_sentinel'").select(
        "user_id", F.col("session_start").cast("timestamp_ntz"), "events"
    )
    from cartwheel.operators import sessions

    want = sessions.sessions(sessions.sessionize(enr)).select("user_id", "session_start", "events")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_cart_outcomes_by_stream_join(spark, tmp_dir):
    enr = silver.silver_and_enriched(td.bronze(spark, SF001), td.products(spark, SF001))
    path = os.path.join(tmp_dir, "enriched")
    # files in order of event time, as a stream delivers them; the last one is far ahead and drains all state
    week = F.date_diff(F.to_date("event_timestamp"), F.lit("2024-01-01").cast("date")).cast("int") / 7
    enr = enr.withColumn("_week", F.floor(week)).checkpoint()
    weeks = sorted(r[0] for r in enr.select("_week").distinct().collect())
    schema = "event_id string, user_id string, event_type string, event_timestamp timestamp_ntz, product_id string, price double"
    for k, ahead in enumerate((0, 1)):
        sentinel = [(f"sentinel{k}", "u_sentinel", "purchase", SENTINEL_TS + dt.timedelta(days=90 * ahead), "p_sentinel", 1.0)]
        rows = spark.createDataFrame(sentinel, schema)
        if not k:
            for w in weeks:
                enr.where(F.col("_week") == w).coalesce(1).write.mode("append").parquet(path)
                time.sleep(1.1)
        enr.limit(0).unionByName(rows, allowMissingColumns=True).write.mode("append").parquet(path)
        time.sleep(1.1)
    stream = spark.readStream.schema(enr.schema).option("maxFilesPerTrigger", 1).parquet(path)
    outcomes = SA.cart_outcomes_join_stream(stream)
    plan = outcomes._jdf.queryExecution().analyzed().toString()
    assert "LeftOuter" in plan and "Python" not in plan and "InPandas" not in plan
    q = _run_available_now(outcomes, "cart_join", os.path.join(tmp_dir, "ckpt"))
    got = spark.table("cart_join").select("event_id", "n_purchases", F.col("first_purchase_at").cast("timestamp_ntz"))
    want = gold.cart_purchase_matches(enr).select("event_id", "n_purchases", "first_purchase_at")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0 and got.count() > 0
    # state is evicted: at the end of a batch it holds no more than that week's carts and purchases, in the join and the
    # aggregate, and next to none after the drain
    held = [sum(o["numRowsTotal"] for o in p["stateOperators"]) for p in q.recentProgress if p["stateOperators"]]
    rows = enr.where("event_type in ('add_to_cart', 'purchase')")
    weekly = [r["count"] for r in rows.groupBy("_week").count().collect()]
    assert len(weekly) >= 4 and max(held) <= 3 * max(weekly) and held[-1] <= 4, (held, weekly)


def test_late_and_duplicate_events(spark, tmp_dir):
    base = dt.datetime(2024, 1, 15, 12, 0)
    schema = "event_id string, user_id string, event_type string, event_timestamp timestamp_ntz, price double"
    path = os.path.join(tmp_dir, "late")
    batches = [
        [("e1", "u", "purchase", base, 10.0)],
        [("e1", "u", "purchase", base + dt.timedelta(minutes=1), 11.0),  # duplicate id within the delay: dropped
         ("e2", "u", "purchase", base + dt.timedelta(hours=2), 5.0)],  # moves the watermark to 13:30
        [("e3", "u", "purchase", base + dt.timedelta(minutes=5), 7.0)],  # behind the watermark
        [("zz", "u", "purchase", SENTINEL_TS, 1.0)],
    ]
    for i, b in enumerate(batches):
        spark.createDataFrame(b, schema).coalesce(1).write.mode("append").parquet(os.path.join(path, f"b{i}"))
        time.sleep(1.1)  # the file source takes files in modification-time order
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(path)
    _run_available_now(SA.dedup_within_watermark(stream), "dedup", os.path.join(tmp_dir, "c1"))
    # the dedup operator only removes repeats; dropping late rows is the job of the windowed aggregate below
    assert sorted(r[0] for r in spark.table("dedup").select("event_id").collect()) == ["e1", "e2", "e3", "zz"]
    assert spark.table("dedup").where("event_id = 'e1'").first()["price"] == 10.0  # first delivery kept
    _run_available_now(SA.minute_revenue_stream(stream), "late_rev", os.path.join(tmp_dir, "c2"))
    revs = {r["window_start"].hour * 60 + r["window_start"].minute: r["revenue"]
            for r in spark.table("late_rev").where(F.year("window_start") < 2030).collect()}
    # Spark guarantees that data within the delay is aggregated; a row behind the watermark "may" be dropped
    expected = {12 * 60: 10.0, 12 * 60 + 1: 11.0, 14 * 60: 5.0}
    assert {k: revs.get(k) for k in expected} == expected and set(revs) <= set(expected) | {12 * 60 + 5}


# --------------------------------------------------------------------------------------------------------
# incremental pipeline
# --------------------------------------------------------------------------------------------------------
def test_incremental_transform_matches_batch_and_is_idempotent(spark, tmp_dir):
    bronze_path = os.path.join(tmp_dir, "bronze")
    write_bronze(td.bronze(spark, SF01), bronze_path)
    wh = pipeline.Warehouse(os.path.join(tmp_dir, "wh"))
    products = silver.stg_products(td.products(spark, SF01))
    runs = ["2024-01-15 12:00:00", "2024-01-15 13:00:00", "2024-01-16 00:30:00"]
    for i, r in enumerate(runs):
        out = pipeline.run_transform(spark, bronze_path, wh, r, f"run-{i}", products=products, gate_suite=K.T)
        assert out["gate"] == "pass"
    stg = spark.read.parquet(wh.path("stg_clickstream"))
    first = stg.select("event_id", "processing_timestamp", "price")
    # the same rows as the batch silver of the covered windows
    b = read_bronze(spark, bronze_path)
    covered = None
    for r in runs:
        s = silver.lookback_window(b, r)
        covered = s if covered is None else covered.unionByName(s)
    want = silver.stg_clickstream(covered.drop("event_date")).select("event_id", "processing_timestamp", "price")
    assert first.exceptAll(want).count() == 0 and want.exceptAll(first).count() == 0
    # rerunning a window changes nothing
    pipeline.run_transform(spark, bronze_path, wh, runs[0], "rerun", products=products, gate_suite=K.T)
    again = spark.read.parquet(wh.path("stg_clickstream")).select("event_id", "processing_timestamp", "price")
    assert again.exceptAll(want).count() == 0 and want.exceptAll(again).count() == 0
    rev = spark.read.parquet(wh.path("fct_daily_revenue"))
    enr = silver.enrich_with_products(silver.stg_clickstream(covered.drop("event_date")), products)
    want_rev = gold.fct_daily_revenue(enr, audit=False).select("revenue_date", "gross_revenue", "orders_count")
    got_rev = rev.select("revenue_date", "gross_revenue", "orders_count")
    assert got_rev.exceptAll(want_rev).count() == 0 and want_rev.exceptAll(got_rev).count() == 0


def _equal(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _event(eid, kind, at, processed=None, **kw):
    return dict(event_id=eid, user_id="u", session_id="s", event_type=kind, event_timestamp=at,
                processing_timestamp=processed or at, product_id="p", category_id="c", category_name="C", price=5.0) | kw


def test_transform_over_dates_with_a_gap_equals_batch(spark, tmp_dir):
    """A late event of day 1 and one of day 3 come in one run: day 2 must be read, for the carts of day 1."""
    t = dt.datetime(2024, 1, 1, 20)
    h = dt.timedelta(hours=1)
    first = [_event("cart1", "add_to_cart", t), _event("buy2", "purchase", t + 20 * h), _event("cart2", "add_to_cart", t + 21 * h),
             _event("buy3", "purchase", t + 40 * h), _event("cart0", "add_to_cart", t - 22 * h)]
    second = [_event("late1", "purchase", t + 1 * h), _event("late3", "purchase", t + 41 * h)]
    products = silver.stg_products(td.products(spark, SF001))
    wh = pipeline.Warehouse(os.path.join(tmp_dir, "wh"))
    for k, rows in enumerate((first, second)):
        path = os.path.join(tmp_dir, f"bronze{k}")
        write_bronze(events(spark, rows), path)
        out = pipeline.run_transform(spark, path, wh, "2024-01-05 00:00:00", f"r{k}", products=products, gate_suite=K.T,
                                     lookback_start="200 hours")
    assert out["touched_dates"] == [dt.date(2024, 1, 1), dt.date(2024, 1, 3)]
    assert out["gold_dates"] == [dt.date(2023, 12, 31), dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)]
    enriched = silver.enrich_with_products(silver.stg_clickstream(events(spark, first + second)), products)
    for name in ("fct_daily_revenue", "fct_conversion_funnel", "fct_cart_abandonment"):
        want = getattr(gold, name)(enriched, audit=False)
        assert _equal(spark.read.parquet(wh.path(name)).select(*want.columns), want), name


def test_an_invalid_newest_copy_drops_its_event(spark, tmp_dir):
    t = dt.datetime(2024, 1, 1, 12)
    old = [_event("a", "purchase", t), _event("b", "purchase", t)]
    new = [_event("a", "purchase", t, t + dt.timedelta(hours=1), user_id=None)]  # newest copy without a user
    products = silver.stg_products(td.products(spark, SF001))
    wh = pipeline.Warehouse(os.path.join(tmp_dir, "wh"))
    path = os.path.join(tmp_dir, "bronze")
    for k, rows in enumerate((old, new)):
        write_bronze(events(spark, rows), path)
        pipeline.run_transform(spark, path, wh, "2024-01-01 13:00:00", f"r{k}", products=products, gate_suite=K.T)
    pipeline.run_transform(spark, path, wh, "2024-01-01 13:00:00", "again", products=products, gate_suite=K.T)
    want = silver.stg_clickstream(events(spark, old + new)).select("event_id")
    assert [r[0] for r in want.collect()] == ["b"]
    assert _equal(spark.read.parquet(wh.path("stg_clickstream")).select("event_id"), want)
    # the last valid event of a day goes: so does the day
    write_bronze(events(spark, [_event("b", "none", t, t + dt.timedelta(hours=2))]), path)
    pipeline.run_transform(spark, path, wh, "2024-01-01 13:00:00", "last", products=products, gate_suite=K.T)
    assert spark.read.schema("event_id string").parquet(wh.path("stg_clickstream")).count() == 0
    assert spark.read.schema("gross_revenue double").parquet(wh.path("fct_daily_revenue")).count() == 0


def test_a_hot_user_and_type_fills_several_files(spark, tmp_dir):
    t = dt.datetime(2024, 1, 1, 12)
    hot = spark.range(40_000).select(
        F.concat(F.lit("e"), "id").alias("event_id"), F.lit("u").alias("user_id"), F.lit("page_view").alias("event_type"),
        F.lit(t).cast("timestamp_ntz").alias("event_timestamp"), F.lit(t.date()).alias("event_date"),
    )
    path = os.path.join(tmp_dir, "hot")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tables.materialize(hot, "hot_table", path=path, partition_by="event_date", cluster_by=("user_id", "event_type"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    per_file = [r["count"] for r in spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()]
    assert len(per_file) >= 6 and max(per_file) <= 2 * 40_000 / len(per_file) and sum(per_file) == 40_000


def test_adjacent_hours_keep_both_slices_on_a_uri_root(spark, tmp_dir):
    bronze_path = os.path.join(tmp_dir, "bronze")
    write_bronze(td.bronze(spark, SF01), bronze_path)
    wh = pipeline.Warehouse("file://" + os.path.join(tmp_dir, "wh"))
    products = silver.stg_products(td.products(spark, SF01))
    runs = ["2024-01-15 11:00:00", "2024-01-15 12:00:00"]
    for i, r in enumerate(runs):
        pipeline.run_transform(spark, bronze_path, wh, r, f"run-{i}", products=products, gate_suite=K.T)
    b = read_bronze(spark, bronze_path)
    covered = silver.lookback_window(b, runs[0]).unionByName(silver.lookback_window(b, runs[1]))
    want = silver.stg_clickstream(covered.drop("event_date")).select("event_id")
    got = spark.read.parquet(wh.path("stg_clickstream")).select("event_id")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert wh.exists(spark, "int_enriched_clickstream")
    wh.drop_partition(spark, "stg_clickstream", "event_date", "2024-01-15")
    assert not wh.exists(spark, "stg_clickstream/event_date=2024-01-15")


def test_gate_blocks_gold(spark, tmp_dir):
    bronze_path = os.path.join(tmp_dir, "bronze")
    write_bronze(td.bronze(spark, SF001), bronze_path)
    wh = pipeline.Warehouse(os.path.join(tmp_dir, "wh"))
    products = silver.stg_products(td.products(spark, SF001))
    # the runtime suite asks for more than 100 rows per slice: an hourly slice of sf0.001 fails it
    with pytest.raises(C.ContractFailure):
        pipeline.run_transform(spark, bronze_path, wh, "2024-01-15 12:00:00", "r", products=products,
                               lookback_start="3 hours")
    assert not wh.exists(spark, "fct_daily_revenue")


def test_run_all_seed_transform_scan_monitoring(spark, tmp_dir):
    bronze_path = os.path.join(tmp_dir, "bronze")
    write_bronze(td.bronze(spark, SF001), bronze_path)
    seed = os.path.join(tmp_dir, "seed")
    (td.products(spark, SF001).coalesce(1).write.option("header", "true")
     .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(seed))
    wh = pipeline.Warehouse(os.path.join(tmp_dir, "wh"))
    out = pipeline.run_all(spark, seed, bronze_path, wh, "2024-01-15 12:00:00", "run-all", gate_suite=K.T)
    assert out["gate"] == "pass" and out["seed_rejects"] == 0
    assert {r["table_name"] for r in out["scan"]} >= {"stg_clickstream", "stg_products", "fct_daily_revenue"}
    assert out["scan_outcome"] in ("warn", "fail")  # an hourly slice is below the volume contract
    assert out["monitoring"]["health"][0]["events_last_hour"] >= 0
