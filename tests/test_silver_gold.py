import datetime as dt

from pyspark.sql import functions as F

from cartwheel.operators import gold, silver
from cartwheel.sources import testdata as td
from helpers import SF001, SF01, T0, events, rows, ts



def _cart(eid, user, prod, at, price=10.0, cat="c1", name="Cat 1"):
    return dict(event_id=eid, user_id=user, session_id="s", event_type="add_to_cart", event_timestamp=at,
                processing_timestamp=at, product_id=prod, category_id=cat, category_name=name, price=price)


def _purchase(eid, user, prod, at, price=10.0):
    return dict(event_id=eid, user_id=user, session_id="s", event_type="purchase", event_timestamp=at,
                processing_timestamp=at, product_id=prod, price=price)


# --------------------------------------------------------------------------------------------------------
# dedup / validation / lookback
# --------------------------------------------------------------------------------------------------------
def test_dup_events_latest_wins_and_ties_are_deterministic(spark):
    df = events(spark, [
        dict(event_id="e1", user_id="u", event_type="purchase", event_timestamp=ts(0), processing_timestamp=ts(1), price=1.0),
        dict(event_id="e1", user_id="u", event_type="purchase", event_timestamp=ts(0), processing_timestamp=ts(5), price=2.0),
        dict(event_id="e1", user_id="u", event_type="purchase", event_timestamp=ts(0), processing_timestamp=ts(5), price=3.0),
    ])
    first = rows(silver.dedup_latest(df), "price")
    again = rows(silver.dedup_latest(df.orderBy(F.desc("price"))), "price")
    assert len(first) == 1 and first[0][0] in (2.0, 3.0)
    assert first == again


def test_dup_latest_invalid_drops_event(spark):
    df = events(spark, [
        dict(event_id="e1", user_id="u", event_type="purchase", event_timestamp=ts(0), processing_timestamp=ts(1)),
        dict(event_id="e1", user_id=None, event_type="purchase", event_timestamp=ts(0), processing_timestamp=ts(2)),
        dict(event_id="e2", user_id="u", event_type="purchase", event_timestamp=ts(0), processing_timestamp=ts(2)),
    ])
    assert rows(silver.stg_clickstream(df), "event_id") == [("e2",)]


def test_null_ids_dropped(spark):
    df = events(spark, [
        dict(event_id=None, user_id="u", event_type="purchase", event_timestamp=ts(0), processing_timestamp=ts(1)),
        dict(event_id=None, user_id="v", event_type="page_view", event_timestamp=ts(0), processing_timestamp=ts(2)),
    ])
    assert silver.stg_clickstream(df).count() == 0


def test_lookback_edges_half_open(spark):
    run = T0
    df = events(spark, [
        dict(event_id="a", event_timestamp=ts(-90)),
        dict(event_id="b", event_timestamp=ts(-90, micros=-1)),
        dict(event_id="c", event_timestamp=ts(-30)),
        dict(event_id="d", event_timestamp=ts(-30, micros=-1)),
    ])
    assert rows(silver.lookback_window(df, run), "event_id") == [("a",), ("d",)]


def test_lookback_tiles(spark):
    b = td.bronze(spark, SF01)
    r1 = silver.lookback_window(b, "2024-01-15 12:00:00").select("event_id", "processing_timestamp")
    r2 = silver.lookback_window(b, "2024-01-15 13:00:00").select("event_id", "processing_timestamp")
    both = silver.lookback_window(b, "2024-01-15 13:00:00", start="2 hours 30 minutes")
    assert r1.intersect(r2).count() == 0
    assert r1.count() + r2.count() == both.count()


def test_lookback_macro_variable_wins(spark):
    df = events(spark, [dict(event_id="a", event_timestamp=ts(-150)), dict(event_id="b", event_timestamp=ts(-100))])
    assert silver.lookback_macro_window(df, T0).count() == 1
    assert silver.lookback_macro_window(df, T0, lookback_hours=3).count() == 2


def test_dedup_is_idempotent_and_order_independent(spark):
    b = silver.typed_projection(td.bronze(spark, SF001))
    once = silver.dedup_latest(b)
    twice = silver.dedup_latest(once)
    shuffled = silver.dedup_latest(b.repartition(7, "price"))
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0
    assert once.exceptAll(shuffled).count() == 0


def test_enrichment_event_value_wins(spark):
    ev = events(spark, [
        dict(event_id="e1", user_id="u", event_type="view_item", event_timestamp=ts(0), product_id="p1", price=5.0),
        dict(event_id="e2", user_id="u", event_type="view_item", event_timestamp=ts(0), product_id="p1"),
        dict(event_id="e3", user_id="u", event_type="page_view", event_timestamp=ts(0)),
    ])
    prods = spark.createDataFrame(
        [("p1", "cat", "Cat", "B", 9.0, "USD", True, T0, T0)],
        "product_id string, category_id string, category_name string, brand string, price double, currency string, "
        "is_active boolean, created_at timestamp_ntz, updated_at timestamp_ntz",
    )
    for max_bytes in (1 << 20, 100, 0):  # broadcast path and sort-merge path
        out = silver.enrich_with_products(ev, prods, broadcast_max_bytes=max_bytes)
        assert rows(out, "event_id", "price", "category_id") == [("e1", 5.0, "cat"), ("e2", 9.0, "cat"), ("e3", None, None)]


# --------------------------------------------------------------------------------------------------------
# cart / purchase interval match
# --------------------------------------------------------------------------------------------------------
def test_interval_edges(spark):
    c = T0
    df = events(spark, [
        _cart("c1", "u", "p", c),
        _purchase("p0", "u", "p", c - dt.timedelta(microseconds=1)),  # before cart: out
        _purchase("p1", "u", "p", c),  # at cart time: in
        _purchase("p2", "u", "p", c + dt.timedelta(hours=24, microseconds=-1)),  # in
        _purchase("p3", "u", "p", c + dt.timedelta(hours=24)),  # out
    ])
    m = gold.cart_purchase_matches(df)
    assert rows(m, "event_id", "n_purchases", "first_purchase_at") == [("c1", 2, c)]
    # the answer does not depend on the bucket width
    for b in ("1 hour", "7 hours", "3 days"):
        assert rows(gold.cart_purchase_matches(df, bucket=b), "event_id", "n_purchases") == [("c1", 2)]


def test_multi_match_literal_and_first_only(spark):
    df = events(spark, [
        _cart("c1", "u", "p", ts(0)),
        _purchase("p1", "u", "p", ts(10)),
        _purchase("p2", "u", "p", ts(20)),
    ])
    lit = gold.fct_cart_abandonment(df, audit=False)
    first = gold.fct_cart_abandonment(df, audit=False, first_only=True)
    assert rows(lit, "cart_additions", "completed_purchases", "abandoned_carts", "revenue_lost") == [(1, 2, -1, -10.0)]
    assert rows(first, "cart_additions", "completed_purchases", "abandoned_carts", "revenue_lost") == [(1, 1, 0, 0.0)]


def test_two_names_repeat_purchases(spark):
    df = events(spark, [
        _cart("c1", "u", "p", ts(0), name="A"),
        _cart("c2", "v", "q", ts(0), name="B"),
        _purchase("p1", "u", "p", ts(5)),
    ])
    out = rows(gold.fct_cart_abandonment(df, audit=False), "category_name", "cart_additions", "completed_purchases")
    assert out == [("A", 1, 1), ("B", 1, 1)]


def test_null_prices(spark):
    df = events(spark, [_cart("c1", "u", "p", ts(0), price=None), _cart("c2", "v", "p", ts(0), price=None)])
    out = rows(gold.fct_cart_abandonment(df, audit=False), "cart_value", "revenue_lost", "abandonment_rate")
    assert out == [(None, None, 100.0)]


def test_empty_steps_zero_counts_null_rates(spark):
    df = events(spark, [
        dict(event_id="e1", user_id="u", event_type="view_item", event_timestamp=ts(0)),
        dict(event_id="e2", user_id="u", event_type="purchase", event_timestamp=ts(0)),
    ])
    f = gold.fct_conversion_funnel(df, audit=False).first()
    assert f["page_views"] == 0 and f["add_to_carts"] == 0 and f["view_items"] == 1
    assert f["conversion_rate_view"] is None and f["overall_conversion_rate"] is None


def cart_events(enriched):
    """Carts by the plain rule, for brute force."""
    return enriched.where("event_type = 'add_to_cart' and product_id is not null and category_id is not null").select(
        "event_id", "user_id", "product_id", F.col("event_timestamp").alias("cart_at")
    )


def purchase_events(enriched):
    return enriched.where("event_type = 'purchase' and product_id is not null").select(
        "user_id", "product_id", F.col("event_timestamp").alias("purchase_at")
    )


def test_matches_equal_brute_force_join(spark):
    enr = silver.silver_and_enriched(td.bronze(spark, SF01), td.products(spark, SF01))
    carts = cart_events(enr).alias("c")
    purch = purchase_events(enr).alias("p")
    pairs = carts.join(
        purch,
        (F.col("c.user_id") == F.col("p.user_id")) & (F.col("c.product_id") == F.col("p.product_id"))
        & (F.col("p.purchase_at") >= F.col("c.cart_at"))
        & (F.col("p.purchase_at") < F.col("c.cart_at") + F.expr("INTERVAL 24 HOURS")),
        "left",
    ).groupBy("c.event_id").agg(F.count("p.purchase_at").alias("n"), F.min("p.purchase_at").alias("f"))
    got = gold.cart_purchase_matches(enr).select("event_id", "n_purchases", "first_purchase_at")
    assert got.exceptAll(pairs).count() == 0 and pairs.exceptAll(got).count() == 0
    hourly = gold.cart_purchase_matches(enr, bucket="1 hour").select("event_id", "n_purchases", "first_purchase_at")
    assert got.exceptAll(hourly).count() == 0
    daily = gold.cart_purchase_matches(enr, bucket="1 day").select("event_id", "n_purchases", "first_purchase_at")
    assert got.exceptAll(daily).count() == 0 and daily.exceptAll(got).count() == 0


def test_hot_key_split_matches_brute_force(spark):
    # one (user, product) holds most rows, several carts and purchases share instants
    base = T0
    evs = []
    for i in range(60):
        at = base + dt.timedelta(minutes=37 * i)
        evs.append(_cart(f"c{i}", "hot", "p", at))
        if i % 3 == 0:
            evs.append(_purchase(f"p{i}", "hot", "p", at))  # same instant as a cart: counts
        if i % 4 == 0:
            evs.append(_purchase(f"q{i}", "hot", "p", at + dt.timedelta(hours=24)))  # exactly 24 h later: out
        if i % 5 == 0:
            evs.append(_purchase(f"r{i}", "hot", "p", at + dt.timedelta(hours=23, minutes=59)))
    evs.append(_cart("cold", "u", "p", base))
    df = events(spark, evs)
    carts = cart_events(df).alias("c")
    purch = purchase_events(df).alias("p")
    want = carts.join(
        purch,
        (F.col("c.user_id") == F.col("p.user_id")) & (F.col("c.product_id") == F.col("p.product_id"))
        & (F.col("p.purchase_at") >= F.col("c.cart_at"))
        & (F.col("p.purchase_at") < F.col("c.cart_at") + F.expr("INTERVAL 24 HOURS")),
        "left",
    ).groupBy("c.event_id").agg(F.count("p.purchase_at").alias("n"), F.min("p.purchase_at").alias("f"))
    want_rows = rows(want)
    for bucket in ("10 minutes", "30 days", "1 second"):
        got = gold.cart_purchase_matches(df, bucket=bucket)
        assert rows(got, "event_id", "n_purchases", "first_purchase_at") == want_rows, bucket


def test_revenue_distinct_paths_agree(spark):
    enr = silver.silver_and_enriched(td.bronze(spark, SF01), td.products(spark, SF01))
    a = gold.fct_daily_revenue(enr, audit=False)
    b = gold.fct_daily_revenue(enr, audit=False, event_ids_unique=False)
    assert a.exceptAll(b).count() == 0 and a.count() == 30


# --------------------------------------------------------------------------------------------------------
# plan assertions
# --------------------------------------------------------------------------------------------------------
def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plan_shapes(spark):
    b = td.bronze(spark, SF01)
    d = silver.dedup_latest(silver.typed_projection(b))
    assert "WindowGroupLimit" in d._jdf.queryExecution().sparkPlan().toString()
    enr = silver.silver_and_enriched(b, td.products(spark, SF01))
    assert "BroadcastHashJoin" in enr._jdf.queryExecution().sparkPlan().toString()
    rev = gold.fct_daily_revenue(enr, audit=False)
    assert "Expand" not in rev._jdf.queryExecution().sparkPlan().toString()
    for df in (enr, gold.fct_cart_abandonment(enr), gold.fct_conversion_funnel(enr)):
        p = df._jdf.queryExecution().sparkPlan().toString()
        assert "PythonUDF" not in p and "BatchEvalPython" not in p and "ArrowEvalPython" not in p
    scan = b.select("event_id", "event_timestamp")._jdf.queryExecution().sparkPlan().toString()
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in scan


def test_ordered_per_key_plans(spark):
    from cartwheel.operators import sessions

    enr = silver.silver_and_enriched(td.bronze(spark, SF001), td.products(spark, SF001))
    stg = silver.stg_clickstream(td.bronze(spark, SF001))
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "building plans starts no job")
    built = {
        "matches": gold.cart_purchase_matches(enr),
        "abandonment": gold.fct_cart_abandonment(enr),
        "sessions": sessions.sessionize(stg),
        "progress": sessions.session_progress(sessions.sessionize(stg)),
        "consistency": sessions.session_consistency_violations(stg),
    }
    assert len(jobs.getJobIdsForGroup("building")) == 0
    spark.sparkContext.setJobGroup("other", "")
    for df in built.values():
        p = df._jdf.queryExecution().sparkPlan().toString()
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
        assert "PythonUDF" not in p and "ArrowEvalPython" not in p
    # on a stored table: rows and summary dealt by (key, bucket), the summary by key and back by (key, bucket)
    stored = spark.createDataFrame(stg.rdd, stg.schema)
    plan = sessions.sessionize(stored)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 4
    built = gold.cart_purchase_matches(spark.createDataFrame(enr.rdd, enr.schema))
    assert built._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") <= 5
