import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cartwheel.operators import monitoring, sessions, silver
from cartwheel.quality import checks as C
from cartwheel.quality import contracts as K
from cartwheel.quality.anomaly import ewma_anomalies
from cartwheel.sources import testdata as td
from helpers import SF01, T0, events, rows, ts



# --------------------------------------------------------------------------------------------------------
# contracts
# --------------------------------------------------------------------------------------------------------
def test_contract_sizes_match_declared_counts():
    sizes = K.contract_size()
    assert sum(t for t, _ in sizes.values()) == 58
    assert sum(r for _, r in sizes.values()) == 60


def _outcomes(df):
    return {(r["check_name"]): (r["measured"], r["outcome"]) for r in df.collect()}


def test_each_check_kind_passes_and_fails(spark):
    good = events(spark, [
        dict(event_id="e1", user_id="u", event_type="purchase", event_timestamp=ts(0), price=1.0, currency="BRL"),
        dict(event_id="e2", user_id="u", event_type="page_view", event_timestamp=ts(-10), price=None, currency="USD"),
    ])
    bad = events(spark, [
        dict(event_id="e1", user_id=None, event_type="error", event_timestamp=ts(-300), price=-1.0, currency="EUR"),
        dict(event_id="e1", user_id="u", event_type="purchase", event_timestamp=ts(-300), price=2.0),
    ])
    checks = [
        C.missing("user_id"),
        C.duplicates("event_id"),
        C.invalid("currency", ["BRL", "USD"]),
        C.between("price", low=0),
        C.min_at_least("price", 0),
        C.row_predicate("price >= 0"),
        C.failed_rows("price < 0"),
        C.row_count_above(1),
        C.freshness("event_timestamp", "2 hours", "1 hour"),
    ]
    g = _outcomes(C.run_checks(good, "t", checks, as_of=T0))
    b = _outcomes(C.run_checks(bad, "t", checks, as_of=T0))
    assert all(o == "pass" for _, o in g.values()), g
    assert all(o == "fail" for k, (_, o) in b.items() if k != "row_count_above"), b
    one_row = _outcomes(C.run_checks(bad.where("price > 0"), "t", [C.row_count_above(1)]))
    assert one_row["row_count_above"] == (1.0, "fail")
    assert b["duplicate_count(event_id)"][0] == 1.0
    warn = _outcomes(C.run_checks(good, "t", [C.freshness("event_timestamp", "2 hours", "1 hour")], as_of=ts(70)))
    assert warn["freshness(event_timestamp)"] == (4200.0, "warn")


def test_freshness_on_empty_table_fails(spark):
    empty = events(spark, [dict(event_id="x", event_timestamp=ts(0))]).where("false")
    r = _outcomes(C.run_checks(empty, "t", [C.freshness("event_timestamp", "2 hours")], as_of=T0))
    assert r["freshness(event_timestamp)"][1] == "fail"


def test_custom_tests(spark):
    df = events(spark, [
        dict(event_id="a", event_type="error", price=0.0),
        dict(event_id="b", event_type=None, price=None),
        dict(event_id="c", event_type="purchase", price=3.0),
    ])
    assert rows(C.valid_event_type_failures(df), "event_id") == [("a",)]  # NULL passes
    assert rows(C.positive_price_failures(df), "event_id") == [("a",)]


def test_schema_check_and_gate(spark):
    stg = silver.stg_clickstream(td.bronze(spark, SF01))
    res = C.schema_check(spark, stg, "stg_clickstream", ["event_id", "user_id", "nope"], {"price": "string"})
    got = {r["check_name"]: r["outcome"] for r in res.collect()}
    assert got == {"schema(required columns)": "fail", "schema(column types)": "warn",
                   "schema(forbidden columns)": "pass"}
    with pytest.raises(C.ContractFailure):
        C.gate(res)


def test_scan_gate_on_silver_schema_tests_passes(spark):
    stg = silver.stg_clickstream(td.bronze(spark, SF01))
    res = K.scan(spark, {"stg_clickstream": stg}, as_of="2024-02-01 00:00:00", suites=(K.T,))
    assert C.gate(res) == "pass"
    with pytest.raises(KeyError):
        K.scan(spark, {"no_such_table": stg})


# --------------------------------------------------------------------------------------------------------
# EWMA
# --------------------------------------------------------------------------------------------------------
def _series(spark, values, start=dt.date(2024, 1, 1), skip=()):
    data = [(start + dt.timedelta(days=i), float(v)) for i, v in enumerate(values) if i not in skip]
    return spark.createDataFrame(data, "d date, v double")


def test_ewma_flags_spike_only(spark):
    vals = [100.0 + (i % 7) for i in range(40)] + [500.0]
    out = {r["metric_date"]: r["status"] for r in ewma_anomalies(_series(spark, vals), "d", "v").collect()}
    last = dt.date(2024, 1, 1) + dt.timedelta(days=40)
    assert out[last] == "anomalous"
    assert sum(1 for s in out.values() if s == "anomalous") == 1
    assert all(out[dt.date(2024, 1, 1) + dt.timedelta(days=i)] == "no_residual" for i in range(7))


def test_ewma_short_series_insufficient_and_missing_day(spark):
    out = {r["metric_date"]: r["status"] for r in ewma_anomalies(_series(spark, [1.0] * 10), "d", "v").collect()}
    assert set(out.values()) == {"no_residual", "insufficient"}
    gap = ewma_anomalies(_series(spark, list(range(30)), skip={10}), "d", "v")
    st = {r["metric_date"]: r["status"] for r in gap.collect()}
    assert dt.date(2024, 1, 11) not in st
    assert st[dt.date(2024, 1, 18)] == "no_residual"  # its value 7 days earlier is missing


# --------------------------------------------------------------------------------------------------------
# monitoring
# --------------------------------------------------------------------------------------------------------
def test_health_warnings(spark):
    df = events(spark, [
        dict(event_id="a", user_id="u", event_type="purchase", event_timestamp=ts(-50), processing_timestamp=ts(-48)),
    ])
    h = monitoring.bronze_health(df, T0)
    w = {r["warning"]: r["measured"] for r in monitoring.bronze_health_warnings(h, T0).collect()}
    assert w == {"low_volume": 1.0, "high_latency": 120.0, "stream_silent": 3000.0}
    empty = monitoring.bronze_health(df.where("false"), T0)
    w2 = {r["warning"] for r in monitoring.bronze_health_warnings(empty, T0).collect()}
    assert w2 == {"low_volume"}  # NULL latency counts as 0, no newest event -> no silence warning


def test_freshness_and_trigger(spark):
    df = events(spark, [dict(event_id="a", event_timestamp=ts(-45))])
    f = monitoring.bronze_freshness(df, T0).first()
    assert f["minutes_stale"] == 45 and f["is_stale"] and f["events_last_hour"] == 1
    assert monitoring.bronze_freshness(df.where("false"), T0).first()["is_stale"]
    with pytest.raises(monitoring.StaleStream):
        monitoring.assert_fresh(df, T0)
    t = monitoring.new_data_since(df, ts(-60), T0).first()
    assert t["should_run"] and t["stale_warning"] and t["run_key"].startswith("bronze_fresh_2024-01-15T11:15")
    assert not monitoring.new_data_since(df, ts(-45), T0).first()["should_run"]


def test_funnel_ratios_zero_base(spark):
    counts = spark.createDataFrame([("page_view", 0), ("view_item", 3), ("add_to_cart", 2)], "event_type string, count long")
    r = monitoring.funnel_ratios(counts).first()
    assert (r[0], r[1], r[2]) == (0.0, 66.67, 0.0)


# --------------------------------------------------------------------------------------------------------
# sessions
# --------------------------------------------------------------------------------------------------------
def sessionize_simple(events_df):
    """The rule with one window per user, for comparison."""
    ev = events_df.where("user_id is not null and event_timestamp is not null")
    w = Window.partitionBy("user_id").orderBy("event_timestamp", "event_id")
    prev = F.lag("event_timestamp").over(w)
    gap = F.timestamp_diff("MICROSECOND", prev, F.col("event_timestamp"))
    ev = ev.withColumn("is_session_start", prev.isNull() | (gap >= 30 * 60 * 1_000_000))
    return ev.withColumn("session_seq", F.sum(F.col("is_session_start").cast("long")).over(w.rowsBetween(Window.unboundedPreceding, 0)))


def test_session_gap_rule(spark):
    df = events(spark, [
        dict(event_id="1", user_id="u", event_type="page_view", event_timestamp=ts(0)),
        dict(event_id="2", user_id="u", event_type="view_item", event_timestamp=ts(29, 59)),  # continue
        dict(event_id="3", user_id="u", event_type="page_view", event_timestamp=ts(59, 59)),  # exactly 30:00 -> new
        dict(event_id="4", user_id="u", event_type="purchase", event_timestamp=ts(90, 0)),  # 30:01 -> new
    ])
    for fn in (sessions.sessionize, sessionize_simple):
        assert rows(fn(df), "event_id", "session_seq") == [("1", 1), ("2", 1), ("3", 2), ("4", 3)]
    depth = rows(sessions.session_funnel_depth(sessions.sessionize(df)), "session_seq", "funnel_depth")
    assert depth == [(1, 2), (2, 1), (3, 4)]


def test_chunked_sessionize_equals_single_window(spark):
    stg = silver.stg_clickstream(td.bronze(spark, SF01))
    cols = ["user_id", "event_id", "session_seq", "is_session_start"]
    a = sessionize_simple(stg).select(*cols)
    for bucket in ("1 day", "1 hour", "10 minutes"):
        b = sessions.sessionize(stg, bucket=bucket).select(*cols)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    w = Window.partitionBy("user_id", "session_seq").orderBy("event_timestamp", "event_id")
    step = F.expr("case event_type when 'page_view' then 1 when 'view_item' then 2 when 'add_to_cart' then 3 else 4 end")
    want = sessionize_simple(stg).withColumn("current_step", F.max(step).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    want = want.select("event_id", "current_step")
    for bucket in ("10 minutes", "1 second", "30 days"):
        got = sessions.session_progress(sessions.sessionize(stg), bucket=bucket).select("event_id", "current_step")
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_time_buckets_are_in_time_order(spark):
    from cartwheel.operators.buckets import running_max, time_bucket

    day = 86_400_000_000
    times = [-day - 1, -5, 5, day - 1, day, 3 * day + 7]  # times before 1970 floor to the earlier bucket
    df = spark.createDataFrame([(t,) for t in times], "t long").withColumn("b", time_bucket("t", day))
    assert [r["b"] for r in df.orderBy("t").collect()] == [-2, -1, 0, 0, 1, 3]
    with pytest.raises(ValueError):
        time_bucket("t", 0)
    values = [4, None, 2, 9, 1, None]
    vals = spark.createDataFrame(list(zip(["k"] * 6, times, values)), "k string, t long, v int")
    for width in (1, 10, day, 100 * day):
        got = running_max(vals, ["k"], "t", ["t"], "v", width, "m").orderBy("t").collect()
        assert [r["m"] for r in got] == [4, 4, 4, 9, 9, 9]
        got = running_max(vals, ["k"], "t", ["t"], "v", width, "m", last=-1).orderBy("t").collect()
        assert [r["m"] for r in got] == [None, 4, 4, 4, 9, 9]


def test_session_consistency_forms(spark):
    df = events(spark, [
        dict(event_id="1", user_id="u", session_id="s1", event_timestamp=ts(0)),
        dict(event_id="2", user_id="v", session_id="s1", event_timestamp=ts(1)),  # shared by two users
        dict(event_id="3", user_id="w", session_id="a", event_timestamp=ts(0)),
        dict(event_id="4", user_id="w", session_id="b", event_timestamp=ts(5)),
        dict(event_id="5", user_id="w", session_id="a", event_timestamp=ts(10)),  # a comes back after b
    ])
    assert sessions.session_consistency_literal(df).count() == 0
    v = rows(sessions.session_consistency_violations(df), "violation", "session_id")
    assert v == [("interleaved", "b"), ("shared_session", "s1")]
    for bucket in ("1 minute", "1 second", "30 days"):
        assert rows(sessions.session_consistency_violations(df, bucket=bucket), "violation", "session_id") == v


def test_scan_binds_variables(spark):
    df = spark.createDataFrame([(1.0,), (95.0,)], "abandonment_rate double")
    declared = {"t": [C.failed_rows("abandonment_rate > ${limit}", suite=K.R)]}
    res = K.scan(spark, {"t": df}, variables={"limit": "90"}, contracts=declared).collect()
    assert [(r["check_name"], r["measured"], r["outcome"]) for r in res] == [
        ("failed_rows(abandonment_rate > 90)", 1.0, "fail")
    ]
