"""Keyed upserts, atomic publication, continuous transform, streaming sink and compaction on versioned tables."""

import datetime as dt
import os
import time

import pytest
from pyspark.errors.exceptions.captured import StreamingQueryException
from pyspark.sql import functions as F

from cartwheel.operators import gold, ingest, silver
from cartwheel.plans import publish
from cartwheel.plans.versions import Conflict, DataFile, Draft, Store, packed
from cartwheel.quality import checks as C
from cartwheel.quality import contracts as K
from cartwheel.schemas import BRONZE_COLUMNS
from cartwheel.sources import testdata as td
from cartwheel.sources.bronze import read_bronze, write_bronze
from cartwheel.sources.kafka import read_envelope_stream
from helpers import SF001, events

T0 = dt.datetime(2024, 1, 1, 20)
H = dt.timedelta(hours=1)
AT = "2024-01-06 00:00:00"


def event(eid, kind, at, processed=None, **kw):
    return dict(event_id=eid, user_id="u" + eid[-1], session_id="s", event_type=kind, event_timestamp=at,
                processing_timestamp=processed or at, product_id="p", category_id="c", category_name="C", price=5.0) | kw


def equal(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.fixture(scope="module")
def products(spark):
    return silver.stg_products(td.products(spark, SF001)).checkpoint()


@pytest.fixture()
def store(spark, tmp_dir):
    return Store(spark, "file://" + os.path.join(tmp_dir, "wh"))


def copies(spark, rows):
    return silver.newest_copies(events(spark, rows), as_of=AT, invocation_id="r", audit=True)


def put(spark, store, products, rows, **kw):
    return publish.publish_rows(store, copies(spark, rows), products, AT, gate_suite=K.T, **kw)


def assert_batch_form(spark, store, products, rows):
    """What is published equals the batch form over all rows ever given."""
    want = silver.stg_clickstream(events(spark, rows))
    assert equal(publish.read_silver(store).select(*BRONZE_COLUMNS), want)
    enriched = silver.enrich_with_products(want, products)
    for name in publish.MARTS:
        mart = getattr(gold, name)(enriched, audit=False)
        assert equal(store.read(name).select(*mart.columns), mart), name


def test_upserts_equal_batch_and_rewrite_only_touched_files(spark, store, products):
    days = [T0 + 24 * k * H for k in range(4)]
    first = [event(f"d{k}e{j}", ("add_to_cart", "purchase")[j % 2], day + j * dt.timedelta(minutes=7))
             for k, day in enumerate(days) for j in range(12)]
    out = put(spark, store, products, first)
    assert out["rewritten"] == [] and out["gate"] == "pass"
    base = {f.day: f.path for f in store.version().tables[publish.SILVER].files}
    assert len(base) == 4 and all(f.kind == "base" for f in store.version().tables[publish.SILVER].files)

    late = T0 + 200 * H
    second = [event("d1e3", "purchase", days[1] + H, late, price=9.0), event("new1", "purchase", days[1] + H)]
    out = put(spark, store, products, second)
    assert out["rewritten"] == [base["2024-01-02"]]  # the others hold none of the ids
    files = {f.path for f in store.version().tables[publish.SILVER].files}
    assert {base[d] for d in base if d != "2024-01-02"} <= files and base["2024-01-02"] not in files
    assert_batch_form(spark, store, products, first + second)

    # an event moves to another day, one gets an invalid newest copy, one has an older copy that comes late
    third = [event("d0e1", "purchase", days[3] + H, late), event("d2e5", "purchase", days[2], late, user_id=None),
             event("d3e7", "purchase", days[3], T0 - 100 * H, price=1.0)]
    out = put(spark, store, products, third)
    assert base["2024-01-01"] in out["rewritten"] and dt.date(2024, 1, 1) in out["touched_dates"]
    assert_batch_form(spark, store, products, first + second + third)
    # reruns, older slices included, change nothing
    for rows in (first, third):
        put(spark, store, products, rows)
    assert_batch_form(spark, store, products, first + second + third)
    assert publish.read_silver(store).where("event_id = 'd2e5'").count() == 0


def test_deltas_are_merged_on_read_until_they_are_folded(spark, store):
    def upsert(rows):
        draft = store.draft()
        draft.upsert("t", copies(spark, rows), "event_id", "event_timestamp")
        draft.commit()

    first = [event(f"e{k}", "purchase", T0 + k * 24 * H) for k in range(5)]
    second = [event("e1", "purchase", T0 + 24 * H, T0 + 300 * H, price=7.0), event("e9", "purchase", T0)]
    upsert(first)
    draft = store.draft()
    draft.fold("t", publish.newest_event, "event_id", "event_timestamp")
    draft.commit()
    upsert(second)
    state = store.version().tables["t"]
    assert [f.day for f in state.files if f.path in state.touched] == ["2024-01-02"] and len(state.of("delta")) == 2
    merged = store.read("t", merge=publish.newest_event).select(*BRONZE_COLUMNS)
    want = silver.dedup_latest(events(spark, first + second))
    assert equal(merged, want)
    with pytest.raises(ValueError, match="pending deltas"):
        store.read("t")
    draft = store.draft()
    assert draft.fold("t", publish.newest_event, "event_id", "event_timestamp") == list(state.touched)
    draft.commit()
    assert equal(store.read("t").select(*BRONZE_COLUMNS), want)
    # a version that was current before can still be read
    assert equal(store.read("t", version=store.version(3), merge=publish.newest_event).select(*BRONZE_COLUMNS), want)


def test_key_filters_overlook_nothing(spark, store):
    rows = spark.range(30_000).select(
        F.concat(F.lit("k"), "id").alias("id"), (F.col("id") % 10).alias("n"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 5).cast("int")).alias("d"),
    )
    draft = store.draft()
    draft.upsert("t", rows, "id", "d")
    draft.fold("t", lambda r: r, "id", "d")
    state = draft.tables["t"]
    by_file = {f.path: {r[0] for r in store.open(state, [f]).select("id").collect()} for f in state.files}
    assert sum(map(len, by_file.values())) == 30_000 and len(by_file) >= 5
    for ids in (["k7"], ["k100", "k20001"], [f"k{i}" for i in range(0, 500, 5)]):
        asked = spark.createDataFrame([(i,) for i in ids], "id string")
        assert set(draft.files_with(state, asked, "id")) >= {p for p, held in by_file.items() if held & set(ids)}
    absent = spark.range(2_000).select(F.concat(F.lit("absent"), "id").alias("id"))
    wrong = [len(draft.files_with(state, absent.where(f"id = 'absent{k}'"), "id")) for k in range(6)]
    assert sum(wrong) <= 0.05 * 6 * len(by_file) + 1


def test_a_failure_between_any_two_writes_leaves_the_old_version(spark, store, products, monkeypatch):
    first = [event("a1", "add_to_cart", T0), event("b1", "purchase", T0 + H)]
    second = [event("a1", "add_to_cart", T0, T0 + 9 * H, price=8.0), event("c2", "add_to_cart", T0 + 2 * H)]
    put(spark, store, products, first)
    published = {n: store.read(n).collect() for n in publish.MARTS}
    write, commit = Draft.write, Store.publish
    steps = 0
    for fail_at in range(50):
        done = [0]

        def step(real):
            def run(*a, **kw):
                if done[0] == fail_at:
                    raise OSError("injected")
                done[0] += 1
                return real(*a, **kw)

            return run

        monkeypatch.setattr(Draft, "write", step(write))
        monkeypatch.setattr(Store, "publish", step(commit))
        try:
            put(spark, store, products, second)
            break
        except OSError:
            steps += 1
            assert store.version().number == 1
            if fail_at % 3 == 0:
                assert {n: store.read(n).collect() for n in publish.MARTS} == published
                assert publish.read_silver(store).count() == 2
    assert steps == 8  # deltas, silver, its filters, enriched events, three marts, the commit
    assert store.version().number == 2
    assert_batch_form(spark, store, products, first + second)


def test_a_failing_gold_check_publishes_nothing(spark, store, products):
    rows = [event("a1", "add_to_cart", T0), event("b1", "purchase", T0 + H)]
    strict = K.CONTRACTS | {"fct_daily_revenue": [C.row_predicate("orders_count > 1000", suite=K.T)]}
    with pytest.raises(C.ContractFailure):
        put(spark, store, products, rows, contracts=strict)
    assert store.version().number == 0
    put(spark, store, products, rows)
    with pytest.raises(C.ContractFailure):  # and the gate on silver
        put(spark, store, products, [event("z1", "purchase", T0)], contracts=K.CONTRACTS | {
            publish.SILVER: [C.row_predicate("event_id <> 'z1'", suite=K.T)]})
    assert store.version().number == 1 and store.read("fct_daily_revenue").first()["orders_count"] == 1


def test_hourly_runs_over_stored_bronze_equal_batch(spark, store, products, tmp_dir):
    bronze_path = os.path.join(tmp_dir, "bronze")
    write_bronze(td.bronze(spark, SF001), bronze_path)
    runs = ["2024-01-15 12:00:00", "2024-01-15 18:00:00", "2024-01-15 12:00:00"]
    bronze = read_bronze(spark, bronze_path)
    for r in runs:
        publish.publish_transform(store, bronze, products, r, "run", "6 hours 30 minutes", gate_suite=K.T)
    parts = [silver.lookback_window(bronze, r, "6 hours 30 minutes").drop("event_date") for r in runs[:2]]
    want = silver.stg_clickstream(parts[0].unionByName(parts[1]))
    assert want.count() > 0 and equal(publish.read_silver(store).select(*BRONZE_COLUMNS), want)


# ------------------------------------------------------------------------------------- continuous transform
def test_late_files_are_published_once_and_a_killed_run_resumes(spark, store, products, tmp_dir, monkeypatch):
    path, checkpoint = os.path.join(tmp_dir, "bronze"), os.path.join(tmp_dir, "ckpt")

    def run():
        q = publish.start_continuous_transform(store, path, products, checkpoint, as_of=AT, gate_suite=K.T)
        q.awaitTermination(300)

    first = [event("a1", "add_to_cart", T0), event("b1", "purchase", T0 + 48 * H)]
    write_bronze(events(spark, first), path)
    run()
    assert_batch_form(spark, store, products, first)
    late = [event("c1", "purchase", T0 + H, T0 + 100 * H, user_id="u1")]  # days behind: no window would reach it
    write_bronze(events(spark, late), path)
    run()
    assert_batch_form(spark, store, products, first + late)
    n = store.version().number
    run()
    assert store.version().number == n

    # killed before the commit: nothing is published, and the next run takes the batch up
    last = [event("d2", "add_to_cart", T0 + 2 * H)]
    write_bronze(events(spark, last), path)
    publish_ = Store.publish
    monkeypatch.setattr(Store, "publish", lambda *a: (_ for _ in ()).throw(OSError("killed")))
    with pytest.raises(StreamingQueryException):
        run()
    assert store.version().number == n
    # killed right after the commit, before the stream's own log has the batch: the batch comes again and is left out
    def after(self, version):
        publish_(self, version)
        raise OSError("killed")

    monkeypatch.setattr(Store, "publish", after)
    with pytest.raises(StreamingQueryException):
        run()
    assert store.version().number == n + 1
    monkeypatch.setattr(Store, "publish", publish_)
    run()
    assert store.version().number == n + 1
    assert_batch_form(spark, store, products, first + late + last)


# --------------------------------------------------------------------------------- streaming sink, compaction
def test_sink_counts_each_batch_once_over_replay_and_restart(spark, store, tmp_dir, monkeypatch):
    env = td.envelope(spark, SF001).checkpoint()
    source, checkpoint = os.path.join(tmp_dir, "envelope"), os.path.join(tmp_dir, "ckpt")
    env.repartition(4).write.parquet(source)
    publish_ = Store.publish
    calls = [0]

    def dies(self, version):
        done = publish_(self, version)
        calls[0] += 1
        if calls[0] == 2:
            raise OSError("driver lost after the commit")
        return done

    def run():
        stream = read_envelope_stream(spark, source, max_files_per_trigger=1)
        publish.start_store_ingest(store, stream, checkpoint, {"availableNow": True}).awaitTermination(300)

    monkeypatch.setattr(Store, "publish", dies)
    with pytest.raises(StreamingQueryException):
        run()
    assert publish.ingest_totals(store).first()["batches_sent"] == 2
    run()
    run()
    parsed = ingest.parse_events(env, processing_time=None).checkpoint()
    ok = parsed.where("reject_reason is null").count()
    totals = publish.ingest_totals(store).first()
    assert (totals["batches_sent"], totals["rows_inserted"], totals["rows_failed"]) == (4, ok, parsed.count() - ok)
    assert totals["success_rate"] == pytest.approx(ok / parsed.count())
    cols = [c for c in BRONZE_COLUMNS if c != "processing_timestamp"]
    assert equal(store.read(publish.BRONZE).select(*cols), ingest.accepted(parsed).select(*cols))
    assert store.read(publish.DEAD).count() == parsed.count() - ok


def test_compaction_keeps_rows_and_a_batch_committed_meanwhile(spark, store):
    def append(k):
        draft = store.draft()
        rows = [event(f"e{k}x{j}", "purchase", T0 + 24 * H * (j % 2)) for j in range(6)]
        draft.append(publish.BRONZE, events(spark, rows).coalesce(1), "event_timestamp", ("user_id",))
        draft.commit()
        return rows

    rows = [r for k in range(5) for r in append(k)]
    files = store.version().tables[publish.BRONZE].files
    assert len(files) >= 10
    draft, twin = store.draft(), store.draft()
    packs = draft.compact(publish.BRONZE, 1 << 20)
    assert len(packs) == 2 and sum(map(len, packs)) == len(files)
    rows += append(9)  # the stream goes on
    draft.commit()
    after = store.version().tables[publish.BRONZE].files
    assert len(after) == 2 + 2 and sum(f.rows for f in after) == 36
    assert equal(store.read(publish.BRONZE).select(*BRONZE_COLUMNS), events(spark, rows))
    only = store.read(publish.BRONZE, [T0.date()])
    assert only.count() == 18 and {r[0] for r in only.select(F.to_date("event_timestamp")).distinct().collect()} == {T0.date()}
    # a second compaction of the same files gives way
    twin.compact(publish.BRONZE, 1 << 20)
    with pytest.raises(Conflict):
        twin.commit()
    assert publish.compact_table(store, publish.BRONZE) == 2 and publish.compact_table(store, publish.BRONZE) == 0
    assert equal(store.read(publish.BRONZE).select(*BRONZE_COLUMNS), events(spark, rows))


def test_packs_are_full_and_hold_every_file_once():
    files = [DataFile(f"f{k}", 1, size, "d") for k, size in enumerate([50, 10, 40, 60, 30, 20, 90, 5])]
    packs = packed(files, 100)
    assert sorted(f.path for p in packs for f in p) == sorted(f.path for f in files)
    assert all(sum(f.bytes for f in p) <= 100 for p in packs) and len(packs) <= 4
