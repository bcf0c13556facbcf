"""Mergeable distinct users, layout on a space-filling curve, incremental uniqueness."""

import datetime as dt
import os

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from cartwheel.operators import distinct, silver
from cartwheel.plans import tables
from cartwheel.plans.versions import Store
from cartwheel.quality import checks as C
from cartwheel.quality.uniqueness import repeated_keys, scan_uniqueness
from cartwheel.sources import testdata as td
from helpers import SF001


def test_hourly_states_merge_to_exact_distinct_users(spark, tmp_dir):
    events = silver.silver_and_enriched(td.bronze(spark, SF001), td.products(spark, SF001)).select(
        "event_id", "user_id", "event_type", "event_timestamp").checkpoint()
    late = F.pmod(F.xxhash64("event_id"), F.lit(10)) == 0
    by = ("event_type",)
    numbers, states = None, None
    for k, rows in enumerate((events.where(~late), events.where(late), events.where(late))):  # the last is a re-delivery
        path = os.path.join(tmp_dir, f"numbers{k}")
        distinct.numbered(rows, "user_id", numbers).write.parquet(path)
        numbers = spark.read.parquet(path)
        path = os.path.join(tmp_dir, f"states{k}")
        distinct.user_states(rows, numbers, by=by).write.parquet(path)
        new = spark.read.parquet(path)
        states = new if states is None else distinct.merged(states.union(new), by)
    n = events.select("user_id").distinct().count()
    assert numbers.count() == n and numbers.agg(F.min("number"), F.max("number"), F.count_distinct("number")).first() == (1, n, n)
    got = distinct.unique_users(states, "day", by)
    want = events.groupBy(F.to_date("event_timestamp").alias("day"), "event_type").agg(F.count_distinct("user_id").alias("unique_users"))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    hours = distinct.unique_users(states, "hour", by)
    want = events.groupBy(F.date_trunc("hour", "event_timestamp").cast("timestamp_ntz").alias("hour"), "event_type").agg(
        F.count_distinct("user_id").alias("unique_users"))
    assert hours.exceptAll(want).count() == 0 and want.exceptAll(hours).count() == 0
    read = {os.path.basename(os.path.dirname(f)) for f in got.inputFiles()}
    assert read <= {"states0", "states1", "states2"}  # no silver


def test_many_numbers_take_several_parts(spark):
    events = spark.range(100_000).select(
        F.concat(F.lit("u"), F.col("id") % 70_000).alias("user_id"), F.lit(dt.datetime(2024, 1, 1)).alias("event_timestamp"))
    numbers = distinct.numbered(events, "user_id").checkpoint()
    assert numbers.agg(F.max("number"), F.count_distinct("number")).first() == (70_000, 70_000)
    states = distinct.user_states(events, numbers)
    assert states.count() == 3 and distinct.unique_users(states).first()["unique_users"] == 70_000
    assert distinct.unique_users(distinct.user_states(events.limit(0), numbers)).count() == 0


def _groups_read(path, column, value):
    """Row groups of all files whose statistics allow ``value``."""
    read = total = 0
    for folder, _, names in os.walk(path):
        for name in (n for n in names if n.endswith(".parquet")):
            meta = pq.ParquetFile(os.path.join(folder, name)).metadata
            place = meta.schema.names.index(column)
            for g in range(meta.num_row_groups):
                stats = meta.row_group(g).column(place).statistics
                total += 1
                read += stats is None or not stats.has_min_max or stats.min <= value <= stats.max
    return read, total


def test_curve_skips_on_the_last_column(spark, tmp_dir):
    rows = spark.range(60_000).select(
        F.concat(F.lit("e"), "id").alias("event_id"), F.lit(dt.date(2024, 1, 1)).alias("event_date"),
        F.format_string("u%04d", F.pmod(F.xxhash64("id"), F.lit(3000))).alias("user_id"),
        F.element_at(F.array(*[F.lit(t) for t in ("cart", "page", "purchase", "view")]), (F.pmod(F.hash("id"), F.lit(4)) + 1)).alias("event_type"),
        F.when(F.col("id") % 17 != 0, F.format_string("c%03d", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(200)))).alias("category_id"),
    )
    keys = ("user_id", "event_type", "category_id")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        paths = {curve: os.path.join(tmp_dir, f"t{curve}") for curve in (False, True)}
        for curve, path in paths.items():
            t = tables.materialize(rows, f"layout_{curve}", path=path, partition_by="event_date", cluster_by=keys, curve=curve)
            assert t.columns[:-1] == [c for c in rows.columns if c != "event_date"]
            same = t.select(*rows.columns)
            assert same.exceptAll(rows).count() == 0 and same.count() == 60_000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    for column, value in (("category_id", "c042"), ("category_id", "c150")):
        (by_sort, total), (by_curve, files) = (_groups_read(paths[c], column, value) for c in (False, True))
        assert total >= 40 and files >= 40 and by_curve <= by_sort / 2, (column, by_sort, by_curve)
    assert _groups_read(paths[True], "user_id", "u0100")[0] <= files / 2  # the first column still skips


def test_uniqueness_is_kept_up_to_date_from_new_files(spark, tmp_dir):
    store = Store(spark, "file://" + os.path.join(tmp_dir, "wh"))
    given = []

    def add(ids, day):
        given.extend(ids)
        rows = spark.createDataFrame([(i, day) for i in ids], "event_id string, at date").coalesce(1)
        draft = store.draft()
        draft.append("bronze", rows, "at", key="event_id")
        draft.commit()
        return {f.path for f in store.version().tables["bronze"].files if f.day == str(day)}

    def check(result):
        rows = spark.createDataFrame([(i,) for i in given], "event_id string")
        full = C.run_checks(rows, "bronze", [C.duplicates("event_id")]).first()
        assert result.duplicates == full["measured"] == sum(given.count(i) > 1 for i in set(given) if i is not None)
        want = {i: given.count(i) for i in set(given) if i is not None and given.count(i) > 1}
        assert {r["key"]: r["n"] for r in repeated_keys(store, "bronze").collect()} == want

    days = [dt.date(2024, 1, d) for d in range(1, 6)]
    first = [add([f"d{d.day}e{k}" for k in range(40)], d) for d in days[:3]]
    result = scan_uniqueness(store, "bronze", "event_id")
    assert result.opened == []
    check(result)
    add(["d2e5", "d2e5", "x1", "x1", None, None], days[3])
    result = scan_uniqueness(store, "bronze", "event_id")
    assert set(result.opened) == first[1]  # only the file of day 2
    check(result)
    add(["x1", "d2e5", "y"], days[4])
    check(scan_uniqueness(store, "bronze", "event_id"))
    check(scan_uniqueness(store, "bronze", "event_id"))  # nothing new
    draft = store.draft()
    assert draft.compact("bronze", 1 << 20, "event_id") == []  # one file a day: nothing to pack
    add(["z1", "y"], days[0])
    draft = store.draft()
    assert draft.compact("bronze", 1 << 20, "event_id")
    draft.commit()
    check(scan_uniqueness(store, "bronze", "event_id"))  # files are gone: counted anew
