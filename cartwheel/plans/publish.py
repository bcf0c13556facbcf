"""Jobs on versioned tables: a transform that is published whole or not at all, its continuous form, and a streaming sink.

``publish_rows`` brings a slice of bronze to silver and gold in one draft (``versions.py``):

1. the newest copy of each event of the slice is upserted by ``event_id``: the key filters say which silver files may hold
   one of the ids, and only these are rewritten. Invalid newest copies are stored too and left out when silver is read, so a
   rerun with an older copy can't bring an event back;
2. the runtime contract of the touched days gates silver;
3. enriched events and the three marts of all days that change (a moved event changes its old day too) are staged;
4. the contract of the staged marts gates gold;
5. one commit publishes silver, enriched events and marts together. A failure anywhere before leaves the version before.

``start_continuous_transform`` does this for every new bronze file, however late its events are: the file source's log is
the cursor, and a batch number in the committed version makes a repeated batch a no-op. ``start_store_ingest`` is the
micro-batched sink on such tables: bronze rows, dead letters and the batch's metrics come with one commit, so totals
count each batch once. ``compact_table`` packs small files while the stream writes.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import gold, ingest, silver
from ..quality import checks as C
from ..quality import contracts as K
from ..schemas import BRONZE_COLUMNS
from ..session import ensure_checkpoint_dir
from ..sources.bronze import BRONZE_TABLE_SCHEMA
from .pipeline import affected_dates
from .tables import LAYOUT
from .versions import Store

SILVER, ENRICHED = "stg_clickstream", "int_enriched_clickstream"
MARTS = {"fct_daily_revenue": "revenue_date", "fct_conversion_funnel": "funnel_date", "fct_cart_abandonment": "analysis_date"}
BRONZE, DEAD, METRICS = "bronze", "dead_letter", "ingest_metrics"


def newest_event(rows: DataFrame) -> DataFrame:
    """The newest copy of each event, ordered as the batch form orders copies; audit columns take no part."""
    order = [F.col(c).desc_nulls_last() for c in ("processing_timestamp", "event_timestamp")]
    window = Window.partitionBy("event_id").orderBy(*order, F.xxhash64(*BRONZE_COLUMNS).desc())
    return rows.withColumn("_place", F.row_number().over(window)).where("_place = 1").drop("_place")


def read_silver(store: Store, days: list[_dt.date] | None = None, version=None) -> DataFrame:
    """Valid silver rows of a version, of some days or all."""
    rows = silver.validate_silver(store.read(SILVER, days, version, newest_event))
    return rows if days is None else rows.where(F.to_date("event_timestamp").isin(days))


def _days(rows: DataFrame) -> set[_dt.date]:
    found = rows.select(F.to_date("event_timestamp").alias("d")).where("d is not null").distinct().collect()
    return {r["d"] for r in found}


def publish_rows(
    store: Store,
    fresh: DataFrame,
    products: DataFrame,
    as_of: str | _dt.datetime,
    gate_suite: str = K.R,
    gold_suite: str = K.T,
    contracts: dict[str, list] | None = None,
    batch: tuple[str, int] | None = None,
) -> dict:
    """Merge ``fresh`` (the newest copies of a slice's events) and publish all that changes. ``batch``: stream and number."""
    draft = store.draft()
    if batch and draft.base.batches.get(batch[0], -1) >= batch[1]:
        return {"version": draft.base.number, "touched_dates": [], "gate": "repeated"}
    ensure_checkpoint_dir(store.spark)
    fresh = fresh.checkpoint(eager=True)
    touched = _days(fresh)
    if batch:
        draft.batches[batch[0]] = batch[1]
    if not touched:
        return {"version": draft.commit().number if batch else draft.base.number, "touched_dates": [], "gate": "skipped"}

    # 1. silver
    before = draft.base.tables.get(SILVER)
    draft.upsert(SILVER, fresh, "event_id", "event_timestamp")
    state = draft.tables[SILVER]
    held = [f for f in before.files if f.path in state.touched or f.kind == "delta"] if before else []
    if held:  # days that lose an event to another day
        touched |= _days(store.open(state, held).join(fresh.select("event_id"), "event_id", "left_semi"))
    part, cluster = LAYOUT[SILVER]
    rewritten = draft.fold(SILVER, newest_event, "event_id", "event_timestamp", cluster)
    gold_dates, read_dates = affected_dates(sorted(touched))
    days = sorted({*read_dates, *touched})

    # 2. gate on silver
    rows = read_silver(store, days, draft.version)
    slice_ = rows.where(F.to_date("event_timestamp").isin(sorted(touched))).withColumn(part, F.to_date("event_timestamp"))
    outcome = C.gate(K.scan(store.spark, {SILVER: slice_}, as_of=as_of, suites=(gate_suite,), contracts=contracts))

    # 3. enriched events and marts
    enriched = silver.enrich_with_products(rows.where(F.to_date("event_timestamp").isin(read_dates)), products)
    draft.replace_days(ENRICHED, enriched, "event_timestamp", read_dates, LAYOUT[ENRICHED][1])
    enriched = draft.read(ENRICHED, read_dates)
    for name, day in MARTS.items():
        mart = getattr(gold, name)(enriched, as_of)
        draft.replace_days(name, mart.where(F.col(day).isin(gold_dates)), day, gold_dates, LAYOUT[name][1])

    # 4. gate on gold
    staged = {name: draft.read(name, gold_dates) for name in MARTS}
    C.gate(K.scan(store.spark, staged, as_of=as_of, suites=(gold_suite,), contracts=contracts))

    # 5. all of it, at once
    return {
        "version": draft.commit().number,
        "touched_dates": sorted(touched),
        "gold_dates": gold_dates,
        "rewritten": rewritten,
        "gate": outcome,
    }


def publish_transform(
    store: Store,
    bronze: DataFrame,
    products: DataFrame,
    run_started_at: str | _dt.datetime,
    invocation_id: str,
    lookback_start: str = "1 hour 30 minutes",
    lookback_end: str = "30 minutes",
    **options,
) -> dict:
    """One hourly run over the slice ``[run - start, run - end)`` of stored bronze; rerunnable."""
    fresh = silver.newest_copies(
        bronze, run_started_at, lookback_start, lookback_end, run_started_at, invocation_id, True, "event_date"
    )
    return publish_rows(store, fresh, products, run_started_at, **options)


def start_continuous_transform(
    store: Store,
    bronze_path: str,
    products: DataFrame,
    checkpoint_path: str,
    as_of: str | _dt.datetime | None = None,
    trigger: dict | None = None,
    query_name: str = "continuous_transform",
    max_files: int | None = None,
    **options,
) -> StreamingQuery:
    """Publish every new file of stored bronze once; by default all that is there, then stop."""

    def run(rows: DataFrame, number: int) -> None:
        at = as_of or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        fresh = silver.newest_copies(rows.drop("event_date"), as_of=at, invocation_id=f"{query_name}-{number}", audit=True)
        publish_rows(store, fresh, products, at, batch=(query_name, number), **options)

    source = store.spark.readStream.schema(BRONZE_TABLE_SCHEMA)
    source = source.option("maxFilesPerTrigger", max_files) if max_files else source
    writer = source.parquet(bronze_path).writeStream.queryName(query_name).option("checkpointLocation", checkpoint_path)
    return writer.foreachBatch(run).trigger(**(trigger or {"availableNow": True})).start()


# ---------------------------------------------------------------------------------------------------------
# Micro-batched sink on versioned tables
# ---------------------------------------------------------------------------------------------------------
def sink_batch(store: Store, parsed: DataFrame, stream: str, number: int) -> bool:
    """Commit one micro-batch: bronze rows, dead letters and its metrics; False if it has been committed before."""
    draft = store.draft()
    if draft.base.batches.get(stream, -1) >= number:
        return False
    parsed = parsed.persist()
    try:
        good = parsed.where(F.col("reject_reason").isNull()).select(*BRONZE_COLUMNS)
        draft.append(BRONZE, good, "event_timestamp", ("user_id", "event_type"))
        tag = [F.lit(stream).alias("query"), F.lit(number).cast("long").alias("batch_id")]
        draft.append(DEAD, ingest.dead_letter(parsed).select(*tag, "*"), None)
        counts = parsed.agg(
            F.count_if(F.col("reject_reason").isNull()).alias("rows_ok"),
            F.count_if(F.col("reject_reason").isNotNull()).alias("rows_failed"),
            F.min("event_timestamp").alias("first_event"),
            F.max("event_timestamp").alias("last_event"),
        )
        draft.append(METRICS, counts.select(*tag, "*"), None)
    finally:
        parsed.unpersist()
    draft.batches[stream] = number
    draft.commit()
    return True


def start_store_ingest(
    store: Store,
    envelope_stream: DataFrame,
    checkpoint_path: str,
    trigger: dict | None = None,
    processing_time: str | None = None,
    query_name: str = "store_ingest",
) -> StreamingQuery:
    """Start the sink: parsed records of the stream into bronze, dead letters and metrics of ``store``."""
    parsed = ingest.parse_events(envelope_stream, processing_time=processing_time)
    writer = parsed.writeStream.queryName(query_name).option("checkpointLocation", checkpoint_path)
    writer = writer.foreachBatch(lambda rows, number: sink_batch(store, rows, query_name, number))
    return writer.trigger(**(trigger or {"processingTime": "10 seconds"})).start()


def ingest_totals(store: Store) -> DataFrame:
    """Per query: batches, rows accepted and rejected, success rate and newest event, over all committed batches."""
    ok, failed = F.sum("rows_ok"), F.sum("rows_failed")
    return (
        store.read(METRICS)
        .groupBy("query")
        .agg(
            F.count("*").alias("batches_sent"),
            ok.alias("rows_inserted"),
            failed.alias("rows_failed"),
            (ok / F.greatest(ok + failed, F.lit(1))).alias("success_rate"),
            F.max("last_event").alias("last_event"),
        )
    )


def compact_table(store: Store, table: str, target_bytes: int = 256 << 20) -> int:
    """Pack the small files of a table; returns the number of packs. Batches that are committed meanwhile are kept."""
    key, cluster = ("event_id", LAYOUT[SILVER][1]) if table == SILVER else (None, LAYOUT.get(table, (None, ()))[1])
    draft = store.draft()
    packs = draft.compact(table, target_bytes, key, cluster)
    if packs:
        draft.commit()
    return len(packs)
