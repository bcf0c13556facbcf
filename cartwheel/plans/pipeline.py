"""User-level jobs: seed load, hourly incremental transform, monitoring, and the full run with a promotion gate.

Incremental transform (one run per hour, rerunnable):

1. read the bronze slice ``[run - 90 min, run - 30 min)`` (date partitions pruned);
2. silver rows of the touched dates = (existing silver of those dates) UNION (new slice), deduplicated again
   (latest copy per event_id wins) and only then validated, so an invalid newest copy removes its event as in the batch
   form; the merged rows are checkpointed into the shared checkpoint folder first, so overwriting those date
   partitions never reads the files it replaces;
3. the runtime contract of the new silver rows gates promotion: a failing check stops the run before silver and
   gold are touched;
4. gold of every touched date and the day before it (a cart waits 24 h for its purchase) is recomputed from all silver
   of those dates and the days after them, and overwrites just those partitions.

Rerunning the same window gives the same tables. Executor loss at any point is covered by Spark task retry
(all inputs are files) and, for a lost driver, by rerunning the window.
"""

from __future__ import annotations

import datetime as _dt
import os
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import gold, monitoring, silver
from ..quality import checks as C
from ..quality import contracts as K
from ..session import ensure_checkpoint_dir
from ..sources.bronze import read_bronze
from ..sources.seeds import load_products as read_products_seed
from .tables import LAYOUT, materialize


@dataclass(frozen=True)
class Warehouse:
    root: str

    def path(self, model: str) -> str:
        return os.path.join(self.root, model)

    def _file_system(self, spark: SparkSession, path: str):
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(spark._jsc.hadoopConfiguration()), at

    def exists(self, spark: SparkSession, model: str) -> bool:
        """Asked of the path's own file system (any URI scheme); an error there is raised, never read as absent."""
        fs, at = self._file_system(spark, self.path(model))
        return bool(fs.exists(at))

    def read(self, spark: SparkSession, model: str) -> DataFrame | None:
        """A stored table, None if there is none; a table without rows is read by its registered schema."""
        if not self.exists(spark, model):
            return None
        try:
            return spark.read.parquet(self.path(model))
        except AnalysisException as e:
            if e.getCondition() != "UNABLE_TO_INFER_SCHEMA":
                raise
        if not spark.catalog.tableExists(model):
            return None
        return spark.read.schema(spark.table(model).schema).parquet(self.path(model))

    def drop_partition(self, spark: SparkSession, model: str, column: str, value: object) -> None:
        """Remove one partition of a stored table, if it is there."""
        fs, at = self._file_system(spark, f"{self.path(model)}/{column}={value}")
        if fs.exists(at) and not fs.delete(at, True):
            raise OSError(f"cannot remove {at}")


def load_products(spark: SparkSession, seed_path: str, wh: Warehouse) -> tuple[DataFrame, DataFrame]:
    """Seed job: CSV catalogue -> ``stg_products`` table (active rows), plus the rejected lines."""
    rows, rejects = read_products_seed(spark, seed_path)
    part, cluster = LAYOUT["stg_products"]
    table = materialize(silver.stg_products(rows), "stg_products", path=wh.path("stg_products"),
                        partition_by=part, cluster_by=cluster)
    return table, rejects


def _dates(df: DataFrame, col: str) -> list[_dt.date]:
    # the slice spans at most a few dates, so this is a handful of rows
    return sorted(r[0] for r in df.select(F.to_date(col).alias("d")).distinct().collect() if r[0] is not None)


def affected_dates(touched: list[_dt.date]) -> tuple[list[_dt.date], list[_dt.date]]:
    """(dates whose marts change, dates to read for them) when the events of ``touched`` dates change: a cart sees the
    purchases of 24 hours, so each touched date changes its own marts and those of the day before, and the marts of a date
    need the day after it."""
    day = _dt.timedelta(days=1)
    change = {d - k * day for d in touched for k in (0, 1)}
    return sorted(change), sorted({d + k * day for d in change for k in (0, 1)})


def run_transform(
    spark: SparkSession,
    bronze_path: str,
    wh: Warehouse,
    run_started_at: str | _dt.datetime,
    invocation_id: str,
    products: DataFrame | None = None,
    lookback_start: str = "1 hour 30 minutes",
    lookback_end: str = "30 minutes",
    gate_suite: str = K.R,
) -> dict:
    """One hourly run. Returns the touched dates and the gate outcome.

    The runtime suite blocks promotion, schema check included; ``gate_suite=contracts.T`` gates on the schema tests.
    """
    ensure_checkpoint_dir(spark)
    bronze = read_bronze(spark, bronze_path)
    fresh = silver.newest_copies(
        bronze, run_started_at, lookback_start, lookback_end, as_of=run_started_at, invocation_id=invocation_id,
        audit=True, date_partition_col="event_date",
    ).withColumn("event_date", F.to_date("event_timestamp"))
    # the slice is computed once: its dates, the merge and the gate read the stored copy
    fresh = fresh.checkpoint(eager=True)
    touched = _dates(fresh, "event_timestamp")
    if not touched:
        return {"touched_dates": [], "gate": "skipped"}

    # 2. merge with the silver rows already stored for those dates, then cut lineage before overwriting
    merged = fresh
    stored = wh.read(spark, "stg_clickstream")
    if stored is not None:
        merged = stored.where(F.col("event_date").isin(touched)).unionByName(fresh)
    merged = silver.validate_silver(silver.dedup_latest(merged)).checkpoint(eager=True)

    # 3. promotion gate on the new silver rows
    outcome = C.gate(K.scan(spark, {"stg_clickstream": merged}, as_of=run_started_at, suites=(gate_suite,)))

    part, cluster = LAYOUT["stg_clickstream"]
    kind = materialize(
        merged, "stg_clickstream", path=wh.path("stg_clickstream"), partition_by=part, cluster_by=cluster
    ).schema
    kept = set(_dates(merged, "event_timestamp"))
    for date in (d for d in touched if d not in kept):
        for model in ("stg_clickstream", "int_enriched_clickstream"):
            wh.drop_partition(spark, model, part, date)

    # 4. gold for every touched date and the day before it (abandonment looks 24 h ahead)
    gold_dates, read_dates = affected_dates(touched)
    stg = spark.read.schema(kind).parquet(wh.path("stg_clickstream")).where(F.col("event_date").isin(read_dates))
    if products is None:
        products = spark.read.parquet(wh.path("stg_products"))
    part, cluster = LAYOUT["int_enriched_clickstream"]
    # stored once, over the dates read, and read by the three marts
    enriched = materialize(
        silver.enrich_with_products(stg.drop("event_date"), products).withColumn(part, F.to_date("event_timestamp")),
        "int_enriched_clickstream",
        path=wh.path("int_enriched_clickstream"),
        partition_by=part,
        cluster_by=cluster,
    )
    enriched = enriched.where(F.col(part).isin(read_dates)).drop(part)
    as_of = run_started_at
    marts = {
        "fct_daily_revenue": gold.fct_daily_revenue(enriched, as_of),
        "fct_conversion_funnel": gold.fct_conversion_funnel(enriched, as_of),
        "fct_cart_abandonment": gold.fct_cart_abandonment(enriched, as_of),
    }
    for name, df in marts.items():
        part, cluster = LAYOUT[name]
        table = materialize(df.where(F.col(part).isin(gold_dates)), name, path=wh.path(name), partition_by=part,
                            cluster_by=cluster)
        # a dynamic overwrite leaves dates that have become empty: the marts as computed say which are left
        left = {r[0] for r in df.where(F.col(part).isin(gold_dates)).select(part).distinct().collect()}
        for date in (d for d in gold_dates if d not in left):
            wh.drop_partition(spark, name, part, date)
        table.createOrReplaceTempView(name)
    return {"touched_dates": touched, "gold_dates": gold_dates, "gate": outcome}


def run_monitoring(spark: SparkSession, bronze_path: str, as_of: str | _dt.datetime) -> dict:
    """Health, type mix and funnel ratios of the last hour; each is one small aggregate result."""
    bronze = read_bronze(spark, bronze_path)
    health = monitoring.bronze_health(bronze, as_of)
    counts = monitoring.bronze_event_counts(bronze, as_of)
    return {
        "health": [r.asDict() for r in health.collect()],
        "warnings": [r.asDict() for r in monitoring.bronze_health_warnings(health, as_of).collect()],
        "event_counts": {r["event_type"]: r["count"] for r in counts.collect()},
        "funnel_ratios": monitoring.funnel_ratios(counts).first().asDict(),
        "freshness": monitoring.bronze_freshness(bronze, as_of).first().asDict(),
    }


def run_all(
    spark: SparkSession,
    seed_path: str,
    bronze_path: str,
    wh: Warehouse,
    run_started_at: str | _dt.datetime,
    invocation_id: str,
    gate_suite: str = K.R,
) -> dict:
    """Seed -> transform (with gate) -> contract scan of all tables -> monitoring."""
    products, rejects = load_products(spark, seed_path, wh)
    out = run_transform(spark, bronze_path, wh, run_started_at, invocation_id, products=products, gate_suite=gate_suite)
    # every stored table, whether or not this run wrote it; one that is not stored fails the scan
    stored = {n: df for n in K.CONTRACTS if (df := wh.read(spark, n)) is not None}
    missing = [n for n in K.CONTRACTS if n not in stored]
    out["scan"] = []
    if stored:
        scan = K.scan(spark, stored, as_of=run_started_at)
        out["scan"] = [r.asDict() for r in scan.collect()]  # one row per declared check (~120 rows)
    out["missing_tables"] = missing
    worst = {r["outcome"] for r in out["scan"]} | ({"fail"} if missing else set())
    out["scan_outcome"] = next((o for o in ("fail", "warn") if o in worst), "pass")
    out["seed_rejects"] = rejects.count()
    out["monitoring"] = run_monitoring(spark, bronze_path, run_started_at)
    return out
