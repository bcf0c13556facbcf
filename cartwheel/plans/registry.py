"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame, over the generated test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .. import oracle
from ..operators import distinct, gold, ingest, monitoring, sessions, silver
from ..quality import checks as C
from ..quality import contracts as K
from ..quality.anomaly import ewma_anomalies
from ..sources import testdata as td
from . import quality_keys as QK

Query = Callable[[SparkSession, str], DataFrame]


def _enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.silver_and_enriched(td.bronze(spark, sf_dir), td.products(spark, sf_dir))


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.stg_clickstream(td.bronze(spark, sf_dir))


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.parse_events(td.envelope(spark, sf_dir), processing_time="broker")


def queries() -> dict[str, Query]:
    q: dict[str, Query] = {}
    as_of = oracle.AS_OF
    run = oracle.RUN_STARTED_AT
    # sources / silver
    q["bronze_scan"] = lambda s, d: td.bronze(s, d)
    q["dedup_latest"] = lambda s, d: silver.dedup_latest(silver.typed_projection(td.bronze(s, d)))
    q["silver_validated"] = _silver
    q["stg_products"] = lambda s, d: silver.stg_products(td.products(s, d))
    q["enriched_clickstream"] = _enriched
    q["lookback_window"] = lambda s, d: silver.lookback_window(td.bronze(s, d), run)
    q["lookback_macro"] = lambda s, d: silver.lookback_macro_window(td.bronze(s, d), run)
    q["typed_projection"] = lambda s, d: silver.typed_projection(td.bronze(s, d))
    q["audit_columns"] = lambda s, d: silver.add_audit_columns(_silver(s, d), as_of, oracle.INVOCATION_ID)
    # gold
    q["cart_to_purchase"] = lambda s, d: gold.cart_purchase_matches(_enriched(s, d))
    q["cart_agg"] = lambda s, d: gold.cart_agg(gold.cart_purchase_matches(_enriched(s, d)))
    q["purchase_agg"] = lambda s, d: gold.purchase_agg(gold.cart_purchase_matches(_enriched(s, d)))
    q["fct_daily_revenue"] = lambda s, d: gold.fct_daily_revenue(_enriched(s, d), as_of)
    q["daily_event_counts"] = lambda s, d: gold.daily_event_counts(_enriched(s, d))
    q["funnel_pivot"] = lambda s, d: gold.funnel_pivot(gold.daily_event_counts(_enriched(s, d)))
    q["fct_conversion_funnel"] = lambda s, d: gold.fct_conversion_funnel(_enriched(s, d), as_of)
    q["fct_cart_abandonment"] = lambda s, d: gold.fct_cart_abandonment(_enriched(s, d), as_of)
    q["cart_abandonment_first"] = lambda s, d: gold.fct_cart_abandonment(_enriched(s, d), as_of, first_only=True)
    q["minute_revenue"] = lambda s, d: gold.minute_revenue(_enriched(s, d))
    # ingest
    q["publish_envelope"] = lambda s, d: ingest.publish_envelope(td.bronze(s, d))
    q["sink_row_prep"] = lambda s, d: ingest.sink_row_prep(td.bronze(s, d))
    q["parse_events"] = lambda s, d: _parsed(s, d)
    q["validate_events"] = lambda s, d: ingest.accepted(_parsed(s, d))
    q["dead_letter"] = lambda s, d: ingest.dead_letter(_parsed(s, d))
    q["required_fields"] = lambda s, d: ingest.missing_required(_parsed(s, d))
    q["synth_event_id"] = lambda s, d: ingest.event_ids(_parsed(s, d))
    q["ingest_stats"] = lambda s, d: ingest.ingest_stats(_parsed(s, d))
    # quality
    q["dq_missing"] = lambda s, d: C.run_checks(_bronze_typed(s, d), "bronze", QK.MISSING)
    q["dq_duplicates"] = lambda s, d: C.run_checks(_bronze_typed(s, d), "bronze", QK.DUPLICATES)
    q["dq_accepted_values"] = lambda s, d: C.run_checks(_bronze_typed(s, d), "bronze", QK.ACCEPTED)
    q["dq_between"] = lambda s, d: C.run_checks(_bronze_typed(s, d), "bronze", QK.BETWEEN)
    q["dq_min"] = lambda s, d: C.run_checks(_bronze_typed(s, d), "bronze", QK.MINS)
    q["dq_row_predicate"] = lambda s, d: C.run_checks(
        gold.fct_conversion_funnel(_enriched(s, d), as_of), "fct_conversion_funnel", QK.ROW_PREDICATES
    )
    q["dq_cross_column"] = lambda s, d: C.run_checks(
        gold.fct_conversion_funnel(_enriched(s, d), as_of), "fct_conversion_funnel", QK.CROSS_FUNNEL
    ).unionByName(C.run_checks(gold.fct_cart_abandonment(_enriched(s, d), as_of), "fct_cart_abandonment", QK.CROSS_ABANDON))
    q["dq_freshness"] = lambda s, d: C.run_checks(_silver(s, d), "stg_clickstream", QK.FRESHNESS, as_of)
    q["dq_row_count"] = lambda s, d: C.run_checks(_silver(s, d), "stg_clickstream", QK.ROW_COUNT).unionByName(
        C.run_checks(silver.lookback_window(td.bronze(s, d), run), "lookback_slice", QK.ROW_COUNT)
    )
    q["dq_valid_event_type"] = lambda s, d: C.valid_event_type_failures(td.bronze(s, d)).select("event_id", "event_type")
    q["dq_positive_price"] = lambda s, d: C.positive_price_failures(td.bronze(s, d)).select("event_id", "price")
    q["dq_failed_rows"] = lambda s, d: C.failing_rows(
        gold.fct_cart_abandonment(_enriched(s, d), as_of), C.failed_rows("abandonment_rate > 90")
    ).select("analysis_date", "category_id", "category_name", "abandonment_rate")
    q["dq_session_consistency"] = _session_consistency
    q["dq_ewma_anomaly"] = lambda s, d: ewma_anomalies(
        gold.fct_daily_revenue(_enriched(s, d), as_of), "revenue_date", "gross_revenue"
    )
    q["dq_ewma_anomaly_by_category"] = lambda s, d: ewma_anomalies(
        gold.fct_cart_abandonment(_enriched(s, d), as_of), "analysis_date", "abandonment_rate",
        ["category_id", "category_name"],
    )
    q["gate_outcome"] = lambda s, d: C.outcome_by_suite(K.scan(s, {"stg_clickstream": _silver(s, d)}, as_of=as_of))
    q["dq_scan"] = _scan
    # stored partial states
    q["daily_unique_users"] = _daily_unique_users
    # monitoring
    h_as_of = oracle.HEALTH_AS_OF
    q["bronze_health"] = lambda s, d: monitoring.bronze_health(td.bronze(s, d), h_as_of)
    q["bronze_health_warnings"] = lambda s, d: monitoring.bronze_health_warnings(
        monitoring.bronze_health(td.bronze(s, d), h_as_of), h_as_of
    )
    q["bronze_event_counts"] = lambda s, d: monitoring.bronze_event_counts(td.bronze(s, d), h_as_of)
    q["funnel_ratios"] = lambda s, d: monitoring.funnel_ratios(monitoring.bronze_event_counts(td.bronze(s, d), h_as_of))
    q["bronze_freshness"] = lambda s, d: monitoring.bronze_freshness(td.bronze(s, d), as_of)
    q["new_data_since"] = lambda s, d: monitoring.new_data_since(td.bronze(s, d), QK.SENSOR_CURSOR, h_as_of)
    # sessions
    q["sessionize"] = lambda s, d: sessions.sessionize(_silver(s, d)).select(
        "user_id", "event_id", "event_timestamp", "is_session_start", "session_seq"
    )
    q["session_progress"] = lambda s, d: sessions.session_progress(sessions.sessionize(_silver(s, d))).select(
        "user_id", "event_id", "session_seq", "current_step"
    )
    q["session_funnel_depth"] = lambda s, d: sessions.session_funnel_depth(sessions.sessionize(_silver(s, d)))
    return q


def _daily_unique_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct users a day and type, from hourly states whose users are numbered."""
    events = _enriched(spark, sf_dir).select("user_id", "event_type", "event_timestamp")
    states = distinct.user_states(events, distinct.numbered(events, "user_id"), by=("event_type",))
    return distinct.unique_users(states, "day", ("event_type",))


def _bronze_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.typed_projection(td.bronze(spark, sf_dir))


def _session_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from ..session import ensure_checkpoint_dir

    # three checks read silver: materialise it once, as the pipeline does when it writes the table
    ensure_checkpoint_dir(spark)
    stg = _silver(spark, sf_dir).checkpoint(eager=True)
    literal = sessions.session_consistency_literal(stg).agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit("session_consistency_literal").alias("check_name"), "violations"
    )
    strict = sessions.session_consistency_violations(stg)
    kinds = spark.createDataFrame([("shared_session",), ("interleaved",)], "check_name string")
    counts = strict.groupBy(F.col("violation").alias("check_name")).agg(F.count(F.lit(1)).alias("violations"))
    strict_counts = kinds.join(counts, "check_name", "left").select(
        "check_name", F.coalesce("violations", F.lit(0)).cast("long").alias("violations")
    )
    return literal.unionByName(strict_counts)


def _scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Every table is read by several checks (one aggregate pass, one pass per uniqueness check, the anomaly
    # series): materialise silver and the enriched events once in the shared checkpoint folder so the gold
    # tables and the checks do not recompute them from bronze.
    from ..session import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)
    stg = _silver(spark, sf_dir).checkpoint(eager=True)
    products = silver.stg_products(td.products(spark, sf_dir))
    enr = silver.enrich_with_products(stg, products).checkpoint(eager=True)
    tables = {
        "stg_clickstream": stg,
        "stg_products": products,
        # each gold table is read three times (aggregate pass, uniqueness shuffle, anomaly series); they hold
        # one row per day (and category), so materialising them is cheap
        "fct_daily_revenue": gold.fct_daily_revenue(enr, oracle.AS_OF).checkpoint(eager=True),
        "fct_conversion_funnel": gold.fct_conversion_funnel(enr, oracle.AS_OF).checkpoint(eager=True),
        "fct_cart_abandonment": gold.fct_cart_abandonment(enr, oracle.AS_OF).checkpoint(eager=True),
    }
    return K.scan(spark, tables, as_of=oracle.AS_OF)
