"""The table contracts of the clickstream tables, declared as data, and the scan that runs them.

Two suites per table, as declared upstream: ``schema_tests`` (column tests run after each build) and
``runtime_checks`` (metric checks run by the monitor). ``scan`` evaluates any subset over the given tables
and returns one DataFrame of results; ``gate`` (in ``checks``) turns it into a promotion decision.
"""

from __future__ import annotations

import datetime as _dt
import string
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import (
    BRONZE_SCHEMA,
    CURRENCIES,
    DEVICE_TYPES,
    FUNNEL_EVENT_TYPES,
    PRODUCT_COLUMNS,
    SILVER_REQUIRED_COLUMNS,
)
from . import checks as C
from .anomaly import ewma_anomalies

T = "schema_tests"
R = "runtime_checks"


@dataclass(frozen=True)
class AnomalyCheck:
    """EWMA check over a daily metric; the scan reports how many days were flagged (warn when > 0)."""

    metric: str
    date_col: str
    series_cols: tuple[str, ...] = ()
    suite: str = R

    @property
    def check_name(self) -> str:
        return f"anomaly({self.metric})"


@dataclass(frozen=True)
class SchemaCheck:
    required: tuple[str, ...]
    suite: str = R

    @property
    def types(self) -> dict[str, str]:
        """Declared types of the required event columns."""
        return {f.name: f.dataType.simpleString() for f in BRONZE_SCHEMA.fields if f.name in self.required}


def _not_null(cols, suite=T):
    return [C.missing(c, suite=suite) for c in cols]


def _at_least_zero(cols, suite=T):
    return [C.between(c, low=0, suite=suite) for c in cols]


CONTRACTS: dict[str, list] = {
    "stg_clickstream": [
        # schema tests (12)
        *_not_null(["event_id", "user_id", "session_id", "event_type", "event_timestamp", "processing_timestamp",
                    "ip_country"]),
        C.duplicates("event_id", suite=T),
        C.invalid("event_type", FUNNEL_EVENT_TYPES, suite=T),
        C.invalid("currency", CURRENCIES, suite=T),
        C.invalid("device_type", DEVICE_TYPES, suite=T),
        C.between("price", low=0, suite=T),
        # runtime checks (12)
        *_not_null(["user_id", "event_id", "event_type", "event_timestamp"], suite=R),
        C.duplicates("event_id", suite=R),
        C.invalid("event_type", FUNNEL_EVENT_TYPES, suite=R),
        C.invalid("device_type", DEVICE_TYPES, suite=R),
        C.invalid("currency", CURRENCIES, suite=R),
        C.min_at_least("price", 0, suite=R),
        C.freshness("event_timestamp", "2 hours", "1 hour", suite=R),
        C.row_count_above(100, suite=R),
        SchemaCheck(tuple(SILVER_REQUIRED_COLUMNS)),
    ],
    "stg_products": [
        *_not_null(PRODUCT_COLUMNS),
        C.duplicates("product_id", suite=T),
        C.between("price", low=0, suite=T),
    ],
    "fct_daily_revenue": [
        *_not_null(["revenue_date", "gross_revenue", "orders_count", "unique_buyers"]),
        C.duplicates("revenue_date", suite=T),
        *_at_least_zero(["gross_revenue", "orders_count", "avg_order_value", "unique_buyers"]),
        *_not_null(["revenue_date", "gross_revenue", "orders_count"], suite=R),
        C.duplicates("revenue_date", suite=R),
        C.min_at_least("gross_revenue", 0, suite=R),
        C.min_at_least("orders_count", 0, suite=R),
        C.min_at_least("unique_buyers", 0, suite=R),
        C.row_predicate("avg_order_value >= 0", suite=R),
        C.freshness("updated_at", "3 hours", "2 hours", suite=R),
        AnomalyCheck("gross_revenue", "revenue_date"),
    ],
    "fct_conversion_funnel": [
        *_not_null(["funnel_date", "page_views", "view_items", "add_to_carts", "purchases"]),
        C.duplicates("funnel_date", suite=T),
        *_at_least_zero(["page_views", "view_items", "add_to_carts", "purchases"]),
        *[
            C.between(c, low=0, high=100, suite=T)
            for c in ["conversion_rate_view", "conversion_rate_cart", "conversion_rate_purchase",
                      "overall_conversion_rate"]
        ],
        *_not_null(["funnel_date", "page_views", "view_items", "add_to_carts", "purchases"], suite=R),
        *[C.row_predicate(f"{c} >= 0", suite=R) for c in ["page_views", "view_items", "add_to_carts", "purchases"]],
        *[
            C.row_predicate(f"{c} {op} {v}", suite=R)
            for c in ["conversion_rate_view", "conversion_rate_cart", "conversion_rate_purchase",
                      "overall_conversion_rate"]
            for op, v in ((">=", 0), ("<=", 100))
        ],
        C.row_predicate("view_items <= page_views", suite=R),
        C.row_predicate("add_to_carts <= view_items", suite=R),
        C.row_predicate("purchases <= add_to_carts", suite=R),
        AnomalyCheck("overall_conversion_rate", "funnel_date"),
    ],
    "fct_cart_abandonment": [
        *_not_null(["category_id", "category_name", "analysis_date", "cart_additions", "completed_purchases",
                    "abandoned_carts", "abandonment_rate"]),
        *_at_least_zero(["cart_additions", "completed_purchases", "abandoned_carts"]),
        C.between("abandonment_rate", low=0, high=100, suite=T),
        C.between("revenue_lost", low=0, suite=T),
        *_not_null(["category_id", "category_name", "analysis_date", "cart_additions", "completed_purchases",
                    "abandoned_carts", "abandonment_rate", "revenue_lost"], suite=R),
        *[C.row_predicate(f"{c} >= 0", suite=R)
          for c in ["cart_additions", "completed_purchases", "abandoned_carts", "revenue_lost"]],
        C.row_predicate("abandonment_rate >= 0", suite=R),
        C.row_predicate("abandonment_rate <= 100", suite=R),
        C.row_predicate("abandoned_carts = cart_additions - completed_purchases", suite=R),
        AnomalyCheck("abandonment_rate", "analysis_date", ("category_id", "category_name")),
        C.failed_rows("abandonment_rate > 90", suite=R),
    ],
}


def bind_variables(check, variables: dict[str, str]):
    """Substitute ``${name}`` placeholders of a check expression (unknown names are left as written)."""
    if isinstance(check, C.Check) and check.expr and "${" in check.expr:
        return replace(check, expr=string.Template(check.expr).safe_substitute(variables))
    return check


def contract_size() -> dict[str, tuple[int, int]]:
    """(schema tests, runtime checks) per table."""
    out = {}
    for table, items in CONTRACTS.items():
        out[table] = (sum(1 for c in items if c.suite == T), sum(1 for c in items if c.suite == R))
    return out


def _anomaly_result(df: DataFrame, table: str, chk: AnomalyCheck) -> DataFrame:
    flagged = ewma_anomalies(df, chk.date_col, chk.metric, list(chk.series_cols))
    return flagged.agg(F.count_if(F.col("status") == "anomalous").cast("double").alias("measured")).select(
        F.lit(chk.suite).alias("suite"),
        F.lit(table).alias("table_name"),
        F.lit(chk.check_name).alias("check_name"),
        F.lit(chk.metric).alias("column_name"),
        "measured",
        F.lit(0.0).alias("threshold"),
        F.when(F.col("measured") > 0, F.lit("warn")).otherwise(F.lit("pass")).alias("outcome"),
    )


def scan(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    as_of: str | _dt.datetime | Column | None = None,
    suites: tuple[str, ...] = (T, R),
    include_anomaly: bool = True,
    include_schema: bool = True,
    variables: dict[str, str] | None = None,
    contracts: dict[str, list] | None = None,
) -> DataFrame:
    """Run the declared contracts of every table present in ``tables``; one result row per check.

    ``variables`` are bound into check expressions written with ``${name}`` placeholders (``${table}`` is
    always the table being checked). A table name without a contract raises (a missing check path is an
    error, not a silent pass). Each table is read by several checks (one aggregate pass, one shuffle for the
    uniqueness checks, the anomaly series), so pass stored tables or checkpoints, not lazy plans.
    """
    declared = contracts or CONTRACTS
    parts = []
    for name, df in tables.items():
        if name not in declared:
            raise KeyError(f"no contract declared for table {name!r}")
        binding = {"table": name, **(variables or {})}
        items = [bind_variables(c, binding) for c in declared[name] if c.suite in suites]
        plain = [c for c in items if isinstance(c, C.Check)]
        if plain:
            parts.append(C.run_checks(df, name, plain, as_of))
        for c in items:
            if isinstance(c, AnomalyCheck) and include_anomaly:
                parts.append(_anomaly_result(df, name, c))
            elif isinstance(c, SchemaCheck) and include_schema:
                parts.append(C.schema_check(spark, df, name, list(c.required), c.types, suite=c.suite))
    return reduce(DataFrame.unionByName, parts)
