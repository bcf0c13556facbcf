"""Data-quality checks as data, evaluated with built-in Spark aggregates.

A ``Check`` describes one contract line (``missing_count(user_id) = 0``, ``min(price) >= 0``, ...). ``run_checks``
evaluates every aggregate-kind check of a table in **one** ``agg`` pass (one scan, partial aggregation on the
executors, a single result row), and each uniqueness check with one ``groupBy``. The result is a DataFrame with
one row per check::

    suite, table_name, check_name, column_name, measured DOUBLE, threshold DOUBLE, outcome ('pass'|'warn'|'fail')
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import ts_literal

RESULT_SCHEMA = T.StructType(
    [
        T.StructField("suite", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("check_name", T.StringType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("measured", T.DoubleType()),
        T.StructField("threshold", T.DoubleType()),
        T.StructField("outcome", T.StringType()),
    ]
)
RESULT_COLUMNS = [f.name for f in RESULT_SCHEMA.fields]
SEVERITY = {"pass": 0, "warn": 1, "fail": 2}

# Check kinds evaluated as aggregates in the shared pass.
AGG_KINDS = {
    "missing_count",
    "invalid_count",
    "between",
    "min_at_least",
    "max_at_most",
    "row_predicate",
    "failed_rows",
    "row_count_above",
    "freshness",
}


@dataclass(frozen=True)
class Check:
    """One contract line.

    kind            measured value                               fails when
    missing_count   rows where column IS NULL                    measured > threshold (default 0)
    duplicate_count distinct non-null values seen more than once measured > threshold
    invalid_count   non-null values outside ``values``           measured > threshold
    between         non-null values outside [low, high]          measured > threshold
    min_at_least    min(column)                                  measured < threshold
    max_at_most     max(column)                                  measured > threshold
    row_predicate   rows where ``expr`` is false (NULL passes)   measured > threshold
    failed_rows     rows where ``expr`` is true                  measured > threshold
    row_count_above count(*)                                     measured <= threshold
    freshness       seconds from max(column) to ``as_of``        measured >= threshold (warn >= warn_threshold);
                                                                 no rows at all = fail
    """

    kind: str
    column: str | None = None
    threshold: float = 0.0
    values: tuple[str, ...] = ()
    low: float | None = None
    high: float | None = None
    expr: str | None = None
    warn_threshold: float | None = None
    name: str | None = None
    suite: str = "contract"

    @property
    def check_name(self) -> str:
        if self.name:
            return self.name
        if self.kind in ("row_predicate", "failed_rows"):
            return f"{self.kind}({self.expr})"
        return f"{self.kind}({self.column})" if self.column else self.kind

    # measured value as an aggregate expression ------------------------------------------------------------
    def measure(self, as_of: Column | None) -> Column:
        c = F.col(self.column) if self.column else None
        k = self.kind
        if k == "missing_count":
            return F.count_if(c.isNull())
        if k == "invalid_count":
            return F.count_if(c.isNotNull() & ~c.isin(list(self.values)))
        if k == "between":
            ok = F.lit(True)
            if self.low is not None:
                ok = ok & (c >= F.lit(self.low))
            if self.high is not None:
                ok = ok & (c <= F.lit(self.high))
            return F.count_if(c.isNotNull() & ~ok)
        if k == "min_at_least":
            return F.min(c)
        if k == "max_at_most":
            return F.max(c)
        if k == "row_predicate":
            return F.count_if(~F.coalesce(F.expr(self.expr), F.lit(True)))
        if k == "failed_rows":
            return F.count_if(F.coalesce(F.expr(self.expr), F.lit(False)))
        if k == "row_count_above":
            return F.count(F.lit(1))
        if k == "freshness":
            if as_of is None:
                raise ValueError("freshness checks need as_of")
            return F.timestamp_diff("SECOND", F.max(c), as_of)
        raise ValueError(f"not an aggregate check kind: {k}")

    def outcome(self, measured: Column) -> Column:
        thr = F.lit(float(self.threshold))
        k = self.kind
        if k == "min_at_least":
            bad = measured < thr
        elif k == "row_count_above":
            bad = measured <= thr
        elif k == "freshness":
            bad = measured.isNull() | (measured >= thr)
            warn = (
                (measured >= F.lit(float(self.warn_threshold))) if self.warn_threshold is not None else F.lit(False)
            )
            return F.when(bad, "fail").when(warn, "warn").otherwise("pass")
        else:
            bad = measured > thr
        return F.when(F.coalesce(bad, F.lit(False)), "fail").otherwise("pass")


def missing(column: str, **kw) -> Check:
    return Check("missing_count", column, **kw)


def duplicates(column: str, **kw) -> Check:
    return Check("duplicate_count", column, **kw)


def invalid(column: str, values, **kw) -> Check:
    return Check("invalid_count", column, values=tuple(values), **kw)


def between(column: str, low: float | None = None, high: float | None = None, **kw) -> Check:
    return Check("between", column, low=low, high=high, **kw)


def min_at_least(column: str, value: float, **kw) -> Check:
    return Check("min_at_least", column, threshold=value, **kw)


def row_predicate(expr: str, **kw) -> Check:
    return Check("row_predicate", expr=expr, **kw)


def failed_rows(expr: str, **kw) -> Check:
    return Check("failed_rows", expr=expr, **kw)


def row_count_above(n: int, **kw) -> Check:
    return Check("row_count_above", threshold=n, **kw)


def freshness(column: str, fail_after: str, warn_after: str | None = None, **kw) -> Check:
    from ..functions.columns import duration_micros

    fail_s = duration_micros(fail_after) / 1e6
    warn_s = duration_micros(warn_after) / 1e6 if warn_after else None
    return Check("freshness", column, threshold=fail_s, warn_threshold=warn_s, **kw)


def _result_row(chk: Check, table: str, measured: Column) -> Column:
    m = measured.cast("double")
    return F.struct(
        F.lit(chk.suite).alias("suite"),
        F.lit(table).alias("table_name"),
        F.lit(chk.check_name).alias("check_name"),
        F.lit(chk.column).cast("string").alias("column_name"),
        m.alias("measured"),
        F.lit(float(chk.threshold)).alias("threshold"),
        chk.outcome(m).alias("outcome"),
    )


def _duplicate_results(df: DataFrame, dup_checks: list[Check], table: str) -> DataFrame:
    """All uniqueness checks of a table in one shuffle.

    Each row is unpivoted into (column, value) pairs for the checked columns, counted per pair (partial counts
    combine on the map side, so a value repeated millions of times ships one partial count per task), and the
    values seen more than once are counted per column. Identical checks (e.g. the same column in two suites)
    share the work.
    """
    cols = sorted({c.column for c in dup_checks})
    pairs = F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in cols])
    dup_per_col = (
        df.select(F.inline(pairs))
        .where(F.col("v").isNotNull())
        .groupBy("c", "v")
        .count()
        .where(F.col("count") > 1)
        .groupBy("c")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    measured = {c: F.coalesce(F.max(F.when(F.col("c") == c, F.col("n"))), F.lit(0)) for c in cols}
    one = dup_per_col.agg(*[measured[c].alias(f"d{i}") for i, c in enumerate(cols)])
    idx = {c: i for i, c in enumerate(cols)}
    rows = F.array(*[_result_row(chk, table, F.col(f"d{idx[chk.column]}")) for chk in dup_checks])
    return one.select(F.inline(rows))


def run_checks(
    df: DataFrame,
    table: str,
    checks: list[Check],
    as_of: str | _dt.datetime | Column | None = None,
) -> DataFrame:
    """Evaluate ``checks`` over ``df``; one row per check (see module docstring)."""
    as_col = None if as_of is None else (as_of if isinstance(as_of, Column) else ts_literal(as_of))
    parts: list[DataFrame] = []
    agg_checks = [c for c in checks if c.kind in AGG_KINDS]
    if agg_checks:
        one = df.agg(*[c.measure(as_col).alias(f"m{i}") for i, c in enumerate(agg_checks)])
        rows = F.array(*[_result_row(c, table, F.col(f"m{i}")) for i, c in enumerate(agg_checks)])
        parts.append(one.select(F.inline(rows)))
    dup_checks = [c for c in checks if c.kind == "duplicate_count"]
    if dup_checks:
        parts.append(_duplicate_results(df, dup_checks, table))
    for c in checks:
        if c.kind not in AGG_KINDS and c.kind != "duplicate_count":
            raise ValueError(f"unknown check kind {c.kind}")
    if not parts:
        return df.sparkSession.createDataFrame([], RESULT_SCHEMA)
    return reduce(DataFrame.unionByName, parts)


def failing_rows(df: DataFrame, chk: Check) -> DataFrame:
    """The rows a row-level check rejects (for quarantine or inspection)."""
    c = F.col(chk.column) if chk.column else None
    k = chk.kind
    if k == "missing_count":
        return df.where(c.isNull())
    if k == "invalid_count":
        return df.where(c.isNotNull() & ~c.isin(list(chk.values)))
    if k == "between":
        ok = F.lit(True)
        if chk.low is not None:
            ok = ok & (c >= chk.low)
        if chk.high is not None:
            ok = ok & (c <= chk.high)
        return df.where(c.isNotNull() & ~ok)
    if k == "row_predicate":
        return df.where(~F.coalesce(F.expr(chk.expr), F.lit(True)))
    if k == "failed_rows":
        return df.where(F.coalesce(F.expr(chk.expr), F.lit(False)))
    raise ValueError(f"{k} has no row-level failures")


# ---------------------------------------------------------------------------------------------------------
# Custom tests (Q-05, Q-06): the rows they return are the failures.
# ---------------------------------------------------------------------------------------------------------
def valid_event_type_failures(df: DataFrame, column: str = "event_type", values=None) -> DataFrame:
    """Rows whose value is ``NOT IN`` the funnel steps; NULL passes (SQL three-valued logic)."""
    from ..schemas import FUNNEL_EVENT_TYPES

    vals = list(values or FUNNEL_EVENT_TYPES)
    return df.where(~F.col(column).isin(vals))


def positive_price_failures(df: DataFrame, column: str = "price") -> DataFrame:
    """Rows with a non-NULL price that is zero or negative."""
    return df.where(F.col(column).isNotNull() & (F.col(column) <= 0))


# ---------------------------------------------------------------------------------------------------------
# Schema check (Q-13): compares metadata only, no data is read.
# ---------------------------------------------------------------------------------------------------------
def schema_check(
    spark: SparkSession,
    df: DataFrame,
    table: str,
    required: list[str],
    expected_types: dict[str, str] | None = None,
    forbidden: list[str] | None = None,
    suite: str = "contract",
) -> DataFrame:
    """Fail when a required column is missing; warn when a type changed or a forbidden column is present."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    missing_cols = [c for c in required if c not in actual]
    changed = [c for c, t in (expected_types or {}).items() if c in actual and actual[c] != t]
    present_forbidden = [c for c in (forbidden or []) if c in actual]
    rows = [
        (suite, table, "schema(required columns)", ",".join(missing_cols) or None, float(len(missing_cols)), 0.0,
         "fail" if missing_cols else "pass"),
        (suite, table, "schema(column types)", ",".join(changed) or None, float(len(changed)), 0.0,
         "warn" if changed else "pass"),
        (suite, table, "schema(forbidden columns)", ",".join(present_forbidden) or None, float(len(present_forbidden)),
         0.0, "warn" if present_forbidden else "pass"),
    ]
    return spark.createDataFrame(rows, RESULT_SCHEMA)


def _worst() -> Column:
    return F.max(F.when(F.col("outcome") == "fail", 2).when(F.col("outcome") == "warn", 1).otherwise(0))


def outcome_by_suite(results: DataFrame) -> DataFrame:
    """suite, its worst outcome and its number of checks."""
    return results.groupBy("suite").agg(_worst().alias("_s"), F.count("*").alias("checks")).select(
        "suite",
        F.when(F.col("_s") == 2, F.lit("fail")).when(F.col("_s") == 1, F.lit("warn")).otherwise(F.lit("pass")).alias("outcome"),
        "checks",
    )


def overall_outcome(results: DataFrame) -> str:
    """Worst outcome of a result set (a single aggregated row reaches the driver)."""
    row = results.agg(_worst().alias("s")).first()
    s = 0 if row is None or row["s"] is None else row["s"]
    return {0: "pass", 1: "warn", 2: "fail"}[s]


class ContractFailure(RuntimeError):
    """Raised by the promotion gate when a contract fails."""


def gate(results: DataFrame, block_on: str = "fail") -> str:
    """Promotion gate: raise ``ContractFailure`` when the worst outcome reaches ``block_on``."""
    outcome = overall_outcome(results)
    if SEVERITY[outcome] >= SEVERITY[block_on]:
        failed = results.where(F.col("outcome") == outcome).select("table_name", "check_name").collect()
        raise ContractFailure(f"contract outcome {outcome}: " + ", ".join(f"{r[0]}.{r[1]}" for r in failed))
    return outcome


__all__ = [
    "Check",
    "RESULT_SCHEMA",
    "RESULT_COLUMNS",
    "run_checks",
    "failing_rows",
    "missing",
    "duplicates",
    "invalid",
    "between",
    "min_at_least",
    "row_predicate",
    "failed_rows",
    "row_count_above",
    "freshness",
    "valid_event_type_failures",
    "positive_price_failures",
    "schema_check",
    "outcome_by_suite",
    "overall_outcome",
    "gate",
    "ContractFailure",
    "field",
]
