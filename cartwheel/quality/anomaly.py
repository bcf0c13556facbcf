"""EWMA anomaly detection on daily metrics, per series, with weekly seasonality.

Definition (the contract gives only method=ewma, interval=day, sensitivity=3, seasonality=7):

* residual ``r_d = x_d - x_{d-7}`` by calendar date (no value 7 days earlier -> no residual);
* history = residuals of the previous ``history_days`` (21) calendar days that exist;
* weights ``w_i = a (1 - a)^(i - 1)`` with ``i`` the age in days and ``a = 2 / (seasonality + 1)``;
* ``mu = sum(w r) / sum(w)``, ``sigma^2 = sum(w r^2) / sum(w) - mu^2`` (clamped at 0);
* status: ``no_residual`` | ``insufficient`` (fewer than ``min_history`` residuals) | ``anomalous``
  (``|r - mu| > sensitivity * sigma``) | ``normal``.

Spark plan: two aggregates by (series, day) over one read of the input; no join, window or list. Every value is sent
to its own day and a season on, which gives the residuals; every residual is sent to its own day and, weighted, to the
``history_days`` days after it, which gives the weighted sums. Both have partial sums on the executors, and the days
of a series are independent, so one long series is not one task. Nothing is computed while the plan is built.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_SEASONALITY = 7
DEFAULT_SENSITIVITY = 3.0
DEFAULT_HISTORY_DAYS = 21
DEFAULT_MIN_HISTORY = 7


def ewma_anomalies(
    df: DataFrame,
    date_col: str,
    value_col: str,
    series_cols: list[str] | None = None,
    seasonality: int = DEFAULT_SEASONALITY,
    sensitivity: float = DEFAULT_SENSITIVITY,
    history_days: int = DEFAULT_HISTORY_DAYS,
    min_history: int = DEFAULT_MIN_HISTORY,
) -> DataFrame:
    """Per (series, date): value, residual, mu, sigma, n_history, status. Input: one row per (series, date)."""
    keys = list(series_cols or [])
    alpha = 2.0 / (seasonality + 1)
    x = df.select(*keys, F.col(date_col).cast("date").alias("_d"), F.col(value_col).cast("double").alias("_v"))
    at = F.explode(F.array(F.lit(0), F.lit(seasonality))).alias("_after")
    sent = x.where(F.col("_d").isNotNull()).select(*keys, "_d", "_v", at)
    own = F.col("_after") == 0
    residuals = (
        sent.groupBy(*keys, F.date_add("_d", F.col("_after")).alias("metric_date"))
        .agg(
            F.max(F.when(own, F.col("_v"))).alias("value"),
            F.max(F.when(~own, F.col("_v"))).alias("_earlier"),
            F.max(own).alias("_here"),
        )
        .where("_here")
        .select(*keys, "metric_date", "value", (F.col("value") - F.col("_earlier")).alias("residual"))
    )
    # a residual reaches the days after it; a row without one is there for its own day only
    ages = F.when(F.col("residual").isNotNull(), F.sequence(F.lit(0), F.lit(history_days))).otherwise(F.array(F.lit(0)))
    sent = residuals.select(*keys, F.col("metric_date").alias("_d"), "value", "residual", F.explode(ages).alias("_age"))
    own, weight = F.col("_age") == 0, F.lit(alpha) * F.pow(F.lit(1.0 - alpha), (F.col("_age") - 1).cast("double"))

    def weighted(power: int):
        term = weight * F.pow(F.col("residual"), F.lit(float(power)))
        return F.coalesce(F.sum(F.when(~own, term)), F.lit(0.0))

    r = (
        sent.groupBy(*keys, F.date_add("_d", F.col("_age")).alias("metric_date"))
        .agg(
            F.max(F.when(own, F.col("value"))).alias("value"),
            F.max(F.when(own, F.col("residual"))).alias("residual"),
            F.max(own).alias("_here"),
            F.count_if(~own).alias("n_history"),
            weighted(0).alias("_sw"),
            weighted(1).alias("_swr"),
            weighted(2).alias("_swr2"),
        )
        .where("_here")
    )
    r = r.withColumn("_mu", F.try_divide(F.col("_swr"), F.nullif(F.col("_sw"), F.lit(0.0))))
    var = F.greatest(F.try_divide(F.col("_swr2"), F.nullif(F.col("_sw"), F.lit(0.0))) - F.col("_mu") * F.col("_mu"), F.lit(0.0))
    r = r.withColumn("_sigma", F.sqrt(var))
    status = (
        F.when(F.col("residual").isNull(), F.lit("no_residual"))
        .when(F.col("n_history") < min_history, F.lit("insufficient"))
        .when(F.abs(F.col("residual") - F.col("_mu")) > F.lit(sensitivity) * F.col("_sigma"), F.lit("anomalous"))
        .otherwise(F.lit("normal"))
    )
    return r.select(
        *keys,
        "metric_date",
        "value",
        F.round("residual", 6).alias("residual"),
        F.round("_mu", 6).alias("mu"),
        F.round("_sigma", 6).alias("sigma"),
        "n_history",
        status.alias("status"),
    )
