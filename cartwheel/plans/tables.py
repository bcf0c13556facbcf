"""Materialisation of models: temporary view or partitioned, clustered Parquet table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def materialize(
    df: DataFrame,
    name: str,
    materialized: str = "table",
    path: str | None = None,
    partition_by: str | None = None,
    cluster_by: Sequence[str] = (),
    mode: str = "overwrite",
    spread_by: str = "event_id",
    curve: bool = False,
) -> DataFrame:
    """Make a model available under ``name``.

    * ``view``: a temporary view over the plan (recomputed by each reader).
    * ``table``: written to ``path`` as Parquet, one directory per ``partition_by`` value, rows sorted by
      ``cluster_by`` inside each file so Parquet min/max statistics skip row groups. Rows are range-partitioned
      on (partition, cluster keys, hash of ``spread_by`` where the table has that column): a large day is split over
      many tasks and each task writes few files, and rows that share all cluster keys can still be parted.
      ``curve`` sorts by a space-filling curve over the cluster columns instead, so that a filter on any of them skips
      files and row groups, not only one on the first.
      With ``mode="overwrite"`` only the partitions present in ``df`` are replaced (dynamic overwrite), so
      re-running a window rewrites just the days it touched. The table is read back and registered, which
      also cuts the lineage for downstream models.
    """
    if materialized == "view":
        df.createOrReplaceTempView(name)
        return df
    if materialized != "table":
        raise ValueError(f"unknown materialization {materialized!r}")
    if path is None:
        raise ValueError("a table needs a path")
    keys = ([partition_by] if partition_by else []) + list(cluster_by)
    if curve and cluster_by:
        keys = ([partition_by] if partition_by else []) + [curve_place(df, list(cluster_by))]
    out = df
    if keys:
        spread = [F.xxhash64(spread_by)] if spread_by in df.columns else []
        out = out.repartitionByRange(*keys, *spread).sortWithinPartitions(*keys)
    writer = out.write.mode(mode).option("partitionOverwriteMode", "dynamic")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    # read back with the known schema (partition column last): no inference, and an empty result still reads
    fields = [f for f in df.schema.fields if f.name != partition_by]
    fields += [f for f in df.schema.fields if f.name == partition_by]
    table = df.sparkSession.read.schema(T.StructType(fields)).parquet(path)
    table.createOrReplaceTempView(name)
    return table


CURVE_SAMPLE = 10_000
CURVE_BITS = 5


def _at_most(column: str):
    return lambda bound: bound <= F.col(column)


def curve_place(df: DataFrame, columns: Sequence[str], bits: int = CURVE_BITS) -> Column:
    """The place of a row on a Z-order curve over ``columns``.

    Each column is ranked among the ``2 ** bits - 1`` quantiles of a sample of ``CURVE_SAMPLE`` rows (chosen by hash), so values
    of any type and skew spread evenly, and the bits of the ranks are interleaved, highest first. NULL ranks lowest.
    """
    rows = df.select(*columns).orderBy(F.xxhash64(*df.columns)).limit(CURVE_SAMPLE).collect()
    place = F.lit(0).cast("long")
    for k, c in enumerate(columns):
        values = sorted(r[c] for r in rows if r[c] is not None)
        bounds = sorted({values[len(values) * i >> bits] for i in range(1, 1 << bits)}) if values else []
        rank = F.lit(0)
        if bounds:
            known = F.array(*[F.lit(b) for b in bounds])
            rank = F.when(F.col(c).isNull(), F.lit(0)).otherwise(F.size(F.filter(known, _at_most(c))))
        for i in range(bits):
            bit = F.shiftright(rank, i).bitwiseAND(F.lit(1)).cast("long")
            place = place + F.shiftleft(bit, i * len(columns) + len(columns) - 1 - k)
    return place


# Layout of the models (partition column, cluster columns), as declared for the warehouse tables.
LAYOUT = {
    "stg_clickstream": ("event_date", ("user_id", "event_type")),
    "int_enriched_clickstream": ("event_date", ("user_id", "event_type", "category_id")),
    "stg_products": (None, ("category_id", "brand")),
    "fct_daily_revenue": ("revenue_date", ()),
    "fct_conversion_funnel": ("funnel_date", ()),
    "fct_cart_abandonment": ("analysis_date", ("category_id",)),
}
