"""Join helpers: a size-checked broadcast and a skew-safe left join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A dimension is broadcast only when its values are proven to take at most this many bytes.
DEFAULT_BROADCAST_MAX_BYTES = 64 << 20
ROW_BYTES, VALUE_BYTES = 64, 16  # what a row and a value take beside the value's own text


def fits_broadcast(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_MAX_BYTES) -> bool:
    """True when the rows of ``df`` take at most ``max_bytes``: every value as text, plus the overhead of rows and values.

    One aggregate with partial sums on the executors; no rows are gathered.
    """
    if max_bytes <= 0:
        return False
    row = F.lit(ROW_BYTES + VALUE_BYTES * len(df.columns)).cast("long")
    for c in df.columns:
        row = row + F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0))
    return (df.agg(F.sum(row)).first()[0] or 0) <= max_bytes


def null_safe_key(key: Column, spread: Column, prefix: str = "\u0000null:") -> Column:
    """Join key where NULLs are replaced by distinct, never-matching values.

    A left join hashes every NULL key to one partition; when a third of the rows have no key that one task
    gets a third of the data. Replacing NULL by ``prefix || spread`` (a per-row unique value) spreads those
    rows over all partitions; they still find no partner, exactly like NULL.
    """
    return F.coalesce(key, F.concat(F.lit(prefix), spread.cast("string")))


def left_join_dimension(
    facts: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    spread_col: str,
    broadcast_max_bytes: int = DEFAULT_BROADCAST_MAX_BYTES,
) -> DataFrame:
    """``facts LEFT JOIN dim ON facts.fact_key = dim.dim_key``, choosing the strategy by checked size.

    Small dimension: broadcast hash join, no shuffle of the facts. Large dimension: sort-merge join on a
    NULL-spread key so rows without a key do not pile up in one task; a hot key is split by AQE's skew join.
    ``dim_key`` must be unique in ``dim``.
    """
    if fits_broadcast(dim, broadcast_max_bytes):
        return facts.join(F.broadcast(dim), facts[fact_key] == dim[dim_key], "left")
    jk = "__join_key"
    left = facts.withColumn(jk, null_safe_key(F.col(fact_key), F.col(spread_col)))
    return left.join(dim, left[jk] == dim[dim_key], "left").drop(jk)
