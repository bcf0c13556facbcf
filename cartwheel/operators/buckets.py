"""Fixed time buckets for ordered per-key work.

Gap sessions, running values and the cart -> purchase interval match need the events of one key in time order. One
window per key would send a hot key's whole history to one task. They run in partitions of (key, time bucket) and
stitch the buckets together with a one-row-per-bucket summary (a parallel prefix sum).

The bucket's width is a fixed parameter, the same for every key and every size of input, so building a plan starts no
job. Results are exact for any width: buckets of a key never overlap and their ordinals grow with time. A narrow
bucket bounds what one task holds of a hot key (one key with a third of a month's rows has 1 / 13,000 of all rows in
ten minutes); the summary has at most one row per event. Events of one key at one instant share a bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BUCKET = "10 minutes"


def time_bucket(t_col: str, bucket_us: int) -> Column:
    """Ordinal of the bucket of epoch microseconds: floor(t / bucket) in exact integer arithmetic, before 1970 too."""
    b = int(bucket_us)
    if b <= 0:
        raise ValueError("a bucket needs a positive width")
    return F.expr(f"(`{t_col}` - pmod(`{t_col}`, {b}L)) div {b}L")


def running_max(
    df: DataFrame, keys: list[str], t_col: str, order: list[str], value: str, bucket_us: int, out: str, last: int = 0
) -> DataFrame:
    """Add ``out``: the greatest ``value`` of the key's rows so far in ``order``, up to the row ``last`` places on
    (0 = the row itself, -1 = the row before); NULL where there is none. ``order`` starts with the time of ``t_col``.

    Two levels: a window inside (key, bucket), plus the greatest value of the key's earlier buckets.
    """
    bucketed = df.withColumn("_b", time_bucket(t_col, bucket_us))
    inside = Window.partitionBy(*keys, "_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, last)
    earlier = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    summary = bucketed.groupBy(*keys, "_b").agg(F.max(value).alias("_top"))
    summary = summary.select(*keys, "_b", F.max("_top").over(earlier).alias("_earlier"))
    joined = bucketed.withColumn("_inside", F.max(value).over(inside)).join(summary, [*keys, "_b"])
    # greatest() skips NULL
    return joined.withColumn(out, F.greatest("_inside", "_earlier")).drop("_b", "_inside", "_earlier")
