"""Packing into optimal length buckets.

Documents are cut into segments of at most ``context`` tokens, so the histogram of segment lengths has at most
``context`` rows whatever the corpus. Dynamic programming over that histogram picks the bucket boundaries with the
least padding in all. Inside a bucket, segments in a fixed order fill batches of ``token_budget`` padded tokens.

The place of a segment in its bucket is a global rank made in two levels, places within hash chunks of about
``CHUNK`` segments plus the sizes of the chunks before. Chunks go by the segment's number in the stored table, so a bucket, a
doc_id or null ids with a third of all rows are spread over tasks.

Documents without tokens (null or empty texts) take part with one row of length 0 and no bucket or batch. Rows that
repeat a doc_id are packed each for itself; a null doc_id is packed like any other.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

CHUNK = 100_000


@dataclass(frozen=True)
class Packing:
    context: int = 2048
    buckets: int = 8
    token_budget: int = 65536


def boundaries(histogram: dict[int, int], most: int) -> list[int]:
    """At most ``most`` bucket lengths with the least padding, ascending; the last is the greatest length.

    ``best[j]`` is the least padding of the j shortest lengths; with one more bucket it is the least over i of
    ``best[i] + length[j] * (count[j] - count[i]) - (tokens[j] - tokens[i])``: lines in ``length[j]`` of falling slope
    ``-count[i]``, so the lower envelope is kept as a queue. Ties take the earlier line.
    """
    lengths = sorted(k for k, n in histogram.items() if n > 0)
    if not lengths:
        return []
    count, tokens = [0], [0]
    for k in lengths:
        count.append(count[-1] + histogram[k])
        tokens.append(tokens[-1] + k * histogram[k])
    m = len(lengths)
    best: list[int | None] = [0] + [None] * m
    cuts: list[list[int]] = []
    for _ in range(min(most, m)):
        after: list[int | None] = [None] * (m + 1)
        cut = [0] * (m + 1)
        queue: list[tuple[int, int, int]] = []  # slope, intercept, i
        head = 0
        for j in range(1, m + 1):
            if best[j - 1] is not None:
                line = (-count[j - 1], best[j - 1] + tokens[j - 1], j - 1)
                while len(queue) - head >= 2:
                    (a1, b1, _), (a2, b2, _) = queue[-2], queue[-1]
                    if (line[1] - b1) * (a1 - a2) > (b2 - b1) * (a1 - line[0]):
                        break
                    queue.pop()
                queue.append(line)
            if len(queue) <= head:
                continue
            x = lengths[j - 1]
            while len(queue) - head >= 2 and queue[head + 1][0] * x + queue[head + 1][1] < queue[head][0] * x + queue[head][1]:
                head += 1
            slope, intercept, cut[j] = queue[head]
            after[j] = slope * x + intercept + x * count[j] - tokens[j]
        best = after
        cuts.append(cut)
    found, j = [], m
    for cut in reversed(cuts):
        if j == 0:
            break
        found.append(lengths[j - 1])
        j = cut[j]
    return found[::-1]


def segments(lengths: DataFrame, context: int) -> DataFrame:
    """doc_id, segment, start and length from rows (doc_id, n_tokens)."""
    last = F.greatest(F.ceil(F.col("n_tokens") / context) - 1, F.lit(0)).cast("long")
    rows = lengths.select("doc_id", "n_tokens", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("segment"))
    start = F.col("segment") * context
    return rows.select(
        "doc_id", "segment", start.alias("start"), F.least(F.lit(context), F.col("n_tokens") - start).alias("length")
    )


def pack(lengths: DataFrame, conf: Packing = Packing()) -> DataFrame:
    """doc_id, segment, start, length, bucket_length, batch and place of every segment of rows (doc_id, n_tokens)."""
    # numbered before they are stored, so rows that share a doc_id can be parted and a repeated task deals them alike
    cut = stored(segments(lengths, conf.context).withColumn("_row", F.monotonically_increasing_id()), "segments")
    full = cut.where("length > 0")
    histogram = {r["length"]: r["n"] for r in full.groupBy("length").agg(F.count("*").alias("n")).collect()}
    bounds = boundaries(histogram, conf.buckets)
    bucket = F.lit(None).cast("long")
    for b in reversed(bounds):
        bucket = F.when(F.col("length") <= b, F.lit(b).cast("long")).otherwise(bucket)
    chunks = 1 + sum(histogram.values()) // CHUNK
    rows = full.select(
        "*",
        bucket.alias("bucket_length"),
        F.pmod(F.xxhash64("_row"), F.lit(chunks)).alias("_chunk"),
    )
    sizes = rows.groupBy("bucket_length", "_chunk").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy("bucket_length").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("bucket_length", "_chunk", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    within = Window.partitionBy("bucket_length", "_chunk").orderBy("doc_id", "segment", "length", "_row")
    ranked = rows.withColumn("_rank", F.row_number().over(within) - 1).join(sizes, ["bucket_length", "_chunk"])
    place = F.col("_rank") + F.col("_before")
    rows_a_batch = F.greatest(F.lit(1), F.floor(F.lit(conf.token_budget) / F.col("bucket_length")))
    packed = ranked.select(
        "doc_id",
        "segment",
        "start",
        "length",
        "bucket_length",
        F.floor(place / rows_a_batch).cast("long").alias("batch"),
        F.pmod(place, rows_a_batch).cast("long").alias("place"),
    )
    nothing = [F.lit(None).cast("long").alias(c) for c in ("bucket_length", "batch", "place")]
    return packed.unionByName(cut.where("length <= 0").select("doc_id", "segment", "start", "length", *nothing))
