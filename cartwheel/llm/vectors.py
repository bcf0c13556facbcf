"""Vectors of whole numbers: floats scaled and floored, as Spark columns and as numpy matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Scaled components lie within plus and minus this bound, so sums of 1,024 squared differences fit 64 bits.
LIMIT = 1 << 25


def whole_vectors(rows: DataFrame, vector: str, factor: int, keep: dict[str, Column]) -> DataFrame:
    """Columns ``keep`` and ``x``: floor(factor * component) of every component, array<long>.

    Rows whose vector is null or holds a null or non-finite component are left out. Scaled components beyond
    ``LIMIT`` are set to that bound. Names of other columns of ``rows`` don't matter.
    """
    parts = rows.select(*[c.alias(n) for n, c in keep.items()], F.col(vector).cast("array<double>").alias("x"))
    finite = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    scaled = F.transform(
        "x", lambda v: F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), F.floor(v * F.lit(float(factor))))).cast("long")
    )
    return parts.where(F.col("x").isNotNull() & F.coalesce(finite, F.lit(False))).withColumn("x", scaled)


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """The rows of a list column as an int64 matrix; shorter rows end in zeros."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    offsets = flat.offsets.to_numpy().astype(np.int64)
    values = flat.values.to_numpy(zero_copy_only=False).astype(np.int64, copy=False)[offsets[0] : offsets[-1]]
    sizes = np.diff(offsets)
    if (sizes == width).all():
        return values.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = values
    return out


def limbs(x: np.ndarray, width: int) -> list[np.ndarray]:
    """``x`` as sum of limbs[i] << (width * i), each limb at most 2 ** (width - 1) in size, as float64; at least one."""
    half, found = 1 << (width - 1), []
    rest = x
    while True:
        low = ((rest + half) & ((1 << width) - 1)) - half
        found.append(low.astype(np.float64))
        rest = (rest - low) >> width
        if not rest.any():
            return found


def exact_dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b.T`` of int64 matrices, exact where the result fits 64 bits.

    The integers are broken into limbs so narrow that every sum of products stays within 2 ** 53, where float64
    products by BLAS are exact; the partial products are put together again in int64.
    """
    depth = max(1, a.shape[1])
    width = (55 - (depth - 1).bit_length()) // 2
    total = np.zeros((a.shape[0], b.shape[0]), np.int64)
    right = limbs(b, width)
    for i, x in enumerate(limbs(a, width)):
        for j, y in enumerate(right):
            total += (x @ y.T).astype(np.int64) << (width * (i + j))
    return total
