"""Vector code compression: every vector becomes one short code a part, by product quantisation in whole numbers.

Vectors of floor(factor * component) are cut into ``parts`` equal consecutive parts. Each part position has a codebook of
at most ``entries`` entries. It starts as that part of the vectors of smallest vec_id. In each round every part is
assigned to the nearest entry (squared distance, ties to the lower index), and an entry becomes floor(sum / count) of its
parts, component by component; an entry without parts stays. Finally all parts are assigned once more.

Everything is exact, so the result does not depend on how the rows are dealt out. The nearest entry is the first least of
``c . c - 2 x . c``; the dot products are matrix products of limbs (``vectors.exact_dots``) and are put together in int64.

A round is one pass over the stored vectors: each task gives one sum a component of every entry, whatever its number of
rows, and Spark adds these up. Only the codebooks (``entries`` vectors) pass through the driver and go to the tasks.

Vectors that are null or hold null or non-finite components take no part. Components are bounded as ``vectors`` says.
Shorter vectors count as ending in zeros, and the width is rounded up to a multiple of ``parts``. Rows that repeat a vec_id
are coded each for itself; a null vec_id is carried and comes last when the codebooks start, and rows with one vec_id are
ordered there by their components. Empty tables give no rows. Sums of errors beyond 64 bits are null.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import fits_broadcast
from .common import ship, stored
from .vectors import exact_dots, matrix, whole_vectors

SALTS = 64


@dataclass(frozen=True)
class Codec:
    factor: int = 4096
    parts: int = 8
    entries: int = 16
    rounds: int = 6


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry of every row of ``x`` (the first one, if several) and the squared distance to it."""
    gap = (entries * entries).sum(axis=1)[None, :] - 2 * exact_dots(x, entries)
    index = gap.argmin(axis=1)
    return index, gap[np.arange(len(x)), index] + (x * x).sum(axis=1)


def _cut(batch: pa.RecordBatch, width: int, parts: int) -> np.ndarray:
    column = batch.column(batch.schema.get_field_index("x"))
    return matrix(column, width).reshape(batch.num_rows, parts, width // parts)


def _sums(books: np.ndarray):
    """Of every part position and entry: the number of parts assigned (place -1) and their sum at each place."""
    parts, entries, depth = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros((parts, entries), np.int64)
        total = np.zeros((parts, entries, depth), np.int64)
        for batch in batches:
            x = _cut(batch, parts * depth, parts)
            for p in range(parts):
                index, _ = nearest(x[:, p], books[p])
                count[p] += np.bincount(index, minlength=entries)
                np.add.at(total[p], index, x[:, p])
        places = np.concatenate([count[:, :, None], total], axis=2)
        p, k, at = (axis.ravel() for axis in np.indices(places.shape))
        used = count[p, k] > 0
        columns = [p[used], k[used], at[used] - 1, places.ravel()[used]]
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], ["part", "entry", "place", "n"])

    return run


def learn(vectors: DataFrame, width: int, conf: Codec) -> np.ndarray:
    """The codebooks (parts, entries, places) from rows (vec_id, x): ``rounds`` passes."""
    first = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "x").select("x").limit(conf.entries).collect()
    if not first:
        return np.zeros((conf.parts, 1, width // conf.parts), np.int64)  # of no rows
    books = np.zeros((len(first), width), np.int64)
    for k, r in enumerate(first):
        books[k, : len(r["x"])] = r["x"]
    books = np.ascontiguousarray(books.reshape(len(first), conf.parts, width // conf.parts).transpose(1, 0, 2))
    kinds = "part long, entry long, place long, n long"
    for _ in range(conf.rounds):
        sums = vectors.select("x").mapInArrow(_sums(books), kinds)
        sums = sums.groupBy("part", "entry", "place").agg(F.sum(F.col("n").cast("decimal(38,0)")).alias("n"))
        found = {(r["part"], r["entry"], r["place"]): int(r["n"]) for r in sums.collect()}
        books = books.copy()
        for (p, k, at), n in found.items():
            if at >= 0:
                books[p, k, at] = n // found[p, k, -1]
    return books


def books_digest(books: np.ndarray) -> str:
    """sha256 of all components, by part, entry and place, as decimal numbers joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def _codes(books: np.ndarray):
    parts, entries, depth = books.shape
    digits = max(2, len(f"{entries - 1:x}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _cut(batch, parts * depth, parts)
            codes, error = np.empty((len(x), parts), np.int64), np.zeros(len(x), np.int64)
            for p in range(parts):
                codes[:, p], gap = nearest(x[:, p], books[p])
                error += gap
            text = ["".join(f"{k:0{digits}x}" for k in row) for row in codes.tolist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(text, pa.string()), pa.array(error)],
                ["vec_id", "label", "code", "error"],
            )

    return run


def with_label_errors(coded: DataFrame) -> DataFrame:
    """``label_error`` beside every row (vec_id, label, error, ...): the errors of its label added up, nulls as one label."""
    totals = stored(coded.groupBy("label").agg(F.try_sum("error").alias("label_error")), "label-errors")
    if fits_broadcast(totals):
        small = F.broadcast(totals.withColumnRenamed("label", "_label"))
        return coded.join(small, F.col("label").eqNullSafe(F.col("_label")), "left").drop("_label")
    # many labels, of which one may have a third of the rows: each total goes to all salts, a row to one
    salted = totals.select(
        F.col("label").alias("_label"), "label_error", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt")
    )
    rows = coded.withColumn("_own", F.pmod(F.xxhash64("vec_id", "code", "error"), F.lit(SALTS)).cast("int"))
    same = F.col("label").eqNullSafe(F.col("_label")) & (F.col("_own") == F.col("_salt"))
    return rows.join(salted, same, "left").drop("_label", "_salt", "_own")


def compress(vectors: DataFrame, conf: Codec = Codec()) -> DataFrame:
    """vec_id, label, code, error, label_error and codebooks_sha256 of rows (vec_id, embedding, label)."""
    ship(vectors.sparkSession)
    keep = {"vec_id": F.col("vec_id").cast("long"), "label": F.col("label")}
    rows = stored(whole_vectors(vectors, "embedding", conf.factor, keep), "vectors")
    longest = rows.agg(F.coalesce(F.max(F.size("x")), F.lit(0))).first()[0]
    width = max(1, -(-longest // conf.parts)) * conf.parts
    books = learn(rows, width, conf)
    kinds = f"vec_id long, label {rows.schema['label'].dataType.simpleString()}, code string, error long"
    coded = stored(rows.select("vec_id", "label", "x").mapInArrow(_codes(books), kinds), "codes")
    return with_label_errors(coded).withColumn("codebooks_sha256", F.lit(books_digest(books)))
