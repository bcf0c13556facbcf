"""Exact top-k search by inner product over a pivot-distance index.

A vector x gets one more component, sqrt(M - |x|^2), where M is the greatest squared length of all; a query gets 0. Then
``|q - x|^2 = |q|^2 + M - 2 q.x``, so the greatest inner product belongs to the nearest vector and distances obey the triangle
inequality.

Index: every vector is keyed by its nearest pivot and its distance from it. In that order the vectors are cut into annuli
of at most ``block`` rows, each stored as one row with its least and greatest distance. The pivots come from a sample of
``SAMPLE`` rows, each the farthest from those before; every vector is indexed, and any choice of pivots gives the same result.

Search: queries go in batches. The best scores of a query in its own annulus and the rows before it give a radius that its
results can't exceed. A batch meets only the annuli whose distances overlap ``[d - radius, d + radius]`` of some query, d being the query's
distance from their pivot: an equality join on the pivot with a range on the distance. In a task a batch expands over its annuli
in order of their bound. A query passes over an annulus when its bound is beyond its k-th best; the batch stops
when the bound is beyond the k-th best of all. Scores come from exact integer products, and bounds have room for rounding, so
no result is lost.

A batch's annuli are dealt over shares of ``share`` annuli, each of which gives k rows a query at most, so neither a
large corpus nor a pivot with a third of all rows is one task. Equal distances are parted by row, so copies of one
vector fill as many annuli as they need.

Rows are told apart by place, not by vec_id: a row that repeats a query's vec_id is a candidate of it, and each of several
query rows with one vec_id gets its own result. Ties go to the smaller vec_id, null last, and then to the earlier row. A null
vec_id is no query. Vectors that are null or hold null or non-finite components take no part; components are bounded as
``vectors`` says, shorter vectors count as ending in zeros. Empty tables and queries without candidates give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ship, stored
from .vectors import exact_dots, matrix, whole_vectors

SAMPLE = 4096
MOST_PIVOTS = 512
SALTS = 16
COLUMNS = 256
NULL_ID = np.iinfo(np.int64).max
NO_SCORE = np.iinfo(np.int64).min
INDEX = (
    "kind int, block long, pivot int, low double, high double, n int, ids binary, nulls binary, places binary, "
    "vectors binary, radii binary, least array<double>, most array<double>, from array<double>, to array<double>"
)
FOUND = "query_place long, query_id long, vec_id long, place long, score long"


@dataclass(frozen=True)
class Search:
    """Queries are the rows whose vec_id ``every`` divides; each gets its ``top`` best of all other rows."""

    factor: int = 64
    every: int = 20
    top: int = 20
    block: int = 1024
    batch: int = 1024
    share: int = 256


@dataclass(frozen=True)
class Space:
    """What all tasks know: the width of vectors, the greatest squared length M, the pivots and their last component."""

    width: int
    longest: int
    pivots: np.ndarray

    @property
    def slack(self) -> float:
        """Room for rounding in a distance."""
        return 1e-6 * math.sqrt(self.longest + 1)

    def last(self, x: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(0, self.longest - (x * x).sum(axis=1)).astype(np.float64))

    def from_pivots(self, x: np.ndarray, is_query: bool) -> np.ndarray:
        """Distance of every row of ``x`` from every pivot."""
        inner = exact_dots(x, self.pivots).astype(np.float64)
        if is_query:
            squares = (x * x).sum(axis=1)[:, None] + float(self.longest) - 2 * inner
        else:
            squares = 2 * (float(self.longest) - inner - np.outer(self.last(x), self.last(self.pivots)))
        return np.sqrt(np.maximum(0.0, squares))

    def radius(self, x: np.ndarray, score: np.ndarray) -> np.ndarray:
        """Distance within which the vectors of ``score`` or more lie, for every query; infinite without a score."""
        squares = (x * x).sum(axis=1) + float(self.longest) - 2 * np.where(score == NO_SCORE, -np.inf, score)
        return np.sqrt(np.maximum(0.0, squares)) + self.slack


def choose_pivots(sample: np.ndarray, longest: int, n: int) -> np.ndarray:
    """At most ``n`` rows of ``sample``, each the farthest from those chosen before."""
    if not len(sample):
        return sample
    space = Space(sample.shape[1], longest, sample[:1])
    chosen, gap = [0], space.from_pivots(sample, False)[:, 0]
    while len(chosen) < n:
        k = int(gap.argmax())
        if gap[k] <= space.slack:
            break
        chosen.append(k)
        gap = np.minimum(gap, Space(space.width, longest, sample[k : k + 1]).from_pivots(sample, False)[:, 0])
    return sample[chosen]


def _placed(space: Space):
    """Nearest pivot of every vector and its distance; the vector packed as 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(2), space.width)
            gaps = space.from_pivots(x, False)
            pivot = gaps.argmin(axis=1)
            packed = [row.tobytes() for row in x.astype("<i4")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(pivot.astype(np.int32)),
                    pa.array(gaps[np.arange(len(x)), pivot]),
                    pa.array(packed, pa.binary()),
                ],
                ["place", "vec_id", "pivot", "distance", "packed"],
            )

    return run


class Block:
    """Rows of one kind in numpy: vec_ids (``NULL_ID`` where null), places in the table and vectors."""

    def __init__(self, ids, nulls, places, x):
        self.ids, self.nulls, self.places, self.x = ids, nulls, places, x

    @classmethod
    def unpacked(cls, row: dict, width: int) -> Block:
        x = np.frombuffer(row["vectors"], "<i4").reshape(row["n"], width).astype(np.int64)
        nulls = np.frombuffer(row["nulls"], np.uint8).astype(bool)
        return cls(np.frombuffer(row["ids"], "<i8"), nulls, np.frombuffer(row["places"], "<i8"), x)

    def packed(self) -> dict:
        return {
            "n": len(self.x),
            "ids": self.ids.astype("<i8").tobytes(),
            "nulls": self.nulls.astype(np.uint8).tobytes(),
            "places": self.places.astype("<i8").tobytes(),
            "vectors": self.x.astype("<i4").tobytes(),
        }

    def take(self, at: np.ndarray) -> Block:
        return Block(self.ids[at], self.nulls[at], self.places[at], self.x[at])


def _joined(blocks: list[Block]) -> Block:
    return Block(*(np.concatenate([getattr(b, f) for b in blocks]) for f in ("ids", "nulls", "places", "x")))


def _indexed(space: Space, conf: Search):
    """Rows in order of (pivot, distance): annuli (kind 1), and batches of queries (kind 0) with their radii."""
    schema = pa.schema(
        [
            ("kind", pa.int32()),
            ("block", pa.int64()),
            ("pivot", pa.int32()),
            ("low", pa.float64()),
            ("high", pa.float64()),
            ("n", pa.int32()),
            *((c, pa.binary()) for c in ("ids", "nulls", "places", "vectors", "radii")),
            *((c, pa.list_(pa.float64())) for c in ("least", "most", "from", "to")),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        waiting: list[tuple[Block, np.ndarray]] = []
        recent: Block | None = None

        def annulus(pivot: int, gaps: list[float], block: Block) -> dict:
            nonlocal number, recent
            number += 1
            # any rows give a radius; a small annulus borrows from those before
            near = block if recent is None else _joined([recent, block])
            recent = near.take(slice(-conf.block, None))
            asked = np.flatnonzero(~block.nulls & (block.ids % conf.every == 0))
            if len(asked):
                radii = np.full(len(asked), np.inf)
                queries = block.take(asked)
                if len(near.x) > conf.top:
                    scores = exact_dots(queries.x, near.x)
                    scores[queries.places[:, None] == near.places] = NO_SCORE
                    kth = np.partition(scores, len(near.x) - conf.top, axis=1)[:, len(near.x) - conf.top]
                    radii = space.radius(queries.x, kth)
                waiting.append((queries, radii))
            ends = {"low": gaps[0], "high": gaps[-1]}
            return {"kind": 1, "block": number, "pivot": pivot, **ends, **block.packed()}

        def queries() -> dict:
            nonlocal number
            number += 1
            block, radii = _joined([b for b, _ in waiting]), np.concatenate([r for _, r in waiting])
            waiting.clear()
            away = space.from_pivots(block.x, True)
            bounds = {
                "least": away.min(axis=0) - space.slack,
                "most": away.max(axis=0) + space.slack,
                "from": (away - radii[:, None]).min(axis=0) - space.slack,
                "to": (away + radii[:, None]).max(axis=0) + space.slack,
            }
            row = {"kind": 0, "block": number, "radii": radii.astype("<f8").tobytes(), **block.packed()}
            return row | {k: v.tolist() for k, v in bounds.items()}

        pivot, held = -1, []

        def flush(final: bool) -> Iterator[pa.RecordBatch]:
            rows = []
            if held:
                x = np.frombuffer(b"".join(h[3] for h in held), "<i4").reshape(len(held), space.width)
                nulls = np.array([h[1] is None for h in held])
                ids = np.array([NULL_ID if h[1] is None else h[1] for h in held], np.int64)
                places = np.array([h[0] for h in held], np.int64)
                rows.append(annulus(pivot, [h[2] for h in held], Block(ids, nulls, places, x.astype(np.int64))))
                held.clear()
            if waiting and (final or sum(len(r) for _, r in waiting) >= conf.batch):
                rows.append(queries())
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema)

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("place", "vec_id", "pivot", "distance", "packed")]
            for place, vec_id, own, distance, packed in zip(*columns, strict=True):
                if own != pivot or len(held) == conf.block:
                    yield from flush(False)
                    pivot = own
                held.append((place, vec_id, distance, packed))
        yield from flush(True)

    return run


class Best:
    """The best ``top`` rows found so far of every query of a batch."""

    def __init__(self, n: int, top: int):
        self.top = top
        self.score = np.full(n, NO_SCORE)  # of the k-th best, once there are k
        self.last = np.full(n, NULL_ID)  # its vec_id
        self.rows: list[np.ndarray] = [np.empty(0, np.int64)] * 4  # query, score, vec_id, place
        self.null = np.empty(0, bool)

    def add(self, query: np.ndarray, score: np.ndarray, block: Block, at: np.ndarray) -> None:
        new = (query, score, block.ids[at], block.places[at])
        query, score, ids, places = (np.concatenate(p) for p in zip(self.rows, new, strict=True))
        null = np.concatenate([self.null, block.nulls[at]])
        order = np.lexsort((places, null, ids, -score, query))
        query = query[order]
        rank = np.arange(len(query)) - np.searchsorted(query, query)
        order, query = order[rank < self.top], query[rank < self.top]
        self.rows, self.null = [query, score[order], ids[order], places[order]], null[order]
        full = np.flatnonzero(rank[rank < self.top] == self.top - 1)
        self.score[query[full]] = self.rows[1][full]
        self.last[query[full]] = self.rows[2][full]


def _expanded(space: Space, conf: Search):
    """Sorted by (batch, share, kind, bound): each batch of queries, then the annuli that it may need."""

    def meet(best: Best, queries: Block, floor: np.ndarray, asked: np.ndarray, block: Block) -> None:
        for start in range(0, len(block.x), COLUMNS):
            part = block.take(slice(start, start + COLUMNS))
            score = exact_dots(queries.x[asked], part.x)
            kth = best.score[asked][:, None]
            wanted = (score > kth) | ((score == kth) & (part.ids <= best.last[asked][:, None]))
            wanted &= score >= floor[asked][:, None]
            wanted &= queries.places[asked][:, None] != part.places
            row, at = np.nonzero(wanted)
            if len(row):
                best.add(asked[row], score[row, at], part, at)

    def found(queries: Block, best: Best) -> Iterator[pa.RecordBatch]:
        query, score, ids, places = best.rows
        if len(query):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(queries.places[query]),
                    pa.array(queries.ids[query]),
                    pa.array(ids, mask=best.null),
                    pa.array(places),
                    pa.array(score),
                ],
                ["query_place", "query_id", "vec_id", "place", "score"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = best = None
        done = False
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k].as_py() for c in ("kind", "pivot", "low", "high", "bound")}
                if row["kind"] == 1 and done:
                    continue
                row |= {c: batch.column(c)[k].as_py() for c in ("n", "ids", "nulls", "places", "vectors", "radii")}
                if row["kind"] == 0:
                    if queries is not None:
                        yield from found(queries, best)
                    queries, done = Block.unpacked(row, space.width), False
                    best = Best(row["n"], conf.top)
                    away, own = space.from_pivots(queries.x, True), (queries.x * queries.x).sum(axis=1)
                    radius = np.frombuffer(row["radii"], "<f8").copy()
                    # least score that the radius allows, with room for rounding
                    floor = (own + space.longest - radius**2) / 2 - 1 - 1e-12 * (own + space.longest)
                    continue
                radius = np.minimum(radius, space.radius(queries.x, best.score))
                if row["bound"] > radius.max():
                    done = True  # the annuli that follow are farther still
                    continue
                gap = np.maximum(away[:, row["pivot"]] - row["high"], row["low"] - away[:, row["pivot"]])
                asked = np.flatnonzero(gap - space.slack <= radius)
                if len(asked):
                    meet(best, queries, floor, asked, Block.unpacked(row, space.width))
        if queries is not None:
            yield from found(queries, best)

    return run


def search(vectors: DataFrame, conf: Search = Search()) -> DataFrame:
    """query_id, rank, vec_id and score of the ``top`` best rows of every query among rows (vec_id, embedding)."""
    spark = vectors.sparkSession
    ship(spark)
    rows = whole_vectors(vectors, "embedding", conf.factor, {"vec_id": F.col("vec_id").cast("long")})
    rows = stored(rows.select(F.monotonically_increasing_id().alias("place"), "vec_id", "x"), "vectors")
    square = F.aggregate("x", F.lit(0).cast("long"), lambda a, v: a + v * v)
    n, width, longest = rows.agg(
        F.count("*"), F.coalesce(F.max(F.size("x")), F.lit(0)), F.coalesce(F.max(square), F.lit(0))
    ).first()
    width = max(1, width)
    sample = rows.orderBy(F.xxhash64("vec_id", "x"), "vec_id", "place").limit(SAMPLE).select("x").toArrow()
    few = min(MOST_PIVOTS, max(8, math.isqrt(n) // 4))
    picked = matrix(sample.column(0), width) if sample.num_rows else np.zeros((1, width), np.int64)
    space = Space(width, longest, choose_pivots(picked, longest, few))

    kinds = "place long, vec_id long, pivot int, distance double, packed binary"
    placed = rows.mapInArrow(_placed(space), kinds)
    dealt = placed.repartitionByRange(1 + n // (16 * conf.block), "pivot", "distance", "place")
    dealt = dealt.sortWithinPartitions("pivot", "distance", "place")
    index = stored(dealt.mapInArrow(_indexed(space, conf), INDEX), "annuli")

    annuli, asked = index.where("kind = 1"), index.where("kind = 0")
    salt = F.pmod(F.xxhash64("block"), F.lit(SALTS)).cast("int")
    rings = annuli.select(F.col("block").alias("ring"), F.col("pivot").alias("of"), "low", "high", salt.alias("salt"))
    spans = asked.select(F.col("block").alias("batch"), F.posexplode(F.arrays_zip("least", "most", "from", "to")))
    spans = spans.select(
        "batch", F.col("pos").alias("of"), "col.*", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    )
    reached = rings.join(spans, ["of", "salt"]).where((F.col("low") <= F.col("to")) & (F.col("high") >= F.col("from")))
    bound = F.greatest(F.col("low") - F.col("most"), F.col("least") - F.col("high"), F.lit(0.0))
    shares = 1 + annuli.count() // conf.share
    share = F.pmod(F.xxhash64("ring"), F.lit(shares)).alias("share")
    pairs = reached.select("batch", "ring", bound.alias("bound"), share)

    content = ["kind", "pivot", "low", "high", "n", "ids", "nulls", "places", "vectors", "radii"]
    met = pairs.join(annuli.select(F.col("block").alias("ring"), *content), "ring")
    heads = pairs.groupBy("batch", "share").agg(F.lit(-1.0).alias("bound"), F.lit(0).cast("long").alias("ring"))
    heads = heads.join(asked.select(F.col("block").alias("batch"), *content), "batch")
    columns = ["batch", "share", "bound", "ring", *content]
    work = heads.select(columns).union(met.select(columns)).repartition("batch", "share")
    work = work.sortWithinPartitions("batch", "share", "kind", "bound", "ring")
    found = work.mapInArrow(_expanded(space, conf), FOUND)
    order = Window.partitionBy("query_place").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last(), "place")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= conf.top)
    return ranked.select("query_id", "rank", "vec_id", "score")
