"""Near-duplicate groups by min-max hashing.

Min-max hashing takes two signature values from each permutation of a document's shingles, the least and the
greatest, so ``bands * rows`` values cost half as many hash evaluations. Both kinds agree between two documents
with a chance equal to their Jaccard similarity, and a pair of them varies less than two least values do.

1. One pass over the texts gives each document a 128-bit digest of its word sequence, its set size and its band
   keys. Each digest is a vertex, numbered once, whatever doc_ids its documents have.
2. Vertices that share a band key are candidates. No pairs within a bucket are written out: every vertex of a
   bucket is held against the bucket's smallest vertex, on full shingle sets. The leader of a large bucket is sent to a
   place for every ``STAR`` of its vertices.
3. What a star can miss, a link between two vertices of a bucket that do not link to its smallest one, is left
   only in buckets that still hold several components. There, the vertices outside the bucket's largest
   component meet the bucket's vertices of other components, in blocks of bounded size inside tasks: those that share one of
   their rarest shingles are compared, and only links that put components together are given.
4. Connected components of the confirmed links.

With 26 bands of 5 rows, a pair at similarity 0.85 shares no band with a chance of about 2e-7; with 32 bands of
4 rows, at 0.8, about 5e-8. Every candidate is confirmed, so no false link is made.

Null or empty texts have an empty set and link with nothing. Rows whose doc_id is null link with nothing, have a
null component and are kept. The texts of rows that repeat a doc_id are linked: a link of any of them counts for all.
``one_of_each`` goes by the texts alone: a row is dropped only if its own text has a link to that of a row that stays.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import by_bytes, column, map_arrow, ship, stored, unfolded, whole_row
from .components import connected_components
from .shingles import PIECE_BYTES, min_max, mix, normalise, permutations, shingle_hashes, word_hashes

BLOCK = 256
STAR = 1024


@dataclass(frozen=True)
class NearDup:
    """``percent``: link at 100 * intersection >= percent * union. ``bands * rows`` must be even."""

    percent: int = 80
    bands: int = 32
    rows: int = 4
    seed: int = 1


FEATURES = "doc_id long, raw long, hi long, lo long, n_shingles long, bands array<long>"


def _signer(conf: NearDup):
    keys, factors = permutations(conf.bands * conf.rows // 2, conf.seed)
    place = mix(np.arange(1, conf.rows + 1, dtype=np.uint64)) | np.uint64(1)
    number = mix(np.arange(1, conf.bands + 1, dtype=np.uint64))

    def bands(distinct: np.ndarray) -> np.ndarray:
        low, high = min_max(distinct, keys, factors)
        values = np.stack([low, high], axis=1).reshape(conf.bands, conf.rows).astype(np.uint64)
        return mix((values * place).sum(axis=1, dtype=np.uint64) ^ number).view(np.int64)

    return bands


def _features(conf: NearDup):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = _signer(conf)
        for batch in batches:
            ids = batch.column(0).to_pylist()
            raws = batch.column(2).to_pylist()
            rows = zip(ids, map(normalise, batch.column(1).to_pylist()), raws, strict=True)
            for part in by_bytes(rows, lambda r: len(r[1]) + 64, PIECE_BYTES):
                out: list[tuple] = []
                for (doc_id, text, raw), words in zip(part, word_hashes([t for _, t, _ in part]), strict=True):
                    distinct = np.unique(shingle_hashes(words))
                    digest = hashlib.md5(text, usedforsecurity=False).digest()
                    hi, lo = (int.from_bytes(digest[i : i + 8], "little", signed=True) for i in (0, 8))
                    signed = bands(distinct) if len(distinct) and doc_id is not None else None
                    out.append((doc_id, raw, hi, lo, len(distinct), signed))
                cols = list(zip(*out, strict=True))
                types = (*[pa.int64()] * 5, pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, types, strict=True)],
                    ["doc_id", "raw", "hi", "lo", "n_shingles", "bands"],
                )

    return run


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = zip(batch.column(0).to_pylist(), map(normalise, batch.column(1).to_pylist()), strict=True)
        for part in by_bytes(rows, lambda r: len(r[1]) + 64, PIECE_BYTES):
            sets = [np.unique(shingle_hashes(w)).view(np.int64) for w in word_hashes([t for _, t in part])]
            yield pa.RecordBatch.from_arrays(
                [pa.array([i for i, _ in part], pa.int64()), pa.array(sets, pa.list_(pa.int64()))], ["id", "shingles"]
            )


def _confirmed(stars: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of ``stars`` (leader, id, parts) that link on their full sets.

    A leader of many vertices is sent to ``parts`` places, and each vertex to one of them.
    """
    pairs = stars.groupBy(F.col("leader").alias("a"), F.col("id").alias("b")).agg(F.max("parts").alias("parts"))
    pairs = pairs.withColumn("part", F.pmod(F.xxhash64("b"), F.col("parts")))
    leaders = pairs.select("a", "parts").distinct()
    leaders = leaders.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    left = leaders.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa")), "a")
    right = pairs.join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb")), "b")
    both = F.size(F.array_intersect("sa", "sb"))
    return (
        right.join(left, ["a", "parts", "part"])
        .where(F.lit(100) * both >= F.lit(percent) * (F.size("sa") + F.size("sb") - both))
        .select("a", "b")
    )


def _lists(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(values, offsets) of a list column, without a Python object for each value."""
    flat = column.combine_chunks()
    offsets = flat.offsets.to_numpy().astype(np.int64)
    return flat.values.to_numpy()[offsets[0] : offsets[-1]], offsets - offsets[0]


def _rarest(values: np.ndarray, ends: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(shingle, set) of the rarest shingles of every set, as many as a set that links with it can't all lack.

    Two sets that link share ``percent`` of the larger one, so they share one of the n - percent * n + 1 shingles that come first
    in any order that both keep; here the rarest come first.
    """
    sizes = np.diff(ends)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    _, kind, often = np.unique(values, return_inverse=True, return_counts=True)
    order = np.lexsort((values, often[kind], owner))
    rank = np.arange(len(values)) - np.repeat(ends[:-1], sizes)
    first = rank < np.repeat(sizes - -(-percent * sizes // 100) + 1, sizes)
    return values[order][first], owner[order][first]


def _block_links(percent: int):
    """Links between the ``outer`` and the ``inner`` vertices of one block that put components together.

    Vertices meet by their rarest shingles only, and those that are connected by now are not compared again.
    """

    def run(rows: pa.Table) -> pa.Table:
        ids, components = (rows.column(c).to_numpy() for c in ("id", "component"))
        is_outer = rows.column("is_outer").to_numpy()
        values, ends = _lists(rows.column("shingles"))
        sizes = np.diff(ends)
        shingles, owner = _rarest(values, ends, percent)
        inner = ~is_outer[owner]
        order = np.argsort(shingles[inner], kind="stable")
        keys, holders = shingles[inner][order], owner[inner][order]
        up: dict[int, int] = {}

        def top(c: int) -> int:
            while up.get(c, c) != c:
                up[c] = c = up.get(up[c], up[c])
            return c

        found: list[tuple[int, int]] = []
        bounds = np.searchsorted(owner, np.arange(len(sizes) + 1))
        for i in np.flatnonzero(is_outer).tolist():
            own = shingles[bounds[i] : bounds[i + 1]]
            low, high = np.searchsorted(keys, own), np.searchsorted(keys, own, "right")
            met = np.unique(np.concatenate([holders[a:b] for a, b in zip(low, high, strict=True)] or [holders[:0]]))
            n = sizes[i]
            near = 100 * np.minimum(n, sizes[met]) >= percent * np.maximum(n, sizes[met])
            for j in met[near].tolist():
                a, b = top(int(components[i])), top(int(components[j]))
                if a == b:
                    continue
                both = len(np.intersect1d(values[ends[i] : ends[i + 1]], values[ends[j] : ends[j + 1]], assume_unique=True))
                if 100 * both >= percent * (n + sizes[j] - both):
                    up[max(a, b)] = min(a, b)
                    found.append((int(ids[i]), int(ids[j])))
        return pa.table(
            {"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())}
        )

    return run


def _missed_links(multi: DataFrame, components: DataFrame, sets: DataFrame, conf: NearDup):
    """Links inside buckets that the star over their smallest vertex leaves in several components."""
    rest = multi.where("id <> leader").join(components, "id", "left")
    rest = stored(rest.select("key", "id", F.coalesce("component", "id").alias("component")).distinct(), "rest")
    sizes = rest.groupBy("key", "component").agg(F.count("*").alias("n"))
    open_buckets = (
        sizes.groupBy("key")
        .agg(F.sum("n").alias("n"), F.max(F.struct("n", "component")).alias("most"), F.count("*").alias("parts"))
        .where("parts > 1")
        .select(
            "key",
            F.col("most.component").alias("largest"),
            F.ceil((F.col("n") - F.col("most.n")) / BLOCK).alias("outer_blocks"),
            F.ceil(F.col("n") / BLOCK).alias("inner_blocks"),
        )
    )
    # stored first, so that the join has two plain shuffles and AQE can part a hot key
    rows = stored(rest.join(stored(open_buckets, "open-buckets"), "key"), "open")
    if rows.isEmpty():
        return None

    def spread(own: str, other: str, outer: bool) -> DataFrame:
        return rows.where(F.col("component") != F.col("largest") if outer else F.lit(True)).select(
            "key",
            "id",
            "component",
            F.lit(outer).alias("is_outer"),
            F.pmod(F.xxhash64("id"), F.col(f"{own}_blocks")).alias(own),
            F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"{other}_blocks") - 1)).alias(other),
        )

    blocks = spread("outer", "inner", True).unionByName(spread("inner", "outer", False))
    blocks = blocks.join(sets, "id")
    ship(blocks.sparkSession)
    return blocks.groupBy("key", "outer", "inner").applyInArrow(_block_links(conf.percent), "a long, b long").distinct()


def _grouped(docs: DataFrame, conf: NearDup, by_id: bool) -> DataFrame:
    """doc_id, raw (hash of the text as it is), n_shingles, group and first_id (its least doc_id) of every row.

    The group of a row without words or without a doc_id is null. ``by_id`` links texts that share a doc_id.
    """
    texts = docs.select(column("doc_id").cast("long").alias("doc_id"), column("text").cast("string").alias("text"))
    texts = texts.withColumn("raw", F.xxhash64("text"))
    features = stored(map_arrow(texts, _features(conf), FEATURES), "features")
    full = features.where("n_shingles > 0 and doc_id is not null")
    reps = full.groupBy("hi", "lo").agg(F.min("doc_id").alias("doc_id"))
    reps = stored(reps.withColumn("id", F.monotonically_increasing_id()), "vertices")
    vertices = full.join(reps, ["hi", "lo", "doc_id"]).dropDuplicates(["id"])

    members = vertices.select("id", "n_shingles", F.explode("bands").alias("key"))
    buckets = members.groupBy("key").agg(F.min(F.struct("id", "n_shingles")).alias("first"), F.count("*").alias("n"))
    parts = F.floor(F.col("n") / STAR).cast("long") + 1
    buckets = buckets.where("n > 1").select(
        "key", F.col("first.id").alias("leader"), F.col("first.n_shingles").alias("most"), parts.alias("parts")
    )
    # stored first, so that the join has two plain shuffles and AQE can part a hot key
    multi = stored(members.join(stored(buckets, "leaders"), "key"), "buckets")
    needed = vertices.select("id", "doc_id", "raw").join(multi.select("id").distinct(), "id", "left_semi")
    sets = texts.join(needed, ["doc_id", "raw"]).dropDuplicates(["doc_id", "raw"]).select("id", "text")
    sets = stored(map_arrow(sets, _sets, "id long, shingles array<long>"), "sets")
    least, most = F.least("n_shingles", "most"), F.greatest("n_shingles", "most")
    stars = multi.where((F.col("id") != F.col("leader")) & (F.lit(100) * least >= F.lit(conf.percent) * most))
    links = stored(_confirmed(stars, sets, conf.percent), "links")

    if by_id:
        row_ids = full.select("doc_id", "hi", "lo").join(reps.drop("doc_id"), ["hi", "lo"])
        repeated = row_ids.groupBy("doc_id").agg(F.min("id").alias("a"), F.max("id").alias("last")).where("a <> last")
        same_id = row_ids.join(repeated, "doc_id").select("a", F.col("id").alias("b"))
        links = stored(links.union(same_id), "links")
    components = connected_components(links)
    missed = _missed_links(multi, components, sets, conf)
    if missed is not None:
        missed = stored(missed, "missed")
        if not missed.isEmpty():
            components = connected_components(links.union(missed))

    least = components.join(reps.select("id", "doc_id"), "id").groupBy("component").agg(F.min("doc_id").alias("least"))
    groups = reps.join(components.join(least, "component"), "id", "left").select(
        "hi",
        "lo",
        F.coalesce("component", "id").alias("group"),
        F.coalesce("least", "doc_id").alias("first_id"),
    )
    # rows without a doc_id may hold the text of a group; they are in none
    own = F.when(F.col("doc_id").isNotNull(), F.col("group"))
    return (
        features.select("doc_id", "raw", "hi", "lo", "n_shingles")
        .join(groups, ["hi", "lo"], "left")
        .select("doc_id", "raw", "n_shingles", own.alias("group"), "first_id")
    )


def near_duplicates(docs: DataFrame, conf: NearDup = NearDup()) -> DataFrame:
    """doc_id, n_shingles, component_id and kept (doc_id = component_id) for every row of ``docs``."""
    component = F.when(F.col("group").isNotNull(), F.col("first_id")).otherwise(F.col("doc_id"))
    return _grouped(docs, conf, True).select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def one_of_each(docs: DataFrame, conf: NearDup = NearDup()) -> DataFrame:
    """``docs`` with one row of each group of linked texts, the one of smallest doc_id; rows without a doc_id or
    without words stay. Among rows with one doc_id the least hash of the text decides, then the other columns."""
    has_words = F.coalesce(column("text").cast("string").rlike("[^\\x20\\x09-\\x0D]"), F.lit(False))
    rows = docs.select(
        whole_row(docs, "row"),
        column("doc_id").cast("long").alias("id"),
        F.xxhash64(column("text").cast("string")).alias("raw"),
        (column("doc_id").isNotNull() & has_words).alias("linked"),
    )
    first = _grouped(docs, conf, False).where("group is not null and doc_id = first_id")
    first = first.groupBy("group", F.col("doc_id").alias("id")).agg(F.min("raw").alias("raw"))
    order = Window.partitionBy("id", "raw").orderBy(F.to_json("row"))
    firsts = rows.where("linked").join(first.select("id", "raw"), ["id", "raw"], "left_semi")
    firsts = firsts.withColumn("place", F.row_number().over(order)).where("place = 1").select("row")
    return unfolded(firsts.union(rows.where("not linked").select("row")), "row", docs.columns)
