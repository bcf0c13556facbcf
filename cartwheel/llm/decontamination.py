"""Benchmark decontamination: short test items found inside long documents.

A hit means that ``CONTAINED`` percent of the item's distinct five-word shingles are among the shingles of the whole
document, counted exactly: where in the document they stand, and what is written between them, plays no part.

Candidates come from a size-partitioned MinHash containment search. Items are parted by size, a class for each power of two
of their number of shingles. An item's sketch holds its least shingle under each of ``HASHES`` seeded permutations, and
all sketches of a class are looked up in the shingles of the whole document. Each of an item's ``HASHES`` values is found with
a chance of just its containment, whatever the document's size, so an item is nominated when ``LEAST_MATCHES`` are found: at a
containment of 0.8 a hit is missed with a chance of 1.3e-8 (none to two of 16 found). Classes of at most ``HASHES`` shingles keep
all of them and miss nothing. A nominated item's whole set is then counted. Items of one to four words are one shingle of that width
and are looked up among the document's runs of the same width.

Words are runs of letters and digits after lower-casing (any character outside ASCII counts as a letter), so
case and punctuation don't hide a passage. Tasks build the index of the items, in blocks of at most ``BLOCK_BYTES`` of distinct
text (a longer item is a block of its own), and write each to the shared folder; the driver sees only their paths. Each
block is one pass over the documents, whose result is stored before the next.

Null or empty documents and items match nothing. Rows that repeat a document or an item are found each for itself; null
ids are carried. An empty benchmark gives no hits.
"""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_bytes, column, map_arrow, map_same, open_fs, shared_folder, ship, stored
from .shingles import PIECE_BYTES, WIDTH, mix, shingle_hashes, window_hashes, word_hashes

CONTAINED = 80
BLOCK_BYTES = 16 << 20
SIEVE = 1 << 20
HASHES = 16
LEAST_MATCHES = 3

_SEEDS = mix(np.arange(1, HASHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))

_KEEP = bytes(b if chr(b).isalnum() or b > 127 else 32 for b in range(256))


def normalise(text: str | None) -> bytes:
    return b" ".join((text or "").lower().encode("utf-8", "surrogatepass").translate(_KEEP).split())


def size_class(n: int) -> int:
    """The power of two that ``n`` shingles do not exceed."""
    return 1 << (n - 1).bit_length()


def sketch(shingles: np.ndarray) -> np.ndarray:
    """The least shingle of a set under each permutation; the whole set where it is no larger than a sketch."""
    if size_class(len(shingles)) <= HASHES:
        return shingles
    return shingles[mix(shingles[:, None] ^ _SEEDS).argmin(axis=0)]


@dataclass
class Lookup:
    """The sketches of one width and size class: sorted ``keys``, and ``items[starts[k] : starts[k + 1]]`` for key k, an
    item once for every permutation that gives it this key."""

    sieve: np.ndarray
    keys: np.ndarray
    starts: np.ndarray
    items: np.ndarray
    needed: np.ndarray  # matches that nominate an item, by item


@dataclass
class ItemIndex:
    """What the tasks need to find a block of items."""

    names: list[str] = field(default_factory=list)
    sets: list[np.ndarray] = field(default_factory=list)
    widths: list[int] = field(default_factory=list)
    lookups: dict[tuple[int, int], Lookup] = field(default_factory=dict)  # by width and size class

    def add(self, name: str, text: str | None) -> None:
        data = normalise(text)
        words = word_hashes([data])[0] if data else np.empty(0, np.uint64)
        if not len(words):
            return
        self.names.append(name)
        self.sets.append(np.unique(shingle_hashes(words)))
        self.widths.append(min(len(words), WIDTH))

    def prepare(self) -> None:
        """Part the items by width and size class, and index the sketches of each part."""
        parts: dict[tuple[int, int], list[int]] = {}
        for i, (width, own) in enumerate(zip(self.widths, self.sets, strict=True)):
            parts.setdefault((width, size_class(len(own))), []).append(i)
        needed = np.array([-(-CONTAINED * len(own) // 100) for own in self.sets], np.int64)
        for (width, size), numbers in sorted(parts.items()):
            sketches = [sketch(self.sets[i]) for i in numbers]
            values = np.concatenate(sketches)
            owner = np.repeat(np.array(numbers), [len(k) for k in sketches])
            order = np.argsort(values, kind="stable")
            keys, starts = np.unique(values[order], return_index=True)
            sieve = np.zeros(SIEVE, bool)
            sieve[keys >> np.uint64(44)] = True
            enough = needed if size <= HASHES else np.full(len(needed), LEAST_MATCHES)
            self.lookups[width, size] = Lookup(sieve, keys, np.append(starts, len(order)), owner[order], enough)

    def search(self, words: np.ndarray) -> dict[int, tuple[int, int]]:
        """item -> (distinct shingles found, first word of the first one)."""
        found: dict[int, tuple[int, int]] = {}
        runs: dict[int, np.ndarray] = {}
        sorted_runs: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for (width, _), known in self.lookups.items():
            if width not in runs:
                runs[width] = window_hashes(words, width)
            likely = runs[width][known.sieve[runs[width] >> np.uint64(44)]]
            at = np.minimum(np.searchsorted(known.keys, likely), len(known.keys) - 1)
            at = np.unique(at[known.keys[at] == likely])
            if not len(at):
                continue
            matched = np.concatenate([known.items[known.starts[k] : known.starts[k + 1]] for k in at])
            nominated, matches = np.unique(matched, return_counts=True)
            for item in nominated[matches >= known.needed[nominated]].tolist():
                if width not in sorted_runs:
                    sorted_runs[width] = np.unique(runs[width], return_index=True)
                distinct, first = sorted_runs[width]
                own = self.sets[item]
                place = np.minimum(np.searchsorted(distinct, own), len(distinct) - 1)
                place = place[distinct[place] == own]
                if 100 * len(place) >= CONTAINED * len(own):
                    found[item] = (len(place), int(first[place].min()))
        return found


def _items(benchmark: DataFrame) -> DataFrame:
    return benchmark.select(
        column("item_id").cast("long").alias("item_id"), column("text").cast("string").alias("_item")
    ).withColumn("_key", F.sha2("_item", 256))


def _built(folder: str):
    """One block of items -> its index in a file of its own; the table of paths says which files count."""

    def run(rows: pa.Table) -> pa.Table:
        index = ItemIndex()
        items = zip(rows.column("_key").to_pylist(), rows.column("_item").to_pylist(), strict=True)
        for name, text in sorted(items):
            index.add(name, text)
        index.prepare()
        files, inside = open_fs(folder)
        files.create_dir(inside, recursive=True)
        name = f"items-{uuid.uuid4().hex}.index"
        with files.open_output_stream(f"{inside}/{name}") as sink:
            sink.write(pickle.dumps(index, protocol=5))
        return pa.table({"path": [f"{folder}/{name}"], "n": pa.array([len(index.names)], pa.int64())})

    return run


def item_blocks(benchmark: DataFrame) -> list[str]:
    """Paths of the indexes over all distinct item texts, each over at most ``BLOCK_BYTES`` of text or one item."""
    spark = benchmark.sparkSession
    ship(spark)
    texts = stored(_items(benchmark).where("_item is not null").select("_key", "_item").distinct(), "items")
    size = F.octet_length("_item").cast("long")
    total = texts.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    blocks = 1 + total // BLOCK_BYTES
    while True:  # more shares until each is small enough or holds a single item
        share = F.pmod(F.xxhash64("_key"), F.lit(blocks)).alias("_block")
        held = texts.groupBy(share).agg(F.sum(size).alias("bytes"), F.count("*").alias("n"))
        if held.where((F.col("bytes") > BLOCK_BYTES) & (F.col("n") > 1)).isEmpty():
            break
        blocks *= 2
    built = texts.withColumn("_block", share).groupBy("_block")
    files = stored(built.applyInArrow(_built(shared_folder(spark, "item-indexes")), "path string, n long"), "item-files")
    return sorted(r["path"] for r in files.where("n > 0").collect())


_loaded: dict[str, ItemIndex] = {}


def _index(path: str) -> ItemIndex:
    """The index of ``path``; a worker holds the last one that it read."""
    if path not in _loaded:
        files, inside = open_fs(path)
        with files.open_input_stream(inside) as source:
            index = pickle.loads(source.read())
        _loaded.clear()
        _loaded[path] = index
    return _loaded[path]


def _searched(index: ItemIndex, texts: list[str | None]) -> Iterator[dict[int, tuple[int, int]]]:
    for part in by_bytes(map(normalise, texts), lambda t: len(t) + 64, PIECE_BYTES):
        for words in word_hashes(part):
            yield index.search(words)


def find(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, n_found, n_shingles, containment and first_word of every hit."""
    kinds = "doc_id long, _key string, n_found long, n_shingles long, first_word long"
    rows = docs.select(column("doc_id").cast("long").alias("doc_id"), column("text").cast("string").alias("text"))
    hits = docs.sparkSession.createDataFrame([], kinds)

    def searcher(path: str):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = _index(path)
            for batch in batches:
                out = []
                ids = batch.column(0).to_pylist()
                for doc_id, found in zip(ids, _searched(index, batch.column(1).to_pylist()), strict=True):
                    for item, (n, at) in found.items():
                        out.append((doc_id, index.names[item], n, len(index.sets[item]), at))
                columns = list(zip(*out, strict=True)) or [()] * 5
                arrays = [pa.array(c, pa.string() if i == 1 else pa.int64()) for i, c in enumerate(columns)]
                names = ["doc_id", "_key", "n_found", "n_shingles", "first_word"]
                yield pa.RecordBatch.from_arrays(arrays, names)

        return run

    for path in item_blocks(benchmark):
        hits = hits.union(stored(map_arrow(rows, searcher(path), kinds), "hits"))
    named = hits.join(_items(benchmark).select("item_id", "_key"), "_key")
    return named.select(
        "doc_id",
        "item_id",
        "n_found",
        "n_shingles",
        (F.col("n_found") / F.col("n_shingles")).alias("containment"),
        "first_word",
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which no item is found; nothing is shuffled."""
    place = docs.columns.index("text")

    def keeper(path: str):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = _index(path)
            for batch in batches:
                keep = [not found for found in _searched(index, batch.column(place).to_pylist())]
                yield batch.filter(pa.array(keep, pa.bool_()))

        return run

    for k, path in enumerate(item_blocks(benchmark)):
        docs = map_same(stored(docs, "cleaned") if k else docs, keeper(path))
    return docs
