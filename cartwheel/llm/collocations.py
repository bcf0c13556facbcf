"""Phrase collocation mining over sorted count streams.

Counting: one pass over the texts for each phrase length. A task takes the texts of a language in chunks, finds the runs of n
words inside pieces, counts equal runs by sorting them and gives each different run once with its count; Spark adds these up and
keeps phrases of ``least`` occurrences or more. A phrase can only be that frequent if its first and its last n - 1 words are,
so from n = 2 on a run is counted only if both are in a sieve over the frequent phrases of n - 1 words. The sieve has 16 bits a
phrase and ``SIEVE_BITS`` bits at most: whatever passes it wrongly is counted and then falls under the threshold, so its
size changes the work and never the result.

Streams: the counted phrases of all lengths are kept in two orders and merged in step, without hash tables. In *prefix order*
(by words from the first on) a phrase follows all its beginnings, so a scan that holds the open beginnings on a stack reads
off the count of every left part, and each phrase gives its count to its beginning as a right extension. In *suffix order*
(by words from the last backwards) the same scan gives the right parts and the left extensions. A phrase that lies inside
a longer one lies inside one that is one word longer and at least as frequent as that, so these extensions decide
what is dropped.

The order is cut into ranges at sampled phrases, so a word with which a third of all phrases begin is spread over tasks. A range
gets, as seeds, the beginnings of its first possible phrase, which are at most ``longest - 1`` rows; what a seed learns about its
extensions is joined with its own row by the scan that follows.

Words are read after lower-casing A-Z. Inside a chunk a word stands for itself by a 64-bit hash; across chunks phrases are
compared as text. A null or empty text has no words; a null language counts as ``und``. Rows are independent of each other, repeated
ones count each. Tables that are empty or without frequent phrases give no rows.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_arrow, ship, stored
from .shingles import window_hashes, word_hashes

UNKNOWN = "und"
CHUNK = 12 << 20
SIEVE_BITS = 1 << 29
RANGE_ROWS = 50_000
MOST_RANGES = 4096
SAMPLE_A_RANGE = 16

_STOP = b"."
_FOLD = bytes(
    ord("\n") if b in b".,;:!?\n\x0b\x0c\r" else ord(" ") if b in b" \t" else b + 32 if 65 <= b <= 90 else b for b in range(256)
)
_STOP_HASH = word_hashes([_STOP])[0][0]


@dataclass(frozen=True)
class Mining:
    """Phrases of 2 to ``longest`` words with ``least`` occurrences; ``cover`` percent of them in a longer one drop it."""

    longest: int = 5
    least: int = 100
    cover: int = 100
    top: int = 2000


def folded(text: str | None) -> bytes:
    """Words parted by single spaces, a stop word between pieces: ``.`` ends a piece, so it is never part of a word."""
    data = (text or "").encode("utf-8", "surrogatepass").translate(_FOLD)
    return b" ".join(data.replace(b"\n", b" . ").split())


def phrase_counts(data: bytes, n: int, sieve: np.ndarray | None) -> tuple[list[bytes], np.ndarray]:
    """(phrases, their counts) of the runs of ``n`` words in folded text whose parts pass the sieve."""
    words = word_hashes([data])[0]
    hashes = window_hashes(words, n)
    if not len(hashes):
        return [], np.empty(0, np.int64)
    stops = np.concatenate(([0], np.cumsum(words == _STOP_HASH)))
    wanted = stops[n:] == stops[:-n]
    if sieve is not None:
        known = passes(sieve, window_hashes(words, n - 1))
        wanted &= known[:-1] & known[1:]
    at = np.flatnonzero(wanted)
    at = at[np.argsort(hashes[at])]
    found = hashes[at]
    first = np.flatnonzero(np.concatenate((found[:1] == found[:1], found[1:] != found[:-1])))
    counts = np.diff(np.append(first, len(found)))
    spaces = np.flatnonzero(np.frombuffer(data, np.uint8) == 32)
    begins = np.concatenate(([0], spaces + 1))[at[first]].tolist()
    ends = np.concatenate((spaces, [len(data)]))[at[first] + n - 1].tolist()
    return [data[a:b] for a, b in zip(begins, ends, strict=True)], counts


def passes(sieve: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = hashes >> np.uint64(64 - (8 * len(sieve)).bit_length() + 1)
    return (sieve[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & np.uint8(1) > 0


def _counter(n: int, sieve: np.ndarray | None):
    size = 1 << 17

    def rows(lang: str, texts: list[bytes]) -> Iterator[pa.RecordBatch]:
        phrases, counts = phrase_counts(b" . ".join(texts), n, sieve)
        for i in range(0, len(phrases), size):
            part = pa.array(phrases[i : i + size], pa.binary()).cast(pa.string())
            own = pa.repeat(pa.scalar(lang, pa.string()), len(part)), part, pa.array(counts[i : i + size].astype(np.int64))
            yield pa.RecordBatch.from_arrays(list(own), ["lang", "phrase", "f"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = {}
        total = 0
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                data = folded(text)
                if data:
                    held.setdefault(lang, []).append(data)
                    total += len(data)
            if total >= CHUNK:
                for lang, texts in held.items():
                    yield from rows(lang, texts)
                held, total = {}, 0
        for lang, texts in held.items():
            yield from rows(lang, texts)

    return run


def _hashes_of(n: int):
    """The hash of every phrase of ``n`` words, as ``phrase_counts`` takes it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = word_hashes([b" ".join(batch.column(0).cast(pa.binary()).to_pylist())])[0]
            yield pa.RecordBatch.from_arrays([pa.array(window_hashes(words, n)[::n].view(np.int64))], ["hash"])

    return run


def _sieve_of(phrases: DataFrame, n: int, count: int) -> np.ndarray:
    """Bits of the hashes of ``count`` phrases, put together by Spark; at most ``SIEVE_BITS`` of them reach the driver."""
    bits = min(SIEVE_BITS, 1 << max(15, (16 * count - 1).bit_length()))
    place = F.shiftrightunsigned("hash", 65 - bits.bit_length())
    rows = phrases.select("phrase").mapInArrow(_hashes_of(n), "hash long").select(place.alias("place"))
    # the position of a number is counted from 1
    rows = rows.groupBy(F.shiftright("place", 15).alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(F.col("place") + 1)).alias("bits")
    )
    sieve = np.zeros(bits // 8, np.uint8)
    for r in rows.collect():
        sieve[r["part"] << 12 : (r["part"] + 1) << 12] |= np.frombuffer(r["bits"], np.uint8)
    return sieve


def count_streams(docs: DataFrame, conf: Mining) -> tuple[DataFrame, DataFrame]:
    """(lang, words, f) of the frequent phrases of 1 to ``longest`` words, and (lang, total) of all words."""
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)), F.col("text").cast("string"))
    kinds = "lang string, phrase string, f long"
    streams, totals, sieve = [], None, None
    for n in range(1, conf.longest + 1):
        counted = map_arrow(rows, _counter(n, sieve), kinds)
        counted = counted.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
        if n == 1:
            counted = stored(counted, "words")
            totals = counted.groupBy("lang").agg(F.sum("f").alias("total"))
        frequent = stored(counted.where(F.col("f") >= conf.least), "phrases")
        streams.append(frequent)
        found = frequent.count()
        if not found:
            break
        sieve = _sieve_of(frequent, n, found)
    stream = streams[0]
    for part in streams[1:]:
        stream = stream.union(part)
    return stream.select("lang", F.split("phrase", " ").alias("words"), "f"), totals


def _ranged(rows: DataFrame, n: int) -> DataFrame:
    """``rows`` (lang, words, ...) dealt into ranges of their order, with a seed row wherever a range begins inside the
    phrases of a beginning; column ``part`` numbers the ranges and ``own`` is false for seeds."""
    ranges = min(MOST_RANGES, 1 + n // RANGE_ROWS)
    bounds: list[tuple[str, list[str]]] = []
    if ranges > 1:
        sample = rows.select("lang", "words").orderBy(F.xxhash64("lang", "words")).limit(SAMPLE_A_RANGE * ranges)
        keys = sorted((r["lang"], list(r["words"])) for r in sample.collect())
        bounds = [keys[len(keys) * k // ranges] for k in range(1, ranges)]
    names = [*rows.columns, "part", "own"]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields) + ", part int, own boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, parts, own = [], [], []
            keys = zip(batch.column("lang").to_pylist(), batch.column("words").to_pylist(), strict=True)
            real = batch.column("own_row").to_pylist() if "own_row" in batch.schema.names else None
            for i, (lang, words) in enumerate(keys):
                k = bisect_right(bounds, (lang, words))
                row.append(i)
                parts.append(k)
                own.append(real is None or real[i])
                while k < len(bounds) and bounds[k][0] == lang and bounds[k][1][: len(words)] == words:
                    k += 1
                    row.append(i)
                    parts.append(k)
                    own.append(False)
            taken = pa.Table.from_batches([batch]).take(pa.array(row, pa.int64())).combine_chunks().to_batches()
            columns = taken[0].columns if taken else batch.slice(0, 0).columns
            yield pa.RecordBatch.from_arrays([*columns, pa.array(parts, pa.int32()), pa.array(own, pa.bool_())], names)

    dealt = rows.mapInArrow(run, kinds).repartition(ranges, "part")
    return dealt.sortWithinPartitions("part", "lang", "words", F.desc("own"))


class Open:
    """A phrase on the stack: its row, the counts of its beginnings, and the greatest count of an extension by a word."""

    __slots__ = ("words", "f", "before", "more", "own", "rest")

    def __init__(self, words, f, before, more, own, rest):
        self.words, self.f, self.before, self.more, self.own, self.rest = words, f, before, more, own, rest


def scan(rows: Iterator[tuple]) -> Iterator[tuple[str, Open]]:
    """Rows (part, lang, words, f, more, own, rest) in order, each with the counts of its beginnings when all its extensions
    have been seen. Rows of one phrase in a range are one."""
    at: tuple | None = None
    stack: list[Open] = []
    for part, lang, words, f, more, own, rest in rows:
        if at != (part, lang):
            while stack:
                yield at[1], stack.pop()
            at = (part, lang)
        while stack and words[: len(stack[-1].words)] != stack[-1].words:
            yield lang, stack.pop()
        if stack and len(stack[-1].words) == len(words):
            top = stack[-1]  # what a seed of the scan before has learned about the same phrase
            top.more = max(top.more, more)
            continue
        if stack and len(stack[-1].words) == len(words) - 1:
            stack[-1].more = max(stack[-1].more, f)
        stack.append(Open(words, f, [o.f for o in stack], more, own, rest))
    while stack:
        yield at[1], stack.pop()


def _left_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In prefix order: the counts of the beginnings of 1, 2, ... words; the words turned round for the other order."""

    def rows():
        for b in batches:
            for part, lang, words, f, own in zip(
                *(b.column(c).to_pylist() for c in ("part", "lang", "words", "f", "own")), strict=True
            ):
                yield part, lang, words, f, 0, own, None

    names = ["lang", "words", "f", "lefts", "more", "own_row"]
    kinds = (pa.string(), pa.list_(pa.string()), pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.bool_())
    for piece in _pieces((lang, o.words[::-1], o.f, o.before, o.more, o.own) for lang, o in scan(rows())):
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(piece, kinds, strict=True)], names)


def _scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In suffix order: the counts of the endings, and with them the lowest-scoring cut of every phrase."""
    columns = ("part", "lang", "words", "f", "more", "own", "lefts", "total")

    def rows():
        for b in batches:
            for part, lang, words, f, more, own, *rest in zip(*(b.column(c).to_pylist() for c in columns), strict=True):
                yield part, lang, words, f, more, own, rest

    def judged():
        for lang, o in scan(rows()):
            words = o.words[::-1]
            if len(words) < 2:
                continue
            score = left = right = None
            lefts, total = o.rest
            if o.own:
                for k in range(1, len(words)):  # after k words: the ending has len(words) - k
                    cut = 1000 * o.f * total // (lefts[k - 1] * o.before[len(words) - k - 1])
                    if score is None or cut < score:
                        score, left, right = cut, lefts[k - 1], o.before[len(words) - k - 1]
            yield lang, " ".join(words), o.f, left, right, total, score, o.more

    kinds = (pa.string(), pa.string(), *[pa.int64()] * 6)
    for piece in _pieces(judged()):
        arrays = [pa.array(c, k) for c, k in zip(piece, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, ["lang", "phrase", "a", "l", "r", "n", "score", "more"])


def _pieces(rows: Iterator[tuple], size: int = 8192) -> Iterator[list[tuple]]:
    held = []
    for r in rows:
        held.append(r)
        if len(held) == size:
            yield list(zip(*held, strict=True))
            held = []
    if held:
        yield list(zip(*held, strict=True))


def mine(docs: DataFrame, conf: Mining = Mining()) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of the first ``top`` collocations of every language of (text, lang)."""
    ship(docs.sparkSession)
    stream, totals = count_streams(docs, conf)
    stream = stored(stream, "stream")
    n = stream.count()
    lefts = _ranged(stream, n).mapInArrow(
        _left_parts, "lang string, words array<string>, f long, lefts array<long>, more long, own_row boolean"
    )
    lefts = stored(lefts, "left-parts")
    kinds = "lang string, phrase string, a long, l long, r long, n long, score long, more long"
    scored = _ranged(lefts.join(totals, "lang"), n).mapInArrow(_scored, kinds)
    best = scored.groupBy("lang", "phrase", "a", "n").agg(
        *[F.max(c).alias(c) for c in ("l", "r", "score", "more")]
    )
    best = best.where(F.lit(100) * F.col("more") < F.lit(conf.cover) * F.col("a"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= conf.top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
