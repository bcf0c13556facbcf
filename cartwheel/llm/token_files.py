"""Token-id files: bit-plane shuffled, compressed blocks with a chunk index.

``write`` sorts documents by (doc_id, text), encodes every whole text, appends the end id, and writes each sorted
partition into a shared folder, a new file after every ``ROLL_IDS`` ids or ``ROLL_DOCS`` documents. ``read`` gives the documents
back from the files.

File layout (little-endian)::

    "CWTOK1\\0\\0"
    chunk 0, chunk 1, ...      each the planes of BLOCK ids (the last chunk may hold fewer)
    index                     zstd: for each chunk its offset, id count and the sizes of its planes
    documents                 zstd: id counts (uint64), then doc ids (int64) and null flags (uint8)
    footer                    offsets and sizes of index and documents, ids in all, chunks, documents, planes

A chunk is a block of ids as unsigned 32-bit integers, transposed so that plane k holds byte k (or bit k) of every
id; each plane is compressed by itself, so the high planes, all but constant, take almost no room. A reader seeks to
any id range by the index.

A file is written under a name of its own attempt and is part of the result only if the table of files, which Spark
commits, names it: a task that is repeated on another executor leaves at most an unnamed file. The number of ranges goes by the bytes of the texts
(``PART_BYTES`` each; above ``MANY_PARTS`` of them they grow, to ``LARGE_PART_BYTES``). Ranges are cut by doc_id, the
first ``PREFIX`` characters of the text and the row's number, so rows that share a doc_id, or have none, are parted too. A task
holds one chunk, one batch of texts, and the ids and counts of the documents of one file.

A null text counts as empty and gives the end id alone. Rows that repeat a doc_id are documents of their own, in
order of text (where they are cut over partitions, of its first ``PREFIX`` characters); a null doc_id comes first. An empty table gives no documents.
"""

from __future__ import annotations

import json
import re
import struct
import unicodedata
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import column, map_arrow, open_fs, shared_folder, stored
from .token_counts import Memory, byte_alphabet

MAGIC = b"CWTOK1\0\0"
FOOTER = struct.Struct("<8Q")
BLOCK = 1 << 16
PART_BYTES = 32 << 20
MANY_PARTS = 4096
LARGE_PART_BYTES = 512 << 20
PREFIX = 32
ROLL_IDS = 1 << 28
ROLL_DOCS = 1 << 20
ROWS = 8192
ODD = re.compile("[\x1c-\x1f]")
#: The normalizer and pre-tokenizer that lets words be encoded apart.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_NORMALIZERS = [
    {"type": "NFC"},
    {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
    {"type": "Lowercase"},
]
FILES = "path string, number long, n_ids long, n_docs long"


class WordEncoder:
    """Ids of whole texts as a lower-casing word BPE file gives them (no special tokens added).

    White space only parts words there, so each stretch without white space is encoded by itself and remembered.
    Stretches that hold a special string go through the library, as do texts with U+001C to U+001F, which Python
    and the tokenizer class differently.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            conf = json.load(f)
        split, level = conf["pre_tokenizer"]["pretokenizers"]
        known = (
            conf["normalizer"]["normalizers"] == WORD_NORMALIZERS
            and (split["pattern"], split["behavior"], split["invert"]) == ({"Regex": WORD_PATTERN}, "Removed", True)
            and not level["add_prefix_space"]
            and not level["use_regex"]
            and conf["post_processor"] is None
            and conf["truncation"] is None
        )
        if not known:
            raise ValueError(f"{path} is not a lower-casing word BPE tokenizer")
        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        self.pattern = regex.compile(WORD_PATTERN)
        special = [t["content"] for t in conf["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, special)) or r"(?!)")
        self.alphabet = byte_alphabet()
        self.merge = self._by_rank(conf["model"])
        self.words = Memory(self._word)
        self.stretches = Memory(self._stretch)

    def _by_rank(self, model: dict):
        """A rank merge, if every vocabulary string merges alone to its own token (see token_counts).

        A word's end is written as one space, which no word holds; joining it to the last byte ranks below all merges.
        """
        import tiktoken

        back = {c: b for b, c in self.alphabet.items()}
        suffix, ranks = model["end_of_word_suffix"], {}
        for piece, token in model["vocab"].items():
            ends = piece.endswith(suffix)
            data = bytes(map(back.__getitem__, piece[: -len(suffix)] if ends else piece))
            if ends and [t.id for t in self.model.tokenize(piece[: -len(suffix)])] != [token]:
                return None
            ranks[data + b" " if ends else data] = token
        ordered = all(
            model["vocab"][(m if isinstance(m, str) else " ".join(m)).replace(" ", "")] == 512 + k
            for k, m in enumerate(model["merges"])
        )
        if not ordered or len(ranks) != len(model["vocab"]) or not all(bytes([b]) in ranks for b in range(256)):
            return None
        return tiktoken.Encoding("ranks", pat_str=r"(?s:.+)", mergeable_ranks=ranks, special_tokens={})

    def _word(self, word: str) -> bytes:
        if self.merge is not None:
            return np.array(self.merge.encode_ordinary(word + " "), "<u4").tobytes()
        piece = "".join(map(self.alphabet.__getitem__, word.encode("utf-8")))
        return np.array([t.id for t in self.model.tokenize(piece)], "<u4").tobytes()

    def _stretch(self, stretch: str) -> bytes:
        if self.special.search(stretch):
            return self._library(stretch)
        if stretch.isascii():
            lower = stretch.lower()
        else:
            lower = "".join(c.lower() for c in unicodedata.normalize("NFC", stretch))
        if lower.isalpha():
            return self.words[lower]
        return b"".join(map(self.words.__getitem__, self.pattern.findall(lower)))

    def _library(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if ODD.search(text):
            return self._library(text)
        return b"".join(map(self.stretches.__getitem__, text.split()))


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def to_planes(ids: np.ndarray, bits: bool) -> list[bytes]:
    """The byte planes (4) or bit planes (32) of ids, lowest first."""
    octets = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if not bits:
        return [octets[:, k].tobytes() for k in range(4)]
    spread = np.unpackbits(octets, axis=1, bitorder="little")
    return [np.packbits(spread[:, k], bitorder="little").tobytes() for k in range(32)]


def from_planes(planes: list[bytes], n: int) -> np.ndarray:
    if len(planes) == 4:
        octets = np.stack([np.frombuffer(p, np.uint8) for p in planes], axis=1)
    else:
        spread = [np.unpackbits(np.frombuffer(p, np.uint8), count=n, bitorder="little") for p in planes]
        octets = np.packbits(np.stack(spread, axis=1), axis=1, bitorder="little")
    return np.ascontiguousarray(octets).view("<u4").reshape(-1)


class FileWriter:
    def __init__(self, sink, bits: bool, level: int):
        import zstandard

        self.sink, self.bits = sink, bits
        self.squeeze = zstandard.ZstdCompressor(level=level).compress
        self.at = 0
        self.held = bytearray()
        self.n_ids = 0
        self.index: list[tuple] = []
        self.doc_ids: list[int | None] = []
        self.counts: list[int] = []
        self._put(MAGIC)

    def _put(self, data: bytes) -> None:
        self.sink.write(data)
        self.at += len(data)

    def _chunk(self, data: bytes) -> None:
        planes = [self.squeeze(p) for p in to_planes(np.frombuffer(data, "<u4"), self.bits)]
        self.index.append((self.at, len(data) // 4, *map(len, planes)))
        for p in planes:
            self._put(p)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.doc_ids.append(doc_id)
        self.counts.append(len(ids) // 4)
        self.n_ids += len(ids) // 4
        self.held += ids
        while len(self.held) >= 4 * BLOCK:
            self._chunk(bytes(self.held[: 4 * BLOCK]))
            del self.held[: 4 * BLOCK]

    def close(self) -> int:
        if self.held:
            self._chunk(bytes(self.held))
        planes = 32 if self.bits else 4
        index = self.squeeze(np.array(self.index, "<u8").reshape(-1, 2 + planes).tobytes())
        known = [0 if d is None else d for d in self.doc_ids]
        documents = self.squeeze(
            np.array(self.counts, "<u8").tobytes()
            + np.array(known, "<i8").tobytes()
            + np.array([d is None for d in self.doc_ids], np.uint8).tobytes()
        )
        where = (self.at, len(index), self.at + len(index), len(documents))
        total = sum(self.counts)
        self._put(index)
        self._put(documents)
        self._put(FOOTER.pack(*where, total, len(self.index), len(self.counts), planes))
        self.sink.close()
        return total


class FileReader:
    """A file's documents and id ranges; ``source`` is a seekable binary file."""

    def __init__(self, source):
        import zstandard

        self.source = source
        self.expand = zstandard.ZstdDecompressor().decompress
        size = source.seek(0, 2)
        footer = FOOTER.unpack(self._at(size - FOOTER.size, FOOTER.size))
        if self._at(0, len(MAGIC)) != MAGIC:
            raise ValueError("not a token file")
        self.n_ids, n_chunks, n_docs, self.planes = footer[4:]
        self.index = np.frombuffer(self.expand(self._at(*footer[0:2])), "<u8").reshape(n_chunks, 2 + self.planes)
        documents = self.expand(self._at(*footer[2:4]))
        self.counts = np.frombuffer(documents, "<u8", n_docs)
        ids, nulls = np.frombuffer(documents, "<i8", n_docs, 8 * n_docs), documents[16 * n_docs :]
        self.doc_ids = [None if null else int(d) for d, null in zip(ids, nulls, strict=True)]
        self.first = np.concatenate(([0], np.cumsum(self.index[:, 1]))).astype(np.int64)

    def _at(self, offset: int, size: int) -> bytes:
        self.source.seek(int(offset))
        return self.source.read(int(size))

    def chunk(self, k: int) -> np.ndarray:
        offset, n, *sizes = map(int, self.index[k])
        data, planes = self._at(offset, sum(sizes)), []
        for size in sizes:
            planes.append(self.expand(data[:size]))
            data = data[size:]
        return from_planes(planes, n)

    def ids(self, start: int, stop: int) -> Iterator[np.ndarray]:
        """Ids start..stop of the file, in pieces, reading only the chunks that hold them."""
        k = int(np.searchsorted(self.first, start, "right")) - 1
        while start < stop:
            if getattr(self, "_held", (None,))[0] != k:
                self._held = (k, self.chunk(k))
            base = int(self.first[k])
            piece = self._held[1][start - base : stop - base]
            yield piece
            start += len(piece)
            k += 1


@dataclass(frozen=True)
class TokenFiles:
    """``files``: path, number (place in order), n_ids, n_docs and start (ids in all files before) of each file."""

    files: DataFrame


def write(
    docs: DataFrame,
    path: str,
    end_id: int,
    folder: str | None = None,
    bits: bool = False,
    level: int = 3,
    roll_ids: int = ROLL_IDS,
    roll_docs: int = ROLL_DOCS,
    partitions: int | None = None,
) -> TokenFiles:
    """Encode and write ``docs`` (doc_id, text) in ascending doc_id order; ``path``: the tokenizer file."""
    spark = docs.sparkSession
    folder = folder or shared_folder(spark, "token-files")
    end = struct.pack("<I", end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        kinds = pa.schema({"path": pa.string(), "number": pa.int64(), "n_ids": pa.int64(), "n_docs": pa.int64()})
        writer, name, encode = None, "", encoder(path).encode

        def closed() -> pa.RecordBatch:
            total = writer.close()
            row = {"path": f"{folder}/{name}", "number": number, "n_ids": total, "n_docs": len(writer.counts)}
            return pa.RecordBatch.from_pylist([row], kinds)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if writer is None:
                    files, inside = open_fs(folder)
                    files.create_dir(inside, recursive=True)
                    name = f"tokens-{number >> 32:06d}-{uuid.uuid4().hex}.bin"
                    writer = FileWriter(files.open_output_stream(f"{inside}/{name}"), bits, level)
                writer.add(doc_id, encode(text) + end)
                if writer.n_ids >= roll_ids or len(writer.counts) >= roll_docs:
                    yield closed()
                    writer, number = None, number + 1
        if writer is not None:
            yield closed()

    rows = docs.select(column("doc_id").cast("long").alias("doc_id"), column("text").cast("string").alias("text"))
    if partitions is None:
        size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
        partitions = 1 + max(min(size // PART_BYTES, MANY_PARTS), size // LARGE_PART_BYTES)
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    ordered = rows.repartitionByRange(partitions, "doc_id", F.substring("text", 1, PREFIX), "row")
    ordered = ordered.sortWithinPartitions("doc_id", "text").select("doc_id", "text")
    files = stored(map_arrow(ordered, run, FILES), "token-index")
    # a row a file: no more than the ranges, and one for every ROLL_IDS ids or ROLL_DOCS documents
    starts, total = [], 0
    for f in sorted(files.collect(), key=lambda f: f["number"]):
        starts.append((f["path"], f["number"], f["n_ids"], f["n_docs"], total))
        total += f["n_ids"]
    listed = spark.createDataFrame(starts, FILES + ", start long")
    return TokenFiles(listed)


def read(spark: SparkSession, written: TokenFiles) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files; a task streams a file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                files, inside = open_fs(path)
                with files.open_input_file(inside) as source:
                    reader = FileReader(source)
                    at = 0
                    for k in range(0, len(reader.counts), ROWS):
                        counts, crcs, starts = reader.counts[k : k + ROWS], [], []
                        for n in map(int, counts):
                            crc = 0
                            for piece in reader.ids(at, at + n):
                                crc = zlib.crc32(piece.astype("<u4").tobytes(), crc)
                            crcs.append(crc)
                            starts.append(start + at)
                            at += n
                        columns = (reader.doc_ids[k : k + ROWS], starts, counts.astype(np.int64), crcs)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, pa.int64()) for c in columns], ["doc_id", "start", "n_tokens", "ids_crc32"]
                        )

    files = written.files.select("path", "start")
    n = max(1, written.files.count())
    return map_arrow(
        files.repartitionByRange(n, "start"), run, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )
