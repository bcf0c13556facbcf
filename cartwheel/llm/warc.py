"""WARC archives in which a repeated payload is stored once: later records revisit the first.

Which record revisits which is decided on headers alone (page_id, digest, size): the headers are shuffled by digest to their
original, and the few columns of the revisits found are joined to the pages on (page_id, digest), so copies of one page are
spread by their ids. Pages that can't revisit, those that are small or have no page_id, are not shuffled at all. Each record gets fresh
headers; a partition is written as archives of gzip members, one a record, a new one after every ``ROLL_BYTES``.
Reading an archive back streams its members and checks every stored payload against its digest.

A payload is the html in UTF-8; null html is an empty payload. Of records with equal payloads of at least
``LEAST_BYTES`` bytes the one with the smallest page_id is a response and later ones revisit it; rows that repeat that
page_id and payload are responses too. Smaller payloads, and rows without a page_id, are always responses.
A null url gets a target URI made from the page_id. An empty table writes no archive.

A file counts only if the table of files, which Spark commits, names it, so a task that runs twice does no harm.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import column, map_arrow, open_fs, shared_folder, stored

LEAST_BYTES = 100
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAMESPACE = uuid.UUID("6f1c1a62-7a0f-4c57-9d55-0c2a6f5f1b11")
READ = 1 << 20
ROLL_BYTES = 1 << 30
ROWS = 8192
END = b"\r\n\r\n"


def decided(pages: DataFrame) -> DataFrame:
    """page_id, url, html, payload_digest, payload_bytes, record_type and refers_to of every page."""
    payload = F.coalesce(column("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(
        column("page_id").cast("long").alias("page_id"),
        column("url").cast("string").alias("url"),
        payload.alias("payload"),
    )
    rows = rows.withColumns({"payload_digest": F.sha2("payload", 256), "payload_bytes": F.octet_length("payload")})
    can_repeat = (F.col("payload_bytes") >= LEAST_BYTES) & F.col("page_id").isNotNull()
    headers = stored(rows.where(can_repeat).select("page_id", "payload_digest"), "headers")
    first = (
        headers.groupBy("payload_digest")
        .agg(F.min("page_id").alias("first_id"), F.max("page_id").alias("last_id"))
        .where("first_id < last_id")
        .select("payload_digest", "first_id")
    )
    # each side of a join is stored, so that it has two plain shuffles and AQE can part a hot key
    revisits = headers.join(stored(first, "originals"), "payload_digest").where("page_id > first_id").distinct()
    revisits = stored(revisits, "revisits")
    able = rows.where(can_repeat).join(revisits, ["page_id", "payload_digest"], "left")
    every = able.unionByName(rows.where(~can_repeat).withColumn("first_id", F.lit(None).cast("long")))
    is_revisit = F.col("first_id").isNotNull()
    return every.select(
        "page_id",
        "url",
        # a revisit carries no payload
        F.when(~is_revisit, F.col("payload")).alias("payload"),
        "payload_digest",
        F.when(is_revisit, F.lit("revisit")).otherwise(F.lit("response")).alias("record_type"),
        F.col("first_id").alias("refers_to"),
    )


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{page_id}:{digest}')}>"


def target(url: str | None, page_id: int | None) -> str:
    return quote(url, safe="!#$%&'()*+,/:;=?@[]~") if url else f"urn:page:{page_id}"


def record(page_id, url, payload: bytes | None, digest: str, refers_to: int | None, date: str) -> bytes:
    """One record, headers and block; no payload makes a revisit of the record of page ``refers_to``."""
    http = ["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8"]
    if payload is not None:
        http.append(f"Content-Length: {len(payload)}")
    block = "\r\n".join(http).encode() + END + (payload or b"")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if payload is not None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id, digest)}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {target(url, page_id)}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if payload is None:
        head += [
            f"WARC-Profile: {PROFILE}",
            f"WARC-Refers-To: {record_id(refers_to, digest)}",
            f"X-Refers-To-Page-Id: {refers_to}",
        ]
    return "\r\n".join(head).encode() + END + block + END


def gzip_member(data: bytes, level: int = 6) -> bytes:
    squeeze = zlib.compressobj(level, zlib.DEFLATED, 31)
    return squeeze.compress(data) + squeeze.flush()


def members(source) -> Iterator[bytes]:
    """The expanded gzip members of a file, one after the other."""
    expand, held, out = zlib.decompressobj(31), b"", bytearray()
    while True:
        data = held or source.read(READ)
        if not data:
            if out:
                raise ValueError("the archive ends inside a record")
            return
        out += expand.decompress(data)
        held = b""
        if expand.eof:
            yield bytes(out)
            held, expand, out = expand.unused_data, zlib.decompressobj(31), bytearray()


def parsed(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of a record; the payload must have the digest that a response names."""
    head, _, rest = data.partition(END)
    headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(headers["Content-Length"])]
    payload = block.partition(END)[2]
    if headers["WARC-Type"] == "response":
        found = hashlib.sha256(payload).hexdigest()
        if headers["WARC-Payload-Digest"] != f"sha256:{found}":
            raise ValueError(f"record {headers['WARC-Record-ID']}: the payload has digest {found}")
    return headers, payload


def write(pages: DataFrame, folder: str | None = None, date: str = DATE, roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Write the archives; one row (path, n_records) a file, stored in the shared folder."""
    folder = folder or shared_folder(pages.sparkSession, "warc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        kinds = pa.schema({"path": pa.string(), "n_records": pa.int64()})
        sink, path, n, size = None, "", 0, 0
        for batch in batches:
            columns = [batch.column(i) for i in range(5)]
            for row in range(batch.num_rows):
                if sink is None:
                    files, inside = open_fs(folder)
                    files.create_dir(inside, recursive=True)
                    name = f"pages-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
                    path, sink = f"{folder}/{name}", files.open_output_stream(f"{inside}/{name}", compression=None)
                member = gzip_member(record(*(c[row].as_py() for c in columns), date))
                sink.write(member)
                n, size = n + 1, size + len(member)
                if size >= roll_bytes:
                    sink.close()
                    yield pa.RecordBatch.from_pylist([{"path": path, "n_records": n}], kinds)
                    sink, n, size = None, 0, 0
        if sink is not None:
            sink.close()
            yield pa.RecordBatch.from_pylist([{"path": path, "n_records": n}], kinds)

    rows = decided(pages).select("page_id", "url", "payload", "payload_digest", "refers_to")
    return stored(map_arrow(rows, run, "path string, n_records long"), "warc-files")


def read(spark: SparkSession, files: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of every record of the archives.

    A revisit's size is that of the response that it refers to.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        for batch in batches:
            for path in batch.column(0).to_pylist():
                files, inside = open_fs(path)
                with files.open_input_stream(inside, compression=None) as source:
                    rows = []
                    for headers, payload in map(parsed, members(source)):
                        kind = headers["WARC-Type"]
                        ids = (headers.get("X-Page-Id"), headers.get("X-Refers-To-Page-Id"))
                        page_id, refers_to = (int(x) if x is not None else None for x in ids)
                        size = len(payload) if kind == "response" else None
                        rows.append((page_id, size, headers["WARC-Payload-Digest"][7:], kind, refers_to))
                        if len(rows) == ROWS:
                            yield batch_of(rows)
                            rows = []
                    if rows:
                        yield batch_of(rows)

    n = max(1, files.count())
    found = map_arrow(
        files.select("path").repartitionByRange(n, "path"),
        run,
        "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long",
    )
    found = stored(found, "warc-records")
    responses, revisits = (found.where(F.col("record_type") == kind) for kind in ("response", "revisit"))
    sizes = responses.where("page_id is not null").groupBy(F.col("page_id").alias("refers_to"), "payload_digest")
    sizes = stored(sizes.agg(F.max("payload_bytes").alias("payload_bytes")), "original-sizes")
    revisits = revisits.drop("payload_bytes").join(sizes, ["refers_to", "payload_digest"], "left")
    return responses.unionByName(revisits).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
