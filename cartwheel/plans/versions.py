"""Tables in versions: every change is staged in files of its own and becomes visible by one small file.

Layout below a root (any file system that Spark knows)::

    <table>/<run>/day=YYYY-MM-DD/part-*.parquet   data files, never changed once written
    <table>/<run>-filters/part-*.parquet          key filters of those files (keyed tables)
    _versions/000000000012.json                   a version: for each table its schema and list of files

A ``Draft`` starts from the current version, stages data with plain Spark writes and is committed by writing the next
version file under a temporary name and renaming it. Readers take the newest version file, so a run that dies anywhere
before the rename changes nothing for them, and what it staged is never named. If another writer has committed meanwhile, the
draft's changes are put on top of that version, unless both touch the same files (``Conflict``).

A data file holds rows of one day, with its number of rows, bytes and day in the version: a reader of some days opens only
their files. The driver handles one entry a file, like any reader of a folder.

Keyed tables (``upsert``) are merged on read. An upsert stages its rows as delta files and asks the key filters of the base
files which of them may hold one of its keys; only these are merged with the deltas when the table is read, all others
are read as they are. ``fold`` rewrites just those files. A filter is a blocked Bloom filter: ``BLOCK_BITS`` bits a block, ``PROBES`` of
them set for a key; it never overlooks a key, and a key it takes wrongly only has a file merged for nothing.
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid
from collections.abc import Callable, Iterable
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DAY = "day"
BLOCK_BITS = 8192
BITS_A_KEY = 12
PROBES = 6
LEAST_BLOCKS = 16
TRIES = 20


class Conflict(RuntimeError):
    """Another writer has changed the files that this draft replaces."""


@dataclass(frozen=True)
class DataFile:
    path: str  # below the root
    rows: int
    bytes: int
    day: str | None
    kind: str = "base"  # or "delta"


@dataclass(frozen=True)
class TableState:
    schema: str
    files: tuple[DataFile, ...] = ()
    touched: tuple[str, ...] = ()  # base files that hold keys of the deltas, maybe

    def of(self, kind: str) -> list[DataFile]:
        return [f for f in self.files if f.kind == kind]


@dataclass(frozen=True)
class Version:
    number: int = 0
    tables: dict[str, TableState] = field(default_factory=dict)
    batches: dict[str, int] = field(default_factory=dict)  # last batch that each stream has committed

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def from_json(cls, text: str) -> Version:
        raw = json.loads(text)
        tables = {
            name: TableState(t["schema"], tuple(DataFile(**f) for f in t["files"]), tuple(t["touched"]))
            for name, t in raw["tables"].items()
        }
        return cls(raw["number"], tables, raw["batches"])


class Store:
    """The versions below ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # ------------------------------------------------------------------------------------------ file system
    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def _fs(self):
        return self._path("x").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def numbers(self) -> list[int]:
        fs, folder = self._fs(), self._path("_versions")
        if not fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[0] not in "._")

    def version(self, number: int | None = None) -> Version:
        """A committed version, the newest one if none is named; an empty one before the first commit."""
        if number is None:
            known = self.numbers()
            if not known:
                return Version()
            number = known[-1]
        rows = self.spark.read.text(f"{self.root}/_versions/{number:012d}.json", wholetext=True)
        return Version.from_json(rows.first()[0])

    def publish(self, version: Version) -> bool:
        """Make a version visible; False if its number is taken.

        The rename is the commit. Where a file system's rename replaces a file that is there (local disks do), the test before it
        leaves a moment in which two writers could take one number: let one writer commit at a time there.
        """
        fs = self._fs()
        fs.mkdirs(self._path("_versions"))
        final = self._path(f"_versions/{version.number:012d}.json")
        held = self._path(f"_versions/.{version.number:012d}-{uuid.uuid4().hex}")
        out = fs.create(held, False)
        out.write(bytearray(version.to_json().encode()))
        out.close()
        if fs.exists(final) or not fs.rename(held, final):
            fs.delete(held, False)
            return False
        return True

    # ------------------------------------------------------------------------------------------------ reads
    def open(self, state: TableState, files: Iterable[DataFile]) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(state.schema))
        paths = [f"{self.root}/{f.path}" for f in files]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def read(
        self, table: str, days: Iterable[_dt.date] | None = None, version: Version | None = None,
        merge: Callable[[DataFrame], DataFrame] | None = None,
    ) -> DataFrame:
        """A table as of ``version`` (the newest by default); ``days`` opens only their files.

        ``merge`` keeps the newest row of each key; it is applied where deltas are pending. Files touched by deltas are
        merged whole, since a key may have moved to another day; the caller filters rows by day.
        """
        state = (version or self.version()).tables[table]
        wanted = None if days is None else {str(d) for d in days}
        touched, deltas = set(state.touched), state.of("delta")
        plain = [f for f in state.of("base") if f.path not in touched and (wanted is None or f.day in wanted)]
        if not deltas:
            return self.open(state, plain)
        if merge is None:
            raise ValueError(f"{table} has pending deltas: give the function that merges them")
        mixed = merge(self.open(state, [f for f in state.files if f.path in touched or f.kind == "delta"]))
        return self.open(state, plain).unionByName(mixed)

    def draft(self) -> Draft:
        return Draft(self, self.version())


@dataclass
class Draft:
    """Changes on top of a version; nothing is visible before ``commit``."""

    store: Store
    base: Version
    tables: dict[str, TableState] = field(default_factory=dict)
    batches: dict[str, int] = field(default_factory=dict)

    @property
    def version(self) -> Version:
        """The version that a commit would make."""
        return Version(self.base.number + 1, {**self.base.tables, **self.tables}, {**self.base.batches, **self.batches})

    def read(self, table: str, days=None, merge=None) -> DataFrame:
        return self.store.read(table, days, self.version, merge)

    # ---------------------------------------------------------------------------------------------- staging
    def write(self, rows: DataFrame, path: str, partition_by: str | None = None) -> None:
        """All data of a draft goes through here."""
        writer = rows.write.mode("error")
        (writer.partitionBy(partition_by) if partition_by else writer).parquet(f"{self.store.root}/{path}")

    def stage(
        self, table: str, rows: DataFrame, day_col: str | None, cluster_by: Iterable[Column | str] = (), kind: str = "base",
        key: str | None = None,
    ) -> list[DataFile]:
        """Write ``rows`` into new files, one day each, sorted by ``cluster_by``; with ``key``, their filters too."""
        spark, folder = self.store.spark, f"{table}/{uuid.uuid4().hex}"
        day = F.col(day_col).cast("date") if day_col else F.lit(None).cast("date")
        keys = [F.col(DAY), *[F.col(c) if isinstance(c, str) else c for c in cluster_by]]
        # rows of one day and cluster can still be parted
        spread = F.xxhash64(key) if key else F.xxhash64(*rows.columns)
        out = rows.withColumn(DAY, day) if DAY not in rows.columns else rows.drop(DAY).withColumn(DAY, day)
        out = out.repartitionByRange(*keys, spread).sortWithinPartitions(*keys)
        self.write(out, folder, DAY)
        # the files as they are: number of rows, size and day, from footers and names
        written = spark.read.schema(rows.schema).option("basePath", f"{self.store.root}/{folder}").parquet(
            f"{self.store.root}/{folder}"
        )
        meta = written.select(F.col("_metadata.file_path").alias("p"), F.col("_metadata.file_size").alias("s"))
        found = meta.groupBy("p").agg(F.count("*").alias("n"), F.max("s").alias("s")).collect()  # one row a file
        files = []
        for r in sorted(found, key=lambda r: r["p"]):
            path = folder + r["p"].rpartition(folder)[2]
            value = path.split("/")[-2].partition("=")[2]
            files.append(DataFile(path, r["n"], r["s"], None if value == "__HIVE_DEFAULT_PARTITION__" else value, kind))
        if key and kind == "base" and files:
            self._write_filters(folder, rows.schema, files, key)
        return files

    def state(self, table: str, rows: DataFrame) -> TableState:
        held = self.version.tables.get(table)
        return replace(held, schema=rows.schema.json()) if held else TableState(rows.schema.json())

    def append(
        self, table: str, rows: DataFrame, day_col: str | None, cluster_by: Iterable[Column | str] = (), key: str | None = None
    ) -> None:
        """Add rows; with ``key``, key filters of the new files."""
        state = self.state(table, rows)
        new = self.stage(table, rows, day_col, cluster_by, "base", key)
        self.tables[table] = replace(state, files=(*state.files, *new))

    def replace_days(
        self, table: str, rows: DataFrame, day_col: str, days: Iterable[_dt.date], cluster_by: Iterable[Column | str] = ()
    ) -> None:
        """``rows`` become all of the table's rows of ``days``; days without rows become empty."""
        state, gone = self.state(table, rows), {str(d) for d in days}
        kept = [f for f in state.files if f.day not in gone]
        self.tables[table] = replace(state, files=(*kept, *self.stage(table, rows, day_col, cluster_by)))

    def upsert(self, table: str, rows: DataFrame, key: str, day_col: str) -> None:
        """Stage ``rows`` (one a key) as deltas, and find the base files that may hold their keys."""
        state = self.state(table, rows)
        deltas = self.stage(table, rows, day_col, (), "delta")
        state = replace(state, files=(*state.files, *deltas))
        hit = self.files_with(state, self.store.open(state, deltas), key)
        self.tables[table] = replace(state, touched=tuple(sorted({*state.touched, *hit})))

    def fold(self, table: str, merge: Callable[[DataFrame], DataFrame], key: str, day_col: str, cluster_by=()) -> list[str]:
        """Rewrite the base files that deltas touch, together with the deltas; returns the paths of the files rewritten."""
        state = self.version.tables[table]
        old = [f for f in state.files if f.kind == "delta" or f.path in state.touched]
        if not old:
            return []
        rows = merge(self.store.open(state, old))
        new = self.stage(table, rows, day_col, cluster_by, "base", key)
        gone = {f.path for f in old}
        kept = [f for f in state.files if f.path not in gone]
        self.tables[table] = replace(state, files=(*kept, *new), touched=())
        return sorted(f.path for f in old if f.kind == "base")

    def compact(self, table: str, target_bytes: int, key: str | None = None, cluster_by=()) -> list[list[str]]:
        """Pack a day's small files (under half of ``target_bytes``) into files of about that size; returns the packs."""
        state = self.version.tables[table]
        small: dict[str | None, list[DataFile]] = {}
        for f in state.of("base"):
            if f.bytes < target_bytes // 2 and f.path not in state.touched:
                small.setdefault(f.day, []).append(f)
        packs = [p for files in small.values() for p in packed(files, target_bytes) if len(p) > 1]
        if not packs:
            return []
        number = [(f.path, k) for k, pack in enumerate(packs) for f in pack]
        known = F.broadcast(self.store.spark.createDataFrame(number, "_path string, _pack int"))
        own = F.regexp_extract(F.col("_metadata.file_path"), f"({table}/[^/]+/[^/]+/[^/]+)$", 1)
        rows = self.store.open(state, [f for pack in packs for f in pack]).withColumn("_path", own)
        rows = rows.join(known, "_path").drop("_path")
        folder = f"{table}/{uuid.uuid4().hex}"
        sort = [F.col(c) if isinstance(c, str) else c for c in cluster_by]
        # a pack is one file of at most target_bytes, so it is one task
        out = rows.repartition(len(packs), "_pack").sortWithinPartitions("_pack", *sort)
        self.write(out, folder, "_pack")
        schema = T.StructType.fromJson(json.loads(state.schema))
        written = self.store.spark.read.schema(schema).parquet(f"{self.store.root}/{folder}")
        meta = written.select(F.col("_metadata.file_path").alias("p"), F.col("_metadata.file_size").alias("s"))
        new = []
        for r in meta.groupBy("p").agg(F.count("*").alias("n"), F.max("s").alias("s")).collect():
            path = folder + r["p"].rpartition(folder)[2]
            new.append(DataFile(path, r["n"], r["s"], packs[int(path.split("/")[-2].partition("=")[2])][0].day))
        if key:
            self._write_filters(folder, schema, new, key)
        gone = {path for path, _ in number}
        kept = [f for f in state.files if f.path not in gone]
        self.tables[table] = replace(state, files=(*kept, *sorted(new, key=lambda f: f.path)))
        return [[f.path for f in pack] for pack in packs]

    # ---------------------------------------------------------------------------------------------- filters
    def _write_filters(self, folder: str, schema: T.StructType, files: list[DataFile], key: str) -> None:
        spark, root = self.store.spark, self.store.root
        blocks = [(f.path, max(LEAST_BLOCKS, 1 << (max(1, f.rows * BITS_A_KEY // BLOCK_BITS)).bit_length())) for f in files]
        sizes = spark.createDataFrame(blocks, "path string, blocks int")
        rows = spark.read.schema(schema).parquet(*[f"{root}/{f.path}" for f in files]).where(F.col(key).isNotNull())
        own = F.concat(F.lit(folder), F.element_at(F.split(F.col("_metadata.file_path"), folder), -1))
        rows = rows.select(own.alias("path"), F.xxhash64(key).alias("h")).join(F.broadcast(sizes), "path")
        bits = rows.select("path", "blocks", F.pmod("h", F.col("blocks")).cast("int").alias("block"), F.explode(_places()).alias("at"))
        word = F.shiftright("at", 6)
        words = bits.groupBy("path", "blocks", "block", word.alias("word")).agg(
            F.bit_or(F.expr("shiftleft(1L, at & 63)")).alias("bits")
        )
        held = F.map_from_entries(F.collect_list(F.struct("word", "bits")))
        every = F.transform(F.sequence(F.lit(0), F.lit(BLOCK_BITS // 64 - 1)), lambda w: F.coalesce(F.col("m")[w], F.lit(0).cast("long")))
        filters = words.groupBy("path", "blocks", "block").agg(held.alias("m")).select("path", "blocks", "block", every.alias("words"))
        self.write(filters, f"{folder}-filters")

    def files_with(self, state: TableState, rows: DataFrame, key: str) -> list[str]:
        """Paths of the base files whose filter takes at least one key of ``rows``."""
        live = {f.path for f in state.of("base")}
        folders = sorted({p.rsplit("/", 2)[0] for p in live})
        if not folders:
            return []
        filters = self.store.spark.read.schema("path string, blocks int, block int, words array<long>").parquet(
            *[f"{self.store.root}/{f}-filters" for f in folders]
        )
        sizes = [r["blocks"] for r in filters.select("blocks").distinct().collect()]  # powers of two: a few
        keys = rows.where(F.col(key).isNotNull()).select(F.xxhash64(key).alias("h")).distinct()
        asked = keys.select("h", F.explode(F.array(*[F.lit(s) for s in sorted(sizes)])).alias("blocks"))
        asked = asked.select("blocks", F.pmod("h", F.col("blocks")).cast("int").alias("block"), _places().alias("places"))
        taken = F.forall("places", lambda p: F.getbit(F.get("words", F.shiftright(p, 6)), p.bitwiseAND(F.lit(63))) == 1)
        found = filters.join(asked, ["blocks", "block"]).where(taken).select("path").distinct().collect()
        return sorted(live & {r["path"] for r in found})

    # ----------------------------------------------------------------------------------------------- commit
    def commit(self) -> Version:
        """Publish the draft; on top of other writers' versions if they left its files alone."""
        for _ in range(TRIES):
            version = self.version
            if self.store.publish(version):
                return version
            self.rebase(self.store.version())
        raise Conflict("other writers commit all the time")

    def rebase(self, now: Version) -> None:
        """Put this draft's changes on top of ``now``."""
        for stream, batch in self.batches.items():
            if now.batches.get(stream, -1) >= batch:
                raise Conflict(f"batch {batch} of {stream} has been committed by another run")
        moved = {}
        for name, state in self.tables.items():
            before = self.base.tables.get(name, TableState(state.schema))
            current = now.tables.get(name, TableState(state.schema))
            gone = {f.path for f in before.files} - {f.path for f in state.files}
            added = [f for f in state.files if f.path not in {g.path for g in before.files}]
            changed = before.touched != state.touched
            if gone - {f.path for f in current.files} or (changed and current != before):
                raise Conflict(f"files of {name} have been changed by another run")
            kept = [f for f in current.files if f.path not in gone]
            moved[name] = replace(current, schema=state.schema, files=(*kept, *added), touched=state.touched if changed else current.touched)
        self.base, self.tables = now, moved


def packed(files: list[DataFile], target_bytes: int) -> list[list[DataFile]]:
    """Files in packs of at most ``target_bytes``: largest first, each into the first pack with room."""
    packs: list[list[DataFile]] = []
    room: list[int] = []
    for f in sorted(files, key=lambda f: (-f.bytes, f.path)):
        k = next((i for i, r in enumerate(room) if r >= f.bytes), None)
        if k is None:
            packs.append([])
            room.append(target_bytes)
            k = len(packs) - 1
        packs[k].append(f)
        room[k] -= f.bytes
    return packs


def _places() -> Column:
    """The bits of a key inside its block, from its hash ``h``."""
    return F.array(*[F.pmod(F.xxhash64("h", F.lit(i)), F.lit(BLOCK_BITS)).cast("int") for i in range(1, PROBES + 1)])

