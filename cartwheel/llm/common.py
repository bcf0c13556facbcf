"""Helpers shared by the operators of this subpackage: table access, tables in the shared folder, files, batching."""

from __future__ import annotations

import contextvars
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from typing import TypeVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

T = TypeVar("T")
ROWS_A_SLICE = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as named by ``spark.checkpoint.dir``.

    Where the setting is absent the context's own checkpoint folder is taken. Only a local master may go
    without both (tests): it gets a scratch folder.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="cartwheel-shared-"))
    return spark.sparkContext.getCheckpointDir()


_scratch: contextvars.ContextVar[str | None] = contextvars.ContextVar("scratch", default=None)


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder path under the open ``scratch`` folder or else the shared folder; nothing is created yet."""
    return f"{_scratch.get() or shared_dir(spark)}/cartwheel-{label}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """A folder for all that operators store meanwhile, removed at the end.

    Its owner is whoever opens it: results are read lazily, so write them elsewhere before it closes. Without one, stored
    tables and files stay in the shared folder until whoever runs the application empties that.
    """
    folder = shared_folder(spark, "scratch")
    held = _scratch.set(folder)
    try:
        yield folder
    finally:
        _scratch.reset(held)
        at = spark._jvm.org.apache.hadoop.fs.Path(folder)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def column(name: str) -> Column:
    """The column of just this name, be there dots in it."""
    return F.col("`" + name.replace("`", "``") + "`")


def whole_row(docs: DataFrame, label: str) -> Column:
    """All columns of ``docs`` in one struct column."""
    return F.struct(*[column(c).alias(c) for c in docs.columns]).alias(label)


def unfolded(rows: DataFrame, label: str, names: list[str]) -> DataFrame:
    """The columns ``names`` out of the struct column ``label`` and nothing else."""
    return rows.select(*[F.col(label).getField(c).alias(c) for c in names])


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the Python workers this package, once an application, as ``--py-files`` would."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="cartwheel-ship-"), "cartwheel_package.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(package):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(folder, name)
                out.write(path, os.path.relpath(path, os.path.dirname(package)))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)


def map_arrow(df: DataFrame, run, schema) -> DataFrame:
    """``mapInArrow`` with a function of this package, given slices of ROWS_A_SLICE rows: a task turns few texts at
    a time into Python strings."""

    def sliced(batches):
        return run(b.slice(i, ROWS_A_SLICE) for b in batches for i in range(0, b.num_rows, ROWS_A_SLICE))

    ship(df.sparkSession)
    return df.mapInArrow(sliced, schema)


def map_same(df: DataFrame, run) -> DataFrame:
    """``map_arrow`` with a function that returns the columns it is given, whatever their names: it sees them by place."""
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return map_arrow(plain, run, plain.schema).toDF(*df.columns)


def stored(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """Write ``df`` as a Parquet table, in the shared folder unless a path is given, and read it again: lineage ends there."""
    path = path or shared_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def crc32_mod(column: str, modulus: int):
    """crc32 of the value as text, modulo ``modulus`` (a null value counts as empty text)."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


def by_bytes(items: Iterable[T], size, limit: int) -> Iterator[list[T]]:
    """Lists of consecutive items with at most ``limit`` bytes each; a larger item comes alone."""
    held: list[T] = []
    total = 0
    for item in items:
        n = size(item)
        if held and total + n > limit:
            yield held
            held, total = [], 0
        held.append(item)
        total += n
    if held:
        yield held


def open_fs(path: str):
    """(filesystem, path inside it) of a folder URI or a plain path, for files written by tasks."""
    from pyarrow import fs

    if "://" in path:
        return fs.FileSystem.from_uri(path)
    if path.startswith("file:"):
        return fs.LocalFileSystem(), path[len("file:") :]
    return fs.LocalFileSystem(), path
