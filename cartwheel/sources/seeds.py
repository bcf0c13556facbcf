"""CSV seed loading with declared types and a reject output for malformed lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import PRODUCTS_SCHEMA
from ..session import ensure_checkpoint_dir

CORRUPT_COL = "_corrupt_record"


def read_seed_csv(
    spark: SparkSession, path: str, schema: T.StructType = PRODUCTS_SCHEMA
) -> tuple[DataFrame, DataFrame]:
    """Read a headed CSV with a declared schema; return ``(rows, rejects)``.

    PERMISSIVE mode keeps going on a bad line (wrong number of fields, a value that does not parse) and puts
    the raw line into ``_corrupt_record``; those lines form the reject output instead of being loaded with
    NULLs. The scan is checkpointed once, in the shared folder, so both outputs come from one read (Spark refuses queries
    that touch only the corrupt-record column of a raw CSV scan) and nothing stays cached.
    """
    ensure_checkpoint_dir(spark)
    with_corrupt = T.StructType(schema.fields + [T.StructField(CORRUPT_COL, T.StringType())])
    raw = (
        spark.read.option("header", "true")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT_COL)
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
        .schema(with_corrupt)
        .csv(path)
        .checkpoint(eager=True)
    )
    rows = raw.where(F.col(CORRUPT_COL).isNull()).drop(CORRUPT_COL)
    rejects = raw.where(F.col(CORRUPT_COL).isNotNull()).select(F.col(CORRUPT_COL).alias("raw_line"))
    return rows, rejects


def load_products(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The product catalogue seed: typed rows and rejected lines."""
    return read_seed_csv(spark, path, PRODUCTS_SCHEMA)
