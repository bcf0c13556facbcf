"""Small builders for hand-made edge tables."""

import datetime as dt

from pyspark.sql import functions as F

from cartwheel.schemas import BRONZE_COLUMNS, BRONZE_SCHEMA

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"

T0 = dt.datetime(2024, 1, 15, 12, 0, 0)


def ts(minutes=0.0, seconds=0.0, micros=0, base=T0):
    return base + dt.timedelta(minutes=minutes, seconds=seconds, microseconds=micros)


def events(spark, rows):
    """rows: list of dicts with any bronze columns; the rest are NULL (ip_country defaults to BR)."""
    full = []
    for r in rows:
        d = {c: None for c in BRONZE_COLUMNS}
        d["ip_country"] = "BR"
        d.update(r)
        full.append(tuple(d[c] for c in BRONZE_COLUMNS))
    return spark.createDataFrame(full, BRONZE_SCHEMA)


def rows(df, *cols, order=None):
    sel = df.select(*cols) if cols else df
    out = [tuple(r) for r in sel.collect()]
    return sorted(out, key=repr)
