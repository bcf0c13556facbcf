"""Column-level helpers. Every helper returns a built-in Spark ``Column`` (no Python UDFs)."""

from __future__ import annotations

import datetime as _dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
MICROS_PER_SECOND = 1_000_000
MICROS_PER_MINUTE = 60 * MICROS_PER_SECOND
MICROS_PER_HOUR = 60 * MICROS_PER_MINUTE
MICROS_PER_DAY = 24 * MICROS_PER_HOUR

_UNITS = {
    "microsecond": 1,
    "second": MICROS_PER_SECOND,
    "minute": MICROS_PER_MINUTE,
    "hour": MICROS_PER_HOUR,
    "day": MICROS_PER_DAY,
}


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ts_literal(value: str | _dt.datetime) -> Column:
    """A ``TIMESTAMP_NTZ`` literal; independent of the session time zone."""
    if isinstance(value, _dt.datetime):
        value = value.replace(tzinfo=None).isoformat(sep=" ")
    return F.lit(str(value)).cast("timestamp_ntz")


def to_ntz(c: str | Column) -> Column:
    """Text or timestamp -> ``TIMESTAMP_NTZ`` in UTC (the warehouse's ``timestamp(x)``); bad text gives NULL.

    Text with an offset (``...T10:00:00-03:00``) is an instant, so it goes through TIMESTAMP; the session zone must
    be UTC, as everywhere in this library.
    """
    return col_(c).try_cast("timestamp").cast("timestamp_ntz")


def duration_micros(spec: str | int | _dt.timedelta) -> int:
    """'90 minutes', '1 hour 30 minutes', '24 hours', timedelta or microseconds -> microseconds."""
    if isinstance(spec, int):
        return spec
    if isinstance(spec, _dt.timedelta):
        return (spec.days * 86_400 + spec.seconds) * MICROS_PER_SECOND + spec.microseconds
    total = 0
    for amount, unit in re.findall(r"(\d+)\s*([a-z]+?)s?\b", spec.lower()):
        if unit not in _UNITS:
            raise ValueError(f"unknown unit in duration {spec!r}")
        total += int(amount) * _UNITS[unit]
    if total == 0 and spec.strip() not in ("0", ""):
        raise ValueError(f"cannot parse duration {spec!r}")
    return total


def interval(spec: str | int | _dt.timedelta) -> Column:
    """A day-time interval literal of the given duration."""
    us = duration_micros(spec)
    return F.expr(f"make_dt_interval(0, 0, 0, {us / MICROS_PER_SECOND:.6f})")


def epoch_micros(c: str | Column) -> Column:
    """Microseconds since 1970-01-01 of a ``TIMESTAMP_NTZ``, with no time-zone shift."""
    return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH_NTZ), col_(c))


def from_epoch_micros(c: str | Column) -> Column:
    """Inverse of ``epoch_micros``."""
    return F.timestamp_add("MICROSECOND", col_(c), F.expr(_EPOCH_NTZ))


def seconds_between(start: str | Column, end: str | Column) -> Column:
    """Whole seconds from ``start`` to ``end``, truncated toward zero (1.2 s -> 1)."""
    return F.timestamp_diff("SECOND", col_(start), col_(end))


def minutes_between(start: str | Column, end: str | Column) -> Column:
    return F.timestamp_diff("MINUTE", col_(start), col_(end))


def safe_divide(numerator: str | Column, denominator: str | Column) -> Column:
    """NULL when the denominator is 0 or NULL (never raises under ANSI mode)."""
    return F.try_divide(col_(numerator), F.nullif(col_(denominator), F.lit(0)))


def percent(numerator: str | Column, denominator: str | Column) -> Column:
    return safe_divide(numerator, denominator) * F.lit(100)


def money(c: str | Column) -> Column:
    """Exact money value: DECIMAL(28,9) keeps fractions of a cent and makes sums independent of row order."""
    return col_(c).cast("decimal(28,9)")


def iso_text(c: str | Column) -> Column:
    """ISO-8601 text with microseconds, e.g. 2024-01-01T00:00:07.179575."""
    return F.date_format(col_(c), ISO_MICROS)


def in_half_open(c: str | Column, start: Column, end: Column) -> Column:
    return (col_(c) >= start) & (col_(c) < end)
