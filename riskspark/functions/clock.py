"""Epoch milliseconds, minute numbers and days."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MINUTE_MS = 60_000
HOUR_MS = 60 * MINUTE_MS
DAY_MS = 24 * HOUR_MS


def naive_millis(column: str) -> Column:
    """Epoch milliseconds of a `timestamp_ntz` column, whatever the session's time zone."""
    return F.expr(f"timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {column})")


def slot(millis: Column, width_ms: int) -> Column:
    """Number of the `width_ms` wide slot a time falls in, also right before 1970."""
    return F.floor(millis / F.lit(width_ms)).cast("bigint")


def minute_of(millis: Column) -> Column:
    return slot(millis, MINUTE_MS)


def day_of(millis: Column) -> Column:
    """UTC calendar day of an epoch-millisecond column."""
    return F.date_add(F.lit("1970-01-01").cast("date"), slot(millis, DAY_MS).cast("int"))


def hours(n: int) -> int:
    return n * HOUR_MS
