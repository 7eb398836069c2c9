"""Clocks and differences between timestamps without a zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_clock() -> Column:
    """Wall clock when this row is produced, in ms.

    ``current_timestamp`` is fixed once per micro-batch, before any model call, and would hide the
    time spent in it. This expression is evaluated row by row, above the call it follows.
    """
    ms = F.java_method(F.lit("java.lang.System"), F.lit("currentTimeMillis")).cast("bigint")
    return F.timestamp_millis(ms).cast("timestamp_ntz")


def to_millis(ts: Column) -> Column:
    return F.date_trunc("millisecond", ts).cast("timestamp_ntz")


def plus_millis(ts: Column, ms: Column) -> Column:
    return F.timestamp_add("MILLISECOND", ms.cast("int"), ts)


def millis_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MILLISECOND", start, end)


def event_time(ts: Column) -> Column:
    """Watermarks need a TIMESTAMP; the records carry TIMESTAMP_NTZ (session zone is UTC)."""
    return ts.cast("timestamp")
