"""Time helpers. Every "now" is an explicit ``as_of`` argument so results are
reproducible; all arithmetic works on TIMESTAMP_NTZ wall-clock values and does
not depend on the session time zone."""
from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def epoch_millis(ts_ntz: Column) -> Column:
    """Milliseconds since the epoch of a wall-clock UTC timestamp (truncating)."""
    return F.timestamp_diff("MILLISECOND", F.expr(EPOCH_NTZ), ts_ntz)


def from_epoch_millis(ms: Column) -> Column:
    """Epoch milliseconds -> TIMESTAMP_NTZ (UTC wall clock)."""
    return F.timestamp_add("MILLISECOND", ms, F.expr(EPOCH_NTZ))


def lit_ntz(value: str | _dt.datetime) -> Column:
    if isinstance(value, _dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.expr(f"TIMESTAMP_NTZ'{value}'")


def lit_date(value: str | _dt.date) -> Column:
    return F.expr(f"DATE'{value}'")


def years_between_boundaries(start: Column, end: Column) -> Column:
    """Number of year boundaries crossed (``DATEDIFF('year', a, b)`` semantics):
    2000-12-31 -> 2001-01-01 is 1."""
    return (F.year(end) - F.year(start)).cast("int")


def latency_ms(push_time_ms: Column, as_of_ntz: Column) -> Column:
    """Milliseconds from a push time (epoch ms) to ``as_of``."""
    return F.timestamp_diff("MILLISECOND", from_epoch_millis(push_time_ms), as_of_ntz)


def trunc_ntz(unit: str, ts: Column) -> Column:
    """``date_trunc`` that keeps TIMESTAMP_NTZ (Spark's returns a zoned TIMESTAMP;
    the round trip through the session zone keeps the wall clock)."""
    return F.date_trunc(unit, ts).cast("timestamp_ntz")
