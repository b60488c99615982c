"""Event-time helpers: ``as_of`` anchors, tumbling windows, time differences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_of_column(df: DataFrame, ts: str, as_of=None) -> Column:
    """The reference instant of a temporal filter (``NOW()``).

    ``None`` -> the latest event time of ``df`` as a scalar subquery: Spark
    evaluates it once, as a small aggregate job, and pushes the value into the
    consuming scan as a runtime filter.  Nothing is collected by the caller
    and no cross join is planned.  A string or datetime is a literal.
    """
    if as_of is None:
        return df.select(F.max(ts)).scalar()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, str):
        return F.to_timestamp(F.lit(as_of))
    return F.lit(as_of).cast("timestamp")


def ago(anchor: Column, interval: str) -> Column:
    """``anchor - INTERVAL interval``."""
    return anchor - F.expr(f"INTERVAL {interval}")


#: Partition column of tables laid out by event day.
PART = "_part"


def since(df: DataFrame, ts: str, start: Column) -> DataFrame:
    """Rows with ``ts >= start``; of a table laid out by the day of ``ts`` only
    the partitions from that day on are read."""
    if PART in df.columns:
        df = df.where(F.col(PART) >= F.to_date(start))
    return df.where(F.col(ts) >= start)


def window_start(ts: Column, duration: str) -> Column:
    """Epoch-aligned window start like ``F.window(...).start``, but NULL for a
    NULL time instead of dropping the row (used where NULLs must be counted)."""
    d = interval_micros(duration)
    us = F.unix_micros(ts)
    return F.timestamp_micros(us - F.pmod(us, F.lit(d)))


def minutes_between(later: Column, earlier: Column) -> Column:
    """Exact elapsed minutes as double (microsecond resolution)."""
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(60_000_000.0)


def interval_micros(interval: str) -> int:
    """Length of a simple interval literal such as ``'1 hour'`` in µs."""
    n, unit = interval.split()
    unit = unit.lower().rstrip("s")
    scale = {"microsecond": 1, "millisecond": 1_000, "second": 1_000_000,
             "minute": 60_000_000, "hour": 3_600_000_000, "day": 86_400_000_000}
    return int(float(n) * scale[unit])
