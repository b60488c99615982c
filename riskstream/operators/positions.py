"""Last-position index: each customer's newest transaction per period.

The score needs, for customers with recent transactions, the row just before
the look-back (C7, D1b).  The index holds the newest row of every (customer,
day), of every (customer, month) and of every (customer, year), each level
aggregated from the one below.  A probe at an instant reads the staged rows of
one day, the day rows of one month, the month rows of one year, and the year
rows before: at most 30 + 11 + years small partitions, whatever the history
holds, and only customers of the probe go on.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskstream.functions.time import PART

LEVELS = ("day", "month", "year")
KEY = "customer_id"
COLUMNS = ["account_id", "transaction_id", "country_code", "latitude", "longitude", "occurred_at"]


def _newest(rows: DataFrame, *keys) -> DataFrame:
    """Per key the last row by (time, transaction id); partial before the shuffle."""
    last = F.max_by(F.struct(*COLUMNS), F.struct("occurred_at", "transaction_id")).alias("_row")
    return rows.groupBy(*keys).agg(last)


def newest(rows: DataFrame, level: str) -> DataFrame:
    """One level of the index, from transactions or from the level below.

    Rows without a time are nobody's position; rows without a customer share one.
    """
    timed = rows.where(F.col("occurred_at").isNotNull())
    period = F.date_trunc(level, F.col("occurred_at")).alias("period")
    return _newest(timed, KEY, period).select(KEY, "period", "_row.*")


def build(transactions: DataFrame) -> dict[str, DataFrame]:
    """All levels, lazily; a store writes each before the next is derived."""
    out, rows = {}, transactions
    for level in LEVELS:
        out[level] = rows = newest(rows, level)
    return out


def _periods(df: DataFrame, lo: Column | None, hi: Column) -> DataFrame:
    """Rows of the periods in [lo, hi); a table laid out by day is pruned."""
    if PART in df.columns:
        df = df.where(F.col(PART) < F.to_date(hi))
        df = df if lo is None else df.where(F.col(PART) >= F.to_date(lo))
    df = df.where(F.col("period") < hi)
    return df if lo is None else df.where(F.col("period") >= lo)


def last_before(transactions: DataFrame, index: dict[str, DataFrame], at: Column,
                customers: DataFrame) -> DataFrame:
    """The last row before ``at`` of each of ``customers`` (customer_id; NULL is a
    customer of its own): customer_id and ``COLUMNS``."""
    day, month, year = (F.date_trunc(level, at) for level in LEVELS)
    today = transactions
    if PART in today.columns:
        today = today.where(F.col(PART) == F.to_date(at))
    parts = [today.where((F.col("occurred_at") >= day) & (F.col("occurred_at") < at)),
             _periods(index["day"], month, day), _periods(index["month"], year, month),
             _periods(index["year"], None, year)]
    rows = reduce(DataFrame.unionByName, [p.select(KEY, *COLUMNS) for p in parts])
    # An inner join: Spark would copy a semi join, with what it probes for, into
    # every part of the union.
    wanted = customers.select(F.col(KEY).alias("_c")).distinct()
    probed = rows.join(wanted, F.col(KEY).eqNullSafe(F.col("_c")))
    return _newest(probed, KEY).select(KEY, "_row.*")
