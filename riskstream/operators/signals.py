"""Tumbling-window fraud signals (C1-C6) and the known-device helper.

All windows are epoch-aligned tumbling windows (``F.window``).  Each signal is
one hash aggregate on (keys, window): Spark computes partial aggregates per
input partition, so a hot account / device contributes one partial row per
partition and window before the shuffle.  Distinct counts run as a
two-level (Expand) aggregate in batch.  On a streaming input
``distinct_count`` falls back to ``size(collect_set)``; the streaming module
replaces C3, C5 and C6 with dedupe-then-count forms (``streaming.signals``).

The flag column repeats the HAVING condition and is therefore always TRUE;
it is kept because downstream consumers read it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskstream.constants import (
    BURST_MIN_TYPES,
    BURST_WINDOW,
    CNP_MIN_TXNS,
    CNP_WINDOW,
    RING_MIN_CUSTOMERS,
    RING_WINDOW,
    STORM_MIN_FAILURES,
    STORM_WINDOW,
    STRUCTURING_HIGH,
    STRUCTURING_LOW,
    STRUCTURING_MIN_TXNS,
    STRUCTURING_WINDOW,
    VELOCITY_MIN_TXNS,
    VELOCITY_WINDOW,
)
from riskstream.functions.numeric import money_sum
from riskstream.functions.time import interval_micros


def distinct_count(df: DataFrame, col: str, session: str | None = None) -> Column:
    """Exact distinct count; streams keep a per-window set, and so do sessions
    (Spark removes duplicates of a distinct count before it merges sessions)."""
    if df.isStreaming or session is not None:
        return F.size(F.collect_set(col)).cast("bigint")
    return F.count_distinct(F.col(col))


def tumbling_signal(df: DataFrame, keys: list[str], duration: str, measures: dict[str, Column],
                    having: Column, flag: str, ts: str = "occurred_at",
                    where: Column | None = None, watermark: str | None = None,
                    slide: str | None = None, session: str | None = None) -> DataFrame:
    """GROUP BY keys, TUMBLE(ts, duration) ... HAVING ``having``.

    ``having`` is written over the measure names; ``flag`` is the boolean
    column that repeats it.  In streaming, ``watermark`` bounds the state.
    ``slide`` turns the tumbling window into a sliding one, ``session`` into
    sessions: rows of a key no more than that gap apart, whose window ends the
    gap after the last one.  Streams merge sessions in state and give them out
    in append mode.  The defined signals are tumbling.
    """
    if where is not None:
        df = df.where(where)
    if df.isStreaming and watermark:
        df = df.withWatermark(ts, watermark)
    win = F.window(ts, duration, slide)
    if session is not None:
        win = F.session_window(ts, session)
    agg = df.groupBy(*keys, win.alias("w")).agg(
        *[c.alias(n) for n, c in measures.items()])
    return agg.where(having).select(
        *keys, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
        *measures.keys(), having.alias(flag))


def sliding_distinct(df: DataFrame, keys: list[str], duration: str, slide: str,
                     distinct: dict[str, str], ts: str = "occurred_at") -> DataFrame:
    """keys, w (sliding window) and exact distinct counts, name -> column.

    A value counts in a window where it is seen first: where its last time before
    is earlier than the window.  So no task keeps the values of its windows, as
    the copies of a row per window and column in one hash aggregate would.
    """
    rows = reduce(DataFrame.unionByName, [
        df.select(*keys, F.lit(name).alias("_of"), F.col(col).cast("string").alias("_value"),
                  F.col(ts).alias("_at")) for name, col in distinct.items()])
    rows = rows.where(F.col("_value").isNotNull() & F.col("_at").isNotNull())
    by = [*keys, "_of", "_value"]
    if interval_micros(duration) % interval_micros(slide) == 0:
        # Windows are made of whole steps: a row for each value and step will do.
        step = F.window("_at", slide).start.alias("_at")
        rows = rows.select(*by, step).distinct()
    last = F.lag("_at").over(Window.partitionBy(*by).orderBy("_at"))
    seen = rows.withColumn("_last", last).select(
        *keys, "_of", "_last", F.window("_at", duration, slide).alias("w"))
    seen = seen.where(F.col("_last").isNull() | (F.col("_last") < F.col("w.start")))
    return seen.groupBy(*keys, "w").agg(
        *[F.count_if(F.col("_of") == name).alias(name) for name in distinct])


def sliding_storm(failed: DataFrame, keys: list[str], duration: str, slide: str,
                  measures: dict[str, Column], distinct: dict[str, str], having: Column,
                  flag: str, ts: str = "occurred_at") -> DataFrame:
    """A sliding signal with distinct counts (batch); other arguments as
    ``tumbling_signal``."""
    agg = failed.groupBy(*keys, F.window(ts, duration, slide).alias("w")).agg(
        *[c.alias(n) for n, c in measures.items() if n not in distinct])
    counts = sliding_distinct(failed, keys, duration, slide, distinct, ts)
    counts = counts.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("w").alias("_w"), *distinct)
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    out = agg.join(counts, same & (F.col("w.start") == F.col("_w.start")), "left")
    return out.where(having).select(
        *keys, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
        *[F.coalesce(n, F.lit(0).cast("bigint")).alias(n) if n in distinct else F.col(n)
          for n in measures], having.alias(flag))


def velocity_alerts(stg_tx: DataFrame, window: str = VELOCITY_WINDOW,
                    min_txns: int = VELOCITY_MIN_TXNS, watermark: str | None = None,
                    slide: str | None = None) -> DataFrame:
    """>= ``min_txns`` transactions per (account, card) in a tumbling window."""
    return tumbling_signal(
        stg_tx, ["account_id", "card_last4"], window,
        {"txn_count": F.count(F.lit(1)), "total_amount": money_sum("amount")},
        F.col("txn_count") >= min_txns, "is_velocity_breach", watermark=watermark,
        slide=slide)


def cnp_spike(stg_tx: DataFrame, window: str = CNP_WINDOW, min_txns: int = CNP_MIN_TXNS,
              watermark: str | None = None,
              slide: str | None = None) -> DataFrame:
    """>= ``min_txns`` card-not-present transactions per (card, account)."""
    return tumbling_signal(
        stg_tx, ["card_last4", "account_id"], window,
        {"cnp_count": F.count(F.lit(1)), "total_amount": money_sum("amount")},
        F.col("cnp_count") >= min_txns, "is_cnp_spike",
        where=F.col("is_cnp") == F.lit(True), watermark=watermark, slide=slide)


def login_failure_storm(stg_login: DataFrame, window: str = STORM_WINDOW,
                        min_failures: int = STORM_MIN_FAILURES,
                        watermark: str | None = None, slide: str | None = None,
                        session: str | None = None) -> DataFrame:
    """>= ``min_failures`` failed logins per customer in a window."""
    measures = {"failure_count": F.count(F.lit(1)),
                "distinct_ips": distinct_count(stg_login, "ip_address", session),
                "distinct_devices": distinct_count(stg_login, "device_id", session),
                "first_failure_at": F.min("occurred_at"),
                "last_failure_at": F.max("occurred_at")}
    failed, enough = F.col("success") == F.lit(False), F.col("failure_count") >= min_failures
    if slide is not None and session is None and not stg_login.isStreaming:
        return sliding_storm(stg_login.where(failed), ["customer_id"], window, slide, measures,
                             {"distinct_ips": "ip_address", "distinct_devices": "device_id"},
                             enough, "is_brute_force")
    return tumbling_signal(stg_login, ["customer_id"], window, measures, enough, "is_brute_force",
                           where=failed, watermark=watermark, slide=slide, session=session)


def structuring(stg_tx: DataFrame, window: str = STRUCTURING_WINDOW,
                low: float = STRUCTURING_LOW, high: float = STRUCTURING_HIGH,
                min_txns: int = STRUCTURING_MIN_TXNS, watermark: str | None = None,
                slide: str | None = None) -> DataFrame:
    """C4: >= ``min_txns`` amounts in the closed band [low, high] per (account, customer)."""
    return tumbling_signal(
        stg_tx, ["account_id", "customer_id"], window,
        {"qualifying_txn_count": F.count(F.lit(1)), "total_amount": money_sum("amount")},
        F.col("qualifying_txn_count") >= min_txns, "is_structuring_pattern",
        where=F.col("amount").between(low, high), watermark=watermark, slide=slide)


def correlated_alert_burst(stg_alerts: DataFrame, window: str = BURST_WINDOW,
                           min_types: int = BURST_MIN_TYPES,
                           watermark: str | None = None,
                           slide: str | None = None) -> DataFrame:
    """>= ``min_types`` distinct alert types per customer in a window."""
    return tumbling_signal(
        stg_alerts, ["customer_id"], window,
        {"alert_type_count": distinct_count(stg_alerts, "alert_type"),
         "max_confidence_score": F.max("confidence_score")},
        F.col("alert_type_count") >= min_types, "is_compound_fraud", watermark=watermark,
        slide=slide)


def shared_device_ring(stg_tx: DataFrame, window: str = RING_WINDOW,
                       min_customers: int = RING_MIN_CUSTOMERS, drop_null_device: bool = False,
                       watermark: str | None = None,
                       slide: str | None = None) -> DataFrame:
    """One device used by >= ``min_customers`` customers in a window.

    A NULL device id forms a group of its own (as GROUP BY does); pass
    ``drop_null_device=True`` to leave it out.  The distinct count is a
    two-level aggregate keyed by (device, window, customer) first, so a
    device shared by a third of all rows still spreads over the cluster.
    """
    where = F.col("device_id").isNotNull() if drop_null_device else None
    return tumbling_signal(
        stg_tx, ["device_id"], window,
        {"customer_count": distinct_count(stg_tx, "customer_id")},
        F.col("customer_count") >= min_customers, "is_shared_device_ring",
        where=where, watermark=watermark, slide=slide)


def known_customer_devices(stg_tx: DataFrame) -> DataFrame:
    """First / last time each (customer, device) pair was seen."""
    return stg_tx.groupBy("customer_id", "device_id").agg(
        F.min("occurred_at").alias("first_seen_at"),
        F.max("occurred_at").alias("last_seen_at"))
