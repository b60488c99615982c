"""Row-pair and anti-join signals: geographic impossibility (C7), device anomalies.

C7 needs each transaction's predecessor per customer (``LAG ... ORDER BY
occurred_at``).  A plain ``Window.partitionBy("customer_id")`` sorts a whole
customer in one task, which breaks when one customer holds a large share of
the rows.  ``lag_by_time_bucket`` computes the same LAG in two levels:

1. LAG inside (customer, time bucket) partitions -- many small sorts;
2. the last row of every (customer, bucket) as an aggregate whose partial
   phase runs before the shuffle, and a LAG over those bucket rows per
   customer, whose size is the number of non-empty buckets, not the number of
   transactions;
3. the first row of a bucket takes the previous bucket's last row.

The input is shuffled once (by customer and bucket); the bucket table is
small and joins the big side without moving it.  The result equals the
plain LAG ordered by (occurred_at ASC NULLS LAST, transaction_id ASC), the
tie-breaker making simultaneous transactions deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskstream.constants import (
    CNP_CHANNEL,
    DEVICE_HISTORY_FROM,
    DEVICE_HISTORY_UNTIL,
    DEVICE_MIN_AMOUNT,
    DEVICE_RECENT,
    GEO_FLAG_KM,
    GEO_MAX_MINUTES,
    GEO_MIN_KM,
)
from riskstream.functions.geo import equirectangular_km
from riskstream.functions.numeric import round_numeric
from riskstream.functions.time import (
    ago,
    as_of_column,
    interval_micros,
    minutes_between,
)
from riskstream.functions.time import since as rows_since
from riskstream.operators import positions

# Bucket index for rows without an event time: after every real bucket, as
# NULLs sort last in ascending order.
_NULL_BUCKET = 2**62


def lag_by_time_bucket(df: DataFrame, key: str, ts: str, tie: str, carry: list[str],
                       bucket: str = "1 hour", prev: str = "prev") -> DataFrame:
    """Add struct column ``prev`` = the previous row (``carry`` fields) per ``key``.

    Ordering is (ts ASC NULLS LAST, tie ASC).  ``bucket`` bounds the rows one
    task sorts for one key; it changes the plan, never the result.
    """
    size = interval_micros(bucket)
    # Any non-decreasing function of the time is a valid bucket.
    b = F.coalesce(F.expr(f"unix_micros(`{ts}`) div {size}"), F.lit(_NULL_BUCKET))
    # The key as non-null columns, so that window, aggregate and join all
    # cluster by the same three columns: the rows are shuffled once.
    rows = df.withColumns({"_b": b, "_kn": F.col(key).isNull(),
                           "_k": F.coalesce(F.col(key), F.lit(""))})
    by = ["_k", "_kn", "_b"]
    row = F.struct(*[F.col(c) for c in carry])
    order = [F.col(ts).asc_nulls_last(), F.col(tie).asc()]

    inner = rows.withColumn("_prev_in", F.lag(row).over(Window.partitionBy(*by).orderBy(*order)))

    # Last row of every (key, bucket) as an aggregate: its partial phase runs
    # before the shuffle, so this branch moves one row per bucket and map
    # task instead of a second copy of the input.  Inside a bucket all times
    # are NULL or none is, so (ts, tie) orders exactly like the window (a
    # NULL tie sorts first in both).  A LAG over bucket rows per key then has
    # one row per non-empty bucket, however many rows the key has.
    last = rows.groupBy(*by).agg(F.max_by(row, F.struct(ts, tie)).alias("_last"))
    prev_bucket = last.select(*by, F.lag("_last").over(
        Window.partitionBy("_k", "_kn").orderBy("_b")).alias("_prev_bucket"))
    out = inner.join(prev_bucket, by, "left")
    return out.withColumn(prev, F.coalesce("_prev_in", "_prev_bucket")) \
        .drop(*by, "_prev_in", "_prev_bucket")


def geo_hops(stg_tx: DataFrame, min_km: float = GEO_MIN_KM, flag_km: float = GEO_FLAG_KM,
             max_minutes: float = GEO_MAX_MINUTES, bucket: str = "1 hour",
             since=None, index: dict[str, DataFrame] | None = None) -> DataFrame:
    """C7 with the second transaction's account carried along (for the score).

    ``since`` (a Column) keeps only hops whose second transaction is at or
    after it, without shuffling the history: the LAG runs over the rows
    since then plus each customer's last earlier row, which a ``max_by``
    aggregate with a partial (map-side) phase finds.  With the last-position
    ``index`` (``operators.positions``) that row is looked up, and no history is
    scanned.  Rows without a time sort last and are never a predecessor of a
    timed row, so they can be left out of the earlier part.
    """
    carry = ["transaction_id", "country_code", "latitude", "longitude", "occurred_at"]
    cols = ["customer_id", "account_id", *carry]
    tx = stg_tx.select(*cols)
    if since is not None:
        recent = rows_since(stg_tx, "occurred_at", since).select(*cols)
        if index is None:
            before = tx.where(F.col("occurred_at") < since).groupBy("customer_id").agg(
                F.max_by(F.struct(*cols), F.struct("occurred_at", "transaction_id")).alias("r"))
            before = before.select("r.*")
        else:
            before = positions.last_before(stg_tx, index, since, recent.select("customer_id"))
        tx = recent.unionByName(before)
    with_prev = lag_by_time_bucket(tx, "customer_id", "occurred_at", "transaction_id",
                                   carry, bucket=bucket)
    p = F.col("prev")
    hops = with_prev.where(p["transaction_id"].isNotNull() & p["latitude"].isNotNull())
    km = equirectangular_km(F.col("latitude"), F.col("longitude"), p["latitude"], p["longitude"])
    minutes = minutes_between(F.col("occurred_at"), p["occurred_at"])
    hops = hops.select(
        "customer_id",
        p["transaction_id"].alias("txn1_id"), p["country_code"].alias("txn1_country"),
        p["latitude"].alias("txn1_lat"), p["longitude"].alias("txn1_lon"),
        p["occurred_at"].alias("txn1_time"),
        F.col("transaction_id").alias("txn2_id"), F.col("country_code").alias("txn2_country"),
        F.col("latitude").alias("txn2_lat"), F.col("longitude").alias("txn2_lon"),
        F.col("occurred_at").alias("txn2_time"),
        F.col("account_id").alias("txn2_account_id"),
        km.alias("_km"), minutes.alias("_min"))
    # Filter and flag on the unrounded values, round for output only.
    return hops.where(F.col("_km") > min_km).select(
        *[c for c in hops.columns if not c.startswith("_")],
        round_numeric("_km", 2).alias("approx_distance_km"),
        round_numeric("_min", 2).alias("time_diff_minutes"),
        ((F.col("_km") > flag_km) & (F.col("_min") < max_minutes) & (F.col("_min") > 0))
        .alias("is_impossible"))


def geo_impossible_trips(stg_tx: DataFrame, min_km: float = GEO_MIN_KM,
                         flag_km: float = GEO_FLAG_KM, max_minutes: float = GEO_MAX_MINUTES,
                         bucket: str = "1 hour") -> DataFrame:
    """Consecutive transactions of a customer more than ``min_km`` apart.

    ``is_impossible`` = distance > ``flag_km`` and 0 < minutes < ``max_minutes``;
    rows between ``min_km`` and ``flag_km`` are kept with the flag FALSE.
    """
    return geo_hops(stg_tx, min_km, flag_km, max_minutes, bucket).drop("txn2_account_id")


def device_anomalies(stg_tx: DataFrame, as_of=None, recent: str = DEVICE_RECENT,
                     history_from: str = DEVICE_HISTORY_FROM,
                     history_until: str = DEVICE_HISTORY_UNTIL,
                     min_amount: float = DEVICE_MIN_AMOUNT,
                     with_account: bool = False) -> DataFrame:
    """Recent high-value CNP transactions on a device unseen in the history.

    History = pairs (customer, device) seen in [as_of - history_from,
    as_of - history_until).  A NULL device never matches, so it is flagged.
    Of the history only the candidates' pairs are kept, by a semi join with
    minutes of candidates, before the distinct and the ``left_anti`` join.
    """
    now = as_of_column(stg_tx, "occurred_at", as_of)
    cand = rows_since(stg_tx, "occurred_at", ago(now, recent)).where(
        (F.col("amount") > min_amount) & (F.col("channel") == CNP_CHANNEL))
    wanted = cand.select("customer_id", "device_id").distinct()
    history = rows_since(stg_tx, "occurred_at", ago(now, history_from)).where(
        F.col("occurred_at") < ago(now, history_until)) \
        .select("customer_id", "device_id").join(wanted, ["customer_id", "device_id"], "left_semi") \
        .distinct()
    out = cand.join(history, ["customer_id", "device_id"], "left_anti")
    cols = ["customer_id", "transaction_id", "device_id", "amount", "occurred_at"]
    if with_account:
        cols.append("account_id")
    return out.select(*cols, F.lit(True).alias("is_new_device_candidate"),
                      F.lit(True).alias("is_high_value"), F.lit(True).alias("combined_risk_flag"))


def device_presence(stg_tx: DataFrame, bucket: str = "1 hour") -> DataFrame:
    """(customer, device, bucket) -> first / last time seen in that bucket.

    A compact stand-in for the device history: one row per pair and hour
    however many transactions the pair has (hash aggregate, partial per
    partition).  Streaming keeps it incrementally.
    """
    return stg_tx.groupBy("customer_id", "device_id",
                          F.window("occurred_at", bucket).alias("w")).agg(
        F.min("occurred_at").alias("first_at"), F.max("occurred_at").alias("last_at")
    ).select("customer_id", "device_id", F.col("w.start").alias("bucket_start"),
             F.col("w.end").alias("bucket_end"), "first_at", "last_at")


def seen_between(presence: DataFrame, lo, hi, rows_near_bounds: DataFrame) -> DataFrame:
    """Distinct (customer, device) with a transaction in [lo, hi), from presence.

    A bucket inside the range counts if present; the bucket holding ``lo``
    counts if its last time is >= lo; the bucket holding ``hi`` if its first
    time is < hi.  A bucket holding both bounds cannot be decided from
    first/last, so its pairs come from ``rows_near_bounds``: any staged rows
    that include that bucket (any row inside [lo, hi) is valid evidence, so
    the caller can pass, e.g., the day partition holding ``lo``).
    """
    s, e = F.col("bucket_start"), F.col("bucket_end")
    inside = (s >= lo) & (e <= hi)
    low_edge = (s < lo) & (e > lo) & (e <= hi) & (F.col("last_at") >= lo)
    high_edge = (s >= lo) & (s < hi) & (e > hi) & (F.col("first_at") < hi)
    known = presence.where(inside | low_edge | high_edge).select("customer_id", "device_id")
    t = F.col("occurred_at")
    both = rows_near_bounds.where((t >= lo) & (t < hi)).select("customer_id", "device_id")
    return known.unionByName(both).distinct()


def device_anomalies_from_presence(recent_tx: DataFrame, presence: DataFrame,
                                   rows_near_bounds: DataFrame, as_of,
                                   recent: str = DEVICE_RECENT,
                                   history_from: str = DEVICE_HISTORY_FROM,
                                   history_until: str = DEVICE_HISTORY_UNTIL,
                                   min_amount: float = DEVICE_MIN_AMOUNT,
                                   with_account: bool = False) -> DataFrame:
    """C9 with the history taken from ``device_presence`` (same rows as
    ``device_anomalies``).  ``recent_tx`` needs only the last ``recent``;
    ``rows_near_bounds`` only the bucket that may hold both history bounds."""
    now = as_of_column(recent_tx, "occurred_at", as_of)
    t = F.col("occurred_at")
    cand = recent_tx.where((F.col("amount") > min_amount) & (F.col("channel") == CNP_CHANNEL)
                           & (t >= ago(now, recent)))
    lo, hi = ago(now, history_from), ago(now, history_until)
    known = seen_between(presence, lo, hi, rows_near_bounds)
    out = cand.join(known, ["customer_id", "device_id"], "left_anti")
    cols = ["customer_id", "transaction_id", "device_id", "amount", "occurred_at"]
    if with_account:
        cols.append("account_id")
    return out.select(*cols, F.lit(True).alias("is_new_device_candidate"),
                      F.lit(True).alias("is_high_value"), F.lit(True).alias("combined_risk_flag"))
