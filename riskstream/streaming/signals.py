"""Streaming forms of the signals.

Windowed signals (C1-C6): the batch functions run unchanged on a streaming
DataFrame; a watermark bounds the per-window state.  Distinct counts become
dedupe-then-count (C3, C5, C6): no state row holds a set.  In ``update`` mode each micro-batch emits
the groups that changed; counts in a window only grow, so once a group
passes its threshold it stays and an upsert by (keys, window) reproduces the
batch result for every row inside the watermark.  Rows later than the
watermark are dropped (streaming only; batch is exact).

Geo (C7): LAG per customer across micro-batches needs state; ``geochain`` keeps
it by (customer, time bucket) with a tail per customer, freed by event-time
timers.  The distance, minutes and flags are the same Spark expressions as in
batch.  A row that arrives out of order makes its own pair and renews the pair
of the row after it, so the maintained table equals batch for all rows inside
the watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskstream.constants import (
    BURST_MIN_TYPES,
    BURST_WINDOW,
    GEO_FLAG_KM,
    GEO_MAX_MINUTES,
    GEO_MIN_KM,
    RING_MIN_CUSTOMERS,
    RING_WINDOW,
    STORM_MIN_FAILURES,
    STORM_WINDOW,
)
from riskstream.functions.geo import equirectangular_km
from riskstream.functions.numeric import round_numeric
from riskstream.functions.time import minutes_between
from riskstream.operators import signals
from riskstream.streaming import geochain

DEFAULT_WATERMARK = "10 minutes"
#: State of the geo chain: rows of a customer and bucket, in slots.
GEO_BUCKET, GEO_SLOT = "1 hour", "1 minute"


def shared_device_ring_stream(staged_stream: DataFrame, window: str = RING_WINDOW,
                              min_customers: int = RING_MIN_CUSTOMERS,
                              watermark: str = DEFAULT_WATERMARK) -> DataFrame:
    """Streaming C6 with state bounded per (window, device, customer).

    A set of customers per device would put every customer of a hot device
    (or of the NULL device) into one state row.  Instead the stream is first
    de-duplicated on (window, device, customer) -- one small state entry per
    pair, spread over the state partitions -- and the distinct count becomes
    a plain count.  Both operators evict by watermark; update mode.
    """
    w = staged_stream.withWatermark("occurred_at", watermark).select(
        F.window("occurred_at", window).alias("w"), "device_id", "customer_id")
    agg = w.dropDuplicates(["w", "device_id", "customer_id"]).groupBy("w", "device_id") \
        .agg(F.count(F.lit(1)).alias("customer_count"))
    return agg.where(F.col("customer_count") >= min_customers).select(
        "device_id", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
        "customer_count", (F.col("customer_count") >= min_customers).alias("is_shared_device_ring"))


STORM_PARTS = ("storm_counts", "storm_ips", "storm_devices")


def login_failure_storm_streams(staged_logins: DataFrame, window: str = STORM_WINDOW,
                                watermark: str = DEFAULT_WATERMARK) -> dict[str, DataFrame]:
    """Streaming C3 as three bounded aggregates per (customer, window).

    ``storm_counts``: count / first / last failure.  ``storm_ips`` and
    ``storm_devices``: the failed logins de-duplicated on (window, customer,
    value) and counted, so a customer hit from many addresses never holds a
    set in one state row.  ``login_failure_storm_view`` joins the three
    maintained tables and applies the threshold.
    """
    base = staged_logins.where(F.col("success") == F.lit(False)) \
        .withWatermark("occurred_at", watermark) \
        .select(F.window("occurred_at", window).alias("w"), "customer_id", "ip_address",
                "device_id", "occurred_at")

    def out(df: DataFrame) -> DataFrame:
        return df.select("customer_id", F.col("w.start").alias("window_start"),
                         F.col("w.end").alias("window_end"),
                         *[c for c in df.columns if c not in ("w", "customer_id")])

    def distinct(col: str, name: str) -> DataFrame:
        d = base.where(F.col(col).isNotNull()).dropDuplicates(["w", "customer_id", col])
        return out(d.groupBy("w", "customer_id").agg(F.count(F.lit(1)).alias(name)))

    counts = base.groupBy("w", "customer_id").agg(
        F.count(F.lit(1)).alias("failure_count"), F.min("occurred_at").alias("first_failure_at"),
        F.max("occurred_at").alias("last_failure_at"))
    return {"storm_counts": out(counts), "storm_ips": distinct("ip_address", "distinct_ips"),
            "storm_devices": distinct("device_id", "distinct_devices")}


def login_failure_storm_view(counts: DataFrame, ips: DataFrame, devices: DataFrame,
                             min_failures: int = STORM_MIN_FAILURES) -> DataFrame:
    """C3 rows from the three maintained tables (batch read)."""
    keys = ["customer_id", "window_start", "window_end"]
    hit = counts.where(F.col("failure_count") >= min_failures)
    zero = F.lit(0).cast("bigint")
    j = hit.join(ips, keys, "left").join(devices, keys, "left")
    return j.select(*keys, "failure_count",
                    F.coalesce("distinct_ips", zero).alias("distinct_ips"),
                    F.coalesce("distinct_devices", zero).alias("distinct_devices"),
                    "first_failure_at", "last_failure_at",
                    (F.col("failure_count") >= min_failures).alias("is_brute_force"))


BURST_PARTS = ("burst_types", "burst_scores")


def correlated_alert_burst_streams(staged_alerts: DataFrame, window: str = BURST_WINDOW,
                                   watermark: str = DEFAULT_WATERMARK) -> dict[str, DataFrame]:
    """Streaming C5 as two bounded aggregates per (customer, window).

    ``burst_types``: the alerts de-duplicated on (window, customer, type) and
    counted; types are free text, so a set of them in one state row would have
    no bound.  ``burst_scores``: the highest confidence.  A null type counts
    for nothing, as in a distinct count.  ``correlated_alert_burst_view`` joins
    the maintained tables and applies the threshold.
    """
    base = staged_alerts.withWatermark("occurred_at", watermark).select(
        F.window("occurred_at", window).alias("w"), "customer_id", "alert_type",
        "confidence_score")
    types = (base.where(F.col("alert_type").isNotNull())
             .dropDuplicates(["w", "customer_id", "alert_type"])
             .groupBy("w", "customer_id").agg(F.count(F.lit(1)).alias("alert_type_count")))
    scores = base.groupBy("w", "customer_id").agg(
        F.max("confidence_score").alias("max_confidence_score"))
    return {name: df.select("customer_id", F.col("w.start").alias("window_start"),
                            F.col("w.end").alias("window_end"), df.columns[-1])
            for name, df in zip(BURST_PARTS, (types, scores), strict=True)}


def correlated_alert_burst_view(types: DataFrame, scores: DataFrame,
                                min_types: int = BURST_MIN_TYPES) -> DataFrame:
    """C5 rows from the two maintained tables (batch read).  A null customer is
    a group like any other."""
    hit = types.where(F.col("alert_type_count") >= min_types)
    s = scores.select(F.col("customer_id").alias("c"), F.col("window_start").alias("s"),
                      "max_confidence_score")
    on = F.col("customer_id").eqNullSafe(F.col("c")) & (F.col("window_start") == F.col("s"))
    return hit.join(s, on, "left").select(
        "customer_id", "window_start", "window_end", "alert_type_count", "max_confidence_score",
        (F.col("alert_type_count") >= min_types).alias("is_compound_fraud"))


# One query a signal.  The topology keeps C3 and C5 in the bounded parts above;
# C5 as one query holds a set of alert types.
WINDOWED = {
    "velocity_alerts": (signals.velocity_alerts, ["account_id", "card_last4"]),
    "cnp_spike": (signals.cnp_spike, ["card_last4", "account_id"]),
    "structuring": (signals.structuring, ["account_id", "customer_id"]),
    "correlated_alert_burst": (signals.correlated_alert_burst, ["customer_id"]),
    "shared_device_ring": (shared_device_ring_stream, ["device_id"]),
}


def windowed_signal(name: str, staged_stream: DataFrame,
                    watermark: str = DEFAULT_WATERMARK) -> tuple[DataFrame, list[str]]:
    """(streaming signal DataFrame, upsert keys) for one of C1-C6."""
    fn, keys = WINDOWED[name]
    return fn(staged_stream, watermark=watermark), keys + ["window_start"]


def geo_hops_stream(staged_stream: DataFrame, min_km: float = GEO_MIN_KM,
                    flag_km: float = GEO_FLAG_KM, max_minutes: float = GEO_MAX_MINUTES,
                    watermark: str = DEFAULT_WATERMARK, bucket: str = GEO_BUCKET,
                    slot: str = GEO_SLOT) -> DataFrame:
    """Streaming C7: one row per transaction whose pair is new or has changed,
    with the columns of ``geo_hops`` and ``is_hop``.

    Written through ``materialize`` with key ``txn2_id``, the rows with ``is_hop`` (``geo_hops_view``) equal the batch hops of all
    rows that were not later than the watermark.  A pair that a row arriving
    out of order splits is replaced, also by one that is no hop.  Rows without
    an event time make no hop here (they are dead letters on the load path).
    """
    pairs = geochain.pairs(staged_stream, watermark, bucket, slot)
    km = equirectangular_km(F.col("latitude"), F.col("longitude"),
                            F.col("p_latitude"), F.col("p_longitude"))
    minutes = minutes_between(F.col("occurred_at"), F.col("p_occurred_at"))
    known = F.col("p_transaction_id").isNotNull() & F.col("p_latitude").isNotNull()
    return pairs.select(
        "customer_id",
        F.col("p_transaction_id").alias("txn1_id"), F.col("p_country_code").alias("txn1_country"),
        F.col("p_latitude").alias("txn1_lat"), F.col("p_longitude").alias("txn1_lon"),
        F.col("p_occurred_at").alias("txn1_time"),
        F.col("transaction_id").alias("txn2_id"), F.col("country_code").alias("txn2_country"),
        F.col("latitude").alias("txn2_lat"), F.col("longitude").alias("txn2_lon"),
        F.col("occurred_at").alias("txn2_time"), F.col("account_id").alias("txn2_account_id"),
        round_numeric(km, 2).alias("approx_distance_km"),
        round_numeric(minutes, 2).alias("time_diff_minutes"),
        ((km > flag_km) & (minutes < max_minutes) & (minutes > 0)).alias("is_impossible"),
        F.coalesce(known & (km > min_km), F.lit(False)).alias("is_hop"))


def geo_hops_view(table: DataFrame) -> DataFrame:
    """The hops among the maintained pairs."""
    return table.where("is_hop").drop("is_hop")
