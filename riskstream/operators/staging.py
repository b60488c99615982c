"""Staging layer (B1-B7): typed, derived and de-duplicated event tables.

Each function is a narrow projection (no shuffle) except ``latest_kyc`` and
``dedupe_events``, which aggregate by key with map-side partial aggregation.
Timestamps are parsed with ``try_cast``: a malformed value becomes
NULL (and is reported by the quality checks) instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskstream.constants import (
    CNP_CHANNEL,
    DEFAULT_SEVERITY_WEIGHT,
    HIGH_RISK_MCC,
    ODD_HOURS,
    SEVERITY_WEIGHTS,
)


def parse_ts(col: str) -> Column:
    """ISO-8601 string (``...Z`` or with offset) -> TIMESTAMP, NULL when unparsable.

    ``try_cast`` accepts the same ISO forms as ``try_to_timestamp`` without a
    pattern and is cheaper per row.
    """
    return F.col(col).try_cast("timestamp")


def _with_ts(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn(col, parse_ts(col))


def stg_transactions(tx: DataFrame) -> DataFrame:
    """B1: 17 source columns with ``occurred_at`` typed, plus four flags."""
    out = _with_ts(tx, "occurred_at")
    hour = F.hour("occurred_at")
    return out.select(
        *tx.columns,
        hour.alias("txn_hour"),
        hour.between(*ODD_HOURS).alias("is_odd_hours"),
        (F.col("channel") == CNP_CHANNEL).alias("is_cnp"),
        F.col("merchant_category_code").isin(*HIGH_RISK_MCC).alias("is_high_risk_mcc"),
    )


def stg_login_events(logins: DataFrame) -> DataFrame:
    """B2."""
    return _with_ts(logins, "occurred_at")


def stg_card_events(cards: DataFrame) -> DataFrame:
    """B3."""
    return _with_ts(cards, "occurred_at")


def severity_weight(col: str = "severity") -> Column:
    out = None
    for name, weight in SEVERITY_WEIGHTS:
        cond = F.col(col) == name
        out = F.when(cond, F.lit(weight)) if out is None else out.when(cond, F.lit(weight))
    return out.otherwise(F.lit(DEFAULT_SEVERITY_WEIGHT))


def stg_alert_events(alerts: DataFrame) -> DataFrame:
    """Typed time plus ``severity_weight`` (NULL / unknown -> 1)."""
    return _with_ts(alerts, "occurred_at").withColumn("severity_weight", severity_weight())


def stg_kyc_profiles(kyc: DataFrame) -> DataFrame:
    """B5."""
    return _with_ts(kyc, "updated_at")


def latest_kyc(kyc: DataFrame) -> DataFrame:
    """Last write wins per customer (``DISTINCT ON ... ORDER BY updated_at DESC``).

    ``max_by`` over a struct ordered by (updated_at, other columns) is an
    aggregate with a partial (map-side) phase: a customer with millions of
    profile events is reduced per partition before the shuffle, so no task
    ever holds a whole hot group.  The extra struct fields break ties
    deterministically.
    """
    value_cols = ["risk_tier", "kyc_status", "account_type", "country_of_residence"]
    order = F.struct("updated_at", *value_cols)
    latest = kyc.groupBy("customer_id").agg(
        F.max_by(F.struct("updated_at", *value_cols), order).alias("r"))
    return latest.select("customer_id", *[F.col(f"r.{c}").alias(c) for c in value_cols],
                         F.col("r.updated_at").alias("updated_at"))


def dedupe_events(df: DataFrame, id_col: str, ts_col: str | None = None,
                  watermark: str | None = None) -> DataFrame:
    """B7 (opt-in): drop at-least-once duplicates by event id.

    Batch: ``dropDuplicates`` (hash aggregate, partial per partition).
    Streaming: ``dropDuplicatesWithinWatermark`` so the state stays bounded.
    """
    if df.isStreaming:
        if ts_col is None or watermark is None:
            raise ValueError("streaming dedupe needs ts_col and watermark")
        return df.withWatermark(ts_col, watermark).dropDuplicatesWithinWatermark([id_col])
    return df.dropDuplicates([id_col])
