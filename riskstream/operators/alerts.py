"""Alert emission (H1): signal rows -> ``alert_events``-shaped rows.

The reference derives alerts from a hidden label of generated transactions;
here the same alert types, severities, confidence ranges and rule ids are
attached to the rows the signals actually found.  The lookup is a literal
map expression (no join); the union is narrow.  Window signals have no
single transaction, so their ``transaction_id`` is NULL and their time is the
window end.  The confidence is reported as its range (no random draw).
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskstream.constants import ALERT_RULES


def _lookup(index: int) -> Column:
    return F.create_map(*chain.from_iterable((F.lit(r[0]), F.lit(r[index])) for r in ALERT_RULES))


def _key(*cols: Column) -> Column:
    return F.concat_ws(":", *[c.cast("string") for c in cols])


def emit_alerts(stg_tx: DataFrame, velocity: DataFrame, cnp: DataFrame, structuring: DataFrame,
                geo: DataFrame, device: DataFrame, pairs: DataFrame) -> DataFrame:
    """Alerts for velocity, CNP spike, structuring, geo, device and odd-hour MCC rows.

    ``pairs`` = distinct (customer_id, account_id); it gives the customer of
    the account-keyed window signals.
    """
    def window_part(df: DataFrame, atype: str, keys: list[str]) -> DataFrame:
        if "customer_id" not in keys:
            df = df.join(pairs, "account_id")
        return df.select(
            _key(F.lit(atype), *[F.col(k) for k in keys], F.unix_micros("window_start"))
            .alias("alert_id"),
            "customer_id", F.lit(None).cast("string").alias("transaction_id"),
            F.lit(atype).alias("alert_type"), F.col("window_end").alias("occurred_at"))

    def txn_part(df: DataFrame, atype: str, txn: str, ts: str) -> DataFrame:
        return df.select(_key(F.lit(atype), F.col(txn)).alias("alert_id"), "customer_id",
                         F.col(txn).alias("transaction_id"), F.lit(atype).alias("alert_type"),
                         F.col(ts).alias("occurred_at"))

    odd_mcc = stg_tx.where(F.col("is_odd_hours") & F.col("is_high_risk_mcc"))
    parts = [
        window_part(velocity, "velocity", ["account_id", "card_last4"]),
        window_part(cnp, "card_not_present", ["account_id", "card_last4"]),
        window_part(structuring, "structuring", ["account_id", "customer_id"]),
        txn_part(geo.where(F.col("is_impossible")), "geo_anomaly", "txn2_id", "txn2_time"),
        txn_part(device, "account_takeover", "transaction_id", "occurred_at"),
        txn_part(odd_mcc, "device_fingerprint", "transaction_id", "occurred_at"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    t = F.col("alert_type")
    return out.select(
        "alert_id", "customer_id", "transaction_id", "alert_type",
        _lookup(1)[t].alias("severity"),
        _lookup(2)[t].cast("double").alias("confidence_min"),
        _lookup(3)[t].cast("double").alias("confidence_max"),
        _lookup(4)[t].alias("rule_id"), "occurred_at")
