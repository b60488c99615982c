"""Explicit source schemas of the five event streams.

Column names *and order* are part of the contract (see ``check_contract``).
Timestamps arrive as ISO-8601 strings and are parsed in staging.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, D, B = T.StringType(), T.DoubleType(), T.BooleanType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


TRANSACTIONS = _schema(
    ("transaction_id", S), ("account_id", S), ("customer_id", S), ("amount", D),
    ("currency", S), ("merchant_id", S), ("merchant_category_code", S),
    ("merchant_name", S), ("channel", S), ("card_last4", S), ("device_id", S),
    ("ip_address", S), ("latitude", D), ("longitude", D), ("country_code", S),
    ("occurred_at", S), ("status", S),
)

LOGIN_EVENTS = _schema(
    ("event_id", S), ("customer_id", S), ("device_id", S), ("ip_address", S),
    ("country_code", S), ("latitude", D), ("longitude", D), ("user_agent", S),
    ("success", B), ("failure_reason", S), ("occurred_at", S),
)

CARD_EVENTS = _schema(
    ("event_id", S), ("account_id", S), ("customer_id", S), ("card_last4", S),
    ("event_type", S), ("initiated_by", S), ("occurred_at", S),
)

ALERT_EVENTS = _schema(
    ("alert_id", S), ("customer_id", S), ("transaction_id", S), ("alert_type", S),
    ("severity", S), ("confidence_score", D), ("rule_id", S), ("occurred_at", S),
)

KYC_PROFILE_EVENTS = _schema(
    ("customer_id", S), ("risk_tier", S), ("kyc_status", S), ("account_type", S),
    ("country_of_residence", S), ("updated_at", S),
)

STREAMS = {
    "transactions": TRANSACTIONS,
    "login_events": LOGIN_EVENTS,
    "card_events": CARD_EVENTS,
    "alert_events": ALERT_EVENTS,
    "kyc_profile_events": KYC_PROFILE_EVENTS,
}

# Event-time column of each stream (after staging).
EVENT_TIME = {
    "transactions": "occurred_at",
    "login_events": "occurred_at",
    "card_events": "occurred_at",
    "alert_events": "occurred_at",
    "kyc_profile_events": "updated_at",
}

# Primary key of each staged stream (declared ``unique`` data tests).
KEYS = {
    "transactions": "transaction_id",
    "login_events": "event_id",
    "card_events": "event_id",
    "alert_events": "alert_id",
    "kyc_profile_events": None,
}
