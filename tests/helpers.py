"""Fixture builders: staged transactions / logins / alerts from compact tuples."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from riskstream import schemas
from riskstream.operators import staging

T0 = datetime(2026, 4, 18, 10, 0, 0)


def iso(t: datetime) -> str:
    return t.strftime("%Y-%m-%dT%H:%M:%S.%f")[:-3] + "Z"


def at(seconds: float) -> str:
    return iso(T0 + timedelta(seconds=seconds))


TX_DEFAULTS = dict(transaction_id=None, account_id="acc-1", customer_id="cust-1", amount=10.0,
                   currency="AUD", merchant_id="m-1", merchant_category_code="5411",
                   merchant_name="Shop", channel="card_present", card_last4="1234",
                   device_id="dev-1", ip_address="10.0.0.1", latitude=-33.8688,
                   longitude=151.2093, country_code="AU", occurred_at=None, status="approved")


def tx_rows(spark, rows: list[dict]):
    """Raw transactions; each dict overrides the defaults (ids auto-filled)."""
    out = []
    for i, r in enumerate(rows):
        d = {**TX_DEFAULTS, **r}
        d["transaction_id"] = d["transaction_id"] or f"txn-{i}"
        out.append(tuple(d[f.name] for f in schemas.TRANSACTIONS))
    return spark.createDataFrame(out, schemas.TRANSACTIONS)


def stg_tx(spark, rows):
    return staging.stg_transactions(tx_rows(spark, rows))


LOGIN_DEFAULTS = dict(event_id=None, customer_id="cust-1", device_id="dev-1",
                      ip_address="10.0.0.1", country_code="AU", latitude=0.0, longitude=0.0,
                      user_agent="ua", success=False, failure_reason="wrong_password",
                      occurred_at=None)


def stg_logins(spark, rows):
    out = []
    for i, r in enumerate(rows):
        d = {**LOGIN_DEFAULTS, **r}
        d["event_id"] = d["event_id"] or f"evt-{i}"
        out.append(tuple(d[f.name] for f in schemas.LOGIN_EVENTS))
    return staging.stg_login_events(spark.createDataFrame(out, schemas.LOGIN_EVENTS))


ALERT_DEFAULTS = dict(alert_id=None, customer_id="cust-1", transaction_id="txn-1",
                      alert_type="velocity", severity="high", confidence_score=0.87,
                      rule_id="RULE_001", occurred_at=None)


def stg_alerts(spark, rows):
    out = []
    for i, r in enumerate(rows):
        d = {**ALERT_DEFAULTS, **r}
        d["alert_id"] = d["alert_id"] or f"alt-{i}"
        out.append(tuple(d[f.name] for f in schemas.ALERT_EVENTS))
    return staging.stg_alert_events(spark.createDataFrame(out, schemas.ALERT_EVENTS))


def _key(r):
    return tuple((v is None, v) for v in r)


def rows(df, *cols):
    """Sorted tuples; NULLs sort last in each column."""
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=_key)


def col_values(df, col):
    return sorted(r[0] for r in df.select(F.col(col)).collect())
