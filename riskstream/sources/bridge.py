"""Projection of the driver's test tables onto the five event streams.

The test data has no banking events; this module derives them from the
``events`` and ``customer`` tables, deterministically, so every signal has
rows to find.  It is test scaffolding and lives apart from the operators.
The same projection is written in DuckDB SQL in ``riskstream.plans.oracle``.

Rules (one event row -> at most one row per stream):

* time: 30 days of raw data are compressed into 30 minutes,
  ``occurred_at = T0 + (ts - T0) div COMPRESSION`` (1 raw day = 1 minute),
  rendered as an ISO-8601 ``...Z`` string like the real topics;
  (``compression=10`` gives the wide timeline: three days, odd hours included);
* ``k`` is the integer in ``props`` (0..99) and drives the categorical fields;
  ``k = 7`` has no device;
* transactions: every event, amounts with cents; logins: ``error`` (failed) and
  ``click`` (ok); card events: ``purchase``; alerts: every ``signup`` / ``view``,
  of the type that ``k`` chooses;
* KYC: one profile per customer (users without a customer row stay
  ``unknown``), plus a later update for balances of at least 5000 (latest
  write wins).

Every step is a narrow projection or filter: no shuffle, scales with input.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskstream import schemas

T0 = "2024-01-01 00:00:00"
T0_MICROS = 1_704_067_200_000_000
COMPRESSION = 1440
WIDE_COMPRESSION = 10
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"

# Fixed values of the projection (bridge only).
LONDON = (51.5074, -0.1278, "GB")
SYDNEY = (-33.8688, 151.2093, "AU")
LONDON_K = 50
MCC_BY_K10 = {0: "6011", 1: "7995", 2: "6051"}
OTHER_MCC = "5411"
FAILURE_REASONS = ("wrong_password", "account_locked", "2fa_failed", "session_expired")
CARD_EVENT_TYPES = ("block", "unblock", "reissue", "pin_change", "limit_change")
CARD_INITIATORS = ("customer", "bank", "fraud_system")
ALERT_EVENTS = ("signup", "view")
ALERT_TYPES = ("velocity", "geo_anomaly", "account_takeover", "card_not_present",
               "device_fingerprint", "structuring")  # k % 6; rule n + 1
NO_DEVICE_K = 7
SEVERITY_BY_K5 = {0: "low", 1: "medium", 2: "high", 3: "critical"}  # 4 -> NULL
KYC_TIER_BY_SEGMENT = {
    "AUTOMOBILE": "low", "BUILDING": "medium", "FURNITURE": "high",
    "HOUSEHOLD": "pep", "MACHINERY": "sanctioned",
}
ACCOUNT_TYPES = ("personal", "business", "joint")
KYC_UPDATE_BALANCE = 5000


def _pick(index: Column, values) -> Column:
    """values[index] for a small fixed tuple (CASE chain)."""
    out = F.when(index == 0, F.lit(values[0]))
    for i, v in enumerate(values[1:], start=1):
        out = out.when(index == i, F.lit(v))
    return out


def _k() -> Column:
    """The integer ``k`` of the ``props`` JSON."""
    return F.from_json("props", "k INT")["k"]


def _iso(ts: Column) -> Column:
    return F.date_format(ts, ISO_FORMAT)


def _enriched(events: DataFrame, compression: int) -> DataFrame:
    """Common derived columns of an ``events`` row."""
    k = _k()
    occurred = F.timestamp_micros(F.lit(T0_MICROS) + F.expr(
        f"(unix_micros(cast(ts AS timestamp)) - {T0_MICROS}) div {compression}"))
    london = k == LONDON_K
    uid = F.col("user_id").cast("string")
    eid = F.col("event_id").cast("string")
    return events.select(
        "event_id", "user_id", "event_type", "value",
        k.alias("k"),
        _iso(occurred).alias("occurred_at"),
        F.concat(F.lit("cust-"), uid).alias("customer_id"),
        F.concat(F.lit("acc-"), uid, F.lit("-"), (F.col("event_id") % 2).cast("string"))
        .alias("account_id"),
        F.when(k == NO_DEVICE_K, F.lit(None).cast("string"))
        .when(k >= 95, F.concat(F.lit("new-"), eid))
        .when(k % 20 == 0, F.concat(F.lit("shared-"), k.cast("string")))
        .otherwise(F.concat(F.lit("dev-"), uid, F.lit("-"), (k % 3).cast("string")))
        .alias("device_id"),
        F.concat(F.lit("10.0."), (F.col("user_id") % 256).cast("string"), F.lit("."),
                 (k % 8).cast("string")).alias("ip_address"),
        F.when(london, F.lit(LONDON[0])).otherwise(F.lit(SYDNEY[0])).alias("latitude"),
        F.when(london, F.lit(LONDON[1])).otherwise(F.lit(SYDNEY[1])).alias("longitude"),
        F.when(london, F.lit(LONDON[2])).otherwise(F.lit(SYDNEY[2])).alias("country_code"),
    )


def transactions(events: DataFrame, compression: int = COMPRESSION) -> DataFrame:
    e = _enriched(events, compression)
    k = F.col("k")
    mcc = F.coalesce(_pick(k % 10, [MCC_BY_K10[i] for i in range(3)]), F.lit(OTHER_MCC))
    out = e.select(
        F.concat(F.lit("txn-"), F.col("event_id").cast("string")).alias("transaction_id"),
        "account_id", "customer_id",
        (F.col("value").cast("decimal(12,2)") * 100
         + (F.col("event_id") % 100).cast("decimal(12,2)") / 100).cast("double").alias("amount"),
        F.lit("AUD").alias("currency"),
        F.concat(F.lit("mer-"), (k % 25).cast("string")).alias("merchant_id"),
        mcc.alias("merchant_category_code"),
        F.concat(F.lit("Merchant "), (k % 25).cast("string")).alias("merchant_name"),
        F.when(k % 4 <= 1, F.lit("card_not_present")).when(k % 4 == 2, F.lit("card_present"))
        .otherwise(F.lit("atm")).alias("channel"),
        F.lpad(((F.col("user_id") * 2 + F.col("event_id") % 2) % 10000).cast("string"), 4, "0")
        .alias("card_last4"),
        "device_id", "ip_address", "latitude", "longitude", "country_code", "occurred_at",
        F.when(F.col("event_type") == "error", F.lit("declined"))
        .when(F.col("event_type") == "purchase", F.lit("approved"))
        .otherwise(F.lit("pending")).alias("status"),
    )
    return out.select([F.col(f.name).cast(f.dataType) for f in schemas.TRANSACTIONS])


def login_events(events: DataFrame, compression: int = COMPRESSION) -> DataFrame:
    e = _enriched(events.where(F.col("event_type").isin("error", "click")), compression)
    failed = F.col("event_type") == "error"
    out = e.select(
        F.concat(F.lit("login-"), F.col("event_id").cast("string")).alias("event_id"),
        "customer_id", "device_id", "ip_address", "country_code", "latitude", "longitude",
        F.lit("bridge/1.0").alias("user_agent"),
        (~failed).alias("success"),
        F.when(failed, _pick(F.col("k") % 4, FAILURE_REASONS)).alias("failure_reason"),
        "occurred_at",
    )
    return out.select([F.col(f.name).cast(f.dataType) for f in schemas.LOGIN_EVENTS])


def card_events(events: DataFrame, compression: int = COMPRESSION) -> DataFrame:
    e = _enriched(events.where(F.col("event_type") == "purchase"), compression)
    out = e.select(
        F.concat(F.lit("card-"), F.col("event_id").cast("string")).alias("event_id"),
        "account_id", "customer_id",
        F.lpad(((F.col("user_id") * 2 + F.col("event_id") % 2) % 10000).cast("string"), 4, "0")
        .alias("card_last4"),
        _pick(F.col("k") % 5, CARD_EVENT_TYPES).alias("event_type"),
        _pick(F.col("k") % 3, CARD_INITIATORS).alias("initiated_by"),
        "occurred_at",
    )
    return out.select([F.col(f.name).cast(f.dataType) for f in schemas.CARD_EVENTS])


def alert_events(events: DataFrame, compression: int = COMPRESSION) -> DataFrame:
    e = _enriched(events.where(F.col("event_type").isin(*ALERT_EVENTS)), compression)
    kind = F.col("k") % len(ALERT_TYPES)
    out = e.select(
        F.concat(F.lit("alt-"), F.col("event_id").cast("string")).alias("alert_id"),
        "customer_id",
        F.concat(F.lit("txn-"), F.col("event_id").cast("string")).alias("transaction_id"),
        _pick(kind, ALERT_TYPES).alias("alert_type"),
        _pick(F.col("k") % 5, [SEVERITY_BY_K5[i] for i in range(4)]).alias("severity"),
        ((F.col("k") + 50) / 100.0).alias("confidence_score"),
        F.concat(F.lit("RULE_00"), (kind + 1).cast("string")).alias("rule_id"),
        "occurred_at",
    )
    return out.select([F.col(f.name).cast(f.dataType) for f in schemas.ALERT_EVENTS])


def kyc_profile_events(customer: DataFrame) -> DataFrame:
    c = customer
    tier = F.coalesce(*[F.when(F.col("c_mktsegment") == s, F.lit(t))
                        for s, t in KYC_TIER_BY_SEGMENT.items()])
    cid = F.concat(F.lit("cust-"), F.col("c_custkey").cast("string"))
    acct = _pick(F.col("c_nationkey") % 3, ACCOUNT_TYPES)
    first = c.select(
        cid.alias("customer_id"), tier.alias("risk_tier"), F.lit("pending").alias("kyc_status"),
        acct.alias("account_type"), F.lit("AU").alias("country_of_residence"),
        _iso(F.timestamp_micros(F.lit(T0_MICROS))).alias("updated_at"),
    )
    update = c.where(F.col("c_acctbal") >= KYC_UPDATE_BALANCE).select(
        cid.alias("customer_id"),
        F.when(tier.isin("low", "medium"), F.lit("high")).otherwise(tier).alias("risk_tier"),
        F.lit("verified").alias("kyc_status"),
        acct.alias("account_type"), F.lit("AU").alias("country_of_residence"),
        _iso(F.timestamp_micros(F.lit(T0_MICROS) + (F.col("c_nationkey") + 1) * 60_000_000))
        .alias("updated_at"),
    )
    out = first.unionByName(update)
    return out.select([F.col(f.name).cast(f.dataType) for f in schemas.KYC_PROFILE_EVENTS])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


class _LazyStreams(dict):
    """Stream name -> DataFrame, each projection built on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str, compression: int):
        super().__init__()
        self._spark, self._dir, self._compression = spark, sf_dir, compression

    def __missing__(self, name: str) -> DataFrame:
        if name == "kyc_profile_events":
            df = kyc_profile_events(read_table(self._spark, self._dir, "customer"))
        else:
            df = BUILDERS[name](self._events(), self._compression)
        self[name] = df
        return df

    def _events(self) -> DataFrame:
        if "_events_df" not in self.__dict__:
            self.__dict__["_events_df"] = read_table(self._spark, self._dir, "events")
        return self.__dict__["_events_df"]


BUILDERS = {"transactions": transactions, "login_events": login_events,
            "card_events": card_events, "alert_events": alert_events}


def raw_streams(spark: SparkSession, sf_dir: str,
                compression: int = COMPRESSION) -> dict[str, DataFrame]:
    """The five source-shaped (string timestamp) streams for a test-data folder.

    Built lazily: a query that needs only transactions never plans the others.
    """
    return _LazyStreams(spark, sf_dir, compression)


def corrupted_streams(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The streams of a faulty feed, for the data-quality checks: by event
    number, some transactions lose their id or customer, have a channel or
    severity nobody accepts, or are delivered twice."""
    streams = _LazyStreams(spark, sf_dir, COMPRESSION)
    n = F.regexp_extract("transaction_id", r"(\d+)$", 1).cast("long")
    tx = streams["transactions"]
    tx = tx.unionByName(tx.where(n % 89 == 0))
    tx = tx.withColumn("_n", n)
    tx = tx.withColumns({
        "transaction_id": F.when(F.col("_n") % 97 != 0, F.col("transaction_id")),
        "customer_id": F.when(F.col("_n") % 101 != 0, F.col("customer_id")),
        "channel": F.when(F.col("_n") % 83 == 0, F.lit("carrier_pigeon")).otherwise(
            F.col("channel"))}).drop("_n")
    streams["transactions"] = tx
    return streams
