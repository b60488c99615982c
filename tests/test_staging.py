"""Staging (B1-B7)."""

from pyspark.sql import functions as F

from helpers import rows, stg_alerts, stg_tx
from riskstream.operators import staging


def test_odd_hours_and_flags(spark):
    times = ["2026-04-18T01:59:59.000Z", "2026-04-18T02:00:00.000Z",
             "2026-04-18T04:59:59.999Z", "2026-04-18T05:00:00.000Z"]
    data = [{"occurred_at": t, "merchant_category_code": m, "channel": c}
            for t, m, c in zip(times, ["6011", "7995", "5411", None],
                               ["card_not_present", "atm", "card_present", "card_not_present"])]
    got = rows(stg_tx(spark, data), "txn_hour", "is_odd_hours", "is_high_risk_mcc", "is_cnp")
    assert got == [(1, False, True, True), (2, True, True, False), (4, True, False, False),
                   (5, False, None, True)]


def test_bad_timestamp_becomes_null(spark):
    df = stg_tx(spark, [{"occurred_at": "not a time"}, {"occurred_at": "2026-04-18T10:00:00Z"}])
    assert df.where(F.col("occurred_at").isNull()).count() == 1


def test_severity_weight(spark):
    data = [{"severity": s, "occurred_at": "2026-04-18T10:00:00.000Z"}
            for s in ["critical", "high", "medium", "low", None, "weird"]]
    got = [r[0] for r in stg_alerts(spark, data).select("severity_weight").collect()]
    assert sorted(got) == [1, 1, 1, 2, 3, 4]


def test_latest_kyc_last_write_wins(spark):
    kyc = spark.createDataFrame(
        [("c1", "low", "pending", "personal", "AU", "2026-04-18T10:00:00Z"),
         ("c1", "pep", "verified", "personal", "AU", "2026-04-18T11:00:00Z"),
         ("c2", "high", "pending", "joint", "AU", "2026-04-18T09:00:00Z")],
        "customer_id string, risk_tier string, kyc_status string, account_type string, "
        "country_of_residence string, updated_at string")
    out = staging.latest_kyc(staging.stg_kyc_profiles(kyc))
    assert rows(out, "customer_id", "risk_tier", "kyc_status") == [
        ("c1", "pep", "verified"), ("c2", "high", "pending")]


def test_dedupe_events(spark):
    df = stg_tx(spark, [{"transaction_id": "t1", "occurred_at": "2026-04-18T10:00:00Z"},
                        {"transaction_id": "t2", "occurred_at": "2026-04-18T10:00:01Z"}])
    dup = df.unionByName(df.where("transaction_id = 't1'"))
    assert staging.dedupe_events(dup, "transaction_id").count() == 2
