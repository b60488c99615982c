"""Data quality (G1-G9) on clean and corrupted inputs."""

from pyspark.sql import functions as F

from helpers import at, rows, stg_tx
from riskstream.operators import marks, quality


def test_view_checks_clean_and_corrupt(spark):
    clean = stg_tx(spark, [{"occurred_at": at(i)} for i in range(3)])
    rep = quality.view_checks(clean, "stg_transactions", ["transaction_id", "amount"],
                              ["transaction_id"])
    assert {r.status for r in rep.collect()} == {"pass"}
    bad = stg_tx(spark, [{"transaction_id": "x", "occurred_at": at(0)},
                         {"transaction_id": "x", "occurred_at": at(1), "amount": None},
                         {"transaction_id": "y", "occurred_at": "garbage"}])
    bad = bad.withColumn("risk_tier", F.when(F.col("transaction_id") == "y", "bogus")
                         .otherwise("low"))
    rep = quality.view_checks(bad, "v", ["amount", "occurred_at"], ["transaction_id"],
                              {"risk_tier": ("low", "high")})
    got = rows(rep, "check_name", "column_name", "failures", "status")
    assert got == [("accepted_values", "risk_tier", 1, "fail"),
                   ("not_null", "amount", 1, "fail"),
                   ("not_null", "occurred_at", 1, "fail"),
                   ("unique", "transaction_id", 1, "fail")]


def test_not_null_unique_accepted(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), (None, 2)], "k string, v int")
    assert rows(quality.not_null(df, ["k", "v"]), "column_name", "null_count") == [
        ("k", 1), ("v", 1)]
    assert rows(quality.unique_violations(df, "k"), "k", "n") == [("a", 2)]
    assert rows(quality.accepted_values(df, "k", ["b"]), "k", "n") == [("a", 2)]
    assert quality.duplicate_count(df, "k").first()[0] == 1


def test_freshness_and_staleness(spark):
    df = stg_tx(spark, [{"occurred_at": at(0)}, {"occurred_at": at(100)}])
    as_of = F.lit("2026-04-18 10:04:00").cast("timestamp")
    r = quality.freshness(df, "occurred_at", as_of).first()
    assert (r.age_seconds, r.status) == (140, "pass")
    late = F.lit("2026-04-18 10:05:00").cast("timestamp")
    assert quality.freshness(df, "occurred_at", late).first().status == "fail"
    st = quality.topic_staleness(
        marks.computed({"transactions": ("stg_transactions", df, "occurred_at")}), as_of).first()
    assert (st.published, st.stale_seconds, st.status) == (2, 140, "degraded")


def test_reconcile(spark):
    df = stg_tx(spark, [{"occurred_at": at(0)}, {"occurred_at": at(70)}])
    raw = df.select(F.date_format("occurred_at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("t"))
    raw = raw.unionByName(spark.createDataFrame([("bad",)], "t string"))
    out = quality.reconcile(raw, F.col("t").try_cast("timestamp"), df.limit(1), "occurred_at")
    got = rows(out, "source_count", "staged_count", "missing")
    assert got == [(1, 0, 1), (1, 0, 1), (1, 1, 0)]


def test_cluster_settings_scale_with_input():
    from riskstream.session import cluster_settings
    small = cluster_settings(1e9, 8)
    big = cluster_settings(100e12, 8000)
    assert int(small["spark.sql.shuffle.partitions"]) == 32
    assert int(big["spark.sql.shuffle.partitions"]) == 100_000
    assert big["spark.sql.files.maxPartitionBytes"] == str(512 << 20)
