"""Windowed signals (C1-C6, C8) at their thresholds, one below and at the boundary."""

import random
from datetime import datetime, timedelta

from helpers import at, rows, stg_alerts, stg_logins, stg_tx
from pyspark.sql import functions as F

from riskstream import constants as C
from riskstream.operators import signals


def test_threshold_guard(spark):
    from riskstream.operators.quality import threshold_guard
    got = {r.check_name: r.status for r in threshold_guard(spark).collect()}
    assert set(got.values()) == {"pass"} and len(got) == 4


def test_threshold_defaults_are_pinned():
    # The thresholds the CI guard pins.
    assert (C.VELOCITY_MIN_TXNS, C.CNP_MIN_TXNS, C.STORM_MIN_FAILURES) == (5, 8, 3)
    assert (C.STRUCTURING_LOW, C.STRUCTURING_HIGH, C.STRUCTURING_MIN_TXNS) == (9000, 9999, 2)
    assert (C.BURST_MIN_TYPES, C.RING_MIN_CUSTOMERS) == (2, 2)


def test_velocity_four_vs_five_and_straddle(spark):
    data = [{"account_id": "a4", "occurred_at": at(i)} for i in range(4)]
    data += [{"account_id": "a5", "amount": 2.5, "occurred_at": at(i)} for i in range(5)]
    # 5 rows in 60 s that straddle a minute boundary: 3 + 2, must not fire
    data += [{"account_id": "ax", "occurred_at": at(57 + i)} for i in range(5)]
    out = signals.velocity_alerts(stg_tx(spark, data))
    got = rows(out, "account_id", "txn_count", "total_amount", "is_velocity_breach")
    assert got == [("a5", 5, 12.5, True)]
    w = out.select("window_start", "window_end").first()
    assert (w[1] - w[0]).total_seconds() == 60 and w[0].second == 0


def test_cnp_spike_seven_vs_eight_only_cnp(spark):
    data = [{"account_id": "a7", "channel": "card_not_present", "occurred_at": at(i)}
            for i in range(7)]
    data += [{"account_id": "a7", "channel": "card_present", "occurred_at": at(10)}]
    data += [{"account_id": "a8", "channel": "card_not_present", "occurred_at": at(i * 30)}
             for i in range(8)]
    out = signals.cnp_spike(stg_tx(spark, data))
    assert rows(out, "account_id", "cnp_count") == [("a8", 8)]


def test_login_storm_two_vs_three(spark):
    data = [{"customer_id": "c2", "occurred_at": at(i)} for i in range(2)]
    data += [{"customer_id": "c2", "success": True, "occurred_at": at(5)}]
    data += [{"customer_id": "c3", "ip_address": f"ip{i % 2}", "occurred_at": at(i)}
             for i in range(3)]
    out = signals.login_failure_storm(stg_logins(spark, data))
    got = rows(out, "customer_id", "failure_count", "distinct_ips", "distinct_devices")
    assert got == [("c3", 3, 2, 1)]
    r = out.first()
    assert r.first_failure_at < r.last_failure_at and r.is_brute_force


def test_structuring_band_is_closed(spark):
    amounts = [8999.99, 9000.0, 9999.0, 9999.01, 9999.5]
    data = [{"account_id": "a", "amount": a, "occurred_at": at(i * 60)}
            for i, a in enumerate(amounts)]
    data += [{"account_id": "b", "amount": 9500.0, "occurred_at": at(0)}]
    out = signals.structuring(stg_tx(spark, data))
    assert rows(out, "account_id", "qualifying_txn_count", "total_amount") == [
        ("a", 2, 18999.0)]


def test_alert_burst_needs_two_types(spark):
    data = [{"customer_id": "c1", "alert_type": "velocity", "occurred_at": at(0)},
            {"customer_id": "c1", "alert_type": "velocity", "occurred_at": at(10)},
            {"customer_id": "c2", "alert_type": "velocity", "occurred_at": at(0),
             "confidence_score": 0.5},
            {"customer_id": "c2", "alert_type": "geo_anomaly", "occurred_at": at(20),
             "confidence_score": 0.9}]
    out = signals.correlated_alert_burst(stg_alerts(spark, data))
    assert rows(out, "customer_id", "alert_type_count", "max_confidence_score") == [
        ("c2", 2, 0.9)]


def test_shared_device_ring_and_null_device(spark):
    data = [{"device_id": "d1", "customer_id": "c1", "occurred_at": at(0)},
            {"device_id": "d1", "customer_id": "c1", "occurred_at": at(5)},
            {"device_id": "d2", "customer_id": "c1", "occurred_at": at(0)},
            {"device_id": "d2", "customer_id": "c2", "occurred_at": at(5)},
            {"device_id": None, "customer_id": "c3", "occurred_at": at(0)},
            {"device_id": None, "customer_id": "c4", "occurred_at": at(5)}]
    df = stg_tx(spark, data)
    got = rows(signals.shared_device_ring(df), "device_id", "customer_count")
    assert got == [("d2", 2), (None, 2)]
    assert rows(signals.shared_device_ring(df, drop_null_device=True), "device_id") == [("d2",)]


def test_known_customer_devices(spark):
    data = [{"device_id": "d1", "occurred_at": at(0)}, {"device_id": "d1", "occurred_at": at(9)},
            {"device_id": "d2", "occurred_at": at(3)}]
    out = signals.known_customer_devices(stg_tx(spark, data))
    got = {r.device_id: (r.last_seen_at - r.first_seen_at).total_seconds() for r in out.collect()}
    assert got == {"d1": 9.0, "d2": 0.0}


def test_signal_plans_aggregate_once_with_partial_phase(spark):
    df = stg_tx(spark, [{"occurred_at": at(0)}])
    plan = signals.velocity_alerts(df)._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan  # map-side combine before the shuffle
    ring = signals.shared_device_ring(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" in ring or "count(distinct" in ring.lower()


def test_sliding_storm_counts_without_copies_of_rows(spark):
    """Equal to a plain grouping, also with NULLs, ties and steps that do not
    divide the window; no row is copied per distinct column."""
    r = random.Random(4)
    rows = [(r.choice(["a", "b", None]), r.choice(["x", "y", "z", None]),
             r.choice(["p", "q", None]), datetime(2024, 1, 1) + timedelta(seconds=r.randint(0, 300)),
             r.random() < .1) for _ in range(200)]
    rows.append(("a", "x", "p", None, False))
    df = spark.createDataFrame(rows, "customer_id string, ip_address string, device_id string, "
                                     "occurred_at timestamp, success boolean")
    for slide in ("20 seconds", "25 seconds"):
        got = signals.login_failure_storm(df, slide=slide, window="1 minute", min_failures=2)
        plain = df.where("NOT success").groupBy(
            "customer_id", F.window("occurred_at", "1 minute", slide).alias("w")).agg(
            F.count(F.lit(1)).alias("n"), F.count_distinct("ip_address"),
            F.count_distinct("device_id"), F.min("occurred_at"), F.max("occurred_at")).where("n > 1")
        want = plain.select("customer_id", "w.start", "w.end", *plain.columns[2:], F.lit(True))
        assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, map(tuple, want.collect())))
        assert "gid" not in got._jdf.queryExecution().optimizedPlan().toString()  # of such copies
