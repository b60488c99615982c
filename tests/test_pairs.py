"""Geo hops (C7) and device anomalies."""

import random

import pytest
from datetime import timedelta

from pyspark.sql import Window
from pyspark.sql import functions as F

from helpers import T0, at, iso, rows, stg_tx
from riskstream.operators import pairs

LONDON = (51.5074, -0.1278)
SYDNEY = (-33.8688, 151.2093)


def test_geo_boundaries(spark):
    # lat step 4.5 deg = 499.5 km (kept? no: must be > 500), 4.6 deg = 510.6 km
    data = [
        {"customer_id": "c1", "latitude": 0.0, "longitude": 0.0, "occurred_at": at(0)},
        {"customer_id": "c1", "latitude": 4.5, "longitude": 0.0, "occurred_at": at(60)},
        {"customer_id": "c1", "latitude": 9.1, "longitude": 0.0, "occurred_at": at(120)},
        # > 1000 km, at 119.9 min -> impossible; at 120 min -> not impossible
        {"customer_id": "c2", "latitude": 0.0, "longitude": 0.0, "occurred_at": at(0)},
        {"customer_id": "c2", "latitude": 10.0, "longitude": 0.0, "occurred_at": at(119.9 * 60)},
        {"customer_id": "c2", "latitude": 0.0, "longitude": 0.0, "occurred_at": at(239.9 * 60)},
        # simultaneous pair: minutes = 0 -> kept but not impossible
        {"customer_id": "c3", "latitude": 0.0, "longitude": 0.0, "occurred_at": at(0),
         "transaction_id": "a"},
        {"customer_id": "c3", "latitude": 20.0, "longitude": 0.0, "occurred_at": at(0),
         "transaction_id": "b"},
        # missing previous latitude -> no hop
        {"customer_id": "c4", "latitude": None, "longitude": 0.0, "occurred_at": at(0)},
        {"customer_id": "c4", "latitude": 30.0, "longitude": 0.0, "occurred_at": at(60)},
    ]
    out = pairs.geo_impossible_trips(stg_tx(spark, data))
    got = rows(out, "customer_id", "approx_distance_km", "time_diff_minutes", "is_impossible")
    assert got == [
        ("c1", 510.6, 1.0, False),
        ("c2", 1110.0, 119.9, True),
        ("c2", 1110.0, 120.0, False),
        ("c3", 2220.0, 0.0, False),
    ]
    assert rows(out.where("customer_id = 'c3'"), "txn1_id", "txn2_id") == [("a", "b")]


def _plain_lag(df):
    w = Window.partitionBy("customer_id").orderBy(F.col("occurred_at").asc_nulls_last(),
                                                  F.col("transaction_id").asc())
    return df.select("customer_id", "transaction_id",
                     F.lag("transaction_id").over(w).alias("prev_id"))


def test_bucketed_lag_equals_plain_lag_with_hot_customer(spark):
    rnd = random.Random(7)
    data = []
    for i in range(600):
        cust = "hot" if rnd.random() < 0.4 else f"c{rnd.randint(0, 20)}"
        t = T0 + timedelta(seconds=rnd.randint(0, 6 * 3600))
        data.append({"customer_id": cust, "transaction_id": f"t{i:04d}",
                     "occurred_at": iso(t) if rnd.random() > 0.02 else None})
    # rows without a customer form their own LAG partition
    data += [{"customer_id": None, "transaction_id": f"n{i}",
              "occurred_at": iso(T0 + timedelta(minutes=17 * i))} for i in range(6)]
    # exact ties on time, broken by id
    data += [{"customer_id": "hot", "transaction_id": f"z{i}", "occurred_at": at(0)}
             for i in range(3)]
    df = stg_tx(spark, data).select("customer_id", "transaction_id", "occurred_at")
    want = rows(_plain_lag(df), "customer_id", "transaction_id", "prev_id")
    for bucket in ["1 second", "7 minutes", "1 hour", "30 days"]:
        got = pairs.lag_by_time_bucket(df, "customer_id", "occurred_at", "transaction_id",
                                       ["transaction_id"], bucket=bucket)
        got = got.select("customer_id", "transaction_id",
                         F.col("prev.transaction_id").alias("prev_id"))
        assert rows(got, "customer_id", "transaction_id", "prev_id") == want, bucket


def test_geo_london_sydney_is_impossible(spark):
    data = [{"customer_id": "c", "latitude": SYDNEY[0], "longitude": SYDNEY[1],
             "occurred_at": at(0)},
            {"customer_id": "c", "latitude": LONDON[0], "longitude": LONDON[1],
             "occurred_at": at(600), "account_id": "acc-9"}]
    hops = pairs.geo_hops(stg_tx(spark, data))
    r = hops.first()
    assert r.is_impossible and r.txn2_account_id == "acc-9" and r.time_diff_minutes == 10.0


def test_device_anomalies_bounds(spark):
    as_of = T0 + timedelta(days=40)
    ts = lambda d=0, s=0: iso(as_of - timedelta(days=d, seconds=s))
    cnp = "card_not_present"
    data = [
        # history: known device d1 seen 2 days ago (inside [30d, 24h))
        {"customer_id": "c1", "device_id": "d1", "occurred_at": ts(2)},
        # seen exactly 24h ago: upper bound is exclusive -> not history
        {"customer_id": "c1", "device_id": "d2", "occurred_at": ts(1)},
        # seen exactly 30 days ago: lower bound inclusive -> history
        {"customer_id": "c1", "device_id": "d3", "occurred_at": ts(30)},
        # recent CNP high value on known / new / boundary devices
        {"customer_id": "c1", "device_id": "d1", "amount": 900.0, "channel": cnp,
         "occurred_at": ts(0, 60), "transaction_id": "known"},
        {"customer_id": "c1", "device_id": "d2", "amount": 900.0, "channel": cnp,
         "occurred_at": ts(0, 60), "transaction_id": "d2-new"},
        {"customer_id": "c1", "device_id": "d3", "amount": 900.0, "channel": cnp,
         "occurred_at": ts(0, 60), "transaction_id": "d3-known"},
        {"customer_id": "c1", "device_id": "dx", "amount": 500.0, "channel": cnp,
         "occurred_at": ts(0, 60), "transaction_id": "at-500"},
        {"customer_id": "c1", "device_id": "dx", "amount": 500.01, "channel": cnp,
         "occurred_at": ts(0, 60), "transaction_id": "above-500"},
        {"customer_id": "c1", "device_id": None, "amount": 700.0, "channel": cnp,
         "occurred_at": ts(0, 60), "transaction_id": "null-device"},
        {"customer_id": "c1", "device_id": "dy", "amount": 700.0, "channel": "card_present",
         "occurred_at": ts(0, 60), "transaction_id": "not-cnp"},
        {"customer_id": "c2", "device_id": "d1", "amount": 700.0, "channel": cnp,
         "occurred_at": ts(0, 11 * 60), "transaction_id": "too-old"},
        {"customer_id": "c2", "device_id": "d1", "amount": 700.0, "channel": cnp,
         "occurred_at": ts(0, 10 * 60), "transaction_id": "at-bound"},
    ]
    out = pairs.device_anomalies(stg_tx(spark, data), as_of=as_of)
    assert [r[0] for r in rows(out, "transaction_id")] == sorted(
        ["above-500", "at-bound", "d2-new", "null-device"])
    flags = "is_new_device_candidate AND is_high_value AND combined_risk_flag"
    assert out.where(flags).count() == 4
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan  # G8: anti-join against the device history


@pytest.mark.parametrize("bounds", [("30 days", "24 hours"), ("50 minutes", "20 minutes"),
                                    ("3 hours", "61 minutes"), ("2 days", "90 minutes")])
def test_device_from_presence_equals_rows(spark, bounds):
    rnd = random.Random(11)
    as_of = T0 + timedelta(days=40)
    data = []
    for i in range(400):
        back = rnd.choice([rnd.randint(0, 3 * 86400), rnd.randint(0, 40 * 86400),
                           rnd.randint(0, 4 * 3600)])
        data.append({"customer_id": f"c{rnd.randint(0, 4)}",
                     "device_id": rnd.choice(["d0", "d1", "d2", "d3", None]),
                     "amount": rnd.choice([100.0, 700.0]),
                     "channel": rnd.choice(["card_not_present", "atm"]),
                     "occurred_at": iso(as_of - timedelta(seconds=back))})
    df = stg_tx(spark, data)
    args = dict(recent="6 hours", history_from=bounds[0], history_until=bounds[1])
    want = rows(pairs.device_anomalies(df, as_of=as_of, **args), "transaction_id")
    from riskstream.functions.time import interval_micros
    lo = as_of - timedelta(microseconds=interval_micros(bounds[0]))
    near = df.where(F.to_date("occurred_at") == F.lit(lo.date()))  # the day holding lo only
    got = pairs.device_anomalies_from_presence(df, pairs.device_presence(df), near, as_of, **args)
    assert rows(got, "transaction_id") == want
    assert len(want) > 0


def test_geo_hops_since_equals_filtered_full(spark):
    rnd = random.Random(5)
    data = []
    for i in range(300):
        data.append({"customer_id": "hot" if rnd.random() < 0.4 else f"c{rnd.randint(0, 9)}",
                     "transaction_id": f"t{i:04d}",
                     "latitude": rnd.choice([-33.8688, 51.5074, 40.0]),
                     "longitude": rnd.choice([151.2093, -0.1278, -74.0]),
                     "occurred_at": iso(T0 + timedelta(seconds=rnd.randint(0, 8 * 3600)))
                     if rnd.random() > 0.02 else None})
    df = stg_tx(spark, data)
    full = pairs.geo_hops(df, bucket="15 minutes")
    cols = ["customer_id", "txn1_id", "txn2_id", "is_impossible", "txn2_account_id"]
    for hours in [0, 1, 3, 7, 9]:
        since = F.lit(T0 + timedelta(hours=hours)).cast("timestamp")
        want = rows(full.where(F.col("txn2_time") >= since), *cols)
        got = rows(pairs.geo_hops(df, bucket="15 minutes", since=since), *cols)
        assert got == want, hours


def test_geo_shuffles_transactions_once(spark):
    """Window, bucket aggregate and join cluster by the same columns: beside the
    rows themselves only aggregates of them are exchanged."""
    from riskstream.plans.views import Views
    tx = Views.from_testdata(spark, "/root/testdata/sf0.001").stg_transactions
    kept = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold",
                                                 "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = pairs.geo_hops(tx)._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in kept.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    lines = plan.splitlines()
    exchanges = [i for i, x in enumerate(lines) if "Exchange hashpartitioning" in x]
    of_rows = [i for i in exchanges if not any(
        n in "".join(lines[i + 1:i + 3]) for n in ("Aggregate", "Window"))
        and "LocalTableScan" not in lines[i + 1] and "_last" not in lines[i + 1]
        and "_prev_bucket" not in lines[i + 1]]
    assert len(of_rows) == 1 and len(exchanges) == 4, plan
