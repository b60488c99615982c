"""Signals against pure-Python brute force on random small fixtures."""

import random
from collections import defaultdict
from datetime import timedelta

import pytest

from helpers import T0, iso, rows, stg_tx
from riskstream.operators import pairs, signals


def _random_tx(seed, n=500, start=3300, span=600):
    """Dense random rows; the default span crosses an hour boundary."""
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        t = T0 + timedelta(seconds=start + rnd.randint(0, span),
                           microseconds=rnd.randint(0, 999) * 1000)
        out.append({
            "transaction_id": f"t{i:04d}",
            "account_id": f"a{rnd.randint(0, 2)}",
            "customer_id": f"c{rnd.randint(0, 3)}",
            "card_last4": f"{rnd.randint(0, 1):04d}",
            "device_id": rnd.choice(["d0", "d1", "d2", None]),
            "amount": rnd.choice([100.0, 9000.0, 9500.0, 9999.0, 9999.5, 600.0]),
            "channel": rnd.choice(["card_not_present", "card_present", "atm"]),
            "latitude": rnd.choice([-33.8688, 51.5074, 40.0]),
            "longitude": rnd.choice([151.2093, -0.1278, -74.0]),
            "occurred_at": iso(t),
        })
    return out


def _parse(s):
    from datetime import datetime
    return datetime.strptime(s, "%Y-%m-%dT%H:%M:%S.%fZ")


def _bucket(t, seconds):
    epoch = int((t - T0.replace(hour=0, minute=0, second=0)).total_seconds())
    return epoch // seconds


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_windowed_signals_brute_force(spark, seed):
    data = _random_tx(seed)
    df = stg_tx(spark, data)

    def brute(keyf, seconds, cond, threshold, distinct=None):
        groups = defaultdict(list)
        for r in data:
            if cond(r):
                groups[(keyf(r), _bucket(_parse(r["occurred_at"]), seconds))].append(r)
        out = {}
        for k, rs in groups.items():
            n = len({distinct(r) for r in rs}) if distinct else len(rs)
            if n >= threshold:
                out[k] = n
        return out

    def spark_map(out, keys, seconds, measure):
        return {(tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]],
                 _bucket(r.window_start, seconds)): r[measure] for r in out.collect()}

    assert signals.velocity_alerts(df).count() > 0
    assert signals.cnp_spike(df).count() > 0
    assert spark_map(signals.velocity_alerts(df), ["account_id", "card_last4"], 60,
                     "txn_count") == brute(lambda r: (r["account_id"], r["card_last4"]), 60,
                                           lambda r: True, 5)
    assert spark_map(signals.cnp_spike(df), ["card_last4", "account_id"], 300,
                     "cnp_count") == brute(lambda r: (r["card_last4"], r["account_id"]), 300,
                                           lambda r: r["channel"] == "card_not_present", 8)
    assert spark_map(signals.structuring(df), ["account_id", "customer_id"], 3600,
                     "qualifying_txn_count") == brute(
        lambda r: (r["account_id"], r["customer_id"]), 3600,
        lambda r: 9000 <= r["amount"] <= 9999, 2)
    assert spark_map(signals.shared_device_ring(df), ["device_id"], 3600,
                     "customer_count") == brute(lambda r: r["device_id"], 3600, lambda r: True, 2,
                                                distinct=lambda r: r["customer_id"])


@pytest.mark.parametrize("seed", [4, 5])
def test_geo_brute_force(spark, seed):
    import math
    data = _random_tx(seed, 200, start=0, span=4 * 3600)
    by_cust = defaultdict(list)
    for r in data:
        by_cust[r["customer_id"]].append(r)
    want = []
    for c, rs in by_cust.items():
        rs = sorted(rs, key=lambda r: (r["occurred_at"], r["transaction_id"]))
        for p, r in zip(rs, rs[1:]):
            dy = (r["latitude"] - p["latitude"]) * 111.0
            dx = (r["longitude"] - p["longitude"]) * 111.0 * abs(
                math.cos(math.radians((r["latitude"] + p["latitude"]) / 2)))
            km = math.sqrt(dy * dy + dx * dx)
            mins = (_parse(r["occurred_at"]) - _parse(p["occurred_at"])).total_seconds() / 60
            if km > 500:
                want.append((c, p["transaction_id"], r["transaction_id"],
                             km > 1000 and 0 < mins < 120))
    for bucket in ["1 minute", "1 hour"]:
        got = rows(pairs.geo_impossible_trips(stg_tx(spark, data), bucket=bucket),
                   "customer_id", "txn1_id", "txn2_id", "is_impossible")
        assert got == sorted(want)
