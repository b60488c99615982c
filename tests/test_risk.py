"""Risk score (D1) golden over all 128 flag combinations; cases."""

import itertools
from decimal import Decimal

from pyspark.sql import functions as F
from pyspark.sql import types as T

from helpers import at, rows, stg_alerts, stg_logins, stg_tx
from riskstream.constants import BASE_SCORE, SIGNAL_WEIGHTS
from riskstream.operators import cases, pairs, risk

NAMES = [n for n, _ in SIGNAL_WEIGHTS]


def _expected(bits):
    raw = BASE_SCORE + sum(w for b, (_, w) in zip(bits, SIGNAL_WEIGHTS) if b)
    score = float(min(Decimal("1.0"), raw))
    tier = ("critical" if score > 0.8 else "high" if score > 0.5
            else "medium" if score > 0.3 else "low")
    return score, [n for b, n in zip(bits, NAMES) if b], tier


def test_score_all_128_combinations(spark):
    combos = list(itertools.product([0, 1], repeat=7))
    schema = T.StructType([T.StructField(n, T.IntegerType()) for n in NAMES])
    # NULL stands for "no row in the flag table" and must count as 0
    data = [tuple(b if b else None for b in c) for c in combos]
    df = spark.createDataFrame(data, schema)
    score, signals = risk.score_columns({n: F.col(n) for n in NAMES})
    out = df.select(*NAMES, score.alias("s"), signals.alias("sig"),
                    risk.risk_tier(score).alias("tier")).collect()
    tiers = {}
    for r in out:
        bits = tuple(1 if r[n] else 0 for n in NAMES)
        s, sig, tier = _expected(bits)
        assert (r.s, list(r.sig), r.tier) == (s, sig, tier), bits
        tiers[tier] = tiers.get(tier, 0) + 1
    assert tiers == {"low": 4, "medium": 8, "high": 26, "critical": 90}


def test_decimal_weights_keep_point_three_low(spark):
    # 0.1 + 0.20 (device) is exactly 0.3: tier low, and not resolved (< 0.3 strict)
    df = spark.createDataFrame([(1,)], "device_anomaly int")
    flags = {n: (F.col("device_anomaly") if n == "device_anomaly" else F.lit(None)) for n in NAMES}
    score, _ = risk.score_columns(flags)
    r = df.select(score.alias("s"), risk.risk_tier(score).alias("t")).first()
    assert r.s == 0.3 and r.t == "low"
    scored = df.select(F.lit("a").alias("account_id"), F.lit("c").alias("customer_id"),
                       score.alias("risk_score"))
    assert cases.resolved_cases(scored).count() == 0


def test_recommended_action_order(spark):
    data = [
        (0.55, ["velocity"], "pep", "escalate"),
        (0.95, [], None, "escalate"),
        (0.75, ["structuring"], "low", "monitor"),
        (0.80, ["structuring"], "low", "freeze_account"),
        (0.60, ["velocity"], None, "monitor"),
        (0.65, ["cnp_spike"], "high", "block_card"),
        (0.70, ["geo_impossible"], "sanctioned", "escalate"),
    ]
    df = spark.createDataFrame(data, "s double, sig array<string>, k string, want string")
    got = df.select(cases.recommended_action(F.col("s"), F.col("sig"), F.col("k")).alias("a"),
                    "want").collect()
    assert [r.a for r in got] == [r.want for r in got]


def test_account_score_end_to_end(spark):
    # acc-1 (cust-1): 5 tx in a minute -> velocity; cust-1 also has a login storm.
    # acc-2 belongs to cust-1 too and is active -> gets brute_force via the customer.
    tx = [{"account_id": "acc-1", "customer_id": "cust-1", "occurred_at": at(i)}
          for i in range(5)]
    tx += [{"account_id": "acc-2", "customer_id": "cust-1", "occurred_at": at(30)},
           {"account_id": "acc-3", "customer_id": "cust-3", "occurred_at": at(40)}]
    stx = stg_tx(spark, tx)
    logins = stg_logins(spark, [{"customer_id": "cust-1", "occurred_at": at(i)} for i in range(3)])
    alerts = stg_alerts(spark, [{"customer_id": "cust-9", "occurred_at": at(0)}])
    geo = pairs.geo_hops(stx)
    dev = pairs.device_anomalies(stx, with_account=True)
    out = risk.account_risk_score_snapshot(stx, logins, alerts, geo, dev)
    got = {r.account_id: (r.risk_score, list(r.contributing_signals), r.risk_tier)
           for r in out.collect()}
    assert got == {
        "acc-1": (0.7, ["velocity", "brute_force"], "high"),
        "acc-2": (0.45, ["brute_force"], "medium"),
        "acc-3": (0.1, [], "low"),
    }
    # the unbounded formulation gives the same rows
    from riskstream.operators import signals as s
    full = risk.account_risk_score(stx, s.velocity_alerts(stx), geo, dev, s.cnp_spike(stx),
                                   s.login_failure_storm(logins), s.structuring(stx),
                                   s.correlated_alert_burst(alerts))
    assert rows(full, "account_id", "risk_score") == rows(out, "account_id", "risk_score")
