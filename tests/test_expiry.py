"""The streaming score with timers equals the batch score at several instants."""

import os
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helpers import rows
from riskstream.operators import risk
from riskstream.streaming import expiry
from riskstream.streaming import materialize as mat

T0 = datetime(2026, 4, 18, 10, 0)
EMPTY = {
    "velocity_alerts": "account_id string, window_start timestamp, window_end timestamp, "
                       "is_velocity_breach boolean",
    "cnp_spike": "account_id string, window_start timestamp, window_end timestamp, "
                 "is_cnp_spike boolean",
    "structuring": "account_id string, customer_id string, window_start timestamp, "
                   "window_end timestamp, is_structuring_pattern boolean",
    "geo_hops": "txn2_account_id string, txn2_time timestamp, is_impossible boolean",
    "device_anomalies": "account_id string, occurred_at timestamp, combined_risk_flag boolean",
    "login_failure_storm": "customer_id string, window_start timestamp, window_end timestamp, "
                           "is_brute_force boolean",
    "correlated_alert_burst": "customer_id string, window_start timestamp, window_end timestamp, "
                              "is_compound_fraud boolean"}
m = lambda x: T0 + timedelta(minutes=x)


def at_minute(k: int) -> dict[str, list[tuple]]:
    """What becomes known around minute ``k``: accounts shared by customers, customers
    with several accounts, ones that fall silent, null ids, flags that are false."""
    out = {n: [] for n in EMPTY}
    c = f"c{k % 5}"
    out["tx"] = [(f"a{k % 7}", c, m(k)), (f"a{k % 3}", c, m(k - 1) if k % 2 else m(k))]
    if k < 20:
        out["tx"] += [("early", "gone", m(k)), (None, "c1", m(k)), ("a1", None, m(k))]
    if k % 11 == 0:
        out["velocity_alerts"].append((f"a{k % 7}", m(k), m(k + 5), True))
        out["geo_hops"] += [(f"a{(k + 1) % 7}", m(k), k % 2 == 0), (None, m(k), True)]
    if k % 17 == 0:
        out["cnp_spike"].append((f"a{k % 3}", m(k), m(k + 15), True))
        out["login_failure_storm"].append((c, m(k), m(k + 10), True))
    if k % 23 == 0:
        out["structuring"].append((f"a{k % 7}", c, m(k), m(k + 60), True))
        out["correlated_alert_burst"] += [(c, m(k), m(k + 10), True), (None, m(k), m(k + 10), True)]
    if k == 5:
        out["device_anomalies"] += [("early", m(5), True), ("a2", m(5), True)]
        out["correlated_alert_burst"].append(("gone", m(5), m(15), True))
        out["login_failure_storm"].append(("late", m(5), m(15), True))
    if k in (12, 140):
        out["tx"].append(("new", "late", m(k)))
    return out


def test_score_stream_equals_batch_at_several_instants(spark, tmp_dir):
    src, ck, out = (os.path.join(tmp_dir, x) for x in ("src", "ck", "out"))
    os.makedirs(src)
    spark.createDataFrame([], expiry.FACT).coalesce(1).write.mode("append").parquet(src)
    known = {n: [] for n in [*EMPTY, "tx"]}
    work = []
    for lo, hi in ((0, 25), (25, 80), (80, 82), (82, 150), (150, 400)):
        ks = range(lo, hi) if lo < 150 else (390,)
        new = [at_minute(k) for k in ks]
        for n in known:
            known[n] += [r for d in new for r in d[n]]
        tables = {n: spark.createDataFrame([r for d in new for r in d[n]], EMPTY[n]) for n in EMPTY}
        tx = spark.createDataFrame([r for d in new for r in d["tx"]],
                                   "account_id string, customer_id string, occurred_at timestamp")
        parts = [expiry.signal_facts(n, df) for n, df in tables.items()]
        parts.append(expiry.facts(tx, expiry.SEEN, "occurred_at", "occurred_at"))
        reduce(DataFrame.unionByName, parts).coalesce(1).write.mode("append").parquet(src)

        stream = spark.readStream.schema(expiry.FACT).parquet(src)
        q = mat.materialize(expiry.score_changes(stream), out, ["account_id", "customer_id"],
                            mat.hash_bucket(["account_id", "customer_id"], 4), ck,
                            {"availableNow": True}, output_mode="append")
        q.awaitTermination()
        work.append(mat.changes(spark, out).count())

        df = {n: spark.createDataFrame(known[n], EMPTY[n]) for n in EMPTY}
        stg = spark.createDataFrame(known["tx"],
                                    "account_id string, customer_id string, occurred_at timestamp")
        as_of = stg.agg(F.max("occurred_at")).first()[0]
        want = risk.account_risk_score(
            stg, df["velocity_alerts"], df["geo_hops"], df["device_anomalies"], df["cnp_spike"],
            df["login_failure_storm"], df["structuring"], df["correlated_alert_burst"], as_of=as_of)
        got = expiry.score_view(mat.read_view(spark, out))
        cols = ["account_id", "customer_id", "risk_score", "risk_tier"]
        names = F.array_join("contributing_signals", ",").alias("names")
        assert rows(got.select(*cols, names), *cols, "names") == \
            rows(want.select(*cols, names), *cols, "names"), as_of
        assert got.count() > 0
    # Minute 80 to 82 changes few rows: work follows changes, not the table.
    assert work[2] - work[1] < 12
