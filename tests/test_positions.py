"""Last-position index and high-water marks: same rows as scans of the history."""

import os
import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from helpers import rows
from riskstream.functions.time import PART
from riskstream.operators import marks, pairs, positions
from riskstream.plans.views import Views

SCHEMA = ("customer_id string, account_id string, transaction_id string, country_code string, "
          "latitude double, longitude double, occurred_at timestamp")


def history(n=400):
    """Three years of a few customers, one hot, one NULL; ties and rows without time."""
    r = random.Random(2)
    out = []
    for i in range(n):
        t = datetime(2023, 11, 30) + timedelta(hours=r.choice([r.randint(0, 24 * 900),
                                                              24 * 890 + r.randint(0, 48)]))
        out.append((r.choice(["hot", "hot", "c1", "c2", None]), f"a{i % 3}", f"t{i:04d}", "AU",
                    r.uniform(-60, 60), r.uniform(-170, 170), t))
    out += [("c1", "a", None, "AU", 1.0, 1.0, out[0][-1]), ("c2", "a", "x", "AU", 1.0, 1.0, None),
            (*out[5][:2], "zz", *out[5][3:])]
    return out


@pytest.fixture(scope="module")
def tx(spark):
    return spark.createDataFrame(history(), SCHEMA).repartition(4)


INSTANTS = ["2023-01-01 00:00:00", "2024-01-01 00:00:00", "2024-02-29 13:00:00",
            "2025-03-01 00:00:00", "2026-05-09 05:30:00", "2030-01-01 00:00:00"]


@pytest.mark.parametrize("at", INSTANTS)
def test_last_before_equals_plain(spark, tx, at):
    when = datetime.fromisoformat(at)
    best = {}
    for row in history():
        if row[-1] is not None and row[-1] < when and row[0] != "c2":
            key = (row[-1], row[2] is not None, row[2] or "")
            best[row[0]] = max(best.get(row[0], ((datetime.min, False, ""),)), (key,))
    customers = spark.createDataFrame([("hot",), ("c1",), (None,), ("nobody",)], "customer_id string")
    got = positions.last_before(tx, positions.build(tx), F.lit(at).cast("timestamp"), customers)
    want = {c: (k[0][0], k[0][2] or None) for c, k in best.items()}
    assert {r.customer_id: (r.occurred_at, r.transaction_id) for r in got.collect()} == want


@pytest.mark.parametrize("at", INSTANTS[2:])
def test_recent_hops_by_index_equal_those_by_scan(tx, at):
    since = F.lit(at).cast("timestamp")
    index = positions.build(tx)
    cols = ["customer_id", "txn1_id", "txn2_id", "approx_distance_km", "is_impossible"]
    got = pairs.geo_hops(tx, since=since, index=index)
    want = pairs.geo_hops(tx, since=since)
    assert rows(got, *cols) == rows(want, *cols)


def test_levels_have_a_row_a_period(tx):
    index = positions.build(tx)
    for level in positions.LEVELS:
        keys = tx.where("occurred_at IS NOT NULL").select(
            "customer_id", F.date_trunc(level, F.col("occurred_at"))).distinct().count()
        assert index[level].count() == keys


def test_score_scans_no_history(spark, tmp_dir):
    """Every transaction scan of the score's plan is bounded below by day, and its
    instant comes from the high-water marks."""
    views = Views.from_testdata(spark, "/root/testdata/sf0.001", store=os.path.join(tmp_dir, "v"))
    plain = Views.from_testdata(spark, "/root/testdata/sf0.001")
    want = rows(plain.account_risk_score, "account_id", "customer_id", "risk_score")
    assert rows(views.account_risk_score, "account_id", "customer_id", "risk_score") == want and want
    for name in ("account_risk_score", "recent_geo_hops"):
        plan = views.built[name]
        text = plan._sc._jvm.PythonSQLUtils.explainString(plan._jdf.queryExecution(), "formatted")
        scans = re.findall(r"Location: InMemoryFileIndex \[[^\]]*/stg_transactions\]\n(?:.*\n)*?\n",
                           text)
        assert scans
        for scan in scans:
            assert re.search(rf"PartitionFilters: \[[^\n]*{PART}", scan), scan
        assert "high_water" in text


def test_marks_add_up_over_writes(spark, tx, tmp_dir):
    path = os.path.join(tmp_dir, "marks")
    early, late = (tx.where(c) for c in ("occurred_at < '2025-01-01'", "occurred_at >= '2025-01-01'"))
    for part in (late, early, tx.where("occurred_at IS NULL"), tx.limit(0)):
        df, seen = marks.observed(part, "occurred_at", ["customer_id", "transaction_id"])
        df.write.mode("append").parquet(os.path.join(tmp_dir, "out"))
        marks.record(spark, path, "transactions", "stg_transactions", seen)
    got = marks.read(spark, path).collect()
    newest = max(r[-1] for r in history() if r[-1])
    assert [(r.rows, r.newest) for r in got] == [(len(history()), newest)]
    nulls = {r.column_name: r.failures for r in marks.null_counts(spark, path).collect()}
    assert nulls == {"customer_id": sum(r[0] is None for r in history()), "transaction_id": 1}
    at = spark.range(1).select(marks.newest(marks.read(spark, path)).alias("x")).first().x
    assert at == newest
