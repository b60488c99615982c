"""Sources and sinks (A1-A10): typed JSON, dead letters, contract, topic writer."""

import json
import os

from riskstream import schemas
from riskstream.sources import events


def _write_lines(path, lines):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "part-0.json"), "w") as f:
        f.write("\n".join(lines) + "\n")


GOOD = dict(transaction_id="txn-1", account_id="acc-1", customer_id="cust-1", amount=99.99,
            currency="AUD", merchant_id="m", merchant_category_code="5411", merchant_name="Shop",
            channel="card_present", card_last4="1234", device_id="d", ip_address="1.1.1.1",
            latitude=1.0, longitude=2.0, country_code="AU",
            occurred_at="2026-04-18T10:00:00.000Z", status="approved")


def test_read_quarantine_and_contract(spark, tmp_dir):
    missing = {k: v for k, v in GOOD.items() if k != "merchant_name"}
    lines = [
        json.dumps(GOOD),
        "{not json",
        json.dumps({**GOOD, "transaction_id": "txn-2", "amount": "lots"}),
        json.dumps({**missing, "transaction_id": "txn-3"}),
        json.dumps({**GOOD, "transaction_id": "txn-4", "occurred_at": "yesterday"}),
    ]
    path = os.path.join(tmp_dir, "tx")
    _write_lines(path, lines)
    df = events.read_transactions(spark, path=path)
    assert events.check_contract(df, "transactions") == []
    good, bad = events.quarantine(df, "transactions")
    assert sorted(r.transaction_id for r in good.collect()) == ["txn-1", "txn-3"]
    errs = sorted((r.topic, r.error) for r in bad.collect())
    assert errs == [("transactions", "bad_event_time"), ("transactions", "malformed_json"),
                    ("transactions", "malformed_json")]
    assert good.where("transaction_id = 'txn-3'").first().merchant_name is None


def test_contract_detects_order_and_type(spark):
    df = spark.createDataFrame([], schemas.TRANSACTIONS)
    assert events.check_contract(df, "transactions") == []
    swapped = df.select("account_id", "transaction_id", *df.columns[2:])
    assert events.check_contract(swapped, "transactions")
    retyped = df.withColumn("amount", df.amount.cast("string"))
    assert any("amount" in p for p in events.check_contract(retyped, "transactions"))


def test_write_topic_round_trip(spark, tmp_dir):
    path = os.path.join(tmp_dir, "out")
    src = spark.createDataFrame([tuple(GOOD[f.name] for f in schemas.TRANSACTIONS)],
                                schemas.TRANSACTIONS)
    events.write_topic(src, "transactions", path=path)
    back = events.read_transactions(spark, path=path, keep_corrupt=False)
    assert back.collect() == src.collect()


def test_kafka_options():
    o = events.kafka_options("b:9092", "transactions",
                             security={"kafka.sasl.mechanism": "PLAIN"})
    assert o["subscribe"] == "transactions" and o["startingOffsets"] == "earliest"
    assert o["kafka.sasl.mechanism"] == "PLAIN"
    w = events.kafka_options("b:9092", "t", subscribe=False)
    assert w == {"kafka.bootstrap.servers": "b:9092", "topic": "t"}


def test_temp_views_and_cli_batch(spark, tmp_dir):
    from riskstream.__main__ import main
    from riskstream.plans.views import Views

    v = Views.from_testdata(spark, "/root/testdata/sf0.001")
    names = v.register_temp_views(prefix="t_")
    assert "t_account_risk_score" in names
    got = spark.sql("SELECT COUNT(*) AS n FROM t_account_risk_score "
                    "WHERE risk_tier IN ('high', 'critical')").first().n
    assert got == v.account_risk_score.where("risk_tier IN ('high', 'critical')").count()
    # the five topics as JSON files -> every view written by the CLI
    src = {}
    for name in ["transactions", "login_events", "card_events", "alert_events",
                 "kyc_profile_events"]:
        p = os.path.join(tmp_dir, "topics", name)
        v.raw[name].write.json(p)
        src[name] = p
    out = os.path.join(tmp_dir, "out")
    main(["batch", *[f"--source={k}={p}" for k, p in src.items()], "--out", out])
    back = spark.read.parquet(os.path.join(out, "velocity_alerts"))
    assert back.count() == v.velocity_alerts.count() > 0


def test_cli_stream_once(spark, tmp_dir):
    from riskstream.streaming import topology
    from riskstream.__main__ import main
    from riskstream.plans.views import Views

    v = Views.from_testdata(spark, "/root/testdata/sf0.001")
    src = []
    for name in ["transactions", "login_events", "card_events", "alert_events",
                 "kyc_profile_events"]:
        p = os.path.join(tmp_dir, "topics", name)
        v.raw[name].write.json(p)
        src.append(f"--source={name}={p}")
    root = os.path.join(tmp_dir, "root")
    main(["stream", *src, "--root", root, "--once"])
    snap = topology.snapshot(spark, root, "account_risk_score")
    assert snap.count() == v.account_risk_score.count() > 0


def test_parquet_sources_and_contract(spark, tmp_dir):
    from riskstream.plans.views import Views

    v = Views.from_testdata(spark, "/root/testdata/sf0.001")
    paths = {}
    for name in ["transactions", "login_events", "card_events", "alert_events",
                 "kyc_profile_events"]:
        paths[name] = os.path.join(tmp_dir, name)
        v.raw[name].write.parquet(paths[name])
        df = events.read_stream(spark, name, path=paths[name], fmt="parquet")
        assert events.check_contract(df, name) == []
    w = Views.from_sources(spark, paths, fmt="parquet", device_args=v.device_args,
                           geo_bucket=v.geo_bucket)
    assert sorted(tuple(r) for r in w.account_risk_score.select(
        "account_id", "risk_score").collect()) == sorted(
        tuple(r) for r in v.account_risk_score.select("account_id", "risk_score").collect())


def test_load_checks_the_contract_and_splits_dead_letters(spark, tmp_dir):
    import pytest

    from riskstream import schemas
    from riskstream.sources import events
    path = os.path.join(tmp_dir, "bad")
    spark.createDataFrame([("t", 1)], "transaction_id string, amount int").write.parquet(path)
    with pytest.raises(ValueError, match="columns"):
        events.load(spark, "transactions", path=path, fmt="parquet")
    text = os.path.join(tmp_dir, "json")
    os.makedirs(text)
    with open(os.path.join(text, "a.json"), "w") as f:
        f.write('{"customer_id": "c", "updated_at": "2026-04-18T10:00:00.000Z"}\n{"customer_id": 1\n')
    good, bad = events.load(spark, "kyc_profile_events", path=text)
    assert good.columns == [f.name for f in schemas.STREAMS["kyc_profile_events"]]
    assert good.count() == 1 and [r.error for r in bad.collect()] == ["malformed_json"]
    assert events.kafka_options("b:1", "t")["failOnDataLoss"] == "true"
    assert events.kafka_options("b:1", "t", fail_on_data_loss=False)["failOnDataLoss"] == "false"


def test_views_over_topics_read_what_they_hold(spark, monkeypatch):
    """Batch over Kafka: each stream is loaded from the brokers, not as a stream."""
    from riskstream import schemas
    from riskstream.plans.views import Views
    asked = []

    def load(spark_, name, **how):
        asked.append((name, how))
        good = spark_.createDataFrame([], schemas.STREAMS[name])
        return good, spark_.createDataFrame([], "topic string, payload string, error string")
    monkeypatch.setattr(events, "load", load)
    how = {"brokers": "b:9092", "kafka": {"security": {}}}
    views = Views.from_sources(spark, {n: how for n in schemas.STREAMS})
    assert asked == [(n, how) for n in schemas.STREAMS]
    assert views.account_risk_score.count() == 0 and views.dead_letters.count() == 0
