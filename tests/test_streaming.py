"""Streaming = batch for the windowed signals; geo state across micro-batches;
snapshot refresh from materialized tables."""

import os

import pytest
from pyspark.sql import functions as F

from helpers import rows
from riskstream.operators import pairs, signals
from riskstream.plans.views import Views
from riskstream.streaming import materialize as mat
from riskstream.streaming import signals as ss
from riskstream.streaming import snapshot

SF = "/root/testdata/sf0.001"


def _chunked_source(spark, df, path, n=3):
    """Write ``df`` as ``n`` time-ordered files -> one micro-batch each."""
    lo, hi = df.select(F.min("occurred_at"), F.max("occurred_at")).first()
    step = (hi - lo) / n
    for i in range(n):
        a, b = lo + step * i, lo + step * (i + 1)
        part = df.where((F.col("occurred_at") >= a) &
                        ((F.col("occurred_at") < b) if i < n - 1 else F.lit(True)))
        part.coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


@pytest.fixture(scope="module")
def views(spark):
    return Views.from_testdata(spark, SF)


@pytest.mark.parametrize("name,source", [
    ("velocity_alerts", "stg_transactions"), ("cnp_spike", "stg_transactions"),
    ("structuring", "stg_transactions"), ("shared_device_ring", "stg_transactions"),
    ("correlated_alert_burst", "stg_alert_events")])
def test_windowed_stream_equals_batch(spark, views, tmp_dir, name, source):
    staged = getattr(views, source)
    stream = _chunked_source(spark, staged, os.path.join(tmp_dir, "src"))
    sig, keys = ss.windowed_signal(name, stream, watermark="1 hour")
    out, ckpt = os.path.join(tmp_dir, "view"), os.path.join(tmp_dir, "ckpt")
    q = mat.materialize(sig, out, keys, mat.day_of("window_start"), ckpt,
                        trigger={"availableNow": True})
    q.awaitTermination()
    assert q.lastProgress is not None
    got = mat.read_view(spark, out)
    want = getattr(views, name)
    cols = want.columns
    assert rows(got, *cols) == rows(want, *cols)
    assert len(rows(want, *cols)) > 0


def test_login_storm_parts_equal_batch(spark, views, tmp_dir):
    stream = _chunked_source(spark, views.stg_login_events, os.path.join(tmp_dir, "src"))
    tables = []
    for name, part in ss.login_failure_storm_streams(stream, watermark="1 hour").items():
        out = os.path.join(tmp_dir, name)
        q = mat.materialize(part, out, ["customer_id", "window_start"],
                            mat.day_of("window_start"), os.path.join(tmp_dir, "ck_" + name),
                            trigger={"availableNow": True})
        q.awaitTermination()
        tables.append(mat.read_view(spark, out))
    got = ss.login_failure_storm_view(*tables)
    want = views.login_failure_storm
    assert rows(got, *want.columns) == rows(want, *want.columns)
    assert want.count() > 0


def test_burst_parts_equal_batch(spark, views, tmp_dir):
    """Also alerts without a type or a customer, types that come again in a later
    micro-batch, and types beyond the six."""
    base = views.stg_alert_events
    odd = base.limit(40).withColumn("customer_id", F.lit(None).cast("string")).withColumn(
        "alert_type", F.when(F.rand(3) < .3, None).otherwise(F.concat(F.lit("t"), F.floor(F.rand(4) * 30))))
    alerts = base.unionByName(odd).persist()
    stream = _chunked_source(spark, alerts, os.path.join(tmp_dir, "src"))
    tables = []
    for name, part in ss.correlated_alert_burst_streams(stream, watermark="1 hour").items():
        out = os.path.join(tmp_dir, name)
        q = mat.materialize(part, out, ["customer_id", "window_start"],
                            mat.day_of("window_start"), os.path.join(tmp_dir, "ck_" + name),
                            trigger={"availableNow": True})
        q.awaitTermination()
        tables.append(mat.read_view(spark, out))
    got = ss.correlated_alert_burst_view(*tables)
    want = signals.correlated_alert_burst(alerts)
    assert rows(got, *want.columns) == rows(want, *want.columns)
    assert want.where("customer_id IS NULL").count() > 0 < want.where("customer_id IS NOT NULL").count()
    alerts.unpersist()


def test_geo_state_across_micro_batches(spark, views, tmp_dir):
    staged = views.stg_transactions
    stream = _chunked_source(spark, staged, os.path.join(tmp_dir, "src"))
    out = os.path.join(tmp_dir, "hops")
    q = mat.materialize(ss.geo_hops_stream(stream, watermark="1 hour"), out, ["txn2_id"],
                        mat.day_of("txn2_time"), os.path.join(tmp_dir, "ckpt"),
                        {"availableNow": True}, output_mode="append")
    q.awaitTermination()
    assert len(q.recentProgress) >= 3
    got = ss.geo_hops_view(mat.read_view(spark, out))
    want = pairs.geo_hops(staged)
    cols = ["customer_id", "txn1_id", "txn2_id", "approx_distance_km", "time_diff_minutes",
            "is_impossible", "txn2_account_id"]
    assert rows(got, *cols) == rows(want, *cols)
    assert len(rows(want, *cols)) > 0


def test_geo_rows_out_of_order_and_without_time_equal_batch(spark, tmp_dir):
    """Rows that arrive after a later row of their customer, inside the watermark."""
    import random
    r = random.Random(4)
    place = {"AU": (-33.87, 151.21), "GB": (51.51, -0.13), "NZ": (-36.85, 174.76)}
    data = []
    for i in range(120):
        c = r.choice(list(place))
        data.append((f"c{i % 3}", f"a{i % 4}", f"t{i:03d}", c, *place[c],
                     f"2026-04-18 10:{r.randint(0, 59):02d}:00", i))
    schema = ("customer_id string, account_id string, transaction_id string, country_code string, "
              "latitude double, longitude double, occurred_at string, n int")
    df = spark.createDataFrame(data + [("c0", "a0", "tx", "AU", 1.0, 2.0, None, 50),
                                       ("c1", "a0", "ty", "GB", None, None,
                                        "2026-04-18 10:30:00", 70)], schema)
    df = df.withColumn("occurred_at", F.to_timestamp("occurred_at"))
    src = os.path.join(tmp_dir, "src")
    for k in range(6):  # in the order of arrival, not of time
        df.where(F.col("n").between(20 * k, 20 * k + 19)).drop("n").coalesce(1).write.mode(
            "append").parquet(src)
    stream = spark.readStream.schema(df.drop("n").schema).option("maxFilesPerTrigger", 1).parquet(src)
    out = os.path.join(tmp_dir, "hops")
    mat.materialize(ss.geo_hops_stream(stream, watermark="2 hours"), out, ["txn2_id"],
                    mat.day_of("txn2_time"), os.path.join(tmp_dir, "ckpt"),
                    {"availableNow": True}, output_mode="append").awaitTermination()
    want = pairs.geo_hops(df.drop("n").where("occurred_at is not null"))
    cols = ["customer_id", "txn1_id", "txn2_id", "approx_distance_km", "time_diff_minutes",
            "is_impossible", "txn2_account_id"]
    assert rows(ss.geo_hops_view(mat.read_view(spark, out)), *cols) == rows(want, *cols)
    assert want.count() > 20


def test_geo_slots_touch_only_neighbours():
    """A new row reads its slot and its neighbours' slots, whatever the bucket holds."""
    from riskstream.streaming import geochain as gc
    kept, reads = {}, []

    def get(s):
        reads.append(s)
        return kept[s]
    slots = gc.Slots(60_000_000, [], get, kept.__setitem__)
    row = lambda minute, name: ("a", name, "AU", 1.0, 1.0, int(minute * 60_000_000))
    pairs, edge = slots.add([row(m, f"t{m}") for m in (50, 0, 3, 10, 40)])
    names = lambda ps: sorted((a[1], b[1]) for a, b in ps)
    assert names(pairs) == [("t0", "t3"), ("t10", "t40"), ("t3", "t10"), ("t40", "t50")]
    assert (edge[0][1], edge[1][1]) == ("t0", "t50")
    reads.clear()
    pairs, edge = slots.add([row(5, "t5"), row(5.5, "u5")])
    assert names(pairs) == [("t3", "t5"), ("t5", "u5"), ("u5", "t10")] and edge is None
    assert set(reads) <= {0, 3, 10, 50}  # neighbours and the bucket's ends
    pairs, edge = slots.add([row(0, "s0")])
    assert names(pairs) == [("s0", "t0")] and edge[0][1] == "s0"


def test_geo_state_is_freed_behind_the_watermark(spark, tmp_dir):
    """After the watermark has passed, a customer keeps one edge, and a row long
    after follows it; small buckets, rows out of order inside the watermark."""
    hours = [(0, 0), (0, 2), (0, 1), (1, 0), (3, 0), (2, 59), (9, 0), (30, 0), (30, 1), (60, 0)]
    src = os.path.join(tmp_dir, "src")
    place = [(-33.87, 151.21), (51.51, -0.13)]
    data = [("c", "a", f"t{i}", "AU", *place[i % 2], f"2026-04-{18 + h // 24} {h % 24:02d}:{m:02d}:00", i)
            for i, (h, m) in enumerate(hours)]
    df = spark.createDataFrame(data, "customer_id string, account_id string, transaction_id string, "
                               "country_code string, latitude double, longitude double, "
                               "occurred_at string, n int")
    df = df.withColumn("occurred_at", F.to_timestamp("occurred_at"))
    for i in range(len(hours)):
        df.where(F.col("n") == i).drop("n").coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(df.drop("n").schema).option("maxFilesPerTrigger", 1).parquet(src)
    out, ck = os.path.join(tmp_dir, "hops"), os.path.join(tmp_dir, "ckpt")
    hops = ss.geo_hops_stream(stream, watermark="2 hours", bucket="30 minutes", slot="1 minute")
    q = mat.materialize(hops, out, ["txn2_id"], mat.day_of("txn2_time"), ck, {"availableNow": True},
                        output_mode="append")
    q.awaitTermination()
    want = pairs.geo_hops(df.drop("n"))
    cols = ["customer_id", "txn1_id", "txn2_id", "time_diff_minutes", "is_impossible"]
    assert rows(ss.geo_hops_view(mat.read_view(spark, out)), *cols) == rows(want, *cols)
    # State entries, timers included: the last bucket and its edge, one older tail.
    assert sum(o.numRowsTotal for o in q.lastProgress.stateOperators) <= 12


def test_changes_are_appended_once_and_read_by_newest_epoch(spark, tmp_dir):
    def frame(*data):
        df = spark.createDataFrame([(k, v, f"2026-04-{d} 10:00:00") for k, v, d in data],
                                   "k string, v int, ts string")
        return df.withColumn("ts", F.col("ts").cast("timestamp"))
    b1, b2 = frame(("a", 1, 18), ("b", 1, 18), (None, 1, 18)), frame(("a", 2, 18), ("c", 5, 19),
                                                                    (None, 2, 18))
    want = [(None, 2), ("a", 2), ("b", 1), ("c", 5)]
    for name, part in (("day", mat.day_of("ts")), ("keyed", mat.hash_bucket(["k"], 4))):
        path = os.path.join(tmp_dir, name)
        for epoch, b in ((0, b1), (1, b2), (1, b2)):  # the last one is a replay
            mat.append_changes(b, path, ["k"], part, epoch)
        assert sorted(rows(mat.read_view(spark, path), "k", "v"), key=str) == sorted(want, key=str)
        copy = os.path.join(tmp_dir, name + "-compact")
        mat.compact(spark, path, copy)
        assert mat.changes(spark, copy).count() == len(want)
        mat.append_changes(frame(("b", 9, 18)), copy, ["k"], part, 0)
        assert ("b", 9) in rows(mat.read_view(spark, copy), "k", "v")
    empty = os.path.join(tmp_dir, "empty")
    mat.append_changes(b1.where("v > 100"), empty, ["k"], mat.day_of("ts"), 0)
    assert mat.read_view(spark, empty).count() == 0
    mat.append_changes(b1, empty, ["k"], mat.day_of("ts"), 1)
    assert mat.read_view(spark, empty).count() == 3


@pytest.mark.parametrize("version", [None, "v"])
def test_published_base_while_changes_come(spark, tmp_dir, version):
    """A base changes no row read, whatever comes after it: new epochs, a replay of
    the unfinished one, keys that never change again.  With a base the superseded
    files aren't opened (they are spoilt here)."""
    path, day = os.path.join(tmp_dir, "t"), F.to_date(F.lit("2024-01-01"))

    def append(epoch, data):
        df = spark.createDataFrame([(*d, 1) for d in data], "k string, x long, v long")
        mat.append_changes(df.coalesce(1), path, ["k"], day, epoch, version)
    now = lambda: {r.k: r.x for r in mat.read_view(spark, path).collect()}
    assert mat.publish_compacted(spark, path) is None  # no table yet
    append(0, [("a", 1), ("b", 1), (None, 1)])
    assert mat.publish_compacted(spark, path) is None  # no finished epoch
    append(1, [("a", 2)])
    append(2, [("b", 3), ("c", 3)])
    want = {"a": 2, "b": 3, "c": 3, None: 1}
    assert now() == want
    assert mat.publish_compacted(spark, path, "0 seconds") == 1
    assert mat.publish_compacted(spark, path) is None  # nothing finished since
    assert now() == want
    for f in mat.changes(spark, path).where(F.col(mat.EPOCH) < 2).select(
            "_metadata.file_path").distinct().collect():
        name = f[0].removeprefix("file:").removeprefix("//")
        at = os.stat(name).st_mtime
        open(name, "wb").write(b"no parquet")
        os.utime(name, (at - 60, at - 60))
    assert now() == want
    append(2, [("b", 3), ("c", 3)])
    append(3, [("c", 4), ("d", 4)])
    want |= {"c": 4, "d": 4}
    assert now() == want
    assert mat.publish_compacted(spark, path, "0 seconds") == 2 and now() == want
    assert {r.k for r in mat.read_table(spark, path).where(F.col(mat.PART) == day).collect()} == set(want)


def test_micro_batch_runs_once_and_reads_prune(spark, tmp_dir):
    """One execution a micro-batch, nothing left beside the table, and a filter
    on the partition reaches the scan through the newest-epoch aggregate."""
    ran = spark.sparkContext.accumulator(0)

    def count(it):
        for pdf in it:
            ran.add(len(pdf))
            yield pdf
    path = os.path.join(tmp_dir, "t")
    b = spark.range(30).selectExpr("id as k", "timestamp'2026-04-18 10:00:00' as ts")
    for epoch in range(3):
        mat.append_changes(b.mapInPandas(count, b.schema), path, ["k"], mat.day_of("ts"), epoch)
    assert ran.value == 90
    assert all(n.startswith(("_part=", "_meta", "_SUCCESS", "._SUCCESS")) for n in os.listdir(path))
    table = mat.read_table(spark, path).where(F.col("_part") == F.to_date(F.lit("2026-04-18")))
    plan = table._sc._jvm.PythonSQLUtils.explainString(table._jdf.queryExecution(), "formatted")
    assert "PartitionFilters: [isnotnull(_part" in plan


def test_snapshot_from_materialized_tables(spark, views, tmp_dir):
    staged_dir, out = os.path.join(tmp_dir, "staged"), os.path.join(tmp_dir, "snap")
    for s in ["transactions", "login_events", "card_events", "alert_events",
              "kyc_profile_events"]:
        views.raw[s].write.parquet(os.path.join(staged_dir, s))
    v2 = snapshot.staged_views(spark, staged_dir, device_args=views.device_args,
                               geo_bucket=views.geo_bucket)
    snapshot.write_snapshot(v2, out)
    got = spark.read.parquet(os.path.join(out, "account_risk_score"))
    cols = ["account_id", "customer_id", "risk_score", "risk_tier"]
    assert rows(got, *cols) == rows(views.account_risk_score, *cols)


def test_topology_snapshot_equals_batch(spark, views, tmp_dir):
    from riskstream import schemas
    from riskstream.operators.staging import parse_ts
    from riskstream.streaming import topology

    sources = {}
    for name, schema in schemas.STREAMS.items():
        raw = views.raw[name]
        ts = schemas.EVENT_TIME[name]
        path = os.path.join(tmp_dir, "src", name)
        with_t = raw.withColumn("_t", parse_ts(ts))
        lo, hi = with_t.select(F.min("_t"), F.max("_t")).first()
        step = (hi - lo) / 3
        for i in range(3):
            cond = (F.col("_t") >= lo + step * i) & (
                (F.col("_t") < lo + step * (i + 1)) if i < 2 else F.lit(True))
            with_t.where(cond).drop("_t").coalesce(1).write.mode("append").parquet(path)
        sources[name] = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1) \
            .parquet(path)
    root = os.path.join(tmp_dir, "root")
    topo = topology.start(spark, sources, root, trigger={"availableNow": True},
                          watermark="1 hour", device_args=views.device_args)
    topo.await_all()
    # Each topic is read and parsed by one query; the others read staged files.
    read = [src.description for q in topo.queries for src in q.lastProgress.sources]
    for name in sources:
        assert sum(os.path.join(tmp_dir, "src", name) in d for d in read) == 1, name
    snap = topology.snapshot_views(spark, root, device_args=views.device_args)
    for name, cols in [("account_risk_score", ["account_id", "customer_id", "risk_score",
                                               "risk_tier"]),
                       ("open_fraud_cases", ["account_id", "recommended_action", "kyc_risk_tier"]),
                       ("resolved_cases", ["account_id", "current_risk_score"]),
                       ("recent_high_alerts", ["alert_id", "customer_kyc_tier", "kyc_status"])]:
        want = rows(getattr(views, name), *cols)
        assert rows(snap[name], *cols) == want, name
        assert len(want) > 0 or name == "resolved_cases", name
    with pytest.MonkeyPatch.context() as m:
        m.setattr(topology, "snapshot_views", lambda *a, **k: snap)
        first = topology.refresh_snapshot(spark, root)
        second = topology.refresh_snapshot(spark, root)
    assert second > first
    score = topology.snapshot(spark, root, "account_risk_score")
    assert rows(score, "account_id", "risk_score") == rows(
        views.account_risk_score, "account_id", "risk_score")
    open_ = topology.snapshot(spark, root, "open_fraud_cases")
    assert rows(open_, "account_id", "risk_score") == rows(
        score.where("risk_tier in ('high', 'critical')"), "account_id", "risk_score")
    kept = topology.maintained_views(spark, root)
    for name, df in kept.items():
        want = getattr(views, name)
        cols = [c for c in want.columns if c in df.columns]
        assert len(cols) == len(want.columns), name
        assert rows(df, *cols) == rows(want, *cols), name
    # C9 came out as the transactions did, in one micro-batch here.
    alerts = mat.read_view(spark, os.path.join(root, "views", "device_anomalies"))
    cols = ["customer_id", "transaction_id", "device_id", "amount", "account_id"]
    assert rows(alerts, *cols) == rows(views.device_anomalies_with_account, *cols)
    # The score as a stream: NOW() is the newest time among all facts.
    from riskstream.streaming import expiry
    scored = expiry.score_view(mat.read_view(spark, os.path.join(root, "views", "account_scores")))
    cols = ["account_id", "customer_id", "risk_score", "risk_tier"]
    assert rows(scored, *cols) == rows(views.account_risk_score, *cols)
    health = topology.query_staleness(spark, topo).collect()
    assert len(health) == len(topo.queries) and all(r.last_batch_at for r in health)


def test_stream_dedupe_quarantine_and_topic_sink(spark, tmp_dir):
    import json

    from riskstream.operators.staging import dedupe_events, stg_transactions
    from riskstream.sources import events
    good = {"transaction_id": "t1", "account_id": "a", "customer_id": "c", "amount": 1.0,
            "occurred_at": "2026-04-18T10:00:00.000Z"}
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    with open(os.path.join(src, "0.json"), "w") as f:
        f.write("\n".join([json.dumps(good), json.dumps(good), "{broken",
                           json.dumps({**good, "transaction_id": "t2",
                                       "occurred_at": "not-a-time"})]) + "\n")
    stream = events.read_transactions(spark, path=src, streaming=True)
    ok, bad = events.quarantine(stream, "transactions")
    deduped = dedupe_events(stg_transactions(ok), "transaction_id", "occurred_at", "1 hour")
    q1 = (deduped.writeStream.format("memory").queryName("dedupe_test")
          .option("checkpointLocation", os.path.join(tmp_dir, "ck1"))
          .trigger(availableNow=True).start())
    out = os.path.join(tmp_dir, "dlq")
    q2 = events.write_topic(bad, "transactions_dlq", path=out,
                            checkpoint=os.path.join(tmp_dir, "ck2"))
    q1.awaitTermination()
    q2.processAllAvailable()
    q2.stop()
    assert [r.transaction_id for r in spark.table("dedupe_test").collect()] == ["t1"]
    dead = [json.loads(r.value) for r in spark.read.text(out).collect()]
    assert sorted(d["error"] for d in dead) == ["bad_event_time", "malformed_json"]


def test_session_stream_equals_batch(spark, views, tmp_dir):
    """Sessions merge across micro-batches; all but those still open come out."""
    from riskstream.operators import signals
    logins = views.stg_login_events
    stream = _chunked_source(spark, logins, os.path.join(tmp_dir, "src"), 4)
    got = signals.login_failure_storm(stream, session="1 minute", watermark="2 minutes")
    q = (got.writeStream.format("parquet").option("path", os.path.join(tmp_dir, "out"))
         .option("checkpointLocation", os.path.join(tmp_dir, "ck")).outputMode("append")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    cols = ["customer_id", "window_start", "window_end", "failure_count", "distinct_ips"]
    # The mark follows the failed logins, which are all that the windows see.
    newest = logins.where("success = false").agg(F.max("occurred_at")).first()[0]
    closed = F.col("window_end") <= F.lit(newest) - F.expr("INTERVAL 2 MINUTES")
    want = signals.login_failure_storm(logins, session="1 minute").where(closed)
    assert rows(spark.read.parquet(os.path.join(tmp_dir, "out")), *cols) == rows(want, *cols)
    assert want.count() > 0


def test_device_alerts_per_micro_batch_equal_batch(spark, views, tmp_dir):
    """C9 as it happens: each micro-batch's alerts are the batch alerts at its own
    newest time, among its rows; a replay changes nothing."""
    from riskstream.streaming import topology
    tx, root = views.stg_transactions, os.path.join(tmp_dir, "root")
    tx.withColumn("_part", F.to_date("occurred_at")).write.partitionBy("_part").parquet(
        os.path.join(root, "staged", "transactions"))
    mat.append_changes(pairs.device_presence(tx), os.path.join(root, "views", "device_presence"),
                       ["customer_id", "device_id", "bucket_start"], mat.day_of("bucket_start"), 0)
    out = os.path.join(root, "views", "device_anomalies")
    run = topology.device_alerts_on_batch(root, out, views.device_args)
    lo, hi = tx.select(F.min("occurred_at"), F.max("occurred_at")).first()
    cuts = [lo + (hi - lo) * k / 4 for k in range(4)] + [hi]
    want = []
    for epoch, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
        batch = tx.where((F.col("occurred_at") > a) & (F.col("occurred_at") <= b))
        for _ in range(2 if epoch == 1 else 1):
            run(batch, epoch)
        known = tx.where(F.col("occurred_at") <= b)
        found = pairs.device_anomalies(known, **views.device_args).where(F.col("occurred_at") > a)
        want += rows(found, "transaction_id", "device_id")
    run(tx.limit(0), 9)
    assert sorted(rows(mat.read_view(spark, out), "transaction_id", "device_id"), key=str) == \
        sorted(want, key=str)
    assert want
