"""All views kept current from the five streams.

``start`` launches one streaming query per maintained table, every one with
its own checkpoint (restartable, exactly-once output), in three levels:

==========================  ==========================================  ==========
table                       maintained by                               partition
==========================  ==========================================  ==========
1 staged/<stream>           staging functions, file sink (append)       event day
2 views/high_water          newest time and rows of each stream         key hash
2 views/<C1-C6 signal>      windowed aggregate, changed rows            window day
2 views/storm_*, burst_*    C3, C5 in bounded parts, update + upsert    window day
2 views/accounts_seen       (customer, account) -> last seen, upsert    key hash
2 views/latest_kyc          ``max_by`` per customer, upsert             key hash
2 views/device_presence     (customer, device, hour) first/last seen    hour day
2 views/kpi_*, merchant_,   per-window aggregates (D2 parts, D3-D5),    window day
  channel_, hourly_...      update + upsert
2 views/known_customer_...  (customer, device) first/last seen (C8)     key hash
2 views/geo_hops            keyed state by customer and time bucket,    event day
                            newest pair of each transaction
3 views/device_anomalies    C9 of each micro-batch: its rows anti-join  event day
                            the device history as maintained
3 views/account_scores      D1 as keyed state with timers, from the     key hash
                            changes of the signals
==========================  ==========================================  ==========

A topic is read and parsed once, by its staging query; level 2 reads the staged
files as streams, level 3 the changes of level 2.

``refresh_snapshot`` recomputes the ``NOW()``-relative views (risk
score, open / resolved cases, recent high alerts) from those tables.  It
reads windowed signals and staged rows only in the partitions the look-backs
can reach; the device history comes from the hourly presence table; the
all-time inputs (pairs, latest KYC) are keyed tables of dimension size
instead of rescans of the history.
"""

from __future__ import annotations

import os
import time
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskstream import schemas
from riskstream.constants import (
    BURST_MIN_TYPES,
    BURST_WINDOW,
    CNP_WINDOW,
    DEVICE_HISTORY_FROM,
    DEVICE_RECENT,
    HIGH_ALERT_LOOKBACK,
    STALE_AFTER_SECONDS,
    STORM_MIN_FAILURES,
    STORM_WINDOW,
    STRUCTURING_WINDOW,
    VELOCITY_WINDOW,
)
from riskstream.functions.time import ago, interval_micros
from riskstream.operators import cases, marks, pairs, risk, signals, staging
from riskstream.streaming import expiry
from riskstream.streaming import materialize as mat
from riskstream.streaming import signals as ss

STAGE = {
    "transactions": staging.stg_transactions,
    "login_events": staging.stg_login_events,
    "card_events": staging.stg_card_events,
    "alert_events": staging.stg_alert_events,
    "kyc_profile_events": staging.stg_kyc_profiles,
}
SIGNAL_SOURCE = {
    "velocity_alerts": "transactions", "cnp_spike": "transactions",
    "structuring": "transactions", "shared_device_ring": "transactions",
}


WINDOWS = (VELOCITY_WINDOW, CNP_WINDOW, STORM_WINDOW, STRUCTURING_WINDOW, BURST_WINDOW)


def longest(intervals) -> str:
    """The longest of some intervals."""
    return max(intervals, key=interval_micros)


@dataclass
class Topology:
    root: str
    queries: list = field(default_factory=list)
    staged: dict[str, DataFrame] = field(default_factory=dict)  # streams of staged rows

    def path(self, *parts: str) -> str:
        return os.path.join(self.root, *parts)

    def await_all(self) -> None:
        for q in self.queries:
            q.awaitTermination()

    def stop(self) -> None:
        for q in self.queries:
            q.stop()


def _staged_stream(spark: SparkSession, topo: Topology, name: str, schema) -> DataFrame:
    """The files of a staging query as a stream of staged rows."""
    path = topo.path("staged", name)
    # A source needs its folder; the sink may not have made it yet.
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)
    with_day = mat.T.StructType([*schema.fields, mat.T.StructField(mat.PART, mat.T.DateType())])
    return spark.readStream.schema(with_day).parquet(path).drop(mat.PART)


def high_water_stream(staged: dict[str, DataFrame]) -> DataFrame:
    """stream, newest, rows: one state row a stream."""
    each = None
    for name, df in staged.items():
        one = df.select(F.lit(name).alias("stream"), F.col(schemas.EVENT_TIME[name]).alias("at"))
        each = one if each is None else each.unionByName(one)
    return each.groupBy("stream").agg(F.max("at").alias("newest"), F.count(F.lit(1)).alias("rows"))


def device_alerts_on_batch(root: str, path: str, device_args: dict | None = None):
    """A ``foreachBatch`` function over staged transactions: C9 as it happens.

    The micro-batch's high-value card-not-present rows whose (customer, device)
    is not in the device history, as maintained, up to the micro-batch's newest
    time.  Presence that runs ahead doesn't matter: the history ends before the
    recent rows.  A replayed epoch changes nothing.
    """
    args = device_args or {}

    def run(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        rows = batch.persist()
        try:
            newest = rows.agg(F.max("occurred_at")).first()[0]
            if newest is None:
                return
            as_of = F.lit(newest)
            lo = ago(as_of, args.get("history_from", DEVICE_HISTORY_FROM))
            presence = _since(_table(spark, os.path.join(root, "views", "device_presence")),
                              "bucket_end", lo)
            near = _table(spark, os.path.join(root, "staged", "transactions")).where(
                F.col(mat.PART) == F.to_date(lo)).drop(mat.PART)
            found = pairs.device_anomalies_from_presence(rows, presence, near, as_of,
                                                         with_account=True, **args)
            mat.append_changes(found, path, ["transaction_id"], mat.day_of("occurred_at"), epoch)
        finally:
            rows.unpersist()
    return run


def start(spark: SparkSession, sources: dict[str, DataFrame], root: str,
          trigger: dict | None = None, watermark: str = ss.DEFAULT_WATERMARK,
          device_args: dict | None = None,
          compact_every: int | None = mat.COMPACT_EVERY) -> Topology:
    """Start the queries over streaming source-shaped DataFrames (see module doc).

    With an ``availableNow`` or ``once`` trigger a level starts when the one
    before has processed all there is.  Every ``compact_every`` micro-batches a
    maintained table publishes its current rows as a base for its readers.
    """
    topo = Topology(root)
    ck = lambda name: topo.path("_checkpoints", name)
    trig = trigger or {}
    finite = bool(trig.get("availableNow") or trig.get("once"))
    schema_of = {}

    def keep(name: str, df: DataFrame, keys: list[str], part: Column,
             output_mode: str = "update") -> None:
        path = topo.path("views", name)
        schema_of[name] = mat.change_rows(df, part).schema
        mat.prepare(spark, path, schema_of[name], keys)
        topo.queries.append(mat.materialize(df, path, keys, part, ck(name), trig,
                                            output_mode=output_mode,
                                            compact_every=compact_every))

    def level_done() -> None:
        if finite:
            topo.await_all()

    # Level 1: each topic is parsed once.
    shapes = {}
    for name, src in sources.items():
        df, ts = STAGE[name](src), schemas.EVENT_TIME[name]
        shapes[name] = df.schema
        w = (df.withColumn(mat.PART, F.to_date(ts)).writeStream.format("parquet")
             .partitionBy(mat.PART).option("path", topo.path("staged", name))
             .option("checkpointLocation", ck(f"staged_{name}")).trigger(**trig))
        topo.queries.append(w.start())
    level_done()

    # Level 2: views of staged rows.
    staged = {name: _staged_stream(spark, topo, name, shape) for name, shape in shapes.items()}
    topo.staged = staged
    tx, logins = staged["transactions"], staged["login_events"]
    keep("high_water", high_water_stream(staged), ["stream"], mat.hash_bucket(["stream"], 1))
    for name, src in SIGNAL_SOURCE.items():
        sig, keys = ss.windowed_signal(name, staged[src], watermark=watermark)
        keep(name, sig, keys, mat.day_of("window_start"))
    in_parts = (ss.login_failure_storm_streams(logins, watermark=watermark)
                | ss.correlated_alert_burst_streams(staged["alert_events"], watermark=watermark))
    for name, part in in_parts.items():
        keep(name, part, ["customer_id", "window_start"], mat.day_of("window_start"))
    # Keyed by (customer, account) only: state is one row per pair (dimension
    # size), kept for ever because the pairs are all-time by definition.
    pair = ["customer_id", "account_id"]
    keep("accounts_seen", risk.accounts_seen(tx), pair, mat.hash_bucket(pair))
    keep("latest_kyc", staging.latest_kyc(staged["kyc_profile_events"]), ["customer_id"],
         mat.hash_bucket(["customer_id"]))
    # Monotone aggregates of the transactions / alerts, upserted per window.
    tx_wm = tx.withWatermark("occurred_at", watermark)
    alerts_wm = staged["alert_events"].withWatermark("occurred_at", watermark)
    for name, df, keys in [
            ("kpi_transactions", risk.kpi_transactions(tx_wm), ["window_start"]),
            ("kpi_alerts", risk.kpi_alerts(alerts_wm), ["window_start"]),
            ("merchant_fraud_exposure", risk.merchant_fraud_exposure(tx_wm),
             ["merchant_id", "merchant_name", "merchant_category_code", "window_start"]),
            ("channel_risk_breakdown", risk.channel_risk_breakdown(tx_wm),
             ["channel", "window_start"]),
            ("hourly_fraud_trend", risk.hourly_fraud_trend(tx_wm), ["hour_bucket"])]:
        keep(name, df, keys, mat.day_of(keys[-1]))
    device = ["customer_id", "device_id"]
    keep("known_customer_devices", signals.known_customer_devices(tx), device,
         mat.hash_bucket(device))
    keep("device_presence", pairs.device_presence(tx_wm), [*device, "bucket_start"],
         mat.day_of("bucket_start"))
    keep("geo_hops", ss.geo_hops_stream(tx, watermark=watermark), ["txn2_id"],
         mat.day_of("txn2_time"), output_mode="append")
    level_done()

    # Level 3: what needs maintained tables.
    alerts_path = topo.path("views", "device_anomalies")
    found = mat.T.StructType([
        *[shapes["transactions"][c] for c in ("customer_id", "transaction_id", "device_id",
                                              "amount", "occurred_at", "account_id")],
        *[mat.T.StructField(c, mat.T.BooleanType()) for c in (
            "is_new_device_candidate", "is_high_value", "combined_risk_flag")]])
    schema_of["device_anomalies"] = mat.change_rows(
        spark.createDataFrame([], found), mat.day_of("occurred_at")).schema
    mat.prepare(spark, alerts_path, schema_of["device_anomalies"], ["transaction_id"])
    topo.queries.append(
        tx.writeStream.foreachBatch(device_alerts_on_batch(root, alerts_path, device_args))
        .option("checkpointLocation", ck("device_anomalies")).trigger(**trig).start())
    level_done()

    scores = expiry.score_changes(score_facts(spark, topo, schema_of))
    keep("account_scores", scores, pair, mat.hash_bucket(pair), output_mode="append")
    return topo


def score_facts(spark: SparkSession, topo: Topology, schema_of: dict) -> DataFrame:
    """All facts of the score as one stream: the changes of the signals, and the
    accounts as they are seen."""
    changed = lambda name: mat.change_stream(
        spark, topo.path("views", name), schema_of[name])
    out = expiry.facts(changed("accounts_seen"), expiry.SEEN, "last_seen_at", "last_seen_at")
    for name in expiry.SIGNALS:
        if name == "login_failure_storm":  # the counts hold its threshold
            df = changed("storm_counts")
            df = df.withColumn("is_brute_force", F.col("failure_count") >= STORM_MIN_FAILURES)
        elif name == "correlated_alert_burst":
            df = changed("burst_types")
            df = df.withColumn("is_compound_fraud", F.col("alert_type_count") >= BURST_MIN_TYPES)
        else:
            df = changed(name)
        out = out.unionByName(expiry.signal_facts(name, df))
    return out


def _table(spark: SparkSession, path: str) -> DataFrame:
    return mat.read_table(spark, path)


def _since(df: DataFrame, ts: str, start: Column) -> DataFrame:
    """Rows with ``ts >= start``, pruned to the partitions from that day on."""
    return df.where((F.col(mat.PART) >= F.to_date(start)) & (F.col(ts) >= start)).drop(mat.PART)


def snapshot_views(spark: SparkSession, root: str, device_args: dict | None = None
                   ) -> dict[str, DataFrame]:
    """The NOW()-relative views computed from the maintained tables."""
    t = lambda *p: _table(spark, os.path.join(root, *p))
    seen = t("views", "accounts_seen").drop(mat.PART)
    high_water = t("views", "high_water")
    as_of = marks.newest(high_water, "transactions")
    # Nothing that starts before the longest look-back and the longest window
    # can reach the score.
    horizon = ago(ago(as_of, longest(risk.LOOKBACK.values())), longest(WINDOWS))
    recent = lambda name, ts="window_end": _since(t("views", name), ts, horizon)
    dev_args = device_args or {}
    lo = ago(as_of, dev_args.get("history_from", DEVICE_HISTORY_FROM))
    staged_tx = t("staged", "transactions")
    tx_recent = _since(staged_tx, "occurred_at", horizon)
    tx_device = _since(staged_tx, "occurred_at",
                       ago(as_of, dev_args.get("recent", DEVICE_RECENT)))
    # Device history from the hourly presence table; raw rows only from the
    # day holding the lower bound (for an hour that holds both bounds).
    presence = _since(t("views", "device_presence"), "bucket_end", lo)
    near = staged_tx.where(F.col(mat.PART) == F.to_date(lo)).drop(mat.PART)
    device = pairs.device_anomalies_from_presence(tx_device, presence, near, as_of,
                                                  with_account=True, **dev_args)
    storm = ss.login_failure_storm_view(*[recent(p) for p in ss.STORM_PARTS])
    burst = ss.correlated_alert_burst_view(*[recent(p) for p in ss.BURST_PARTS])
    score = risk.account_risk_score(
        tx_recent, recent("velocity_alerts"), ss.geo_hops_view(recent("geo_hops", "txn2_time")),
        device,
        recent("cnp_spike"), storm, recent("structuring"),
        burst, as_of=as_of, seen=seen)
    kyc = t("views", "latest_kyc").drop(mat.PART)
    # The alerts' own newest time anchors their look-back, as in batch.
    staged_alerts = t("staged", "alert_events")
    newest = marks.newest(high_water, "alert_events")
    alerts = _since(staged_alerts, "occurred_at", ago(newest, HIGH_ALERT_LOOKBACK))
    return {
        "account_risk_score": score,
        "open_fraud_cases": cases.open_fraud_cases(score, kyc),
        "resolved_cases": cases.resolved_cases(score),
        "recent_high_alerts": cases.recent_high_alerts(alerts, kyc, as_of=newest),
    }


def refresh_snapshot(spark: SparkSession, root: str, device_args: dict | None = None) -> int:
    """Publish a new version of every NOW()-relative view; returns its number.

    The score is computed and written once; the cases are derived from the
    written score, so they cannot disagree with it.  Readers (``snapshot``)
    take the newest published version, which exists as a whole: its number is
    appended to ``snapshot/published`` after its last view is written.
    """
    base = os.path.join(root, "snapshot")
    version = time.time_ns()
    at = lambda name: os.path.join(base, f"version={version}", name)
    views = snapshot_views(spark, root, device_args)
    views["account_risk_score"].write.parquet(at("account_risk_score"))
    score = spark.read.parquet(at("account_risk_score"))
    kyc = _table(spark, os.path.join(root, "views", "latest_kyc")).drop(mat.PART)
    cases.open_fraud_cases(score, kyc).write.parquet(at("open_fraud_cases"))
    cases.resolved_cases(score).write.parquet(at("resolved_cases"))
    views["recent_high_alerts"].write.parquet(at("recent_high_alerts"))
    spark.createDataFrame([(version,)], "version long").coalesce(1).write.mode("append").json(
        os.path.join(base, "published"))
    return version


def snapshot(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A view of the newest published snapshot."""
    base = os.path.join(root, "snapshot")
    version = spark.read.schema("version long").json(os.path.join(base, "published")).agg(
        F.max("version")).first()[0]
    return spark.read.parquet(os.path.join(base, f"version={version}", name))


def query_staleness(spark: SparkSession, topo: Topology, now=None,
                    stale_after: int = STALE_AFTER_SECONDS) -> DataFrame:
    """G6 for running streams: per query, rows in the last micro-batch, when it
    ran, seconds since, and ``ok`` / ``degraded`` (from query progress only)."""
    import datetime as dt
    now = now or dt.datetime.now(dt.timezone.utc)
    rows = []
    for q in topo.queries:
        p = q.lastProgress or {}
        ts = p.get("timestamp")
        at = dt.datetime.fromisoformat(ts.replace("Z", "+00:00")) if ts else None
        stale = int((now - at).total_seconds()) if at else None
        rows.append((q.name or str(q.id), int(p.get("numInputRows", 0)), at, stale,
                     "ok" if stale is not None and stale < stale_after else "degraded"))
    return spark.createDataFrame(
        rows, "query string, last_batch_rows long, last_batch_at timestamp, "
              "stale_seconds long, status string")


def maintained_views(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The monotone views as kept by the topology (read side)."""
    v = lambda name: mat.read_view(spark, os.path.join(root, "views", name))
    out = {name: v(name) for name in list(SIGNAL_SOURCE) + [
        "merchant_fraud_exposure", "channel_risk_breakdown", "hourly_fraud_trend",
        "known_customer_devices", "latest_kyc"]}
    out["login_failure_storm"] = ss.login_failure_storm_view(*[v(p) for p in ss.STORM_PARTS])
    out["correlated_alert_burst"] = ss.correlated_alert_burst_view(
        *[v(p) for p in ss.BURST_PARTS])
    geo = ss.geo_hops_view(v("geo_hops"))
    out["geo_impossible_trips"] = geo.drop("txn2_account_id")
    out["fraud_kpis_1min"] = risk.fraud_kpis_assemble(
        v("kpi_transactions"), v("kpi_alerts"), out["velocity_alerts"], geo,
        out["login_failure_storm"], out["structuring"])
    return out
