"""The view graph: every view as a lazily composed DataFrame.

``Views`` is the graph of views: each property is one view defined on its
upstream views, built once per ``Views`` object.  Without a ``store`` nothing
executes until a result is requested.  With one, staged streams and the views
that others are built on are written there when first needed, events laid out
by day, and read from there afterwards: the raw strings are parsed once, time
filters prune days, and serving queries read a view instead of deriving it.
"""

from __future__ import annotations

from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskstream.functions.time import PART, ago, as_of_column
from riskstream.operators import (
    cases,
    marks,
    pairs,
    positions,
    quality,
    risk,
    signals,
    staging,
)
from riskstream.session import configure
from riskstream.sources import bridge

# Time-scaled arguments for the compressed test timeline (1 raw day = 1 minute)
# used by the device signal, whose defaults span days.
DEVICE_ARGS_COMPRESSED = {"recent": "1 minute", "history_from": "30 minutes",
                          "history_until": "1 minute"}
# LAG time bucket on the compressed timeline (= one raw day).
GEO_BUCKET_COMPRESSED = "1 minute"


class Views:
    """All views over one set of raw streams.

    ``raw`` maps stream name -> source-shaped DataFrame (string timestamps).
    ``device_args`` / ``geo_bucket`` override operator defaults.
    """

    def __init__(self, raw: dict[str, DataFrame], as_of=None, device_args: dict | None = None,
                 geo_bucket: str = "1 hour", store: str | None = None):
        self.raw = raw
        self.store = store
        self.built: dict[str, DataFrame] = {}  # what the store's tables were written from
        self.as_of = as_of
        self.device_args = device_args or {}
        self.geo_bucket = geo_bucket

    def _kept(self, name: str, df: DataFrame, ts: str | None = None) -> DataFrame:
        """``df`` as a table of the store, laid out by the day of ``ts``."""
        if self.store is None:
            return df
        self.built[name] = df
        path = f"{self.store}/{name}"
        # Rows of a day go to few tasks, whose number follows their size: else every
        # task would open a file for every day.
        out = df.withColumn(PART, F.to_date(ts)).hint("rebalance", PART) if ts else df
        out.write.partitionBy(*[PART] * bool(ts)).parquet(path)
        # Nullable as Parquet is; the partition column comes last.
        return df.sparkSession.read.schema(out.schema).parquet(path)

    def _staged(self, name: str, stage, ts: str = "occurred_at", view: str | None = None
                ) -> DataFrame:
        """A staged stream; writing it records its high-water mark and NULLs."""
        df, view = stage(self.raw[name]), view or f"stg_{name}"
        if self.store is None:
            return df
        watched, seen = marks.observed(df, ts, quality.VIEW_TESTS[view]["not_null"])
        out = self._kept(view, watched, ts)
        marks.record(df.sparkSession, f"{self.store}/high_water", name, view, seen)
        return out

    STREAMS = {"transactions": ("stg_transactions", "occurred_at"),
               "login_events": ("stg_login_events", "occurred_at"),
               "card_events": ("stg_card_events", "occurred_at"),
               "alert_events": ("stg_alert_events", "occurred_at"),
               "kyc_profile_events": ("stg_kyc_profiles", "updated_at")}

    @cached_property
    def high_water(self) -> DataFrame:
        """stream, view_name, rows, newest of all five streams."""
        staged = {n: (view, getattr(self, view), ts) for n, (view, ts) in self.STREAMS.items()}
        if self.store is None:
            return marks.computed(staged)
        return marks.read(self.stg_transactions.sparkSession, f"{self.store}/high_water")

    @cached_property
    def measured_nulls(self) -> DataFrame | None:
        """NULLs found when the staged streams were written (None without a store)."""
        if self.store is None:
            return None
        spark = self.high_water.sparkSession
        return marks.null_counts(spark, f"{self.store}/high_water")

    def _now(self, stream: str):
        """The instant of a view over one stream: the given one, else the stream's
        high-water mark, else (without a store) the operator's own default."""
        if self.as_of is not None or self.store is None:
            return self.as_of
        staged = getattr(self, self.STREAMS[stream][0])
        return marks.newest(marks.read(staged.sparkSession, f"{self.store}/high_water"), stream)

    @cached_property
    def positions(self) -> dict[str, DataFrame] | None:
        """The last-position index, a table a level (None without a store)."""
        if self.store is None:
            return None
        out, rows = {}, self.stg_transactions
        for level in positions.LEVELS:
            out[level] = self._kept(f"positions_{level}", positions.newest(rows, level), "period")
            rows = out[level].drop(PART)
        return out

    @classmethod
    def from_testdata(cls, spark: SparkSession, sf_dir: str, **kw) -> "Views":
        configure(spark)
        narrow = {"device_args": DEVICE_ARGS_COMPRESSED, "geo_bucket": GEO_BUCKET_COMPRESSED} | kw
        views = cls(bridge.raw_streams(spark, sf_dir), **narrow)
        at = lambda name: {"store": views.store and f"{views.store}/{name}"}
        views._wide = lambda: cls(bridge.raw_streams(spark, sf_dir, bridge.WIDE_COMPRESSION),
                                  **kw | at("wide"))
        views._corrupted = lambda: cls(bridge.corrupted_streams(spark, sf_dir),
                                       **narrow | at("corrupted"))
        return views

    @cached_property
    def wide(self) -> "Views":
        """Test data only: the same events over three days, default arguments."""
        return self._wide()

    @cached_property
    def corrupted(self) -> "Views":
        """Test data only: the views over a faulty transaction feed."""
        return self._corrupted()

    @classmethod
    def from_sources(cls, spark: SparkSession, sources: dict[str, str | dict], fmt: str = "json",
                     **kw) -> "Views":
        """Views over the five topics: ``stream -> path`` of files, or ``stream ->``
        arguments of ``sources.events.load`` (``brokers`` reads what a topic holds);
        rows that cannot be read are in ``dead_letters``, not in the views."""
        from riskstream.sources import events
        configure(spark)
        given = {n: s if isinstance(s, dict) else {"path": s, "fmt": fmt}
                 for n, s in sources.items()}
        loaded = {name: events.load(spark, name, **how) for name, how in given.items()}
        views = cls({name: good for name, (good, _) in loaded.items()}, **kw)
        views.dead_letters = reduce(DataFrame.unionByName, [bad for _, bad in loaded.values()])
        return views

    #: (topic, payload, error) of unreadable rows, where the views have sources.
    dead_letters: DataFrame | None = None

    VIEW_NAMES = (
        "stg_transactions", "stg_login_events", "stg_card_events", "stg_alert_events",
        "stg_kyc_profiles", "latest_kyc", "velocity_alerts", "cnp_spike", "login_failure_storm",
        "structuring", "correlated_alert_burst", "shared_device_ring", "known_customer_devices",
        "geo_impossible_trips", "device_anomalies", "account_risk_score", "fraud_kpis_1min",
        "merchant_fraud_exposure", "channel_risk_breakdown", "hourly_fraud_trend",
        "open_fraud_cases", "resolved_cases", "recent_high_alerts")

    def register_temp_views(self, prefix: str = "") -> list[str]:
        """Expose every view to ``spark.sql`` under its name (lazy; nothing runs)."""
        names = []
        for name in self.VIEW_NAMES:
            getattr(self, name).createOrReplaceTempView(prefix + name)
            names.append(prefix + name)
        return names

    def write_all(self, out_dir: str, names=None, mode: str = "overwrite") -> None:
        """Write each view as Parquet under ``out_dir/<name>`` (one job per view)."""
        import os
        for name in names or self.VIEW_NAMES:
            getattr(self, name).write.mode(mode).parquet(os.path.join(out_dir, name))
        if self.dead_letters is not None and names is None:
            self.dead_letters.write.mode(mode).parquet(os.path.join(out_dir, "dead_letters"))

    # --- staging ----------------------------------------------------------
    @cached_property
    def _transactions(self) -> DataFrame:
        return self._staged("transactions", staging.stg_transactions)

    @cached_property
    def stg_transactions(self) -> DataFrame:
        return self._transactions.drop(PART)

    @cached_property
    def _login_events(self) -> DataFrame:
        return self._staged("login_events", staging.stg_login_events)

    @cached_property
    def stg_login_events(self) -> DataFrame:
        return self._login_events.drop(PART)

    @cached_property
    def _card_events(self) -> DataFrame:
        return self._staged("card_events", staging.stg_card_events)

    @cached_property
    def stg_card_events(self) -> DataFrame:
        return self._card_events.drop(PART)

    @cached_property
    def _alert_events(self) -> DataFrame:
        return self._staged("alert_events", staging.stg_alert_events)

    @cached_property
    def stg_alert_events(self) -> DataFrame:
        return self._alert_events.drop(PART)

    @cached_property
    def stg_kyc_profiles(self) -> DataFrame:
        return self._staged("kyc_profile_events", staging.stg_kyc_profiles, "updated_at",
                            "stg_kyc_profiles").drop(PART)

    @cached_property
    def latest_kyc(self) -> DataFrame:
        return self._kept("latest_kyc", staging.latest_kyc(self.stg_kyc_profiles))

    @cached_property
    def accounts_seen(self) -> DataFrame:
        return self._kept("accounts_seen", risk.accounts_seen(self.stg_transactions))

    # --- signals ----------------------------------------------------------
    @cached_property
    def velocity_alerts(self) -> DataFrame:
        return self._kept("velocity_alerts", signals.velocity_alerts(self.stg_transactions),
                          "window_start").drop(PART)

    @cached_property
    def cnp_spike(self) -> DataFrame:
        return self._kept("cnp_spike", signals.cnp_spike(self.stg_transactions),
                          "window_start").drop(PART)

    @cached_property
    def login_failure_storm(self) -> DataFrame:
        return self._kept("login_failure_storm", signals.login_failure_storm(self.stg_login_events),
                          "window_start").drop(PART)

    @cached_property
    def structuring(self) -> DataFrame:
        return self._kept("structuring", signals.structuring(self.stg_transactions),
                          "window_start").drop(PART)

    @cached_property
    def correlated_alert_burst(self) -> DataFrame:
        return self._kept("correlated_alert_burst", signals.correlated_alert_burst(self.stg_alert_events),
                          "window_start").drop(PART)

    @cached_property
    def shared_device_ring(self) -> DataFrame:
        return signals.shared_device_ring(self.stg_transactions)

    @cached_property
    def known_customer_devices(self) -> DataFrame:
        return signals.known_customer_devices(self.stg_transactions)

    @cached_property
    def geo_hops(self) -> DataFrame:
        return self._kept("geo_hops", pairs.geo_hops(self.stg_transactions, bucket=self.geo_bucket),
                          "txn2_time").drop(PART)

    @cached_property
    def geo_impossible_trips(self) -> DataFrame:
        return self.geo_hops.drop("txn2_account_id")

    @cached_property
    def device_anomalies_with_account(self) -> DataFrame:
        return self._kept("device_anomalies", pairs.device_anomalies(
            self._transactions, as_of=self._now("transactions"), with_account=True,
            **self.device_args))

    @cached_property
    def device_anomalies(self) -> DataFrame:
        return self.device_anomalies_with_account.drop("account_id")

    # --- risk -------------------------------------------------------------
    @cached_property
    def recent_geo_hops(self) -> DataFrame | None:
        """The hops that the score looks back on, as a table: its plan uses them
        without deriving them again (None without a store)."""
        if self.store is None:
            return None
        now = as_of_column(self._transactions, "occurred_at", self._now("transactions"))
        return self._kept("recent_geo_hops", pairs.geo_hops(
            self._transactions, bucket=self.geo_bucket,
            since=ago(now, risk.LOOKBACK["geo_impossible"]), index=self.positions))

    @cached_property
    def account_risk_score(self) -> DataFrame:
        return self._kept("account_risk_score", risk.account_risk_score_snapshot(
            self._transactions, self._login_events, self._alert_events,
            self.recent_geo_hops, self.device_anomalies_with_account,
            as_of=self._now("transactions"), geo_bucket=self.geo_bucket,
            seen=self.accounts_seen if self.store else None))

    @cached_property
    def fraud_kpis_1min(self) -> DataFrame:
        return self._kept("fraud_kpis_1min", risk.fraud_kpis(
            self.stg_transactions, self.stg_alert_events, self.velocity_alerts,
            self.geo_impossible_trips, self.login_failure_storm, self.structuring),
            "window_start").drop(PART)

    @cached_property
    def merchant_fraud_exposure(self) -> DataFrame:
        return risk.merchant_fraud_exposure(self.stg_transactions)

    @cached_property
    def channel_risk_breakdown(self) -> DataFrame:
        return risk.channel_risk_breakdown(self.stg_transactions)

    @cached_property
    def hourly_fraud_trend(self) -> DataFrame:
        return risk.hourly_fraud_trend(self.stg_transactions)

    # --- cases ------------------------------------------------------------
    @cached_property
    def open_fraud_cases(self) -> DataFrame:
        return self._kept("open_fraud_cases", cases.open_fraud_cases(
            self.account_risk_score, self.latest_kyc))

    @cached_property
    def resolved_cases(self) -> DataFrame:
        return cases.resolved_cases(self.account_risk_score)

    @cached_property
    def recent_high_alerts(self) -> DataFrame:
        return cases.recent_high_alerts(self._alert_events, self.latest_kyc,
                                        as_of=self._now("alert_events"))
