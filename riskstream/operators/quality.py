"""Data-quality operators.

All checks on one view run in one pass: a GROUPING SETS aggregate (one set
per key or value column, plus the total) and a one-row summary.  Results are small tables of
failures, never the offending rows gathered in one place.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskstream.constants import (
    ACTIONS,
    CASE_TIERS,
    FRESHNESS_MAX_SECONDS,
    HIGH_ALERT_SEVERITIES,
    RISK_TIERS,
    STALE_AFTER_SECONDS,
)
from riskstream.functions.time import window_start

# The data tests declared for each view.
VIEW_TESTS = {
    "stg_transactions": {"not_null": ["transaction_id", "account_id", "customer_id",
                                      "occurred_at", "amount"],
                         "unique": ["transaction_id"]},
    "stg_login_events": {"not_null": ["event_id", "customer_id", "occurred_at"],
                         "unique": ["event_id"]},
    "stg_card_events": {"not_null": ["event_id", "occurred_at"], "unique": ["event_id"]},
    "stg_alert_events": {"not_null": ["alert_id", "customer_id", "occurred_at"],
                         "unique": ["alert_id"]},
    "stg_kyc_profiles": {"not_null": ["customer_id", "updated_at"]},
    "latest_kyc": {"not_null": ["customer_id"], "unique": ["customer_id"]},
    "account_risk_score": {"not_null": ["account_id", "customer_id", "risk_score", "risk_tier"],
                           "unique": ["account_id"],
                           "accepted_values": {"risk_tier": RISK_TIERS}},
    "fraud_kpis_1min": {"not_null": ["window_start"]},
    "open_fraud_cases": {"not_null": ["account_id", "customer_id", "risk_tier",
                                      "recommended_action"],
                         "unique": ["account_id"],
                         "accepted_values": {"risk_tier": CASE_TIERS,
                                             "recommended_action": ACTIONS}},
    "recent_high_alerts": {"not_null": ["alert_id", "severity"], "unique": ["alert_id"],
                           "accepted_values": {"severity": HIGH_ALERT_SEVERITIES}},
}


def _status(failures: Column) -> Column:
    return F.when(failures == 0, F.lit("pass")).otherwise(F.lit("fail"))


def not_null(df: DataFrame, cols: list[str]) -> DataFrame:
    """G1: NULL count per column, one pass -> rows (column, null_count)."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return wide.unpivot([], cols, "column_name", "null_count")


def unique_violations(df: DataFrame, col: str) -> DataFrame:
    """Keys that occur more than once (NULL keys are not tested)."""
    return df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n")) \
        .where(F.col("n") > 1)


def accepted_values(df: DataFrame, col: str, values) -> DataFrame:
    """Values outside the accepted set, with their counts (NULL passes)."""
    return df.where(~F.col(col).isin(*values)).groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def duplicate_count(df: DataFrame, id_col: str, alias: str = "duplicate_ids") -> DataFrame:
    """Number of ids that occur more than once."""
    return unique_violations(df, id_col).agg(F.count(F.lit(1)).alias(alias))


def freshness(df: DataFrame, ts: str, as_of: Column,
              max_seconds: int = FRESHNESS_MAX_SECONDS) -> DataFrame:
    """Whole seconds between the newest event and ``as_of``; pass when < max.

    ``df`` may be the events or a table of high-water marks.
    """
    last = df.agg(F.max(ts).alias("last_event_at"))
    age = F.round((F.unix_micros(as_of) - F.unix_micros(F.col("last_event_at"))) / 1e6) \
        .cast("bigint")
    return last.select("last_event_at", age.alias("age_seconds"),
                       F.when(age < max_seconds, "pass").otherwise("fail").alias("status"))


def topic_staleness(marks: DataFrame, as_of: Column | None = None,
                    stale_after: int = STALE_AFTER_SECONDS) -> DataFrame:
    """Per topic: events seen, newest event, seconds since, ok/degraded.

    ``marks`` has one row a stream (``operators.marks``); without ``as_of`` the
    newest event of all topics is the instant.
    """
    topics = marks.select(F.col("stream").alias("topic"), F.col("rows").alias("published"),
                          F.col("newest").alias("last_event_at"))
    # One row per topic: a window over all of them is as small as the result.
    now = F.max("last_event_at").over(Window.partitionBy()) if as_of is None else as_of
    out = topics.withColumn("_now", now)
    stale = F.round((F.unix_micros("_now") - F.unix_micros("last_event_at")) / 1e6) \
        .cast("bigint")
    return out.select("topic", "published", "last_event_at", stale.alias("stale_seconds"),
                      F.when(stale < stale_after, "ok").otherwise("degraded").alias("status"))


def reconcile(source: DataFrame, source_ts: Column, staged: DataFrame, staged_ts: str,
              window: str = "1 minute") -> DataFrame:
    """Row counts per window, source vs staged (full outer join).

    Rows whose time is NULL (unparsable) form their own NULL window, so they
    show up as missing instead of vanishing.
    """
    s = source.groupBy(window_start(source_ts, window).alias("window_start")) \
        .agg(F.count(F.lit(1)).alias("source_count"))
    t = staged.groupBy(window_start(F.col(staged_ts), window).alias("window_start")) \
        .agg(F.count(F.lit(1)).alias("staged_count"))
    j = s.join(t, "window_start", "full_outer")
    zero = F.lit(0).cast("bigint")
    return j.select("window_start", F.coalesce("source_count", zero).alias("source_count"),
                    F.coalesce("staged_count", zero).alias("staged_count"),
                    (F.coalesce("source_count", zero) - F.coalesce("staged_count", zero))
                    .alias("missing"))


def view_checks(df: DataFrame, view: str, not_null_cols=(), unique=(),
                accepted: dict | None = None) -> DataFrame:
    """Rows (check_name, view_name, column_name, failures, status) for one view.

    One pass over the view: a GROUPING SETS aggregate with one set per unique
    key, one per accepted-values column and the grand total (which carries
    the NULL counts), then a one-row summary.  Failures follow the data-test
    conventions: NULL rows for not_null, duplicated (non-NULL) keys for
    unique, distinct (non-NULL) values outside the list for accepted_values.
    """
    accepted = accepted or {}
    group_cols = list(dict.fromkeys([*unique, *accepted]))
    nulls = [F.count_if(F.col(c).isNull()).alias(f"_null{i}")
             for i, c in enumerate(not_null_cols)]
    specs = []  # (check, column, summary expression)
    if group_cols:
        m = len(group_cols)
        total = (1 << m) - 1
        gid_of = {c: total - (1 << (m - 1 - i)) for i, c in enumerate(group_cols)}
        g = df.groupingSets([[c] for c in group_cols] + [[]], *group_cols).agg(
            F.count(F.lit(1)).alias("_n"), *nulls, F.grouping_id().alias("_gid"))
        gid = F.col("_gid")
        specs += [("not_null", c, F.sum(F.when(gid == total, F.col(f"_null{i}"))))
                  for i, c in enumerate(not_null_cols)]
        specs += [("unique", c, F.count_if((gid == gid_of[c]) & F.col(c).isNotNull()
                                           & (F.col("_n") > 1))) for c in unique]
        specs += [("accepted_values", c, F.count_if((gid == gid_of[c]) & F.col(c).isNotNull()
                                                    & ~F.col(c).isin(*vals)))
                  for c, vals in accepted.items()]
    else:
        g = df.agg(*nulls)
        specs += [("not_null", c, F.sum(F.col(f"_null{i}"))) for i, c in enumerate(not_null_cols)]
    names = [f"_{i}" for i in range(len(specs))]
    wide = g.agg(*[e.alias(n) for n, (_, _, e) in zip(names, specs)])
    long = wide.unpivot([], names, "test", "failures")
    check = F.create_map(*chain.from_iterable((F.lit(n), F.lit(sp[0]))
                                              for n, sp in zip(names, specs)))
    column = F.create_map(*chain.from_iterable((F.lit(n), F.lit(sp[1]))
                                               for n, sp in zip(names, specs)))
    out = long.select(check[F.col("test")].alias("check_name"), F.lit(view).alias("view_name"),
                      column[F.col("test")].alias("column_name"),
                      F.coalesce(F.col("failures").cast("bigint"), F.lit(0).cast("bigint"))
                      .alias("failures"))
    return out.withColumn("status", _status(F.col("failures")))


def dq_report(views: dict[str, DataFrame], fresh: DataFrame | None = None,
              tests: dict | None = None, measured: DataFrame | None = None,
              measured_views: tuple[str, ...] = ()) -> DataFrame:
    """The declared data tests of every view, plus the freshness check.

    ``measured`` (view_name, column_name, failures) has the NOT NULL checks of
    ``measured_views`` as their writes observed them; these are not made again.
    """
    tests = tests or VIEW_TESTS
    parts = []
    for v, t in tests.items():
        nulls = () if v in measured_views else t.get("not_null", ())
        if v in views and (nulls or t.get("unique") or t.get("accepted_values")):
            parts.append(view_checks(views[v], v, nulls, t.get("unique", ()),
                                     t.get("accepted_values")))
    if measured is not None:
        parts.append(measured.where(F.col("view_name").isin(*measured_views)).select(
            F.lit("not_null").alias("check_name"), "view_name", "column_name",
            F.col("failures").cast("bigint").alias("failures"),
            _status(F.col("failures")).alias("status")))
    if fresh is not None:
        parts.append(fresh.select(
            F.lit("freshness").alias("check_name"), F.lit("stg_transactions").alias("view_name"),
            F.lit("occurred_at").alias("column_name"),
            F.when(F.col("status") == "pass", F.lit(0)).otherwise(F.lit(1)).cast("bigint")
            .alias("failures"), "status"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def threshold_guard(spark) -> DataFrame:
    """The pinned thresholds are the operators' defaults, and the device
    signal plans a left anti join against its history.

    Reads the live function signatures and an (empty-input) optimized plan,
    so a changed default or a rewritten join shows up as ``fail``.
    """
    import inspect

    from riskstream import schemas
    from riskstream.operators import pairs, signals, staging

    def default(fn, arg):
        return inspect.signature(fn).parameters[arg].default

    checks = [("velocity min_txns", 5, default(signals.velocity_alerts, "min_txns")),
              ("cnp_spike min_txns", 8, default(signals.cnp_spike, "min_txns")),
              ("login storm min_failures", 3, default(signals.login_failure_storm, "min_failures"))]
    empty = staging.stg_transactions(spark.createDataFrame([], schemas.TRANSACTIONS))
    plan = pairs.device_anomalies(empty, as_of="2026-01-01 00:00:00")
    anti = "LeftAnti" in plan._jdf.queryExecution().optimizedPlan().toString()
    checks.append(("device anomaly anti-join", 1, int(anti)))
    rows = [(name, str(want), str(got), "pass" if want == got else "fail")
            for name, want, got in checks]
    return spark.createDataFrame(rows, "check_name string, expected string, actual string, "
                                       "status string")
