"""Risk aggregation: account risk score (D1) and operational KPIs.

Score arithmetic is decimal (0.1 + 0.2 is exactly 0.3) and cast to double
after the cap, so tiers never flip on binary rounding.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskstream.constants import (
    ACTIVE_ACCOUNT_LOOKBACK,
    BASE_SCORE,
    BURST_WINDOW,
    CNP_WINDOW,
    LOWEST_TIER,
    SCORE_CAP,
    SCORE_LOOKBACK,
    SIGNAL_WEIGHTS,
    STORM_WINDOW,
    STRUCTURING_WINDOW,
    TIERS,
    VELOCITY_WINDOW,
)
from riskstream.functions.numeric import flag, money_sum, pct, round_numeric
from riskstream.functions.time import ago, as_of_column, since
from riskstream.operators import pairs, signals

LOOKBACK = dict(SCORE_LOOKBACK)


def customer_accounts(stg_tx: DataFrame) -> DataFrame:
    """Distinct (customer_id, account_id) pairs ever seen.

    Used instead of raw transactions when a customer-level signal is spread
    to accounts: identical result after the MAX, but the join input is one
    row per pair (reduced map-side) instead of one per transaction.
    """
    return stg_tx.select("customer_id", "account_id").distinct()


def risk_tier(score: Column) -> Column:
    (t1, v1), (t2, v2), (t3, v3) = TIERS
    return F.when(score > v1, F.lit(t1)).when(score > v2, F.lit(t2)) \
        .when(score > v3, F.lit(t3)).otherwise(F.lit(LOWEST_TIER))


def score_columns(flags: dict[str, Column]) -> tuple[Column, Column]:
    """(risk_score, contributing_signals) from 0/1/NULL flag columns."""
    raw = F.lit(BASE_SCORE)
    names = []
    for name, weight in SIGNAL_WEIGHTS:
        f = F.coalesce(flags[name], F.lit(0))
        raw = raw + f * F.lit(weight)
        names.append(F.when(f == 1, F.lit(name)))
    score = F.least(F.lit(SCORE_CAP), raw).cast("double")
    return score, F.array_compact(F.array(*names))


def accounts_seen(stg_tx: DataFrame) -> DataFrame:
    """(customer_id, account_id, last_seen_at): every pair ever seen.

    One hash aggregate (partial per partition).  Streaming keeps it
    incrementally (``streaming.topology``), so the score never rescans the
    history for it.
    """
    return stg_tx.groupBy("customer_id", "account_id").agg(
        F.max("occurred_at").alias("last_seen_at"))


def account_risk_score(stg_tx: DataFrame, velocity: DataFrame, geo: DataFrame,
                       device: DataFrame, cnp: DataFrame, storm: DataFrame,
                       structuring: DataFrame, burst: DataFrame, as_of=None,
                       lookback: dict[str, str] | None = None,
                       active_lookback: str = ACTIVE_ACCOUNT_LOOKBACK,
                       seen: DataFrame | None = None) -> DataFrame:
    """One row per (account, customer) active in the last hour.

    ``geo`` must carry ``txn2_account_id`` and ``device`` ``account_id``
    (``geo_hops`` / ``device_anomalies(with_account=True)``): the account of
    the flagged transaction, which the reference obtains by joining all
    transactions on ``transaction_id``; identical under the unique
    ``transaction_id`` contract (checked by ``unique``), without a shuffle of
    every transaction.  Customer-level signals (brute force, compound alerts)
    reach every account the customer has ever used, through the all-time
    (customer, account) pairs of ``accounts_seen`` (pass ``seen`` to use a
    maintained table instead of aggregating ``stg_tx``).

    The account-keyed flags are one union and one aggregate, left-joined once;
    AQE broadcasts a side only when its measured size allows.  The
    structuring flag is keyed by (account, customer) but joined on the account
    only, as defined (an account shared by two customers fans out;
    ``unique(account_id)`` reports it).
    """
    lb = {**LOOKBACK, **(lookback or {})}
    now = as_of_column(stg_tx, "occurred_at", as_of)
    # One aggregate gives both the all-time (customer, account) pairs and the
    # accounts active in the last hour.
    seen = accounts_seen(stg_tx) if seen is None else seen
    pairs = seen.select("customer_id", "account_id")
    active = seen.where(F.col("last_seen_at") >= ago(now, active_lookback)) \
        .select("account_id", "customer_id")

    def recent(df: DataFrame, ts: str, name: str) -> DataFrame:
        return df.where(F.col(ts) >= ago(now, lb[name]))

    def rows_of(df: DataFrame, account: str, flag_col: str, name: str) -> DataFrame:
        return df.select(F.col(account).alias("account_id"), F.lit(name).alias("_signal"),
                         flag(F.col(flag_col)).alias("_f"))

    # Account-keyed flags: one union, one aggregate, one join (instead of one
    # aggregate + join per signal).  MAX over no rows is NULL -> 0 later.
    account_rows = [
        rows_of(recent(velocity, "window_end", "velocity"), "account_id",
                "is_velocity_breach", "velocity"),
        rows_of(recent(geo, "txn2_time", "geo_impossible"), "txn2_account_id",
                "is_impossible", "geo_impossible"),
        rows_of(recent(device, "occurred_at", "device_anomaly"), "account_id",
                "combined_risk_flag", "device_anomaly"),
        rows_of(recent(cnp, "window_end", "cnp_spike"), "account_id", "is_cnp_spike",
                "cnp_spike"),
        rows_of(recent(burst, "window_end", "compound_fraud").join(pairs, "customer_id"),
                "account_id", "is_compound_fraud", "compound_fraud"),
    ]
    u = account_rows[0]
    for part in account_rows[1:]:
        u = u.unionByName(part)
    per_account = u.groupBy("account_id").agg(
        *[F.max(F.when(F.col("_signal") == n, F.col("_f"))).alias(n)
          for n in ("velocity", "geo_impossible", "device_anomaly", "cnp_spike",
                    "compound_fraud")])
    # Brute force is keyed by (customer, account); structuring by (account,
    # customer) but joined on the account only, as defined.
    rb = recent(storm, "window_end", "brute_force").join(pairs, "customer_id") \
        .groupBy("customer_id", "account_id") \
        .agg(F.max(flag(F.col("is_brute_force"))).alias("brute_force"))
    rs = recent(structuring, "window_end", "structuring").groupBy("account_id", "customer_id") \
        .agg(F.max(flag(F.col("is_structuring_pattern"))).alias("structuring")) \
        .drop("customer_id")

    scored = (active
              .join(per_account, "account_id", "left")
              .join(rb, ["account_id", "customer_id"], "left")
              .join(rs, "account_id", "left"))
    score, names = score_columns({name: F.col(name) for name, _ in SIGNAL_WEIGHTS})
    return scored.select(
        "account_id", "customer_id", score.alias("risk_score"),
        names.alias("contributing_signals"), risk_tier(score).alias("risk_tier"))


def account_risk_score_snapshot(stg_tx: DataFrame, stg_login: DataFrame, stg_alerts: DataFrame,
                                geo: DataFrame | None, device: DataFrame, as_of=None,
                                lookback: dict[str, str] | None = None,
                                geo_bucket: str = "1 hour",
                                seen: DataFrame | None = None,
                                index: dict[str, DataFrame] | None = None) -> DataFrame:
    """D1 from staged events, reading only the rows each signal can contribute.

    A tumbling window of length ``d`` that ends at or after ``as_of - L`` starts
    at or after ``as_of - L - d``, so every row of such a window is kept by the
    pre-filter ``occurred_at >= as_of - L - d``; windows the filter cuts short
    end before ``as_of - L`` and are dropped by the look-back anyway.  The
    result is identical to scoring the full signal views, but the aggregations
    shuffle only recent rows, and on a time-partitioned staged table the scan
    prunes to the last couple of hours.  With ``geo=None`` the geo hops are
    computed for the look-back only (``geo_hops(since=...)``: recent rows plus
    each customer's last earlier row, from the last-position ``index`` if
    there is one).  The device signal (30 days of history) is passed in.
    """
    lb = {**LOOKBACK, **(lookback or {})}
    now = as_of_column(stg_tx, "occurred_at", as_of)

    def recent(df: DataFrame, name: str, window: str) -> DataFrame:
        return since(df, "occurred_at", ago(ago(now, lb[name]), window))

    if geo is None:
        geo = pairs.geo_hops(stg_tx, bucket=geo_bucket, since=ago(now, lb["geo_impossible"]),
                             index=index)
    return account_risk_score(
        stg_tx,
        signals.velocity_alerts(recent(stg_tx, "velocity", VELOCITY_WINDOW)),
        geo, device,
        signals.cnp_spike(recent(stg_tx, "cnp_spike", CNP_WINDOW)),
        signals.login_failure_storm(recent(stg_login, "brute_force", STORM_WINDOW)),
        signals.structuring(recent(stg_tx, "structuring", STRUCTURING_WINDOW)),
        signals.correlated_alert_burst(recent(stg_alerts, "compound_fraud", BURST_WINDOW)),
        as_of=now, lookback=lb, seen=seen)


def kpi_transactions(stg_tx: DataFrame, window: str = "1 minute") -> DataFrame:
    """Per window count, value and high-risk-MCC count (monotone)."""
    tw = stg_tx.groupBy(F.window("occurred_at", window).alias("w")).agg(
        F.count(F.lit(1)).alias("total_transactions"),
        money_sum("amount").alias("transaction_value"),
        F.count_if(F.col("is_high_risk_mcc")).alias("flagged_transactions"))
    return tw.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                     "total_transactions", "transaction_value", "flagged_transactions")


def kpi_alerts(stg_alerts: DataFrame, window: str = "1 minute") -> DataFrame:
    """D2f parts: per window sum and count of confidence (AVG = sum / count)."""
    aw = stg_alerts.groupBy(F.window("occurred_at", window).alias("w")).agg(
        F.sum("confidence_score").alias("confidence_sum"),
        F.count("confidence_score").alias("confidence_n"))
    return aw.select(F.col("w.start").alias("window_start"), "confidence_sum", "confidence_n")


def fraud_kpis_assemble(tw: DataFrame, aw: DataFrame, velocity: DataFrame, geo: DataFrame,
                        storm: DataFrame, structuring: DataFrame,
                        window: str = "1 minute") -> DataFrame:
    """D2 from its parts (batch, or maintained tables in streaming)."""
    def per_window(df: DataFrame, cond: str, start: Column, name: str) -> DataFrame:
        return df.where(F.col(cond)).groupBy(start.alias("window_start")) \
            .agg(F.count(F.lit(1)).alias(name))

    start = F.col("window_start")
    sides = [
        per_window(velocity, "is_velocity_breach", start, "velocity_breaches"),
        per_window(geo, "is_impossible", F.window("txn2_time", window).start, "geo_anomalies"),
        per_window(storm, "is_brute_force", start, "brute_force_attempts"),
        per_window(structuring, "is_structuring_pattern", start, "structuring_flags"),
        aw.select("window_start", (F.col("confidence_sum") / F.col("confidence_n")).alias("_conf")),
    ]
    j = tw
    for side in sides:
        j = j.join(side, "window_start", "left")
    zero = F.lit(0).cast("bigint")
    return j.select(
        "window_start", "window_end", "total_transactions", "flagged_transactions",
        F.lit(0).alias("critical_risk_accounts"),
        round_numeric("transaction_value", 2).alias("total_transaction_value"),
        round_numeric(pct(F.col("flagged_transactions"), F.col("total_transactions")), 2)
        .alias("fraud_rate_pct"),
        F.coalesce("velocity_breaches", zero).alias("velocity_breaches"),
        F.coalesce("geo_anomalies", zero).alias("geo_anomalies"),
        F.coalesce("brute_force_attempts", zero).alias("brute_force_attempts"),
        F.coalesce("structuring_flags", zero).alias("structuring_flags"),
        round_numeric(F.coalesce("_conf", F.lit(0.0)), 4).alias("avg_alert_confidence"))


def fraud_kpis(stg_tx: DataFrame, stg_alerts: DataFrame, velocity: DataFrame, geo: DataFrame,
               storm: DataFrame, structuring: DataFrame, window: str = "1 minute") -> DataFrame:
    """Per-window operations KPIs driven by transaction windows.

    Signals in windows without transactions vanish (left joins); structuring
    windows (60 min) only meet the KPI window starting at the same instant,
    and ``critical_risk_accounts`` is the constant 0 -- all as defined.
    Every side is one row per window, so each join is tiny and broadcast by
    AQE after its size is measured.
    """
    return fraud_kpis_assemble(kpi_transactions(stg_tx, window), kpi_alerts(stg_alerts, window),
                               velocity, geo, storm, structuring, window)


def _flagged_measures() -> dict[str, Column]:
    hr = F.col("is_high_risk_mcc")
    return {
        "n": F.count(F.lit(1)),
        "flagged": F.count_if(hr),
        "value": money_sum("amount"),
        "flagged_value": money_sum(F.when(hr, F.col("amount"))),
        "avg_amount": money_sum("amount") / F.count("amount"),
    }


def merchant_fraud_exposure(stg_tx: DataFrame, window: str = "1 hour",
                            min_txns: int = 2) -> DataFrame:
    """D3: high-risk-MCC exposure per merchant and window (HAVING count >= min)."""
    m = _flagged_measures()
    agg = stg_tx.groupBy("merchant_id", "merchant_name", "merchant_category_code",
                         F.window("occurred_at", window).start.alias("window_start")) \
        .agg(*[m[k].alias(k) for k in ("n", "flagged", "value", "flagged_value")])
    return agg.where(F.col("n") >= min_txns).select(
        "merchant_id", "merchant_name", "merchant_category_code", "window_start",
        F.col("n").alias("total_txns"), F.col("flagged").alias("flagged_txns"),
        round_numeric(pct(F.col("flagged"), F.col("n")), 2).alias("fraud_exposure_pct"),
        round_numeric("value", 2).alias("total_value"),
        round_numeric("flagged_value", 2).alias("flagged_value"))


def channel_risk_breakdown(stg_tx: DataFrame, window: str = "1 hour") -> DataFrame:
    """Per channel and window; ``flagged_value`` is NULL when nothing is flagged."""
    m = _flagged_measures()
    agg = stg_tx.groupBy("channel", F.window("occurred_at", window).start.alias("window_start")) \
        .agg(*[v.alias(k) for k, v in m.items()])
    return agg.select(
        "channel", "window_start", F.col("n").alias("txn_count"),
        F.col("flagged").alias("flagged_count"),
        round_numeric("value", 2).alias("total_value"),
        round_numeric("flagged_value", 2).alias("flagged_value"),
        round_numeric(pct(F.col("flagged"), F.col("n")), 2).alias("fraud_rate_pct"),
        round_numeric("avg_amount", 2).alias("avg_amount"))


def hourly_fraud_trend(stg_tx: DataFrame, window: str = "1 hour",
                       since=None) -> DataFrame:
    """Per-bucket totals.  No time predicate unless ``since`` is given."""
    if since is not None:
        stg_tx = stg_tx.where(F.col("occurred_at") >= F.lit(since).cast("timestamp"))
    m = _flagged_measures()
    agg = stg_tx.groupBy(F.window("occurred_at", window).start.alias("hour_bucket")) \
        .agg(m["n"].alias("n"), m["flagged"].alias("flagged"), m["value"].alias("value"))
    return agg.select(
        "hour_bucket", F.col("n").alias("total_txns"), F.col("flagged").alias("fraud_flags"),
        round_numeric(pct(F.col("flagged"), F.col("n")), 2).alias("fraud_rate_pct"),
        round_numeric("value", 2).alias("total_value"))
