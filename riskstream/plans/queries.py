"""Registered queries: name -> (Spark builder over ``Views``, DuckDB oracle SQL).

Every query reads the driver tables through the bridge and runs over the
whole tables.  Limits appear only in the top-k / latest-row serving queries,
where the limit is the feature.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskstream import schemas
from riskstream.operators import alerts, marks, quality, serving, signals, staging
from riskstream.operators.risk import customer_accounts
from riskstream.plans import oracle
from riskstream.plans.oracle import rnd, sql
from riskstream.plans.views import Views
from riskstream.sources import events

Builder = Callable[[Views], DataFrame]
REGISTRY: dict[str, tuple[Builder, str | None]] = {}


def register(name: str, oracle_sql: str | None):
    def deco(fn: Builder) -> Builder:
        REGISTRY[name] = (fn, oracle_sql)
        return fn
    return deco


def _view(name: str) -> None:
    REGISTRY[name] = (lambda v: getattr(v, name), sql(f"SELECT * FROM {name}", name))


# --- staging, signals, risk, cases: one view each ---------------------------
for _n in ["stg_transactions", "stg_login_events", "stg_card_events", "stg_alert_events",
           "stg_kyc_profiles", "latest_kyc", "velocity_alerts", "cnp_spike",
           "login_failure_storm", "structuring", "correlated_alert_burst", "shared_device_ring",
           "geo_impossible_trips", "known_customer_devices", "device_anomalies",
           "account_risk_score", "fraud_kpis_1min", "merchant_fraud_exposure",
           "channel_risk_breakdown", "hourly_fraud_trend", "open_fraud_cases", "resolved_cases",
           "recent_high_alerts"]:
    _view(_n)


# Sessions of failed logins (gaps and islands), and the storm in sliding windows.
register("login_failure_sessions", sql("""
SELECT customer_id, min(occurred_at) AS window_start,
       max(occurred_at) + INTERVAL 1 MINUTE AS window_end, count(*) AS failure_count,
       count(DISTINCT ip_address) AS distinct_ips, count(DISTINCT device_id) AS distinct_devices,
       min(occurred_at) AS first_failure_at, max(occurred_at) AS last_failure_at,
       true AS is_brute_force
FROM (SELECT *, sum(begins) OVER (PARTITION BY customer_id ORDER BY occurred_at
                                  RANGE UNBOUNDED PRECEDING) AS island
      FROM (SELECT *, CASE WHEN occurred_at <= lag(occurred_at) OVER (
                PARTITION BY customer_id ORDER BY occurred_at) + INTERVAL 1 MINUTE
              THEN 0 ELSE 1 END AS begins
            FROM stg_login_events WHERE success = FALSE AND occurred_at IS NOT NULL))
GROUP BY customer_id, island HAVING count(*) >= 3""", "stg_login_events"))(
    lambda v: signals.login_failure_storm(v.stg_login_events, session="1 minute"))
register("login_failure_sliding", sql("""
SELECT customer_id, starts AS window_start, starts + INTERVAL 1 MINUTE AS window_end,
       count(*) AS failure_count, count(DISTINCT ip_address) AS distinct_ips,
       count(DISTINCT device_id) AS distinct_devices, min(occurred_at) AS first_failure_at,
       max(occurred_at) AS last_failure_at, true AS is_brute_force
FROM (SELECT *, time_bucket(INTERVAL 20 SECOND, occurred_at) - back * INTERVAL 20 SECOND AS starts
      FROM stg_login_events, (VALUES (0), (1), (2)) AS steps(back)
      WHERE success = FALSE AND occurred_at IS NOT NULL)
GROUP BY customer_id, starts HAVING count(*) >= 3""", "stg_login_events"))(
    lambda v: signals.login_failure_storm(v.stg_login_events, window="1 minute",
                                          slide="20 seconds"))


# --- serving ------------------------------------------------------------------
_ROW_VIEWS = ["account_risk_score", "open_fraud_cases", "velocity_alerts",
              "geo_impossible_trips", "fraud_kpis_1min"]
_SIGNAL_VIEWS = ["stg_transactions", "stg_login_events", "stg_alert_events", "stg_kyc_profiles",
                 "velocity_alerts", "login_failure_storm", "structuring", "cnp_spike",
                 "device_anomalies", "correlated_alert_burst"]


def _counts_sql(names: list[str]) -> str:
    return sql(" UNION ALL ".join(
        f"SELECT '{n}' AS view_name, COUNT(*) AS row_count FROM {n}" for n in names), *names)


register("view_row_counts", _counts_sql(_ROW_VIEWS))(
    lambda v: serving.row_counts({n: getattr(v, n) for n in _ROW_VIEWS}))
register("signal_view_counts", _counts_sql(_SIGNAL_VIEWS))(
    lambda v: serving.row_counts({n: getattr(v, n) for n in _SIGNAL_VIEWS}))

register("critical_accounts", sql(f"""
SELECT account_id, customer_id, {rnd('risk_score', 3)} AS risk_score, risk_tier,
       contributing_signals
FROM account_risk_score WHERE risk_tier = 'critical'
ORDER BY risk_score DESC, account_id LIMIT 20""", "account_risk_score"))(
    lambda v: serving.critical_accounts(v.account_risk_score))

register("top_cases", sql(f"""
SELECT customer_id, account_id, {rnd('risk_score', 3)} AS risk_score, risk_tier,
       recommended_action
FROM open_fraud_cases ORDER BY risk_score DESC, account_id LIMIT 10""", "open_fraud_cases"))(
    lambda v: serving.top_cases(v.open_fraud_cases))

register("latest_kpis", sql("""
SELECT window_start, total_transactions, flagged_transactions, fraud_rate_pct,
       critical_risk_accounts, velocity_breaches, geo_anomalies, brute_force_attempts,
       structuring_flags
FROM fraud_kpis_1min ORDER BY window_start DESC LIMIT 5""", "fraud_kpis_1min"))(
    lambda v: serving.latest_kpis(v.fraud_kpis_1min))

register("fraud_rate_line", sql(f"""
SELECT 'Fraud rate: ' || printf('%.2f', {rnd('fraud_rate_pct', 2)}) || '%  | Total txns: '
       || total_transactions || ' | Flagged: ' || flagged_transactions AS line
FROM fraud_kpis_1min ORDER BY window_start DESC LIMIT 1""", "fraud_kpis_1min"))(
    lambda v: serving.fraud_rate_line(v.fraud_kpis_1min))

register("latest_fraud_rate", sql("""
SELECT fraud_rate_pct FROM fraud_kpis_1min ORDER BY window_start DESC LIMIT 1""",
    "fraud_kpis_1min"))(lambda v: serving.latest_kpi_value(v.fraud_kpis_1min, "fraud_rate_pct"))

register("latest_transactions", sql("""
SELECT total_transactions FROM fraud_kpis_1min ORDER BY window_start DESC LIMIT 1""",
    "fraud_kpis_1min"))(
    lambda v: serving.latest_kpi_value(v.fraud_kpis_1min, "total_transactions"))

register("latest_kpi_rounded", sql(f"""
SELECT {rnd('fraud_rate_pct', 1)} AS fraud_rate_pct FROM fraud_kpis_1min
ORDER BY window_start DESC LIMIT 1""", "fraud_kpis_1min"))(
    lambda v: serving.latest_kpi_value(v.fraud_kpis_1min, "fraud_rate_pct", digits=1))

register("critical_account_count", sql("""
SELECT COUNT(*) AS critical_accounts FROM account_risk_score WHERE risk_tier = 'critical'""",
    "account_risk_score"))(
    lambda v: serving.count_where(v.account_risk_score, "critical_accounts",
                                  F.col("risk_tier") == "critical"))

register("open_case_count", sql("SELECT COUNT(*) AS open_cases FROM open_fraud_cases",
                                "open_fraud_cases"))(
    lambda v: serving.count_where(v.open_fraud_cases, "open_cases"))

_SERIES_RANGE = ("WHERE window_start BETWEEN (SELECT max(window_start) FROM fraud_kpis_1min) "
                 "- INTERVAL 30 MINUTE AND (SELECT max(window_start) FROM fraud_kpis_1min) "
                 "ORDER BY window_start")
register("throughput_series", sql(f"""
SELECT window_start AS time, total_transactions AS total, flagged_transactions AS flagged
FROM fraud_kpis_1min {_SERIES_RANGE}""", "fraud_kpis_1min"))(
    lambda v: serving.throughput_series(v.fraud_kpis_1min))
register("signal_activity_series", sql(f"""
SELECT window_start AS time, velocity_breaches AS velocity, geo_anomalies AS geo_impossible,
       brute_force_attempts AS brute_force, structuring_flags AS structuring
FROM fraud_kpis_1min {_SERIES_RANGE}""", "fraud_kpis_1min"))(
    lambda v: serving.signal_activity_series(v.fraud_kpis_1min))
register("fraud_rate_series", sql(f"""
SELECT window_start AS time, fraud_rate_pct FROM fraud_kpis_1min {_SERIES_RANGE}""",
    "fraud_kpis_1min"))(lambda v: serving.fraud_rate_series(v.fraud_kpis_1min))

register("tier_distribution", sql("""
SELECT risk_tier, COUNT(*) AS accounts FROM account_risk_score GROUP BY risk_tier
ORDER BY accounts DESC, risk_tier""", "account_risk_score"))(
    lambda v: serving.tier_distribution(v.account_risk_score))

register("case_table", sql(f"""
SELECT account_id, customer_id, {rnd('risk_score', 3)} AS risk_score, risk_tier, kyc_risk_tier,
       recommended_action, contributing_signals
FROM open_fraud_cases ORDER BY risk_score DESC, account_id LIMIT 100""", "open_fraud_cases"))(
    lambda v: serving.case_table(v.open_fraud_cases))

register("high_risk_accounts", sql(f"""
SELECT account_id, customer_id, {rnd('risk_score', 3)} AS risk_score, risk_tier,
       contributing_signals
FROM account_risk_score WHERE risk_tier IN ('high', 'critical')
ORDER BY risk_score DESC, account_id LIMIT 50""", "account_risk_score"))(
    lambda v: serving.high_risk_accounts(v.account_risk_score))


# --- data quality -----------------------------------------------------------------
_STREAM_TIMES = [("transactions", "stg_transactions", "occurred_at"),
                 ("login_events", "stg_login_events", "occurred_at"),
                 ("card_events", "stg_card_events", "occurred_at"),
                 ("alert_events", "stg_alert_events", "occurred_at"),
                 ("kyc_profile_events", "stg_kyc_profiles", "updated_at")]
_SNAPSHOT_SQL = "(SELECT max(x) FROM (" + " UNION ALL ".join(
    f"SELECT max({ts}) AS x FROM {view}" for _, view, ts in _STREAM_TIMES) + "))"
_STG = [view for _, view, _ in _STREAM_TIMES]


def snapshot_time(v: Views):
    """Newest event time over all five streams (the snapshot's ``now``)."""
    return marks.newest(v.high_water)


def _freshness(v: Views) -> DataFrame:
    return quality.freshness(v.high_water.where(F.col("stream") == "transactions"), "newest",
                             snapshot_time(v))


def _age_sql(ts: str) -> str:
    return f"CAST(ROUND((epoch_us({_SNAPSHOT_SQL}) - epoch_us({ts})) / 1e6) AS BIGINT)"


_FRESH_SQL = f"""
SELECT last_event_at, {_age_sql('last_event_at')} AS age_seconds,
       CASE WHEN {_age_sql('last_event_at')} < 180 THEN 'pass' ELSE 'fail' END AS status
FROM (SELECT max(occurred_at) AS last_event_at FROM stg_transactions)"""

register("freshness", sql(_FRESH_SQL, *_STG))(
    _freshness)

register("topic_staleness", sql(" UNION ALL ".join(f"""
SELECT '{topic}' AS topic, COUNT(*) AS published, max({ts}) AS last_event_at,
       {_age_sql(f'max({ts})')} AS stale_seconds,
       CASE WHEN {_age_sql(f'max({ts})')} < 120 THEN 'ok' ELSE 'degraded' END AS status
FROM {view}""" for topic, view, ts in _STREAM_TIMES), *_STG))(
    lambda v: quality.topic_staleness(v.high_water))

register("duplicate_count", sql("""
SELECT COUNT(*) AS duplicate_ids FROM (
  SELECT transaction_id FROM stg_transactions WHERE transaction_id IS NOT NULL
  GROUP BY transaction_id HAVING COUNT(*) > 1)""", "stg_transactions"))(
    lambda v: quality.duplicate_count(v.stg_transactions, "transaction_id"))

register("reconcile", sql(f"""
SELECT COALESCE(s.window_start, t.window_start) AS window_start,
       COALESCE(source_count, 0) AS source_count, COALESCE(staged_count, 0) AS staged_count,
       COALESCE(source_count, 0) - COALESCE(staged_count, 0) AS missing
FROM (SELECT {oracle.bucket(oracle._parse('occurred_at'), oracle.MIN)} AS window_start,
             COUNT(*) AS source_count FROM transactions GROUP BY 1) s
FULL OUTER JOIN
     (SELECT {oracle.bucket('occurred_at', oracle.MIN)} AS window_start,
             COUNT(*) AS staged_count FROM stg_transactions GROUP BY 1) t
  ON s.window_start = t.window_start""",
    "transactions", "stg_transactions"))(
    lambda v: quality.reconcile(v.raw["transactions"], staging.parse_ts("occurred_at"),
                                v.stg_transactions, "occurred_at"))


# Fixed values of the declared data tests, stated for the oracle.
_NOT_NULL = {
    "stg_transactions": "transaction_id account_id customer_id occurred_at amount",
    "stg_login_events": "event_id customer_id occurred_at",
    "stg_card_events": "event_id occurred_at",
    "stg_alert_events": "alert_id customer_id occurred_at",
    "stg_kyc_profiles": "customer_id updated_at",
    "latest_kyc": "customer_id",
    "account_risk_score": "account_id customer_id risk_score risk_tier",
    "fraud_kpis_1min": "window_start",
    "open_fraud_cases": "account_id customer_id risk_tier recommended_action",
    "recent_high_alerts": "alert_id severity"}
_UNIQUE = {"stg_transactions": "transaction_id", "stg_login_events": "event_id",
           "stg_card_events": "event_id", "stg_alert_events": "alert_id",
           "latest_kyc": "customer_id", "account_risk_score": "account_id",
           "open_fraud_cases": "account_id", "recent_high_alerts": "alert_id"}
_ACCEPTED = {
    ("account_risk_score", "risk_tier"): "low medium high critical",
    ("open_fraud_cases", "risk_tier"): "high critical",
    ("open_fraud_cases", "recommended_action"): "escalate freeze_account block_card monitor",
    ("recent_high_alerts", "severity"): "high critical"}


def _dq_sql(*views: str, over: dict | None = None, fresh: bool = True) -> str:
    """Every check counted on its own, from the values stated above."""
    of = lambda view: not views or view in views
    row = "SELECT '{}' AS check_name, '{}' AS view_name, '{}' AS column_name, ({}) AS failures"
    parts = [row.format("not_null", view, c, f"SELECT COUNT(*) - COUNT({c}) FROM {view}")
             for view, cols in _NOT_NULL.items() if of(view) for c in cols.split()]
    parts += [row.format("unique", view, c, f"SELECT COUNT(*) FROM (SELECT 1 FROM {view} "
                         f"WHERE {c} IS NOT NULL GROUP BY {c} HAVING COUNT(*) > 1)")
              for view, c in _UNIQUE.items() if of(view)]
    parts += [row.format("accepted_values", view, c, f"SELECT COUNT(DISTINCT {c}) FROM {view} "
                         f"WHERE NOT list_contains({values.split()}, {c})")
              for (view, c), values in _ACCEPTED.items() if of(view)]
    if fresh:
        parts.append("SELECT 'freshness', 'stg_transactions', 'occurred_at', "
                     f"CASE status WHEN 'pass' THEN 0 ELSE 1 END FROM ({_FRESH_SQL})")
    final = ("SELECT check_name, view_name, column_name, CAST(failures AS BIGINT) AS failures, "
             "CASE WHEN failures > 0 THEN 'fail' ELSE 'pass' END AS status FROM ("
             + " UNION ALL ".join(parts) + ")")
    return sql(final, *(views or [*_NOT_NULL, *_STG]), over=over)


def _not_null_spark(v: Views) -> DataFrame:
    parts = [quality.not_null(getattr(v, view), t["not_null"])
             .select(F.lit(view).alias("view_name"), "column_name", "null_count")
             for view, t in quality.VIEW_TESTS.items()]
    return reduce(DataFrame.unionByName, parts)


register("not_null_counts", sql(" UNION ALL ".join(
    f"SELECT '{view}' AS view_name, '{c}' AS column_name, "
    f"COUNT(*) FILTER (WHERE {c} IS NULL) AS null_count FROM {view}"
    for view, cols in _NOT_NULL.items() for c in cols.split()), *_NOT_NULL))(_not_null_spark)


def _dq_report(v: Views, *views: str, fresh: bool = True) -> DataFrame:
    names = views or tuple(quality.VIEW_TESTS)
    staged = tuple(n for n in _STG if n in names) if v.measured_nulls is not None else ()
    return quality.dq_report({n: getattr(v, n) for n in names},
                             fresh=_freshness(v) if fresh else None,
                             measured=v.measured_nulls, measured_views=staged)


register("dq_report", _dq_sql())(_dq_report)

# B7 on an at-least-once feed derived from the data: ATM transactions are
# delivered twice (replayed segment); the dedupe must return each id once.
register("dedupe_events", sql("""
SELECT DISTINCT * FROM (SELECT * FROM stg_transactions
                        UNION ALL SELECT * FROM stg_transactions WHERE channel = 'atm')""",
    "stg_transactions"))(
    lambda v: staging.dedupe_events(
        v.stg_transactions.unionByName(v.stg_transactions.where(F.col("channel") == "atm")),
        "transaction_id"))


# --- alert emission ---------------------------------------------------------------
def _emit_sql(wide: bool = False) -> str:
    # Fixed values, stated here again so that the oracle has its own copy.
    rules = (
        ("velocity", "high", 0.75, 0.92, "RULE_001"),
        ("geo_anomaly", "critical", 0.85, 0.99, "RULE_002"),
        ("account_takeover", "critical", 0.88, 0.99, "RULE_003"),
        ("card_not_present", "high", 0.75, 0.93, "RULE_004"),
        ("device_fingerprint", "medium", 0.60, 0.82, "RULE_005"),
        ("structuring", "critical", 0.80, 0.97, "RULE_006"))
    sev = " ".join(f"WHEN '{t}' THEN '{s}'" for t, s, _, _, _ in rules)
    lo = " ".join(f"WHEN '{t}' THEN {a}" for t, _, a, _, _ in rules)
    hi = " ".join(f"WHEN '{t}' THEN {b}" for t, _, _, b, _ in rules)
    rule = " ".join(f"WHEN '{t}' THEN '{r}'" for t, _, _, _, r in rules)
    pairs = "(SELECT DISTINCT customer_id, account_id FROM stg_transactions)"
    body = f"""
SELECT 'velocity:' || x.account_id || ':' || x.card_last4 || ':' || epoch_us(x.window_start)
         AS alert_id, p.customer_id, CAST(NULL AS VARCHAR) AS transaction_id,
       'velocity' AS alert_type, x.window_end AS occurred_at
FROM velocity_alerts x JOIN {pairs} p ON x.account_id = p.account_id
UNION ALL
SELECT 'card_not_present:' || x.account_id || ':' || x.card_last4 || ':'
         || epoch_us(x.window_start), p.customer_id, NULL, 'card_not_present', x.window_end
FROM cnp_spike x JOIN {pairs} p ON x.account_id = p.account_id
UNION ALL
SELECT 'structuring:' || account_id || ':' || customer_id || ':' || epoch_us(window_start),
       customer_id, NULL, 'structuring', window_end FROM structuring
UNION ALL
SELECT 'geo_anomaly:' || txn2_id, customer_id, txn2_id, 'geo_anomaly', txn2_time
FROM geo_impossible_trips WHERE is_impossible
UNION ALL
SELECT 'account_takeover:' || transaction_id, customer_id, transaction_id, 'account_takeover',
       occurred_at FROM device_anomalies
UNION ALL
SELECT 'device_fingerprint:' || transaction_id, customer_id, transaction_id,
       'device_fingerprint', occurred_at
FROM stg_transactions WHERE is_odd_hours AND is_high_risk_mcc"""
    final = f"""
SELECT alert_id, customer_id, transaction_id, alert_type,
       CASE alert_type {sev} END AS severity,
       CAST(CASE alert_type {lo} END AS DOUBLE) AS confidence_min,
       CAST(CASE alert_type {hi} END AS DOUBLE) AS confidence_max,
       CASE alert_type {rule} END AS rule_id, occurred_at
FROM ({body})"""
    return sql(final, "velocity_alerts", "cnp_spike", "structuring", "geo_impossible_trips",
               "device_anomalies", "stg_transactions", wide=wide)


def _emit(v: Views) -> DataFrame:
    return alerts.emit_alerts(v.stg_transactions, v.velocity_alerts, v.cnp_spike,
                              v.structuring, v.geo_impossible_trips, v.device_anomalies,
                              customer_accounts(v.stg_transactions))


register("emit_alerts", _emit_sql())(_emit)

# --- sources: JSON messages, a share of them broken -------------------------------
_IDS = {"transactions": "transaction_id", "login_events": "event_id", "card_events": "event_id",
        "alert_events": "alert_id", "kyc_profile_events": "customer_id"}


def _number(stream: str):
    return F.regexp_extract(_IDS[stream], r"(\d+)$", 1).cast("long")


def _messages(v: Views, stream: str) -> DataFrame:
    """The stream as its topic holds it; by event number, some texts are cut
    short, some times are missing or no times."""
    ts, n = schemas.EVENT_TIME[stream], _number(stream)
    raw = v.raw[stream].withColumn("_n", n)
    raw = raw.withColumn(ts, F.when(F.col("_n") % 61 == 0, F.lit(None)).when(
        F.col("_n") % 59 == 0, F.lit("not-a-time")).otherwise(F.col(ts)))
    cols = [f.name for f in schemas.STREAMS[stream]]
    cut = F.when(F.col("_n") % 53 == 0, F.substr("value", F.lit(1), F.length("value") - 5)
                 ).otherwise(F.col("value"))
    return raw.select("_n", F.to_json(F.struct(*cols)).alias("value")).select(cut.alias("value"))


def _parsed(v: Views, stream: str) -> tuple[DataFrame, DataFrame]:
    got = _messages(v, stream).select(events.parse_json(F.col("value"), stream).alias("e"))
    return events.quarantine(got.select("e.*"), stream)


def _dead_letters(v: Views) -> DataFrame:
    bad = [_parsed(v, stream)[1] for stream in _IDS]
    return reduce(DataFrame.unionByName, bad).groupBy("topic", "error").agg(
        F.count(F.lit(1)).alias("n"))


_NR = "CAST(regexp_extract({}, '([0-9]+)$', 1) AS BIGINT)"
for _n, _id in _IDS.items():
    _nr = _NR.format(_id)
    REGISTRY[f"parse_{_n}"] = (
        (lambda n: lambda v: _parsed(v, n)[0])(_n),
        sql(f"SELECT * FROM {_n} WHERE {_nr} % 53 <> 0 AND {_nr} % 59 <> 0 AND {_nr} % 61 <> 0",
            _n))
register("dead_letters", sql("SELECT topic, error, COUNT(*) AS n FROM (" + " UNION ALL ".join(
    f"SELECT '{n}' AS topic, CASE WHEN nr % 53 = 0 THEN 'malformed_json' WHEN nr % 61 = 0 "
    f"THEN 'missing_event_time' WHEN nr % 59 = 0 THEN 'bad_event_time' END AS error "
    f"FROM (SELECT {_NR.format(i)} AS nr FROM {n})" for n, i in _IDS.items())
    + ") WHERE error IS NOT NULL GROUP BY topic, error", *_IDS))(_dead_letters)


# --- the same views over three days ----------------------------------------------
# Here windows, look-backs, the odd-hours flag and slow hops cut something.
WIDE = ["stg_transactions", "velocity_alerts", "cnp_spike", "login_failure_storm", "structuring",
        "correlated_alert_burst", "shared_device_ring", "geo_impossible_trips",
        "known_customer_devices", "device_anomalies", "account_risk_score", "fraud_kpis_1min",
        "merchant_fraud_exposure", "channel_risk_breakdown", "hourly_fraud_trend",
        "open_fraud_cases", "resolved_cases", "recent_high_alerts"]
for _n in WIDE:
    REGISTRY[f"wide_{_n}"] = ((lambda n: lambda v: getattr(v.wide, n))(_n),
                              sql(f"SELECT * FROM {_n}", _n, wide=True))
register("wide_emit_alerts", _emit_sql(wide=True))(lambda v: _emit(v.wide))

# --- data quality of a faulty feed ------------------------------------------------
_FAULTY = {"transactions": """
SELECT CASE WHEN nr % 97 <> 0 THEN transaction_id END AS transaction_id,
       account_id, CASE WHEN nr % 101 <> 0 THEN customer_id END AS customer_id,
       * EXCLUDE (transaction_id, account_id, customer_id, channel, nr, again),
       CASE WHEN nr % 83 = 0 THEN 'carrier_pigeon' ELSE channel END AS channel
FROM (SELECT *, CAST(substr(transaction_id, 5) AS BIGINT) AS nr FROM (""" + oracle.CTES[
    "transactions"][0] + """)), (VALUES (0), (1)) AS c(again)
WHERE again = 0 OR nr % 89 = 0"""}
# Fixed values of these checks, stated for the oracle.
_KEYS = ["transaction_id", "account_id", "customer_id", "occurred_at", "amount"]
_CHANNELS = ["card_not_present", "card_present", "atm"]

register("faulty_not_null", sql(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS null_count "
    f"FROM stg_transactions" for c in _KEYS), "stg_transactions", over=_FAULTY))(
    lambda v: quality.not_null(v.corrupted.stg_transactions, _KEYS))
register("faulty_unique", sql("""
SELECT transaction_id, COUNT(*) AS n FROM stg_transactions WHERE transaction_id IS NOT NULL
GROUP BY transaction_id HAVING COUNT(*) > 1""", "stg_transactions", over=_FAULTY))(
    lambda v: quality.unique_violations(v.corrupted.stg_transactions, "transaction_id"))
register("faulty_accepted_values", sql(
    "SELECT channel, COUNT(*) AS n FROM stg_transactions WHERE channel NOT IN ("
    + ", ".join(f"'{c}'" for c in _CHANNELS) + ") GROUP BY channel",
    "stg_transactions", over=_FAULTY))(
    lambda v: quality.accepted_values(v.corrupted.stg_transactions, "channel", _CHANNELS))
register("faulty_duplicate_count", sql("""
SELECT COUNT(*) AS duplicate_ids FROM (
  SELECT transaction_id FROM stg_transactions WHERE transaction_id IS NOT NULL
  GROUP BY transaction_id HAVING COUNT(*) > 1)""", "stg_transactions", over=_FAULTY))(
    lambda v: quality.duplicate_count(v.corrupted.stg_transactions, "transaction_id"))
register("faulty_dq_report", _dq_sql("stg_transactions", "stg_login_events", over=_FAULTY,
                                     fresh=False))(
    lambda v: _dq_report(v.corrupted, "stg_transactions", "stg_login_events", fresh=False))
# Lost rows: the staged table lacks what the ATM channel published.
register("faulty_reconcile", sql(f"""
SELECT {oracle.bucket('occurred_at', oracle.MIN)} AS window_start, COUNT(*) AS source_count,
       COUNT(*) FILTER (WHERE channel <> 'atm') AS staged_count,
       COUNT(*) FILTER (WHERE channel = 'atm') AS missing
FROM stg_transactions GROUP BY 1""", "stg_transactions"))(
    lambda v: quality.reconcile(v.raw["transactions"], staging.parse_ts("occurred_at"),
                                v.stg_transactions.where(F.col("channel") != "atm"),
                                "occurred_at"))
