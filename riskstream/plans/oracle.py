"""DuckDB SQL for every registered query (the cross-engine oracle).

not generated from the Spark code and in another shape: the score is one long
table of (account, signal) evidence weighed by a list of fixed values, the
KPIs are one pivoted list of (minute, metric, amount), hops pair row numbers.
``sql(final, *views)`` assembles the CTEs a query needs in dependency order, on
the narrow timeline or, with ``wide=True``, on the wide one (three days).

Conventions shared with the Spark side (see ``plans/output.py``): instants as
TIMESTAMP, NUMERIC rounding through DECIMAL(38,10), arrays as ``{a,b}`` text.
"""

from __future__ import annotations

import re

from riskstream.sources.bridge import COMPRESSION, T0_MICROS, WIDE_COMPRESSION


def bucket(ts: str, micros: int) -> str:
    """Epoch-aligned tumbling window start."""
    return f"make_timestamp((epoch_us({ts}) // {micros}) * {micros})"


def rnd(x: str, n: int) -> str:
    return f"CAST(ROUND(CAST({x} AS DECIMAL(38,10)), {n}) AS DOUBLE)"


def pct(part: str, whole: str) -> str:
    return f"CASE WHEN {whole} > 0 THEN CAST({part} AS DOUBLE) / {whole} * 100 ELSE 0 END"


SEC, MIN, HOUR = 1_000_000, 60_000_000, 3_600_000_000
ISO = "'%Y-%m-%dT%H:%M:%S.%fZ'"


def _iso(ts: str) -> str:
    return f"strftime({ts}, {ISO})"


def _parse(s: str) -> str:
    return f"try_strptime({s}, {ISO})"


CTES: dict[str, tuple[str, list[str]]] = {}


def cte(name: str, body: str, deps: list[str] | None = None) -> None:
    CTES[name] = (body, deps or [])


# --- bridge ---------------------------------------------------------------
cte("ev0", f"""
SELECT event_id, user_id, event_type, value,
       CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       make_timestamp({T0_MICROS} + (epoch_us(ts) - {T0_MICROS}) // @COMPRESSION@) AS t
FROM events""")

cte("ev", f"""
SELECT event_id, user_id, event_type, value, k,
       {_iso('t')} AS occurred_at,
       'cust-' || user_id AS customer_id,
       'acc-' || user_id || '-' || (event_id % 2) AS account_id,
       CASE WHEN k = 7 THEN NULL WHEN k >= 95 THEN 'new-' || event_id
            WHEN k % 20 = 0 THEN 'shared-' || k
            ELSE 'dev-' || user_id || '-' || (k % 3) END AS device_id,
       '10.0.' || (user_id % 256) || '.' || (k % 8) AS ip_address,
       CASE WHEN k = 50 THEN 51.5074 ELSE -33.8688 END::DOUBLE AS latitude,
       CASE WHEN k = 50 THEN -0.1278 ELSE 151.2093 END::DOUBLE AS longitude,
       CASE WHEN k = 50 THEN 'GB' ELSE 'AU' END AS country_code,
       lpad(CAST((user_id * 2 + event_id % 2) % 10000 AS VARCHAR), 4, '0') AS card_last4
FROM ev0""", ["ev0"])

cte("transactions", """
SELECT 'txn-' || event_id AS transaction_id, account_id, customer_id,
       CAST(CAST(value AS DECIMAL(12,2)) * 100
            + CAST(event_id % 100 AS DECIMAL(12,2)) * 0.01 AS DOUBLE) AS amount,
       'AUD' AS currency,
       'mer-' || (k % 25) AS merchant_id,
       CASE k % 10 WHEN 0 THEN '6011' WHEN 1 THEN '7995' WHEN 2 THEN '6051' ELSE '5411' END
         AS merchant_category_code,
       'Merchant ' || (k % 25) AS merchant_name,
       CASE WHEN k % 4 <= 1 THEN 'card_not_present' WHEN k % 4 = 2 THEN 'card_present'
            ELSE 'atm' END AS channel,
       card_last4, device_id, ip_address, latitude, longitude, country_code, occurred_at,
       CASE event_type WHEN 'error' THEN 'declined' WHEN 'purchase' THEN 'approved'
            ELSE 'pending' END AS status
FROM ev""", ["ev"])

cte("login_events", """
SELECT 'login-' || event_id AS event_id, customer_id, device_id, ip_address, country_code,
       latitude, longitude, 'bridge/1.0' AS user_agent, event_type <> 'error' AS success,
       CASE WHEN event_type = 'error' THEN
         CASE k % 4 WHEN 0 THEN 'wrong_password' WHEN 1 THEN 'account_locked'
                    WHEN 2 THEN '2fa_failed' ELSE 'session_expired' END END AS failure_reason,
       occurred_at
FROM ev WHERE event_type IN ('error', 'click')""", ["ev"])

cte("card_events", """
SELECT 'card-' || event_id AS event_id, account_id, customer_id, card_last4,
       CASE k % 5 WHEN 0 THEN 'block' WHEN 1 THEN 'unblock' WHEN 2 THEN 'reissue'
                  WHEN 3 THEN 'pin_change' ELSE 'limit_change' END AS event_type,
       CASE k % 3 WHEN 0 THEN 'customer' WHEN 1 THEN 'bank' ELSE 'fraud_system' END
         AS initiated_by,
       occurred_at
FROM ev WHERE event_type = 'purchase'""", ["ev"])

cte("alert_events", """
SELECT 'alt-' || event_id AS alert_id, customer_id, 'txn-' || event_id AS transaction_id,
       ['velocity', 'geo_anomaly', 'account_takeover', 'card_not_present', 'device_fingerprint',
        'structuring'][k % 6 + 1] AS alert_type,
       CASE k % 5 WHEN 0 THEN 'low' WHEN 1 THEN 'medium' WHEN 2 THEN 'high'
                  WHEN 3 THEN 'critical' END AS severity,
       (k + 50) / 100.0 AS confidence_score,
       'RULE_00' || (k % 6 + 1) AS rule_id, occurred_at
FROM ev WHERE event_type IN ('signup', 'view')""", ["ev"])

cte("kyc_profile_events", f"""
WITH c AS (
  SELECT 'cust-' || c_custkey AS customer_id, c_nationkey, c_acctbal,
         CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'low' WHEN 'BUILDING' THEN 'medium'
              WHEN 'FURNITURE' THEN 'high' WHEN 'HOUSEHOLD' THEN 'pep'
              WHEN 'MACHINERY' THEN 'sanctioned' END AS tier,
         CASE c_nationkey % 3 WHEN 0 THEN 'personal' WHEN 1 THEN 'business' ELSE 'joint' END
           AS account_type
  FROM customer)
SELECT customer_id, tier AS risk_tier, 'pending' AS kyc_status, account_type,
       'AU' AS country_of_residence, {_iso(f'make_timestamp({T0_MICROS})')} AS updated_at
FROM c
UNION ALL
SELECT customer_id, CASE WHEN tier IN ('low', 'medium') THEN 'high' ELSE tier END,
       'verified', account_type, 'AU',
       {_iso(f'make_timestamp({T0_MICROS} + (c_nationkey + 1) * {MIN})')}
FROM c WHERE c_acctbal >= 5000""")

# --- staging ----------------------------------------------------------------
cte("stg_transactions", f"""
SELECT transaction_id, account_id, customer_id, amount, currency, merchant_id,
       merchant_category_code, merchant_name, channel, card_last4, device_id, ip_address,
       latitude, longitude, country_code, {_parse('occurred_at')} AS occurred_at, status,
       CAST(EXTRACT(hour FROM {_parse('occurred_at')}) AS INTEGER) AS txn_hour,
       EXTRACT(hour FROM {_parse('occurred_at')}) BETWEEN 2 AND 4 AS is_odd_hours,
       channel = 'card_not_present' AS is_cnp,
       merchant_category_code IN ('6011', '7995', '6051') AS is_high_risk_mcc
FROM transactions""", ["transactions"])

cte("stg_login_events", f"""
SELECT event_id, customer_id, device_id, ip_address, country_code, latitude, longitude,
       user_agent, success, failure_reason, {_parse('occurred_at')} AS occurred_at
FROM login_events""", ["login_events"])

cte("stg_card_events", f"""
SELECT event_id, account_id, customer_id, card_last4, event_type, initiated_by,
       {_parse('occurred_at')} AS occurred_at
FROM card_events""", ["card_events"])

cte("stg_alert_events", f"""
SELECT alert_id, customer_id, transaction_id, alert_type, severity, confidence_score, rule_id,
       {_parse('occurred_at')} AS occurred_at,
       CASE severity WHEN 'critical' THEN 4 WHEN 'high' THEN 3 WHEN 'medium' THEN 2 ELSE 1 END
         AS severity_weight
FROM alert_events""", ["alert_events"])

cte("stg_kyc_profiles", f"""
SELECT customer_id, risk_tier, kyc_status, account_type, country_of_residence,
       {_parse('updated_at')} AS updated_at
FROM kyc_profile_events""", ["kyc_profile_events"])

cte("latest_kyc", """
SELECT customer_id, risk_tier, kyc_status, account_type, country_of_residence, updated_at
FROM (SELECT *, row_number() OVER (PARTITION BY customer_id
        ORDER BY updated_at DESC, risk_tier DESC, kyc_status DESC, account_type DESC,
                 country_of_residence DESC) AS rn
      FROM stg_kyc_profiles) WHERE rn = 1""", ["stg_kyc_profiles"])


# --- signals ----------------------------------------------------------------
def _tumble(src: str, keys: str, micros: int, measures: str, having: str, flag: str,
            where: str = "TRUE") -> str:
    return f"""
SELECT {keys}, window_start, window_start + INTERVAL ({micros}) MICROSECOND AS window_end,
       {measures}, {having} AS {flag}
FROM (SELECT *, {bucket('occurred_at', micros)} AS window_start FROM {src} WHERE {where}) s
WHERE occurred_at IS NOT NULL
GROUP BY {keys}, window_start
HAVING {having}"""


cte("velocity_alerts", _tumble(
    "stg_transactions", "account_id, card_last4", SEC * 60,
    "COUNT(*) AS txn_count, @MONEY@ AS total_amount", "COUNT(*) >= 5",
    "is_velocity_breach"), ["stg_transactions"])
cte("cnp_spike", _tumble(
    "stg_transactions", "card_last4, account_id", MIN * 5,
    "COUNT(*) AS cnp_count, @MONEY@ AS total_amount", "COUNT(*) >= 8", "is_cnp_spike",
    "is_cnp = TRUE"), ["stg_transactions"])
cte("login_failure_storm", _tumble(
    "stg_login_events", "customer_id", SEC * 60,
    "COUNT(*) AS failure_count, COUNT(DISTINCT ip_address) AS distinct_ips, "
    "COUNT(DISTINCT device_id) AS distinct_devices, MIN(occurred_at) AS first_failure_at, "
    "MAX(occurred_at) AS last_failure_at", "COUNT(*) >= 3", "is_brute_force",
    "success = FALSE"), ["stg_login_events"])
cte("structuring", _tumble(
    "stg_transactions", "account_id, customer_id", MIN * 60,
    "COUNT(*) AS qualifying_txn_count, @MONEY@ AS total_amount", "COUNT(*) >= 2",
    "is_structuring_pattern", "amount BETWEEN 9000 AND 9999"), ["stg_transactions"])
cte("correlated_alert_burst", _tumble(
    "stg_alert_events", "customer_id", MIN * 5,
    "COUNT(DISTINCT alert_type) AS alert_type_count, "
    "MAX(confidence_score) AS max_confidence_score",
    "COUNT(DISTINCT alert_type) >= 2", "is_compound_fraud"), ["stg_alert_events"])
cte("shared_device_ring", _tumble(
    "stg_transactions", "device_id", MIN * 60,
    "COUNT(DISTINCT customer_id) AS customer_count", "COUNT(DISTINCT customer_id) >= 2",
    "is_shared_device_ring"), ["stg_transactions"])

cte("known_customer_devices", """
SELECT customer_id, device_id, MIN(occurred_at) AS first_seen_at,
       MAX(occurred_at) AS last_seen_at
FROM stg_transactions GROUP BY customer_id, device_id""", ["stg_transactions"])

# Consecutive transactions of a customer, paired by their numbers.
cte("geo_impossible_trips", f"""
WITH numbered AS (
  SELECT customer_id, transaction_id AS id, country_code AS country, latitude AS lat,
         longitude AS lon, occurred_at AS at,
         row_number() OVER (PARTITION BY customer_id ORDER BY occurred_at NULLS LAST,
                            transaction_id NULLS FIRST) AS nr
  FROM stg_transactions),
hop AS (
  SELECT later.customer_id, earlier.id AS id1, earlier.country AS country1,
         earlier.lat AS lat1, earlier.lon AS lon1, earlier.at AS at1, later.id AS id2,
         later.country AS country2, later.lat AS lat2, later.lon AS lon2, later.at AS at2,
         111.0 * sqrt((later.lat - earlier.lat) ** 2
                      + ((later.lon - earlier.lon)
                         * cos(radians((earlier.lat + later.lat) / 2))) ** 2) AS dist,
         (epoch_us(later.at) - epoch_us(earlier.at)) / 60000000.0 AS mins
  FROM numbered AS later JOIN numbered AS earlier
    ON later.nr = earlier.nr + 1 AND later.customer_id IS NOT DISTINCT FROM earlier.customer_id
  WHERE earlier.id IS NOT NULL)
SELECT customer_id, id1 AS txn1_id, country1 AS txn1_country, lat1 AS txn1_lat,
       lon1 AS txn1_lon, at1 AS txn1_time, id2 AS txn2_id, country2 AS txn2_country,
       lat2 AS txn2_lat, lon2 AS txn2_lon, at2 AS txn2_time,
       {rnd('dist', 2)} AS approx_distance_km, {rnd('mins', 2)} AS time_diff_minutes,
       dist > 1000 AND mins > 0 AND mins < 120 AS is_impossible
FROM hop WHERE dist > 500""", ["stg_transactions"])

AS_OF = "(SELECT max(occurred_at) FROM stg_transactions)"

# Narrow timeline: recent 1 minute, history [as_of - 30 minutes, as_of - 1 minute);
# wide timeline: the default arguments.
cte("device_anomalies", f"""
SELECT customer_id, transaction_id, device_id, amount, occurred_at,
       TRUE AS is_new_device_candidate, TRUE AS is_high_value, TRUE AS combined_risk_flag
FROM stg_transactions AS now
WHERE channel = 'card_not_present' AND amount > 500
  AND occurred_at >= {AS_OF} - INTERVAL '@RECENT@'
  AND NOT EXISTS (
    FROM stg_transactions AS old
    WHERE old.device_id = now.device_id AND old.customer_id = now.customer_id
      AND old.occurred_at >= {AS_OF} - INTERVAL '@FROM@'
      AND old.occurred_at < {AS_OF} - INTERVAL '@UNTIL@')""", ["stg_transactions"])

# --- risk -------------------------------------------------------------------
# Order number, signal, weight, minutes of look-back.
cte("signal_list", """
SELECT * FROM (VALUES (1, 'velocity', 0.25, 10), (2, 'geo_impossible', 0.30, 30),
  (3, 'device_anomaly', 0.20, 10), (4, 'cnp_spike', 0.15, 5), (5, 'brute_force', 0.35, 5),
  (6, 'structuring', 0.40, 60), (7, 'compound_fraud', 0.20, 10)) AS v(nr, signal, weight, mins)""")
# One row per piece of evidence; a NULL customer means any customer of the account.
cte("evidence", """
SELECT 1 AS nr, account_id, NULL AS customer_id, window_end AS at
FROM velocity_alerts WHERE is_velocity_breach
UNION ALL
SELECT 2, account_id, NULL, occurred_at
FROM stg_transactions SEMI JOIN geo_impossible_trips ON transaction_id = txn2_id AND is_impossible
UNION ALL
SELECT 3, account_id, NULL, occurred_at
FROM stg_transactions SEMI JOIN device_anomalies USING (transaction_id)
UNION ALL
SELECT 4, account_id, NULL, window_end FROM cnp_spike WHERE is_cnp_spike
UNION ALL
SELECT 5, account_id, customer_id, window_end
FROM login_failure_storm JOIN stg_transactions USING (customer_id) WHERE is_brute_force
UNION ALL
SELECT 6, account_id, NULL, window_end FROM structuring WHERE is_structuring_pattern
UNION ALL
SELECT 7, account_id, NULL, window_end
FROM correlated_alert_burst JOIN stg_transactions USING (customer_id) WHERE is_compound_fraud""",
    ["velocity_alerts", "geo_impossible_trips", "device_anomalies", "cnp_spike",
     "login_failure_storm", "structuring", "correlated_alert_burst", "stg_transactions"])
cte("account_risk_score", f"""
WITH active AS (
  SELECT account_id, customer_id FROM stg_transactions GROUP BY ALL
  HAVING max(occurred_at) >= {AS_OF} - INTERVAL 60 MINUTE),
found AS (
  SELECT DISTINCT active.account_id, active.customer_id, nr, signal, weight
  FROM active JOIN evidence ON evidence.account_id = active.account_id
       AND coalesce(evidence.customer_id, active.customer_id) = active.customer_id
  JOIN signal_list USING (nr)
  WHERE evidence.at >= {AS_OF} - to_minutes(signal_list.mins)),
total AS (
  SELECT account_id, customer_id,
         least(1.0, 0.1 + coalesce(sum(weight), 0))::DOUBLE AS risk_score,
         '{{' || coalesce(string_agg(signal, ',' ORDER BY nr), '') || '}}' AS contributing_signals
  FROM active LEFT JOIN found USING (account_id, customer_id) GROUP BY ALL)
SELECT total.*, CASE WHEN risk_score > 0.8 THEN 'critical' WHEN risk_score > 0.5 THEN 'high'
                     WHEN risk_score > 0.3 THEN 'medium' ELSE 'low' END AS risk_tier
FROM total""", ["evidence", "signal_list", "stg_transactions"])

# One list of (minute, metric, amount), pivoted; minutes without transactions go.
cte("fraud_kpis_1min", f"""
WITH metric AS (
  SELECT {bucket('occurred_at', MIN)} AS minute, 'tx' AS what, 1 AS n,
         CAST(amount AS DECIMAL(28,6)) AS x
  FROM stg_transactions
  UNION ALL SELECT {bucket('occurred_at', MIN)}, 'mcc', 1, 0 FROM stg_transactions
            WHERE is_high_risk_mcc
  UNION ALL SELECT window_start, 'velocity', 1, 0 FROM velocity_alerts
  UNION ALL SELECT {bucket('txn2_time', MIN)}, 'geo', 1, 0 FROM geo_impossible_trips
            WHERE is_impossible
  UNION ALL SELECT window_start, 'storm', 1, 0 FROM login_failure_storm
  UNION ALL SELECT window_start, 'struct', 1, 0 FROM structuring
  UNION ALL SELECT {bucket('occurred_at', MIN)}, 'alert', 1, CAST(confidence_score AS DECIMAL(28,6))
            FROM stg_alert_events WHERE confidence_score IS NOT NULL),
wide AS (
  SELECT minute, count(*) FILTER (what = 'tx') AS tx, count(*) FILTER (what = 'mcc') AS mcc,
         sum(x) FILTER (what = 'tx') AS worth, count(*) FILTER (what = 'velocity') AS vel,
         count(*) FILTER (what = 'geo') AS geo, count(*) FILTER (what = 'storm') AS storm,
         count(*) FILTER (what = 'struct') AS struct,
         CAST(sum(x) FILTER (what = 'alert') AS DOUBLE)
           / nullif(count(*) FILTER (what = 'alert'), 0) AS conf
  FROM metric WHERE minute IS NOT NULL GROUP BY minute)
SELECT minute AS window_start, minute + INTERVAL 1 MINUTE AS window_end,
       tx AS total_transactions, mcc AS flagged_transactions, 0 AS critical_risk_accounts,
       {rnd('worth', 2)} AS total_transaction_value, {rnd(pct('mcc', 'tx'), 2)} AS fraud_rate_pct,
       vel AS velocity_breaches, geo AS geo_anomalies, storm AS brute_force_attempts,
       struct AS structuring_flags, {rnd('coalesce(conf, 0)', 4)} AS avg_alert_confidence
FROM wide WHERE tx > 0""",
    ["stg_transactions", "velocity_alerts", "geo_impossible_trips", "login_failure_storm",
     "structuring", "stg_alert_events"])

_HR = "COUNT(*) FILTER (WHERE is_high_risk_mcc)"
cte("merchant_fraud_exposure", f"""
SELECT merchant_id, merchant_name, merchant_category_code, window_start,
       COUNT(*) AS total_txns, {_HR} AS flagged_txns,
       {rnd(pct(_HR, 'COUNT(*)'), 2)} AS fraud_exposure_pct,
       {rnd('@MONEY@', 2)} AS total_value,
       {rnd('@MONEY@ FILTER (WHERE is_high_risk_mcc)', 2)} AS flagged_value
FROM (SELECT *, {bucket('occurred_at', HOUR)} AS window_start FROM stg_transactions
      WHERE occurred_at IS NOT NULL)
GROUP BY merchant_id, merchant_name, merchant_category_code, window_start
HAVING COUNT(*) >= 2""", ["stg_transactions"])

cte("channel_risk_breakdown", f"""
SELECT channel, window_start, COUNT(*) AS txn_count, {_HR} AS flagged_count,
       {rnd('@MONEY@', 2)} AS total_value,
       {rnd('@MONEY@ FILTER (WHERE is_high_risk_mcc)', 2)} AS flagged_value,
       {rnd(pct(_HR, 'COUNT(*)'), 2)} AS fraud_rate_pct,
       {rnd('CAST(@MONEY@ AS DOUBLE) / COUNT(amount)', 2)} AS avg_amount
FROM (SELECT *, {bucket('occurred_at', HOUR)} AS window_start FROM stg_transactions
      WHERE occurred_at IS NOT NULL)
GROUP BY channel, window_start""", ["stg_transactions"])

cte("hourly_fraud_trend", f"""
SELECT window_start AS hour_bucket, COUNT(*) AS total_txns, {_HR} AS fraud_flags,
       {rnd(pct(_HR, 'COUNT(*)'), 2)} AS fraud_rate_pct, {rnd('@MONEY@', 2)} AS total_value
FROM (SELECT *, {bucket('occurred_at', HOUR)} AS window_start FROM stg_transactions
      WHERE occurred_at IS NOT NULL)
GROUP BY window_start""", ["stg_transactions"])

# --- cases ------------------------------------------------------------------
cte("open_fraud_cases", """
WITH told AS (
  SELECT score.*, latest_kyc.risk_tier AS kyc,
         ',' || trim(contributing_signals, '{}') || ',' AS names
  FROM account_risk_score AS score LEFT JOIN latest_kyc USING (customer_id)
  WHERE score.risk_tier <> 'low' AND score.risk_tier <> 'medium'),
step AS (
  SELECT *, coalesce(
    CASE WHEN kyc = 'pep' OR kyc = 'sanctioned' OR risk_score > 0.9 THEN 1 END,
    CASE WHEN names LIKE '%,structuring,%' AND risk_score > 0.75 THEN 2 END,
    CASE WHEN names SIMILAR TO '.*,(velocity|cnp_spike),.*' AND risk_score > 0.6 THEN 3 END, 4)
    AS nr FROM told)
SELECT account_id, customer_id, risk_score, risk_tier, contributing_signals,
       coalesce(kyc, 'unknown') AS kyc_risk_tier,
       ['escalate', 'freeze_account', 'block_card', 'monitor'][nr] AS recommended_action
FROM step""", ["account_risk_score", "latest_kyc"])

cte("resolved_cases", """
SELECT account_id, customer_id, risk_score AS current_risk_score
FROM account_risk_score WHERE risk_score < 0.3""", ["account_risk_score"])

# Grave alerts of the half hour up to the newest alert; what is known of the
# customer is looked up per alert.
cte("recent_high_alerts", f"""
WITH grave AS (
  SELECT *, max(epoch_us(occurred_at)) OVER () AS newest_us FROM stg_alert_events),
kept AS (
  SELECT * FROM grave SEMI JOIN (VALUES ('critical'), ('high')) AS level(severity) USING (severity)
  WHERE newest_us - epoch_us(occurred_at) <= 30 * 60 * 1000000),
told AS (
  SELECT kept.*, (SELECT max([coalesce(risk_tier, 'unknown'), coalesce(kyc_status, 'unknown')])
                  FROM latest_kyc AS known WHERE known.customer_id = kept.customer_id) AS known
  FROM kept)
SELECT alert_id, customer_id, transaction_id, alert_type, severity, rule_id, occurred_at,
       {rnd('confidence_score', 4)} AS confidence_score,
       coalesce(known[1], 'unknown') AS customer_kyc_tier,
       coalesce(known[2], 'unknown') AS kyc_status
FROM told""", ["stg_alert_events", "latest_kyc"])


def _order(names: list[str]) -> list[str]:
    seen: list[str] = []

    def visit(n: str) -> None:
        if n in seen:
            return
        for d in CTES[n][1]:
            visit(d)
        seen.append(n)

    for n in names:
        visit(n)
    return seen


TIMELINES = {
    False: {"@COMPRESSION@": str(COMPRESSION), "@RECENT@": "1 minute", "@FROM@": "30 minutes",
            "@UNTIL@": "1 minute"},
    True: {"@COMPRESSION@": str(WIDE_COMPRESSION), "@RECENT@": "10 minutes", "@FROM@": "30 days",
           "@UNTIL@": "24 hours"},
}


def sql(final: str, *views: str, wide: bool = False, over: dict[str, str] | None = None) -> str:
    """``WITH <needed CTEs> <final>``; ``over`` replaces bodies of CTEs."""
    bodies = {n: (over or {}).get(n, CTES[n][0]).strip() for n in _order(list(views))}
    out = "WITH " + ",\n".join(f"{n} AS ({b})" for n, b in bodies.items()) + "\n" + final
    out = re.sub(r"@MONEY@( FILTER \([^)]*\))?",
                 lambda m: f"CAST(SUM(CAST(amount AS DECIMAL(28,6))){m[1] or ''} AS DOUBLE)", out)
    for token, value in TIMELINES[wide].items():
        out = out.replace(token, value)
    return out
