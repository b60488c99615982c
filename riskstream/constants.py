"""Fixed values.

Everything in this module must equal the values of the system we reproduce,
otherwise scores, tiers, flags and actions change.  They are stated here once,
plainly and in their natural order, and imported everywhere else.
"""

from __future__ import annotations

from decimal import Decimal

# --- fixed values: staging -------------------------------------------------
# Merchant category codes treated as high risk.
HIGH_RISK_MCC = ("6011", "7995", "6051")
# Channel value that marks a card-not-present transaction.
CNP_CHANNEL = "card_not_present"
# Odd hours, inclusive, UTC hour of day.
ODD_HOURS = (2, 4)
# Alert severity -> numeric weight; anything else (including NULL) is 1.
SEVERITY_WEIGHTS = (("critical", 4), ("high", 3), ("medium", 2))
DEFAULT_SEVERITY_WEIGHT = 1

# --- fixed values: signal thresholds and windows ---------------------------
VELOCITY_WINDOW, VELOCITY_MIN_TXNS = "60 seconds", 5
CNP_WINDOW, CNP_MIN_TXNS = "5 minutes", 8
STORM_WINDOW, STORM_MIN_FAILURES = "60 seconds", 3
STRUCTURING_WINDOW, STRUCTURING_LOW, STRUCTURING_HIGH, STRUCTURING_MIN_TXNS = (
    "60 minutes", 9000, 9999, 2)
BURST_WINDOW, BURST_MIN_TYPES = "5 minutes", 2
RING_WINDOW, RING_MIN_CUSTOMERS = "60 minutes", 2
GEO_MIN_KM, GEO_FLAG_KM, GEO_MAX_MINUTES = 500, 1000, 120
KM_PER_DEGREE = 111.0
DEVICE_MIN_AMOUNT = 500
DEVICE_RECENT, DEVICE_HISTORY_FROM, DEVICE_HISTORY_UNTIL = (
    "10 minutes", "30 days", "24 hours")

# --- fixed values: risk score ----------------------------------------------
# Base score and additive weights, in the order the signals are listed in
# ``contributing_signals``.  Decimal on purpose: 0.1 + 0.2 must be exactly 0.3.
BASE_SCORE = Decimal("0.1")
SIGNAL_WEIGHTS = (
    ("velocity", Decimal("0.25")),
    ("geo_impossible", Decimal("0.30")),
    ("device_anomaly", Decimal("0.20")),
    ("cnp_spike", Decimal("0.15")),
    ("brute_force", Decimal("0.35")),
    ("structuring", Decimal("0.40")),
    ("compound_fraud", Decimal("0.20")),
)
# Look-back per signal used by the score, relative to ``as_of``.
SCORE_LOOKBACK = (
    ("velocity", "10 minutes"),
    ("geo_impossible", "30 minutes"),
    ("device_anomaly", "10 minutes"),
    ("cnp_spike", "5 minutes"),
    ("brute_force", "5 minutes"),
    ("structuring", "60 minutes"),
    ("compound_fraud", "10 minutes"),
)
ACTIVE_ACCOUNT_LOOKBACK = "60 minutes"
SCORE_CAP = Decimal("1.0")
# Tier thresholds, strict ``>``, checked from the top.
TIERS = (("critical", 0.8), ("high", 0.5), ("medium", 0.3))
LOWEST_TIER = "low"
RISK_TIERS = ("low", "medium", "high", "critical")

# --- fixed values: case management -----------------------------------------
CASE_TIERS = ("high", "critical")
ESCALATE_SCORE = 0.9
ESCALATE_KYC_TIERS = ("pep", "sanctioned")
FREEZE_SCORE = 0.75
BLOCK_SCORE = 0.6
ACTIONS = ("escalate", "freeze_account", "block_card", "monitor")
RESOLVED_BELOW = 0.3
HIGH_ALERT_SEVERITIES = ("high", "critical")
HIGH_ALERT_LOOKBACK = "30 minutes"
UNKNOWN = "unknown"

# --- fixed values: data quality ----------------------------------------------
FRESHNESS_MAX_SECONDS = 180
STALE_AFTER_SECONDS = 120

# --- fixed values: alert emission --------------------------------------------
# Alert type -> (severity, confidence low, confidence high, rule id).
ALERT_RULES = (
    ("velocity", "high", 0.75, 0.92, "RULE_001"),
    ("geo_anomaly", "critical", 0.85, 0.99, "RULE_002"),
    ("account_takeover", "critical", 0.88, 0.99, "RULE_003"),
    ("card_not_present", "high", 0.75, 0.93, "RULE_004"),
    ("device_fingerprint", "medium", 0.60, 0.82, "RULE_005"),
    ("structuring", "critical", 0.80, 0.97, "RULE_006"),
)
