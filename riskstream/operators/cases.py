"""Case management."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskstream.constants import (
    BLOCK_SCORE,
    CASE_TIERS,
    ESCALATE_KYC_TIERS,
    ESCALATE_SCORE,
    FREEZE_SCORE,
    HIGH_ALERT_LOOKBACK,
    HIGH_ALERT_SEVERITIES,
    RESOLVED_BELOW,
    UNKNOWN,
)
from riskstream.functions.numeric import round_numeric
from riskstream.functions.time import ago, as_of_column, since


def recommended_action(score, signals, kyc_tier):
    """First matching rule wins: escalate, freeze_account, block_card, monitor."""
    has = lambda name: F.array_contains(signals, name)
    return (F.when((score > ESCALATE_SCORE)
                   | F.coalesce(kyc_tier, F.lit("")).isin(*ESCALATE_KYC_TIERS), "escalate")
            .when((score > FREEZE_SCORE) & has("structuring"), "freeze_account")
            .when((score > BLOCK_SCORE) & (has("velocity") | has("cnp_spike")), "block_card")
            .otherwise("monitor"))


def open_fraud_cases(risk: DataFrame, latest_kyc: DataFrame) -> DataFrame:
    """high/critical accounts with KYC tier and a recommended action.

    The KYC side is one row per customer; AQE broadcasts it when its measured
    size allows, otherwise both sides are shuffled on ``customer_id``.
    """
    cases = risk.where(F.col("risk_tier").isin(*CASE_TIERS))
    k = latest_kyc.select("customer_id", F.col("risk_tier").alias("_kyc_tier"))
    j = cases.join(k, "customer_id", "left")
    return j.select(
        "account_id", "customer_id", "risk_score", "risk_tier", "contributing_signals",
        F.coalesce("_kyc_tier", F.lit(UNKNOWN)).alias("kyc_risk_tier"),
        recommended_action(F.col("risk_score"), F.col("contributing_signals"),
                           F.col("_kyc_tier")).alias("recommended_action"))


def resolved_cases(risk: DataFrame, below: float = RESOLVED_BELOW) -> DataFrame:
    """Accounts whose score is back under ``below`` (strict)."""
    return risk.where(F.col("risk_score") < below).select(
        "account_id", "customer_id", F.col("risk_score").alias("current_risk_score"))


def recent_high_alerts(stg_alerts: DataFrame, latest_kyc: DataFrame, as_of=None,
                       lookback: str = HIGH_ALERT_LOOKBACK) -> DataFrame:
    """high/critical alerts of the last ``lookback`` with the customer's KYC."""
    now = as_of_column(stg_alerts, "occurred_at", as_of)
    a = since(stg_alerts, "occurred_at", ago(now, lookback)).where(
        F.col("severity").isin(*HIGH_ALERT_SEVERITIES))
    k = latest_kyc.select("customer_id", F.col("risk_tier").alias("_tier"),
                          F.col("kyc_status").alias("_status"))
    j = a.join(k, "customer_id", "left")
    return j.select(
        "alert_id", "customer_id", "transaction_id", "alert_type", "severity", "rule_id",
        "occurred_at", round_numeric("confidence_score", 4).alias("confidence_score"),
        F.coalesce("_tier", F.lit(UNKNOWN)).alias("customer_kyc_tier"),
        F.coalesce("_status", F.lit(UNKNOWN)).alias("kyc_status"))
