"""Serving queries (F1-F17): top-k, latest row, counts and time series.

Top-k and "latest" are ``orderBy(...).limit(n)``, which Spark plans as
TakeOrderedAndProject: every task keeps its own n best rows and only those
reach the final merge, so nothing unbounded is gathered.  Ties are broken on
``account_id`` so the rows at the limit are deterministic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskstream.functions.numeric import round_numeric
from riskstream.functions.time import ago


def signals_text(col: str = "contributing_signals") -> Column:
    """Array rendered as ``{a,b}`` (the text form of a SQL array)."""
    return F.concat(F.lit("{"), F.array_join(F.col(col), ","), F.lit("}"))


def row_counts(views: dict[str, DataFrame], name_col: str = "view_name",
               count_col: str = "row_count") -> DataFrame:
    """``UNION ALL`` of (name, count) per view."""
    parts = [df.agg(F.count(F.lit(1)).alias(count_col))
             .select(F.lit(name).alias(name_col), count_col) for name, df in views.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def critical_accounts(risk: DataFrame, n: int = 20) -> DataFrame:
    """F2: top critical accounts, score rounded to 3."""
    r = risk.where(F.col("risk_tier") == "critical").select(
        "account_id", "customer_id", round_numeric("risk_score", 3).alias("risk_score"),
        "risk_tier", "contributing_signals")
    return r.orderBy(F.col("risk_score").desc(), F.col("account_id").asc()).limit(n)


def top_cases(cases: DataFrame, n: int = 10) -> DataFrame:
    """highest-scored open cases."""
    r = cases.select("customer_id", "account_id",
                     round_numeric("risk_score", 3).alias("risk_score"),
                     "risk_tier", "recommended_action")
    return r.orderBy(F.col("risk_score").desc(), F.col("account_id").asc()).limit(n)


KPI_SUMMARY = ["window_start", "total_transactions", "flagged_transactions", "fraud_rate_pct",
               "critical_risk_accounts", "velocity_breaches", "geo_anomalies",
               "brute_force_attempts", "structuring_flags"]


def latest_kpis(kpis: DataFrame, n: int = 5) -> DataFrame:
    """the ``n`` most recent KPI windows."""
    return kpis.select(*KPI_SUMMARY).orderBy(F.col("window_start").desc()).limit(n)


def latest_kpi_value(kpis: DataFrame, col: str, digits: int | None = None,
                     alias: str | None = None) -> DataFrame:
    """One column of the latest KPI window."""
    c = F.col(col) if digits is None else round_numeric(col, digits)
    return kpis.orderBy(F.col("window_start").desc()).limit(1).select(c.alias(alias or col))


def fraud_rate_line(kpis: DataFrame) -> DataFrame:
    """one-line text summary of the latest window."""
    latest = kpis.orderBy(F.col("window_start").desc()).limit(1)
    return latest.select(F.concat(
        F.lit("Fraud rate: "), F.format_string("%.2f", round_numeric("fraud_rate_pct", 2)),
        F.lit("%  | Total txns: "), F.col("total_transactions").cast("string"),
        F.lit(" | Flagged: "), F.col("flagged_transactions").cast("string")).alias("line"))


def count_where(df: DataFrame, alias: str, cond: Column | None = None) -> DataFrame:
    """``SELECT COUNT(*) ... [WHERE cond]``."""
    if cond is not None:
        df = df.where(cond)
    return df.agg(F.count(F.lit(1)).alias(alias))


def time_series(kpis: DataFrame, columns: dict[str, str], start=None, end=None,
                last: str = "30 minutes") -> DataFrame:
    """KPI columns over [start, end] ordered by time.

    Defaults mirror the dashboard: the last ``last`` before the newest window.
    """
    end_c = F.lit(end).cast("timestamp") if end is not None else \
        kpis.select(F.max("window_start")).scalar()
    start_c = F.lit(start).cast("timestamp") if start is not None else ago(end_c, last)
    rows = kpis.where(F.col("window_start").between(start_c, end_c))
    return rows.select(F.col("window_start").alias("time"),
                       *[F.col(src).alias(dst) for dst, src in columns.items()]) \
        .orderBy("time")


def throughput_series(kpis: DataFrame, **kw) -> DataFrame:
    return time_series(kpis, {"total": "total_transactions",
                              "flagged": "flagged_transactions"}, **kw)


def signal_activity_series(kpis: DataFrame, **kw) -> DataFrame:
    return time_series(kpis, {"velocity": "velocity_breaches", "geo_impossible": "geo_anomalies",
                              "brute_force": "brute_force_attempts",
                              "structuring": "structuring_flags"}, **kw)


def fraud_rate_series(kpis: DataFrame, **kw) -> DataFrame:
    return time_series(kpis, {"fraud_rate_pct": "fraud_rate_pct"}, **kw)


def tier_distribution(risk: DataFrame) -> DataFrame:
    """accounts per tier, largest first."""
    return risk.groupBy("risk_tier").agg(F.count(F.lit(1)).alias("accounts")) \
        .orderBy(F.col("accounts").desc(), F.col("risk_tier"))


def case_table(cases: DataFrame, n: int = 100) -> DataFrame:
    """case list with the signal array as text."""
    r = cases.select("account_id", "customer_id",
                     round_numeric("risk_score", 3).alias("risk_score"), "risk_tier",
                     "kyc_risk_tier", "recommended_action",
                     signals_text().alias("contributing_signals"))
    return r.orderBy(F.col("risk_score").desc(), F.col("account_id").asc()).limit(n)


def high_risk_accounts(risk: DataFrame, n: int = 50) -> DataFrame:
    """top high/critical accounts."""
    r = risk.where(F.col("risk_tier").isin("high", "critical")).select(
        "account_id", "customer_id", round_numeric("risk_score", 3).alias("risk_score"),
        "risk_tier", signals_text().alias("contributing_signals"))
    return r.orderBy(F.col("risk_score").desc(), F.col("account_id").asc()).limit(n)
