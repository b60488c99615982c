"""Time-relative views in streaming (T24 expiry): recompute per micro-batch.

``NOW()``-relative views (risk score, cases, recent alerts) lose rows as time
passes, which an incremental aggregate cannot retract.  The honest
equivalent is a snapshot: after each micro-batch, recompute them with
``as_of`` = the newest event time seen and overwrite the snapshot tables.
``snapshot_on_batch`` does it from the tables ``streaming.topology``
maintains; ``staged_views`` / ``write_snapshot`` recompute everything from
source-shaped tables (backfills).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from riskstream.plans.views import Views

SNAPSHOT_VIEWS = ("account_risk_score", "open_fraud_cases", "resolved_cases",
                  "recent_high_alerts")


def write_snapshot(views: Views, out_dir: str, names=SNAPSHOT_VIEWS) -> None:
    """Overwrite each snapshot view under ``out_dir/<name>``."""
    for name in names:
        getattr(views, name).write.mode("overwrite").parquet(os.path.join(out_dir, name))


def staged_views(spark: SparkSession, staged_dir: str, **kw) -> Views:
    """Views over materialized source-shaped tables (``staged_dir/<stream>``)."""
    streams = ("transactions", "login_events", "card_events", "alert_events",
               "kyc_profile_events")
    raw = {s: spark.read.parquet(os.path.join(staged_dir, s)) for s in streams}
    return Views(raw, **kw)


def snapshot_on_batch(root: str, device_args: dict | None = None):
    """A ``foreachBatch`` function for a trigger stream (e.g. transactions):
    after every micro-batch, publish a snapshot of the topology at ``root``
    from its maintained tables (``topology.refresh_snapshot``).  The tables only
    grow, so a refresh does not race their writers; one that fails fails the
    query."""
    from riskstream.streaming import topology

    def run(batch: DataFrame, epoch_id: int) -> None:
        topology.refresh_snapshot(batch.sparkSession, root, device_args)
    return run
