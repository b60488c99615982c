"""Micro-batch durations of the streaming signals.

Usage: python tools/stream_bench.py [sf_dir] [batches]
Writes the staged streams of the test data as ``batches`` time-ordered files
each (a fresh ``mktemp`` folder), runs every streaming signal with one file
per micro-batch into its materialized table, and prints one JSON line with
the mean / max micro-batch duration (ms) per signal.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile

from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from riskstream.plans.views import Views  # noqa: E402
from riskstream.session import local_session  # noqa: E402
from riskstream.streaming import materialize as mat  # noqa: E402
from riskstream.streaming import signals as ss  # noqa: E402


def chunked(df, path, n):
    lo, hi = df.select(F.min("occurred_at"), F.max("occurred_at")).first()
    step = (hi - lo) / n
    for i in range(n):
        cond = (F.col("occurred_at") >= lo + step * i) & (
            (F.col("occurred_at") < lo + step * (i + 1)) if i < n - 1 else F.lit(True))
        df.where(cond).coalesce(1).write.mode("append").parquet(path)
    return df.schema


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    n = int(sys.argv[2]) if len(sys.argv) > 2 else 10
    spark = local_session(8)
    root = tempfile.mkdtemp(prefix="rs-stream-bench-")
    v = Views.from_testdata(spark, sf_dir)
    sources = {}
    for name in ("stg_transactions", "stg_login_events", "stg_alert_events"):
        path = os.path.join(root, "src", name)
        schema = chunked(getattr(v, name), path, n)
        sources[name] = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1) \
            .parquet(path)
    src_of = {"correlated_alert_burst": "stg_alert_events"}
    jobs = {}
    for name in ss.WINDOWED:
        sig, keys = ss.windowed_signal(name, sources[src_of.get(name, "stg_transactions")])
        jobs[name] = (sig, keys, mat.day_of("window_start"), "update")
    for name, part in ss.login_failure_storm_streams(sources["stg_login_events"]).items():
        jobs[name] = (part, ["customer_id", "window_start"], mat.day_of("window_start"),
                      "update")
    result = {}
    for name, (df, keys, part, mode) in jobs.items():
        q = mat.materialize(df, os.path.join(root, "views", name), keys, part,
                            os.path.join(root, "ck", name), trigger={"availableNow": True},
                            output_mode=mode)
        q.awaitTermination()
        d = [p["durationMs"]["triggerExecution"] for p in q.recentProgress
             if p.get("numInputRows", 0) > 0]
        result[name] = {"batches": len(d), "mean_ms": round(statistics.mean(d)),
                        "max_ms": max(d)}
    hops = ss.geo_hops_stream(sources["stg_transactions"])
    q = (hops.writeStream.format("parquet").option("path", os.path.join(root, "views", "geo"))
         .option("checkpointLocation", os.path.join(root, "ck", "geo"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    d = [p["durationMs"]["triggerExecution"] for p in q.recentProgress
         if p.get("numInputRows", 0) > 0]
    result["geo_hops"] = {"batches": len(d), "mean_ms": round(statistics.mean(d)),
                          "max_ms": max(d)}
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "micro_batch_ms", "sf": sf, "signals": result}))
    spark.stop()


if __name__ == "__main__":
    main()
