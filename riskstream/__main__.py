"""Command line: batch snapshot of every view, or the streaming topology.

  python -m riskstream batch  --source transactions=PATH ... --out DIR [--format json]
  python -m riskstream stream --source transactions=PATH ... --root DIR [--format json] [--once]
  python -m riskstream stream --brokers HOST:PORT --root DIR [--kafka kafka.NAME=VALUE ...]

Sources are the five topics as files (JSON lines by default) or, with
``--brokers``, Kafka topics read from the earliest offset.  ``batch`` writes
every view as Parquet under ``--out``; ``stream`` starts one streaming query per
maintained table under ``--root`` and publishes the NOW()-relative snapshot
after every transaction micro-batch.  Unreadable rows go to ``dead_letters``.
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import SparkSession

from riskstream import schemas
from riskstream.plans.views import Views
from riskstream.session import cluster_settings, configure


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="riskstream")
    ap.add_argument("mode", choices=["batch", "stream"])
    ap.add_argument("--source", action="append", default=[], help="stream=path")
    ap.add_argument("--format", default="json")
    ap.add_argument("--brokers", help="Kafka bootstrap servers")
    ap.add_argument("--kafka", action="append", default=[], help="kafka.NAME=VALUE client setting")
    ap.add_argument("--out", help="batch output folder")
    ap.add_argument("--root", help="streaming tables folder")
    ap.add_argument("--as-of", default=None, help="batch NOW() (default: newest event)")
    ap.add_argument("--input-tb", type=float, default=None,
                    help="input size in TB: sizes shuffle partitions and scan splits")
    ap.add_argument("--cores", type=int, default=None, help="total executor cores")
    ap.add_argument("--once", action="store_true",
                    help="stream: process what is available, refresh the snapshot, exit")
    args = ap.parse_args(argv)
    paths = dict(s.split("=", 1) for s in args.source)
    unknown = set(paths) - set(schemas.STREAMS)
    if unknown:
        ap.error(f"unknown streams: {sorted(unknown)}")
    spark = configure(SparkSession.builder.appName("riskstream").getOrCreate())
    if args.input_tb:
        cores = args.cores or spark.sparkContext.defaultParallelism
        for k, v in cluster_settings(args.input_tb * 1e12, cores).items():
            spark.conf.set(k, v)
    if args.brokers:
        how = {"brokers": args.brokers,
               "kafka": {"security": dict(x.split("=", 1) for x in args.kafka)}}
        given = {n: how for n in schemas.STREAMS}
    else:
        given = {n: {"path": p, "fmt": args.format} for n, p in paths.items()}
    if args.mode == "batch":  # of a topic: all that it holds now
        Views.from_sources(spark, given, as_of=args.as_of).write_all(args.out)
        return
    from riskstream.sources import events
    from riskstream.streaming import snapshot, topology
    loaded = {n: events.load(spark, n, streaming=True, **how) for n, how in given.items()}
    sources = {n: good for n, (good, _) in loaded.items()}
    trigger = {"availableNow": True} if args.once else {}
    dead = [bad.writeStream.format("parquet").trigger(**trigger)
            .option("path", os.path.join(args.root, "dead_letters", n))
            .option("checkpointLocation", os.path.join(args.root, "_checkpoints", f"dead_{n}"))
            .start() for n, (_, bad) in loaded.items()]
    if args.once:
        topo = topology.start(spark, sources, args.root, trigger=trigger)
        topo.queries += dead
        topo.await_all()
        topology.refresh_snapshot(spark, args.root)
        return
    topo = topology.start(spark, sources, args.root)
    refresher = (topo.staged["transactions"].writeStream
                 .option("checkpointLocation", os.path.join(args.root, "_checkpoints", "snapshot"))
                 .foreachBatch(snapshot.snapshot_on_batch(args.root)).start())
    topo.queries += [refresher, *dead]
    spark.streams.awaitAnyTermination()


if __name__ == "__main__":
    main()
