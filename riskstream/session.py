"""Session settings the operators rely on.

Only runtime SQL confs are touched, so the helpers are safe to call on a
session someone else built (a cluster session keeps its own resources).
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings that change results or plans.  The session zone pins
# EXTRACT(HOUR ...) and the timestamp rendering to UTC.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Hot groups (one customer / device with a large share of the rows) are
    # split by AQE for joins; windowed LAG is split by time buckets instead.
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    # Keyed state of dimension size stays off the executors' heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def cluster_settings(input_bytes: float, total_cores: int,
                     target_partition_bytes: int = 256 << 20,
                     max_partitions: int = 100_000) -> dict[str, str]:
    """Shuffle / scan sizing for a cluster run over ``input_bytes`` of input.

    * scan splits of 512 MiB: 100 TB -> ~200k scan tasks, each well inside an
      executor's memory;
    * initial shuffle partitions sized so that a full-width shuffle of the
      input lands near ``target_partition_bytes`` per partition (at least 4
      waves of the cluster's cores), capped at ``max_partitions`` so the map
      output bookkeeping on the driver stays bounded (the widest shuffle here,
      the geo LAG, carries about a third of the columns); AQE then coalesces
      the much smaller post-aggregation shuffles to the advisory size;
    * skew: a partition 5x the median and above 1 GiB is split by AQE;
    * broadcast: only sides measured under 64 MiB at run time.
    """
    initial = min(max_partitions,
                  max(4 * total_cores, int(input_bytes // target_partition_bytes)))
    return {
        "spark.sql.files.maxPartitionBytes": str(512 << 20),
        "spark.sql.shuffle.partitions": str(initial),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(initial),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1 << 30),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
    }


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the library needs (idempotent)."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "riskstream") -> SparkSession:
    """A local session for tests, the bench and examples."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    Read from the session (``spark.checkpoint.dir`` or a folder already set
    on the context).  Only a local session without either gets a folder of its
    own; on a cluster the setting must point at shared storage.
    """
    sc = spark.sparkContext
    path = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="riskstream-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path
