"""Materialized views kept current from a stream.

A view is a partitioned Parquet table of changes.  Each micro-batch appends the
rows that changed, with its epoch number; nothing is read back or rewritten, so
a micro-batch costs what it changes and a reader never meets a half-written
partition.  The current rows are, per key, those of the newest epoch.  A
replayed epoch appends the same rows again, which changes nothing, so
``foreachBatch`` + a checkpoint location is effectively exactly-once.

The partition of a key never changes (the day of a window start for windowed
views, a hash bucket of the key for keyed tables) and is a grouping key of the
read, so a filter on it prunes files.

``publish_compacted`` bounds what a read costs while the query runs: the current
rows as of the last finished epoch are written as a base table, and the base
counts once its pointer is appended.  A read takes the newest base and the
changes of later epochs.  ``compact`` writes a table of its own with the current
rows only, for a topology that starts again from it.
"""

from __future__ import annotations

import json
import os
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskstream.functions.time import PART

EPOCH = "_epoch"
META = "_meta"  # folders whose names data readers skip
BASES, POINTERS = "_bases", "_published"
#: Clocks that stamp files may differ by so much.
CLOCK_MARGIN = "1 hour"
#: A topology publishes a base every so many epochs.
COMPACT_EVERY = 100


def day_of(col: str) -> Column:
    """Partition by the day of a time that never changes for a key."""
    return F.to_date(F.col(col))


def hash_bucket(keys: list[str], buckets: int = 64) -> Column:
    """Partition keyed tables by a stable hash of the key."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets))


def _load_meta(spark: SparkSession, path: str) -> dict | None:
    try:
        found = spark.read.text(os.path.join(path, META)).orderBy("value").first()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return json.loads(found.value) if found else None


def _save_meta(spark: SparkSession, path: str, schema: T.StructType, keys: list[str],
               version: str | None) -> None:
    """Schema and keys beside the data: a view without rows is readable too."""
    text = json.dumps({"schema": schema.jsonValue(), "keys": keys, "version": version},
                      sort_keys=True)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("append").text(
        os.path.join(path, META))


def change_rows(rows: DataFrame, part: Column, epoch: int = 0) -> DataFrame:
    """Rows of a view as its table holds them."""
    return rows.withColumn(PART, part).withColumn(EPOCH, F.lit(epoch).cast("long"))


def prepare(spark: SparkSession, path: str, schema: T.StructType, keys: list[str],
            version: str | None = None) -> None:
    """Make the table known before its first rows, so that streams can start on it."""
    if _load_meta(spark, path) is None:
        _save_meta(spark, path, schema, keys, version)


def change_stream(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The changes of a prepared view as a stream, each appended row once."""
    return spark.readStream.schema(schema).parquet(path)


def append_changes(batch: DataFrame, path: str, keys: list[str], part: Column, epoch: int,
                   version: str | None = None) -> None:
    """Append the changed rows of one micro-batch to the table at ``path``.

    ``version`` names a column that orders rows of one key inside a batch; an
    update-mode aggregate has one row per key and needs none.
    """
    spark = batch.sparkSession
    rows = change_rows(batch, part, epoch)
    prepare(spark, path, rows.schema, keys, version)
    rows.write.mode("append").partitionBy(PART).parquet(path)


def changes(spark: SparkSession, path: str) -> DataFrame:
    """All appended rows, with ``_part`` and ``_epoch``."""
    meta = _load_meta(spark, path)
    reader = spark.read
    if meta is not None:
        reader = reader.schema(T.StructType.fromJson(meta["schema"]))
    return reader.parquet(path)


def _newest_base(spark: SparkSession, path: str) -> tuple[str, int, str] | None:
    """(name, epoch, since) of the newest published base."""
    try:
        found = spark.read.schema("name string, epoch long, since string").json(
            os.path.join(path, POINTERS))
        row = found.orderBy(F.desc("epoch"), F.desc("name")).first()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return tuple(row) if row else None


def _later(spark: SparkSession, path: str, base: tuple[str, int, str] | None) -> DataFrame:
    """The changes after a base.  The files' times only prune, the epochs decide."""
    rows = changes(spark, path)
    if base is None:
        return rows
    _, epoch, since = base
    return rows.where((F.col("_metadata.file_modification_time") >= F.lit(since).cast("timestamp"))
                      & (F.col(EPOCH) > epoch))


def _live_rows(spark: SparkSession, path: str, base: tuple[str, int, str] | None) -> DataFrame:
    """The rows of a base and the changes after it."""
    rows = _later(spark, path, base)
    if base is None:
        return rows
    return rows.unionByName(spark.read.schema(rows.schema).parquet(
        os.path.join(path, BASES, base[0])))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The current rows with ``_part``: per key the newest epoch's.  A table that
    a plain file sink wrote (no keys) is read as it is."""
    meta = _load_meta(spark, path)
    if meta is None:
        return changes(spark, path)
    return _current(_live_rows(spark, path, _newest_base(spark, path)), meta)


def _current(rows: DataFrame, meta: dict) -> DataFrame:
    """Per key the newest epoch's row."""
    keys = [PART, *meta["keys"]]
    rest = [c for c in rows.columns if c not in keys and c != EPOCH]
    newest = F.struct(EPOCH, *[meta["version"]] * bool(meta["version"]))
    now = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), newest).alias("_row"))
    out = now.select(*keys, "_row.*")
    order = [c for c in rows.columns if c not in (PART, EPOCH, meta["version"])]
    return out.select(*order, PART)


def read_view(spark: SparkSession, path: str) -> DataFrame:
    """The current rows of a materialized view (partition column dropped)."""
    return read_table(spark, path).drop(PART)


def publish_compacted(spark: SparkSession, path: str, margin: str = CLOCK_MARGIN) -> int | None:
    """Write the current rows as of the last finished epoch as the table's new
    base and publish it; returns that epoch, or None if no epoch is finished since
    the last base.  The table's query may run meanwhile: an epoch is finished
    when a later one has begun, so no replay adds to it.  Changes and older bases
    stay until the storage's retention removes them.
    """
    meta, base = _load_meta(spark, path), _newest_base(spark, path)
    if meta is None:
        return None
    rows = _live_rows(spark, path, base)
    epoch = rows.agg(F.max(EPOCH)).first()[0]
    if epoch is None or epoch - 1 <= (base[1] if base else -1):
        return None
    epoch -= 1
    since = _later(spark, path, base).where(F.col(EPOCH) > epoch).agg(
        (F.min("_metadata.file_modification_time") - F.expr(f"INTERVAL {margin}")).cast("string")
    ).first()[0]
    now = _current(rows.where(F.col(EPOCH) <= epoch), meta)
    if meta["version"]:
        kind = T.StructType.fromJson(meta["schema"])[meta["version"]].dataType
        now = now.withColumn(meta["version"], F.lit(None).cast(kind))
    name = f"{epoch}-{uuid.uuid4().hex}"
    now.withColumn(EPOCH, F.lit(epoch).cast("long")).repartition(PART).write.partitionBy(
        PART).parquet(os.path.join(path, BASES, name))
    spark.createDataFrame([(name, epoch, since)], "name string, epoch long, since string").coalesce(
        1).write.mode("append").json(os.path.join(path, POINTERS))
    return epoch


def compact(spark: SparkSession, path: str, out: str) -> None:
    """Write the current rows of ``path`` to ``out`` as a table of its own (epoch
    -1, so that any later change of a key wins)."""
    meta = _load_meta(spark, path)
    rows = read_table(spark, path)
    if meta["version"]:
        kind = T.StructType.fromJson(meta["schema"])[meta["version"]].dataType
        rows = rows.withColumn(meta["version"], F.lit(None).cast(kind))
    append_changes(rows, out, meta["keys"], F.col(PART), -1, meta["version"])


def materialize(stream: DataFrame, path: str, keys: list[str], part: Column,
                checkpoint: str, trigger: dict | None = None, query_name: str | None = None,
                output_mode: str = "update", version: str | None = None,
                compact_every: int | None = None):
    """Start a streaming query that keeps ``path`` equal to the view's rows.

    ``stream`` is a streaming aggregate (``update`` emits the changed groups)
    or an append stream whose rows replace earlier ones of their key.  Every
    ``compact_every`` epochs the query publishes a base (``publish_compacted``).
    Returns the ``StreamingQuery``.
    """
    def run(df: DataFrame, epoch: int) -> None:
        append_changes(df, path, keys, part, epoch, version)
        if compact_every and epoch % compact_every == compact_every - 1:
            publish_compacted(df.sparkSession, path)

    writer = (stream.writeStream.outputMode(output_mode)
              .option("checkpointLocation", checkpoint).foreachBatch(run))
    if query_name:
        writer = writer.queryName(query_name)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()
