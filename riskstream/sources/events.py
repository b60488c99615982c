"""Event sources and sinks.

Every stream is read with its explicit schema (no inference).  Kafka is the
production transport: ``kafka_options`` builds the reader/writer options and
``read_stream`` parses the ``value`` column with ``from_json``.  Files (JSON
lines or Parquet) are the same path for tests and backfills.  The Kafka
connector jar is not on this image's classpath, so tests use files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskstream import schemas
from riskstream.operators.staging import parse_ts

CORRUPT = "_corrupt_record"


def kafka_options(brokers: str, topic: str, starting_offsets: str = "earliest",
                  security: dict[str, str] | None = None, subscribe: bool = True,
                  fail_on_data_loss: bool = True) -> dict:
    """Options for ``format("kafka")``; ``earliest`` replays the topic.

    A query fails when offsets it has not read are gone; passing
    ``fail_on_data_loss=False`` skips them.  ``security`` holds ``kafka.*`` client settings (SASL mechanism, JAAS
    config, ...) and is passed through unchanged.
    """
    opts = {"kafka.bootstrap.servers": brokers}
    if subscribe:
        opts.update({"subscribe": topic, "startingOffsets": starting_offsets,
                     "failOnDataLoss": str(fail_on_data_loss).lower()})
    else:
        opts["topic"] = topic
    opts.update(security or {})
    return opts


def _with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType(), True)])


def parse_json(value: Column, stream: str) -> Column:
    """JSON text -> struct of the stream's fields plus ``_corrupt_record``.

    PERMISSIVE: bad JSON and wrong value types keep the text in
    ``_corrupt_record``; a missing field is NULL.
    """
    return F.from_json(value, _with_corrupt(schemas.STREAMS[stream]),
                       {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})


def read_stream(spark: SparkSession, stream: str, path: str | None = None,
                brokers: str | None = None, topic: str | None = None, fmt: str = "json",
                streaming: bool = False, keep_corrupt: bool = True,
                kafka: dict | None = None, **options) -> DataFrame:
    """A1-A5: one event stream with its declared columns (and ``_corrupt_record``).

    Kafka when ``brokers`` is given (topic defaults to the stream name,
    ``kafka`` holds arguments of ``kafka_options``), otherwise files at
    ``path`` in ``fmt``.
    """
    schema = schemas.STREAMS[stream]
    reader = spark.readStream if streaming else spark.read
    if brokers:
        raw = reader.format("kafka").options(
            **kafka_options(brokers, topic or stream, **(kafka or {}))).load()
        parsed = raw.select(parse_json(F.col("value").cast("string"), stream).alias("e"))
        df = parsed.select("e.*")
    elif fmt == "json":
        df = reader.schema(_with_corrupt(schema)).options(
            mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT, **options).json(path)
    else:
        df = reader.schema(schema).options(**options).format(fmt).load(path)
        df = df.withColumn(CORRUPT, F.lit(None).cast("string"))
    cols = [f.name for f in schema] + ([CORRUPT] if keep_corrupt else [])
    return df.select(*cols)


def read_transactions(spark, **kw) -> DataFrame:
    return read_stream(spark, "transactions", **kw)


def read_login_events(spark, **kw) -> DataFrame:
    return read_stream(spark, "login_events", **kw)


def read_card_events(spark, **kw) -> DataFrame:
    return read_stream(spark, "card_events", **kw)


def read_alert_events(spark, **kw) -> DataFrame:
    return read_stream(spark, "alert_events", **kw)


def read_kyc_profile_events(spark, **kw) -> DataFrame:
    return read_stream(spark, "kyc_profile_events", **kw)


def quarantine(df: DataFrame, stream: str) -> tuple[DataFrame, DataFrame]:
    """Split into (good rows, dead letters).

    A row is a dead letter when its JSON was corrupt or its event time does
    not parse.  Dead letters are ``(topic, payload, error)`` like the
    producer's DLQ messages.  Both outputs are narrow filters of the input.
    """
    ts = schemas.EVENT_TIME[stream]
    has_corrupt = CORRUPT in df.columns
    corrupt = F.col(CORRUPT).isNotNull() if has_corrupt else F.lit(False)
    bad_time = F.col(ts).isNotNull() & parse_ts(ts).isNull()
    missing_time = F.col(ts).isNull()
    error = (F.when(corrupt, F.lit("malformed_json"))
             .when(missing_time, F.lit("missing_event_time"))
             .when(bad_time, F.lit("bad_event_time")))
    tagged = df.withColumn("_error", error)
    cols = [f.name for f in schemas.STREAMS[stream]]
    good = tagged.where(F.col("_error").isNull()).select(*cols)
    payload = F.coalesce(F.col(CORRUPT), F.to_json(F.struct(*cols))) if has_corrupt \
        else F.to_json(F.struct(*cols))
    bad = tagged.where(F.col("_error").isNotNull()).select(
        F.lit(stream).alias("topic"), payload.alias("payload"), F.col("_error").alias("error"))
    return good, bad


def to_messages(df: DataFrame, key: str | None = None) -> DataFrame:
    """Rows -> (key, value) JSON messages, the topic wire format."""
    value = F.to_json(F.struct(*[F.col(c) for c in df.columns]))
    k = F.col(key).cast("string") if key else F.lit(None).cast("string")
    return df.select(k.alias("key"), value.alias("value"))


def write_topic(df: DataFrame, topic: str, brokers: str | None = None, path: str | None = None,
                key: str | None = None, security: dict[str, str] | None = None,
                checkpoint: str | None = None):
    """Publish rows as JSON messages (Kafka, or JSON files at ``path``).

    ``acks=all`` and retries mirror the producer settings.  Streaming inputs
    return the started query; batch inputs write and return None.
    """
    msgs = to_messages(df, key)
    if brokers:
        opts = kafka_options(brokers, topic, security=security, subscribe=False)
        opts.update({"kafka.acks": "all", "kafka.retries": "3"})
        fmt = "kafka"
    else:
        # one JSON message per line, readable back with ``read_stream(fmt="json")``
        opts, fmt = {"path": path}, "text"
        msgs = msgs.select("value")
    if df.isStreaming:
        return msgs.writeStream.format(fmt).options(**opts) \
            .option("checkpointLocation", checkpoint).start()
    msgs.write.format(fmt).options(**opts).mode("append").save()
    return None


def check_contract(df: DataFrame, stream: str) -> list[str]:
    """A10: differences between a source's columns and the declared schema.

    Names and order must be equal; an empty list means the contract holds.
    """
    want = [(f.name, f.dataType.simpleString()) for f in schemas.STREAMS[stream]]
    got = [(f.name, f.dataType.simpleString()) for f in df.schema if f.name != CORRUPT]
    problems = []
    if [n for n, _ in got] != [n for n, _ in want]:
        problems.append(f"columns {[n for n, _ in got]} != {[n for n, _ in want]}")
    for (n1, t1), (n2, t2) in zip(got, want):
        if n1 == n2 and t1 != t2:
            problems.append(f"{n1}: {t1} != {t2}")
    return problems


def load(spark: SparkSession, stream: str, **source) -> tuple[DataFrame, DataFrame]:
    """(good rows, dead letters) of one stream, the way every run loads it.

    Files that carry their own schema must meet the contract (A10); JSON is
    read with the declared schema, and what does not fit is a dead letter (A7).
    """
    fmt = source.get("fmt", "json")
    if not source.get("brokers") and fmt != "json":
        problems = check_contract(spark.read.format(fmt).load(source["path"]), stream)
        if problems:
            raise ValueError(f"{stream}: " + "; ".join(problems))
    return quarantine(read_stream(spark, stream, **source), stream)
