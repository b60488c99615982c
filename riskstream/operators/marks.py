"""High-water marks and checks measured by the write itself.

Staging a stream observes, in the pass that writes it, the number of rows, the
newest event time and the NULLs of the columns that must not be NULL.  They are
appended to a small table, one row a write.  ``NOW()`` and the freshness checks
then read that table; nothing scans a staged table for its maximum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

SCHEMA = ("stream string, view_name string, rows long, newest timestamp, "
          "nulls map<string, long>")


def observed(df: DataFrame, ts: str, not_null: list[str]) -> tuple[DataFrame, Observation]:
    """``df`` with its metrics; the observation has them once it is written."""
    seen = Observation()
    nulls = [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in not_null]
    newest = F.max(F.unix_micros(ts)).alias("newest")
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), newest, *nulls), seen


def record(spark: SparkSession, path: str, stream: str, view: str, seen: Observation) -> None:
    """Append the marks of a finished write."""
    got = seen.get
    nulls = {k[len("null_"):]: v for k, v in got.items() if k.startswith("null_")}
    row = spark.createDataFrame([(stream, view, got.get("rows", 0), got.get("newest"), nulls)],
                                "stream string, view_name string, rows long, us long, "
                                "nulls map<string, long>")
    row.select("stream", "view_name", "rows", F.timestamp_micros("us").alias("newest"), "nulls") \
        .coalesce(1).write.mode("append").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row a stream over all its writes: stream, view_name, rows, newest."""
    return spark.read.schema(SCHEMA).parquet(path).groupBy("stream", "view_name").agg(
        F.sum("rows").alias("rows"), F.max("newest").alias("newest"))


def computed(streams: dict[str, tuple[str, DataFrame, str]]) -> DataFrame:
    """The same from the streams themselves, where nothing was recorded."""
    out = None
    for name, (view, df, ts) in streams.items():
        one = df.agg(F.count(F.lit(1)).alias("rows"), F.max(ts).alias("newest")).select(
            F.lit(name).alias("stream"), F.lit(view).alias("view_name"), "rows", "newest")
        out = one if out is None else out.unionByName(one)
    return out


def newest(marks: DataFrame, *streams: str) -> Column:
    """The newest event time of some streams (all without names): a scalar over a
    table of a few rows."""
    if streams:
        marks = marks.where(F.col("stream").isin(*streams))
    return marks.select(F.max("newest")).scalar()


def null_counts(spark: SparkSession, path: str) -> DataFrame:
    """view_name, column_name, failures of the NOT NULL checks made on writing."""
    each = spark.read.schema(SCHEMA).parquet(path).select(
        "view_name", F.explode("nulls").alias("column_name", "n"))
    return each.groupBy("view_name", "column_name").agg(F.sum("n").alias("failures"))
