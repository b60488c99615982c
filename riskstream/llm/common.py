"""Helpers shared by the operators: tables, words, shared scratch tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: The same white space as Python's bytes.split() takes.
SPACES = " \t\n\x0b\x0c\r"
#: bytes.translate table: A-Z to a-z, everything else unchanged.
LOWER = bytes.maketrans(UPPER.encode(), UPPER.lower().encode())


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def lower_az(col: Column) -> Column:
    return F.translate(col, UPPER, UPPER.lower())


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def small_batches(spark: SparkSession, rows: int = 512) -> None:
    """Bound what one Arrow batch brings into a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


def carried(df: DataFrame, cols: Sequence[str]) -> tuple[list[Column], list[Column]]:
    """Columns on their way through pandas and back: numbers go as text, which
    keeps nulls and large integers whole; names are k0, k1, ... in between."""
    kinds = [df.schema[c].dataType for c in cols]
    there = [(F.col(c).cast("string") if isinstance(k, T.NumericType) else F.col(c)).alias(f"k{i}")
             for i, (c, k) in enumerate(zip(cols, kinds, strict=True))]
    back = [F.col(f"k{i}").cast(k).alias(c)
            for i, (c, k) in enumerate(zip(cols, kinds, strict=True))]
    return there, back


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share (``spark.checkpoint.dir``).

    Only a local session without the setting gets a folder of its own.
    """
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="riskstream-shared-")
        sc.setCheckpointDir(path)
    return path.rstrip("/")


def new_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"


def written(df: DataFrame, tag: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """``df`` as a table written to the shared folder: cuts the lineage, is
    computed once, and survives lost executors."""
    spark = df.sparkSession
    path = new_path(spark, tag)
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def files_of_shuffles_go(spark: SparkSession) -> Iterator[None]:
    """What is written inside leaves no shuffle files: the table is all that is
    read from then on."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)
