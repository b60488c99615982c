"""Streaming C7: the LAG per customer as chained keyed state.

Two stateful steps, so that no step re-reads a customer's whole buffer and a
hot customer is spread over tasks:

1. ``InBucket``, keyed by (customer, time bucket): rows in a ``MapState`` of
   short slots.  A new row touches its slot, the last row of the slot before and
   the first of the slot after.  It gives the pairs of neighbours that it makes
   or changes, and the bucket's first and last row when they change (an edge).
2. ``AcrossBuckets``: edges keyed by customer pair the first row of a bucket with
   the last row of the bucket before; pairs pass through on keys of their own.

Event-time timers free a bucket when the watermark has passed it; of the passed
buckets step 2 keeps the newest one's edge, the tail that the next row follows.
"""

from __future__ import annotations

import json
from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from riskstream.functions.time import interval_micros

CARRY = [("transaction_id", T.StringType()), ("country_code", T.StringType()),
         ("latitude", T.DoubleType()), ("longitude", T.DoubleType()),
         ("occurred_at", T.TimestampType())]
NAMES = [n for n, _ in CARRY]
PAIR = T.StructType(
    [T.StructField("customer_id", T.StringType()), T.StructField("account_id", T.StringType()),
     T.StructField("bucket", T.LongType()), T.StructField("edge", T.BooleanType())]
    + [T.StructField(f"p_{n}", t) for n, t in CARRY]
    + [T.StructField(n, t) for n, t in CARRY])
COLUMNS = [f.name for f in PAIR]  # names with _ in front would be renamed on the way

#: A row in state: account, transaction, country, latitude, longitude, microseconds.
Row = tuple


def plain(v):
    """pandas scalar -> plain Python value; times become microseconds, which no
    time zone changes."""
    if v is None or (not isinstance(v, str) and pd.isna(v)):
        return None
    if isinstance(v, pd.Timestamp):
        return v.value // 1000
    return v.item() if hasattr(v, "item") else v


def shown(row: Row) -> tuple:
    """A row's carried fields with its time as a timestamp again."""
    return *row[1:-1], pd.Timestamp(row[-1], unit="us")


def order(row: Row) -> tuple:
    """(time, transaction id with NULL first): the order of the batch LAG."""
    return row[-1], row[1] is not None, row[1] or ""


def frame(out: list[tuple]) -> pd.DataFrame:
    df = pd.DataFrame(out, columns=COLUMNS)
    for c in ("p_occurred_at", "occurred_at"):
        df[c] = pd.to_datetime(df[c])
    return df


def rows_of(pdf: pd.DataFrame, names: list[str]) -> list[Row]:
    times = pdf[[n for n in names if n.endswith("occurred_at")]].astype("datetime64[ns]")
    return [tuple(plain(v) for v in r)
            for r in pdf.assign(**times)[names].itertuples(index=False, name=None)]


class Slots:
    """Rows of one bucket in short slots over ``get(slot)`` / ``put(slot, rows)``;
    ``index`` lists the slots that have rows."""

    def __init__(self, size: int, index: list[int], get, put):
        self.size, self.index, self.get, self.put = size, index, get, put

    def add(self, new: list[Row]) -> tuple[list[tuple[Row, Row]], tuple[Row, Row] | None]:
        """Pairs (before, row) made or changed, and the edge if it changed."""
        fresh, touched = set(), {}
        for row in new:
            touched.setdefault(row[-1] // self.size, []).append(row)
        for slot, rows in touched.items():
            fresh.update(map(id, rows))
            if slot in self.index:
                rows = self.get(slot) + rows
            else:
                self.index.insert(bisect_left(self.index, slot), slot)
            touched[slot] = sorted(rows, key=order)
            self.put(slot, touched[slot])
        of = lambda slot: touched.get(slot) or self.get(slot)
        pairs = []
        for slot, rows in touched.items():
            at = self.index.index(slot)
            line = ([of(self.index[at - 1])[-1]] if at else []) + rows
            after = self.index[at + 1] if at + 1 < len(self.index) else None
            if after is not None and after not in touched:
                line.append(of(after)[0])
            pairs += [(a, b) for a, b in zip(line, line[1:]) if id(a) in fresh or id(b) in fresh]
        first, last = of(self.index[0])[0], of(self.index[-1])[-1]
        return pairs, (first, last) if id(first) in fresh or id(last) in fresh else None


class InBucket(StatefulProcessor):
    def __init__(self, bucket: int, slot: int):
        self.bucket, self.slot = bucket, slot

    def init(self, handle) -> None:
        self.handle = handle
        self.rows = handle.getMapState("rows", "slot long", "rows string")
        self.index = handle.getValueState("index", "slots string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        customer, bucket = key[0], int(key[1])
        new = []
        for pdf in rows:
            new += rows_of(pdf, ["account_id", *NAMES])
        if not self.index.exists():
            self.handle.registerTimer((bucket + 1) * self.bucket // 1000)
        index = json.loads(self.index.get()[0]) if self.index.exists() else []
        slots = Slots(self.slot, index,
                      lambda s: [tuple(r) for r in json.loads(self.rows.getValue((s,))[0])],
                      lambda s, rs: self.rows.updateValue((s,), (json.dumps(rs),)))
        pairs, edge = slots.add(new)
        self.index.update((json.dumps(slots.index),))
        out = [(customer, b[0], bucket, False, *shown(a), *shown(b)) for a, b in pairs]
        if edge:
            out.append((customer, edge[0][0], bucket, True, *shown(edge[0]), *shown(edge[1])))
        if out:
            yield frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):  # noqa: N802, N803
        self.rows.clear()
        self.index.clear()
        return iter(())

    def close(self) -> None:
        pass


class AcrossBuckets(StatefulProcessor):
    def __init__(self, bucket: int):
        self.bucket = bucket

    def init(self, handle) -> None:
        self.handle = handle
        self.edges = handle.getMapState("edges", "bucket long", "edge string")
        self.index = handle.getValueState("index", "buckets string")

    def _buckets(self) -> list[int]:
        return json.loads(self.index.get()[0]) if self.index.exists() else []

    def _edge(self, bucket: int) -> list[Row]:
        return [tuple(r) for r in json.loads(self.edges.getValue((bucket,))[0])]

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        changed = {}
        for pdf in rows:
            through = pdf[~pdf["edge"].astype(bool)]
            if len(through):
                yield through[COLUMNS]
            edges = pdf[pdf["edge"].astype(bool)]
            firsts = rows_of(edges, ["account_id", *[f"p_{n}" for n in NAMES]])
            lasts = rows_of(edges, ["account_id", *NAMES])
            for bucket, first, last in zip(edges["bucket"], firsts, lasts, strict=True):
                changed[int(bucket)] = (first, last)
        if not changed:
            return
        index = self._buckets()
        for bucket, edge in changed.items():
            self.edges.updateValue((bucket,), (json.dumps(edge),))
            if bucket not in index:
                index.insert(bisect_left(index, bucket), bucket)
                self.handle.registerTimer((bucket + 1) * self.bucket // 1000)
        self.index.update((json.dumps(index),))
        of = lambda b: changed.get(b) or self._edge(b)
        ends = {index.index(b) for b in changed} | {index.index(b) + 1 for b in changed}
        out = []
        for i in sorted(ends):
            if 0 < i < len(index):
                before, row = of(index[i - 1])[1], of(index[i])[0]
                out.append((key[0], row[0], index[i], False, *shown(before), *shown(row)))
        if out:
            yield frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):  # noqa: N802, N803
        """Of the buckets that the watermark has passed only the newest stays."""
        index, mark = self._buckets(), timerValues.getCurrentWatermarkInMs()
        passed = [b for b in index if (b + 1) * self.bucket // 1000 <= mark]
        for bucket in passed[:-1]:
            self.edges.removeKey((bucket,))
            index.remove(bucket)
        self.index.update((json.dumps(index),))
        return iter(())

    def close(self) -> None:
        pass


def pairs(stream: DataFrame, watermark: str, bucket: str, slot: str) -> DataFrame:
    """Rows of ``PAIR``: one for each transaction whose predecessor is new or has
    changed.  Rows without an event time have no place in the order."""
    size = interval_micros(bucket)
    src = (stream.where(F.col("occurred_at").isNotNull()).withWatermark("occurred_at", watermark)
           .select("customer_id", "account_id", *NAMES,
                   F.expr(f"unix_micros(occurred_at) div {size}").alias("bucket_no")))
    inside = src.groupBy("customer_id", "bucket_no").transformWithStateInPandas(
        InBucket(size, interval_micros(slot)), PAIR, "append", "EventTime",
        eventTimeColumnName="occurred_at")
    spread = inside.withColumn("spread", F.when(F.col("edge"), F.lit(-1)).otherwise(F.col("bucket")))
    return spread.groupBy("customer_id", "spread").transformWithStateInPandas(
        AcrossBuckets(size), PAIR, "append", "EventTime")
