"""Benchmark decontamination by Wu-Manber multi-pattern search (operator 7).

Patterns are the benchmark's windows of ``WINDOW`` consecutive words (a
shorter item is one window).  Symbols are words, blocks are two words.  For
each pattern length a shift table tells how far the search may jump after
seeing a block: a block that no pattern holds skips the window but for one
word.  A block that ends some pattern has shift 0; its bucket lists the
patterns with that end, a prefix block selects among them and a direct
comparison confirms.

The benchmark is the stated query set: it is read in blocks of at most
``BLOCK_BYTES`` of text (an item larger than that is its own block), each of
which is broadcast; documents are never shuffled.  With more than one block
the documents' hits are carried on in a table written between the passes.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskstream.llm.common import carried, small_batches, table, written

WINDOW = 10
BLOCK_BYTES = 1 << 20

_KEPT = b"0123456789abcdefghijklmnopqrstuvwxyz"
#: A-Z to a-z; other ASCII that is not a digit or letter to a space.
FOLD = bytes(b if b >= 128 or b in _KEPT else b + 32 if 65 <= b <= 90 else 32
             for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(FOLD).split() if text else []


class Patterns:
    """Wu-Manber tables of all patterns of one length (in words)."""

    def __init__(self, length: int):
        self.m = length
        self.b = min(2, length)
        self.owners: dict[tuple[bytes, ...], set[str]] = {}

    def add(self, pattern: tuple[bytes, ...], item: str) -> None:
        self.owners.setdefault(pattern, set()).add(item)

    def build(self) -> Patterns:
        m, b = self.m, self.b
        self.shift: dict[tuple[bytes, ...], int] = {}
        self.bucket: dict[tuple[bytes, ...], dict[tuple[bytes, ...], list]] = {}
        for p in self.owners:
            for end in range(b, m + 1):
                block = p[end - b:end]
                if self.shift.get(block, m) > m - end:
                    self.shift[block] = m - end
            self.bucket.setdefault(p[m - b:], {}).setdefault(p[:b], []).append(p)
        return self

    def search(self, words: list[bytes]) -> Iterator[tuple[int, tuple[bytes, ...]]]:
        """(start, pattern) of every occurrence, by start."""
        m, b, n = self.m, self.b, len(words)
        skip, shift = m - b + 1, self.shift
        end = m
        while end <= n:
            block = tuple(words[end - b:end])
            jump = shift.get(block, skip)
            if jump:
                end += jump
                continue
            start = end - m
            for p in self.bucket[block].get(tuple(words[start:start + b]), ()):
                if tuple(words[start:end]) == p:
                    yield start, p
            end += 1


def build_tables(items: list[tuple[str, str]], window: int = WINDOW) -> list[Patterns]:
    by_length: dict[int, Patterns] = {}
    for item, text in items:
        w = words_of(text)
        m = min(len(w), window)
        if m:
            tables = by_length.setdefault(m, Patterns(m))
            for i in range(len(w) - m + 1):
                tables.add(tuple(w[i:i + m]), item)
    return [p.build() for _, p in sorted(by_length.items())]


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _scanner(items, window: int):
    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tables = build_tables(items.value, window)
        for pdf in batches:
            counts, spans, found = [], [], []
            for text, old, ids in zip(pdf["text_"], pdf["spans_"], pdf["items_"], strict=True):
                words = words_of(text)
                hit = [(int(s["a"]), int(s["b"])) for s in old]
                names = set(ids)
                for t in tables:
                    for start, p in t.search(words):
                        hit.append((start, start + t.m))
                        names |= t.owners[p]
                counts.append(len(words))
                spans.append([{"a": a, "b": b} for a, b in merge_spans(hit)])
                found.append(sorted(names))
            yield pdf.assign(n_words_=counts, spans_=spans, items_=found)
    return scan


def benchmark_blocks(benchmark: DataFrame, item_id: str, text: str,
                     block_bytes: int) -> Iterator[list[tuple[str, str]]]:
    """The items in blocks of about ``block_bytes``, one at a time on the driver:
    hashed groups of that mean size, streamed and cut where one is larger."""
    items = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("null")).alias("i"),
                             F.col(text).alias("t")).filter("t is not null").distinct()
    total = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    groups = max(1, -(-total // block_bytes))
    keyed = items.withColumn("g", F.pmod(F.xxhash64("i", "t"), F.lit(groups)))
    for g in range(groups):
        block: list[tuple[str, str]] = []
        size = 0
        for r in keyed.filter(F.col("g") == g).select("i", "t").toLocalIterator():
            if block and size + len(r.t) > block_bytes:
                yield block
                block, size = [], 0
            block.append((r.i, r.t))
            size += len(r.t)
        if block:
            yield block


def find_benchmark(docs: DataFrame, benchmark: DataFrame, keep: list[str], text: str = "text",
                   item_id: str = "item_id", item_text: str = "text", window: int = WINDOW,
                   block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The ``keep`` columns of every row of ``docs`` with n_words, n_hit, spans
    (merged word ranges [a, b)), items (sorted ids) and contaminated.

    Null or empty text: no words, never hit.  Items without words have no
    window; null item ids are named ``null``; rows of the same id are one item.
    Repeated documents are rows of their own.  Empty tables: no hits, or no
    rows.  Columns outside ``keep`` are ignored; names may clash with ours.
    """
    spark = docs.sparkSession
    small_batches(spark)
    spans_type, items_type = "array<struct<a:int,b:int>>", "array<string>"
    there, back = carried(docs, keep)
    df = docs.select(*there, F.col(text).alias("text_"), F.lit(0).cast("long").alias("n_words_"),
                     F.array().cast(spans_type).alias("spans_"),
                     F.array().cast(items_type).alias("items_"))
    schema = T.StructType(df.schema.fields)
    first = True
    for block in benchmark_blocks(benchmark, item_id, item_text, block_bytes):
        if not first:
            df = written(df, "decontaminate")
        df = df.mapInPandas(_scanner(spark.sparkContext.broadcast(block), window), schema)
        first = False
    if first:  # no item: words are still counted
        df = df.mapInPandas(_scanner(spark.sparkContext.broadcast([]), window), schema)
    n_hit = F.aggregate("spans_", F.lit(0).cast("long"), lambda s, x: s + (x.b - x.a))
    return df.select(*back, F.col("n_words_").alias("n_words"), n_hit.alias("n_hit"),
                     F.col("spans_").alias("spans"), F.col("items_").alias("items"),
                     (F.size("spans_") > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no benchmark window, with their columns."""
    found = find_benchmark(docs, benchmark, docs.columns, text)
    clean = found.filter(~F.col("contaminated"))
    return clean.toDF(*docs.columns, *[f"_{i}" for i in range(5)]).select(*docs.columns)


def op7_wu_manber(spark, sf_dir: str) -> DataFrame:
    found = find_benchmark(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"),
                           ["doc_id"])
    return found.select("doc_id", "n_words", "n_hit",
                        F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        "contaminated")


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT DISTINCT coalesce(item_id::VARCHAR, 'null') AS item, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL),
win AS (
  SELECT DISTINCT item, m, array_to_string(w[i:i + m - 1], ' ') AS g
  FROM (SELECT item, w, least(len(w), 10) AS m,
               unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i
        FROM b WHERE len(w) > 0)),
dw AS (
  SELECT r, m, i, array_to_string(w[i:i + m - 1], ' ') AS g
  FROM (SELECT r, w, m, unnest(range(1, len(w) - m + 2)) AS i
        FROM d, (SELECT DISTINCT m FROM win) WHERE len(w) >= m)),
hit AS (SELECT r, i, m, item FROM dw JOIN win USING (m, g)),
pos AS (SELECT r, count(DISTINCT p)::BIGINT AS n_hit
        FROM (SELECT r, unnest(range(i, i + m)) AS p FROM hit) GROUP BY r),
it AS (SELECT r, count(*)::BIGINT AS n_items, string_agg(item, ',' ORDER BY item) AS items
       FROM (SELECT DISTINCT r, item FROM hit) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN pos USING (r) LEFT JOIN it USING (r)
"""
