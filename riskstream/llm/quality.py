"""Quality rules with host verdicts (operator 9).

Each document is judged by base rules on its whole text.  Failures are then
aggregated per host (the ``source``), the host's failure rate is shrunk
towards the corpus rate with a beta prior whose strength is estimated from
the spread of the hosts' own rates, and the host verdict is joined back: a
document of a host whose shrunk rate exceeds ``max_host_rate`` is not kept.

The text is read once, by one bounded batch at a time; what is aggregated and
joined are a few numbers a document.  A hot host is pre-aggregated in each
task, and its side of the join back is one row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskstream.llm.common import SPACES, carried, small_batches, table, written

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PCT = 50
MAX_HOST_RATE = 0.5


def repeat_words(words: list[bytes]) -> int:
    """Words inside three-word windows that occur at least twice."""
    n = len(words)
    if n < 4:
        return 0
    ids: dict[bytes, int] = {}
    code = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, n)
    _, pair = np.unique(code[:-2] * len(ids) + code[1:-1], return_inverse=True)
    _, inv, cnt = np.unique(pair.astype(np.int64) * len(ids) + code[2:],
                            return_inverse=True, return_counts=True)
    hit = cnt[inv] > 1
    mark = np.zeros(n, bool)
    mark[:-2] |= hit
    mark[1:-1] |= hit
    mark[2:] |= hit
    return int(mark.sum())


def text_stats(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of one text."""
    if not text:
        return 0, 0, 0, 0, 0
    words = text.encode("utf-8", "surrogatepass").split()
    spaces = sum(text.count(c) for c in SPACES)
    dup, seen = 0, set()
    if "\n" in text:
        for line in text.split("\n"):
            if line.strip(SPACES):
                if line in seen:
                    dup += 1
                else:
                    seen.add(line)
    return (len(words), len(text) - spaces, sum(text.count(c) for c in SYMBOLS), dup,
            repeat_words(words))


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        got = pd.DataFrame([text_stats(t) for t in b["text"]], columns=COUNTS, dtype="int64")
        yield pd.concat([b[["k0", "host"]].reset_index(drop=True), got], axis=1)


def base_rules(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
               host: str = "source") -> DataFrame:
    """doc_id, host, the five counts and base_failed, one row per row of ``docs``.

    Null or empty text: all counts 0, so the base rules fail it.
    """
    small_batches(docs.sparkSession)
    there, back = carried(docs, [doc_id])
    d = docs.select(*there, F.col(host).cast("string").alias("host"),
                    F.col(text).alias("text"))
    got = d.mapInPandas(_measure, f"k0 {d.schema['k0'].dataType.simpleString()}, host string, "
                        + ", ".join(f"{c} long" for c in COUNTS))
    got = got.select(back[0].alias("doc_id"), "host", *COUNTS)
    return got.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words")))


def host_verdicts(judged: DataFrame, max_host_rate: float = MAX_HOST_RATE) -> DataFrame:
    """host, n_docs, n_failed, shrunk_rate, host_failed from (host, base_failed).

    Beta prior by moments: with pooled rate m and the document-weighted
    variance v of the hosts' rates, its strength is m(1-m)/v - 1, at least 0.
    Without spread (v = 0, for instance a single host) every host gets m.
    """
    hosts = judged.groupBy("host").agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.sum(F.col("base_failed").cast("long")).alias("n_failed"))
    sums = hosts.agg(F.sum("n_docs").alias("n"), F.sum("n_failed").alias("f"),
                     F.sum(F.col("n_failed") * F.col("n_failed") / F.col("n_docs")).alias("ff"))
    m = F.col("f") / F.col("n")
    v = F.greatest(F.col("ff") / F.col("n") - m * m, F.lit(0.0))
    prior = sums.select(m.alias("m"), F.when(v > 1e-12, F.greatest(
        m * (1 - m) / v - 1, F.lit(0.0))).alias("strength"))
    # One row of totals beside every host: scalar subqueries, no join.
    m_all = prior.select("m").scalar()
    strength = prior.select("strength").scalar()
    shrunk = F.when(strength.isNull(), m_all).otherwise(
        (F.col("n_failed") + strength * m_all) / (F.col("n_docs") + strength))
    return (hosts.withColumn("shrunk_rate", shrunk)
            .withColumn("host_failed", F.col("shrunk_rate") > max_host_rate))


def quality_rules(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  host: str = "source", max_host_rate: float = MAX_HOST_RATE) -> DataFrame:
    """The base rules' columns with shrunk_rate, host_failed and kept.

    Null host: one host of its own.  Repeated rows count as often as they
    come.  An empty table gives no rows; other columns are ignored.
    """
    judged = written(base_rules(docs, doc_id, text, host), "quality-base")
    verdict = host_verdicts(judged, max_host_rate).select(
        F.col("host").alias("h"), "shrunk_rate", "host_failed")
    return (judged.join(verdict, F.col("host").eqNullSafe(F.col("h"))).drop("h")
            .withColumn("kept", ~F.col("base_failed") & ~F.col("host_failed")))


def op9_host_quality(spark, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "host_failed")


ORACLE = r"""
WITH w AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
tri AS (
  SELECT r, i, words[i:i+2] AS g
  FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
twice AS (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM tri),
rep AS (
  SELECT r, count(DISTINCT p)::BIGINT AS n
  FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM twice WHERE c > 1) GROUP BY r),
lines AS (
  SELECT r, (count(*) - count(DISTINCT l))::BIGINT AS n
  FROM (SELECT r, unnest(string_split(text, chr(10))) AS l FROM w)
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY r),
base AS (
  SELECT w.r, doc_id, source, len(words)::BIGINT AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
         coalesce(lines.n, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words
  FROM w LEFT JOIN lines USING (r) LEFT JOIN rep USING (r)),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base),
hosts AS (SELECT source, count(*) AS n, count(*) FILTER (base_failed) AS f FROM judged GROUP BY source),
mom AS (SELECT sum(f) / sum(n) AS m, sum(f * f / n) / sum(n) AS mm FROM hosts),
v AS (
  SELECT source, CASE WHEN mm - m * m <= 1e-12 THEN m
         ELSE (f + greatest(m * (1 - m) / (mm - m * m) - 1, 0) * m)
              / (n + greatest(m * (1 - m) / (mm - m * m) - 1, 0)) END > 0.5 AS host_failed
  FROM hosts, mom)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT host_failed AS kept, host_failed
FROM judged JOIN v ON judged.source IS NOT DISTINCT FROM v.source
"""
