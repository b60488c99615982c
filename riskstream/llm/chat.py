"""Collapsing cumulative conversation snapshots, then rendering (operator 6).

DataFrame functions only.  A logged conversation that is a prefix of a longer
one is dropped, of equal ones the smallest id stays.  Prefixes are compared by
rolling hashes: the hash of the first n turns is the hash of the first n - 1
plus a hash of (n, role, text), as four independent 32-bit sums.

Turns are numbered inside blocks of ``BLOCK`` turn numbers, and the blocks'
sums are added up over the few blocks of a conversation, so a conversation
that holds a third of all turns is worked on by many tasks.  It is rendered in
parts of ``PART`` turns for the same reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskstream.llm.common import table, written

BLOCK = 256
PART = 256
SUMS = ["h1", "h2", "h3", "h4"]


def turn_hashes(pos: Column) -> list[Column]:
    """Four 32-bit hashes of a turn in its place; null differs from empty."""
    what = [pos, F.col("role").isNull(), F.coalesce("role", F.lit("")),
            F.col("text").isNull(), F.coalesce("text", F.lit(""))]
    low = F.lit(0xFFFFFFFF).cast("long")
    out = []
    for seed in (1, 2):
        h = F.xxhash64(F.lit(seed), *what)
        out += [h.bitwiseAND(low), F.shiftrightunsigned(h, 32)]
    return [h.alias(c) for h, c in zip(out, SUMS, strict=True)]


def numbered_prefixes(turns: DataFrame) -> DataFrame:
    """conv, pos (from 1), role, text and the rolling hash h1..h4 of each prefix."""
    block = F.floor(F.coalesce(F.col("turn"), F.lit((1 << 62))) / BLOCK).alias("block")
    t = turns.select("conv", "turn", "role", "text", block)
    inside = Window.partitionBy("conv", "block").orderBy(
        F.col("turn").asc_nulls_last(), F.col("role").asc_nulls_first(),
        F.col("text").asc_nulls_first())
    numbered = t.withColumn("rn", F.row_number().over(inside))
    sizes = t.groupBy("conv", "block").agg(F.count(F.lit(1)).alias("n"))
    over = (Window.partitionBy("conv").orderBy("block")
            .rowsBetween(Window.unboundedPreceding, -1))
    zero = F.lit(0).cast("long")
    starts = sizes.select(F.col("conv").alias("c"), F.col("block").alias("b"),
                          F.coalesce(F.sum("n").over(over), zero).alias("start"))
    same = F.col("conv").eqNullSafe(F.col("c")) & (F.col("block") == F.col("b"))
    placed = (numbered.join(starts, same).withColumn("pos", F.col("start") + F.col("rn"))
              .select("conv", "block", "pos", "role", "text", *turn_hashes(F.col("start")
                                                                           + F.col("rn"))))
    totals = placed.groupBy("conv", "block").agg(*[F.sum(c).alias(c) for c in SUMS])
    before = totals.select(F.col("conv").alias("c"), F.col("block").alias("b"), *[
        F.coalesce(F.sum(c).over(over), zero).alias(f"{c}_before") for c in SUMS])
    rolling = (Window.partitionBy("conv", "block").orderBy("pos")
               .rowsBetween(Window.unboundedPreceding, 0))
    return placed.join(before, same).select(
        "conv", "pos", "role", "text",
        *[(F.col(f"{c}_before") + F.sum(c).over(rolling)).alias(c) for c in SUMS])


def maximal_conversations(prefixes: DataFrame) -> DataFrame:
    """conv, n_turns, n_equal of the conversations that prefix no longer one."""
    whole = prefixes.groupBy("conv").agg(F.max(F.struct("pos", *SUMS)).alias("x")).select(
        "conv", F.col("x.pos").alias("pos"), *[F.col(f"x.{c}").alias(c) for c in SUMS])
    key = ["pos", *SUMS]
    ends = whole.select(F.col("conv").alias("c"), F.col("pos").alias("n_turns"))
    proper = (prefixes.join(ends, F.col("conv").eqNullSafe(F.col("c")))
              .filter(F.col("pos") < F.col("n_turns")).select(*key).distinct())
    distinct = whole.groupBy(*key).agg(
        F.min(F.struct(F.col("conv").isNull().alias("z"), F.col("conv").alias("conv"))).alias("m"),
        F.count(F.lit(1)).alias("n_equal"))
    return (distinct.join(proper, key, "left_anti")
            .select(F.col("m.conv").alias("conv"), F.col("pos").alias("n_turns"), "n_equal"))


def render_turn() -> Column:
    """One turn in the chat markup; markup inside a text is broken up."""
    plain = lambda c: F.replace(F.coalesce(F.col(c), F.lit("")), F.lit("<|"), F.lit("< |"))
    return F.concat(F.lit("<|im_start|>"), plain("role"), F.lit("\n"), plain("text"),
                    F.lit("<|im_end|>\n"))


def collapse_and_render(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn",
                        role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, part, n_turns, n_equal, rendered: the maximal conversations in
    parts of ``PART`` turns (a conversation's text is its parts in order).

    Turns go by number, null last; ties by role and text, repeated rows are
    turns of their own.  Null conv_id: one conversation with a null id.  Null
    and empty texts differ but render alike.  An empty table gives no rows.
    Other columns are ignored.
    """
    turns = conversations.select(F.col(conv_id).alias("conv"), F.col(turn).alias("turn"),
                                 F.col(role).alias("role"), F.col(text).alias("text"))
    prefixes = written(numbered_prefixes(turns), "chat-prefixes")
    kept = maximal_conversations(prefixes).withColumnRenamed("conv", "c")
    part = F.floor((F.col("pos") - 1) / PART).alias("part")
    segments = prefixes.join(kept, F.col("conv").eqNullSafe(F.col("c"))).select(
        "conv", part, "n_turns", "n_equal", F.struct("pos", render_turn().alias("s")).alias("x"))
    in_order = F.array_sort(F.collect_list("x"))
    return (segments.groupBy("conv", "part", "n_turns", "n_equal")
            .agg(F.array_join(F.transform(in_order, lambda x: x.s), "").alias("rendered"))
            .select(F.col("conv").alias("conv_id"), "part", "n_turns", "n_equal", "rendered"))


def op6_snapshot_collapse(spark, sf_dir: str) -> DataFrame:
    return collapse_and_render(table(spark, sf_dir, "conversations"))


ORACLE = """
WITH t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST,
           role NULLS FIRST, text NULLS FIRST) AS pos, role, text
  FROM conversations),
c AS (SELECT conv_id, count(*)::BIGINT AS n, list({'r': role, 't': text} ORDER BY pos) AS turns
      FROM t GROUP BY conv_id),
u AS (SELECT turns, n, min(conv_id) AS conv_id, count(*)::BIGINT AS n_equal
      FROM c GROUP BY turns, n),
p AS (SELECT DISTINCT turns[1:k] AS prefix FROM (SELECT turns, unnest(range(1, n)) AS k FROM u)),
m AS (SELECT * FROM u WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.prefix = u.turns))
SELECT t.conv_id, ((pos - 1) // 256)::BIGINT AS part, n AS n_turns, n_equal,
       string_agg('<|im_start|>' || replace(coalesce(role, ''), '<|', '< |') || chr(10)
         || replace(coalesce(text, ''), '<|', '< |') || '<|im_end|>' || chr(10), '' ORDER BY pos)
       AS rendered
FROM t JOIN m ON t.conv_id IS NOT DISTINCT FROM m.conv_id
GROUP BY t.conv_id, (pos - 1) // 256, n, n_equal
"""
