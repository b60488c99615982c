"""Mixing sources to target weights by Pareto order sampling (operator 2).

DataFrame functions only.  Every source gets a target number of words.  Inside
a source a document is expected ``m`` times, in proportion to its weight, at
most ``max_copies`` (what that cuts off goes to the lighter documents), so that
the expected words are the target.  ``floor(m)`` copies are certain.  The rest
is filled with one more copy of documents drawn in Pareto order: documents are
ranked by (random odds) / (odds of their inclusion probability ``m - floor(m)``)
and taken from the smallest on until the words are used up (the last one if
more than half of it fits).

A document that is large beside the rest would end such a draw early, or miss
by half its size.  So documents are drawn in strata by their size in eighths of
the rest, the largest first: each stratum is drawn up to the words expected of
it and of those before, less what these took, and the last up to the rest.  What
a large document misses or exceeds is made up for by smaller ones.

A hot source never meets in one task.  Its ranking variable is cut into about
sqrt(documents) bins; a window over the bins gives each bin's start, a window
inside one bin the order there, so both windows hold about sqrt(n) rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskstream.llm.common import n_words, table, written

WEIGHTS = (5, 2, 1)
MAX_COPIES = 3
SEED = "mix"
#: Without weights of their own, documents of fewer words than this weigh half.
SHORT_WORDS, SHORT_WEIGHT = 100, 0.5
#: Documents of more than 1/8, 1/64 and 1/512 of a source's rest are strata.
STRATA = (8, 64, 512)


def source_targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS,
                   max_copies: int = MAX_COPIES) -> DataFrame:
    """(source, source_size, ...) -> the same with ``target``.

    Sources by code point, null last, weigh ``weights``, repeating.  Targets
    share the sum of all sizes by weight.  A target above ``max_copies`` times
    its source's size stops there and the excess is shared again by weight:
    the sources by cap/weight ascending, a prefix of them is capped.
    One row per source: the windows below run over that small table.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cap = F.col("source_size") * F.lit(max_copies)
    w = F.element_at(F.array(*[F.lit(int(x)) for x in weights]),
                     ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    ranked = sources.withColumn("w", w.cast("long")).withColumn("cap", cap)
    order = Window.orderBy((F.col("cap") / F.col("w")).asc(),
                           F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    zero = F.lit(0).cast("long")
    filled = (ranked
              .withColumn("cap_before", F.coalesce(F.sum("cap").over(before), zero))
              .withColumn("w_before", F.coalesce(F.sum("w").over(before), zero))
              .withColumn("total", F.sum("source_size").over(everything))
              .withColumn("w_all", F.sum("w").over(everything))
              .withColumn("capped", (F.col("total") - F.col("cap_before")) * F.col("w")
                          >= F.col("cap") * (F.col("w_all") - F.col("w_before")))
              .withColumn("cap_used", F.sum(F.when(F.col("capped"), F.col("cap"))
                                            .otherwise(zero)).over(everything))
              .withColumn("w_used", F.sum(F.when(F.col("capped"), F.col("w"))
                                          .otherwise(zero)).over(everything)))
    level = (F.col("total") - F.col("cap_used")) / F.nullif(F.col("w_all") - F.col("w_used"),
                                                            F.lit(0))
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(F.col("w") * level)
    return filled.select(*sources.columns, F.coalesce(target, F.lit(0.0)).alias("target"))


def uniform(key: Column, seed: str) -> Column:
    """A number in (0, 1) that depends only on the key and the seed."""
    h = F.md5(F.concat(F.lit(seed + "|"), F.coalesce(key.cast("string"), F.lit("null"))))
    return (F.conv(F.substring(h, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))


def expected_copies(classes: DataFrame, targets: DataFrame, max_copies: int) -> DataFrame:
    """(k, dw, words, n_sized) -> the same with source_size, target, m: the copies
    expected of a document of source ``k`` and weight ``dw``; ``whole``, the
    certain ones; and ``rest``, the words of the target that they leave.

    ``m`` is in proportion to the weight; where that exceeds ``max_copies`` it
    stops there and the lighter documents take the rest.  The windows run over
    a source's distinct weights, which must be few.
    """
    heavy = Window.partitionBy("k").orderBy(F.col("dw").desc())
    before = heavy.rowsBetween(Window.unboundedPreceding, -1)
    after = heavy.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = heavy.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    zero = F.lit(0).cast("long")
    cap, load = F.col("words") * max_copies, F.col("dw") * F.col("words")
    c = (classes.join(targets.drop("source"), "k")
         .withColumn("capped", (F.col("target") - F.coalesce(F.sum(cap).over(before), zero))
                     * F.col("dw") >= F.sum(load).over(after) * max_copies)
         .withColumn("cap_used", F.sum(F.when(F.col("capped"), cap).otherwise(zero)).over(every))
         .withColumn("load_open", F.sum(F.when(F.col("capped"), 0.0).otherwise(load)).over(every)))
    m = F.col("dw") * (F.col("target") - F.col("cap_used")) / F.nullif("load_open", F.lit(0.0))
    m = F.when(F.col("capped"), float(max_copies)).otherwise(
        F.greatest(F.lit(0.0), F.least(F.lit(float(max_copies)), F.coalesce(m, F.lit(0.0)))))
    whole = F.floor("m").cast("long")
    return (c.withColumn("m", m).withColumn("whole", whole)
            .withColumn("rest", F.col("target") - F.sum(F.col("whole") * F.col("words")).over(every))
            .drop("capped", "cap_used", "load_open"))


def stratum_of(size: Column, rest: Column) -> Column:
    out = F.lit(len(STRATA))
    for i, part in reversed(list(enumerate(STRATA))):
        out = F.when(size * part > rest, i).otherwise(out)
    return out


def limits(order: DataFrame, sources: DataFrame) -> DataFrame:
    """k, stratum, limit: up to how many words a stratum is drawn.  ``order`` are
    the documents to draw with the words ``before`` each in its stratum,
    ``sources`` has the rest of each source."""
    last = len(STRATA)
    expected = (order.groupBy("k", "stratum", "lam").agg(F.sum("size").alias("words"))
                .groupBy("k").pivot("stratum", list(range(last)))
                .agg(F.sum(F.col("lam") * F.col("words"))))
    cuts = sources.join(expected, "k", "left").withColumn("used", F.lit(0).cast("long"))
    sofar = F.lit(0.0)
    for i in range(last):
        sofar = sofar + F.coalesce(F.col(str(i)), F.lit(0.0))
        cuts = cuts.withColumn(f"limit{i}", F.round(sofar, 3) - F.col("used"))
        got = (order.filter(F.col("stratum") == i).join(cuts.select("k", f"limit{i}"), "k")
               .filter(F.col("before") + F.col("size") / 2.0 <= F.col(f"limit{i}"))
               .groupBy("k").agg(F.max(F.col("before") + F.col("size")).alias("got")))
        cuts = (cuts.join(got, "k", "left")
                .withColumn("used", F.col("used") + F.coalesce("got", F.lit(0))).drop("got"))
    each = F.array(*[F.struct(F.lit(i).alias("stratum"), (F.col(f"limit{i}") if i < last else
                     F.col("rest") - F.col("used")).alias("limit")) for i in range(last + 1)])
    return cuts.select("k", F.inline(each))


def mix_to_targets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                   source: str = "source", weights: Sequence[int] = WEIGHTS,
                   max_copies: int = MAX_COPIES, seed: str = SEED,
                   doc_weight: str | None = None) -> DataFrame:
    """doc_id, tie (md5 of the text), size, source, source_size, target, copies,
    taken, one row per row of ``docs``.

    ``doc_weight`` names a column of positive weights of few distinct values;
    without it documents of fewer than ``SHORT_WORDS`` words weigh
    ``SHORT_WEIGHT`` and the others 1.  Inside a source inclusion is in
    proportion to the weight.

    Null text: size 0, nothing taken.  Null source: a source of its own, the
    last.  Null ids draw the same number; ties go by id, then by text digest.
    Repeated rows are rows of their own.  An empty table gives no rows.  Other
    columns are ignored.  A source whose documents are too few and too large to
    make up its target misses it by at most half its largest document.
    """
    sizes = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
        n_words(F.col(text)).alias("size"),
        (F.col(doc_weight) if doc_weight else F.lit(None)).cast("double").alias("dw"),
        F.md5(F.coalesce(F.col(text), F.lit(""))).alias("tie"))
    if not doc_weight:
        sizes = sizes.withColumn("dw", F.when(F.col("size") < SHORT_WORDS, SHORT_WEIGHT)
                                 .otherwise(1.0))
    k = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))
    narrow = written(sizes.withColumn("k", k), "mix-sizes")
    classes = narrow.groupBy("k", "source", "dw").agg(
        F.sum("size").alias("words"), F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("size") > 0).alias("n_sized"))
    targets = source_targets(classes.groupBy("k", "source").agg(
        F.sum("words").alias("source_size"), F.sum("n").alias("n_docs")), weights, max_copies)
    plan = expected_copies(classes.drop("source", "n"), targets, max_copies)
    # The mean probability scales the ranking variable, a constant factor of a
    # source, so that its bins fill evenly.
    lam, all_of = F.col("m") - F.col("whole"), Window.partitionBy("k")
    plan = written(plan.withColumn("lam", lam).withColumn(
        "lam_mean", F.sum(F.col("lam") * F.col("n_sized")).over(all_of)
        / F.nullif(F.sum("n_sized").over(all_of), F.lit(0)))
        .withColumn("n_bins", F.ceil(F.sqrt(F.col("n_docs").cast("double"))).cast("long")),
        "mix-plan")

    odds = lambda p: p / (1 - p)
    drawn = narrow.join(plan.drop("words", "n_sized", "n_docs"), ["k", "dw"])
    size = F.col("size")
    ranked = (drawn.withColumn("whole", F.when(size > 0, F.col("whole")).otherwise(0))
              .withColumn("u", uniform(F.col("doc_id"), seed))
              .withColumn("z", F.when((size > 0) & (F.col("lam") > 0), odds(F.col("u"))
                                      * (odds(F.col("lam_mean")) / odds(F.col("lam")))))
              .withColumn("stratum", F.when(F.col("z").isNotNull(),
                                            stratum_of(size, F.col("rest")))
                          .otherwise(len(STRATA) + 1))  # not drawn
              .withColumn("bin", F.least(F.col("n_bins") - 1, F.floor(
                  F.coalesce(F.col("z") / (F.col("z") + 1), F.col("u")) * F.col("n_bins")))))
    over_bins = (Window.partitionBy("k", "stratum").orderBy("bin")
                 .rowsBetween(Window.unboundedPreceding, -1))
    nothing = F.lit(0).cast("long")
    starts = ranked.groupBy("k", "stratum", "bin").agg(F.sum("size").alias("bin_size")).select(
        "k", "stratum", "bin",
        F.coalesce(F.sum("bin_size").over(over_bins), nothing).alias("bin_start"))
    inside = (Window.partitionBy("k", "stratum", "bin")
              .orderBy(F.col("z").asc_nulls_last(), F.col("doc_id").asc_nulls_first(), "tie")
              .rowsBetween(Window.unboundedPreceding, -1))
    in_bin = F.coalesce(F.sum("size").over(inside), nothing)
    placed = written(
        ranked.withColumn("in_bin", in_bin).join(starts, ["k", "stratum", "bin"]).select(
            "doc_id", "tie", "size", "k", "source", "source_size", "target", "whole", "lam",
            "stratum", (F.col("bin_start") + F.col("in_bin")).alias("before")), "mix-order")
    upto = limits(placed.filter(F.col("stratum") <= len(STRATA)),
                  plan.select("k", "rest").distinct())
    one_more = F.coalesce(F.col("before") + size / 2.0 <= F.col("limit"), F.lit(False))
    copies = F.col("whole") + F.when(one_more, 1).otherwise(0)
    return placed.join(upto, ["k", "stratum"], "left").select(
        "doc_id", "tie", "size", "source", "source_size", "target",
        copies.cast("long").alias("copies"), (copies * size).cast("long").alias("taken"))


def mixed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
          **options) -> DataFrame:
    """The rows of ``docs`` that the mix takes, with ``copies``.  Rows equal in
    id and text are given once, with the sum of their copies."""
    got = mix_to_targets(docs, doc_id, text, source, **options)
    copies = got.groupBy("doc_id", "tie").agg(F.sum("copies").alias("copies_")).filter("copies_ > 0")
    names = docs.columns
    d = docs.toDF(*[f"c{i}" for i in range(len(names))])
    key, body = F.col(f"c{names.index(doc_id)}"), F.col(f"c{names.index(text)}")
    d = d.withColumn("t_", F.md5(F.coalesce(body, F.lit("")))).dropDuplicates(
        [f"c{names.index(doc_id)}", "t_"])
    return d.join(copies, key.eqNullSafe(F.col("doc_id")) & (F.col("t_") == F.col("tie"))).select(
        *[f"c{i}" for i in range(len(names))], "copies_").toDF(*names, "copies")


def op2_pareto_mixing(spark, sf_dir: str) -> DataFrame:
    return mix_to_targets(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "copies")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, md5(coalesce(text, '')) AS tie,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         (('0x' || substr(md5('mix|' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT::DOUBLE
          + 0.5) / 4503599627370496.0 AS u
  FROM documents),
w AS (SELECT *, CASE WHEN size < 100 THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END AS dw FROM d),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3 + 1] AS w
  FROM d GROUP BY source),
f AS (
  SELECT *, 3 * source_size AS cap, (sum(source_size) OVER ())::BIGINT AS total,
         (sum(w) OVER ())::BIGINT AS w_all,
         coalesce(sum(3 * source_size) OVER o, 0)::BIGINT AS cap_before,
         coalesce(sum(w) OVER o, 0)::BIGINT AS w_before
  FROM s WINDOW o AS (ORDER BY 3 * source_size / w, source NULLS LAST
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
g AS (SELECT *, (total - cap_before) * w >= cap * (w_all - w_before) AS capped FROM f),
t AS (
  SELECT source, source_size, coalesce(CASE WHEN capped THEN cap::DOUBLE ELSE
           w * ((total - sum(CASE WHEN capped THEN cap ELSE 0 END) OVER ())::DOUBLE
           / nullif(w_all - sum(CASE WHEN capped THEN w ELSE 0 END) OVER (), 0)::DOUBLE) END, 0.0)
           AS target
  FROM g),
-- Classes of a source: the heavier documents first; what three copies of them
-- can't take goes to the lighter ones.
c0 AS (
  SELECT source, dw, sum(size)::BIGINT AS words FROM w GROUP BY source, dw),
c1 AS (
  SELECT c0.*, t.source_size, t.target,
         (t.target - coalesce(sum(3 * words) OVER (h ROWS BETWEEN UNBOUNDED PRECEDING
                                                   AND 1 PRECEDING), 0)::BIGINT) * dw
         >= sum(dw * words) OVER (h ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) * 3 AS capped
  FROM c0 JOIN t ON c0.source IS NOT DISTINCT FROM t.source
  WINDOW h AS (PARTITION BY c0.source ORDER BY dw DESC)),
c2 AS (
  SELECT *, CASE WHEN capped THEN 3.0::DOUBLE ELSE greatest(0.0::DOUBLE, least(3.0::DOUBLE,
           coalesce(dw * (target - (sum(CASE WHEN capped THEN 3 * words ELSE 0 END)
                                    OVER (PARTITION BY source))::BIGINT)
                    / nullif(sum(CASE WHEN capped THEN 0.0::DOUBLE ELSE dw * words END)
                             OVER (PARTITION BY source), 0.0::DOUBLE), 0.0::DOUBLE))) END AS m
  FROM c1),
c AS (
  SELECT source, dw, source_size, target, floor(m)::BIGINT AS whole, m - floor(m) AS lam,
         target - (sum(floor(m)::BIGINT * words) OVER (PARTITION BY source))::BIGINT AS rest
  FROM c2),
q AS (
  SELECT w.doc_id, w.source, w.size, w.tie, c.source_size, c.target, c.lam, c.rest,
         CASE WHEN size > 0 THEN whole ELSE 0 END AS whole,
         CASE WHEN size > 0 AND lam > 0 THEN u / (1 - u) / (lam / (1 - lam)) END AS z,
         CASE WHEN NOT (size > 0 AND lam > 0) THEN 4 WHEN size * 8 > rest THEN 0
              WHEN size * 64 > rest THEN 1 WHEN size * 512 > rest THEN 2 ELSE 3 END AS stratum
  FROM w JOIN c ON w.source IS NOT DISTINCT FROM c.source AND w.dw = c.dw),
r AS (
  SELECT *, coalesce(sum(size) OVER (
           PARTITION BY source, stratum ORDER BY z NULLS LAST, doc_id NULLS FIRST, tie
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM q),
e AS (
  SELECT source, rest, coalesce(sum(lam * words) FILTER (stratum = 0), 0) AS e0,
         coalesce(sum(lam * words) FILTER (stratum = 1), 0) AS e1,
         coalesce(sum(lam * words) FILTER (stratum = 2), 0) AS e2
  FROM (SELECT source, rest, stratum, lam, sum(size)::BIGINT AS words FROM r
        GROUP BY source, rest, stratum, lam) GROUP BY source, rest),
l0 AS (
  SELECT *, round(e0, 3) AS limit0, coalesce((
    SELECT max(before + size) FROM r WHERE r.source IS NOT DISTINCT FROM e.source AND stratum = 0
      AND before + size / 2.0::DOUBLE <= round(e0, 3)), 0) AS used0 FROM e),
l1 AS (
  SELECT *, round(e0 + e1, 3) - used0 AS limit1, used0 + coalesce((
    SELECT max(before + size) FROM r WHERE r.source IS NOT DISTINCT FROM l0.source AND stratum = 1
      AND before + size / 2.0::DOUBLE <= round(e0 + e1, 3) - used0), 0) AS used1 FROM l0),
l2 AS (
  SELECT *, round(e0 + e1 + e2, 3) - used1 AS limit2, used1 + coalesce((
    SELECT max(before + size) FROM r WHERE r.source IS NOT DISTINCT FROM l1.source AND stratum = 2
      AND before + size / 2.0::DOUBLE <= round(e0 + e1 + e2, 3) - used1), 0) AS used2 FROM l1),
x AS (
  SELECT r.*, whole + CASE WHEN before + size / 2.0::DOUBLE <= CASE stratum
           WHEN 0 THEN limit0 WHEN 1 THEN limit1 WHEN 2 THEN limit2 WHEN 3 THEN l2.rest - used2 END
           THEN 1 ELSE 0 END AS n
  FROM r JOIN l2 ON r.source IS NOT DISTINCT FROM l2.source)
SELECT doc_id, size, source_size, target, (n * size)::BIGINT AS taken, n::BIGINT AS copies FROM x
"""
