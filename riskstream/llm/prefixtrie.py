"""Prefix trie of rebuilt conversations with a minimal-perfect-hash node table
(operator 11).

A node is a distinct sequence of first turns, known by a 128-bit digest: sums of
hashes of (place, role, text).  Spark enumerates the distinct digests and counts
their members before the shuffle.

Subtree figures come from shards.  A subtree whose members have at most ``limit``
rows goes to a shard as a whole; nodes above (upper nodes) are few, at most rows
/ limit at a depth.  A shard builds a minimal perfect hash of its digests, checks
every slot against the digest in it, scatters the nodes' counts into flat arrays
by slot, and adds them up through the array of parent slots from the deepest
level up.  What the subtrees add to their parents is summed in Spark; upper
nodes follow in bands of levels, the deepest first, with the same arrays.

A conversation, a first turn or an id list that holds a third of all rows is
split: turns are numbered in ranges, prefix sums go by blocks, and ids are
packed by ranges before they are hashed as a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskstream.llm.common import small_batches, table, written

#: Member rows of a subtree that one shard may take at least; with more rows in
#: all, rows / 2^WIDTH_BITS.  So no level has more than 2^WIDTH_BITS upper nodes.
SUBTREE_ROWS = 1 << 14
WIDTH_BITS = 18
#: Upper nodes of one band of levels, and nodes of a shard on average.
BAND_NODES = 1 << 20
SHARD_NODES = 1 << 16
#: Turns of a block of prefix sums, and ids of a range of ends.
BLOCK = 1 << 12
ID_RANGE = 1 << 16
#: Fixed values of the rebuilding: group of ids, and the modulus of shared turns.
GROUP, SHARED = 100, 6

SUMS = ["s1", "s2", "s3", "s4"]
KEY = ["depth", "k1", "k2"]
EMPTY_HASH = hashlib.sha256(b"").hexdigest()


# --- the node table, in tasks --------------------------------------------------

class NodeTable:
    """Minimal perfect hash of digests: n keys, slots 0 to n - 1.

    Level by level, keys that are alone at their place get that place; the others
    go on to the next level.  A slot holds its digest, so that a key that isn't
    in the table is found out, and two nodes never share a slot.
    """

    def __init__(self, keys: np.ndarray):
        """``keys``: rows of three 64-bit numbers (depth and digest)."""
        self.levels, self.keys = [], np.empty_like(keys)
        rest, base = np.arange(len(keys)), 0
        while len(rest):
            if len(self.levels) == 64:
                raise ValueError("a digest stands twice among the nodes")
            places = len(rest) + (len(rest) >> 1) + 1
            at = self._place(keys[rest], len(self.levels), places)
            alone = np.bincount(at, minlength=places)[at] == 1
            slot = np.full(places, -1, np.int64)
            taken = np.sort(at[alone])
            slot[taken] = base + np.arange(len(taken))
            self.keys[slot[at[alone]]] = keys[rest[alone]]
            self.levels.append(slot)
            rest, base = rest[~alone], base + len(taken)

    @staticmethod
    def _place(keys: np.ndarray, level: int, places: int) -> np.ndarray:
        k = keys.astype(np.uint64)
        salt = np.uint64((level + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
        h = k[:, 1] ^ (k[:, 2] + salt) ^ k[:, 0]
        for shift in (30, 27):
            h = (h ^ (h >> np.uint64(shift))) * np.uint64(0xBF58476D1CE4E5B9)
        return ((h ^ (h >> np.uint64(31))) % np.uint64(places)).astype(np.int64)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Each key's slot, -1 if it is not in the table."""
        out, rest = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, slot in enumerate(self.levels):
            found = slot[self._place(keys[rest], level, len(slot))]
            out[rest] = found
            rest = rest[found < 0]
        known = out >= 0
        known[known] = (self.keys[out[known]] == keys[known]).all(axis=1)
        return np.where(known, out, -1)


SUMMED = ("depth long, k1 long, k2 long, p1 long, p2 long, conv_id long, parent_conv_id long, "
          "n_convs long, n_children long, n_leaves long, saved_tokens long, inner boolean")


def summed(nodes: pd.DataFrame) -> pd.DataFrame:
    """applyInPandas function: a shard's nodes with figures of their subtrees.

    Nodes come with what subtrees outside add to them (``children``, ``leaves``,
    ``saved``).  ``inner`` says whether the parent is in the shard as well.
    """
    keys = nodes[KEY].to_numpy(np.int64)
    table_ = NodeTable(keys)
    n = len(keys)
    slot = table_.slots(keys)

    def scattered(values) -> np.ndarray:
        out = np.empty(n, np.int64)
        out[slot] = np.asarray(values, np.int64)
        return out

    up = nodes[["depth", "p1", "p2"]].to_numpy(np.int64)
    up[:, 0] -= 1
    parent = scattered(np.where(up[:, 0] >= 0, table_.slots(up), -1))
    depth, conv = scattered(nodes["depth"]), scattered(nodes["conv_id"])
    n_convs = scattered(nodes["n_convs"])
    leaves = scattered(nodes["leaves"] + nodes["leaf"])
    saved = scattered(nodes["saved"]) + (n_convs - 1) * scattered(nodes["len"])
    inner = parent >= 0
    children = scattered(nodes["children"]) + np.bincount(parent[inner], minlength=n)
    order = np.argsort(-depth, kind="stable")
    order = order[inner[order]]
    for level in np.split(order, np.flatnonzero(np.diff(depth[order])) + 1):
        np.add.at(leaves, parent[level], leaves[level])
        np.add.at(saved, parent[level], saved[level])
    above = np.where(inner, conv[np.maximum(parent, 0)], 0)[slot]
    out = nodes[[*KEY, "p1", "p2", "conv_id", "n_convs"]].copy()
    out["parent_conv_id"] = pd.array(above, "Int64")
    out.loc[~inner[slot], "parent_conv_id"] = None
    out["n_children"], out["n_leaves"] = children[slot], leaves[slot]
    out["saved_tokens"], out["inner"] = saved[slot], inner[slot]
    return out[[c.split()[0] for c in SUMMED.split(", ")]]


def hashed_ids(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """mapInPandas function: rows in order of key and range to one SHA-256 of the
    comma-joined ids of each key; only one hash is open at a time."""
    key, state = None, None
    for f in frames:
        done = []
        for *now, said in zip(f["depth"], f["k1"], f["k2"], f["ids"], strict=True):
            if now == key:
                state.update(b"," + said.encode())
                continue
            if key is not None:
                done.append((*key, state.hexdigest()))
            key, state = now, hashlib.sha256(said.encode())
        yield pd.DataFrame(done, columns=[*KEY, "ends_sha256"])
    if key is not None:
        yield pd.DataFrame([(*key, state.hexdigest())], columns=[*KEY, "ends_sha256"])


# --- rows, in Spark ------------------------------------------------------------

def numbered(turns: DataFrame) -> DataFrame:
    """conv, j (from 1, by turn, null first; ties by role and text), w1, w2, len."""
    order = [F.col("turn").asc_nulls_first(), "role", "text", "tie"]
    rows = turns.withColumn("tie", F.monotonically_increasing_id())
    ranged = (rows.repartitionByRange("conv", *order).withColumn("range", F.spark_partition_id())
              .withColumn("w1", F.xxhash64(F.lit(1), "role", "text"))
              .withColumn("w2", F.xxhash64(F.lit(2), "text", "role"))
              .withColumn("len", F.length("text").cast("long")))
    inside = Window.partitionBy("conv", "range").orderBy(*order)
    rows = written(ranged, "trie-turns")
    over = Window.partitionBy("conv").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("conv", "range").agg(F.count(F.lit(1)).alias("n")).select(
        "conv", "range", F.coalesce(F.sum("n").over(over), F.lit(0)).alias("start"))
    return (rows.withColumn("rn", F.row_number().over(inside)).join(starts, ["conv", "range"])
            .select("conv", (F.col("start") + F.col("rn")).alias("j"), "w1", "w2", "len"))


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(c, pos, w1, w2, len) of rebuilt turns, and (c, length) of conversations."""
    own = written(numbered(conversations), "trie-numbered")
    counts = own.groupBy("conv").agg(F.count(F.lit(1)).alias("n"))
    c = F.col("conv")
    ids = counts.select("conv", "n", (c - c % GROUP).alias("first"),
                        (F.crc32(c.cast("string").cast("binary")) % SHARED).alias("h"))
    first = counts.select(F.col("conv").alias("first"), F.col("n").alias("first_n"))
    shared = F.least(F.col("h"), F.coalesce("first_n", F.lit(0)))
    convs = written(ids.join(first, "first", "left").withColumn("shared", shared), "trie-convs")
    theirs = own.filter((c % GROUP == 0) & (F.col("j") < SHARED)).withColumnRenamed("conv", "first")
    begun = (convs.select(c.alias("c"), "first", "h").join(theirs, "first")
             .filter(F.col("j") <= F.col("h")).select("c", F.col("j").alias("pos"), "w1", "w2", "len"))
    rest = (own.join(convs.select("conv", "h", "shared"), "conv").filter(F.col("j") > F.col("h"))
            .select(c.alias("c"), (F.col("j") - F.col("h") + F.col("shared")).alias("pos"),
                    "w1", "w2", "len"))
    length = F.col("shared") + F.greatest(F.col("n") - F.col("h"), F.lit(0))
    return begun.unionByName(rest), convs.select(c.alias("c"), length.alias("length"))


def digests(sums: list[Column]) -> list[Column]:
    """Two 64-bit numbers of four sums modulo 2^32."""
    low = F.lit(0xFFFFFFFF).cast("long")
    parts = [s.bitwiseAND(low) for s in sums]
    return [F.shiftleft(parts[i], 32).bitwiseOR(parts[i + 1]) for i in (0, 2)]


def members(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """(c, depth, k1, k2, p1, p2, len, length): a row for every conversation and
    depth, with the digests of its first turns and of one turn fewer."""
    block = F.floor(F.col("pos") / BLOCK).alias("block")
    low = F.lit(0xFFFFFFFF).cast("long")
    one, two = F.xxhash64("pos", "w1"), F.xxhash64("w2", "pos")
    parts = [one.bitwiseAND(low), F.shiftrightunsigned(one, 32),
             two.bitwiseAND(low), F.shiftrightunsigned(two, 32)]
    t = turns.select("c", "pos", "len", block, *[p.alias(s) for p, s in zip(parts, SUMS, strict=True)])
    over = Window.partitionBy("c").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = t.groupBy("c", "block").agg(*[F.sum(s).alias(s) for s in SUMS]).select(
        "c", "block", *[F.coalesce(F.sum(s).over(over), F.lit(0)).alias(f"{s}_before") for s in SUMS])
    run = Window.partitionBy("c", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    t = t.select("*", *[F.sum(s).over(run).alias(f"{s}_run") for s in SUMS]).join(
        before, ["c", "block"])
    upto = [F.col(f"{s}_before") + F.col(f"{s}_run") for s in SUMS]
    k1, k2 = digests(upto)
    p1, p2 = digests([u - F.col(s) for u, s in zip(upto, SUMS, strict=True)])
    zero = F.lit(0).cast("long")
    rows = t.select("c", F.col("pos").alias("depth"), k1.alias("k1"), k2.alias("k2"),
                    p1.alias("p1"), p2.alias("p2"), "len").join(lengths, "c")
    roots = lengths.select("c", *[zero.alias(x) for x in ("depth", "k1", "k2", "p1", "p2", "len")],
                           "length")
    return rows.unionByName(roots)


def ends_of(rows: DataFrame) -> DataFrame:
    """depth, k1, k2, ends_sha256 of nodes at which conversations end."""
    ended = rows.filter(F.col("depth") == F.col("length"))
    packed = (ended.groupBy(*KEY, F.floor(F.col("c") / ID_RANGE).alias("range"))
              .agg(F.array_join(F.sort_array(F.collect_list("c")).cast("array<string>"), ",")
                   .alias("ids")))
    return (packed.repartition(*KEY).sortWithinPartitions(*KEY, "range")
            .mapInPandas(hashed_ids, "depth long, k1 long, k2 long, ends_sha256 string"))


NOTHING = ["children", "leaves", "saved"]


def added(nodes: DataFrame) -> DataFrame:
    """What nodes whose parent is in another shard add to it."""
    return nodes.filter(~F.col("inner") & (F.col("depth") > 0)).select(
        (F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2"),
        F.lit(1).cast("long").alias("children"), F.col("n_leaves").alias("leaves"),
        F.col("saved_tokens").alias("saved"))


def prefix_trie(conversations: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn",
                role: str = "role", text: str = "text", subtree_rows: int = SUBTREE_ROWS,
                band_nodes: int = BAND_NODES) -> DataFrame:
    """A row for every node: conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256.

    Turns go by number, null first, ties by role and text; repeated rows are
    turns of their own.  Null role and text are empty; rows without conv_id
    belong to no conversation.  An empty table gives no rows.  Other columns are
    ignored, whatever their names.
    """
    small_batches(conversations.sparkSession, 4096)
    given = conversations.filter(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv"), F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"))
    turns, lengths = rebuilt(given)
    rows = written(members(turns, lengths), "trie-rows")
    nodes = rows.groupBy(*KEY).agg(
        F.min("c").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"),
        F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.max("len").alias("len"),
        (F.max("length") == F.col("depth")).cast("long").alias("leaf"),
        F.sum(F.col("length") - F.col("depth") + 1).alias("weight"))
    nodes = written(nodes, "trie-nodes")
    total = rows.count()
    limit = max(subtree_rows, total >> WIDTH_BITS)
    is_upper = F.col("weight") > limit
    upper, lower = nodes.filter(is_upper).drop("weight"), nodes.filter(~is_upper).drop("weight")

    # The root of a lower node's subtree: one below the last upper node on the
    # path of the conversation that the node is named by.
    last = (rows.join(upper.select(*KEY), KEY, "left_semi").groupBy("c")
            .agg(F.max("depth").alias("last")))
    tops = (rows.select("c", "depth", "k1", "k2").join(last, "c", "left")
            .filter(F.col("depth") == F.coalesce("last", F.lit(-1)) + 1)
            .select(F.col("c").alias("conv_id"), F.xxhash64(*KEY).alias("top")))
    shards = max(8, total // SHARD_NODES + 1)
    no = [F.lit(0).cast("long").alias(c) for c in NOTHING]
    sharded = lower.join(tops, "conv_id").select("*", *no)
    done = [written(sharded.groupBy(F.pmod("top", F.lit(shards)).alias("shard"))
                    .applyInPandas(summed, SUMMED), "trie-shards")]
    sums = lambda frames: _union(map(added, frames)).groupBy(*KEY).agg(
        *[F.sum(c).alias(c) for c in NOTHING])
    levels = max(1, band_nodes // max(1, min(1 << WIDTH_BITS, total // limit + 1)))
    deepest = upper.agg(F.max("depth")).first()[0]
    for band in range(deepest // levels if deepest is not None else -1, -1, -1):
        here = upper.filter(F.col("depth").between(band * levels, (band + 1) * levels - 1))
        filled = here.join(sums(done[:1] + done[-1:] if len(done) > 1 else done), KEY, "left")
        one = filled.select(*here.columns, *[F.coalesce(c, F.lit(0)).alias(c) for c in NOTHING])
        done.append(written(one.groupBy(F.lit(0).alias("band")).applyInPandas(summed, SUMMED),
                            "trie-band"))

    all_nodes = _union(done)
    parents = upper.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"),
                           F.col("k2").alias("p2"), F.col("conv_id").alias("above"))
    outer = all_nodes.filter(~F.col("inner")).join(parents, ["depth", "p1", "p2"], "left")
    cols = [*KEY, "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    above = F.when(F.col("depth") > 0, F.col("above")).alias("parent_conv_id")
    out = all_nodes.filter("inner").select(*cols, "parent_conv_id").unionByName(
        outer.select(*cols, above))
    out = out.join(ends_of(rows), KEY, "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                      "saved_tokens", F.coalesce("ends_sha256", F.lit(EMPTY_HASH)).alias("ends_sha256"))


def _union(frames) -> DataFrame:
    first, *rest = frames
    for f in rest:
        first = first.unionByName(f)
    return first


def op11_prefix_trie(spark, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


ORACLE = """
WITH RECURSIVE ids AS (
  SELECT DISTINCT conv_id AS c, conv_id::VARCHAR AS s FROM conversations WHERE conv_id IS NOT NULL),
crc(c, s, k, v) AS (
  SELECT c, s, 0, 4294967295::BIGINT FROM ids
  UNION ALL
  SELECT c, s, k + 1, xor(x >> 1, 3988292384 * (x & 1)) FROM (
    SELECT c, s, k, CASE WHEN k % 8 = 0 THEN xor(v, ascii(substr(s, k // 8 + 1, 1))::BIGINT)
                    ELSE v END AS x
    FROM crc WHERE k < 8 * length(s)) AS step),
h AS (SELECT c, xor(v, 4294967295::BIGINT) % 6 AS h FROM crc WHERE k = 8 * length(s)),
own AS (
  SELECT conv_id AS c, list({'r': coalesce(role, ''), 't': coalesce(text, '')}
           ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS ts
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
whole AS (
  SELECT own.c, list_concat(CASE WHEN f.ts IS NULL OR h = 0 THEN [] ELSE f.ts[1:h] END,
                            CASE WHEN h >= len(own.ts) THEN [] ELSE own.ts[h + 1:] END) AS ts
  FROM own JOIN h ON h.c = own.c LEFT JOIN own AS f ON f.c = own.c - own.c % 100),
m AS (SELECT c, ts, len(ts)::BIGINT AS n, unnest(range(0, len(ts) + 1)) AS d FROM whole),
p AS (SELECT c, d, n, CASE WHEN d = 0 THEN [] ELSE ts[1:d] END AS pre FROM m),
node AS (
  SELECT d, pre, min(c) AS conv_id, count(*)::BIGINT AS n_convs, max(n) = d AS leaf,
         sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE n = d), '')) AS ends,
         CASE WHEN d = 0 THEN 0 ELSE (count(*) - 1) * length(pre[d].t) END AS saved
  FROM p GROUP BY d, pre),
path AS (
  SELECT k, CASE WHEN k = 0 THEN [] ELSE pre[1:k] END AS up, d, leaf, saved
  FROM (SELECT *, unnest(range(0, d + 1)) AS k FROM node) AS every),
total AS (
  SELECT k, up, sum(leaf::INT)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens,
         sum((d = k + 1)::INT)::BIGINT AS n_children
  FROM path GROUP BY k, up)
SELECT node.conv_id, node.d::BIGINT AS depth, above.conv_id AS parent_conv_id, node.n_convs,
       n_children, n_leaves, saved_tokens, node.ends AS ends_sha256
FROM node JOIN total ON total.k = node.d AND total.up = node.pre
LEFT JOIN node AS above ON above.d = node.d - 1
  AND above.pre = CASE WHEN node.d <= 1 THEN [] ELSE node.pre[1:node.d - 1] END
"""
