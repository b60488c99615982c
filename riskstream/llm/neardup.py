"""Near-duplicate classes by min-max hashing (operator 3).

A document's set is its distinct word shingles.  Under each permutation both
the minimum and the maximum of the set are kept, so ``PERMS`` hash evaluations
give 2 x PERMS signature values; they are banded (the two values of one
permutation never share a band).  20 bands of 5 values miss a pair at similarity
0.85 with probability 8e-6; below 0.85, 25 bands of 4 miss one at 0.8 with 2e-6.

Documents with equal sets are one node from the start.  Nodes that share a
band are confirmed on their full sets, never all with all: in each round every
bucket picks one member as its centre and only members of another component
are compared with it.  Buckets whose members are all of one component are
done.  Buckets that stay open after ``STAR_ROUNDS`` go to an exact stage that
compares the members of different components, block by block, inside tasks; a
bound on the intersection, from histograms, rules out most pairs at once.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskstream.llm.common import LOWER, small_batches, table, written

SHINGLE = 3
PERMS = 50
THRESHOLD = 85  # percent
STAR_ROUNDS = 3
BLOCK = 256
BINS = 256  # of a set's histogram; a power of two
SALTS = 64

_rng = np.random.Generator(np.random.PCG64(20))
MULT = _rng.integers(0, 2 ** 63, PERMS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
ADD = _rng.integers(0, 2 ** 64, PERMS, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (the finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(LOWER).split() if text else []


def shingle_set(text: str | None, size: int = SHINGLE) -> frozenset[bytes]:
    w = words_of(text)
    if len(w) <= size:
        return frozenset([b" ".join(w)] if w else [])
    return frozenset(map(b" ".join, zip(*(w[i:] for i in range(size)), strict=False)))


def hashed_sets(texts: list[str | None], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct 64-bit shingle hashes of all texts one after the other, and
    how many each text has."""
    docs = [words_of(t) for t in texts]
    lengths = np.array([len(d) for d in docs], np.int64)
    total = int(lengths.sum())
    if not total:
        return np.empty(0, np.uint64), np.zeros(len(docs), np.int64)
    ids: dict[bytes, int] = {}
    code = np.fromiter((ids.setdefault(w, len(ids)) for d in docs for w in d), np.int64, total)
    hashes = pd.util.hash_array(np.array(list(ids), dtype=object), categorize=False)
    h = hashes[code]
    doc = np.repeat(np.arange(len(docs)), lengths)
    at = np.arange(total) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    left = np.repeat(lengths, lengths) - at  # words from here to the end
    x = np.zeros(total, np.uint64)
    for i in range(size):
        shifted = np.zeros(total, np.uint64)
        shifted[:total - i] = h[i:] if i else h
        shifted[left <= i] = np.uint64(0x5851F42D4C957F2D)  # past the end of a short text
        x = mix(x * np.uint64(0x9E3779B97F4A7C15) + shifted + np.uint64(i + 1))
    keep = (left >= size) | ((at == 0) & (np.repeat(lengths, lengths) < size))
    x, doc = x[keep], doc[keep]
    order = np.lexsort((x, doc))
    x, doc = x[order], doc[order]
    new = np.ones(len(x), bool)
    new[1:] = (x[1:] != x[:-1]) | (doc[1:] != doc[:-1])
    return x[new], np.bincount(doc[new], minlength=len(docs))


def band_layout(threshold: int) -> list[list[int]]:
    """Which of the values (PERMS minima, then PERMS maxima) make each band."""
    if threshold >= 85:
        return [list(range(b, 2 * PERMS, 20)) for b in range(20)]
    return [[b, b + 25, PERMS + (b + 12) % 50, PERMS + (b + 37) % 50] for b in range(25)]


def band_keys(x: np.ndarray, starts: np.ndarray, threshold: int = THRESHOLD) -> np.ndarray:
    """(texts, bands) keys of the min-max signatures of non-empty sets."""
    values = np.empty((2 * PERMS, len(starts)), np.uint64)
    for p in range(PERMS):
        v = x * MULT[p] + ADD[p]
        values[p] = np.minimum.reduceat(v, starts)
        values[PERMS + p] = np.maximum.reduceat(v, starts)
    layout = band_layout(threshold)
    keys = np.empty((len(starts), len(layout)), np.uint64)
    for b, rows in enumerate(layout):
        k = np.full(len(starts), b + 1, np.uint64)
        for row in rows:
            k = mix(k * np.uint64(0x9E3779B97F4A7C15) + values[row])
        keys[:, b] = k
    return keys


def _signatures(size: int, threshold: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            x, counts = hashed_sets(list(pdf["t_"]), size)
            node = np.full(len(pdf), "", object)
            bands: list = [[] for _ in range(len(pdf))]
            full = np.flatnonzero(counts)
            if len(full):
                starts = np.concatenate(([0], np.cumsum(counts[full])[:-1]))
                one = np.add.reduceat(x, starts)
                two = np.add.reduceat(mix(x ^ np.uint64(0xA5A5A5A5A5A5A5A5)), starts)
                keys = band_keys(x, starts, threshold).view(np.int64)
                for j, i in enumerate(full):
                    node[i] = f"{int(one[j]):016x}{int(two[j]):016x}"
                    # Sets n and n + 1 reach the threshold only from some size on.
                    small = counts[i] * (100 - threshold) < threshold
                    bands[i] = [] if small else keys[j]
            yield pd.DataFrame({"doc_id": pdf["d_"], "tk": pdf["tk_"], "n": counts, "node": node,
                                "bands": bands})
    return run


def signatures(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
               size: int = SHINGLE, threshold: int = THRESHOLD) -> DataFrame:
    """doc_id, tk (text digest), n (set size), node (set digest, empty for no
    set) and bands of every row."""
    small_batches(docs.sparkSession, 256)
    d = docs.select(F.col(doc_id).cast("string").alias("d_"), F.md5(F.col(text)).alias("tk_"),
                    F.col(text).alias("t_"))
    got = d.mapInPandas(_signatures(size, threshold),
                        "doc_id string, tk string, n long, node string, bands array<long>")
    return got.withColumn("doc_id", F.col("doc_id").cast("long"))


def linked(a: frozenset, b: frozenset, threshold: int = THRESHOLD) -> bool:
    both = len(a & b)
    return 100 * both >= threshold * (len(a) + len(b) - both)


def _compare(size: int, threshold: int):
    """Rows (center, salt) sorted with the centre's own text first."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        center, base = None, frozenset()
        for pdf in batches:
            out = []
            for c, s, node, text in zip(pdf["center"], pdf["salt"], pdf["node"], pdf["text"],
                                        strict=True):
                if node == c:
                    center, base = (c, s), shingle_set(text, size)
                elif center != (c, s):
                    raise ValueError("a group without the text of its centre")
                elif linked(base, shingle_set(text, size), threshold):
                    out.append((c, node))
            yield pd.DataFrame(out, columns=["a", "b"], dtype=object)
    return run


def confirm(pairs: DataFrame, texts: DataFrame, size: int, threshold: int) -> DataFrame:
    """(center, node) -> linked (a, b).  Members meet their centre's set in
    salted groups; a text is moved once per pair, a centre's once per salt."""
    salt = F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int")
    p = pairs.withColumn("salt", salt)
    own = p.select("center", "salt").distinct().select(
        "center", F.col("center").alias("node"), "salt")
    rows = p.select("center", "node", "salt").unionByName(own).join(texts, "node")
    first = F.col("node") != F.col("center")
    dealt = (rows.select("center", "salt", "node", "text").repartition("center", "salt")
             .sortWithinPartitions("center", "salt", first, "node"))
    return dealt.mapInPandas(_compare(size, threshold), "a string, b string")


def components(links: DataFrame) -> DataFrame:
    """(a, b) -> (node, label), label the smallest node reachable, by
    alternating large-star and small-star rounds on written edge tables until
    all that is left are stars."""
    def norm(e: DataFrame) -> DataFrame:
        return e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter(
            "a != b").distinct()

    def stars(e: DataFrame) -> bool:
        """Has every node at most one smaller one, which has none itself?"""
        ends = e.select(F.col("a").alias("v"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
            e.select(F.col("b").alias("v"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        open_ = ends.groupBy("v").agg(F.sum("up").alias("up"), F.max("down").alias("down")).filter(
            F.col("up") + F.col("down") > 1)
        return not open_.agg(F.count(F.lit(1))).first()[0]

    edges = written(norm(links), "neardup-edges")
    while not stars(edges):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = norm(both.join(low, "a").filter(F.col("b") > F.col("a")).select(
            F.col("b").alias("a"), F.col("m").alias("b")))
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            low.select("a", F.col("m").alias("b")))
        edges = written(norm(small), "neardup-edges")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))


def with_labels(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return members.withColumn("label", F.col("node"))
    return (members.join(labels, "node", "left")
            .withColumn("label", F.coalesce("label", "node")))


def open_members(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    """The members of buckets that still hold more than one component."""
    m = with_labels(members, labels)
    keys = m.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"),
                                F.count(F.lit(1)).alias("size")).filter("lo != hi")
    return m.join(keys.select("key", "size"), "key")


def close_enough(a: str, b: str, threshold: int) -> Column:
    """Set sizes that allow the threshold."""
    return 100 * F.least(a, b) >= threshold * F.greatest(a, b)


def histogram(shingles: frozenset[bytes]) -> np.ndarray:
    """How many of a set's shingles fall into each of ``BINS``: the sum of the
    smaller counts of two sets is at least the size of their intersection."""
    at = np.fromiter(map(hash, shingles), np.int64, len(shingles)) & (BINS - 1)
    return np.bincount(at, minlength=BINS).astype(np.int32)


def may_link(mine: np.ndarray, n: int, others: np.ndarray, sizes: np.ndarray, threshold: int
             ) -> np.ndarray:
    """Which of the sets with histograms ``others`` may be linked with one of
    ``n`` shingles: no linked one is left out."""
    both = np.minimum(others, mine).sum(axis=1, dtype=np.int64)
    return np.flatnonzero(100 * both >= threshold * (sizes + n - both))


def _cross(size: int, threshold: int):
    """All members of different components of one block pair of a bucket."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def groups():
            rows = itertools.chain.from_iterable(
                zip(b["key"], b["x"], b["y"], b["side"], b["node"], b["label"], b["text"],
                    strict=True) for b in batches)
            yield from itertools.groupby(rows, key=lambda r: r[:3])
        for (_, x, y), rows in groups():
            left, out, parent = [], [], {}
            counts, sizes = np.empty((64, BINS), np.int32), np.empty(64, np.int64)

            def root(v, parent=parent):
                while parent.setdefault(v, v) != v:
                    parent[v] = v = parent[parent[v]]
                return v
            for *_, side, node, label, text in rows:
                s = shingle_set(text, size)
                mine, m = histogram(s), len(left)
                for i in may_link(mine, len(s), counts[:m], sizes[:m], threshold):
                    other, tag, t = left[i]
                    if root(label) != root(tag) and linked(s, t, threshold):
                        out.append((other, node))
                        parent[root(label)] = root(tag)
                if side == 0 or x == y:
                    if m == len(counts):
                        counts, sizes = np.repeat(counts, 2, axis=0), np.repeat(sizes, 2)
                    counts[m], sizes[m] = mine, len(s)
                    left.append((node, label, s))
            if out:
                yield pd.DataFrame(out, columns=["a", "b"], dtype=object)
    return run


def cross_links(still: DataFrame, texts: DataFrame, size: int, threshold: int) -> DataFrame:
    """Links between the components that share an open bucket, exactly.

    A bucket's members are dealt into blocks of about ``BLOCK``; each task takes
    one pair of blocks, so a member's text is moved once per block of its bucket
    and nothing but links comes out.
    """
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    mine = F.pmod(F.xxhash64("node"), blocks.cast("long")).cast("int")
    m = still.withColumn("blocks", blocks).withColumn("mine", mine)
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    p = m.select("key", "node", "label", "mine", other.alias("o")).select(
        "key", F.least("mine", "o").alias("x"), F.greatest("mine", "o").alias("y"),
        (F.col("mine") > F.col("o")).cast("int").alias("side"), "node", "label")
    dealt = (p.join(texts, "node").select("key", "x", "y", "side", "node", "label", "text")
             .repartition("key", "x", "y").sortWithinPartitions("key", "x", "y", "side", "node"))
    return dealt.mapInPandas(_cross(size, threshold), "a string, b string")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    size: int = SHINGLE, threshold: int = THRESHOLD) -> DataFrame:
    """doc_id, tk (md5 of the text), n_shingles, label (of the component's
    sets), component_id, kept, one row per row of ``docs``.

    Null or empty text, or one without words: an empty set, linked with
    nothing; such a row is its own component.  Null ids sort last and are kept
    only if alone.  Rows that repeat an id are separate documents: equal sets
    are one component, whose smallest id may then be kept more than once.
    Empty tables give no rows; other columns are ignored.
    """
    sig = written(signatures(docs, doc_id, text, size, threshold), "neardup-signatures")
    nodes = written(sig.filter("n > 0").groupBy("node").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("z"), F.col("doc_id").alias("id"),
                       "tk")).alias("r"),
        F.first("n").alias("n"), F.first("bands").alias("bands"))
        .select("node", F.col("r.id").alias("lowest"), F.col("r.tk").alias("tk"), "n", "bands"),
        "neardup-nodes")
    exploded = nodes.select(F.explode("bands").alias("key"), "node", "n")
    shared = exploded.groupBy("key").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    members = written(exploded.join(shared.select("key"), "key"), "neardup-buckets")
    # One row stands for a node, so that a text with many copies is moved once.
    wanted = (members.select("node").distinct().join(nodes, "node")
              .select("node", F.col("lowest").alias("i"), F.col("tk").alias("k")))
    d = docs.select(F.col(doc_id).cast("long").alias("d"), F.col(text).alias("text"),
                    F.md5(F.col(text)).alias("t"))
    texts = written(d.join(wanted, F.col("d").eqNullSafe(F.col("i")) & (F.col("t") == F.col("k")))
                    .groupBy("i", "k", "node").agg(F.first("text").alias("text"))
                    .select("node", "text"), "neardup-texts")

    labels, links = None, None
    for turn in range(STAR_ROUNDS + 1):
        still = written(open_members(members, labels), "neardup-open")
        if still.isEmpty():
            break
        if turn < STAR_ROUNDS:
            # The same few nodes are centres in all of their buckets.
            by = F.xxhash64("node", F.lit(turn))
            centers = still.groupBy("key").agg(F.min_by(F.struct("node", "label", "n"), by).alias("c"))
            pairs = (still.join(centers, "key").filter(
                (F.col("c.label") != F.col("label"))
                & close_enough("n", "c.n", threshold))
                .select(F.col("c.node").alias("center"), "node").distinct())
            found = confirm(pairs, texts, size, threshold)
        else:
            found = cross_links(still, texts, size, threshold)
        found = written(found, "neardup-links")
        links = found if links is None else links.unionByName(found)
        labels = components(links)
    by_node = with_labels(nodes.select("node", "lowest"), labels)
    ids = by_node.groupBy("label").agg(F.min("lowest").alias("component"))
    comp = by_node.join(ids, "label").select("node", "label", "component")
    out = sig.filter("n > 0").join(comp, "node").select(
        "doc_id", "tk", F.col("n").alias("n_shingles"), "label",
        F.col("component").alias("component_id"))
    alone = sig.filter("n = 0").select(
        "doc_id", "tk", F.col("n").alias("n_shingles"), F.lit(None).cast("string").alias("label"),
        F.col("doc_id").alias("component_id"))
    return out.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(
        F.col("component_id")))


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                size: int = SHINGLE, threshold: int = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each component the one
    with the smallest id (null last), then the smallest text digest.  Rows
    equal in id and text are one; texts without words all stay."""
    got = near_duplicates(docs, doc_id, text, size, threshold)
    best = got.filter("n_shingles > 0").groupBy("label").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("z"), F.col("doc_id").alias("i"), F.col("tk").alias("t"))
        ).alias("b")).select("b.i", "b.t")
    keep = best.unionByName(got.filter("n_shingles = 0").select(
        F.col("doc_id").alias("i"), F.col("tk").alias("t")).distinct())
    names = docs.columns
    d = docs.toDF(*[f"c{i}" for i in range(len(names))])
    key, body = F.col(f"c{names.index(doc_id)}"), F.col(f"c{names.index(text)}")
    d = d.withColumn("i_", key.cast("long")).withColumn("t_", F.md5(body))
    kept = d.join(keep, F.col("i_").eqNullSafe(F.col("i")) & F.col("t_").eqNullSafe(F.col("t")))
    return kept.dropDuplicates(["i_", "t_"]).select(*[f"c{i}" for i in range(len(names))]).toDF(*names)


def op3_minmax_neardup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).drop("tk", "label")


ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM d WHERE len(w) > 0)),
c AS (SELECT doc_id, count(*)::BIGINT AS n FROM s GROUP BY doc_id),
p AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
  FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2),
e AS (
  SELECT a, b FROM p JOIN c ca ON ca.doc_id = a JOIN c cb ON cb.doc_id = b
  WHERE 100 * common >= 85 * (ca.n + cb.n - common)),
r AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
m AS (SELECT a AS doc_id, min(b)::BIGINT AS component_id FROM r GROUP BY a)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d LEFT JOIN c USING (doc_id) JOIN m USING (doc_id)
"""
