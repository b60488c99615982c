"""The prefix trie against a plain trie of Python dicts, and its node table."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import types as T

from riskstream.llm import prefixtrie as pt

SCHEMA = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
    T.StructField("role", T.StringType()), T.StructField("text", T.StringType()),
    # Names that the operator uses itself.
    T.StructField("conv", T.StringType()), T.StructField("depth", T.StringType()),
    T.StructField("n_convs", T.StringType()), T.StructField("range", T.StringType())])


def plain(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    whole = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        first = c - (c % 100 if c >= 0 else -(-c % 100))
        whole[c] = own.get(first, [])[:h] + ts[h:]
    members = {}
    for c, ts in whole.items():
        for d in range(len(ts) + 1):
            members.setdefault(tuple(ts[:d]), []).append(c)
    kids = Counter(k[:-1] for k in members if k)
    leaves, saved = Counter(), Counter()
    for k, cs in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += not kids[k]
            saved[k[:d]] += (len(cs) - 1) * len(k[-1][1]) if k else 0
    out = Counter()
    for k, cs in members.items():
        ends = ",".join(str(c) for c in sorted(cs) if len(whole[c]) == len(k))
        out[(min(cs), len(k), min(members[k[:-1]]) if k else None, len(cs), kids[k], leaves[k],
             saved[k], hashlib.sha256(ends.encode()).hexdigest())] += 1
    return out


def trie(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "a", "b", "c", "d") for r in rows], SCHEMA).repartition(3)
    return Counter(tuple(r) for r in pt.prefix_trie(df, **kw).collect())


def conversations(n=60, seed=1):
    r = random.Random(seed)
    rows = [(c, t, r.choice(["user", "assistant"]), r.choice(["hi", "é中", "yes", "no thanks", ""]))
            for c in r.sample(range(260), n) for t in range(r.randint(1, 7))]
    rows += [(300, 0, "user", "x"), (307, 0, "user", "x")]  # short ones of a group
    rows += [(None, 1, "user", "lost"), (None, None, None, None)]
    rows += [(5, None, None, "first"), (5, 1, None, None), (5, 1, None, None), (5, 1, "", "")]
    rows += [(-7, 0, "user", "n"), (-7, 1, "user", "m"), (401, None, None, None)]
    return rows


@pytest.mark.parametrize("subtree,band", [(1 << 14, 1 << 20), (20, 40), (1, 1)])
def test_equals_plain(spark, subtree, band):
    rows = conversations()
    assert trie(spark, rows, subtree_rows=subtree, band_nodes=band) == plain(rows)


def test_long_and_common(spark, monkeypatch):
    """One conversation with a third of all rows, one sequence that most share."""
    monkeypatch.setattr(pt, "BLOCK", 16)
    monkeypatch.setattr(pt, "ID_RANGE", 8)
    rows = [(0, t, "user", f"t{t % 3}") for t in range(150)]
    rows += [(c, t, "user", f"t{t % 3}") for c in range(1, 70) for t in range(4)]
    assert trie(spark, rows, subtree_rows=50, band_nodes=30) == plain(rows)


def test_empty(spark):
    assert not trie(spark, [])
    assert not trie(spark, [(None, 1, "user", "x")])


def test_node_table():
    r = np.random.default_rng(1)
    keys = r.integers(-2**63, 2**63 - 1, (5000, 3))
    table = pt.NodeTable(keys)
    assert sorted(table.slots(keys)) == list(range(5000))
    assert (table.slots(keys + 1) == -1).all()
    assert len(pt.NodeTable(keys[:0]).slots(keys[:5] * 0)) == 5
    with pytest.raises(ValueError):
        pt.NodeTable(np.concatenate([keys, keys[:1]]))
