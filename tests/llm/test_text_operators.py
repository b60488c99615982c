"""Language model, near duplicates, suffix arrays, decontamination, language
identification and quality rules on small tables, against brute force."""

import hashlib
import math
import random
import re
import tracemalloc
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pytest
from fixtures import edge_docs, edge_rows, lower_az, prose
from pyspark.sql import functions as F

from riskstream.llm import decontaminate, hpylm, langid, neardup, quality, suffixarray

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def words(text):
    return [w for w in SPACE.split(lower_az(text or "")) if w]


# --- 1 ----------------------------------------------------------------------

def test_hpylm_counts_and_base_scores(spark):
    rows = edge_rows()
    held = {7, 10, 13}
    got = hpylm.hpy_scores(edge_docs(spark), F.coalesce(F.col("doc_id").isin(*held), F.lit(False)))
    assert got.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens",
                           "base_score", "score"]
    c = Counter()
    for i, t, *_ in rows:
        if i not in held:
            c.update([*words(t), None])
    n, v = sum(c.values()), len(c)
    want = sorted((str(i), i in held, len(words(t)) + 1, sum(c[w] > 0 for w in [*words(t), None]), n,
                   round(sum(math.log10((c[w] + .5) / (n + .5 * (v + 1)))
                             for w in [*words(t), None]), 6)) for i, t, *_ in rows)
    seen = got.collect()
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens,
                   round(r.base_score, 6)) for r in seen) == want
    assert all(r.score < 0 and math.isfinite(r.score) for r in seen)


def test_hpylm_empty_and_untrained(spark):
    empty = edge_docs(spark, [])
    assert hpylm.hpy_scores(empty, F.lit(False)).count() == 0
    rows = hpylm.hpy_scores(edge_docs(spark), F.lit(True)).collect()
    assert len(rows) == len(edge_rows()) and {r.train_tokens for r in rows} == {0}
    assert all(abs(r.base_score) < 1e-9 for r in rows)


def test_hpylm_predictive_sums_to_one_and_seating_is_bounded():
    rng = np.random.default_rng(3)
    word = rng.integers(1, 60, 4000).astype(np.uint64)
    ctx = rng.integers(0, 5, 4000).astype(np.uint16)
    d = hpylm.Dishes(word, ctx, np.ones(4000, np.int64))
    start = np.bincount(d.ctx, minlength=hpylm.CONTEXTS).astype(float)
    customers = np.bincount(d.ctx, d.count, hpylm.CONTEXTS)
    g = {"n": 4000, "v": len(d.words), "d": .7, "d0": .5, "customers": customers, "tables": start,
         "root_customers": start.sum(), "root_tables": float(len(d.words))}
    (_, t, c0, t0), = hpylm.sweeps(d, [g])
    assert (t >= 1).all() and (t <= d.count).all() and (t0 >= 1).all() and (t0 <= c0).all()
    now = g | {"tables": np.bincount(d.ctx, t, hpylm.CONTEXTS), "root_customers": c0.sum(),
               "root_tables": t0.sum()}
    root = d.parent(now, c0, t0)
    unknown = ((hpylm.STRENGTH + .5 * t0.sum()) / (len(d.words) + 1)
               / (hpylm.STRENGTH + c0.sum()))
    assert root.sum() + unknown == pytest.approx(1)
    for x in range(5):
        at = d.ctx == x
        own = (d.count[at] - .7 * t[at]).sum()
        assert (own + hpylm.STRENGTH + .7 * now["tables"][x]) / (
            hpylm.STRENGTH + customers[x]) == pytest.approx(1)


def test_hpylm_large_counts_seat_like_single_customers():
    """Groups of customers give about as many tables as customers one by one."""
    n, mass, disc = 3000, 6.0, .6
    rng = np.random.default_rng(0)
    slow = []
    for _ in range(60):
        t = 1
        for i in range(1, n):
            t += rng.random() < mass / (mass + i - disc * t)
        slow.append(t)
    fast = hpylm.seat(np.full(400, n), np.full(400, mass), disc,
                      np.arange(400, dtype=np.uint64) * np.uint64(7919), 0)
    assert abs(fast.mean() - np.mean(slow)) < 0.1 * np.mean(slow)


def test_hpylm_buckets_and_spread_words_do_not_change_counts(spark, monkeypatch):
    docs = edge_docs(spark, [(i, "the " * 40 + prose(i, 30), "en", "a") for i in range(40)])
    held = F.col("doc_id") % 5 == 0
    one = {r.doc_id: r for r in hpylm.hpy_scores(docs, held).collect()}
    monkeypatch.setattr(hpylm, "TOKENS_PER_BUCKET", 300)
    many = {r.doc_id: r for r in hpylm.hpy_scores(docs, held).collect()}
    for i, r in one.items():
        assert many[i].n_known == r.n_known and abs(many[i].base_score - r.base_score) < 1e-6
        assert many[i].score == pytest.approx(r.score, rel=1e-9)
    # The copies of "the" make it far likelier than the add-half unigram says.
    assert sum(r.score > r.base_score for r in one.values()) == 40


def plain_hpylm(rows, held, samples):
    """The same model and random numbers with dictionaries, one customer at a time."""
    u64 = np.uint64
    name = lambda w: hpylm.word_hashes([w.encode() if w else hpylm.END])[0]
    texts = {i: [*words(t), None] for i, t, *_ in rows}
    pairs = lambda ws: list(zip([0, *ws[:-1]], ws, strict=True))
    hash_of = lambda c: hpylm.START if c == 0 else name(c)
    count = Counter(p for i, ws in texts.items() if i not in held for p in pairs(ws))
    total, customers = Counter(), Counter()
    for (c, w), n in count.items():
        total[w] += n
        customers[c] += n
    n, v, s = sum(total.values()), len(total), hpylm.STRENGTH
    kinds = lambda xs: hpylm.discount(*[sum(x == k for x in xs) for k in (1, 2)])
    d, d0 = kinds(count.values()), kinds(Counter(w for _, w in count).values())

    def seat(n, mass, disc, key, sweep):
        t = int(n > 0)
        for i in range(1, n):
            t += hpylm.uniforms(np.array([key]), i, sweep)[0] * (mass + i - disc * t) < mass
        return int(t)
    key = {(c, w): hpylm.mix(np.array([name(w)]) * u64(0x9E3779B97F4A7C15) + hash_of(c))[0]
           for c, w in count}
    root = {w: (x + .5) / (n + .5 * (v + 1)) for w, x in total.items()}
    tables, root_tables = Counter(c for c, _ in count), v
    sampled = []
    for sweep in range(hpylm.BURN_IN + samples):
        t = {p: seat(x, (s + d * tables[p[0]]) * root[p[1]], d, key[p], sweep)
             for p, x in count.items()}
        c0, tables = Counter(), Counter()
        for (c, w), x in t.items():
            c0[w] += x
            tables[c] += x
        new = (s + d0 * root_tables) / (v + 1)
        t0 = {w: seat(x, new, d0, hpylm.root_key(np.array([name(w)]))[0], sweep + 500)
              for w, x in c0.items()}
        root_tables = sum(t0.values())
        new = (s + d0 * root_tables) / (v + 1)
        root = {w: (c0[w] - d0 * t0[w] + new) / (s + sum(c0.values())) for w in c0}
        if sweep >= hpylm.BURN_IN:
            sampled.append((t, tables, root, new / (s + sum(c0.values()))))

    def p(c, w):
        return sum((count[c, w] - d * t.get((c, w), 0) + (s + d * tb[c]) * r.get(w, unknown))
                   / (s + customers[c]) for t, tb, r, unknown in sampled) / len(sampled)
    return {i: sum(math.log10(p(c, w)) for c, w in pairs(ws)) for i, ws in texts.items()}


@pytest.mark.parametrize("bucket", [2_500_000, 250])
def test_hpylm_scores_equal_a_plain_sampler(spark, monkeypatch, bucket):
    rows = [(i, "the " * (i % 9) + prose(i, 25), "en", "a") for i in range(30)]
    rows += [(90, None, "en", "a"), (91, "", "en", "a"), (92, "the zzz the", "en", "a")]
    held = {3, 8, 92}
    monkeypatch.setattr(hpylm, "TOKENS_PER_BUCKET", bucket)
    monkeypatch.setattr(hpylm, "CONTEXTS", 50)
    monkeypatch.setattr(hpylm, "PACK_TOKENS", 200)
    got = {r.doc_id: r.score for r in hpylm.hpy_scores(
        edge_docs(spark, rows), F.col("doc_id").isin(*held)).collect()}
    want = plain_hpylm(rows, held, hpylm.SAMPLES)
    assert got == {i: pytest.approx(x, rel=1e-9) for i, x in want.items()}


def test_hpylm_dishes_do_not_grow_with_the_buckets():
    """Every (context, word) is in one bucket, dealt words too; each bucket that
    such a word may come to knows it."""
    batch = hpylm.Batch()
    for i in range(40):
        batch.add(i, False, "the " * 30 + " the ".join(prose(i, 40).split()))
    keys = np.sort(hpylm.word_hashes([b"the"]))
    seen = {}
    for buckets, ways in ((1, 1), (4, 3), (64, 40)):
        spread = (keys, np.array([ways]))
        hashes, _, key = batch.by_bucket(spread, buckets)
        key, n = np.unique(key, return_counts=True)
        n = n.astype(np.uint32)
        rows = dict(hpylm.split_rows(hashes, key, n))
        got = [hpylm.dishes_of([rows[b]] if b in rows else [], b, spread, buckets)
               for b in range(buckets)]
        seen[buckets] = Counter({(int(w), int(d.names[c])): int(x) for d in got
                                 for w, c, x in zip(d.word, d.ctx, d.count, strict=True) if x})
        assert sum((d.count > 0).sum() for d in got) == len(seen[buckets])
        assert sum(keys[0] in d.words for d in got) == ways
    assert seen[1] == seen[4] == seen[64]


def test_hpylm_seats_every_customer_as_one_by_one():
    count = np.array([1, 2, 48, 49, 700, 5000])
    mass = np.array([3.0, .5, 9.0, 2.0, 40.0, 900.0])
    key = np.arange(6, dtype=np.uint64) * np.uint64(7919)
    want = []
    for c, m, k in zip(count, mass, key, strict=True):
        t = 1
        for i in range(1, c):
            u = hpylm.uniforms(np.array([k]), i, 3)[0]
            t += u * (m + i - .6 * t) < m
        want.append(t)
    assert hpylm.seat(count, mass, .6, key, 3).tolist() == want


@pytest.mark.parametrize("bucket", [2_500_000, 9_000])
def test_hpylm_rare_previous_words_have_contexts_of_their_own(spark, monkeypatch, bucket):
    """More words than the 8,192 that once had one; "aab" and "zab" end alike."""
    monkeypatch.setattr(hpylm, "TOKENS_PER_BUCKET", bucket)
    filler = " ".join(f"w{i}" for i in range(9000))
    rows = [(i, filler, "en", "a") for i in range(3)]
    rows += [(10 + i, t, "en", "a") for i, t in enumerate(["aab one", "zab two"] * 2)]
    rows += [(20, "aab one", "en", "a"), (21, "zab one", "en", "a")]
    got = {r.doc_id: r.score for r in hpylm.hpy_scores(
        edge_docs(spark, rows), F.col("doc_id") >= 20).collect()}
    assert got[20] > got[21] + .5


# --- 3 ----------------------------------------------------------------------

def brute_components(rows, size=3, threshold=85):
    def shingles(t):
        w = words(t)
        return {tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()
    sets = [shingles(t) for _, t, *_ in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in range(len(rows)):
        for b in range(a):
            i = len(sets[a] & sets[b])
            if i and 100 * i >= threshold * (len(sets[a]) + len(sets[b]) - i):
                parent[root(a)] = root(b)
    out = []
    for k, (i, *_) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root(j) == root(k) and rows[j][0] is not None]
        comp = min(ids) if ids else None
        out.append((str(i), len(sets[k]), str(comp), i == comp))
    return sorted(out)


def family(seed, n, edits):
    r = random.Random(seed)
    base = prose(seed, 150).split()
    out = [base]
    for _ in range(n - 1):
        w = list(r.choice(out))
        for _ in range(r.randint(0, edits)):
            w[r.randrange(len(w))] = prose(r.random(), 1)
        out.append(w)
    return [" ".join(w) for w in out]


@pytest.mark.parametrize("rounds", [3, 0])
def test_neardup_components(spark, monkeypatch, rounds):
    monkeypatch.setattr(neardup, "STAR_ROUNDS", rounds)  # 0: the exact stage alone
    monkeypatch.setattr(neardup, "BLOCK", 7)
    rows = edge_rows()
    for s in range(4):
        rows += [(1000 * (s + 1) + k, t, "en", "a") for k, t in enumerate(family(s, 25, 6))]
    got = neardup.near_duplicates(edge_docs(spark, rows))
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept)
                  for r in got.collect()) == brute_components(rows)


def test_neardup_empty_and_filter(spark):
    assert neardup.near_duplicates(edge_docs(spark, [])).count() == 0
    docs = edge_docs(spark)
    kept = neardup.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = sorted(str(r.doc_id) for r in kept.collect())
    assert "4" not in ids and "5" not in ids and ids.count("6") == 1 and "11" not in ids
    assert {"3", "7", "8", "9", "10"} <= set(ids)


def test_band_layouts_never_pair_a_permutation_with_itself():
    for threshold in (85, 80):
        layout = neardup.band_layout(threshold)
        assert sorted(sum(layout, [])) == list(range(2 * neardup.PERMS))
        assert all(len({v % neardup.PERMS for v in b}) == len(b) for b in layout)


def test_neardup_stars_need_no_rounds(spark, monkeypatch):
    made = []
    monkeypatch.setattr(neardup, "written", lambda df, tag: made.append(tag) or df.localCheckpoint())
    links = [("a", "b"), ("c", "a"), ("x", "y")]
    got = neardup.components(spark.createDataFrame(links, "a string, b string"))
    assert {tuple(r) for r in got.collect()} == {("b", "a"), ("c", "a"), ("y", "x")}
    assert len(made) == 1  # the links themselves
    path = [(f"{i:02}", f"{i + 1:02}") for i in range(20)]
    got = neardup.components(spark.createDataFrame(path, "a string, b string"))
    assert {tuple(r) for r in got.collect()} == {(f"{i:02}", "00") for i in range(1, 21)}


def test_neardup_histograms_rule_out_no_link():
    r = random.Random(7)
    sets = []
    for _ in range(60):
        text = [str(r.randint(0, 40)) for _ in range(r.randint(1, 120))]
        for _ in range(3):
            sets.append(neardup.shingle_set(" ".join(text)))
            text[r.randrange(len(text))] = "x"
    h, n = np.array([neardup.histogram(s) for s in sets]), np.array([len(s) for s in sets])
    out = 0
    for i, s in enumerate(sets):
        may = set(neardup.may_link(h[i], len(s), h, n, 85).tolist())
        assert may >= {j for j, t in enumerate(sets) if neardup.linked(s, t)}
        out += len(sets) - len(may)
    assert out > 25_000  # of 32,400


# --- 5 ----------------------------------------------------------------------

def test_suffix_array_by_linear_grouping():
    r = random.Random(5)
    for _ in range(1500):
        s = [r.randint(1, r.choice([1, 2, 3, 9])) for _ in range(r.randint(0, 40))] + [0]
        assert suffixarray.suffix_array(s) == sorted(range(len(s)), key=lambda i: s[i:])


def test_suffix_array_keeps_plain_integers():
    s = np.random.default_rng(1).integers(1, 40_000, 50_000).tolist() + [0]
    tracemalloc.start()
    try:
        suffixarray.suffix_array(s)
        assert tracemalloc.get_traced_memory()[1] < 120 * len(s)  # lists of objects took 189
    finally:
        tracemalloc.stop()


def brute_repeats(rows):
    order = sorted({(i is not None, i or 0, t or "") for i, t, *_ in rows}, key=lambda x: x[:2])
    seen, out = set(), {}
    for has, i, t in order:
        b = t.encode()
        gone = bytearray(len(b))
        for p in range(len(b) - 99):
            w = b[p:p + 100]
            if w in seen:
                gone[p:p + 100] = b"\1" * 100
            seen.add(w)
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        keep = bytes(c for c, g in zip(b, gone) if not g)
        out[(has, i, t)] = (len(b), sum(gone), spans, hashlib.sha256(keep).hexdigest())
    return sorted((str(i), *out[(i is not None, i or 0, t or "")]) for i, t, *_ in rows)


def repeat_rows():
    r = random.Random(9)
    passages = [prose(50 + k, 40) for k in range(4)]
    rows = [(i, t, la, s) for i, t, la, s in edge_rows() if i != (1 << 53) + 1]
    for k in range(40):
        parts = [prose(900 + k, 20), r.choice(passages), prose(950 + k, 15), r.choice(passages)[7:]]
        rows.append((100 + k, "\n".join(parts), "en", "a"))
    rows.append((300, "ab" * 300, "en", "a"))
    rows.append((301, "\x00é" * 200 + prose(900, 20), "en", "a"))
    return rows


@pytest.mark.parametrize("hot", [False, True])
def test_repeated_spans(spark, monkeypatch, hot):
    rows = repeat_rows()
    if hot:  # every anchor of the sample takes the route of hot ones
        b = [np.frombuffer((t or "").encode(), np.uint8) for _, t, *_ in rows]
        h = np.unique(np.concatenate([suffixarray.cells(x, np.zeros(len(x), int))[0] for x in b]))
        monkeypatch.setattr(suffixarray, "hot_anchors", lambda d, n: h[::2])
    got = suffixarray.repeated_spans(edge_docs(spark, rows)).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").alias("n"), "kept_sha256")
    assert sorted((str(r.doc_id), *r[1:]) for r in got.collect()) == brute_repeats(rows)


def test_repeated_spans_long_texts_and_small_pieces(spark, monkeypatch):
    monkeypatch.setattr(suffixarray, "CHUNK", 700)
    monkeypatch.setattr(suffixarray, "BUCKET_BYTES", 4000)
    monkeypatch.setattr(suffixarray, "CONTEXT_BUCKET", 4000)
    monkeypatch.setattr(suffixarray, "RANGE_BYTES", 5000)
    monkeypatch.setattr(suffixarray, "BATCH_BYTES", 3000)
    rows = [*repeat_rows(), (500, prose(50, 40) + prose(60, 800), "en", "a"),
            (501, prose(60, 800) + prose(51, 40), "en", "a")]
    got = suffixarray.repeated_spans(edge_docs(spark, rows)).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").alias("n"), "kept_sha256")
    assert sorted((str(r.doc_id), *r[1:]) for r in got.collect()) == brute_repeats(rows)


def test_repeated_spans_empty(spark):
    assert suffixarray.repeated_spans(edge_docs(spark, [])).count() == 0


# --- 7 ----------------------------------------------------------------------

def brute_hits(rows, items):
    def fold(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower_az(t or ""))
    out = []
    for i, t, *_ in rows:
        w, hit, names = fold(t), set(), set()
        for name, text in items:
            x = fold(text)
            m = min(10, len(x))
            for k in range(len(x) - m + 1 if m else 0):
                for p in range(len(w) - m + 1):
                    if w[p:p + m] == x[k:k + m]:
                        hit.update(range(p, p + m))
                        names.add(str(name))
        out.append((str(i), len(w), len(hit), ",".join(sorted(names)), bool(hit)))
    return sorted(out)


@pytest.mark.parametrize("block", [1 << 20, 200])
def test_decontamination(spark, block):
    rows = edge_rows()
    base, other = rows[0][1], prose(3, 70)
    items = [(1, " ".join(base.split()[20:45])), (2, "one TWO"), (10, other), (2, "x"), (7, None),
             (8, ""), (9, "!!"), (11, "zzz " * 12), (12, "café 3.5"), (1, "d e f")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows += [(900, "At the Café: 3.5!", "en", "a")]
    got = decontaminate.find_benchmark(edge_docs(spark, rows), bench, ["doc_id", "node"],
                                       block_bytes=block)
    assert sorted((str(r.doc_id), r.n_words, r.n_hit, ",".join(r["items"]), r.contaminated)
                  for r in got.collect()) == brute_hits(rows, [x for x in items if x[1]])


def test_decontamination_empty_tables_and_filter(spark):
    docs = edge_docs(spark)
    none = spark.createDataFrame([], "item_id long, text string")
    got = decontaminate.find_benchmark(docs, none, ["doc_id"])
    assert got.filter("contaminated").count() == 0 and got.count() == len(edge_rows())
    bench = spark.createDataFrame([(1, "one two")], "item_id long, text string")
    assert decontaminate.find_benchmark(edge_docs(spark, []), bench, ["doc_id"]).count() == 0
    clean = decontaminate.drop_contaminated(docs, bench)
    assert clean.columns == docs.columns and clean.count() == len(edge_rows()) - 2


# --- 8 ----------------------------------------------------------------------

def test_crf_marginals_equal_enumeration():
    rng = np.random.default_rng(2)
    k = 3
    trans = rng.normal(size=(k, k))
    lengths = np.array([1, 4, 7, 2])
    emit = rng.normal(size=(lengths.sum(), k))
    want, at = [], 0
    for n in lengths:
        e = emit[at:at + n]
        p = np.zeros((n, k))
        for path in np.ndindex(*[k] * n):
            s = sum(e[i, y] for i, y in enumerate(path)) + sum(
                trans[a, b] for a, b in zip(path, path[1:]))
            for i, y in enumerate(path):
                p[i, y] += math.exp(s)
        want.append(p / p.sum(axis=1, keepdims=True))
        at += n
    for block in (128, 3, 2, 1):
        assert np.allclose(langid.marginals(emit, trans, lengths, block), np.concatenate(want))


def test_language_of_mixed_and_odd_texts(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(d)
    rows = d.filter("n_chars > 300").select("doc_id", "text", "lang").filter(langid.fold() == 0).collect()
    by = {x: [r.text for r in rows if r.lang == x] for x in model.langs}
    switched = " ".join(by["de"][0].split()[:60] + by["fr"][0].split()[:20])
    odd = [*edge_rows(), (700, switched, None, "a"), (701, by["es"][0] * 30, None, "a")]
    got = {str(r.doc_id): r for r in langid.predict_language(
        edge_docs(spark, odd), model, ["doc_id", "k0"]).filter("doc_id is not null").collect()}
    assert got["700"].lang_pred == "de" and got["701"].lang_pred == "es"
    assert {got[i].lang_pred for i in ("7", "8", "9", "16")} == {"und"}
    assert all(0 <= r.score <= 1 for r in got.values())
    p = langid.marginals(model.emissions(langid.words_of(switched)),
                         model.trans, np.array([len(langid.words_of(switched))]))
    right = p.argmax(axis=1)
    assert (right[:50] == model.langs.index("de")).mean() > .9
    assert (right[-15:] == model.langs.index("fr")).mean() > .8


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.op8_crf_langid(spark, "/root/testdata/sf0.01").join(docs, "doc_id")
    held = got.filter("held_out and lang is not null")
    assert held.filter("lang_pred = lang").count() >= 0.97 * held.count() > 0


def test_language_nothing_learned(spark):
    empty = edge_docs(spark, [])
    model = langid.fit(empty)
    assert model.langs == []
    assert langid.predict_language(empty, model, ["doc_id"]).count() == 0
    assert {r.lang_pred for r in langid.predict_language(edge_docs(spark), model, ["doc_id"]
                                                         ).collect()} == {"und"}


# --- 9 ----------------------------------------------------------------------

def brute_quality(rows):
    out = []
    for i, t, _, s in rows:
        w = [x for x in SPACE.split(t or "") if x]
        tri = Counter(zip(w, w[1:], w[2:]))
        rep = {p + k for p in range(len(w) - 2) if tri[tuple(w[p:p + 3])] > 1 for k in range(3)}
        lines = [x for x in (t or "").split("\n") if SPACE.sub("", x)]
        failed = len(w) < 50 or 100 * len(rep) > 50 * len(w)
        out.append((i, s, len(w), sum(map(len, w)), sum((t or "").count(c) for c in "#*$%&|<>"),
                    len(lines) - len(set(lines)), len(rep), failed))
    hosts = {s: [r[-1] for r in out if r[1] == s] for s in {r[1] for r in out}}
    n = len(out)
    m = sum(r[-1] for r in out) / n
    v = sum(sum(f) ** 2 / len(f) for f in hosts.values()) / n - m * m
    strength = max(m * (1 - m) / v - 1, 0) if v > 1e-12 else None
    bad = {s: (m if strength is None else (sum(f) + strength * m) / (len(f) + strength)) > .5
           for s, f in hosts.items()}
    return sorted((str(r[0]), *r[2:], not r[-1] and not bad[r[1]]) for r in out)


@pytest.mark.parametrize("good", [0, 30])
def test_quality_rules(spark, good):
    rows = edge_rows() + [(2000 + k, prose(k, 80), "en", "a" if k % 2 else "good") for k in range(good)]
    got = quality.quality_rules(edge_docs(spark, rows))
    assert sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines,
                   r.n_repeat_words, r.base_failed, r.kept) for r in got.collect()
                  ) == brute_quality(rows)


def test_quality_rules_empty(spark):
    assert quality.quality_rules(edge_docs(spark, [])).count() == 0


def test_langid_reads_the_middle_of_long_unspaced_texts():
    model = langid.train([("xx", langid.words_of("abcab cabca bcabb " * 60)),
                          ("yy", langid.words_of("uvwuv wuvwu vwuvv " * 60))], n_words=3000, steps=30)
    text = "qq" * 10 + "uvwuv" * 40 + "qq" * 10
    batch = pd.DataFrame({"t_": [text, text.replace("uvwuv", "abcab")]})
    (got,) = langid._predictor(SimpleNamespace(value=model))(iter([batch]))
    assert got["lang_pred_"].tolist() == ["yy", "xx"] and (got["score_"] > .8).all()
    assert "".join(langid.words_of(text)) == text


def test_repeated_spans_bounds_the_cells_of_an_anchor(spark, monkeypatch):
    """A short line in ever other surroundings, unseen by the sample of hot anchors."""
    line = prose(90, 14)[:70]
    docs = edge_docs(spark, [(i, f"{prose(100 + i, 40)} {line} {prose(100 + i % 7, 60)}", "en", "a")
                             for i in range(40)])
    monkeypatch.setattr(suffixarray, "hot_anchors", lambda d, n: np.empty(0, np.uint64))
    want = sorted(map(str, suffixarray.repeated_spans(docs).collect()))
    routed, real = [], suffixarray.hot_repeats

    def seen(cut):
        routed.append(sorted(r["count"] for r in cut.groupBy("h").count().collect()))
        return real(cut)
    monkeypatch.setattr(suffixarray, "hot_repeats", seen)
    monkeypatch.setattr(suffixarray, "CELLS_PER_ANCHOR", 5)
    assert sorted(map(str, suffixarray.repeated_spans(docs).collect())) == want
    assert routed and routed[0] and routed[0][0] > 5


def test_langid_refuses_more_languages_than_it_learns(spark, monkeypatch):
    monkeypatch.setattr(langid, "MAX_LANGS", 2)
    docs = edge_docs(spark, [(i, "a b c", f"l{i}", "a") for i in range(3)])
    with pytest.raises(ValueError, match="languages"):
        langid.training_sample(docs)


def test_flags_do_not_grow_with_buckets(spark, monkeypatch):
    """Rows between the steps follow documents and ranges, not buckets."""
    rows = [(i, prose(i % 7, 60) + prose(50 + i, 30), "en", "a") for i in range(60)]
    docs, counts, results = edge_docs(spark, rows), [], []
    real = suffixarray.written

    def seen(df, tag, *a):
        out = real(df, tag, *a)
        if tag == "suffix-flags":
            counts.append((out.count(), out.select("did", "dig").distinct().count()))
        return out
    monkeypatch.setattr(suffixarray, "written", seen)
    for size in (1 << 20, 1 << 12, 1 << 9):
        monkeypatch.setattr(suffixarray, "BUCKET_BYTES", size)
        results.append(sorted(map(str, suffixarray.repeated_spans(docs).collect())))
    assert results[0] == results[1] == results[2]
    assert all(n == d <= len(rows) for n, d in counts)
