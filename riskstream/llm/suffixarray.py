"""Removal of repeated 100-byte strings with suffix arrays (operator 5).

The suffix arrays are built by linear grouping: suffixes are grouped by the
Lyndon word they begin with, groups are taken in descending order, and each
suffix extends the group of its previous smaller one (``prev``); afterwards
one ascending scan emits every group's order through the same pointers, without
recursion on renamed strings.  Its symbols are ranks of pieces of ``PIECE`` bytes,
which are sorted once to get them.

How the work is cut for a cluster, for windows of ``LENGTH`` bytes:

1. Each window has an anchor, the smallest (leftmost on ties) hash of the
   ``GRAM``-byte strings inside it.  Equal windows have equal anchors at equal
   offsets, so all copies of a window meet under the anchor's hash.  A cell is
   an anchor with the run of windows it serves and the bytes they cover.
2. Equal cells are collapsed, in each batch before the shuffle and then per
   bucket: all windows of any but the first one are repeats.  A bucket gives a
   row for every range of documents, and a range's rows are unpacked together.
3. Where different cells share an anchor's hash, the first of each kind is cut
   out of its text, and a bucket's cells are sorted by what follows the anchor:
   a suffix array over their bytes in pieces of ``PIECE``, ranked
   lexicographically.  Runs of neighbours with a common prefix that reaches a
   window's end, split by the bytes before the anchor, are the window's
   occurrences; all but the first are repeats.
4. A document's repeats are merged into spans and cut out.

Anchor hashes that a large share of a sample of documents holds are routed by
cell instead, and their windows are compared by digest in an aggregate with
map-side combine, so a line that a third of all documents hold, each in other
surroundings, never meets in one task.  That choice changes routes only.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskstream.llm.common import files_of_shuffles_go, small_batches, table, written

LENGTH = 100
GRAM = 40
SPAN = LENGTH - GRAM + 1  # windows an anchor may serve
PIECE = 20
CHUNK = 1 << 20
BATCH_BYTES = 16 << 20
BUCKET_BYTES = 32 << 20
RANGE_BYTES = 128 << 20  # text of the documents whose flags one task unpacks
CONTEXT_BUCKET = 12 << 20
CELLS_PER_ANCHOR = CONTEXT_BUCKET // 160  # more cells of one anchor are not grouped
HOT_SAMPLE = 4000  # documents, about
HOT_LEAST = 200  # of them hold a hot anchor

_rng = np.random.Generator(np.random.PCG64(5))
BYTE_HASH = _rng.integers(0, 2 ** 64, 256, dtype=np.uint64)
LEVEL = _rng.integers(0, 2 ** 63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
LOW = np.uint64((1 << 24) - 1)
GOLD = np.uint64(0x9E3779B97F4A7C15)


# --- suffix array -----------------------------------------------------------

def numbers(x: np.ndarray) -> array:
    """``x`` as plain 8-byte integers: a list's objects take four times as much."""
    return array("q", x.astype(np.int64).tobytes())


def group_suffixes(s: Sequence[int]) -> tuple[array, array]:
    """Lyndon groups of the suffixes of ``s`` (its last symbol smallest and
    unique): the start of each suffix's group in suffix order, and each
    suffix's previous smaller suffix (-1: none).

    A group owns the slots from its start on; its members lie there in any
    order.  Groups are finalized from the highest slots downwards.  For a final
    group, members that share a previous smaller suffix j extend j's Lyndon word
    by the group's word, once per member; the extended ones leave their old
    group for a new one right above it, those with more extensions higher.
    """
    n = len(s)
    _, symbol, count = np.unique(np.asarray(s, np.int64), return_inverse=True, return_counts=True)
    starts = np.cumsum(count) - count
    by_symbol = np.argsort(symbol, kind="stable")
    places, sizes = np.empty(n, np.int64), np.zeros(n, np.int64)
    places[by_symbol] = np.arange(n)
    sizes[starts] = count
    group, size = numbers(starts[symbol]), numbers(sizes)
    slots, where = numbers(by_symbol), numbers(places)
    del symbol, count, starts, by_symbol, places, sizes
    prev = array("q", [-1]) * n
    top = n
    while top > 0:
        g = group[slots[top - 1]]
        members = sorted(slots[g:top])
        times: dict[int, int] = {}
        for i in members:
            j = i - 1
            while j >= 0 and group[j] >= g:
                j = prev[j]
            prev[i] = j
            if j >= 0:
                times[j] = times.get(j, 0) + 1
        top = g
        if not times:
            continue
        # Most extensions first, so that they get the highest slots.
        by_count: dict[int, list[int]] = {}
        for j, k in times.items():
            by_count.setdefault(k, []).append(j)
        for k in sorted(by_count, reverse=True):
            moved: dict[int, int] = {}
            leaving = by_count[k]
            for j in leaving:  # to the end of the old group's slots
                old = group[j]
                m = moved.get(old, 0) + 1
                moved[old] = m
                end, here = old + size[old] - m, where[j]
                other = slots[end]
                slots[here], where[other] = other, here
                slots[end], where[j] = j, end
            for old, m in moved.items():
                size[old] -= m
            for j in leaving:
                old = group[j]
                new = old + size[old]
                group[j] = new
            for old, m in moved.items():
                size[old + size[old]] = m
    return group, prev


def suffix_array(s: Sequence[int]) -> list[int]:
    """Suffix array of ``s``, whose last symbol is its unique smallest."""
    return suffix_order(s).tolist()


def suffix_order(s: Sequence[int]) -> array:
    """The suffix array as plain integers."""
    n = len(s)
    if not n:
        return array("q")
    group, prev = group_suffixes(s)
    fill = numbers(np.arange(n))  # the next free slot of the group that starts there
    sa = array("q", [-1]) * n
    placed = bytearray(n)
    sa[0] = n - 1
    placed[n - 1] = 1
    for r in range(n):
        j = sa[r] - 1
        while j >= 0 and not placed[j]:
            g = group[j]
            sa[fill[g]] = j
            fill[g] += 1
            placed[j] = 1
            j = prev[j]
    return sa


# --- cells ------------------------------------------------------------------

def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_hashes(b: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` bytes from each position, by doubling."""
    p, width, level = BYTE_HASH[b], 1, 0
    out, done = None, 0
    left = size
    while True:
        if left & 1:
            if out is None:
                out, done = p, width
            else:
                n = len(b) - (done + width) + 1
                out = out[:n] * LEVEL[15 - level] + p[done:done + n]
                done += width
        left >>= 1
        if not left:
            break
        n = len(b) - 2 * width + 1
        p = p[:n] * LEVEL[level] + p[width:width + n]
        width *= 2
        level += 1
    return mix(out[:len(b) - size + 1])


def sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    p, have = v, 1
    while have * 2 <= width:
        p = np.minimum(p[:-have], p[have:])
        have *= 2
    n, rest = len(v) - width + 1, width - have
    return np.minimum(p[:n], p[rest:rest + n])


def cells(b: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, ...]:
    """(hash, kind, first window, offset of the anchor, windows - 1) of the
    cells of the texts in ``b``; ``doc`` numbers each byte's text, from 0 up."""
    if len(b) < LENGTH:
        z = np.empty(0, np.uint64)
        return z, z, *[np.empty(0, np.int64)] * 3
    h = gram_hashes(b, GRAM)
    v = (h & ~LOW) | np.arange(len(h), dtype=np.uint64)
    anchor = (sliding_min(v, SPAN) & LOW).astype(np.int64)
    valid = doc[:len(anchor)] == doc[LENGTH - 1:]
    new = np.empty(len(anchor), bool)
    new[0] = True
    new[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:len(anchor)] != doc[:len(anchor) - 1])
    new |= np.r_[True, valid[1:] != valid[:-1]]
    lo = np.flatnonzero(new)
    hi = np.r_[lo[1:], len(anchor)] - 1
    ok = valid[lo]
    lo, hi = lo[ok], hi[ok]
    a = anchor[lo]
    end = hi + LENGTH - GRAM
    kind = h[lo]
    for at in (lo + GRAM, np.minimum(lo + 2 * GRAM, end), end):  # all bytes of the cell
        kind = mix(kind * GOLD + h[at])
    rel, span = a - lo, hi - lo
    kind = mix(kind * GOLD + (rel * 128 + span).astype(np.uint64))
    return h[a], kind, lo, rel, span


def chunks(texts: list[bytes], size: int = CHUNK) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Bytes of about ``size``, the text of each byte, and the place in its
    text of each byte; long texts overlap by a window less one byte."""
    part, used = [], 0
    for i, t in enumerate(texts):
        at = 0
        while True:
            take = t[at:at + size]
            part.append((i, at, take))
            used += len(take)
            if used >= size:
                yield _joined(part)
                part, used = [], 0
            if at + len(take) >= len(t):
                break
            at += len(take) - LENGTH + 1
    if used:
        yield _joined(part)


def _joined(part):
    n = [len(t) for _, _, t in part]
    return (np.frombuffer(b"".join(t for *_, t in part), np.uint8),
            np.repeat([i for i, *_ in part], n),
            np.concatenate([np.arange(at, at + len(t)) for _, at, t in part]))


CELL = np.dtype([("h", "<u8"), ("kind", "<u8"), ("doc", "<u4"), ("lo", "<u4"), ("rel", "u1"),
                 ("span", "u1")])
RUN = np.dtype([("start", "<u4"), ("count", "<u4")])


def batch_cells(texts: list[bytes]) -> np.ndarray:
    got = []
    for b, doc, place in chunks(texts):
        h, kind, lo, rel, span = cells(b, doc)
        c = np.empty(len(h), CELL)
        c["h"], c["kind"], c["rel"], c["span"] = h, kind, rel, span
        c["doc"], c["lo"] = doc[lo], place[lo]
        got.append(c)
    return np.concatenate(got) if got else np.empty(0, CELL)


def firsts(h: np.ndarray, kind: np.ndarray, did: np.ndarray, dig: np.ndarray, lo: np.ndarray
           ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of cells by (h, kind, document, place); in that order: is it the
    first of its kind, is it the very same place as the one before."""
    order = np.lexsort((lo, dig, did, kind, h))
    h, kind, did, dig, lo = (x[order] for x in (h, kind, did, dig, lo))
    same = np.zeros(len(h), bool)
    same[1:] = (h[1:] == h[:-1]) & (kind[1:] == kind[:-1])
    again = same.copy()
    again[1:] &= (did[1:] == did[:-1]) & (dig[1:] == dig[:-1]) & (lo[1:] == lo[:-1])
    return order, ~same, again


def per_doc(did: np.ndarray, dig: np.ndarray, items: np.ndarray) -> list[tuple[int, int, bytes]]:
    """(did, dig, packed items) for each document, items in their order."""
    if not len(did):
        return []
    order = np.lexsort((np.arange(len(did)), dig, did))
    did, dig, items = did[order], dig[order], items[order]
    cut = np.flatnonzero((did[1:] != did[:-1]) | (dig[1:] != dig[:-1])) + 1
    lo, hi = np.r_[0, cut], np.r_[cut, len(did)]
    return [(int(did[a]), int(dig[a]), items[a:b].tobytes()) for a, b in zip(lo, hi, strict=True)]


def by_range(did: np.ndarray, dig: np.ndarray, items: np.ndarray, ranges: int
             ) -> list[tuple[int, bytes]]:
    """(range of documents, packed ids, counts and items): a row for every range,
    not for every document."""
    at = mix(did.astype(np.uint64) * GOLD ^ dig.astype(np.uint64)) % np.uint64(ranges)
    order = np.lexsort((np.arange(len(did)), dig, did, at))
    at, did, dig, items = at[order], did[order], dig[order], items[order]
    out = []
    for part in np.split(np.arange(len(at)), np.flatnonzero(np.diff(at)) + 1):
        if len(part):
            i, g = did[part], dig[part]
            new = np.r_[True, (i[1:] != i[:-1]) | (g[1:] != g[:-1])]
            head = np.flatnonzero(new)
            counts = np.diff(np.r_[head, len(part)])
            out.append((int(at[part[0]]), b"".join(x.astype(np.int64).tobytes() for x in (
                np.array([len(head)]), i[head], g[head], counts)) + items[part].tobytes()))
    return out


def from_ranges(payloads: list[bytes], kind: np.dtype) -> dict[tuple[int, int], bytes]:
    """(did, dig) -> items, over the packed rows of one range."""
    did, dig, items = [], [], []
    for p in payloads:
        n = int(np.frombuffer(p, np.int64, 1)[0])
        i, g, counts = np.frombuffer(p, np.int64, 3 * n, 8).reshape(3, n)
        did.append(np.repeat(i, counts))
        dig.append(np.repeat(g, counts))
        items.append(np.frombuffer(p, kind, -1, 8 + 24 * n))
    if not did:
        return {}
    return {(i, g): x for i, g, x in
            per_doc(np.concatenate(did), np.concatenate(dig), np.concatenate(items))}


def as_runs(c: np.ndarray) -> np.ndarray:
    r = np.empty(len(c), RUN)
    r["start"], r["count"] = c["lo"], c["span"].astype(np.uint32) + 1
    return r


def _pack(shared):
    """Documents -> rows (bucket, did, dig, payload): bucket >= 0 packed cells
    of a batch, -1 runs of repeated windows of one document."""
    hot, buckets = shared.value

    def rows_of(texts, did, dig):
        c = batch_cells(texts)
        did, dig = np.array(did, np.int64), np.array(dig, np.int64)
        order, first, again = firsts(c["h"], c["kind"], did[c["doc"]], dig[c["doc"]], c["lo"])
        c = c[order]
        rep = ~first & ~again
        out = [(-1, a, b, p) for a, b, p in
               per_doc(did[c["doc"][rep]], dig[c["doc"][rep]], as_runs(c[rep]))]
        c = c[first]
        by = np.where(np.isin(c["h"], hot), mix(c["h"] * GOLD + c["kind"]), mix(c["h"] ^ GOLD))
        bucket = (by % np.uint64(buckets)).astype(np.int64)
        sort = np.argsort(bucket, kind="stable")
        c, bucket = c[sort], bucket[sort]
        cut = np.flatnonzero(np.diff(bucket)) + 1
        for lo, hi in zip(np.r_[0, cut], np.r_[cut, len(c)], strict=True):
            if hi > lo:
                used, at = np.unique(c["doc"][lo:hi], return_inverse=True)
                part = c[lo:hi].copy()
                part["doc"] = at
                out.append((int(bucket[lo]), 0, 0, np.int64(len(used)).tobytes()
                            + did[used].tobytes() + dig[used].tobytes() + part.tobytes()))
        return pd.DataFrame(out, columns=["bucket", "did", "dig", "payload"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        texts, did, dig, used = [], [], [], 0
        for pdf in batches:
            for i, g, t in zip(pdf["did"], pdf["dig"], pdf["t_"], strict=True):
                texts.append(t.encode("utf-8", "surrogatepass"))
                did.append(i)
                dig.append(g)
                used += len(texts[-1])
                if used >= BATCH_BYTES:
                    yield rows_of(texts, did, dig)
                    texts, did, dig, used = [], [], [], 0
        if texts:
            yield rows_of(texts, did, dig)
    return run


def _collapse(shared, ranges: int):
    """A bucket's cells -> a row per range of documents: runs (repeated windows)
    of all but the first cell of a kind, and the cells whose bytes must be
    compared."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        hot = shared.value[0]
        got, did, dig = [], [], []
        for p in pdf["payload"]:
            n = int(np.frombuffer(p, np.int64, 1)[0])
            d, g = np.frombuffer(p, np.int64, n, 8), np.frombuffer(p, np.int64, n, 8 + 8 * n)
            c = np.frombuffer(p, CELL, -1, 8 + 16 * n)
            got.append(c)
            did.append(d[c["doc"]])
            dig.append(g[c["doc"]])
        c, did, dig = np.concatenate(got), np.concatenate(did), np.concatenate(dig)
        order, first, again = firsts(c["h"], c["kind"], did, dig, c["lo"])
        c, did, dig = c[order], did[order], dig[order]
        rep = ~first & ~again
        out = [(r, p, b"") for r, p in by_range(did[rep], dig[rep], as_runs(c[rep]), ranges)]
        c, did, dig = c[first], did[first], dig[first]
        h = c["h"]
        shared_h = np.zeros(len(h), bool)
        shared_h[1:] |= h[1:] == h[:-1]
        shared_h[:-1] |= h[1:] == h[:-1]
        shared_h |= np.isin(h, hot)
        out += [(r, b"", p) for r, p in
                by_range(did[shared_h], dig[shared_h], c[shared_h], ranges)]
        return pd.DataFrame(out, columns=["r", "runs", "cells"])
    return run


def _per_document(pdf: pd.DataFrame) -> pd.DataFrame:
    """A range's packed rows -> one row per document."""
    runs = from_ranges([p for p in pdf["runs"] if p], RUN)
    cells_of = from_ranges([p for p in pdf["cells"] if p], CELL)
    return pd.DataFrame([(i, g, runs.get((i, g), b""), cells_of.get((i, g), b""))
                         for i, g in {**runs, **cells_of}], columns=["did", "dig", "runs", "cells"])


def _cut_out(shared):
    """Documents with the cells wanted of them -> one row per cell with its bytes."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hot = set(shared.value[0].tolist())
        for pdf in batches:
            out = []
            for i, g, t, packed in zip(pdf["did"], pdf["dig"], pdf["t_"], pdf["cells"], strict=True):
                b = t.encode("utf-8", "surrogatepass")
                for h, _, _, lo, rel, span in np.frombuffer(b"".join(packed), CELL).tolist():
                    out.append((h - (1 << 64) if h >> 63 else h, h in hot, i, g, lo, rel, span,
                                b[lo:lo + span + LENGTH]))
            yield pd.DataFrame(out, columns=["h", "hot", "did", "dig", "lo", "rel", "span", "bytes"])
    return run


def sorted_by_right(right: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Lexicographic order of strings of at most LENGTH bytes: the suffix array
    of all of them, in pieces, read at their first positions; and the strings as
    a matrix of byte + 1, 0 past their ends."""
    m, n_pieces = len(right), -(-LENGTH // PIECE)
    flat = np.zeros((m, n_pieces * PIECE), ">u2")
    for at in range(0, m, 4096):  # a part at a time: the matrix is the largest thing here
        part = right[at:at + 4096]
        sizes = np.array([len(x) for x in part])
        flat[at:at + 4096][np.arange(flat.shape[1])[None, :] < sizes[:, None]] = (
            np.frombuffer(b"".join(part), np.uint8).astype(np.uint16) + 1)
    pieces = np.ascontiguousarray(flat).view(f"S{2 * PIECE}").reshape(m, n_pieces)
    _, rank = np.unique(pieces, return_inverse=True)
    s = np.zeros(m * (n_pieces + 1) + 1, np.int64)  # 1 ends a string, 0 ends all
    rows = s[:-1].reshape(m, n_pieces + 1)
    rows[:, :-1] = rank.reshape(m, n_pieces) + 2
    rows[:, -1] = 1
    sa = np.frombuffer(suffix_order(s), np.int64)
    heads = sa[sa % (n_pieces + 1) == 0] // (n_pieces + 1)
    return heads[heads < m], flat


def repeats(pdf: pd.DataFrame) -> list[tuple[int, int, bytes]]:
    """Runs of repeated windows by document among cells that share anchors."""
    pdf = pdf.sort_values(["did", "dig", "lo"]).reset_index(drop=True)
    rel = pdf["rel"].to_numpy(np.int64)
    span = pdf["span"].to_numpy(np.int64)
    lo = pdf["lo"].to_numpy(np.int64)
    order, flat = sorted_by_right([b[r:r + LENGTH] for b, r in zip(pdf["bytes"], rel, strict=True)])
    f = flat[order]
    common = np.cumprod((f[1:] == f[:-1]) & (f[1:] > 0), axis=1, dtype=np.uint8).sum(axis=1)
    del f, flat
    left = np.zeros((len(pdf), SPAN), np.uint8)
    for i, (b, r) in enumerate(zip(pdf["bytes"], rel, strict=True)):
        left[i, :r] = np.frombuffer(b, np.uint8, r)[::-1]
    before = np.zeros(len(pdf), np.uint64)
    who, start = [], []
    for off in range(SPAN):
        if off:
            before = mix(before * GOLD + left[:, off - 1].astype(np.uint64) + np.uint64(1))
        run_sorted = np.r_[0, np.cumsum(common < LENGTH - off)]
        run = np.empty(len(pdf), np.int64)
        run[order] = run_sorted
        has = np.flatnonzero((off <= rel) & (off >= rel - span))
        if len(has) < 2:
            continue
        key = mix(before[has] + run[has].astype(np.uint64) * GOLD)
        by = np.argsort(key, kind="stable")  # rows are in document order already
        k = key[by]
        later = np.zeros(len(k), bool)
        later[1:] = k[1:] == k[:-1]
        hit = has[by[later]]
        who.append(hit.astype(np.int32))
        start.append((lo[hit] + rel[hit] - off).astype(np.int32))
    if not who:
        return []
    who, start = np.concatenate(who), np.concatenate(start)
    order = np.lexsort((start, who))
    who, start = who[order], start[order]
    new = np.ones(len(who), bool)
    new[1:] = (who[1:] != who[:-1]) | (start[1:] != start[:-1] + 1)
    at = np.flatnonzero(new)
    r = np.empty(len(at), RUN)
    r["start"], r["count"] = start[at], np.diff(np.r_[at, len(who)])
    return per_doc(pdf["did"].to_numpy(np.int64)[who[at]], pdf["dig"].to_numpy(np.int64)[who[at]], r)


def _repeats(pdf: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame(repeats(pdf.drop(columns="g")), columns=["did", "dig", "runs"])


def _windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Cells -> one row per window with a digest of its bytes."""
    for pdf in batches:
        out = []
        for i, g, lo, span, b in zip(pdf["did"], pdf["dig"], pdf["lo"], pdf["span"], pdf["bytes"],
                                     strict=True):
            out += [(hashlib.blake2b(b[k:k + LENGTH], digest_size=16).digest(), i, g, lo + k)
                    for k in range(span + 1)]
        yield pd.DataFrame(out, columns=["window", "did", "dig", "start"])


def hot_repeats(cut: DataFrame) -> DataFrame:
    """Runs of repeated windows among cells of hot anchors, by window digest."""
    w = cut.mapInPandas(_windows, "window binary, did long, dig long, start int")
    first = w.groupBy("window").agg(F.min(F.struct("did", "dig", "start")).alias("f"))
    later = w.join(first, "window").filter(
        F.struct("did", "dig", "start") != F.col("f")).select("did", "dig", "start")
    big = F.lpad(F.hex("start"), 8, "0")  # a RUN of one window, little-endian
    one = F.unhex(F.concat(*[F.substring(big, i, 2) for i in (7, 5, 3, 1)], F.lit("01000000")))
    return later.select("did", "dig", one.alias("runs"))


def spans_of(runs: list[bytes], length: int = LENGTH) -> list[tuple[int, int]]:
    """Merged byte ranges that the windows of packed runs cover."""
    if not runs:
        return []
    r = np.sort(np.concatenate([np.frombuffer(p, RUN) for p in runs]), order="start")
    start = r["start"].astype(np.int64)
    end = np.maximum.accumulate(start + r["count"].astype(np.int64) + length - 1)
    new = np.r_[True, start[1:] > end[:-1]]
    at = np.flatnonzero(new)
    return list(zip(start[at].tolist(), end[np.r_[at[1:], len(r)] - 1].tolist(), strict=True))


def _finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        out = []
        for t, runs in zip(pdf["t_"], pdf["runs"], strict=True):
            b = t.encode("utf-8", "surrogatepass")
            spans = spans_of(list(runs) if runs is not None else [])
            h, at, gone = hashlib.sha256(), 0, 0
            for lo, hi in spans:
                h.update(b[at:lo])
                at = hi
                gone += hi - lo
            h.update(b[at:])
            out.append((len(b), gone, [{"a": a, "b": z} for a, z in spans], h.hexdigest()))
        got = pd.DataFrame(out, columns=["n_bytes", "n_removed", "spans", "kept_sha256"])
        yield pd.concat([pdf[["did"]].reset_index(drop=True), got], axis=1)


NO_ID = -(1 << 63)


def hot_anchors(d: DataFrame, n_docs: int) -> np.ndarray:
    """Anchor hashes in at least ``HOT_LEAST`` of about ``HOT_SAMPLE`` documents."""
    share = min(1.0, HOT_SAMPLE / max(1, n_docs))
    sample = d.filter(F.pmod(F.xxhash64("did", "dig"), F.lit(1 << 20)) < F.lit(share * (1 << 20)))

    def run(batches):
        for pdf in batches:
            out = []
            for t in pdf["t_"]:
                if len(t) <= CHUNK:
                    b = np.frombuffer(t.encode("utf-8", "surrogatepass"), np.uint8)
                    out.append(np.unique(cells(b, np.zeros(len(b), np.int64))[0]).view(np.int64))
            yield pd.DataFrame({"h": np.concatenate(out) if out else np.empty(0, np.int64)})
    found = (sample.mapInPandas(run, "h long").groupBy("h").count()
             .filter(F.col("count") >= HOT_LEAST).select("h").collect())
    return np.sort(np.array([r.h for r in found], np.int64)).view(np.uint64)


def repeated_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, spans (byte ranges [a, b) to remove) and
    kept_sha256 of every row.

    Null or empty text: no bytes.  Texts of under ``LENGTH`` bytes keep all.
    Rows of one id with different texts are documents of their own, ordered by
    a digest of the text; rows equal in id and text are one document, and each
    gets its result.  Null ids come first.  An empty table gives no rows; other
    columns are ignored.
    """
    spark = docs.sparkSession
    small_batches(spark)
    d = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("did"),
                    F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("dig"),
                    F.coalesce(F.col(text), F.lit("")).alias("t_"))
    n_docs, n_bytes = (int(x or 0) for x in d.agg(
        F.count(F.lit(1)), F.sum(F.octet_length("t_").cast("long"))).first())
    buckets = max(1, -(-n_bytes // BUCKET_BYTES))
    shared = spark.sparkContext.broadcast((hot_anchors(d, n_docs), buckets))
    with files_of_shuffles_go(spark):
        packed = written(d.filter(F.octet_length("t_") >= LENGTH).mapInPandas(
            _pack(shared), "bucket int, did long, dig long, payload binary"), "suffix-cells")
        near = packed.filter("bucket < 0").select("did", "dig", F.col("payload").alias("runs"))
        ranges = max(1, -(-n_bytes // RANGE_BYTES))
        flagged = written(
            packed.filter("bucket >= 0").groupBy("bucket").applyInPandas(
                _collapse(shared, ranges), "r int, runs binary, cells binary")
            .groupBy("r").applyInPandas(
                _per_document, "did long, dig long, runs binary, cells binary"), "suffix-flags")
        wanted = flagged.filter(F.length("cells") > 0).select("did", "dig", F.array("cells").alias("cells"))
        # Rows equal in id and text ask for the same cells: one of them answers.
        once = d.join(wanted, ["did", "dig"]).groupBy("did", "dig").agg(
            F.first("t_").alias("t_"), F.first("cells").alias("cells"))
        cut = written(once.mapInPandas(
            _cut_out(shared), "h long, hot boolean, did long, dig long, lo int, rel int, span int, "
                              "bytes binary"), "suffix-cut")
        # Exact counts: an anchor with more cells than a group should hold takes the
        # route without groups as well, whatever the sample saw.
        loaded = written(cut.filter("not hot").groupBy("h").count()
                         .filter(F.col("count") > CELLS_PER_ANCHOR)
                         .select("h", F.lit(True).alias("loaded")), "suffix-loaded")
        any_loaded = not loaded.isEmpty()
        if any_loaded:
            cut = cut.join(loaded, "h", "left").withColumn(
                "hot", F.col("hot") | F.coalesce("loaded", F.lit(False))).drop("loaded")
        size = int(cut.agg(F.sum(F.length("bytes").cast("long"))).first()[0] or 0)
        groups = max(1, -(-size // CONTEXT_BUCKET))
        found = (cut.filter("not hot").withColumn("g", F.pmod(F.xxhash64("h"), F.lit(groups)))
                 .groupBy("g").applyInPandas(_repeats, "did long, dig long, runs binary"))
        runs = near.unionByName(flagged.filter(F.length("runs") > 0).select("did", "dig", "runs")
                                ).unionByName(found)
        if len(shared.value[0]) or any_loaded:
            runs = runs.unionByName(hot_repeats(cut.filter("hot")))
        by_doc = written(runs.groupBy("did", "dig").agg(F.collect_list("runs").alias("runs")),
                         "suffix-runs")
    out = d.join(by_doc, ["did", "dig"], "left").select("did", "t_", "runs").mapInPandas(
        _finish, "did long, n_bytes long, n_removed long, spans array<struct<a:long,b:long>>, "
                 "kept_sha256 string")
    return out.select(F.when(F.col("did") != NO_ID, F.col("did")).alias("doc_id"), "n_bytes",
                      "n_removed", "spans", "kept_sha256")


def op5_lyndon_suffixes(spark, sf_dir: str) -> DataFrame:
    got = repeated_spans(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
                      "kept_sha256")
