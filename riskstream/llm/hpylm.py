"""Hierarchical Pitman-Yor language model (operator 1).

Every token is a customer of the restaurant of its context, the restaurants
share one parent (the unigram restaurant), whose base is uniform over the
training vocabulary and one unknown word.  The context is the whole previous
word, by its 64-bit hash; every one that occurs has a restaurant of its own, so
the restaurants grow with the corpus as the dishes (context, word, count) do.

Seating is sampled by blocked Gibbs sweeps: given the totals of all
restaurants, the tables of each (context, word) are reseated customer by
customer, in parallel over words; then the parent seats one customer a table.
A bucket of words holds the totals of the contexts that occur in it.  After a
sweep every bucket sends its part of these, cut by ranges of the context's hash;
the parts of one range are summed in a group and the sums go back in a written
table.  A context has at most one entry a bucket, so none is a hot key.  Random
numbers are hashes of (word, context, step, sweep), so lost tasks are redone
alike.  The predictive probability is averaged over the sweeps after the burn-in.

The corpus is read twice: to count each batch's distinct (word, context) pairs
by word bucket, and to send each batch's tokens (word, context, document) to the
buckets to be scored; no copy of the tokens is kept.  A word frequent enough to
load a bucket is dealt over several by context, so every dish is in one bucket.
Which words are dealt is judged on a sample: it moves load, never a result.  The tables of such a word go around like those of
a context, under a name of the word's own, and its range seats the parent.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskstream.llm.common import LOWER, files_of_shuffles_go, small_batches, table, written

CONTEXTS = 1 << 20  # about so many contexts of buckets are summed in one group
START = np.uint64(0x5354415254)  # the context of a text's first token
WORD_NAME = np.uint64(0x7A5E1D0C3B2F4968)  # sets names of dealt words apart from contexts
END = b"\n"  # no word holds white space
BURN_IN = 2
SAMPLES = 3
TOKENS_PER_BUCKET = 2_500_000
ONE_BY_ONE = 48
SEATS = 1 << 18  # customers held at a time when they are seated in runs
STRENGTH = 5.0
NO_ID = -(1 << 63)  # stands for a null id inside the packed rows
PACK_TOKENS = 2_000_000
TOKEN_BYTES = 6  # about; sizes the buckets
LAYOUT_TEXTS = 20_000  # about so many texts tell which words to deal


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(LOWER).split() if text else []


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(words: list[bytes]) -> np.ndarray:
    if not words:
        return np.empty(0, np.uint64)
    return pd.util.hash_array(np.array(words, dtype=object), categorize=False)


# --- counting ---------------------------------------------------------------

def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts: Counter[bytes] = Counter()

    def flush() -> pd.DataFrame:
        out = pd.DataFrame({"word": list(counts), "n": list(counts.values())})
        counts.clear()
        return out
    for pdf in batches:
        for text in pdf["t_"]:
            counts.update(words_of(text))
            counts[END] += 1
        if len(counts) > 300_000:
            yield flush()
    if counts:
        yield flush()


def dealt_words(texts: DataFrame, n_texts: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of the words with over a quarter of a bucket's share of the
    tokens of a sample, and over how many buckets each is dealt; there are fewer
    than four such words a bucket."""
    loaded = []
    if buckets > 1:
        some = texts.sample(fraction=min(1.0, LAYOUT_TEXTS / n_texts), seed=1)
        counts = written(some.select("t_").mapInPandas(_count, "word binary, n long")
                         .groupBy("word").agg(F.sum("n").alias("n")), "hpylm-layout")
        total = counts.agg(F.sum("n")).first()[0] or 1
        loaded = counts.filter(F.col("n") * (4 * buckets) > total).collect()
    keys = word_hashes([bytes(r.word) for r in loaded])
    ways = np.array([min(buckets, -(-r.n * buckets * 4 // total)) for r in loaded], np.int64)
    order = np.argsort(keys)
    return keys[order], ways[order]


# --- packing ----------------------------------------------------------------

def bucket_of(h: np.ndarray, n: int) -> np.ndarray:
    return (mix(h ^ np.uint64(0x51ED270B)) % np.uint64(n)).astype(np.int64)


def ways_of(h: np.ndarray, spread: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Over how many buckets each word is dealt (1 for most)."""
    keys, ways = spread
    out = np.ones(len(h), np.int64)
    if len(keys):
        i = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
        found = keys[i] == h
        out[found] = ways[i[found]]
    return out


def names_of(words: np.ndarray) -> np.ndarray:
    """The names under which the totals of dealt words go around."""
    return mix(words ^ WORD_NAME)


def packed_arrays(*arrays: np.ndarray) -> bytes:
    """Arrays in one value, each deflated: ascending 64-bit hashes by their gaps,
    of which only the two highest bytes repeat themselves; numbers (not negative)
    by as many bytes as the largest needs, all lowest bytes first."""
    parts = []
    for a in arrays:
        if a.dtype == np.uint64:
            gaps = np.diff(a, prepend=np.uint64(0))
            parts.append(zlib.compress((gaps >> np.uint64(48)).astype(np.uint16).tobytes(), 1)
                         + (gaps >> np.uint64(32)).astype(np.uint16).tobytes()
                         + gaps.astype(np.uint32).tobytes())
        else:
            a = a.astype(np.int64, copy=False)
            width = max(1, (int(a.max()).bit_length() + 7) // 8) if len(a) else 1
            raw = b"".join((a >> 8 * i).astype(np.uint8).tobytes() for i in range(width))
            parts.append(bytes([width]) + zlib.compress(raw, 1))
    return np.array([len(p) for p in parts], np.int64).tobytes() + b"".join(parts)


def unpacked(blob: bytes, *kinds: type) -> list[np.ndarray]:
    ends = 8 * len(kinds) + np.cumsum(np.frombuffer(blob, np.int64, len(kinds)))
    starts = [8 * len(kinds), *ends[:-1]]
    out = []
    for a, b, kind in zip(starts, ends, kinds, strict=True):
        if kind == np.uint64:
            inflate = zlib.decompressobj()
            top = np.frombuffer(inflate.decompress(blob[a:b]), np.uint16)
            low, n = inflate.unused_data, len(top)
            gaps = (top.astype(np.uint64) << np.uint64(48)) | np.frombuffer(low, np.uint32, n, 2 * n)
            gaps |= np.frombuffer(low, np.uint16, n).astype(np.uint64) << np.uint64(32)
            out.append(np.cumsum(gaps, dtype=np.uint64))
        else:
            planes = np.frombuffer(zlib.decompress(blob[a + 1:b]), np.uint8).reshape(blob[a], -1)
            got = planes[0].astype(np.int64)
            for i in range(1, len(planes)):
                got |= planes[i].astype(np.int64) << 8 * i
            out.append(got.astype(kind, copy=False))
    return out


def gaps_in(runs: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """Numbers that ascend in each run, as the steps between them."""
    first = np.cumsum(runs, dtype=np.int64) - runs
    out = np.diff(numbers.astype(np.int64), prepend=0)
    out[first] = numbers[first]
    return out


def from_gaps(runs: np.ndarray, gaps: np.ndarray) -> np.ndarray:
    first = np.cumsum(runs, dtype=np.int64) - runs
    total = np.cumsum(gaps, dtype=np.int64)
    return total - np.repeat(total[first] - gaps[first], runs)


class Batch:
    """Documents as they come: tokens are numbered by the batch's vocabulary."""

    def __init__(self):
        self.numbers: defaultdict[bytes, int] = defaultdict()
        self.numbers.default_factory = self.numbers.__len__  # the next number
        self.tokens: list[np.ndarray] = []
        self.ids: list[int] = []
        self.held: list[bool] = []
        self.size = 0

    def add(self, doc_id: int, held: bool, text: str | None) -> None:
        words = words_of(text)
        words.append(END)
        self.tokens.append(np.fromiter(map(self.numbers.__getitem__, words), np.int32, len(words)))
        self.ids.append(doc_id)
        self.held.append(held)
        self.size += len(words)

    def full(self) -> bool:
        return self.size >= PACK_TOKENS or len(self.ids) >= 60_000

    def by_bucket(self, spread: tuple[np.ndarray, np.ndarray], buckets: int):
        """Sorted hashes of the vocabulary (and of a text's start), documents'
        lengths and the tokens' sort key: bucket, word and context in the bits of
        one number, as many for each of the latter as the vocabulary needs."""
        hashes = np.append(word_hashes(list(self.numbers)), START)
        size = len(hashes)
        order, rank = np.argsort(hashes), np.empty(size, np.int64)
        rank[order] = np.arange(size)
        hashes = hashes[order]
        lengths = np.array([len(t) for t in self.tokens])
        word = rank[np.concatenate(self.tokens)]
        ctx = np.empty_like(word)
        ctx[1:] = word[:-1]
        ctx[np.cumsum(lengths) - lengths] = rank[-1]
        place = bucket_of(hashes, buckets)[word]
        ways = ways_of(hashes, spread)
        if (ways > 1).any():
            dealt = np.flatnonzero(ways[word] > 1)
            w = word[dealt]
            turn = mix(hashes[ctx[dealt]] ^ hashes[w]) % ways[w].astype(np.uint64)
            place[dealt] = (place[dealt] + turn.astype(np.int64)) % buckets
        bits = size.bit_length()
        return hashes, lengths, (((place << bits) | word) << bits) | ctx


def split_rows(hashes: np.ndarray, key: np.ndarray, *values: np.ndarray
               ) -> Iterator[tuple[int, bytes]]:
    """(bucket, payload) of sorted keys with a value each: word hashes, context
    hashes, keys a word, contexts (places among their hashes), values."""
    bits = len(hashes).bit_length()
    ctx, word, place = key & ((1 << bits) - 1), (key >> bits) & ((1 << bits) - 1), key >> 2 * bits
    seen, number = np.zeros(len(hashes), bool), np.empty(len(hashes), np.int64)
    cuts = np.flatnonzero(np.diff(place)) + 1
    for lo, hi in zip(np.r_[0, cuts], np.r_[cuts, len(key)], strict=True):
        w = word[lo:hi]
        new = np.flatnonzero(np.r_[True, w[1:] != w[:-1]])
        runs = np.diff(np.r_[new, hi - lo]).astype(np.uint32)
        c = ctx[lo:hi]
        seen[c] = True
        own = np.flatnonzero(seen)
        seen[own] = False
        number[own] = np.arange(len(own))
        yield int(place[lo]), packed_arrays(
            hashes[w[new]], hashes[own], runs, gaps_in(runs, number[c]), *[v[lo:hi] for v in values])


def read_rows(payload: bytes, *kinds: type) -> list[np.ndarray]:
    h, own, runs, gaps, *values = unpacked(payload, np.uint64, np.uint64, np.int64, np.int64, *kinds)
    return [h, own, runs, from_gaps(runs, gaps), *values]


def _in_batches(pack):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        batch, done = Batch(), 0
        task = TaskContext.get().partitionId()
        for pdf in batches:
            for i, h, t in zip(pdf["d_"], pdf["h_"], pdf["t_"], strict=True):
                batch.add(i, h, t)
                if batch.full():
                    yield pack(batch, f"{task}-{done}")
                    batch, done = Batch(), done + 1
        if batch.ids:
            yield pack(batch, f"{task}-{done}")
    return run


def _pack_counts(model):
    """Texts -> per batch and bucket the distinct pairs with their counts in
    training texts, which are 0 where a pair is only scored."""
    def pack(batch: Batch, name: str) -> pd.DataFrame:
        hashes, lengths, key = batch.by_bucket(*model.value)
        trains = np.repeat(~np.array(batch.held, bool), lengths)
        key = np.sort(key * 2 + trains)
        new = np.flatnonzero(np.r_[True, np.diff(key >> 1) != 0])
        count = np.add.reduceat((key & 1).astype(np.uint32), new, dtype=np.uint32)
        return pd.DataFrame(list(split_rows(hashes, key[new] >> 1, count)),
                            columns=["bucket", "payload"])
    return _in_batches(pack)


def _pack_tokens(model):
    """Texts -> per batch and bucket the tokens to score (kind ``t``), and per
    batch its documents (kind ``d``)."""
    def pack(batch: Batch, name: str) -> pd.DataFrame:
        buckets = model.value[1]
        hashes, lengths, key = batch.by_bucket(*model.value)
        doc, bits = np.repeat(np.arange(len(lengths)), lengths), len(lengths).bit_length()
        if int(key.max()).bit_length() + bits < 64:  # one number sorts faster than an order
            key = np.sort(key << bits | doc)
            key, doc = key >> bits, key & ((1 << bits) - 1)
        else:
            order = np.argsort(key, kind="stable")
            key, doc = key[order], doc[order]
        out = [(b, "t", name, b"", p) for b, p in split_rows(hashes, key, doc)]
        out.append((zlib.crc32(name.encode()) % buckets, "d", name,
                    np.array(batch.ids, np.int64).tobytes() + np.array(batch.held, np.uint8).tobytes(),
                    lengths.astype(np.int64).tobytes()))
        return pd.DataFrame(out, columns=["bucket", "kind", "batch", "head", "payload"])
    return _in_batches(pack)


# --- seating ----------------------------------------------------------------

def uniforms(key: np.ndarray, step: int | np.ndarray, sweep: int) -> np.ndarray:
    seed = (np.atleast_1d(step).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            + np.uint64((sweep * 0xD1B54A32D192ED03 + 1) & 0xFFFFFFFFFFFFFFFF))
    return ((mix(key + seed) >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0 ** 53


def seat(count: np.ndarray, open_mass: np.ndarray, discount: float, key: np.ndarray,
         sweep: int) -> np.ndarray:
    """Tables of dishes with ``count`` customers each, seated one by one: a new
    table has weight ``open_mass`` (strength and discount mass times the
    parent's probability), the occupied ones the customers less the discounts.

    The first ``ONE_BY_ONE`` customers of all dishes are seated in step, those
    after them in runs: who opens a table depends on the tables opened before in
    the run, so that is worked out again until nothing changes, which is the
    seating one by one.  Every customer has a random number of its own.
    """
    tables = np.minimum(count, 1).astype(np.float64)
    live = np.flatnonzero(count > 1)
    n = 1
    while len(live):
        if n < ONE_BY_ONE:
            size = 1
            t = tables[live]
            u = uniforms(key[live], n, sweep)
            tables[live] = t + (u * (open_mass[live] + n - discount * t) < open_mass[live])
        else:
            size = min(n // 4, SEATS)
            rows = max(1, SEATS // size)
            for lo in range(0, len(live), rows):
                part = live[lo:lo + rows]
                tables[part] += _run(n, size, count[part], open_mass[part], discount,
                                     tables[part], key[part], sweep)
        n += size
        live = live[count[live] > n]
    return tables


def _run(n: int, size: int, count: np.ndarray, open_mass: np.ndarray, discount: float,
         tables: np.ndarray, key: np.ndarray, sweep: int) -> np.ndarray:
    """Tables that customers n to n + size - 1 of each dish open."""
    step = n + np.arange(min(size, int(count.max()) - n))
    here = step[None, :] < count[:, None]
    mass = open_mass[:, None]
    u = uniforms(key[:, None], step, sweep)
    rest = mass + step[None, :] - discount * tables[:, None]
    opens = np.zeros(u.shape, bool)
    while True:
        before = np.cumsum(opens, axis=1) - opens
        again = (u * (rest - discount * before) < mass) & here
        if (again == opens).all():
            return opens.sum(axis=1)
        opens = again


def root_key(words: np.ndarray) -> np.ndarray:
    return mix(words ^ np.uint64(0xABCDEF))


class Dishes:
    """Training counts of one bucket: words (sorted hashes) and, by word, the
    contexts (places in ``names``, the sorted hashes of the bucket's contexts)
    with their counts."""

    def __init__(self, word: np.ndarray, ctx: np.ndarray, count: np.ndarray, merged: bool = False,
                 names: np.ndarray | None = None):
        if not merged:
            order = np.lexsort((ctx, word))
            word, ctx, count = word[order], ctx[order], count[order]
            new = np.r_[True, (word[1:] != word[:-1]) | (ctx[1:] != ctx[:-1])][:len(word)]
            at = np.flatnonzero(new)
            word, ctx = word[at], ctx[at]
            count = np.add.reduceat(count, at) if len(at) else np.empty(0, np.int64)
        self.word, self.ctx, self.count = word, ctx, count
        first = np.flatnonzero(np.r_[True, self.word[1:] != self.word[:-1]][:len(self.word)])
        self.words = self.word[first]
        self.group = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(self.word)]))
        self.total = (np.bincount(self.group, self.count, len(first)).astype(np.int64)
                      if len(first) else np.empty(0, np.int64))
        self.names = names
        of = self.ctx.astype(np.uint64) if names is None else names[self.ctx]
        self.key = mix(self.word * np.uint64(0x9E3779B97F4A7C15) + of)
        self.root_key = root_key(self.words)

    def sweep(self, g: dict, root: np.ndarray, turn: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Reseat everything given the totals ``g``: tables of each dish, then
        the parent's customers and tables of each word."""
        mass = (STRENGTH + g["d"] * g["tables"][self.ctx]) * root[self.group]
        t = seat(self.count, mass, g["d"], self.key, turn)
        c0 = np.bincount(self.group, t, len(self.words)).astype(np.int64)
        base = np.full(len(self.words), (STRENGTH + g["d0"] * g["root_tables"]) / (g["v"] + 1))
        return t, c0, seat(c0, base, g["d0"], self.root_key, turn + 500)

    @staticmethod
    def parent(g: dict, c0: np.ndarray, t0: np.ndarray) -> np.ndarray:
        new = (STRENGTH + g["d0"] * g["root_tables"]) / (g["v"] + 1)
        return (c0 - g["d0"] * t0 + new) / (STRENGTH + g["root_customers"])


NO_DISHES = Dishes(np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64),
                   names=np.empty(0, np.uint64))


def sweeps(d: Dishes, history: list[dict], root: np.ndarray | None = None, turn: int = 0
           ) -> Iterator[tuple[dict, np.ndarray, np.ndarray, np.ndarray]]:
    """(totals, tables, the parent's customers and tables) of a sweep for each of
    the totals given; ``root`` are the words' probabilities before the first."""
    if root is None:  # before any sweep: the unigram frequencies
        root = (d.total + 0.5) / (history[0]["n"] + 0.5 * (history[0]["v"] + 1))
    for g in history:
        t, c0, t0 = d.sweep(g, root, turn)
        yield g, t, c0, t0
        turn += 1
        root = d.parent(g["next"], c0, t0) if "next" in g else root


def dishes_of(payloads, bucket: int, spread: tuple[np.ndarray, np.ndarray], buckets: int) -> Dishes:
    """The counts of a bucket's rows.  The contexts are those of all tokens, also
    of the ones that are only scored.  Every dealt word that may come here has an
    empty dish, so that the bucket knows it, and its name among the contexts'."""
    keys, ways = spread
    here = keys[(bucket - bucket_of(keys, buckets)) % buckets < ways]
    got = [read_rows(p, np.uint32) for p in payloads if p]
    start = np.full(min(1, len(here)), START)
    words = np.unique(np.concatenate([here, *[g[0] for g in got]]))
    names = np.unique(np.concatenate([start, names_of(here), *[g[1] for g in got]]))
    # A pair is one number, word before context, both by place.
    pairs = [np.searchsorted(words, here) * len(names) + np.searchsorted(names, START)]
    counts = [np.zeros(len(here), np.uint32)]
    for h, own, runs, ctx, n in got:
        use = n > 0
        pairs.append((np.repeat(np.searchsorted(words, h), runs) * len(names)
                      + np.searchsorted(names, own)[ctx])[use])
        counts.append(n[use])
    pair, count = np.concatenate(pairs), np.concatenate(counts)
    order = np.argsort(pair)
    pair, count = pair[order], count[order]
    at = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]][:len(pair)])
    count = np.add.reduceat(count, at, dtype=np.int64) if len(at) else np.empty(0, np.int64)
    word, ctx = np.divmod(pair[at], max(1, len(names)))
    return Dishes(words[word], ctx, count, merged=True, names=names)


def _pack_dishes(model):
    """All rows of a bucket -> one row with its dishes."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        spread, buckets = model.value
        b = int(pdf["bucket"].iloc[0])
        d = dishes_of(pdf["payload"], b, spread, buckets)
        runs = np.bincount(d.group, minlength=len(d.words)).astype(np.int64)
        return pd.DataFrame({"bucket": [b], "contexts": [len(d.names)], "dishes": [packed_arrays(
            d.words, d.names, runs, gaps_in(runs, d.ctx), d.count)]})
    return run


def load_dishes(blob: bytes, spread: tuple[np.ndarray, np.ndarray]
                ) -> tuple[Dishes, np.ndarray, np.ndarray]:
    """A bucket's dishes, which of its words are dealt and where their names are."""
    words, names, runs, gaps, count = unpacked(
        blob, np.uint64, np.uint64, np.int64, np.int64, np.int64)
    d = Dishes(np.repeat(words, runs), from_gaps(runs, gaps), count, merged=True, names=names)
    dealt = np.flatnonzero(ways_of(d.words, spread) > 1)
    return d, dealt, np.searchsorted(names, names_of(d.words[dealt]))


# Rows that go around between sweeps: ``a`` a bucket's dishes, ``b`` its seating
# (parent's customers and tables of each word), ``g`` totals of its contexts in
# one range of hashes, ``s`` tables of each dish summed over the samples.
ROW = "bucket int, kind string, turn int, part int, payload binary, sums array<double>"
ROOT_CUSTOMERS, ROOT_TABLES, ONES, TWOS, ROOT_ONES, ROOT_TWOS, TOKENS, WORDS = range(8)


def by_bucket(rows: Iterator[pd.DataFrame], then) -> Iterator[list]:
    """``then(bucket, rows)`` of each bucket; rows are sorted by bucket, the
    dishes first, and held for one bucket at a time."""
    at, held = None, []
    for pdf in rows:
        for r in pdf.itertuples(index=False):
            if r.bucket != at and held:
                yield then(at, held)
                held = []
            at = r.bucket
            held.append(r)
    if held:
        yield then(at, held)


def joined_totals(rows: list) -> np.ndarray:
    """(customers, tables) of a bucket's contexts from its ranges, which are in
    the order of the hashes."""
    got = [unpacked(r.payload, np.int64, np.int64) for r in sorted(rows, key=lambda r: r.part)]
    return np.array([np.concatenate([np.empty(0), *[x[i] for x in got]]) for i in (0, 1)])


def part_of(names: np.ndarray, parts: int) -> np.ndarray:
    """The range of each (sorted) context hash."""
    return ((names >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _sweep(shared):
    """The rows of a turn: per bucket its share of the totals of contexts and
    dealt words by range (customers before any sweep, tables always; those with
    one table a dish before any sweep), its seating, and before any sweep how
    many dishes have one or two customers."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        history, parts, keep, spread = shared.value
        turn = len(history)

        def one(bucket: int, rows: list) -> pd.DataFrame:
            d, dealt, at_name = load_dishes(rows[0].payload, spread)
            local = np.ones(len(d.words), bool)
            local[dealt] = False
            sums = np.zeros(8)
            n = len(d.names)
            out = []
            if turn:
                root = samples = None
                first, tables = joined_totals([r for r in rows if r.kind == "g"])
                if turn == 1:
                    d.total[dealt] = first[at_name]
                for r in rows:
                    if r.kind == "s":
                        samples, = unpacked(r.payload, np.int64)
                    if r.kind == "b":
                        c0, t0 = unpacked(r.payload, np.int64, np.int64)
                        root = parent_of(d, history[-1], c0, t0, dealt, tables[at_name], first[at_name])
                (_, t, c0, t0), = sweeps(d, [history[-1] | {"tables": tables}], root, turn - 1)
                sums[ROOT_CUSTOMERS], sums[ROOT_TABLES] = c0[local].sum(), t0[local].sum()
                out.append((bucket, "b", turn, -1 - bucket, packed_arrays(c0, t0), sums))
                if keep:
                    samples = t if samples is None else samples + t
                    out.append((bucket, "s", turn, -1 - bucket, packed_arrays(samples), np.zeros(8)))
                customers = np.zeros(n, np.int64)
            else:
                t = np.minimum(d.count, 1)
                c0 = np.bincount(d.group, t, len(d.words)).astype(np.int64)
                for i, x in ((ONES, d.count == 1), (TWOS, d.count == 2),
                             (ROOT_ONES, c0[local] == 1), (ROOT_TWOS, c0[local] == 2),
                             (TOKENS, d.count), (WORDS, local)):
                    sums[i] = x.sum()
                out.append((bucket, "b", 0, -1 - bucket, b"", sums))
                customers = np.bincount(d.ctx, d.count, n).astype(np.int64)
                customers[at_name] = d.total[dealt]
            tables = np.bincount(d.ctx, t, n).astype(np.int64)
            tables[at_name] = c0[dealt]
            cuts = np.searchsorted(part_of(d.names, parts), np.arange(parts + 1))
            for p in np.flatnonzero(np.diff(cuts)):
                at = slice(cuts[p], cuts[p + 1])
                out.append((bucket, "g", turn, int(p), packed_arrays(
                    d.names[at], customers[at], tables[at]), np.zeros(8)))
            return pd.DataFrame(out, columns=["bucket", "kind", "turn", "part", "payload", "sums"])
        yield from by_bucket(batches, one)
    return run


def parent_of(d: Dishes, g: dict, c0: np.ndarray, t0: np.ndarray, dealt: np.ndarray,
              dealt_customers: np.ndarray, dealt_tables: np.ndarray) -> np.ndarray:
    """The words' probabilities in the parent; dealt words take their totals
    over all buckets."""
    c0, t0 = c0.astype(np.float64), t0.astype(np.float64)
    c0[dealt], t0[dealt] = dealt_customers, dealt_tables
    return d.parent(g, c0, t0)


def _sum_part(shared):
    """The totals of a range's names, given to every bucket that has them.  Of a
    dealt word these are the parent's customers, which are seated here; their
    tables go back in the place of the customers."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        if pdf["part"].iloc[0] < 0:
            return pdf
        history, _, _, (keys, _) = shared.value
        got = [unpacked(p, np.uint64, np.int64, np.int64) for p in pdf["payload"]]
        names, at = np.unique(np.concatenate([g[0] for g in got]), return_inverse=True)
        total = [np.bincount(at, np.concatenate([g[i] for g in got]), len(names)).astype(np.int64)
                 for i in (1, 2)]
        own = names_of(keys)
        place = np.minimum(np.searchsorted(names, own), len(names) - 1)
        inside = names[place] == own
        place, c0, sums = place[inside], total[1][place[inside]], np.zeros(8)
        if history:
            g = history[-1]
            mass = np.full(len(c0), (STRENGTH + g["d0"] * g["root_tables"]) / (g["v"] + 1))
            t0 = seat(c0, mass, g["d0"], root_key(keys[inside]), len(history) - 1 + 500)
            total[0][place] = t0
            sums[ROOT_CUSTOMERS], sums[ROOT_TABLES] = c0.sum(), t0.sum()
        else:
            sums[ROOT_ONES], sums[ROOT_TWOS] = (c0 == 1).sum(), (c0 == 2).sum()
            sums[WORDS] = (c0 > 0).sum()
        ends = np.cumsum([len(g[0]) for g in got])[:-1]
        back = [packed_arrays(total[0][a], total[1][a]) for a in np.split(at, ends)]
        return pdf.assign(payload=back, sums=[sums, *[np.zeros(8)] * (len(pdf) - 1)])
    return run


def turn_rows(dishes: DataFrame, before: DataFrame | None, history: list[dict], parts: int,
              buckets: int, keep: bool, spread) -> tuple[DataFrame, np.ndarray]:
    """The written rows of a sweep and the sums over all buckets."""
    shared = dishes.sparkSession.sparkContext.broadcast((history, parts, keep, spread))
    rows = dishes.select("bucket", "kind", "turn", "part", "payload")
    if before is not None:
        # Before the second sweep there is no seating, only sums.
        rows = rows.unionByName(before.filter((F.col("kind") == "g") | (F.col("turn") > 0))
                                .select(*rows.columns))
    with files_of_shuffles_go(dishes.sparkSession):
        out = written(sorted_by_bucket(rows, buckets).mapInPandas(_sweep(shared), ROW)
                      .groupBy("part").applyInPandas(_sum_part(shared), ROW), "hpylm-turn")
    sums = out.agg(*[F.sum(F.col("sums")[i]) for i in range(8)]).first()
    return out, np.array([float(x or 0) for x in sums])


def sorted_by_bucket(rows: DataFrame, buckets: int) -> DataFrame:
    return rows.repartition(buckets, "bucket").sortWithinPartitions("bucket", "kind", "turn", "part")


# --- scoring ----------------------------------------------------------------

class Model:
    """What scores the tokens of one bucket: the dishes, the customers less
    discounts of each and, by sample, the contexts' tables and the parent's
    probabilities."""

    def __init__(self, rows: list, history: list[dict], spread: tuple[np.ndarray, np.ndarray]):
        none = np.empty(0, np.int64)
        self.d, dealt, at_name = load_dishes(rows[0].payload, spread) if rows else (
            NO_DISHES, none, none)
        totals = {t: joined_totals([r for r in rows if r.kind == "g" and r.turn == t])
                  for t in {r.turn for r in rows if r.kind == "g"}}
        n = len(self.d.names)
        self.customers = totals[0][0] if 0 in totals else np.zeros(n)
        self.d.total[dealt] = self.customers[at_name]
        self.samples = []
        seated = next((unpacked(r.payload, np.int64)[0] for r in rows if r.kind == "s"),
                      np.zeros(len(self.d.word)))
        for turn in range(BURN_IN + 1, len(history)):
            g = history[turn]
            seating = [r.payload for r in rows if r.kind == "b" and r.turn == turn]
            root = np.empty(0)
            if seating:
                c0, t0 = unpacked(seating[0], np.int64, np.int64)
                first, over_all = totals.get(turn, np.zeros((2, n)))
                root = parent_of(self.d, g, c0, t0, dealt, over_all[at_name], first[at_name])
            self.samples.append((g, totals[turn][1] if turn in totals else np.zeros(n), root))
        self.seated = len(self.samples) * self.d.count - history[0]["d"] * seated
        self.dish_key = self.d.group * max(1, n) + self.d.ctx  # (word, context), sorted


def _score(shared):
    """Rows sorted by bucket, a bucket's dishes, seatings and totals before its
    packed tokens: per batch the sums of log-probabilities by document.  Only
    one bucket's and a few rows of tokens are held at a time.  A batch's row of
    documents goes through as bucket -1."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        history, spread = shared.value
        at_bucket, held, model = None, [], None
        for pdf in batches:
            out = []
            for r in pdf.itertuples(index=False):
                if r.bucket != at_bucket:
                    at_bucket, held, model = r.bucket, [], None
                if r.kind == "d":
                    out.append((-1, r.batch, r.head, r.payload))
                elif r.kind != "t":
                    held.append(r)
                else:
                    if model is None:
                        model, held = Model(held, history, spread), []
                    out.append((r.bucket, r.batch, b"", score_tokens(r.payload, model, history[0])))
            yield pd.DataFrame(out, columns=["bucket", "batch", "head", "part"])
    return run


def score_tokens(payload: bytes, model: Model, g: dict) -> bytes:
    """Packed (documents, sums of score, base score and known tokens)."""
    h, own, runs, ctx, doc = read_rows(payload, np.uint16)
    d = model.d
    i = np.searchsorted(d.words, h)
    known = np.zeros(len(h), bool)
    inside = i < len(d.words)
    known[inside] = d.words[i[inside]] == h[inside]
    i = np.where(known, i, -1)
    w = np.repeat(i, runs)
    places = np.searchsorted(d.names, own)  # every scored context is among the names
    ask = w * max(1, len(d.names)) + places[ctx]
    j = np.searchsorted(model.dish_key, ask)
    has = (w >= 0) & (j < len(model.dish_key))
    has[has] = model.dish_key[j[has]] == ask[has]
    p = np.zeros(len(ctx))
    p[has] = model.seated[j[has]]
    some = known.any()
    for m, tables, root in model.samples:
        new = (STRENGTH + m["d0"] * m["root_tables"]) / (m["v"] + 1)
        base = np.full(len(h), new / (STRENGTH + m["root_customers"]))
        if some:
            base[known] = root[i[known]]
        p += (STRENGTH + m["d"] * tables[places])[ctx] * np.repeat(base, runs)
    lp = np.log10(p / (len(model.samples) * (STRENGTH + model.customers[places]))[ctx])
    counts = np.zeros(len(h))
    if some:
        counts[known] = d.total[i[known]]
    lb = np.repeat(np.log10((counts + 0.5) / (g["n"] + 0.5 * g["v"] + 0.5)), runs)
    docs = np.bincount(doc)
    at = np.flatnonzero(docs)
    return (at.astype(np.uint16).tobytes() + np.bincount(doc, lp)[at].tobytes()
            + np.bincount(doc, lb)[at].tobytes()
            + np.bincount(doc, np.repeat(counts > 0, runs))[at].astype(np.uint32).tobytes())


def _gather(parts: pd.DataFrame) -> pd.DataFrame:
    """Sum a batch's partial scores by document."""
    parts = parts.sort_values("bucket")
    n_tok = np.frombuffer(parts["part"].iloc[0], np.int64)
    n = len(n_tok)
    head = parts["head"].iloc[0]
    score, base, known = np.zeros(n), np.zeros(n), np.zeros(n, np.int64)
    for part in parts["part"].iloc[1:]:
        k = len(part) // 22
        at = np.frombuffer(part, np.uint16, k)
        score[at] += np.frombuffer(part, np.float64, k, 2 * k)
        base[at] += np.frombuffer(part, np.float64, k, 10 * k)
        known[at] += np.frombuffer(part, np.uint32, k, 18 * k)
    return pd.DataFrame({"doc_id": np.frombuffer(head, np.int64, n),
                         "held_out": np.frombuffer(head, np.uint8, n, 8 * n) > 0,
                         "n_tokens": n_tok, "n_known": known, "base_score": base, "score": score})


def discount(ones: float, twos: float) -> float:
    """The usual estimate from how many dishes have one and two customers."""
    return float(np.clip(ones / (ones + 2 * twos), 0.1, 0.95)) if ones + twos else 0.5


def hpy_scores(docs: DataFrame, held_out, doc_id: str = "doc_id", text: str = "text",
               samples: int = SAMPLES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score
    (log10 probability of the whole text, its end included) of every row.

    ``held_out`` is a boolean column of ``docs``; the other rows train.  Null
    or empty text: one token, the end.  Words not seen in training share the
    base probability.  Null ids are kept; repeated rows are rows of their own
    and train as often as they come.  Without training rows every token has the
    base probability.  An empty table gives no rows; other columns are ignored.
    The perplexity of rows is 10 ** (-sum(score) / sum(n_tokens)).
    """
    spark = docs.sparkSession
    small_batches(spark)
    d = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("d_"),
                    held_out.alias("h_"), F.col(text).alias("text"))
    texts = d.select("d_", "h_", F.col("text").alias("t_"))
    train = texts.filter(~F.col("h_"))
    n_texts, size = (int(x or 0) for x in train.agg(
        F.count(F.lit(1)), F.sum(F.octet_length("t_").cast("long"))).first())
    buckets = max(1, -(-(n_texts + size // TOKEN_BYTES) // TOKENS_PER_BUCKET))
    spread = dealt_words(train, n_texts, buckets)
    shared = spark.sparkContext.broadcast((spread, buckets))
    pairs = texts.mapInPandas(_pack_counts(shared), "bucket int, payload binary")
    # One empty row a bucket: a dealt word is known in all of its buckets.
    every = spark.range(buckets).select(F.col("id").cast("int").alias("bucket"),
                                        F.lit(b"").alias("payload"))
    small_batches(spark, 16)  # from here on rows are of about 100 kB
    with files_of_shuffles_go(spark):
        dishes = written(pairs.unionByName(every).groupBy("bucket").applyInPandas(
            _pack_dishes(shared), "bucket int, contexts long, dishes binary"), "hpylm-dishes")
    parts = max(1, -(-int(dishes.agg(F.sum("contexts")).first()[0] or 0) // CONTEXTS))
    dishes = dishes.select("bucket", F.lit("a").alias("kind"), F.lit(0).alias("turn"),
                           F.lit(0).alias("part"), F.col("dishes").alias("payload"))

    rows, start = turn_rows(dishes, None, [], parts, buckets, False, spread)
    n, v = int(start[TOKENS]), int(start[WORDS])
    history = [{"n": n, "v": v, "d": discount(start[ONES], start[TWOS]),
                "d0": discount(start[ROOT_ONES], start[ROOT_TWOS]),
                "root_customers": 0.0, "root_tables": float(v)}]
    kept = [rows.filter("kind = 'g'")]
    for turn in range(1, BURN_IN + samples + 1):
        rows, got = turn_rows(dishes, rows, history, parts, buckets, turn > BURN_IN, spread)
        history.append(history[0] | {"root_customers": got[ROOT_CUSTOMERS],
                                     "root_tables": got[ROOT_TABLES]})
        if turn > BURN_IN:  # the last sweep's sums over the samples are all that is scored with
            kept.append(rows if turn == BURN_IN + samples else rows.filter("kind != 's'"))
    past = spark.sparkContext.broadcast((history, spread))
    everything = texts.mapInPandas(
        _pack_tokens(shared), "bucket int, kind string, batch string, head binary, payload binary"
    ).select("bucket", "kind", F.lit(0).alias("turn"), F.lit(0).alias("part"), "payload", "batch", "head")
    for rows in [dishes, *kept]:
        everything = everything.unionByName(rows.select(
            *dishes.columns, F.lit("").alias("batch"), F.lit(b"").alias("head")))
    scored = sorted_by_bucket(everything, buckets).mapInPandas(
        _score(past), "bucket int, batch string, head binary, part binary")
    small_batches(spark)
    out = scored.groupBy("batch").applyInPandas(
        _gather, "doc_id long, held_out boolean, n_tokens long, n_known long, "
                 "base_score double, score double")
    return out.select(F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias("doc_id"), "held_out",
                      "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"),
                      "base_score", "score")


def op1_hpy_lm(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    remainder = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
                               .cast("binary")), F.lit(5))
    return hpy_scores(docs, remainder == 1)
