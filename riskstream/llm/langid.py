"""Language identification with a linear-chain CRF (operator 8).

Words (runs of letters, in pieces of at most 40) are labelled with a language each, so code-switched
texts are followed word by word: emissions come from affixes, character
n-grams and a lexicon, transitions are learned, marginals come from
forward-backward over the whole text.  A document's language is the one with
the largest mean marginal, which is also its score.

Training takes a bounded sample of labelled rows (``SAMPLE_ROWS`` of each
language, more than ``MAX_LANGS`` of which are an error, by hash of the id; of longer rows a
stretch of ``SAMPLE_CHARS`` characters at a hashed place), spliced into
code-switched sequences.  Prediction covers all rows and
whole texts: sequences are cut into blocks whose transfer matrices are chained,
which gives the exact marginals of the whole sequence.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskstream.llm.common import carried, small_batches, table

SAMPLE_ROWS = 150
SAMPLE_CHARS = 20_000
MAX_LANGS = 256
TRAIN_WORDS = 120_000
SWITCH_EVERY = 24  # mean words between switches in the training sequences
STEPS = 60
LEXICON_MIN = 4
BLOCK = 128
CACHE = 200_000
UNKNOWN = "und"

LETTERS = re.compile(r"[^\W\d_]{1,40}")


def words_of(text: str | None) -> list[str]:
    """Runs of letters; longer ones, as in scripts without spaces, in consecutive
    pieces of 40, which are labelled one by one."""
    return LETTERS.findall(text.lower()) if text else []


def features(word: str) -> set[str]:
    """Affixes of one to three letters, character 1- to 3-grams, the word itself."""
    w, n = word, len(word)
    return {"=" + w, *["<" + w[:k] for k in (1, 2, 3) if n > k],
            *[">" + w[-k:] for k in (1, 2, 3) if n > k], *w,
            *[w[i:i + 2] for i in range(n - 1)], *[w[i:i + 3] for i in range(n - 2)]}


@dataclass
class Crf:
    langs: list[str]
    index: dict[str, int]   # feature -> row of weights
    weights: np.ndarray     # (features, langs)
    trans: np.ndarray       # (langs, langs) log potentials

    def emissions(self, words: list[str]) -> np.ndarray:
        """(words, langs) sums of the weights of each word's known features."""
        get, rows, ends = self.index.get, [], []
        for w in words:
            rows += [i for f in features(w) if (i := get(f)) is not None]
            ends.append(len(rows))
        if not rows:
            return np.zeros((len(words), len(self.langs)))
        sums = np.zeros((len(rows) + 1, len(self.langs)))
        np.cumsum(self.weights[rows], axis=0, out=sums[1:])
        at = np.array([0, *ends])
        return sums[at[1:]] - sums[at[:-1]]


def marginals(emit: np.ndarray, trans: np.ndarray, lengths: np.ndarray,
              block: int = BLOCK) -> np.ndarray:
    """P(label of each word | its whole sequence); sequences lie one after the
    other in ``emit`` (words, labels), with the given positive lengths."""
    n, k = emit.shape
    a = np.exp(trans - trans.max())
    e = np.exp(emit - emit.max(axis=1, keepdims=True))
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    n_blocks = -(-lengths // block)
    first = np.concatenate(([0], np.cumsum(n_blocks)[:-1]))
    seq = np.repeat(np.arange(len(lengths)), n_blocks)
    nth = np.arange(len(seq)) - first[seq]
    at = starts[seq] + nth * block
    size = np.minimum(block, starts[seq] + lengths[seq] - at)
    width = int(size.max())
    where = at[:, None] + np.arange(width)[None, :]
    live = np.arange(width)[None, :] < size[:, None]
    eb = np.where(live[:, :, None], e[np.minimum(where, n - 1)], 1.0)  # (blocks, width, k)
    head = nth == 0

    def step_matrix(t: int) -> np.ndarray:
        """Potentials from the label before word t of each block to its label."""
        m = a[None] * eb[:, t, None, :]
        if t == 0:  # the first word of a sequence has no label before it
            m[head] = np.eye(k)[None] * eb[head, 0, None, :]
        m[~live[:, t]] = np.eye(k)
        return m

    long = n_blocks.max() > 1
    alpha_in = np.full((len(seq), k), 1.0 / k)
    beta_out = np.full((len(seq), k), 1.0 / k)
    if long:
        many = np.flatnonzero(n_blocks[seq] > 1)
        total = np.tile(np.eye(k), (len(many), 1, 1))
        for t in range(width):
            total = total @ step_matrix(t)[many]
            total /= total.sum(axis=(1, 2), keepdims=True)
        place = np.full(len(seq), -1)
        place[many] = np.arange(len(many))
        for j in range(1, int(n_blocks.max())):
            b = first[n_blocks > j] + j
            v = np.einsum("ni,nij->nj", alpha_in[b - 1], total[place[b - 1]])
            alpha_in[b] = v / v.sum(axis=1, keepdims=True)
        for j in range(int(n_blocks.max()) - 1, 0, -1):
            b = first[n_blocks > j] + j
            v = np.einsum("nij,nj->ni", total[place[b]], beta_out[b])
            beta_out[b - 1] = v / v.sum(axis=1, keepdims=True)
    fwd = np.empty((len(seq), width, k))
    v = alpha_in
    for t in range(width):
        moved = v @ a
        if t == 0:
            moved = np.where(head[:, None], v, moved)
        new = moved * eb[:, t]
        new /= new.sum(axis=1, keepdims=True)
        v = np.where(live[:, t, None], new, v)
        fwd[:, t] = v
    out = np.empty((n, k))
    v = beta_out
    for t in range(width - 1, -1, -1):
        m = fwd[:, t] * v
        m /= m.sum(axis=1, keepdims=True)
        out[where[live[:, t], t]] = m[live[:, t]]
        back = (v * eb[:, t]) @ a.T
        back /= back.sum(axis=1, keepdims=True)
        v = np.where(live[:, t, None], back, v)
    return out


def spliced(texts: list[tuple[str, list[str]]], n_words: int, rng: np.random.Generator
            ) -> tuple[list[str], list[int], list[str]]:
    """Training words and labels: runs of random lengths from texts of random languages."""
    langs = sorted({lang for lang, _ in texts})
    pool = {x: [w for lang, w in texts if lang == x and w] for x in langs}
    langs = [x for x in langs if pool[x]]
    words: list[str] = []
    labels: list[int] = []
    while langs and len(words) < n_words:
        x = int(rng.integers(len(langs)))
        t = pool[langs[x]][int(rng.integers(len(pool[langs[x]])))]
        size = min(len(t), 1 + int(rng.geometric(1 / SWITCH_EVERY)))
        at = int(rng.integers(len(t) - size + 1))
        words += t[at:at + size]
        labels += [x] * size
    return words, labels, langs


def train(texts: list[tuple[str, list[str]]], n_words: int = TRAIN_WORDS, steps: int = STEPS,
          length: int = 64, seed: int = 7) -> Crf:
    """Fit emission and transition weights by the CRF's likelihood (Adam, L2)."""
    rng = np.random.default_rng(seed)
    words, labels, langs = spliced(texts, n_words, rng)
    k = len(langs)
    if not words:
        return Crf(langs, {}, np.zeros((0, k)), np.zeros((k, k)))
    n_seq = max(1, len(words) // length)
    length = min(length, len(words))
    words, labels = words[:n_seq * length], labels[:n_seq * length]
    y = np.array(labels).reshape(n_seq, length)
    vocab = {w: i for i, w in enumerate(dict.fromkeys(words))}
    counts = Counter(words)
    common = Counter(f for w in vocab for f in features(w))
    index: dict[str, int] = {}
    row, col = [], []
    for w, i in vocab.items():
        for f in sorted(features(w)):
            if counts[w] >= LEXICON_MIN if f[0] == "=" else common[f] >= 2:
                row.append(i)
                col.append(index.setdefault(f, len(index)))
    row_a, col_a = np.array(row), np.array(col)
    ids = np.array([vocab[w] for w in words]).reshape(n_seq, length)
    flat_y = y.ravel()
    w = np.zeros((len(index), k))
    tr = np.zeros((k, k))
    seen_tr = np.zeros((k, k))
    np.add.at(seen_tr, (y[:, :-1].ravel(), y[:, 1:].ravel()), 1.0)
    state = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(tr), np.zeros_like(tr)]
    lengths = np.full(n_seq, length)
    for step in range(1, steps + 1):
        em = np.stack([np.bincount(row_a, w[col_a, j], len(vocab)) for j in range(k)], axis=1)
        e = em[ids.ravel()]
        p = marginals(e, tr, lengths, block=length)
        # Expected transitions from the neighbours' forward and backward parts.
        a = np.exp(tr - tr.max())
        ee = np.exp(e - e.max(axis=1, keepdims=True)).reshape(n_seq, length, k)
        f = np.empty((n_seq, length, k))
        v = np.full((n_seq, k), 1.0 / k)
        for t in range(length):
            v = (v if t == 0 else v @ a) * ee[:, t]
            v /= v.sum(axis=1, keepdims=True)
            f[:, t] = v
        b = np.ones((n_seq, k))
        exp_tr = np.zeros((k, k))
        for t in range(length - 1, 0, -1):
            right = b * ee[:, t]
            joint = f[:, t - 1][:, :, None] * a[None] * right[:, None, :]
            exp_tr += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            b = right @ a.T
            b /= b.sum(axis=1, keepdims=True)
        diff = -p
        diff[np.arange(len(flat_y)), flat_y] += 1.0
        per_word = np.stack([np.bincount(ids.ravel(), diff[:, j], len(vocab)) for j in range(k)], 1)
        gw = np.stack([np.bincount(col_a, per_word[row_a, j], len(index)) for j in range(k)], 1)
        gw = gw / len(flat_y) - 1e-6 * w
        gt = (seen_tr - exp_tr) / len(flat_y) - 1e-6 * tr
        for x, g, m, s in ((w, gw, state[0], state[1]), (tr, gt, state[2], state[3])):
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            x += 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.99 ** step)) + 1e-8)
    return Crf(langs, index, w, tr)


def training_sample(docs: DataFrame, rows: int = SAMPLE_ROWS) -> list[tuple[str, list[str]]]:
    """(lang, words) of at most ``rows`` labelled rows of each language.

    A hash of the id thins each language to about three times ``rows`` before
    anything is ranked, so a language with a third of all rows is no hot group.
    """
    d = docs.filter("lang is not null and text is not null")
    per = d.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    counts = {r.lang: r.n for r in per.limit(MAX_LANGS + 1).collect()}
    if len(counts) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages; raise MAX_LANGS")
    if not counts:
        return []
    share = F.lit(0.0)
    for lang, n in counts.items():
        share = F.when(F.col("lang") == lang, min(1.0, 3 * rows / n)).otherwise(share)
    h = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("langid")), F.lit(1 << 20))
    thin = d.withColumn("h", h).filter(F.col("h") < share * (1 << 20))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id", F.md5("text")))
    spare = F.greatest(F.length("text") - SAMPLE_CHARS, F.lit(0)) + 1
    stretch = F.substr("text", F.pmod(F.xxhash64("text"), spare.cast("long")).cast("int") + 1,
                       F.lit(SAMPLE_CHARS))
    picked = (thin.withColumn("r", rank).filter(F.col("r") <= rows).orderBy("lang", "r")
              .select("lang", stretch.alias("text")).collect())
    return [(r.lang, words_of(r.text)) for r in picked]


def _predictor(model):
    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        crf: Crf = model.value
        k = len(crf.langs)
        ids: dict[str, int] = {}
        table_ = np.zeros((1024, max(k, 1)))
        for pdf in batches:
            docs = [words_of(t) for t in pdf["t_"]]
            lang = np.full(len(docs), UNKNOWN, object)
            score = np.zeros(len(docs))
            some = [i for i, d in enumerate(docs) if d] if k else []
            if some:
                if len(ids) > CACHE:
                    ids = {}
                words = [w for i in some for w in docs[i]]
                fresh = [w for w in dict.fromkeys(words) if w not in ids]
                if fresh:
                    need = len(ids) + len(fresh)
                    if need > len(table_):
                        table_ = np.concatenate([table_, np.zeros((need, k))])
                    table_[len(ids):need] = crf.emissions(fresh)
                    ids.update(zip(fresh, range(len(ids), need), strict=True))
                lengths = np.array([len(docs[i]) for i in some])
                where = np.fromiter((ids[w] for w in words), np.int64, len(words))
                p = marginals(table_[where], crf.trans, lengths)
                ends = np.concatenate(([0], np.cumsum(lengths)[:-1]))
                mean = np.add.reduceat(p, ends, axis=0) / lengths[:, None]
                best = mean.argmax(axis=1)
                lang[some] = np.array(crf.langs, object)[best]
                score[some] = np.clip(mean[np.arange(len(some)), best], 0.0, 1.0)
            yield pdf.drop(columns="t_").assign(lang_pred_=lang, score_=score)
    return predict


def predict_language(docs: DataFrame, model: Crf, keep: list[str], text: str = "text") -> DataFrame:
    """The ``keep`` columns with lang_pred and score, one row per row of ``docs``.

    Null text or text without a letter: ``und`` with score 0, as is every text
    if nothing was learned.  Columns outside ``keep`` are ignored.
    """
    spark = docs.sparkSession
    small_batches(spark, 256)
    there, back = carried(docs, keep)
    d = docs.select(*there, F.col(text).alias("t_"))
    schema = ", ".join(f"k{i} {d.schema[f'k{i}'].dataType.simpleString()}"
                       for i in range(len(keep)))
    out = d.mapInPandas(_predictor(spark.sparkContext.broadcast(model)),
                        schema + ", lang_pred_ string, score_ double")
    return out.select(*back, F.col("lang_pred_").alias("lang_pred"), F.col("score_").alias("score"))


def fold(modulus: int = 5):
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
                          .cast("binary")), F.lit(modulus))


def fit(docs: DataFrame) -> Crf:
    """A model from the labelled rows outside the held-out fold."""
    return train(training_sample(docs.select("doc_id", "text", "lang").filter(fold() != 0)))


def op8_crf_langid(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = docs.select("doc_id", "text", (fold() == 0).alias("held_out"))
    return predict_language(held, fit(docs), ["doc_id", "held_out"])
