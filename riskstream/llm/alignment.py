"""Alignment of two tokenizers' tokens by a monoid of fragments (operator 12).

A text, with a space in front, is encoded by a byte-level BPE (A) and by a
piece model (B).  Byte offsets where tokens of both end cut the text into
groups.  A *fragment* is what is known of a byte range: the open prefix (tokens
up to the first common end), the closed groups, and the open suffix (tokens
after the last common end).  Fragments of adjoining ranges compose: the left
one's suffix and the right one's prefix make a group.  Composition is
associative, so the fragments of a very long document, made by different tasks,
are reduced as a tree.

Long texts are encoded in chunks.  A chunk begins at a single space between two
characters that are no white space.  Neither tokenizer has a token across such a
place: A's pattern ends a token before it, and B joins nothing over it as none of
its pieces holds the space sign after another character (checked when the
model is read; otherwise texts stay in one chunk).  Composition doesn't rely on
that: it holds for any ranges.

Links are the pairs of an A and a B token whose byte ranges overlap.  They are
counted by batch before the shuffle; totals come back to each batch through a
join on the pair, never as a broadcast.
"""

from __future__ import annotations

import hashlib
import json
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskstream.llm.common import small_batches, table, written

#: Characters of a chunk of a long text, and bytes of text that a batch holds.
CHUNK = 1 << 15
BATCH_BYTES = 1 << 20
#: Fragments that one step of the tree composes.
FAN = 16
#: Tokenizer files are shipped to the tasks; larger ones are refused.
FILE_BYTES = 64 << 20
#: Fixed value: the pattern that byte-level BPE splits text by.
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+"
           r"|\s+(?!\S)|\s+")
SPACE_SIGN = "▁"
EMPTY = np.zeros(0, np.int64)

ROWS = ("kind string, batch long, uid long, id string, part long, ids array<string>, "
        "stats binary, groups array<string>, codes array<long>, counts array<long>, "
        "uses binary, fragment binary")
SCORED = ("uid long, id string, n_a long, n_b long, n_groups long, n_links long, "
          "n_best long, count_sum long, groups string")


# --- tokenizers ----------------------------------------------------------------

def byte_of_char() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and the
    others as characters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Digits(NamedTuple):
    """Every id's digits with what follows it: , or | for A, then , or ; for B."""
    said: list[str]
    a_n: int
    b_n: int

    @staticmethod
    def of(a_n: int, b_n: int) -> Digits:
        return Digits([f"{i}{after}" for n, afters in ((a_n, ",|"), (b_n, ",;"))
                       for after in afters for i in range(n)], a_n, b_n)

    def text(self, places: np.ndarray) -> str:
        return "".join(map(self.said.__getitem__, places.tolist()))[:-1]


class Tokenizers:
    """Both tokenizers in a task: ids of a text, and the bytes of an id."""

    def __init__(self, a_file: bytes, b_file: bytes):
        import sentencepiece

        said = json.loads(a_file)
        vocab, back = said["model"]["vocab"], byte_of_char()
        added = {t["content"]: t["id"] for t in said.get("added_tokens", ())}
        decoded = {bytes(back[c] for c in t): i for t, i in vocab.items() if t not in added}
        self.a_bytes = [b""] * (1 + max([*vocab.values(), *added.values()]))
        for t, i in decoded.items():
            self.a_bytes[i] = t
        self.a = self._encoder(a_file, said, decoded)
        sp = sentencepiece.SentencePieceProcessor(model_proto=b_file)
        self.b = lambda text: sp.encode(text, num_threads=1)
        self.b_bytes = [self._piece(sp, i) for i in range(sp.vocab_size())]
        pieces = (sp.id_to_piece(i) for i in range(sp.vocab_size()))
        self.cuttable = not any(SPACE_SIGN in p.lstrip(SPACE_SIGN) for p in pieces)
        self.a_len = np.array([len(t) for t in self.a_bytes], np.int64)
        self.b_len = np.array([len(t) for t in self.b_bytes], np.int64)
        self.digits = Digits.of(len(self.a_bytes), len(self.b_bytes))

    @staticmethod
    def _encoder(a_file: bytes, said: dict, decoded: dict[bytes, int]):
        """Where ids stand in merge order, the vocabulary as ranks gives the same
        tokens several times faster."""
        parts = (m.split(" ") if isinstance(m, str) else m for m in said["model"]["merges"])
        vocab = said["model"]["vocab"]
        plain = said.get("normalizer") is None and said["pre_tokenizer"] == {
            "type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True,
            "use_regex": True}
        if plain and all(vocab["".join(m)] == 256 + i for i, m in enumerate(parts)):
            import tiktoken

            return tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=decoded,
                                     special_tokens={}).encode_ordinary
        from tokenizers import Tokenizer

        slow = Tokenizer.from_str(a_file.decode())
        slow.encode_special_tokens = True
        return lambda text: slow.encode(text, add_special_tokens=False).ids

    @staticmethod
    def _piece(sp, i: int) -> bytes:
        piece = sp.id_to_piece(i)
        if sp.is_byte(i):
            return bytes([int(piece[3:-1], 16)])
        return piece.replace(SPACE_SIGN, " ").encode()

    def tokens(self, piece: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids by A and B of a piece that starts with a space; None if the bytes
        of either differ from the piece's."""
        want = piece.encode()
        out = []
        for ids, known in ((self.a(piece), self.a_bytes), (self.b(piece[1:]), self.b_bytes)):
            if b"".join([known[i] for i in ids]) != want:
                return None
            out.append(np.array(ids, np.int64))
        return out[0], out[1]


# --- fragments -----------------------------------------------------------------

class Tokens(NamedTuple):
    """Tokens of both sides: ids, and the byte offsets at which they end."""
    a: np.ndarray = EMPTY
    a_end: np.ndarray = EMPTY
    b: np.ndarray = EMPTY
    b_end: np.ndarray = EMPTY

    def __add__(self, other: Tokens) -> Tokens:
        return Tokens(*(np.concatenate(x) for x in zip(self, other, strict=True)))

    def upto(self, end: int) -> tuple[Tokens, Tokens]:
        i, j = np.searchsorted(self.a_end, end, "right"), np.searchsorted(self.b_end, end, "right")
        return (Tokens(self.a[:i], self.a_end[:i], self.b[:j], self.b_end[:j]),
                Tokens(self.a[i:], self.a_end[i:], self.b[j:], self.b_end[j:]))


def marked(t: Tokens) -> tuple[int, np.ndarray, np.ndarray]:
    """First offset, and for every byte from there whether a token of A, of B
    ends there.  Runs over bytes beat searches over ends."""
    low = int(min(x[0] for x in (t.a_end, t.b_end) if len(x))) - 1
    high = int(max(x[-1] for x in (t.a_end, t.b_end) if len(x)))
    a, b = np.zeros(high - low + 1, bool), np.zeros(high - low + 1, bool)
    a[t.a_end - low] = True
    b[t.b_end - low] = True
    return low, a, b


def common_ends(t: Tokens) -> np.ndarray:
    if not len(t.a_end) or not len(t.b_end):
        return EMPTY
    low, a, b = marked(t)
    return low + np.flatnonzero(a & b)


def all_ends(t: Tokens) -> np.ndarray:
    if not len(t.a_end) and not len(t.b_end):
        return EMPTY
    low, a, b = marked(t)
    return low + np.flatnonzero(a | b)


def link_codes(t: Tokens) -> np.ndarray:
    """One code (A id, B id) for each overlapping pair of tokens of whole groups.

    Between two neighbouring ends of either side lies one overlap, and every
    overlap is such a stretch.
    """
    _, a, b = marked(t)
    before = np.flatnonzero(a | b) - 1
    return (t.a[np.cumsum(a)[before]] << 32) | t.b[np.cumsum(b)[before]]


def written_groups(t: Tokens, digits: Digits) -> np.ndarray:
    """Places in ``digits`` of all tokens of whole groups, group by group, A
    before B."""
    low, a, b = marked(t)
    common = a & b
    at = np.flatnonzero(common)
    group = np.cumsum(common)
    ga, gb = group[t.a_end - low - 1], group[t.b_end - low - 1]
    a_upto, b_upto = np.cumsum(a)[at], np.cumsum(b)[at]
    out = np.empty(len(t.a) + len(t.b), np.int64)
    out[np.arange(len(t.a)) + np.concatenate([[0], b_upto])[ga]] = (
        t.a + digits.a_n * common[t.a_end - low])
    out[np.arange(len(t.b)) + a_upto[gb]] = (
        2 * digits.a_n + t.b + digits.b_n * common[t.b_end - low])
    return out


class Fragment(NamedTuple):
    """What is known of a byte range of a document.

    ``closed``: its whole groups, written ``a1,a2|b1;a3|b2``; ``seams``: link
    codes of groups that composition closed (those inside a range are counted
    where they are found).  Without a common end (``bounded`` false) all tokens
    are in ``prefix``.  ``valid`` is false if either tokenizer changes the text.
    """
    valid: bool = True
    bounded: bool = False
    n_a: int = 0
    n_b: int = 0
    n_groups: int = 0
    n_links: int = 0
    prefix: Tokens = Tokens()
    suffix: Tokens = Tokens()
    closed: str = ""
    seams: np.ndarray = EMPTY


def group_text(t: Tokens) -> str:
    return ",".join(map(str, t.a.tolist())) + "|" + ",".join(map(str, t.b.tolist()))


def fragment(t: Tokens, digits: Digits) -> tuple[Fragment, np.ndarray]:
    """The fragment of the tokens that end in a range, and its closed links."""
    common = common_ends(t)
    if not len(common):
        return Fragment(n_a=len(t.a), n_b=len(t.b), prefix=t), EMPTY
    prefix, rest = t.upto(common[0])
    inside, suffix = rest.upto(common[-1])
    codes, text = EMPTY, ""
    if len(common) > 1:
        codes = link_codes(inside)
        text = digits.text(written_groups(inside, digits))
    return Fragment(True, True, len(t.a), len(t.b), len(common) - 1, len(codes), prefix,
                    suffix, text), codes


def compose(x: Fragment, y: Fragment) -> Fragment:
    """The fragment of two adjoining ranges; ``Fragment()`` is neutral."""
    if not (x.valid and y.valid):
        return Fragment(valid=False)
    n_a, n_b = x.n_a + y.n_a, x.n_b + y.n_b
    if not x.bounded:
        return y._replace(n_a=n_a, n_b=n_b, prefix=x.prefix + y.prefix,
                          seams=np.concatenate([x.seams, y.seams]))
    if not y.bounded:
        return x._replace(n_a=n_a, n_b=n_b, suffix=x.suffix + y.prefix)
    seam = x.suffix + y.prefix
    codes = link_codes(seam)
    return Fragment(
        True, True, n_a, n_b, x.n_groups + 1 + y.n_groups, x.n_links + len(codes) + y.n_links,
        x.prefix, y.suffix, ";".join(s for s in (x.closed, group_text(seam), y.closed) if s),
        np.concatenate([x.seams, codes, y.seams]))


def whole(x: Fragment) -> Fragment:
    """A document's fragment, its first group closed too."""
    if not x.valid or not x.bounded:
        return x
    return compose(Fragment(bounded=True), x)


def packed(x: Fragment) -> bytes:
    """A fragment as bytes: numbers, lengths, arrays, text."""
    arrays = [*x.prefix, *x.suffix, x.seams]
    head = np.array([x.valid, x.bounded, *x[2:6], *map(len, arrays)], np.int64)
    return zlib.compress(b"".join([head.tobytes(), *(a.astype(np.int64).tobytes() for a in arrays),
                                   x.closed.encode()]), 1)


def unpacked(said: bytes) -> Fragment:
    said = zlib.decompress(said)
    head = np.frombuffer(said, np.int64, 15).tolist()
    arrays, at = [], 15 * 8
    for n in head[6:]:
        arrays.append(np.frombuffer(said, np.int64, n, at))
        at += 8 * n
    return Fragment(bool(head[0]), bool(head[1]), *head[2:6], Tokens(*arrays[:4]),
                    Tokens(*arrays[4:8]), said[at:].decode(), arrays[8])


# --- in tasks ------------------------------------------------------------------

def chunks(text: str, size: int, cuttable: bool) -> list[str]:
    """Pieces that each start with a space; joined they are space + text."""
    piece = " " + text
    if not cuttable or len(piece) <= size:
        return [piece]
    cut = re.compile(r"(?<=\S) (?=\S)")
    places, at = [0], size
    while (m := cut.search(piece, at)) is not None:
        if m.end() < len(piece) and SPACE_SIGN not in piece[m.start() - 1:m.end() + 1]:
            places.append(m.start())
            at = m.start() + size
        else:
            at = m.end()
    return [piece[i:j] for i, j in zip(places, [*places[1:], len(piece)], strict=True)]


def uses_of(codes: np.ndarray, owner: np.ndarray, owners: int):
    """Distinct codes and their counts; packed (owner, code) uses.  Owners come
    in order, and so do the pairs, which are numbered as they first appear."""
    place, distinct = pd.factorize(codes)
    n = max(1, len(distinct))
    pair, pairs = pd.factorize(owner * n + place)
    ptr = np.searchsorted(pairs // n, np.arange(owners + 1))
    times = np.bincount(pair, minlength=len(pairs))
    body = np.concatenate([ptr, pairs % n, times]).astype(np.int32)
    return distinct, np.bincount(place, minlength=len(distinct)), zlib.compress(body.tobytes(), 1)


def used(said: bytes, owners: int, totals: np.ndarray, best: np.ndarray):
    """n_best and count_sum of each owner from packed uses."""
    body = np.frombuffer(zlib.decompress(said), np.int32).astype(np.int64)
    ptr, rest = body[:owners + 1], body[owners + 1:]
    code, times = rest[:len(rest) // 2], rest[len(rest) // 2:]
    out = []
    for x in (best[code] * times, totals[code] * times):
        run = np.concatenate([[0], np.cumsum(x)])
        out.append(run[ptr[1:]] - run[ptr[:-1]])
    return out


class Batch:
    """Whole short documents of a batch, encoded one by one, aligned as one
    stream: every document's end is a common end."""

    def __init__(self, known: Tokenizers, keep: bool):
        self.known, self.keep, self.size = known, keep, 0
        self.ids, self.parts = [], []

    def add(self, doc_id, text: str | None) -> None:
        pair = self.known.tokens(" " + text) if text else None
        self.ids.append(doc_id)
        self.parts.append(pair or (EMPTY, EMPTY))
        self.size += 64 + len(text or "")

    def row(self, number: int) -> dict:
        k, n = self.known, len(self.ids)
        a, b = (np.concatenate([p[i] for p in self.parts]) for i in (0, 1))
        t = Tokens(a, np.cumsum(k.a_len[a]), b, np.cumsum(k.b_len[b]))
        n_a, n_b = (np.array([len(p[i]) for p in self.parts], np.int64) for i in (0, 1))
        end = np.concatenate([[0], np.cumsum([k.a_len[p[0]].sum() for p in self.parts])])
        common, order, codes = common_ends(t), EMPTY, EMPTY
        if len(a):
            order, codes = written_groups(t, k.digits), link_codes(t)
        ends = all_ends(t)
        n_groups = np.diff(np.searchsorted(common, end, "right"))
        n_links = np.diff(np.searchsorted(ends, end, "right"))
        groups, at = [], 0
        for m in (n_a + n_b).tolist():
            said = k.digits.text(order[at:at + m])
            groups.append(said if self.keep or not said
                          else hashlib.sha256(said.encode()).hexdigest())
            at += m
        owner = np.repeat(np.arange(n), n_links)
        distinct, counts, uses = uses_of(codes, owner, n)
        stats = np.concatenate([n_a, n_b, n_groups, n_links]).astype(np.int64)
        return {"kind": "docs", "batch": number, "ids": self.ids, "stats": stats.tobytes(),
                "groups": groups, "codes": distinct, "counts": counts, "uses": uses}


def part_row(known: Tokenizers, number: int, uid: int, doc_id, part: int, start: int,
             piece: str) -> dict:
    """A chunk of a long document; ``start`` is its first byte."""
    pair = known.tokens(piece)
    if pair is None:
        found, codes = Fragment(valid=False), EMPTY
    else:
        a, b = pair
        found, codes = fragment(Tokens(a, start + np.cumsum(known.a_len[a]), b,
                                       start + np.cumsum(known.b_len[b])), known.digits)
    distinct, counts, uses = uses_of(codes, np.zeros(len(codes), np.int64), 1)
    return {"kind": "part", "batch": number, "uid": uid, "id": doc_id, "part": part,
            "codes": distinct, "counts": counts, "uses": uses, "fragment": packed(found)}


ARROW = pa.schema([
    ("kind", pa.string()), ("batch", pa.int64()), ("uid", pa.int64()), ("id", pa.string()),
    ("part", pa.int64()), ("ids", pa.list_(pa.string())), ("stats", pa.binary()),
    ("groups", pa.list_(pa.string())), ("codes", pa.list_(pa.int64())),
    ("counts", pa.list_(pa.int64())), ("uses", pa.binary()), ("fragment", pa.binary())])


def one_row(row: dict, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([row.get(f.name)], f.type) for f in schema], schema=schema)


def encode(a_file: bytes, b_file: bytes, keep: bool, batch_bytes: int):
    """mapInArrow function: (uid, id, part, start, text) to rows of ``ROWS``;
    ``part`` is null for a whole document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Tokenizers(a_file, b_file)
        number = TaskContext.get().partitionId() << 32
        now = Batch(known, keep)
        for rows in batches:
            for r in rows.to_pylist():
                if r["part"] is not None:
                    number += 1
                    yield one_row(part_row(known, number, r["uid"], r["id"], r["part"],
                                           r["start"], r["text"]), ARROW)
                    continue
                now.add(r["id"], r["text"])
                if now.size >= batch_bytes:
                    number += 1
                    yield one_row(now.row(number), ARROW)
                    now = Batch(known, keep)
        if now.ids:
            yield one_row(now.row(number + 1), ARROW)

    return run


def cut(size: int, cuttable: bool):
    """mapInPandas function: long texts as (uid, id, part, start, text)."""

    def run(frames):
        for f in frames:
            for uid, doc_id, text in zip(f["uid"], f["id"], f["text"], strict=True):
                pieces = chunks(text, size, cuttable)
                start = np.cumsum([0] + [len(p.encode()) for p in pieces])[:-1]
                for lo in range(0, len(pieces), 64):
                    yield type(f)({"uid": uid, "id": doc_id, "start": start[lo:lo + 64],
                                   "text": pieces[lo:lo + 64]}).assign(
                        part=lambda p, lo=lo: range(lo, lo + len(p)))

    return run


def composed(frame):
    """applyInPandas function: neighbouring fragments of a document as one."""
    frame = frame.sort_values("part")
    total = Fragment()
    for said in frame["fragment"]:
        total = compose(total, unpacked(said))
    out = frame.iloc[:1].copy()
    out["part"] = out["part"] // FAN
    out["fragment"] = [packed(total)]
    return out


def finished(keep: bool):
    """mapInPandas function: a long document's fragment to its figures, and its
    seams as a row of ``ROWS``."""

    def run(frames):
        for f in frames:
            rows = []
            for uid, doc_id, said in zip(f["uid"], f["id"], f["fragment"], strict=True):
                x = whole(unpacked(said))
                if not x.valid:
                    x = Fragment(valid=False)
                distinct, counts, uses = uses_of(x.seams, np.zeros(len(x.seams), np.int64), 1)
                text = x.closed if keep or not x.closed else hashlib.sha256(
                    x.closed.encode()).hexdigest()
                rows.append((uid, doc_id, x.valid, x.n_a, x.n_b, x.n_groups, x.n_links, text,
                             distinct, counts, uses))
            yield type(f)(rows, columns=["uid", "id", "valid", "n_a", "n_b", "n_groups", "n_links",
                                         "groups", "codes", "counts", "uses"])

    return run


SCORED_ARROW = pa.schema([
    ("uid", pa.int64()), ("id", pa.string()), ("n_a", pa.int64()), ("n_b", pa.int64()),
    ("n_groups", pa.int64()), ("n_links", pa.int64()), ("n_best", pa.int64()),
    ("count_sum", pa.int64()), ("groups", pa.string())])


def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow function: batches with their codes' totals to documents."""
    for rows in batches:
        for r in rows.to_pylist():
            n = len(r["ids"]) if r["kind"] == "docs" else 1
            totals, best = (np.array(r[c] if r[c] is not None else [], np.int64)
                            for c in ("totals", "best"))
            n_best, count_sum = used(r["uses"], n, totals, best)
            if r["kind"] == "docs":
                stats = np.frombuffer(r["stats"], np.int64).reshape(4, n)
                cols = [[None] * n, r["ids"], *stats, n_best, count_sum, r["groups"]]
            else:
                cols = [[r["uid"]], [None], [0], [0], [0], [0], n_best, count_sum, [None]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(cols, SCORED_ARROW, strict=True)],
                schema=SCORED_ARROW)


# --- the operator --------------------------------------------------------------

def read_file(path: str) -> bytes:
    with open(path, "rb") as f:
        said = f.read(FILE_BYTES + 1)
    if len(said) > FILE_BYTES:
        raise ValueError(f"{path}: a tokenizer file of over {FILE_BYTES} bytes")
    return said


def default_files() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def align(docs: DataFrame, a_path: str, b_path: str, *, doc_id: str = "doc_id",
          text: str = "text", groups: bool = True, chunk: int = CHUNK,
          batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """A row per row of ``docs``: its id, n_a, n_b, n_groups, n_links, n_best,
    count_sum and ``groups`` (``a1,a2|b1;a3|b2``; their SHA-256 with
    ``groups=False``).

    Null, empty and changed texts have zeros and empty groups, and count no
    links.  Null ids and repeated rows stay rows of their own.  An empty table
    gives no rows.  Other columns are ignored, whatever their names.  Texts are
    encoded whole; long ones by chunks, on several tasks.
    """
    spark = docs.sparkSession
    a_file, b_file = read_file(a_path), read_file(b_path)
    cuttable = Tokenizers(a_file, b_file).cuttable
    small_batches(spark)
    rows = docs.select(F.col(doc_id).cast("string").alias("id"), F.col(text).alias("text"))
    is_long = F.coalesce(F.length("text") >= chunk, F.lit(False))
    given = "uid long, id string, part long, start long, text string"
    null = F.lit(None).cast("long")
    short = rows.filter(~is_long).select(null.alias("uid"), "id", null.alias("part"),
                                         null.alias("start"), "text")
    parts = (rows.filter(is_long).withColumn("uid", F.monotonically_increasing_id())
             .select("uid", "id", "text").mapInPandas(cut(chunk, cuttable), given)
             .repartition(F.col("uid"), F.col("part")))
    made = encode(a_file, b_file, groups, batch_bytes)
    found = written(short.unionByName(parts).mapInArrow(made, ROWS), "align-rows")

    level = found.filter("kind = 'part'").select("uid", "id", "part", "fragment")
    last = level.agg(F.max("part")).first()[0] or 0
    while True:
        level = level.groupBy("uid", F.floor(F.col("part") / FAN)).applyInPandas(
            composed, "uid long, id string, part long, fragment binary")
        last //= FAN
        if not last:
            break
    longs = written(level.mapInPandas(finished(groups), (
        "uid long, id string, valid boolean, n_a long, n_b long, n_groups long, n_links long, "
        "groups string, codes array<long>, counts array<long>, uses binary")), "align-long")

    # Batches with links: short documents, parts and seams of valid long ones.
    cols = ["kind", "batch", "uid", "ids", "stats", "groups", "codes", "counts", "uses"]
    valid = longs.filter("valid").select("uid")
    seams = longs.filter("valid").select(
        F.lit("seam").alias("kind"), (-F.col("uid") - 1).alias("batch"), "uid",
        F.lit(None).cast("array<string>").alias("ids"), F.lit(None).cast("binary").alias("stats"),
        F.lit(None).cast("array<string>").alias("groups"), "codes", "counts", "uses")
    batches = (found.filter("kind = 'docs'").select(*cols)
               .unionByName(found.filter("kind = 'part'").join(valid, "uid", "left_semi")
                            .select(*cols))
               .unionByName(seams))
    entries = batches.select("batch", F.posexplode(F.arrays_zip("codes", "counts"))).select(
        "batch", "pos", F.col("col.codes").alias("code"), F.col("col.counts").alias("n"))
    totals = entries.groupBy("code").agg(F.sum("n").alias("total"))
    low = F.col("code").bitwiseAND(F.lit(0xFFFFFFFF).cast("long"))
    totals = written(totals.withColumn("b", low), "align-pairs")
    highest = totals.groupBy("b").agg(F.max("total").alias("highest"))
    known = totals.join(highest, "b").select(
        "code", "total", (F.col("total") == F.col("highest")).cast("long").alias("best"))
    looked_up = (entries.select("batch", "pos", "code").join(known, "code").groupBy("batch")
                 .agg(F.array_sort(F.collect_list(F.struct("pos", "total", "best"))).alias("x"))
                 .select("batch", F.col("x.total").alias("totals"), F.col("x.best").alias("best")))
    joined = batches.join(looked_up, "batch", "left").select(
        "kind", "uid", "ids", "stats", "groups", "uses", "totals", "best")
    scored = written(joined.mapInArrow(score, SCORED), "align-scored")

    sums = scored.filter("uid IS NOT NULL").groupBy("uid").agg(
        F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    whole_long = longs.join(sums, "uid", "left").select(
        "id", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups")
    out = scored.filter("uid IS NULL").drop("uid").unionByName(whole_long)
    return out.withColumn("id", F.col("id").cast(docs.schema[doc_id].dataType)) \
        .withColumnRenamed("id", doc_id)


def op12_fragment_alignment(spark, sf_dir: str) -> DataFrame:
    """Alignment of byte_bpe_50k.json and piece_bpe_32k.model over ``documents``."""
    out = align(table(spark, sf_dir, "documents"), *default_files(), groups=False)
    return out.withColumn("doc_id", F.col("doc_id").cast("long")) \
        .withColumnRenamed("groups", "groups_sha256")
