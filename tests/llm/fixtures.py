"""Small tables with the awkward cases, shared by the operator tests."""

import random

from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    # Names that the operators use themselves.
    T.StructField("k0", T.StringType()), T.StructField("label", T.StringType()),
    T.StructField("tie", T.StringType()), T.StructField("node", T.LongType()),
    T.StructField("size", T.StringType()), T.StructField("t_", T.StringType())])

BIG = (1 << 53) + 1  # not a float


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    vocab = ["".join(r.choice("aeioubcdlmnrst") for _ in range(r.randint(1, 7))) for _ in range(400)]
    return " ".join(r.choice(vocab) for _ in range(n))


def edge_rows() -> list[tuple]:
    """(doc_id, text, lang, source): nulls, empty, blank, long, ties, repeats."""
    base = prose(1, 120)
    words = base.split()
    near = " ".join(words[:60] + ["changed"] + words[61:])
    far = " ".join(words[:40]) + " " + prose(2, 90)
    return [
        (3, base, "en", "a"), (4, base.upper(), "en", "a"), (5, near, "en", None), (6, far, "de", "b"),
        (6, far, "de", "b"), (7, None, "en", "a"), (8, "", None, "b"), (9, " \t\n ", "fr", "b"),
        (10, "one two", "en", "c"), (11, "ONE  two", "en", "c"), (None, prose(3, 70), "en", "c"),
        (None, None, None, None), (BIG, prose(4, 3000) + "\x00 é中", "en", "\U0001f600"),
        (BIG, prose(4, 3000), "en", "￮"), (12, "x", "en", "b"), (13, "a b c d e f", "en", "b"),
        (14, "zzz " * 400, "en", "a"), (15, "line one here\nline one here\nother\n\n" * 4, "fr", "b"),
        (16, "#$%&*|<> !!! 12 34", None, "a")]


def edge_docs(spark, rows=None):
    rows = edge_rows() if rows is None else rows
    return spark.createDataFrame(
        [(i, t, la, s, None if t is None else len(t), "x", "y", "z", 1, "w", "v")
         for i, t, la, s in rows], SCHEMA).repartition(3)


def lower_az(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
