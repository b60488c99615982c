"""The corpus pipeline: documents through five of the operators.

Each stage takes (spark, docs, sf_dir) and gives the documents it keeps; the
last one adds ``copies``.  ``run`` writes each stage's result to the shared
folder and reads it back, so that a lost executor costs no earlier stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskstream.llm import decontaminate, langid, mixing, neardup, pii
from riskstream.llm.common import table, written

#: Documents whose words' mean probability of the best language is lower go.
MIN_LANG_SCORE = 0.4
#: Near duplicates: word shingles and similarity in percent.
SHINGLE, SIMILARITY = 5, 80


def by_place(df: DataFrame) -> DataFrame:
    """Columns c0, c1, ...: names of the documents' own may come twice."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a language (null, no letters) or with no clear
    one; ``lang`` becomes the predicted language.  Without any labelled row
    nothing can be learned, and nothing is dropped."""
    model = langid.fit(docs)
    if not model.langs:
        return docs
    got = by_place(langid.predict_language(docs, model, docs.columns))
    given, (pred, score) = docs.columns, got.columns[-2:]
    kept = got.filter((F.col(pred) != langid.UNKNOWN) & (F.col(score) >= MIN_LANG_SCORE))
    lang = given.index("lang")
    return kept.select(*[F.col(pred if i == lang else c).alias(name)
                         for i, (c, name) in enumerate(zip(kept.columns, given))])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the smallest id."""
    return neardup.one_of_each(docs, size=SHINGLE, threshold=SIMILARITY)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data become surrogates; n_chars follows the new text."""
    got, given = by_place(pii.replace_entities(docs)), docs.columns
    size = F.length(got.columns[given.index("text")]).cast(docs.schema["n_chars"].dataType)
    return got.select(*[(size if name == "n_chars" else F.col(c)).alias(name)
                        for c, name in zip(got.columns, given)])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix of sources takes, with ``copies`` (in place of
    any column of that name)."""
    return mixing.mixed(docs.drop("copies"))


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("personal_data", personal_data),
    ("mix_sources", mix_sources),
]

#: Learned languages and hashed surrogates have no SQL; tests/llm compares the
#: stages with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
