"""Corpus preparation in five stages, each of them one operator on all that its predecessor kept.

``STAGES`` lists (name, function); a function takes ``(spark, docs, sf_dir)``
and returns a DataFrame. All but the last return the columns of ``documents``.
``run`` applies them to ``documents`` and writes each stage's rows to the
shared folder before the next one reads them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emisplit.llm import decontaminate, langid, line_chunks, minhash, mixing
from emisplit.llm.common import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified; NULL texts, texts without a letter, low scores and texts unlike all learned ones go."""
    return langid.keep_identified(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated chunks of lines; those with nothing but blanks left go, NULL texts too. Ids may be NULL or shared."""
    rows = line_chunks.dedup_lines(docs).select(*docs.columns)
    return rows.where(F.col("text").rlike(r"[^\x20\x09-\x0D]"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id. Documents without an id go with their group."""
    return minhash.representatives(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item; all of them if there is none. Ids may be NULL or shared."""
    return decontaminate.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture: a row per copy taken, with its output shard and its place there. Ids may be NULL or shared; no rows give none."""
    return mixing.mixture(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language", language),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("benchmark", benchmark),
    ("mix", mix),
]

#: Training and the seeded hashes of the mixture can't be said in SQL; tests use brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


def queries() -> dict:
    return {"pipeline": run}


def oracle_sql() -> dict:
    return {}
