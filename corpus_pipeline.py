"""From raw documents to a training mix, in five stages that are each written and read again.

Every stage takes (spark, docs, folder) and returns the documents it keeps, with the columns of ``documents``; the last
one adds ``copies``, the number of times the mix takes a document. Random draws make the result one that SQL cannot
express, so there is no SQL for it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodmart.llm import decontaminate, language_id, line_dedup, mixing, prob_minhash
from moodmart.llm.tables import read
from moodmart.session import stage

ORACLE_SQL = None


def known_language(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents in a language that the models know; those rejected go."""
    return language_id.accepted(docs)


def own_lines(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents without the lines that many share; n_chars follows the text."""
    kept = line_dedup.without_shared_lines(docs)
    changed = kept.withColumns({"text": F.col("_kept"), "n_chars": F.char_length("_kept").cast("long")})
    return changed.select(*docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return prob_minhash.without_near_duplicates(docs)


def clean_of_benchmark(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    return decontaminate.clean_documents(docs, read(spark, folder, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The documents that the mix of sources takes, with the number of copies."""
    return mixing.mixed_documents(docs)


STAGES = [
    ("language", known_language),
    ("lines", own_lines),
    ("near_duplicates", one_of_each),
    ("decontaminate", clean_of_benchmark),
    ("mixing", mixed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
