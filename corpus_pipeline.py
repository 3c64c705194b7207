"""From raw documents to packed training sequences, as five stages over the corpus operators.

Each stage takes all rows the one before kept and returns the columns of ``documents``; the last
returns one row per packed piece. ``run`` writes every stage's result to the shared folder and reads
it again, so a lost executor costs tasks of one stage only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskloom.llm.common import small_batches, stored, table
from riskloom.llm.decontamination import without_leaks
from riskloom.llm.language import in_languages
from riskloom.llm.packing import pack
from riskloom.llm.similar import without_similar
from riskloom.llm.toxicity import without_toxic


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: texts without letters go, and texts of no learned language."""
    small_batches(spark)
    return in_languages(docs)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group at five-word similarity 0.8 or more stays, the one with the smallest id."""
    return without_similar(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs)


STAGES = [
    ("language_id", keep_known_languages),
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("packing", pack_sequences),
]

#: Trained models, fingerprints and tokens are beyond SQL; tests hold the stages to plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``: one row per packed piece of the documents that stay."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
