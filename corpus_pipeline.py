"""From raw documents to the order of training, in five stages.

Each stage takes (spark, docs, sf_dir), works on all that the one before kept, and returns a
DataFrame; all but the last return the columns of the documents. Labels and benchmark are read from
the input folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridagro.llm import decontaminate, exact_dedup, mixing, near_dedup, quality
from gridagro.llm.common import read, stored


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.keep_good(docs, read(spark, sf_dir, "labels"))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one with the largest doc_id."""
    return exact_dedup.keep_one(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest doc_id."""
    return near_dedup.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of words with the benchmark."""
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark"))


def training_order(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often and in the order in which they are trained on."""
    return mixing.training_order(docs)


STAGES = [
    ("quality", good_documents),
    ("exact_dedup", without_copies),
    ("near_dedup", without_near_copies),
    ("decontamination", without_benchmark),
    ("mixing", training_order),
]

#: SQL cannot express the classifier and the MinHash tables; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
