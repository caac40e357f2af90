"""From raw documents to packed training sequences, stage by stage.

Every stage takes all rows and columns that the one before kept, whole texts of any length, and
gives the columns of documents (the last one its own). Null ids, texts, sources and languages
are allowed anywhere, further columns are carried along whatever their names, and an empty table gives an
empty one; what else a stage makes of nulls, ties and repeated rows, its function says.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.llm import cotraining, exact, minhash, mixing, packing  # noqa: E402
from tidemark.session import new_folder  # noqa: E402


def quality_classifier(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that are likely good and not toxic stay.

    A null text is judged as an empty one; rows alike are judged alike; without labels all stay.
    """
    return cotraining.accepted(docs, spark.read.parquet(f"{folder}/labels.parquet"))


def exact_dedup(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of texts equal but for A-Z in capitals one document stays, the one with the largest doc_id.

    Null texts are empty ones and equal; of repeated rows one stays; a null doc_id is the smallest.
    """
    return exact.deduplicate(docs)


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of documents linked by a similarity of 0.8 or more one stays, the one with the smallest doc_id.

    Documents without words are linked with nothing and stay; of repeated rows one stays.
    """
    return minhash.deduplicate(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Each document as often, or in the part, as the mix takes it, at most three times.

    A null source is one of its own, the last; documents without words are not taken. A repeated row
    is a document of its own.
    """
    return mixing.mixed_documents(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All pieces of the documents, packed into sequences of at most 2,048 tokens.

    A null text is its end id; a repeated row is packed again; pieces of one length go by row.
    """
    return packing.best_fit(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("exact_dedup", exact_dedup),
    ("minhash_near_dedup", minhash_near_dedup),
    ("source_mixing", source_mixing),
    ("best_fit_packing", best_fit_packing),
]
ORACLE_SQL = None  # SQL trains no classifier and runs no tokenizer


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = new_folder(spark, "pipeline")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return docs
