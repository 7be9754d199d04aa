"""A corpus pipeline: documents in, packed training sequences out.

Each stage works on all that its predecessor kept, is written as Parquet in the
shared folder and read again.  All but the last keep the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from scorefold.llm import dedup, mixing, packing, quality, resemblance
from scorefold.llm.common import table, written


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the pairwise quality ranking does not reject."""
    return quality.good_documents(docs, table(spark, sf_dir, "labels"))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return dedup.without_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, Jaccard similarity 0.8 or more."""
    return resemblance.one_of_each(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences."""
    return packing.packed_documents(docs)


STAGES = [
    ("quality classifier", good_quality),
    ("exact dedup", without_copies),
    ("near-dedup", without_near_copies),
    ("source mix", mixture),
    ("packing", packed),
]

#: A fitted classifier and token ids are beyond SQL; the tests compare every stage with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
