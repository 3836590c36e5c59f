"""The corpus pipeline: quality classifier, quality rules, near-dedup, PII, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before
kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from logweave.llm import cotrain, neardup, packing, pii, quality_rules
from logweave.llm.common import table, written


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier keeps."""
    return cotrain.keep_good(docs, table(spark, sf_dir, "labels"))


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weighted rules keep."""
    return quality_rules.keep_good(docs)


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates: that with the smallest id."""
    return neardup.first_of_class(docs)


def pseudonymise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with pseudonyms for personal numbers and dates, by the key in the
    session's settings; a session without one gets a key for test tables."""
    return pii.pseudonymise(docs, pii.session_key(spark, "test tables"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, placed in sequences of 2048 tokens."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality_classifier", classify),
    ("quality_rules", rules),
    ("near_dedup", dedup),
    ("pii", pseudonymise),
    ("packing", pack),
]

#: Learned classifiers, sketches, tokenisation and packing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, name)
    return docs
