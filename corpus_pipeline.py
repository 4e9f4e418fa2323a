"""Corpus pipeline: five stages over ``documents``, each written as Parquet and reread by the next.

Toxic documents go, one document of each class of equal texts stays, then one
of each group of near copies, personal data is masked, and what is left is
packed into training sequences. All stages but the last return the columns of
``documents``.

Every stage takes nulls in any column (a null text counts as empty), repeated rows
and empty tables: an empty table goes through as one, with its columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from datescore.llm import exact_dedup, ngram_join, packing, pii, toxicity
from datescore.llm.common import read_table, written


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxicity (6): documents whose expected severity reaches the cutoff go; learnt from ``labels``.

    Null and empty texts stay; repeated rows share their fate; without labels of both classes all stay.
    """
    return toxicity.drop_toxic(docs, toxicity.train(docs, read_table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Exact dedup (7): of equal texts the longest original, then the smallest doc_id (null last), stays.

    Null and empty texts are one class; of rows that repeat the one that stays, one stays.
    """
    return exact_dedup.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join (9): five words, similarity 0.8 or more; the smallest doc_id of a group stays.

    A text without words is linked with nothing and stays.
    """
    return ngram_join.keep_one(docs, n=5, num=8, den=10)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """PII (2): every span found is replaced by its kind; n_chars is counted again.

    All rows stay, repeated ones too; a null text stays null.
    """
    return pii.mask_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing (8): the pieces of all documents left, with their sequence and offset.

    A null or empty text is its end id alone; repeated rows are documents of their own.
    """
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("pii", mask_personal_data),
    ("packing", pack_sequences),
]

#: The stages train a classifier, follow links and tokenize: SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last stage's rows."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
