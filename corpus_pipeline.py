"""Cleaning a corpus: five stages, each on all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from plumbline.llm import jaccard, packing, quality, secrets, suffixes
from plumbline.session import new_path

# Texts without what was removed or masked keep the columns of `documents`; n_chars follows the text.
MASK = "[secret]"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, as they are."""
    return quality.good_documents(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that with the smallest id.

    Rows without an id come last in their group. Of one id's texts in a group the
    one with the smallest hash stays, and of rows equal in id and text any one.
    """
    return jaccard.representatives(docs)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the strings that also start earlier; those left without text go.

    Where a removed string ends within a character, the character's remaining bytes go too.
    """
    return suffixes.remaining_texts(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with every secret masked."""
    return secrets.masked(docs, MASK)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's pieces with their sequences and places."""
    from plumbline.llm.queries import vocabulary

    return packing.packed_documents(docs, vocabulary())


STAGES = [
    ("quality_rules", quality_rules),
    ("jaccard_join", jaccard_join),
    ("suffix_dedup", suffix_dedup),
    ("secret_scan", secret_scan),
    ("best_fit_packing", best_fit_packing),
]
# Packing and suffix arrays have no SQL; the stages are tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
