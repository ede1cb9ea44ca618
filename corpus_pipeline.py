"""Corpus pipeline: documents -> packed training sequences.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept,
and returns a DataFrame; ``run`` writes each result as Parquet to the shared
folder and rereads it as the next stage's input. All stages but the last return
the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wattlake.llm import common, exact_dedup, mixing, packing, quality_classifier, simhash


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the ratings, does not reject."""
    return quality_classifier.keep_good(docs, quality_classifier.trained(spark, docs, sf_dir))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.keep_representatives(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once, small sources repeated up to the limit."""
    return mixing.repeat_documents(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the training sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality classifier", good_documents),
    ("exact dedup", without_copies),
    ("SimHash near-dedup", without_near_copies),
    ("mixing sources to target weights", mixed_sources),
    ("best-fit packing", packed_sequences),
]

#: A fitted model, SimHash and a tokenizer cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
