"""A training-data pipeline over documents: each stage is written as Parquet and read as the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from helixframe.llm import langid, packing, passages, simhash, toxicity
from helixframe.llm.common import keep, ready, scratch, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with a margin; null texts and texts without a letter go."""
    ready(spark)
    return langid.keep_identified(docs)


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain doesn't call toxic; all of them where the labels teach nothing."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of copies and near copies: that of the smallest id, of equal ids the first by place."""
    ready(spark)
    return simhash.drop_near_copies(docs, stored=True)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages that stand in an earlier one; a text may become empty, a null stays null."""
    ready(spark)
    return passages.cut_repeats(docs, stored=True)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences; null and empty texts are one token."""
    ready(spark)
    return packing.packed_sequences(docs)


STAGES = [
    ("language ID", language_id),
    ("toxicity", toxic),
    ("SimHash near-dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("best-fit packing", best_fit_packing),
]
#: SQL cannot express compression, trained models, fingerprints or tokenisers.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another. An empty table passes through all of them; columns besides the documents' own don't matter."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with scratch(spark):
            docs = keep(stage(spark, docs, sf_dir), name.replace(" ", "-"), hold=True)
    return docs
