"""Documents to packed training sequences: each stage reads what its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sigweave.llm import decontamination, exact_dedup, near, packing, quality
from sigweave.llm.common import table, written


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier (learned from a bounded sample of labelled rows) doesn't reject."""
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def drop_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_exact(docs)


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group. A Jaccard similarity of 0.8 or more of their five-word shingles links."""
    return near.drop_near(docs, shingle=5, least=0.8)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontamination.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents, with their sequences."""
    return packing.pack(docs)


STAGES = [("quality classifier", keep_good), ("exact dedup", drop_exact), ("near-dedup", drop_near), ("benchmark decontamination", drop_leaks), ("packing", pack)]

#: The classifier is learned; SQL can't express it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
