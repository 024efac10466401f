"""The corpus pipeline: quality filter, exact and near deduplication, decontamination, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quotebook.llm.catalog import table
from quotebook.llm.decontamination import drop_contaminated
from quotebook.llm.exact_dedup import drop_copies
from quotebook.llm.near_duplicates import drop_near_copies
from quotebook.llm.packing import pack
from quotebook.llm.quality import drop_rejected
from quotebook.llm.queries import piece_digests
from quotebook.llm.staging import keep


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on those labelled good, does not reject."""
    return drop_rejected(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    return drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return drop_near_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any ten-word window of a benchmark item."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in sequences of 1024 ids."""
    return piece_digests(pack(docs))


STAGES = [
    ("quality", quality),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: The quality model and the near-duplicate groups are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each over the written result of the one before."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
