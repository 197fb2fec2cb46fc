"""Corpus pipeline over ``documents``: quality classifier, near-dedup, decontamination, source mix, sharding.

Every stage takes (spark, docs, sf_dir), works on all documents that the stage before kept,
and returns the columns of ``documents``; the last adds shard and slot. A stage's result is
written as Parquet in the shared folder and read back as the next one's ``docs``, so a lost
executor costs at most one stage's recomputation.

Defined cases: NULL and empty texts are scored, kept apart from every near-duplicate group,
never contaminated, taken by the mix as they are and sharded like any other; rows with equal or
NULL ids are rows of their own at every stage; an empty table passes all stages empty; extra
columns come through, but for those of the last stage's names, which its results replace.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from orderlens.llm import decontaminate, mixing, near_dedup, quality_cnn, sharding
from orderlens.llm.common import table
from orderlens.session import materialize

SHARDS = 8


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents that the classifier rejects go."""
    return quality_cnn.good_documents(docs, docs, table(spark, sf_dir, "labels", "doc_id", "quality"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: one document of each near-duplicate group stays."""
    return near_dedup.unique_documents(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: documents that hold benchmark passages go."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: every document as often as the mix takes it."""
    return mixing.mixed_documents(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: every row with its shard and slot."""
    return sharding.with_shards(docs, SHARDS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("near-dedup", near_duplicates),
    ("decontamination", decontamination),
    ("source mix", source_mix),
    ("sharding", shards),
]

# The classifier is a trained network and the near-dedup groups are graph components: no SQL twin.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs, f"pipeline-{name.replace(' ', '-')}")
    return docs
