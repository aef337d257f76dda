"""From raw documents to training shards: five stages, each an operator of ``skymatch.llm`` on all that the one before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from skymatch.deploy import ship
from skymatch.llm import decontam, mixing, near_dedup, quality, sharding
from skymatch.llm.common import materialize, table

SHARDS = 16


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble, fitted on ``labels``, scores 0.5 or more."""
    return quality.keep_good(docs, table(ship(spark), sf_dir, "labels"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near-duplicates: five-word shingles, similarity 0.8 or more."""
    ship(spark)
    return near_dedup.deduplicate(docs, k=5, threshold=80)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any item of ``benchmark``: five-word shingles, containment 0.8 or more."""
    return decontam.decontaminate(docs, table(ship(spark), sf_dir, "benchmark"), threshold=80)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of all sources at their target weights; a document taken twice is two rows."""
    ship(spark)
    return mixing.mixed_documents(docs)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row of the mix."""
    ship(spark)
    return sharding.assign(docs, shards=SHARDS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality_stage),
    ("near-dedup", near_dedup_stage),
    ("benchmark decontamination", decontamination_stage),
    ("mixing to target weights", mixing_stage),
    ("sharding", sharding_stage),
]

#: Connected components and fitted models can't be said in SQL; the tests hold every stage against a plain version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs, "pipeline-" + name.replace(" ", "-"))
    return docs
