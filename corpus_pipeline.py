"""A training corpus from ``documents``: quality rules, near duplicates, benchmark, mix, shards.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each one's rows to
the shared folder and reads them back as the next one's documents. All but the last return the
columns of ``docs``; the last adds ``shard`` and ``virtual_slot``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyfold.llm import decontamination, line_quality, mixing, near_duplicates, sharding
from tallyfold.llm.common import table
from tallyfold.sources.shared import stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass, without the lines that too many documents of their host share."""
    return line_quality.clean_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return near_duplicates.deduplicated(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a span of a benchmark item."""
    return decontamination.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row with its shard."""
    return sharding.sharded_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix_sources", mix_sources),
    ("shard", shard),
]

#: Near-duplicate signatures are beyond SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"corpus-{name}")
    return docs
