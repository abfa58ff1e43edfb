"""Registered queries of this package, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyfold.llm import (
    co_training,
    collocations,
    decontamination,
    language_models,
    licenses,
    line_quality,
    main_text,
    mixing,
    near_duplicates,
    oracle,
    periodic_runs,
    secrets,
    sharding,
    token_counts,
)
from tallyfold.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mixed(table(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", "taken")


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_size")


def op4_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality.line_quality(table(spark, sf_dir, "documents")).drop("row_hash")


def op5_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(table(spark, sf_dir, "documents"))
    return placed.selectExpr(
        "doc_id", "size", "text_crc32", "'bytes' as law", "shard", "slot", "cast(null as int) as grown_shard", "virtual_slot"
    )


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.secrets(table(spark, sf_dir, "documents")))


def op7_co_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    return co_training.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontamination.decontaminated(docs, benchmark).drop("row_hash")


def op9_entropy_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target: documents labelled as good and not toxic."""
    good = table(spark, sf_dir, "labels").filter("quality = 1 and toxic = 0")
    return language_models.entropy_difference(table(spark, sf_dir, "documents"), good)


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return licenses.license_matches(docs, licenses.known_notices(docs))


def op11_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.main_texts(table(spark, sf_dir, "pages"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.periodic_runs(table(spark, sf_dir, "documents"))


def llm_queries() -> dict[str, Query]:
    found = [
        op1_token_counts,
        op2_mix_sources,
        op3_near_duplicates,
        op4_line_quality,
        op5_shards,
        op6_secrets,
        op7_co_training,
        op8_decontamination,
        op9_entropy_difference,
        op10_licenses,
        op11_main_text,
        op12_collocations,
        op13_periodic_runs,
    ]
    return {query.__name__: query for query in found}


def llm_oracles() -> dict[str, str]:
    return {
        "op2_mix_sources": oracle.MIXING,
        "op4_line_quality": oracle.LINE_QUALITY,
        "op8_decontamination": oracle.DECONTAMINATION,
        "op12_collocations": oracle.COLLOCATIONS,
    }
