"""Folder that all executors can reach, for tables written between two stages of a report."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"

# Folder of a local run without the setting; removed when the process ends.
_local: list[tempfile.TemporaryDirectory] = []


def shared_root(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; on a local master without one, a temporary folder.

    A folder given by ``SparkContext.setCheckpointDir`` counts where the setting is absent.
    """
    root = spark.conf.get(_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"{_SETTING} must name a folder that every executor can reach")
    if not _local:
        _local.append(tempfile.TemporaryDirectory(prefix="tallyfold-", ignore_cleanup_errors=True))
    return _local[0].name


def new_folder(spark: SparkSession, name: str) -> str:
    """Path of a fresh folder below the shared root."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def stored(frame: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    Work that several sections share is done once, its lineage ends in files, and a lost
    executor costs a re-read instead of a recomputation.
    """
    spark = frame.sparkSession
    path = new_folder(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)
