"""Tables that are replaced as a whole: each load is a folder of its own, and one small file names the current one.

A load is written beside the versions before it, checked there, and only then named by the file
``_current`` below the table's folder. That file is replaced by a rename that overwrites, so a
reader finds the old version or the new one, never a half or none, and a load that fails at any
point leaves the old table as it is. Frames read before keep reading their version until
``remove_old_versions`` is called.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_POINTER = "_current"


def _hadoop(spark: SparkSession, path: str):
    """(JVM, path object, its file system)."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def read_note(spark: SparkSession, path: str) -> dict | None:
    """Content of a small JSON file, or None if there is none."""
    jvm, target, system = _hadoop(spark, path)
    if not system.exists(target):
        return None
    stream = system.open(target)
    try:
        return json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def write_note(spark: SparkSession, path: str, content: dict) -> None:
    """Replace a small JSON file in one step."""
    jvm, target, system = _hadoop(spark, path)
    draft = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
    system.mkdirs(target.getParent())
    stream = system.create(draft, True)
    try:
        stream.write(bytearray(json.dumps(content).encode()))
    finally:
        stream.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    renames = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    renames[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(system.makeQualified(draft), system.makeQualified(target), renames)


def new_version(root: str) -> str:
    """Path of a fresh version below a table's folder."""
    return f"{root.rstrip('/')}/v-{uuid.uuid4().hex}"


def current_version(spark: SparkSession, root: str) -> dict | None:
    """``folder`` (below ``root``), ``columns`` and what else the last commit noted; None without any."""
    return read_note(spark, f"{root.rstrip('/')}/{_POINTER}")


def read_current(spark: SparkSession, root: str) -> DataFrame:
    """The current version of a table; a folder without versions is read as it is."""
    root = root.rstrip("/")
    known = current_version(spark, root)
    if known is None:
        return spark.read.parquet(root)
    schema = T.StructType.fromJson(known["schema"])
    # Partition columns lie in folder names below the version.
    return spark.read.schema(schema).parquet(f"{root}/{known['folder']}")


def commit_version(
    stored: DataFrame, root: str, folder: str, check: Callable[[DataFrame], object] | None = None, **notes
) -> DataFrame:
    """Make the version at ``folder`` current after ``check`` (which raises if it is not as it should be)."""
    spark, root = stored.sparkSession, root.rstrip("/")
    if check:
        check(stored)
    below = folder.removeprefix(root + "/")
    write_note(spark, f"{root}/{_POINTER}", {"folder": below, "schema": stored.schema.jsonValue(), **notes})
    return read_current(spark, root)


def remove_old_versions(spark: SparkSession, root: str) -> int:
    """Delete all versions but the current one; returns how many. Frames that read them stop working."""
    root = root.rstrip("/")
    known = current_version(spark, root)
    if known is None:
        return 0
    return remove_folders(spark, root, {known["folder"].split("/")[0]})


def remove_folders(spark: SparkSession, root: str, kept: set[str]) -> int:
    """Delete all versions below ``root`` but those named in ``kept``; returns how many."""
    _, target, system = _hadoop(spark, root)
    names = {entry.getPath().getName(): entry.getPath() for entry in system.listStatus(target)}
    old = [path for name, path in names.items() if name.startswith("v-") and name not in kept]
    for path in old:
        system.delete(path, True)
    return len(old)
