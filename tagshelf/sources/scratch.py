"""Intermediate tables in the folder shared by all executors.

A written table survives the loss of executors, cuts the lineage, and lets Spark
plan the next step on its real size.
"""

from __future__ import annotations

import os
import tempfile
from uuid import uuid4

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def scratch_path(spark: SparkSession) -> str:
    """A fresh path in the session's own folder, which is removed when its JVM ends.

    That folder lies in the one named by ``spark.checkpoint.dir``. Where it is
    unset a local session falls back to the machine's temporary folder; a
    cluster session is refused, since its executors share no such folder.
    """
    folder, file_system = _session_folder(spark)
    file_system.mkdirs(folder)
    file_system.deleteOnExit(folder)
    return f"{folder}/{uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Remove all intermediate tables of the session; tables not yet computed from them are lost."""
    folder, file_system = _session_folder(spark)
    file_system.delete(folder, True)


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and return the written table."""
    path = scratch_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_scratch(table: DataFrame) -> None:
    """Remove the one intermediate table that ``materialize`` returned."""
    spark = table.sparkSession
    folder, file_system = _session_folder(spark)
    for path in {spark._jvm.org.apache.hadoop.fs.Path(file).getParent() for file in table.inputFiles()}:
        if path.getParent().getName() != folder.getName():
            raise ValueError(f"{path} is no intermediate table of this session")
        file_system.delete(path, True)


def _session_folder(spark: SparkSession) -> tuple[JavaObject, JavaObject]:
    base = _base_folder(spark.conf.get(CHECKPOINT_DIR, None), spark.sparkContext.master)
    path = spark._jvm.org.apache.hadoop.fs.Path(base, f"tagshelf-{spark.sparkContext.applicationId}")
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _base_folder(configured: str | None, master: str) -> str:
    """The configured folder. Only ``local`` and ``local[...]`` may do without one.

    That all executors share the folder is taken on trust: a ``file:`` path may be a mount.
    """
    if configured:
        return configured
    if master != "local" and not master.startswith("local["):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder all executors share")
    return os.path.join(tempfile.gettempdir(), "tagshelf")
