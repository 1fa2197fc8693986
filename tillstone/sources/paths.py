"""Small file-system helpers that work on any store Spark can reach."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def _path_and_fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    target, fs = _path_and_fs(spark, path)
    return fs.exists(target)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly under a directory; empty when there is none."""
    target, fs = _path_and_fs(spark, path)
    if not fs.exists(target):
        return []
    return [status.getPath().getName() for status in fs.listStatus(target)]


def remove(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table that its maker no longer needs."""
    target, fs = _path_and_fs(spark, path)
    fs.delete(target, True)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's folder for intermediate data, ``spark.checkpoint.dir``.

    Only a local session without a checkpoint folder gets a temporary one,
    because executors on other machines could not read it.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    return tempfile.mkdtemp(prefix="tillstone-")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new directory for an intermediate table."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Give iterative fits a place to cut their lineage, unless the session has one."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
