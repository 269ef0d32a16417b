"""Shared scratch storage of the running session."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def checkpoint_root(spark: SparkSession) -> str:
    """Folder all executors can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its own.
    """
    root = spark.conf.get(CHECKPOINT_SETTING, None)
    if root is None:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="millrace-")
        spark.conf.set(CHECKPOINT_SETTING, root)
    return root


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the shared folder; nothing is created there yet."""
    return f"{checkpoint_root(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def scratch_database(spark: SparkSession, purpose: str) -> str:
    """A fresh database whose tables lie below the shared folder."""
    path = scratch_path(spark, purpose)
    name = path.rsplit("/", 1)[1].replace("-", "_")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{path}'")
    return name


def discard(spark: SparkSession, path: str) -> None:
    """Removes a scratch path that nothing reads any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)
