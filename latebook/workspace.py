"""Where staged tables, sinks and stream checkpoints go: the cluster's shared folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def shared_root(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; only a local master may fall back to /tmp."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    root = tempfile.mkdtemp(prefix="latebook-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def new_folder(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_root(spark)}/latebook/{name}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession, name: str) -> Iterator[str]:
    """A path like ``new_folder``'s that is deleted at the end, also after a failure.

    What is read from it must be computed or written elsewhere before.
    """
    path = new_folder(spark, name)
    try:
        yield path
    finally:
        delete_folder(spark, path)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of any file system that Spark knows, if it is there."""
    found, system = _located(spark, path)
    system.delete(found, True)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none if it does not exist."""
    found, system = _located(spark, path)
    if not system.exists(found):
        return []
    return [s.getPath().getName() for s in system.listStatus(found) if s.isDirectory()]


def finished(spark: SparkSession, path: str) -> bool:
    """Whether Spark has written a table to its end."""
    found, system = _located(spark, f"{path}/_SUCCESS")
    return system.exists(found)


def _located(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    found = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    return found, found.getFileSystem(conf)
