"""Where intermediate files go: a folder every executor can reach."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, or else the context's checkpoint folder.

    A session without either gets a temporary folder if driver and executors are
    one process. On a cluster that would be another folder on each machine, so
    there it is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="tallyframe-")


def new_shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder. It is left in place, since frames that read it are lazy."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is there, by Spark's own file system for it.

    PySpark has no public call for this: a reader of a path that is not there
    fails its analysis, which sessions with an observation report as an error.
    """
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def refuse_existing(spark: SparkSession, path: str) -> None:
    """Fail now if ``path`` exists, rather than after hours of work."""
    if path_exists(spark, path):
        raise FileExistsError(f"path already exists: {path}")
