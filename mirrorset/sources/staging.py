"""Intermediate tables written to a folder that the cluster shares, and taken away afterwards."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_written: list[str] = []


def staging_root(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``, else the context's checkpoint folder, else one below the warehouse.

    A warehouse on a machine's own disk serves a local session only: on a cluster, the setting must name a shared folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    if not spark.sparkContext.master.startswith("local") and warehouse.startswith(("file:", "/")):
        raise ValueError("spark.checkpoint.dir must name a folder that the cluster shares")
    return warehouse.rstrip("/") + "/_staged"


def staged_path(spark: SparkSession, name: str) -> str:
    """A new path below the staging folder, deleted with the staged tables."""
    path = f"{staging_root(spark)}/{name}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def stage(df: DataFrame, name: str = "staged") -> DataFrame:
    """Write ``df`` to a new folder and read it back.

    The result has no lineage to recompute after a lost executor, every later
    branch sees the same rows, and Spark knows its size from the files.
    """
    spark = df.sparkSession
    path = staged_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, after: int = 0) -> None:
    """Delete the tables staged by this process, but for the first ``after``; nothing built on them can be read any more."""
    jvm = spark.sparkContext._jvm
    while len(_written) > after:
        path = jvm.org.apache.hadoop.fs.Path(_written.pop())
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Tables staged inside the block are deleted at its end: write the results before."""
    before = len(_written)
    try:
        yield
    finally:
        release(spark, before)
