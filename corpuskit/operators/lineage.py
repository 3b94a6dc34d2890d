"""Cutting lineage in a way that survives the loss of executors."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; in local mode, where none is named, a temporary one."""
    sc = spark.sparkContext
    have = sc.getCheckpointDir()
    if have:
        return have
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="corpuskit-")
    sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """The same rows, written to the shared folder and read from there."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder of any file system that Spark can write to."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
