"""Parquet tables of a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table; one that is stored in fewer pieces than there are cores is dealt out to all of them."""
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
