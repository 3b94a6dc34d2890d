"""The batch operators on streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


def first_by_text(stream: DataFrame, text: str, event_time: str, delay: str = "1 hour") -> DataFrame:
    """The first row of each normalised text within the delay; state older than that is dropped."""
    keyed = stream.withWatermark(event_time, delay).withColumn("__key", F.sha2(T.dedup_text(F.col(text)), 256))
    return keyed.dropDuplicatesWithinWatermark(["__key"]).drop("__key")


def counts(stream: DataFrame, event_time: str, key: str, window: str = "5 minutes", delay: str = "10 minutes") -> DataFrame:
    """Rows of each key in windows of event time."""
    return stream.withWatermark(event_time, delay).groupBy(F.window(event_time, window), key).agg(F.count("*").alias("n"))
