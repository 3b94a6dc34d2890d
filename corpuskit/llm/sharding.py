"""Sharding by fixed virtual slots.

Records are hashed into a fixed number of slots, and slots, never records, are given to shards.
The map from slot to shard is a small table of one row for each slot; every version of it is kept.
Rebalancing makes a new version by editing the last: only the slots that a shard must give up
change hands, all other records stay where they are.

A record's slot depends on its doc_id alone, so equal rows and rows that share a doc_id share a
slot; where doc_id is null the text is hashed instead. A null text has no bytes. In an empty table
all slots are empty and are spread evenly. Other columns are ignored.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.lineage import shared_dir

SLOTS = 4096
SHARDS = 16
SHARDS_AFTER = 20


def slot(slots: int = SLOTS) -> Column:
    key = F.coalesce(F.col("doc_id").cast("string"), F.col("text").cast("string"), F.lit(""))
    return F.pmod(F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long"), F.lit(slots)).cast("int")


def slot_bytes(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """(slot, bytes) for every slot, also the empty ones."""
    sizes = docs.select(slot(slots).alias("slot"), F.coalesce(F.octet_length(F.col("text").cast("string")), F.lit(0)).cast("long").alias("b")).groupBy("slot").agg(F.sum("b").alias("bytes"))
    every = docs.sparkSession.range(slots, numPartitions=1).select(F.col("id").cast("int").alias("slot"))
    return every.join(sizes, "slot", "left").select("slot", F.coalesce("bytes", F.lit(0)).alias("bytes"))


def _spread(cum: Column, own: Column, total: Column, shards: int) -> Column:
    """The shard in whose share of ``total`` the middle of a slot lies."""
    return F.least(F.lit(shards - 1), F.call_function("div", (2 * cum - own) * F.lit(shards), 2 * F.greatest(total, F.lit(1)))).cast("int")


def first_map(sizes: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(slot, bytes, shard): runs of slots of about equal bytes. Empty slots weigh a byte."""
    one = Window.orderBy("slot").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy()
    w = F.col("bytes") + 1
    return sizes.select("slot", "bytes", _spread(F.sum(w).over(one), w, F.sum(w).over(whole), shards).alias("shard"))


def rebalanced(last: DataFrame, shards: int, shards_after: int) -> DataFrame:
    """The map edited for more shards: each old shard keeps its first slots up to the new fair
    share of bytes; the rest go to the new shards."""
    w = F.col("bytes") + 1
    run = Window.partitionBy("shard").orderBy("slot").rowsBetween(Window.unboundedPreceding, 0)
    marked = last.withColumn("w", w).withColumn("stays", F.sum("w").over(run) * shards_after <= F.sum("w").over(Window.partitionBy()))
    moved_w = F.when(F.col("stays"), F.lit(0)).otherwise(F.col("w"))
    cum = F.sum(moved_w).over(Window.orderBy("slot").rowsBetween(Window.unboundedPreceding, 0))
    new = F.lit(shards) + _spread(cum, F.col("w"), F.sum(moved_w).over(Window.partitionBy()), shards_after - shards)
    return marked.select("slot", "bytes", F.when(F.col("stays"), F.col("shard")).otherwise(new).cast("int").alias("shard"))


def store(slot_map: DataFrame, path: str, version: int) -> DataFrame:
    """Write one version of the map; a version that exists is an error. Returns it as stored."""
    slot_map.coalesce(1).write.mode("error").parquet(f"{path}/version={version}")
    return load(slot_map.sparkSession, path, version)


def load(spark, path: str, version: int) -> DataFrame:
    return spark.read.schema("slot int, bytes long, shard int").parquet(f"{path}/version={version}")


def assign(docs: DataFrame, slots: int = SLOTS, shards: int = SHARDS, shards_after: int = SHARDS_AFTER, path: str | None = None) -> DataFrame:
    """(doc_id, slot, shard_before, shard) by the first map and by the map edited for more shards.

    Both versions are stored below ``path``; without one, in a new folder of the shared folder."""
    path = path or f"{shared_dir(docs.sparkSession)}/slot-map-{uuid.uuid4()}"
    first = store(first_map(slot_bytes(docs, slots), shards), path, 1)
    second = store(rebalanced(first, shards, shards_after), path, 2)
    both = first.select("slot", F.col("shard").alias("shard_before")).join(second.select("slot", "shard"), "slot")
    # The map has a row for each slot, whatever the size of the corpus.
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), slot(slots).alias("slot")).join(F.broadcast(both), "slot").select("doc_id", "slot", "shard_before", "shard")


SQL = f"""
WITH d AS (SELECT doc_id, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, text, '')), 1, 8))::BIGINT % {SLOTS} AS slot, coalesce(strlen(text), 0) AS b FROM documents),
s AS (SELECT r.slot, coalesce(sum(b), 0)::BIGINT + 1 AS w FROM range({SLOTS}) r(slot) LEFT JOIN d USING (slot) GROUP BY r.slot),
c AS (SELECT slot, w, sum(w) OVER (ORDER BY slot)::BIGINT AS cum, sum(w) OVER ()::BIGINT AS total FROM s),
f AS (SELECT slot, w, total, least({SHARDS - 1}, (2 * cum - w) * {SHARDS} // (2 * total)) AS shard FROM c),
k AS (SELECT *, sum(w) OVER (PARTITION BY shard ORDER BY slot)::BIGINT * {SHARDS_AFTER} <= total AS stays FROM f),
m AS (SELECT *, sum(CASE WHEN stays THEN 0 ELSE w END) OVER (ORDER BY slot)::BIGINT AS mcum, sum(CASE WHEN stays THEN 0 ELSE w END) OVER ()::BIGINT AS mtotal FROM k),
n AS (SELECT slot, shard AS shard_before, CASE WHEN stays THEN shard ELSE {SHARDS} + least({SHARDS_AFTER - SHARDS - 1}, (2 * mcum - w) * {SHARDS_AFTER - SHARDS} // (2 * mtotal)) END AS shard FROM m)
SELECT doc_id, slot::INTEGER AS slot, shard_before::INTEGER AS shard_before, shard::INTEGER AS shard FROM d JOIN n USING (slot)
"""
