"""Connected components by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .lineage import cut


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = F.least(F.min("v").over(Window.partitionBy("u")), F.col("u"))
    return both.withColumn("m", least).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
    marked = down.withColumn("m", F.min("v").over(Window.partitionBy("u")))
    moved = marked.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(marked.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(id, comp) of every node on an edge; comp is the smallest id of the component.

    Edges with a null end and loops are dropped. Each round is two shuffles of the
    edges that are left; rounds grow with the logarithm of the largest component."""
    now = cut(edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).where("u <> v").distinct())
    before = None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before:
            break
        before = mark
        now = cut(_small_star(_large_star(now)))
    stars = now.select(F.col("u").alias("id"), F.col("v").alias("comp"))
    return stars.unionByName(stars.select(F.col("comp").alias("id"), "comp")).distinct()
