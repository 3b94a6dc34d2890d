"""Pairs of embeddings by cosine, and clusters of topics.

A vector that is null or empty, holds a null or a number that isn't finite, or isn't of the most usual length
(the shorter on a tie) has no pairs and no topic."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ...functions import text as T
from ..lineage import cut
from .blocks import by_pairs, groups_of

BLOCK = 1024
#: Pairs whose products are made again at once.
PAIRS = 1 << 14
#: How far a product of unit vectors in single precision is off at most, for some thousands of dimensions.
SINGLE = 1e-4
#: Numbers in a vector that is made from a text.
DIMENSIONS = 256


def usable(df: DataFrame, id_column: str, vector: Column) -> DataFrame:
    """(id, v) of the vectors that can be compared."""
    rows = df.select(F.col(id_column).cast("long").alias("id"), vector.cast("array<double>").alias("v")).where("id is not null and size(v) > 0")
    rows = rows.where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    usual = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").select("d").first()
    return rows.where(F.size("v") == (usual.d if usual else 0))


def text_vectors(df: DataFrame, id_column: str, text: Column, n: int = 3, dimensions: int = DIMENSIONS) -> DataFrame:
    """(id, v): hashed counts of words and of n-grams within words, damped by a root and brought to length one.

    Stands in for a sentence encoder, which can't be had offline. Texts without words have no vector."""
    mult = np.uint64(0x9E3779B97F4A7C15)

    def each(batches):
        places: dict[str, np.ndarray] = {}

        def of(word: str) -> np.ndarray:
            got = places.get(word)
            if got is None:
                padded = f" {word} "
                parts = [word, *(padded[i : i + n] for i in range(len(padded) - n + 1))]
                h = np.array([int.from_bytes(hashlib.blake2b(p.encode(), digest_size=8).digest(), "little") for p in parts], np.uint64)
                if len(places) > 200_000:
                    places.clear()
                got = places[word] = ((h * mult) >> np.uint64(33)).astype(np.int64)
            return got

        for batch in batches:
            ids, out = [], []
            for i, words in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not words:
                    continue
                at = np.concatenate([of(w) for w in words])
                signs = np.where(at & 1, 1.0, -1.0)
                v = np.zeros(dimensions)
                np.add.at(v, (at >> 1) % dimensions, signs)
                v = np.sign(v) * np.sqrt(np.abs(v))
                norm = np.linalg.norm(v)
                if norm:
                    ids.append(i)
                    out.append(v / norm)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([v.tolist() for v in out], pa.list_(pa.float64()))], ["id", "v"])

    rows = df.select(F.col(id_column).cast("long").alias("id"), T.words(text).alias("w")).where("id is not null and size(w) > 0")
    return rows.mapInArrow(each, "id long, v array<double>")


def matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Ids and unit vectors. Zero vectors stay zero."""
    v = table.column("v").combine_chunks()
    x = np.asarray(v.flatten()).astype(np.float64).reshape(table.num_rows, -1)
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return np.asarray(table.column("id")).astype(np.int64), np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)


def similar_pairs(df: DataFrame, id_column: str, vector: Column, threshold: float = 0.8, rows: int = BLOCK, groups: int | None = None) -> DataFrame:
    """(src, dst, cosine) of all pairs, exactly, by products of ``rows`` by ``rows`` vectors.

    Products are made in single precision first; those that may reach the threshold are worked out in double."""

    def work(first: pa.Table, others):
        m, u = matrix(first)
        u32 = u.astype(np.float32)
        for other in others:
            n, v = (m, u) if other is None else matrix(other)
            v32 = u32 if other is None else v.astype(np.float32)
            for i in range(0, len(m), rows):
                for j in range(i if other is None else 0, len(n), rows):
                    x, y = np.nonzero(u32[i : i + rows] @ v32[j : j + rows].T >= threshold - SINGLE)
                    if other is None and i == j:
                        x, y = x[x < y], y[x < y]
                    for at in range(0, len(x), PAIRS):
                        p, q = x[at : at + PAIRS] + i, y[at : at + PAIRS] + j
                        scores = np.einsum("ij,ij->i", u[p], v[q])
                        ok = (scores >= threshold - 1e-12) & (m[p] != n[q])
                        p, q, scores = p[ok], q[ok], scores[ok]
                        if len(p):
                            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(m[p], n[q])), pa.array(np.maximum(m[p], n[q])), pa.array(scores)], ["src", "dst", "cosine"])

    vectors = cut(usable(df, id_column, vector))
    return by_pairs(vectors, groups or groups_of(vectors.count()), work, "src long, dst long, cosine double")


def topics(df: DataFrame, id_column: str, vector: str, k: int, seed: int = 42, min_size: int = 2) -> DataFrame:
    """(id, topic) by k-means on unit vectors; topics of fewer than ``min_size`` rows get -1.

    Stands in for density clustering of a low-dimensional projection, which Spark doesn't have."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    rows = usable(df, id_column, F.col(vector)).withColumn("norm", norm).select("id", F.transform("v", lambda x: F.when(F.col("norm") > 0, x / F.col("norm")).otherwise(0.0)).alias("v"))
    points = cut(rows.select("id", array_to_vector("v").alias("features")))
    some = points.limit(k).count()
    if some < 2:
        return points.select("id", F.lit(-1 if min_size > some else 0).alias("topic"))
    model = KMeans(k=min(k, some), seed=seed, maxIter=20).fit(points)
    found = model.transform(points).select("id", F.col("prediction").alias("topic"))
    sizes = found.groupBy("topic").agg(F.count("*").alias("n"))
    return found.join(sizes, "topic").select("id", F.when(F.col("n") >= min_size, F.col("topic")).otherwise(F.lit(-1)).alias("topic"))


def topic_edges(found: DataFrame) -> DataFrame:
    """Edges that tie the rows of each topic to its first row."""
    first = found.where("topic >= 0").groupBy("topic").agg(F.min("id").alias("src"))
    return found.join(first, "topic").where("src <> id").select("src", F.col("id").alias("dst"))
