"""Deduplication methods by name: (df, id, text, options) -> pairs (src, dst)."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import assemble, lcs, minhash, semantic, simhash, tfidf
from .exact import first_by_text
from .grams import Digests

Method = Callable[..., DataFrame]
METHODS: dict[str, Method] = {}


def register(name: str, method: Method) -> None:
    """Add a method, or replace one: (df, id_column, text, **options) -> (src, dst)."""
    METHODS[name] = method


def _minhash(df: DataFrame, id_column: str, text: Column, threshold: float = 0.8, ngram_size: int = 5, num_permutations: int = 128, band_size: int = 8, **_) -> DataFrame:
    signed = minhash.signatures(df, id_column, text, ngram_size, num_permutations)
    return minhash.similar_pairs(signed, threshold, band_size, num_permutations)


def _simhash(df: DataFrame, id_column: str, text: Column, ngram_size: int = 3, distance: int = 3, **_) -> DataFrame:
    return simhash.near_pairs(simhash.fingerprints(df, id_column, text, ngram_size), distance)


def _suffix_array(df: DataFrame, id_column: str, text: Column, min_length: int = 20, similarity_threshold: float = 0.5, **_) -> DataFrame:
    return lcs.similar_pairs(df, id_column, text, min_length, similarity_threshold)


def _dbscan(df: DataFrame, id_column: str, text: Column, eps: float = 0.2, min_samples: int = 2, max_features: int = 10_000, **_) -> DataFrame:
    return tfidf.density_edges(tfidf.vectors(df, id_column, text, max_features), eps, min_samples)


def _vectors(df: DataFrame, id_column: str, text: Column, embedding: str | None) -> DataFrame:
    """(id, v) from a column of vectors, or else from the texts."""
    if embedding:
        return df.select(F.col(id_column).cast("long").alias("id"), F.col(embedding).cast("array<double>").alias("v"))
    return semantic.text_vectors(df, id_column, text)


def _semantic(df: DataFrame, id_column: str, text: Column, embedding: str | None = None, threshold: float = 0.8, **_) -> DataFrame:
    return semantic.similar_pairs(_vectors(df, id_column, text, embedding), "id", F.col("v"), threshold)


def _topics(df: DataFrame, id_column: str, text: Column, embedding: str | None = None, topics: int = 20, min_topic_size: int = 2, **_) -> DataFrame:
    return semantic.topic_edges(semantic.topics(_vectors(df, id_column, text, embedding), "id", "v", topics, min_size=min_topic_size))


for _name, _method in {"minhash_lsh": _minhash, "simhash": _simhash, "suffix_array": _suffix_array, "dbscan": _dbscan, "semantic": _semantic, "bertopic": _topics}.items():
    register(_name, _method)


def similar(a: str, b: str, method: str = "minhash_lsh", **options) -> bool:
    """Whether two texts are near duplicates by a method that compares pairs, without Spark.

    The same rules as in ``deduplicate``; texts too short for the method are alike only if they are equal."""
    import numpy as np

    normal = lambda t: re.sub(r"\s+", " ", t.lower()).strip()
    a, b = normal(a), normal(b)
    if a == b:
        return a != ""
    if method == "suffix_array":
        shorter, k = min(len(a), len(b)), options.get("min_length", 20)
        common = lcs.longest_common(a, b)
        return common >= k and common >= options.get("similarity_threshold", 0.5) * shorter
    if method == "simhash":
        x, y = (simhash.fingerprint_of(t, Digests(options.get("ngram_size", 3))) for t in (a, b))
        return x is not None and y is not None and ((x ^ y) & (1 << 64) - 1).bit_count() <= options.get("distance", 3)
    if method == "minhash_lsh":
        perms = [np.array(x, np.uint64) for x in zip(*minhash.permutations(options.get("num_permutations", 128)))]
        x, y = (minhash.signature_of(t, *perms, Digests(options.get("ngram_size", 5))) for t in (a, b))
        return minhash.alike(x, y, options.get("threshold", 0.8))
    if method == "bloom_filter":
        return False
    raise ValueError(f"{method} compares a text with a corpus, not with another text")


def deduplicate(df: DataFrame, id_column: str, text: Column, length: Column | None = None, method: str = "minhash_lsh", enabled: bool = True, pos: str | None = None, **options) -> DataFrame:
    """The rows that stay. Off or with an unknown method all rows do. ``length``: what the representative has most of."""
    if not enabled:
        return df
    if method == "bloom_filter":
        return first_by_text(df, text, pos or id_column)
    if method not in METHODS:
        return df
    pairs = METHODS[method](df, id_column, text, **options).select("src", "dst")
    return assemble.survivors(df, pairs, id_column, F.length(text) if length is None else length, pos)
