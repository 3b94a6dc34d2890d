"""Queries of this subpackage, and the SQL that gives their results where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.tables import read_table
from . import bpe, hnsw, language_id, mixing, pii, sharding, simhash_dedup, substring_dedup, suffix_dedup, webp, webp_write


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, name)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": lambda spark, d: substring_dedup.repeated_passages(_table(spark, d, "documents")),
    "op2_language_id": lambda spark, d: language_id.identify(_table(spark, d, "documents")),
    "op3_suffix_array_dedup": lambda spark, d: suffix_dedup.repeated_passages(_table(spark, d, "documents")),
    "op4_hnsw_neighbours": lambda spark, d: hnsw.neighbours(_table(spark, d, "embeddings")),
    "op5_simhash_near_dedup": lambda spark, d: simhash_dedup.near_duplicates(_table(spark, d, "documents")),
    "op6_pii": lambda spark, d: pii.find(_table(spark, d, "documents")),
    "op8_byte_bpe": lambda spark, d: bpe.encode(_table(spark, d, "documents")),
    "op7_sharding": lambda spark, d: sharding.assign(_table(spark, d, "documents")),
    "op9_webp_pixels": lambda spark, d: webp.decode(webp_write.vector_images(_table(spark, d, "embeddings")), "vec_id"),
    "op10_mixing": lambda spark, d: mixing.sample(_table(spark, d, "documents")),
}

ORACLE_SQL: dict[str, str] = {
    "op1_substring_dedup": substring_dedup.SQL,
    "op3_suffix_array_dedup": suffix_dedup.SQL,
    "op5_simhash_near_dedup": simhash_dedup.SQL,
    "op7_sharding": sharding.SQL,
    "op10_mixing": mixing.SQL,
}
