"""From raw documents to token ids: language, near duplicates, personal data, mixing, tokens.

Null or wordless texts are in no language and go at the first stage, so that later ones meet texts only; a null
doc_id, lang or source is kept (a null source is a source of its own in mixing). Texts of any length go through
whole. Rows that share a doc_id are one document for near duplicates: they stay or go together. Ties are settled
by the operators: the smallest doc_id of a group stays. An empty table gives an empty result. All columns pass
through the first four stages, whatever they are called; the last gives those of the encoder.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corpuskit.llm import bpe, language_id, mixing, pii, simhash_dedup
from corpuskit.operators.lineage import remove, shared_dir


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that the labels tell apart."""
    return language_id.keep_identified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, and all others."""
    return simhash_dedup.deduplicated(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with identifiers and secrets masked in their text."""
    return pii.mask(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many rows as there are documents, every source with the same share of them."""
    return mixing.mix(docs)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row."""
    return bpe.encode(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_duplicates),
    ("pii", mask_personal_data),
    ("mixing", mix_sources),
    ("byte_bpe", encode_tokens),
]

#: SQL can't express the first stage: its network is trained here.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to the documents; each but the last is written to the shared folder and read again.

    What a stage has written is removed when the next one is done. The last one's remains, as the result is read
    from it; it goes with the shared folder."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4()}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before:
            remove(spark, f"{folder}/{before}")
        before = name
    return STAGES[-1][1](spark, docs, sf_dir)
