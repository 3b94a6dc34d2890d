"""The corpus build: source, messages, cleaning, quality, formatting, questions, duplicates, sinks.

Quality: languages are told by the model in ``language_model_path`` (see ``quality_models.fit_language``), or else by
one made from seed sentences; perplexity by that in ``perplexity_model_path``, or else by one fitted on the corpus
itself. A scorer has both at hand even if their own switches are off, as it would reject every row without them;
only wanted languages stay if ``fasttext_enabled`` is on; without a scorer no row is held against the threshold."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cleaning, messages, processors, quality, quality_models
from ..operators.dedup import assemble
from ..operators.dedup.registry import deduplicate
from ..operators.lineage import cut
from ..sources import files, shapes, sinks
from ..sources.registry import source_of
from .counters import Counters
from .formatting import format_conversations


def source(spark: SparkSession, conf: dict) -> DataFrame:
    p = conf["platform"]
    configured = p.get("type") and (p.get("platform_data_path") or p["type"] == "generic")
    df = source_of(p)(spark, p) if configured else shapes.standardise(files.read_formatted(spark, p["input_path"]))
    return df if "pos" in df.columns else df.withColumn("pos", F.struct("source_file", F.lit(0).alias("ordinal")))


def _text() -> Column:
    return assemble.canonical_text(F.col("conversation"))


def _language_model(spark: SparkSession, q: dict) -> DataFrame:
    return spark.read.parquet(q["language_model_path"]) if q["language_model_path"] else quality_models.seed_language_model(spark)


def with_language(df: DataFrame, conf: dict) -> DataFrame:
    """Adds column __lang; rows are written once and numbered for that."""
    df = cut(df.withColumn("__key", F.monotonically_increasing_id()))
    found = quality_models.languages(df.select("__key", _text().alias("t")), "__key", "t", _language_model(df.sparkSession, conf["filtering"]))
    return df.join(found.select("__key", F.col("language").alias("__lang")), "__key", "left").drop("__key")


def with_quality(df: DataFrame, conf: dict) -> DataFrame:
    """The quality filter as configured; nothing if all of it is off."""
    q = conf["filtering"]
    by_language, by_words, scored = q["fasttext_enabled"], q["kenlm_enabled"], q["logistic_regression_enabled"]
    if not (by_language or by_words or scored):
        return df
    df = cut(df.withColumn("__key", F.monotonically_increasing_id()))
    spark, texts = df.sparkSession, df.select("__key", _text().alias("t"))
    language = _language_model(spark, q) if by_language or scored else None
    words = None
    if q["perplexity_model_path"] and (by_words or scored):
        words = spark.read.parquet(q["perplexity_model_path"])
    elif by_words or scored:
        if language is not None:
            texts = texts.join(quality_models.languages(texts, "__key", "t", language).select("__key", "language"), "__key", "left").withColumn("language", F.coalesce("language", F.lit(quality.UNKNOWN)))
        words = quality_models.fit_perplexity(texts, "t", None if language is None else "language")
    out = quality.assessed(df, "__key", _text(), language, words, "logistic" if scored else None, q["quality_threshold"], q["target_languages"] if by_language else None)
    return out.drop("__key") if q["save_quality_metrics"] else out.drop("__key", "quality_metrics")


def process(df: DataFrame, conf: dict, counters: Counters | None = None) -> DataFrame:
    """Testing limit, processor, cleaning, quality, formatting; lazily but for the models of languages and words."""
    seen = counters.watch if counters else lambda df, name: df
    if conf["mode"] == "testing":
        df = df.orderBy("pos").limit(500)
    c = conf["cleaning"]
    df = seen(df.transform(cleaning.valid), "valid")
    df = seen(df.transform(processors.processor_of(conf["data_processing"]), conf["data_processing"]), "processed")
    languages = c["languages"] if c["language_filter_enabled"] else None
    if languages:
        df = with_language(df, conf)
    stop = {"max_ratio": c["max_stopword_ratio"], "min_words": c["min_word_count"], "custom": c["custom_stopwords"]}
    if c["stopwords_file"]:
        stop["stopwords_of"] = cleaning.load_stopwords(c["stopwords_file"])
    rules = [name for name in cleaning.FILTERS if c.get(f"{name}_filter_enabled", True)]
    df = cleaning.clean(df, c["max_length"], c["stopwords_enabled"], c["exact_dedup_enabled"], min_length=c["min_length"], languages=languages, language="__lang", filters=rules, seen=seen, **stop).drop("__lang")
    return seen(df.transform(with_quality, conf), "quality").transform(format_conversations, conf["formatting"])


def build(df: DataFrame, conf: dict, counters: Counters | None = None) -> tuple[DataFrame, DataFrame]:
    """(conversations, question/answer pairs), each without near duplicates.

    What both come from is written once; rows are numbered there, for the methods that compare numbers."""
    ready = cut(process(df, conf, counters).withColumn("id", F.monotonically_increasing_id()))
    options = {k: v for k, v in conf["deduplication"].items() if k not in ("method", "enabled")}
    chosen = {"method": conf["deduplication"]["method"], "enabled": conf["deduplication"]["enabled"]}
    kept = deduplicate(ready, "id", _text(), messages.total_length(), **chosen, **options)
    pairs = cut(messages.qa_pairs(ready).withColumn("id", F.monotonically_increasing_id()))
    # The first pair of a cluster stays: all have the same weight.
    return kept, deduplicate(pairs, "id", F.col("question"), F.lit(0), **chosen, **options)


def run(spark: SparkSession, conf: dict) -> dict[str, int]:
    """Writes the corpus; returns the rows that each stage left."""
    counters, out = Counters(), conf["output"]
    conversations, pairs = build(source(spark, conf), conf, counters)
    conversations, pairs = counters.watch(conversations, "conversations"), counters.watch(pairs, "qa_pairs")
    sinks.write_json(conversations.drop("id", "pos"), out["conversation_path"])
    sinks.write_json(pairs.drop("id"), out["qa_path"])
    if out["by_folder_path"]:
        kept = spark.read.json(out["conversation_path"])
        folder = F.col("source_folder") if "source_folder" in kept.columns else F.lit("all")
        sinks.write_by_folder(kept.withColumn("source_folder", folder), out["by_folder_path"])
    rows = counters.rows()
    if out["counters_path"]:
        Path(out["counters_path"]).write_text(json.dumps(rows, indent=2), encoding="utf-8")
    return rows


def main(argv: list[str] | None = None) -> None:
    import argparse

    from .config import load

    args = argparse.ArgumentParser(description="Build a corpus from chat logs.")
    args.add_argument("--config", default=None)
    run(SparkSession.builder.getOrCreate(), load(args.parse_args(argv).config))


if __name__ == "__main__":
    main()
