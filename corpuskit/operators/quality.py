"""Quality features, scores and the quality filter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

WEIGHTS = {"f_lang": 0.8, "f_ppl": -0.7, "f_chars": 0.5, "f_words": 0.3, "f_special": -0.4}
FEATURES = tuple(WEIGHTS)


def measured(text: Column) -> Column:
    """(characters, words, special): what the features need of a text, to be worked out once."""
    n_words = F.size(F.filter(F.split(T.collapse(text), " "), lambda w: w != ""))
    return F.struct(F.length(text).alias("characters"), n_words.alias("words"), T.special_ratio(text).alias("special"))


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a column that is worked out once for each row.

    Spark writes out a projected column wherever it is used, in later columns and in filters moved below
    it; what a generator makes it doesn't."""
    return df.select(*[df[c] for c in df.columns if c != name], F.explode(F.array(value)).alias(name))


def features_of(m: Column, confidence: Column, perplexity: Column) -> dict[str, Column]:
    """Language confidence, perplexity of 1000, two clippings of characters a word, share of special characters."""
    per_word = F.when(m["words"] > 0, m["characters"] / m["words"]).otherwise(F.lit(0.0))
    return {
        "f_lang": confidence.cast("double"),
        "f_ppl": F.least(F.lit(1.0), perplexity / 1000),
        "f_chars": F.least(F.lit(5.0), per_word) / 5,
        "f_words": F.least(F.lit(15.0), per_word) / 15,
        "f_special": m["special"],
    }


def features(text: Column, confidence: Column, perplexity: Column) -> dict[str, Column]:
    """The features straight from a text."""
    return features_of(measured(text), confidence, perplexity)


def logistic(f: dict[str, Column], weights=WEIGHTS, bias: float = 0.0) -> Column:
    z = F.lit(bias)
    for name, w in weights.items():
        z = z + f[name] * F.lit(w)
    return 1 / (1 + F.exp(-z))


def fallback(confidence: Column, perplexity: Column) -> Column:
    """The score without a model."""
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), confidence * (1 - F.least(F.lit(1.0), perplexity / 1000))))


UNKNOWN = "unknown"


def quality_filter(df: DataFrame, text: Column, language: Column | None = None, confidence: Column | None = None, perplexity: Column | None = None, scorer: str | None = "logistic", threshold: float = 0.5, targets: list[str] | None = None) -> DataFrame:
    """Rows with quality_metrics, without blank texts, languages that aren't wanted and, if there is a scorer, scores
    below the threshold. A missing language is "unknown" with confidence 0, a missing perplexity infinite. Without any
    model all rows are kept with neutral metrics."""
    if language is None and perplexity is None and scorer is None:
        return neutral(df)
    lang = F.lit(UNKNOWN) if language is None else F.coalesce(language, F.lit(UNKNOWN))
    conf = F.lit(0.0) if confidence is None else F.coalesce(confidence.cast("double"), F.lit(0.0))
    ppl = F.lit(float("inf")) if perplexity is None else F.coalesce(perplexity.cast("double"), F.lit(float("inf")))
    out = df.where(T.strip(text) != "")
    if targets and language is not None:
        out = out.where(lang.isin(*targets))
    if scorer == "logistic":
        out = once(out, "__measured", measured(text))
        score = logistic(features_of(F.col("__measured"), conf, ppl))
    else:
        score = fallback(conf, ppl) if scorer else F.lit(0.0)
    out = once(out, "quality_metrics", metrics(lang, conf, ppl, score)).drop("__measured")
    return out.where(F.col("quality_metrics.quality_score") >= threshold) if scorer else out


def metrics(language: Column, confidence: Column, perplexity: Column, score: Column) -> Column:
    return F.struct(language.alias("language"), confidence.cast("double").alias("lang_confidence"), perplexity.cast("double").alias("perplexity"), score.cast("double").alias("quality_score"))


def neutral(df: DataFrame) -> DataFrame:
    """All rows, with the metrics that they get where filtering is wanted but no model is at hand."""
    return df.withColumn("quality_metrics", metrics(F.lit(UNKNOWN), F.lit(0.0), F.lit(float("inf")), F.lit(0.5)))


def assessed(df: DataFrame, id_column: str, text: Column, language_model: DataFrame | None = None, perplexity_model: DataFrame | None = None, scorer: str | None = "logistic", threshold: float = 0.5, targets: list[str] | None = None) -> DataFrame:
    """The quality filter with its models: language first, then perplexity by the model of that language.

    ``language_model``: see ``quality_models.fit_language``; ``perplexity_model``: see ``quality_models.fit_perplexity``.
    Without any of the models and without scorer rows are kept with neutral metrics."""
    from . import quality_models as Q

    if language_model is None and perplexity_model is None and scorer is None:
        return neutral(df)
    texts = df.select(F.col(id_column).alias("__id"), text.alias("__text"))
    out = df
    language = confidence = perplexity = None
    if language_model is not None:
        found = Q.languages(texts, "__id", "__text", language_model)
        out = out.join(found.withColumnsRenamed({"language": "__language", "confidence": "__confidence"}), out[id_column] == found["__id"], "left").drop("__id")
        language, confidence = F.col("__language"), F.col("__confidence")
        texts = texts.join(found.select("__id", F.col("language").alias("__of")), "__id", "left")
    if perplexity_model is not None:
        known = texts if language_model is not None else texts.withColumn("__of", F.lit(UNKNOWN))
        found = Q.perplexities(known, "__id", "__text", "__of", perplexity_model)
        out = out.join(found.withColumnRenamed("perplexity", "__perplexity"), out[id_column] == found["__id"], "left").drop("__id")
        perplexity = F.col("__perplexity")
    return quality_filter(out, text, language, confidence, perplexity, scorer, threshold, targets).drop("__language", "__confidence", "__perplexity")


def word_perplexity(docs: DataFrame, id_column: str, text: str, model: DataFrame) -> DataFrame:
    """(id, perplexity) by a table (word, logp) of base-10 log probabilities; words that it lacks get its least one.

    Words are counted within each text first, so that frequent ones are joined once a text."""
    least = model.agg(F.min("logp").alias("least"))
    counts = docs.select(F.col(id_column).alias("id"), F.explode(T.words(F.col(text))).alias("word")).groupBy("id", "word").agg(F.count("*").alias("n"))
    scored = counts.join(model, "word", "left").crossJoin(F.broadcast(least))
    return scored.groupBy("id").agg(F.pow(F.lit(10.0), -F.sum(F.col("n") * F.coalesce("logp", "least")) / F.sum("n")).alias("perplexity"))


def unigram_model(docs: DataFrame, text: str) -> DataFrame:
    """(word, logp) with one added to every count."""
    counts = docs.select(F.explode(T.words(F.col(text))).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    total = counts.agg((F.sum("n") + F.count("*")).alias("total"))
    return counts.crossJoin(F.broadcast(total)).select("word", F.log10((F.col("n") + 1) / F.col("total")).alias("logp"))
