"""Named queries over the driver tables and the SQL that gives their results.

Every query runs over its whole table. ``QUERIES`` has callables of (spark, sf_dir); ``ORACLE_SQL`` has
DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import unicode as U
from ..operators import cleaning, messages, quality, quality_models
from ..operators.dedup import assemble, exact, grams, lcs, minhash, semantic, simhash, tfidf
from ..operators.graph import connected_components
from ..sources import shapes, social
from ..sources.tables import read_table
from . import oracle as O

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return read_table(spark, d, name)


def conversations(spark: SparkSession, d: str) -> DataFrame:
    return messages.from_turns(table(spark, d, "conversations"))


def documents(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents")


# Messages and cleaning

FILTER_WORDS = ["tionnt", "schst", "eauou", ".com"]
TO_USER, TO_ASSISTANT = ["eau", "ung"], ["onth", "lich"]


@query(O.ROLE_NORMALIZE)
def role_normalize(spark, d):
    return table(spark, d, "conversations").select("conv_id", "turn", "role", T.normal_role(F.col("role")).alias("normal_role"))


@query(O.CONV_VALID_LENGTH)
def conv_valid_length(spark, d):
    kept = conversations(spark, d).transform(cleaning.valid).transform(cleaning.length_between, 4000)
    return kept.select("conversation_id", F.size("conversation").cast("long").alias("n_messages"), messages.total_length().alias("total_length"))


@query(O.STOPWORD_RATIO)
def stopword_ratio(spark, d):
    words = T.words(F.col("text"))
    return documents(spark, d).select("doc_id", F.size(words).cast("long").alias("n_words"), F.round(cleaning.stopword_ratio(words), 6).alias("ratio"))


@query(O.STOPWORD_FILTER)
def stopword_filter(spark, d):
    return conversations(spark, d).transform(cleaning.few_stopwords, 0.1).select("conversation_id")


@query(O.BLOCKLIST_MESSAGES)
def blocklist_messages(spark, d):
    kept = messages.drop_blocked(conversations(spark, d), FILTER_WORDS)
    return kept.select("conversation_id", F.size("conversation").cast("long").alias("n_messages"), messages.total_length().alias("total_length"))


def _roles(df: DataFrame) -> DataFrame:
    return df.select("conversation_id", F.posexplode("conversation").alias("n", "m")).select("conversation_id", F.col("n").cast("long").alias("n"), F.col("m.role").alias("role"))


@query(O.ROLE_TRANSFER_INTENDED)
def role_transfer_intended(spark, d):
    return _roles(messages.transfer_roles(conversations(spark, d), TO_USER, TO_ASSISTANT))


@query(O.ROLE_TRANSFER_REFERENCE)
def role_transfer_reference(spark, d):
    return _roles(messages.transfer_roles(conversations(spark, d), TO_USER, TO_ASSISTANT, "reference"))


@query(O.EXACT_DEDUP_CONV)
def exact_dedup_conv(spark, d):
    return cleaning.exact_dedup(conversations(spark, d)).select("conversation_id")


@query(O.EXACT_DEDUP_DOCS)
def exact_dedup_docs(spark, d):
    return cleaning.first_of(documents(spark, d), F.md5("text"), "doc_id").select("doc_id", "lang", "source")


@query(O.EXACT_DEDUP_SHA256)
def exact_dedup_sha256(spark, d):
    return cleaning.first_of(documents(spark, d), F.sha2("text", 256), "doc_id").select("doc_id", F.sha2("text", 256).alias("digest"))


@query(O.BLOOM_DEDUP)
def bloom_dedup(spark, d):
    return exact.first_by_text(documents(spark, d), F.col("text"), "doc_id").select("doc_id")


@query(O.BLOOM_PARAMS)
def bloom_params(spark, d):
    bits, hashes = exact.bloom_size_columns(F.col("n"), F.col("p"))
    n = documents(spark, d).groupBy("source").agg(F.count("*").cast("double").alias("n"), F.lit(0.001).alias("p"))
    return n.select("source", bits.cast("long").alias("bits"), hashes.cast("long").alias("hashes"))


@query(O.QA_PAIRS)
def qa_pairs(spark, d):
    cleaned = conversations(spark, d).transform(cleaning.valid).transform(cleaning.length_between).transform(cleaning.exact_dedup)
    return messages.qa_pairs(cleaned)


@query(O.QA_DEDUP_EXACT)
def qa_dedup_exact(spark, d):
    pairs = messages.qa_pairs(conversations(spark, d)).withColumn("pos", F.struct("conversation_id", "n"))
    return exact.first_by_text(pairs, F.col("question")).select("conversation_id", "n", "question")


@query(O.FIRST_500)
def first_500(spark, d):
    return table(spark, d, "conversations").orderBy("conv_id", "turn").limit(500).select("conv_id", "turn", "role")


@query(O.SUMMARY_STATS)
def summary_stats(spark, d):
    turns = table(spark, d, "conversations")
    c = messages.from_turns(turns, normal_roles=False).withColumn("participants", F.array_distinct(F.transform("conversation", lambda m: m["role"]))).withColumn("source_file", F.lit(""))
    return social.summary(c).crossJoin(turns.agg(F.sum(F.length("text")).alias("characters"))).withColumn("messages", F.col("messages").cast("long"))


@query(O.REPRESENTATIVE_LONGEST)
def representative_longest(spark, d):
    c = conversations(spark, d)
    first = c.select("conversation_id", F.col("conversation")[0]["role"].alias("role"), F.size("conversation").alias("n"), messages.total_length().alias("length"))
    best = F.max_by("conversation_id", F.struct("length", -F.col("conversation_id")))
    return first.groupBy("role", "n").agg(best.alias("conversation_id"), F.max("length").alias("length")).withColumn("n", F.col("n").cast("long"))


# Quality


def _scored(spark, d) -> DataFrame:
    """Documents with a stand-in for a language model's confidence and perplexity."""
    return documents(spark, d).withColumn("conf", (F.col("doc_id") % 100) / 100.0).withColumn("ppl", (F.col("doc_id") * 37 % 1500).cast("double"))


@query(O.QUALITY_FEATURES)
def quality_features(spark, d):
    f = quality.features(F.col("text"), F.col("conf"), F.col("ppl"))
    return _scored(spark, d).select("doc_id", *[F.round(c, 6).alias(n) for n, c in f.items()])


@query(O.QUALITY_SCORE)
def quality_score(spark, d):
    f = quality.features(F.col("text"), F.col("conf"), F.col("ppl"))
    return _scored(spark, d).select("doc_id", F.round(quality.logistic(f), 6).alias("score"))


@query(O.QUALITY_FALLBACK)
def quality_fallback(spark, d):
    return _scored(spark, d).select("doc_id", F.round(quality.fallback(F.col("conf"), F.col("ppl")), 6).alias("score"))


@query(O.QUALITY_FILTER)
def quality_filter(spark, d):
    kept = quality.quality_filter(_scored(spark, d), F.col("text"), F.col("lang"), F.col("conf"), F.col("ppl"), threshold=0.6, targets=["en", "fr"])
    return kept.select("doc_id", F.col("quality_metrics.language").alias("language"), F.round("quality_metrics.quality_score", 6).alias("score"))


@query(O.LANGUAGE_TARGET_FILTER)
def language_target_filter(spark, d):
    return documents(spark, d).transform(cleaning.in_languages, ["en", "de"]).groupBy("lang").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"))


@query(O.QUALITY_VS_LABELS)
def quality_vs_labels(spark, d):
    f = quality.features(F.col("text"), F.col("conf"), F.col("ppl"))
    scored = _scored(spark, d).select("doc_id", quality.logistic(f).alias("s"))
    return scored.join(table(spark, d, "labels"), "doc_id").groupBy("quality").agg(F.count("*").alias("n"), F.round(F.avg("s"), 6).alias("mean_score"))


@query(O.WORD_PERPLEXITY)
def word_perplexity(spark, d):
    docs = documents(spark, d)
    return quality.word_perplexity(docs, "doc_id", "text", quality.unigram_model(docs, "text")).select(F.col("id").alias("doc_id"), F.round("perplexity", 3).alias("perplexity"))


@query(O.LANGID_NB)
def langid_nb(spark, d):
    """Fitted on all labelled rows."""
    return quality_models.language_naive_bayes(documents(spark, d), "doc_id", "text", "lang", share=1.0)


@query(O.PERPLEXITY_BY_LANGUAGE)
def perplexity_by_language(spark, d):
    docs = documents(spark, d).where("lang is not null")
    found = quality_models.perplexities(docs, "doc_id", "text", "lang", quality_models.fit_perplexity(docs, "text", "lang"))
    return found.select("doc_id", F.round("perplexity", 3).alias("perplexity"))


@query(O.QUALITY_END_TO_END)
def quality_end_to_end(spark, d):
    """Languages, perplexity in the language that was found, score and filter, each by a model of the table."""
    docs = documents(spark, d)
    language = quality_models.fit_language(docs, "doc_id", "text", "lang", share=1.0)
    words = quality_models.fit_perplexity(docs, "text", "lang")
    kept = quality.assessed(docs, "doc_id", F.col("text"), language, words, threshold=0.6, targets=["en", "fr"])
    m = F.col("quality_metrics")
    return kept.select("doc_id", m["language"].alias("language"), F.round(m["lang_confidence"], 4).alias("confidence"), F.round(m["perplexity"], 2).alias("perplexity"), F.round(m["quality_score"], 4).alias("score"))


@query()
def quality_lr_trained(spark, d):
    f = quality.features(F.col("text"), F.lit(1.0), F.lit(0.0))
    rows = documents(spark, d).select("doc_id", *[c.alias(n) for n, c in f.items()]).join(table(spark, d, "labels"), "doc_id", "left")
    return quality_models.trained_scores(rows, "doc_id", list(f), "quality")


# Formatting


def _text_query(name: str, f, sql: str) -> None:
    def run(spark, d):
        return documents(spark, d).select("doc_id", f(F.col("text")).alias("text"))

    run.__name__ = name
    query(sql)(run)


_text_query("replace_urls", T.replace_urls, O.REPLACE_URLS)
_text_query("replace_emails", T.replace_emails, O.REPLACE_EMAILS)
_text_query("replace_numbers", T.replace_numbers, O.REPLACE_NUMBERS)
_text_query("strip_punct", T.strip_punctuation, O.STRIP_PUNCT)
_text_query("collapse_ws", T.collapse, O.COLLAPSE_WS)
_text_query("lowercase", F.lower, O.LOWERCASE)
_text_query("nfc", U.nfc, O.NFC)


@query(O.HTML_STRIP)
def html_strip(spark, d):
    return table(spark, d, "pages").select("page_id", T.strip_tags(F.col("html")).alias("text"))


@query()
def html_clean(spark, d):
    return table(spark, d, "pages").select("page_id", U.clean_html(F.col("html")).alias("text"))


@query(O.PAGE_URLS)
def page_urls(spark, d):
    return table(spark, d, "pages").select("page_id", T.replace_urls(F.concat(F.lit("see "), F.col("url"), F.lit(" now"))).alias("text"))


@query(O.FORMAT_TEXT_ALL)
def format_text_all(spark, d):
    x = T.normalize_dates(T.strip_tags(F.col("text")))
    x = T.replace_numbers(T.replace_emails(T.replace_urls(x)))
    return documents(spark, d).select("doc_id", F.lower(T.collapse(T.strip_punctuation(x))).alias("text"))


def _dated(spark, d) -> DataFrame:
    m, day = F.month("o_orderdate"), F.dayofmonth("o_orderdate")
    lines = F.concat(m, F.lit("/"), day, F.lit("~"), day + 1, F.lit("、"), day + 2, F.lit("~"), day + 3, F.lit(", "), day, F.lit("~"), day, F.lit("\nno "), day, F.lit("~"), day, F.lit("\n2023/"), m, F.lit("/"), day, F.lit("、"), day, F.lit("、"), m, F.lit(", "), m, F.lit("-"), day)
    return table(spark, d, "orders").select("o_orderkey", lines.alias("text"))


@query(O.NORMALIZE_DATES)
def normalize_dates(spark, d):
    return _dated(spark, d).select("o_orderkey", T.normalize_dates(F.col("text")).alias("text"))


@query(O.REPLACE_DATES)
def replace_dates(spark, d):
    return _dated(spark, d).select("o_orderkey", T.replace_dates(F.col("text")).alias("text"))


# Near duplicates


@query(O.CHAR_NGRAMS_COUNT)
def char_ngrams_count(spark, d):
    return grams.counts(documents(spark, d), "doc_id", F.col("text"), 5)


@query(O.MINHASH_SIGNATURE)
def minhash_signature(spark, d):
    s = minhash.signatures(documents(spark, d), "doc_id", F.col("text"))
    return s.select(F.col("id").alias("doc_id"), *[F.col("signature")[i].alias(f"s{i}") for i in range(8)])


def _minhash_pairs(spark, d) -> DataFrame:
    return minhash.similar_pairs(minhash.signatures(documents(spark, d), "doc_id", F.col("text")))


@query(O.LSH_CANDIDATES)
def lsh_candidates(spark, d):
    cut = minhash.bands(minhash.signatures(documents(spark, d), "doc_id", F.col("text"))).select("id", F.xxhash64("band", "part").alias("key"))
    n = cut.groupBy("key").agg(F.count("*").alias("size"))
    return n.groupBy("size").agg(F.count("*").alias("buckets"))


@query(O.MINHASH_PAIRS)
def minhash_pairs(spark, d):
    """Components have the same members as those of all similar pairs, of which equal signatures give a star only."""
    comps = connected_components(_minhash_pairs(spark, d))
    return comps.groupBy("comp").agg(F.count("*").alias("members"), F.sum("id").alias("ids"))


@query(O.MINHASH_SIMILARITY)
def minhash_similarity(spark, d):
    """Pairs of documents with different signatures, and each document with the first of its signature."""
    return _minhash_pairs(spark, d)


@query(O.MINHASH_CLUSTERS)
def minhash_clusters(spark, d):
    return connected_components(_minhash_pairs(spark, d)).select(F.col("id").alias("doc_id"), "comp")


@query(O.MINHASH_DEDUP)
def minhash_dedup(spark, d):
    docs = documents(spark, d)
    return assemble.survivors(docs, _minhash_pairs(spark, d), "doc_id", F.length("text")).select("doc_id")


@query(O.MINHASH_REMOVED)
def minhash_removed(spark, d):
    return assemble.removed(documents(spark, d), _minhash_pairs(spark, d), "doc_id", F.length("text")).select(F.col("id").alias("doc_id"), "kept_id")


@query(O.SIMHASH_VALUE)
def simhash_value(spark, d):
    return simhash.fingerprints(documents(spark, d), "doc_id", F.col("text")).select(F.col("id").alias("doc_id"), "fp")


def _simhash_pairs(spark, d) -> DataFrame:
    return simhash.near_pairs(simhash.fingerprints(documents(spark, d), "doc_id", F.col("text")))


@query(O.SIMHASH_NEAR)
def simhash_near(spark, d):
    """Pairs of different fingerprints, and each document with the first of its fingerprint."""
    return _simhash_pairs(spark, d)


@query(O.SIMHASH_PAIRS)
def simhash_pairs(spark, d):
    comps = connected_components(_simhash_pairs(spark, d))
    return comps.groupBy("comp").agg(F.count("*").alias("members"), F.sum("id").alias("ids"))


@query(O.SIMHASH_DEDUP)
def simhash_dedup(spark, d):
    return assemble.survivors(documents(spark, d), _simhash_pairs(spark, d), "doc_id", F.length("text")).select("doc_id")


@query(O.COSINE_PAIRS)
def cosine_pairs(spark, d):
    found = semantic.similar_pairs(table(spark, d, "embeddings"), "vec_id", F.col("embedding"), 0.4)
    return found.select("src", "dst", F.round("cosine", 4).alias("cosine"))


@query(O.SEMANTIC_DEDUP)
def semantic_dedup(spark, d):
    e = table(spark, d, "embeddings")
    pairs = semantic.similar_pairs(e, "vec_id", F.col("embedding"), 0.4)
    return assemble.survivors(e, pairs, "vec_id", F.size("embedding")).select("vec_id", "label")


def _messages(spark, d) -> DataFrame:
    return table(spark, d, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), "text")


@query(O.LCS_PAIRS)
def lcs_pairs(spark, d):
    found = lcs.similar_pairs(_messages(spark, d), "id", F.col("text"))
    return found.select("src", "dst", F.col("common").cast("long").alias("common"), F.col("shorter").cast("long").alias("shorter"))


@query(O.LCS_DEDUP)
def lcs_dedup(spark, d):
    m = _messages(spark, d)
    return assemble.survivors(m, lcs.similar_pairs(m, "id", F.col("text")), "id", F.length("text")).select("id")


def _tfidf(spark, d) -> DataFrame:
    return tfidf.vectors(documents(spark, d), "doc_id", F.col("text"))


@query(O.TFIDF_PAIRS)
def tfidf_pairs(spark, d):
    return tfidf.near_pairs(_tfidf(spark, d)).select("src", "dst", F.round("cosine", 6).alias("cosine"))


@query(O.DBSCAN_DEDUP)
def dbscan_dedup(spark, d):
    return assemble.survivors(documents(spark, d), tfidf.density_edges(_tfidf(spark, d)), "doc_id", F.length("text")).select("doc_id")


@query()
def topic_dedup(spark, d):
    e = table(spark, d, "embeddings")
    edges = semantic.topic_edges(semantic.topics(e, "vec_id", "embedding", 20))
    return assemble.survivors(e, edges, "vec_id", F.size("embedding")).select("vec_id", "label")


@query(O.GENERIC_SHAPES)
def generic_shapes(spark, d):
    """Turns of all conversations, packed into items of four shapes by turns and read back."""
    t = table(spark, d, "conversations").where("text <> ''")
    kind = F.col("conv_id") % 4
    turn = F.when(kind == 0, F.to_json(F.struct(F.col("role"), F.col("text").alias("content")))).when(kind == 1, F.to_json(F.struct(F.col("role").alias("sender"), "text"))).when(kind == 2, F.to_json(F.struct(F.col("role").alias("speaker"), "text"))).otherwise(F.to_json(F.struct(F.lit("x").alias("foo"))))
    packed = t.select("conv_id", kind.alias("kind"), "turn", turn.alias("j")).groupBy("conv_id", "kind").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "j"))), lambda x: x["j"]), ",").alias("all"))
    name = F.when(F.col("kind") == 0, "conversation").when(F.col("kind") == 2, "dialog").otherwise("messages")
    item = F.try_parse_json(F.concat(F.lit('{"'), name, F.lit('":['), F.col("all"), F.lit("]}")))
    rows = packed.select("conv_id", shapes.conversation(item).alias("c")).where("c is not null")
    return rows.select("conv_id", F.posexplode("c").alias("n", "m")).select("conv_id", F.col("n").cast("long").alias("n"), F.col("m.role").alias("role"), F.col("m.content").alias("content"))


@query(O.PAIR_SHAPES)
def pair_shapes(spark, d):
    """Turns packed into items of the two shapes of questions and answers by turns, and read back."""
    t = table(spark, d, "conversations").where("text <> '' and role <> ''")
    asked = F.to_json(F.struct("text", F.lit("u").alias("user"), F.col("role").alias("answer")))
    item = F.when(F.col("conv_id") % 2 == 0, asked).otherwise(F.to_json(F.struct(F.col("text").alias("prompt"), F.col("role").alias("assistant"))))
    rows = t.select("conv_id", "turn", F.posexplode(shapes.conversation(F.try_parse_json(item))).alias("n", "m"))
    return rows.select("conv_id", "turn", F.col("n").cast("long").alias("n"), F.col("m.role").alias("role"), F.col("m.content").alias("content"))


@query()
def stream_dedup(spark, d):
    """First event of each kind and user within an hour, from a stream of the table run to its end."""
    from ..streaming import dedup

    schema = spark.read.parquet(f"{d}/events.parquet").schema
    stream = spark.readStream.schema(schema).parquet(f"{d}/events.parquet*").withColumn("text", F.concat_ws(" ", F.col("user_id").cast("string"), "event_type")).withColumn("ts", F.col("ts").cast("timestamp"))
    return run_to_end(dedup.first_by_text(stream, "text", "ts"))


def run_to_end(stream: DataFrame) -> DataFrame:
    """A stream's rows so far, as a table in the shared folder."""
    import uuid

    from ..operators.lineage import shared_dir

    spark = stream.sparkSession
    to = f"{shared_dir(spark)}/stream-{uuid.uuid4()}"
    stream.writeStream.format("parquet").option("path", f"{to}/rows").option("checkpointLocation", f"{to}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{to}/rows")
