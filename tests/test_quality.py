"""Language and perplexity models, the quality filter with them, and its place in the corpus build."""

import json

import pytest
from pyspark.sql import functions as F

from corpuskit.operators import cleaning, processors, quality, quality_models
from corpuskit.plans import build, config
from corpuskit.plans.counters import Counters
from corpuskit.sources import shapes, sinks, social

EN = "could someone tell the visitors where the green tea, those porcelain cups and the lemon biscuits were sold near the northern entrance"
DE = "könnten Sie mir sagen, wann der Laden am Sonntag geöffnet ist und was der Tee kosten würde"


def test_language_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("length(text) > 40")
    model = quality_models.fit_language(docs, "doc_id", "text", "lang", share=0.25)
    held = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(1000)) >= 250)
    found = held.join(quality_models.languages(held, "doc_id", "text", model), "doc_id")
    right, n, sure = found.agg(F.avg((F.col("lang") == F.col("language")).cast("double")), F.count("*"), F.min("confidence")).first()
    assert n > 500 and right > 0.95 and 0 < sure <= 1


def test_seed_languages(spark):
    rows = spark.createDataFrame([(1, EN), (2, DE), (3, "pourriez-vous me dire quand le magasin est ouvert le dimanche"), (4, "請問這個多少錢，我想要買茶，謝謝你的幫助"), (5, ""), (6, None)], "id long, t string")
    found = {r.id: r.language for r in quality_models.languages(rows, "id", "t", quality_models.seed_language_model(spark)).collect()}
    assert found == {1: "en", 2: "de", 3: "fr", 4: "zh"}


def test_language_grams(spark, monkeypatch):
    texts = ["abc abd", "ab", "", None, "日本語 日本", "a\U0001f600b\U0001f600b", "Zoë  zoe", "xyz", "abc"]
    rows = spark.createDataFrame([(i, "pq"[i % 2], t) for i, t in enumerate(texts)] + [(0, "p", "qrst")], "id long, l string, t string")
    model = quality_models.fit_language(rows, "id", "t", "l", share=1.0)
    want = {}
    for r in rows.selectExpr("l", "trim(regexp_replace(lower(t), ' +', ' ')) t").collect():
        for k in range(len(r.t or "") - 2):
            want[r.l, r.t[k : k + 3]] = want.get((r.l, r.t[k : k + 3]), 0) + 1
    assert {(r.label, r.g): round(2.718281828459045**r.gain) - 1 for r in model.collect()} == want
    sent = {tuple(r) for r in quality_models.languages(rows, "id", "t", model).collect()}
    monkeypatch.setattr(quality_models, "SENT_GRAMS", 0)
    assert sent == {tuple(r) for r in quality_models.languages(rows, "id", "t", model).collect()} and {r[0] for r in sent} == {0, 4, 5, 6, 7, 8}


def test_perplexity(spark):
    rows = spark.createDataFrame([(1, "en", "a b a b a b"), (2, "en", "b a q"), (3, "xx", "a b"), (4, "en", "")], "id long, lang string, t string")
    model = quality_models.fit_perplexity(rows.where("id = 1"), "t", "lang")
    got = {r.id: r.perplexity for r in quality_models.perplexities(rows, "id", "t", "lang", model).collect()}
    # "<s> a" once of once, "a b" three of three, "b a" two of two; six words, two kinds, one more for the unknown.
    p = 0.6 + 0.4 * 4 / 9
    assert got[1] == pytest.approx(1 / p) and got[3] == float("inf") and 4 not in got
    assert got[2] == pytest.approx((0.4 * 4 / 9 * p * 0.4 / 9) ** (-1 / 3))


def test_pairs_of_words_are_counted_in_each_text(spark):
    rows = spark.createDataFrame([("x", "en", ["a", "b", "a", "b"]), ("y", None, ["b"]), ("x", "en", []), ("z", "en", None), ("z", "xx", ["<s>", "a"])], "id string, lang string, w array<string>")
    h = {r.w: r.h for r in spark.createDataFrame([(w,) for w in ("<s>", "a", "b", "en", "xx")], "w string").select("w", F.xxhash64("w").alias("h")).collect()}
    got = {(r.id, r.before, r.word): r.n for r in quality_models._counted_pairs(rows).collect()}
    assert got == {("x", h["<s>"], h["a"]): 1, ("x", h["a"], h["b"]): 2, ("x", h["b"], h["a"]): 1, ("y", h["<s>"], h["b"]): 1, ("z", h["<s>"], h["<s>"]): 1, ("z", h["<s>"], h["a"]): 1}
    pairs = [tuple(r) for r in quality_models._bigrams(rows.drop("id")).collect()]
    assert sorted(pairs, key=str) == sorted([("en", "<s>", "a"), ("en", "a", "b"), ("en", "b", "a"), ("en", "a", "b"), (None, "<s>", "b"), ("xx", "<s>", "<s>"), ("xx", "<s>", "a")], key=str)


def test_filter(spark):
    rows = spark.createDataFrame([(1, EN, "en", 0.9, 250.0), (2, EN, "de", 0.9, 250.0), (3, "  ", "en", 0.9, 1.0), (4, EN, "en", None, None), (5, EN, None, None, 1.0)], "id long, t string, l string, c double, p double")
    full = quality.quality_filter(rows, F.col("t"), F.col("l"), F.col("c"), F.col("p"), targets=["en"])
    (one,) = full.collect()
    assert one.id == 1 and one.quality_metrics.quality_score > 0.7 and full.columns[-1] == "quality_metrics"
    assert {r.id for r in quality.quality_filter(rows, F.col("t"), F.col("l"), scorer=None, threshold=0.0, targets=["en"]).collect()} == {1, 4}
    assert {r.id for r in quality.quality_filter(rows, F.col("t"), F.col("l"), F.col("c"), F.col("p"), threshold=0.0).collect()} == {1, 2, 4, 5}
    neutral = quality.assessed(rows, "id", F.col("t"), scorer=None).collect()
    assert len(neutral) == 5 and {tuple(r.quality_metrics) for r in neutral} == {("unknown", 0.0, float("inf"), 0.5)}
    assert quality.assessed(rows.limit(0), "id", F.col("t"), quality_models.seed_language_model(spark)).count() == 0


def items(spark, *talks):
    made = [{"conversation": [{"role": "User" if i % 2 == 0 else "Assistant", "content": t} for i, t in enumerate(talk)]} for talk in talks]
    rows = spark.createDataFrame([("f", i, json.dumps(x)) for i, x in enumerate(made)], "source_file string, ordinal int, j string").withColumn("item", F.parse_json("j"))
    return shapes.standardise(rows)


def first_words(df):
    return sorted(r.conversation[0].content.split()[0] for r in df.collect())


def test_build_with_scorer_keeps_ordinary_talk(spark):
    df = items(spark, [EN, "it is open from nine to five, and the tea is three pounds a box"])
    out = build.process(df, config.load(None, {"filtering": {"logistic_regression_enabled": True}})).collect()
    assert len(out) == 1 and out[0].quality_metrics.quality_score > 0.5 and out[0].quality_metrics.language == "en"
    off = build.process(df, config.load(None, {"filtering": {"logistic_regression_enabled": True, "save_quality_metrics": False}}))
    assert off.count() == 1 and "quality_metrics" not in off.columns
    assert "quality_metrics" not in build.process(df, config.load()).columns


def test_build_switches(spark, tmp_path):
    df = items(spark, [EN, "nine"], [DE, "neun"], ["this is it the and of to in a you that they " * 3, "so"])
    run = lambda **over: first_words(build.process(df, config.load(None, over)))
    assert run(filtering={"fasttext_enabled": True}) == ["could"]
    assert run(filtering={"fasttext_enabled": True, "target_languages": ["de"]}) == ["könnten"]
    assert run(filtering={"kenlm_enabled": True}) == ["could", "könnten"]
    assert run(cleaning={"languages": ["de"]}) == ["könnten"]
    assert run(cleaning={"languages": ["de"], "language_filter_enabled": False}) == ["could", "könnten"]
    assert run(cleaning={"stopwords_enabled": False}) == ["could", "könnten", "this"]
    assert run(cleaning={"max_stopword_ratio": 0.99}) == ["could", "könnten", "this"]
    assert run(cleaning={"custom_stopwords": "der sie wann am ist und was tee mir sagen könnten würde".split(), "min_word_count": 5}) == ["could"]
    (tmp_path / "stop.txt").write_text("Tee\n\nwann\n")
    assert cleaning.load_stopwords(str(tmp_path / "stop.txt")) == {"tee", "wann"} and "the" in cleaning.load_stopwords(str(tmp_path / "none"))
    assert run(cleaning={"stopwords_file": str(tmp_path / "stop.txt")}) == ["could", "könnten", "this"]
    cleaning.register_filter("url", lambda d: d.where(~F.exists("conversation", lambda m: F.contains(m["content"], F.lit("nine")))))
    try:
        assert run() == ["könnten"] and run(cleaning={"url_filter_enabled": False}) == ["could", "könnten"]
    finally:
        cleaning.register_filter("url", lambda d: d)


def test_models_from_files(spark, tmp_path):
    seed = spark.createDataFrame([(1, "aa", "zzz yyy xxx zzz yyy"), (2, "bb", "could you tell me")], "id long, l string, t string")
    quality_models.fit_language(seed, "id", "t", "l", share=1.0).write.parquet(str(tmp_path / "lang"))
    df = items(spark, [EN, "nine"], ["zzz yyy xxx", "yyy"])
    conf = {"filtering": {"fasttext_enabled": True, "language_model_path": str(tmp_path / "lang"), "target_languages": ["aa"]}}
    assert first_words(build.process(df, config.load(None, conf))) == ["zzz"]


def test_processors(spark):
    df = items(spark, [EN, "nine"], [DE, "neun"])
    processors.register("german", lambda d, conf: d.where(F.contains(F.col("conversation")[0]["content"], F.lit(conf["filter_words"][0]))))
    try:
        assert first_words(build.process(df, config.load(None, {"data_processing": {"type": "german", "filter_words": ["Laden"]}}))) == ["könnten"]
    finally:
        del processors.PROCESSORS["german"]
    assert processors.processor_of({"type": "none"}) is processors.default is processors.processor_of({})


def test_counters(spark):
    counters = Counters()
    kept, pairs = build.build(items(spark, [EN, "nine"], [EN, "nine"], ["x" * 40_000, "y"]), config.load(), counters)
    assert kept.count() == 1 and pairs.count() == 1
    rows = counters.rows()
    assert rows["valid"] == rows["processed"] == 3 and rows["length"] == rows["stopwords"] == 2 and rows["exact_dedup"] == rows["quality"] == 1


def thread(folder, name, people, *said):
    folder.mkdir(parents=True, exist_ok=True)
    messages = [{"sender_name": who, "content": text, "timestamp_ms": i} for i, (who, text) in enumerate(said)]
    (folder / name).write_text(json.dumps({"thread_path": f"inbox/{folder.name}", "participants": [{"name": p} for p in people], "messages": messages}))


def test_social_build_by_folder(spark, tmp_path):
    inbox = tmp_path / "inbox"
    thread(inbox / "ann_1", "message_1.json", ["Ann", "Shop"], ("Ann", EN), ("Shop", "at nine, and it is three pounds"))
    thread(inbox / "bob_2", "message_1.json", ["Bob", "Shop", "Cy"], ("Bob", "what do you sell in there"), ("Shop", "tea and cups, all kinds of them"))
    read = social.read_threads(spark, str(inbox))
    assert social.most_frequent(read) == "Shop" and social.most_frequent(read.limit(0)) is None
    owners = {r.source_folder: r.account_owner for r in social.transform_threads(read, None, by_frequency=True).collect()}
    assert owners == {"ann_1": "Shop", "bob_2": "Shop"}
    assert {r.account_owner for r in social.transform_threads(read, "Dee").collect()} == {"Shop", "Dee"}
    out = {"conversation_path": str(tmp_path / "c"), "qa_path": str(tmp_path / "q"), "by_folder_path": str(tmp_path / "f"), "counters_path": str(tmp_path / "n.json")}
    conf = config.load(None, {"platform": {"type": "facebook", "platform_data_path": str(inbox), "user_name": "Shop"}, "output": out})
    rows = build.run(spark, conf)
    assert rows["conversations"] == rows["qa_pairs"] == 2 and json.loads((tmp_path / "n.json").read_text()) == rows
    assert sorted(p.name for p in (tmp_path / "f").iterdir() if p.is_dir()) == ["source_folder=ann_1", "source_folder=bob_2"]
    assert spark.read.json(str(tmp_path / "f")).count() == 2


def test_folders_sink(spark, tmp_path):
    sinks.write_by_folder(spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "x int, source_folder string"), str(tmp_path / "o"))
    assert {(r.x, r.source_folder) for r in spark.read.json(str(tmp_path / "o")).collect()} == {(1, "a"), (2, "b"), (3, "a")}


def test_scorer_on_labels(spark):
    """Trained on labels, the scorer puts good rows above bad ones."""
    rows = spark.createDataFrame([(i, float(i % 10), 1.0 if i % 10 > 4 else 0.0) for i in range(200)] + [(999, 9.0, None)], "id long, f double, y double")
    got = {r.id: r.score for r in quality_models.trained_scores(rows, "id", ["f"], "y").collect()}
    assert got[9] > 0.9 > 0.1 > got[0] and got[999] == got[9]
