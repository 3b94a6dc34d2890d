"""Message, cleaning, quality and question operators on small cases."""

from pyspark.sql import functions as F

from corpuskit.operators import cleaning, messages, quality

SCHEMA = f"conversation_id long, pos long, conversation array<{messages.MESSAGE}>"


def conv(spark, *turns):
    return spark.createDataFrame([(i, i, [(r, c, None) for r, c in t]) for i, t in enumerate(turns)], SCHEMA)


def roles(df):
    return [m.role for m in df.first().conversation]


def test_from_turns(spark):
    turns = spark.createDataFrame([(1, 1, "bot", "b"), (1, 0, "human", "a"), (2, 0, "x", None)], "conv_id long, turn long, role string, text string")
    out = {r.conversation_id: [(m.role, m.content, m.do_train) for m in r.conversation] for r in messages.from_turns(turns).collect()}
    assert out == {1: [("User", "a", False), ("Assistant", "b", True)], 2: [("X", None, False)]}


def test_block_list(spark):
    df = conv(spark, [("User", "see x.com"), ("Assistant", "ok"), ("User", "")], [("User", "y.com")])
    assert [[m.content for m in r.conversation] for r in messages.drop_blocked(df, [".com"]).collect()] == [["ok"]]
    assert messages.drop_blocked(df, None).count() == 2


def test_role_transfer(spark):
    df = conv(spark, [("User", "q"), ("Assistant", "a"), ("User", "q2"), ("Assistant", "HIT x"), ("User", "q3"), ("Assistant", "a3")])
    assert roles(messages.transfer_roles(df, ["HIT"])) == ["User", "Assistant", "User", "User", "User", "Assistant"]
    assert roles(messages.transfer_roles(df, ["HIT"], None, "reference")) == [None, "Assistant", "Assistant", "User", "User", "Assistant"]
    assert roles(messages.transfer_roles(df, None, None)) == roles(df)


def test_questions(spark):
    df = conv(spark, [("User", "q1"), ("Assistant", "a1"), ("Assistant", "a2"), ("User", "q2"), ("User", "q3"), ("Assistant", "  "), ("Assistant", "a3")], [("Assistant", "x"), ("User", ""), ("Assistant", "y")])
    assert [(r.n, r.question, r.answer) for r in messages.qa_pairs(df).orderBy("n").collect()] == [(0, "q1", "a1\n a2\n"), (1, "q3", "a3\n")]


def test_length_and_validity(spark):
    df = conv(spark, [("User", "x" * 32768)], [("User", "x" * 32769)], [(None, "x")], [])
    kept = df.transform(cleaning.valid).transform(cleaning.length_between)
    assert [r.pos for r in kept.collect()] == [0]


def test_stopwords(spark):
    df = conv(spark, [("User", "the " * 19)], [("User", "the " * 10 + "zz " * 10)], [("User", "the " * 11 + "zz " * 9)])
    assert sorted(r.pos for r in cleaning.few_stopwords(df).collect()) == [0, 1]
    assert sorted(r.pos for r in cleaning.few_stopwords(df, custom=["zz"]).collect()) == [0]


def test_exact(spark):
    a = [("User", "What is the capital of France?"), ("Assistant", "The capital of France is Paris.")]
    df = conv(spark, a, [("User", "b")], a, [("User", "c")], [("User", "b")])
    assert df.select(cleaning.digest().alias("h")).first().h == "a0d1893fb6d50a1e0445c83029337eb5"
    assert sorted(r.pos for r in cleaning.exact_dedup(df).collect()) == [0, 1, 3]
    assert cleaning.exact_dedup(df).columns == df.columns


def test_quality(spark):
    df = spark.createDataFrame([("Hello, world! This is fine.", 0.9, 250.0), ("Hello, world! This is fine.", 0.0, float("inf")), (" ", 0.9, 1.0)], "t string, c double, p double")
    f = quality.features(F.col("t"), F.col("c"), F.col("p"))
    first = df.select(*[F.round(c, 6).alias(n) for n, c in f.items()], F.round(quality.logistic(f), 6).alias("s"), quality.fallback(F.col("c"), F.col("p")).alias("fb")).collect()
    assert tuple(first[0])[:6] == (0.9, 0.25, 1.0, 0.36, 0.111111, 0.75186) and abs(first[0].fb - 0.675) < 1e-12
    assert first[1].s == 0.465942
    kept = quality.quality_filter(df, F.col("t"), F.lit("en"), F.col("c"), F.col("p"), targets=["en"]).collect()
    assert [r.c for r in kept] == [0.9]
    assert quality.quality_filter(df, F.col("t"), scorer=None).count() == 3
