"""Sources, the corpus build as a whole, sinks and streams."""

import json

from pyspark.sql import functions as F

from corpuskit.functions.unicode import repair
from corpuskit.plans import build, config
from corpuskit.plans.catalogue import ORACLE_SQL, QUERIES, run_to_end
from corpuskit.sources import files, shapes, sinks, social
from corpuskit.streaming import dedup


def test_files(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.json").write_text('[{"x":1},{"x":2}]')
    (tmp_path / "sub" / "b.json").write_text('{"x":3}')
    (tmp_path / "c.json").write_text("{broken")
    (tmp_path / "d.JSONL").write_text('{"x":4}\n\nbroken\n{"x":5}\n')
    x = F.try_variant_get("item", "$.x", "int").alias("x")
    assert sorted(r.x for r in files.read_formatted(spark, str(tmp_path)).select(x).collect()) == [1, 2, 3]
    assert sorted(r.x for r in files.read_generic(spark, str(tmp_path)).select(x).collect()) == [1, 2, 4, 5]


def test_shapes(spark):
    items = [
        {"conversation_id": "c1", "metadata": {"k": 1}, "conversation": [dict(content="a", role="User")]},
        {"messages": [{"sender": "client", "text": "a"}, {"foo": 1}, {"role": "x", "content": "b", "do_train": False}]},
        {"dialog": ["a", {"speaker": "bot", "text": "b"}, "c"]},
        {"text": "q", "user": "u", "answer": "a"},
        {"prompt": "q", "assistant": "a"},
        {"prompt": 5, "assistant": "a"},
        {"messages": []},
    ]
    rows = spark.createDataFrame([("f", i, json.dumps(x)) for i, x in enumerate(items)], "source_file string, ordinal int, j string").withColumn("item", F.parse_json("j"))
    out = {r.pos.ordinal: [tuple(m) for m in r.conversation] for r in shapes.standardise(rows).collect()}
    pair = [("User", "q", False), ("Assistant", "a", True)]
    assert out == {0: [("User", "a", True)], 1: [("User", "a", True), ("x", "b", False)], 2: [("User", "a", False), ("Assistant", "b", True), ("User", "c", False)], 3: pair, 4: pair}


def test_social_export(spark, tmp_path):
    folder = tmp_path / "inbox" / "ann_1"
    folder.mkdir(parents=True)
    wrong = "é你".encode().decode("latin-1")
    thread = {"thread_path": "inbox/ann_1", "participants": [{"name": "Ann"}, {"name": "Shop"}], "messages": [{"sender_name": "Shop", "content": wrong, "timestamp_ms": 2000}, {"sender_name": "Ann", "content": "hi", "timestamp_ms": 1000}, {"sender_name": "Ann", "timestamp_ms": 3000}]}
    (folder / "message_1.json").write_text(json.dumps(thread))
    (folder / "message_2.json").write_text("{broken")
    out = social.transform_threads(social.read_threads(spark, str(tmp_path / "inbox")), "Shop")
    row = out.first()
    assert out.count() == 1 and row.source_folder == "ann_1" and row.account_owner == "Shop"
    assert [(m.role, m.content) for m in row.conversation] == [("User", "hi"), ("Assistant", "é你")]
    assert (row.last_message_at - row.created_at).total_seconds() == 2
    assert tuple(social.summary(out).first()) == (1, 2, 2)
    assert repair("café") == "café"
    got = spark.createDataFrame([(r"a你 &#20320;",)], "t string").select(social.unescape(F.col("t"))).first()[0]
    assert got == "a你 你"


def test_config(tmp_path):
    path = tmp_path / "c.yaml"
    path.write_text("cleaning:\n  max_length: 5\ndata_processing:\n  filter_words:\n")
    conf = config.load(str(path), {"mode": "testing"})
    assert conf["cleaning"]["max_length"] == 5 and conf["cleaning"]["exact_dedup_enabled"] and conf["mode"] == "testing"
    assert conf["data_processing"]["filter_words"] == [] and config.DEFAULTS["cleaning"]["max_length"] == 32768
    config.save(conf, str(tmp_path / "d.yaml"))
    assert config.load(str(tmp_path / "d.yaml")) == conf


def test_whole_build(spark, tmp_path):
    say = lambda q, a: {"conversation": [dict(content=q, role="User"), dict(content=a, role="Assistant")]}
    long = "where is the shop and when does it open on sunday mornings "
    items = [say(long, "here  &amp; <b>now</b> see https://x.y/z"), say(long, "here  &amp; <b>now</b> see https://x.y/z"), say(long + "please", "it opens at nine"), say("what do you sell", "tea and cups, all kinds of them")]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(json.dumps(items))
    over = {"platform": {"type": None, "input_path": str(tmp_path / "in")}, "formatting": {"replace_urls": True}, "output": {"conversation_path": str(tmp_path / "conv"), "qa_path": str(tmp_path / "qa")}}
    conf = config.load(None, over)
    build.run(spark, conf)
    conversations = spark.read.json(str(tmp_path / "conv")).collect()
    assert len(conversations) == 3
    assert "here & now see [URL]" in {m.content for r in conversations for m in r.conversation}
    assert {r.question for r in spark.read.json(str(tmp_path / "qa")).collect()} >= {"what do you sell"}


def test_array_sink(spark, tmp_path):
    df = spark.range(3)
    assert sinks.write_array(df, str(tmp_path / "x" / "a.json")) == 3
    assert json.loads((tmp_path / "x" / "a.json").read_text()) == [{"id": 0}, {"id": 1}, {"id": 2}]


def test_stream(spark, tmp_path):
    rows = spark.createDataFrame([(1, "Hi  There"), (2, "hi there"), (3, "x")], "s int, text string").selectExpr("timestamp_seconds(s) AS ts", "text")
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    assert sorted(r.text.lower().replace("  ", " ") for r in run_to_end(dedup.first_by_text(stream, "text", "ts")).collect()) == ["hi there", "x"]


def test_catalogue():
    assert set(ORACLE_SQL) <= set(QUERIES) and len(QUERIES) >= 55
