"""Byte-level BPE against an independent encoder; language identification on held-out rows."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpuskit.llm import arrays, bpe, language_id


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary.read(bpe.VOCABULARY)


def test_same_as_tiktoken(vocabulary):
    tiktoken = pytest.importorskip("tiktoken")
    pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    other = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=vocabulary.ranks, special_tokens={})
    rng = random.Random(1)
    bits = ["a", "b", " ", "  ", "\n", "'", "'s", "'re", "'ll", "1", "23", "é", "ß", "日本", "\t", "!", "?!", "don't", " 's", "🎉", "'v", "'ve", "r", "\r\n", "_", "²", " ", "the", " the", "xqzj"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(30))) for _ in range(5000)] + ["a" * 5000, " " * 999, "", "'", "ab" * 40000]
    column = pa.array(texts, pa.large_string())
    for a, b in arrays.pieces(column, 1 << 14):
        ids, rows = vocabulary.encode(*arrays.flat(column[a:b]))
        for i in range(a, b):
            assert ids[rows[i - a] : rows[i - a + 1]].tolist() == other.encode_ordinary(texts[i])


def test_perfect_hash(vocabulary):
    h = vocabulary.hash
    assert sorted(h.slot_of) == list(range(len(vocabulary.ranks)))
    assert np.array_equal(h.find(vocabulary.key_at), np.arange(h.n))
    with pytest.raises(ValueError):
        bpe.Vocabulary({b"a": 0})


def test_round_trip_and_messy(spark, messy, nothing):
    out = bpe.encode(messy)
    rows = out.collect()
    assert len(rows) == messy.count()
    assert all(r.round_trip for r in rows if r.n_tokens is not None)
    assert all(len(r.token_ids) == r.n_tokens for r in rows if r.n_tokens is not None)
    assert sum(r.token_ids is None for r in rows) == 2
    back = sorted((tuple(r) for r in bpe.decode(out).collect()), key=repr)
    assert back == sorted((tuple(r) for r in messy.select("doc_id", "text").collect()), key=repr)
    assert bpe.encode(nothing).count() == bpe.decode(bpe.encode(nothing)).count() == 0


def test_ids_outside_the_vocabulary(spark, vocabulary):
    a, b = vocabulary.ranks[b"a"], vocabulary.ranks[b"b"]
    rows = [(1, [a, 10**8, b]), (2, [-5]), (3, [a, None, b]), (4, []), (5, None), (None, [vocabulary.ranks[b"\xff"]])]
    out = bpe.decode(spark.createDataFrame(rows, "doc_id long, token_ids array<int>"))
    assert sorted(map(tuple, out.collect()), key=repr) == sorted([(1, "a\ufffdb"), (2, "\ufffd"), (3, "a\ufffdb"), (4, ""), (5, None), (None, "\ufffd")], key=repr)


def test_rare_language_is_learned(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    rare = docs.where("lang = 'de'").limit(4)
    sample = language_id.training_rows(docs.where("lang <> 'de'").unionByName(rare), 300)
    by = {k: sum(r.lang == k for r in sample) for k in {r.lang for r in sample}}
    assert by["de"] == 4 and len(sample) <= 300 and max(by.values()) <= 300 // len(by)


def test_language_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    seen = {(r.lang, r.text) for r in language_id.training_rows(docs, 300)}
    assert len(seen) <= 300
    out = {r.doc_id: r for r in language_id.identify(docs, train_rows=300).collect()}
    rest = [r for r in docs.collect() if (r.lang, r.text) not in seen]
    assert len(rest) > 500
    assert np.mean([out[r.doc_id].language == r.lang for r in rest]) > 0.95
    assert np.mean([out[r.doc_id].accepted for r in rest]) > 0.97


def test_language_rejects(spark, messy, nothing):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    net = language_id.train(docs)
    texts = pa.array(["0123 4567 -- 9999 1234,5678", "", "12 34", "абвгд ежзий клмно прсту фхцчш" * 3, docs.first().text], pa.large_string())
    which, sure = language_id.classify(net, texts)
    assert [net.labels[w] for w in which[:4]] == ["und"] * 4 and net.labels[which[4]] != "und"
    out = language_id.identify(messy).collect()
    assert len(out) == messy.count() and not any(r.accepted for r in out if r.doc_id in (6, 7, 8))
    kept = language_id.keep_identified(messy)
    assert kept.columns == messy.columns and kept.count() == sum(r.accepted for r in out)
    assert language_id.identify(nothing).count() == language_id.keep_identified(nothing).count() == 0
    assert not any(r.accepted for r in language_id.identify(messy.withColumn("lang", F.lit(None).cast("string"))).collect())


def test_windows_cover_texts():
    texts = ["x" * n for n in (0, 1, 255, 256, 257, 700)]
    x, row, size = language_id.windows(*arrays.flat(pa.array(texts, pa.large_string())))
    assert np.bincount(row, size, 6).tolist() == [len(t) for t in texts]
    assert (x != 0).sum(axis=1)[:1] == 1
