"""Both searches for repeated passages against brute force."""

import random
import re
from collections import defaultdict

import pytest

from corpuskit.llm import substring_dedup as S
from corpuskit.llm import suffix_dedup as P

from .conftest import prose


def brute(rows, window):
    at = defaultdict(list)
    for i, text in rows:
        if i is None or text is None:
            continue
        words = re.findall(r"[^\t\n\x0b\f\r ]+", text)
        for p in range(len(words) - window + 1):
            at[tuple(words[p : p + window])].append((i, p))
    hit = defaultdict(set)
    for places in at.values():
        if len(places) > 1:
            for i, p in places:
                hit[i].add(p)
    out = set()
    for i, places in hit.items():
        start = end = None
        for p in sorted(places):
            if end is None or p > end:
                if end is not None:
                    out.add((i, start, end))
                start = p
            end = p + window
        out.add((i, start, end))
    return out


def rows():
    rng = random.Random(4)
    shared = [prose(100 + k, 70) for k in range(3)]
    out = []
    for i in range(40):
        words = prose(i, rng.randrange(5, 300))
        for s in rng.sample(shared, rng.randrange(0, 3)):
            cut = rng.randrange(0, 40)
            k = rng.randrange(0, len(words))
            words[k:k] = s[cut:]
        out.append((i, "  ".join(words) if i % 2 else "\n".join(words)))
    return [*out, (40, out[3][1]), (41, out[3][1]), (41, out[5][1])]


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_brute_force(spark, limit):
    docs = spark.createDataFrame(rows(), "doc_id long, text string")
    want = brute(rows(), 50)
    assert len(want) > 10
    got = S.repeated_passages(docs, limit=limit).select("doc_id", "start_word", "end_word")
    assert {tuple(r) for r in got.collect()} == want
    got = P.repeated_passages(docs, limit=limit)
    assert {tuple(r) for r in got.collect()} == want


def test_short_windows(spark):
    docs = spark.createDataFrame(rows(), "doc_id long, text string")
    want = brute(rows(), 8)
    assert {tuple(r)[:3] for r in S.repeated_passages(docs, window=8, gram=4).collect()} == want
    assert {tuple(r) for r in P.repeated_passages(docs, threshold=8, base=3, gram=4).collect()} == want
    assert P.offsets(3, 8) == [3, 2] and P.offsets(13, 50) == [13, 24]


@pytest.mark.parametrize("base", [1, 3, 5])
def test_ranks_by_doubling(spark, base):
    """From single words on: equal ranks for equal passages, and for no others."""
    docs = spark.createDataFrame(rows(), "doc_id long, text string")
    words = defaultdict(list)
    for i, text in rows():
        words[i].append(re.findall(r"[^\t\n\x0b\f\r ]+", text))
    by_rank, by_words = defaultdict(set), defaultdict(set)
    for r in P.repeated_positions(docs.where("doc_id <> 41"), threshold=8, base=base, gram=4).collect():
        by_rank[r.rank].add((r.doc_id, r.pos))
    for i, texts in words.items():
        for w in texts if i != 41 else []:
            for p in range(len(w) - 7):
                by_words[tuple(w[p : p + 8])].add((i, p))
    assert sorted(map(sorted, by_rank.values())) == sorted(sorted(v) for v in by_words.values() if len(v) > 1)
    assert P.offsets(1, 8) == [1, 2, 4] and P.offsets(P.BASE, P.THRESHOLD) == [10, 20, 10]


def test_later(spark):
    text = " ".join(prose(9, 60))
    docs = spark.createDataFrame([(5, text), (3, text), (8, text)], "doc_id long, text string")
    assert {(r.doc_id, r.repeated_windows, r.later_windows) for r in S.repeated_passages(docs).collect()} == {(3, 11, 0), (5, 11, 11), (8, 11, 11)}


def test_messy(spark, messy, nothing):
    want = brute([tuple(r) for r in messy.select("doc_id", "text").collect()], 50)
    assert {tuple(r)[:3] for r in S.repeated_passages(messy).collect()} == want
    assert {tuple(r) for r in P.repeated_passages(messy).collect()} == want
    assert S.repeated_passages(nothing).count() == P.repeated_passages(nothing).count() == 0
