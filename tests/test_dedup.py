"""Clusters, survivors and the methods that find pairs."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from corpuskit.operators.dedup import assemble, blocks, exact, grams, lcs, minhash, semantic, simhash, tfidf
from corpuskit.operators.dedup.grams import Digests
from corpuskit.operators.dedup.registry import deduplicate, similar
from corpuskit.operators.graph import connected_components

FRANCE, GERMANY = "What is the capital of France?", "What is the capital of Germany?"


def docs(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "id long, text string")


def test_components(spark):
    edges = spark.createDataFrame([(1, 2), (3, 2), (5, 6), (7, 7)], "src long, dst long")
    assert {tuple(r) for r in connected_components(edges).collect()} == {(1, 1), (2, 1), (3, 1), (5, 5), (6, 5)}
    assert connected_components(edges.limit(0)).count() == 0
    rng = random.Random(1)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(400, 460)]
    root = {x: x for p in pairs for x in p}
    for _ in range(len(root)):
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
    want = {x: r for x, r in root.items() if any(x in p and p[0] != p[1] for p in pairs)}
    assert {r.id: r.comp for r in connected_components(spark.createDataFrame(pairs, "src long, dst long")).collect()} == want


def test_survivors(spark):
    df = docs(spark, "x" * 10, "y" * 30, "z" * 30, "w", "v")
    pairs = spark.createDataFrame([(0, 1), (1, 2)], "src long, dst long")
    assert sorted(r.id for r in assemble.survivors(df, pairs, "id", F.length("text")).collect()) == [1, 3, 4]
    assert {tuple(r) for r in assemble.removed(df, pairs, "id", F.length("text")).collect()} == {(0, 1), (2, 1)}


def test_minhash(spark):
    assert minhash.permutations(3) == [(2746317214, 478163327), (3184935164, 1181241943), (958682847, 2342331444)]
    s = minhash.signatures(docs(spark, FRANCE, FRANCE.upper().replace(" ", "  "), GERMANY, "hi", "hi", "yes"), "id", F.col("text"))
    rows = {r.id: r.signature for r in s.collect()}
    assert rows[0][:4] == [264448721, 44113458, 103907205, 45550826] and rows[1] == rows[0] and rows[3] is None
    assert sum(a == b for a, b in zip(rows[0], rows[2])) / 128 == 0.546875
    assert {tuple(r) for r in minhash.similar_pairs(s).collect()} == {(0, 1, 1.0), (3, 4, 1.0)}


def test_digests_of_many_texts():
    rng = random.Random(1)
    for n in (1, 5, 13, 14):
        texts = ["".join(rng.choice("abc é日\U0001f600") for _ in range(rng.randrange(60))) for _ in range(30)] + [None, ""]
        digests = Digests(n)
        for t, found in zip(texts, digests.of_all(texts), strict=True):
            if t is None:
                assert found is None
                continue
            want = {}
            for k in range(len(t) - n + 1):
                h = hashlib.md5(t[k : k + n].encode()).digest()
                want[h] = want.get(h, 0) + 1
            assert {r.tobytes(): int(c) for r, c in zip(*found)} == want
        assert vars(digests) == {"n": n}  # nothing is kept


def test_counts_of_ngrams(spark):
    texts = ["aaaaaaa", "abcde", "abcd", "", None, "日本語日本語日本語", " A  b c\U0001f600d "]
    got = {r.id: (r.n, r.n_distinct) for r in grams.counts(docs(spark, *texts), "id", F.col("text"), 5).collect()}
    assert got == {0: (3, 1), 1: (1, 1), 2: (0, 0), 3: (0, 0), 4: (0, 0), 5: (5, 3), 6: (3, 3)}


def test_simhash(spark):
    rows = simhash.fingerprints(docs(spark, FRANCE, GERMANY, "hi", ""), "id", F.col("text")).collect()
    assert {r.id: r.fp and r.fp & (1 << 64) - 1 for r in rows} == {0: 0x865C9141425A2388, 1: 0x929190C5437AB343, 2: None, 3: None}
    assert {r.id: r.short for r in rows} == {0: None, 1: None, 2: "hi", 3: None}
    rng = random.Random(3)
    base = [rng.getrandbits(63) for _ in range(50)]
    values = base + [b ^ sum(1 << k for k in rng.sample(range(63), rng.randrange(6))) for b in base]
    prints = spark.createDataFrame([*((i, v, None) for i, v in enumerate(values)), (200, None, "hi"), (201, None, "ok"), (202, None, "hi")], "id long, fp long, short string")
    found = simhash.near_pairs(prints).collect()
    assert all(r.distance == (values[r.src] ^ values[r.dst]).bit_count() for r in found if r.src < 200)
    got = {tuple(sorted((r.src, r.dst))) for r in found}
    assert (200, 202) in got
    assert got - {(200, 202)} == {(i, j) for i in range(100) for j in range(i + 1, 100) if (values[i] ^ values[j]).bit_count() <= 3}


def test_lcs(spark):
    shared = "abcdefghij klmnopqrst uvwxyzab"
    assert len(shared) == 30
    pad = lambda c, n: c + "".join(chr(0x4E00 + ord(c) * 50 + i) for i in range(n - 1))
    df = docs(spark, shared + pad("1", 20), pad("2", 60) + shared, shared + pad("3", 40), "short")
    got = {(r.src, r.dst): (r.common, r.shorter) for r in lcs.similar_pairs(df, "id", F.col("text")).collect()}
    assert got == {(0, 1): (30, 50), (0, 2): (30, 50)}


def naive_common(a, b):
    best, row = 0, [0] * (len(b) + 1)
    for x in a:
        new = [0] * (len(b) + 1)
        for j, y in enumerate(b):
            if x == y:
                new[j + 1] = row[j] + 1
                best = max(best, new[j + 1])
        row = new
    return best


def test_lcs_against_all_pairs(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcd") for _ in range(rng.randrange(1, 5)))
    parts = [" ".join(word() for _ in range(rng.randrange(4, 60))) for _ in range(12)]
    texts = [" ".join([*(word() for _ in range(rng.randrange(0, 30))), rng.choice(parts), *(word() for _ in range(rng.randrange(0, 30)))]) for _ in range(60)]
    assert all(lcs.longest_common(a, b) == naive_common(a, b) for a in texts[:6] for b in texts[:20])
    want = {(i, j) for i in range(60) for j in range(i + 1, 60) if (n := naive_common(texts[i], texts[j])) >= 20 and n >= 0.5 * min(len(texts[i]), len(texts[j]))}
    got = {(r.src, r.dst) for r in lcs.similar_pairs(docs(spark, *texts), "id", F.col("text")).collect()}
    assert got == want and len(want) > 20


def test_lcs_looks_at_few_other_pairs(spark):
    rng = random.Random(9)
    parts = ["".join(rng.choice("abcdefghijkl") for _ in range(11)) for _ in range(30)]  # common to many, but too short
    texts = [" ".join(rng.choice(parts) + "".join(rng.choice("mnopqrst") for _ in range(rng.randrange(4, 9))) for _ in range(rng.randrange(2, 5))) for _ in range(300)]
    texts += [t[: len(t) * 2 // 3] + "".join(rng.choice("uvwxyz") for _ in range(20)) for t in texts[:40]]
    met = {tuple(r) for r in lcs.candidates(docs(spark, *texts).withColumnRenamed("text", "t")).collect()}
    assert len(met) < 400
    common = {(i, j): lcs.common_of(texts[i], texts[j], 20) for i in range(340) for j in range(i + 1, 340)}
    assert all(n == naive_common(texts[i], texts[j]) for (i, j), n in common.items() if n)
    want = {p for p, n in common.items() if n and n >= 0.5 * min(len(texts[x]) for x in p)}
    assert want <= met and len(want) > 20
    for a, b in [("ab" * 300, "ab" * 250 + "c"), ("abcde" * 4, "xbcdey"), ("", "a")]:
        for need in (1, 4, 20, 501):
            n = naive_common(a, b)
            assert lcs.common_of(a, b, need) == (n if n >= need else 0)


def test_short_texts_are_no_duplicates(spark):
    df = docs(spark, "hi", "ok", "no", "this is a sentence of ordinary length, is it not", "ok", "")
    for method in ("minhash_lsh", "simhash"):
        assert sorted(r.id for r in deduplicate(df, "id", F.col("text"), method=method).collect()) == [0, 1, 2, 3, 5]
    assert similar("Hi ", "hi") and not similar("hi", "ok", "simhash") and not similar("", "")
    assert similar(FRANCE, FRANCE.upper()) and not similar(FRANCE, GERMANY) and not similar(FRANCE, GERMANY, "simhash")
    assert similar(FRANCE, GERMANY, "suffix_array") and not similar(FRANCE, "something else", "suffix_array")
    with pytest.raises(ValueError):
        similar("a", "b", "dbscan")


def test_texts_as_vectors(spark):
    df = docs(spark, FRANCE, "What IS the capital of France", "Tea and cups of all kinds, and where to buy them", "", "123")
    v = {r.id: r.v for r in semantic.text_vectors(df, "id", F.col("text")).collect()}
    assert set(v) == {0, 1, 2, 4} and all(abs(sum(x * x for x in w) - 1) < 1e-9 for w in v.values())
    assert sorted(r.id for r in deduplicate(df, "id", F.col("text"), method="semantic").collect()) == [0, 2, 3, 4]
    assert deduplicate(df, "id", F.col("text"), method="bertopic", topics=2).count() < 5
    odd = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.1]), (3, [1.0, 0.0, 0.0, 0.0]), (4, [1.0, None]), (5, [float("nan"), 1.0])], "id long, v array<double>")
    assert {(r.src, r.dst) for r in semantic.similar_pairs(odd, "id", F.col("v"), 0.5).collect()} == {(1, 2)}
    assert semantic.topics(odd.limit(0), "id", "v", 3).count() == 0


def test_cosine(spark):
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [0.0, 1.0]), (3, [0.0, 0.0]), (4, [1.0, 1.0]), (5, None)]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    for block in (2, 100):
        assert {(r.src, r.dst, round(r.cosine, 3)) for r in semantic.similar_pairs(df, "id", F.col("v"), 0.7, block).collect()} == {(0, 1, 1.0), (0, 4, 0.707), (1, 4, 0.707), (2, 4, 0.707)}


def test_cosine_by_groups(spark):
    rng = random.Random(4)
    v = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(120)]
    v += [[x * 2 for x in w] for w in v[:5]]
    unit = [[x / sum(y * y for y in w) ** 0.5 for x in w] for w in v]
    want = {(i, j) for i in range(125) for j in range(i + 1, 125) if sum(x * y for x, y in zip(unit[i], unit[j])) >= 0.7}
    df = spark.createDataFrame(list(enumerate(v)), "id long, v array<double>")
    for groups, rows in ((1, 1024), (2, 16), (5, 7)):
        got = [(r.src, r.dst) for r in semantic.similar_pairs(df, "id", F.col("v"), 0.7, rows, groups).collect()]
        assert set(got) == want and len(got) == len(want) > 50
    # What is moved is the rows times the groups.
    assert [blocks.groups_of(n) for n in (0, 3, 10_000, 100_000, 500_000, 1_000_000)] == [1, 3, 8, 8, 8, 16]


def test_tfidf_prefixes_lose_no_pair(spark):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(40)]
    texts = [" ".join(rng.choice(words) for _ in range(12)) for _ in range(40)]
    texts += [t + " " + rng.choice(words) for t in texts[:20]]
    w = tfidf.vectors(docs(spark, *texts), "id", F.col("text"))
    by = {}
    for r in w.collect():
        by.setdefault(r.id, {})[r.term] = r.w
    dot = lambda a, b: sum(x * by[b].get(t, 0) for t, x in by[a].items())
    want = {(i, j) for i in by for j in by if i < j and 1 - dot(i, j) <= 0.4}
    assert want and {(r.src, r.dst) for r in tfidf.near_pairs(w, 0.4).collect()} == want


def test_tfidf_by_groups(spark):
    rng = random.Random(12)
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(rng.choice(words) for _ in range(10)) for _ in range(60)]
    texts += [t + " " + rng.choice(words) for t in texts[:30]] + texts[:5] + ["", "only"]
    w = tfidf.vectors(docs(spark, *texts), "id", F.col("text"))
    pairs = {(r.src, r.dst) for r in tfidf.near_pairs(w).collect()}
    assert len(pairs) > 20
    clusters = {tuple(r) for r in connected_components(spark.createDataFrame(sorted(pairs), "src long, dst long")).collect()}
    for groups in (1, 3):
        assert {(r.src, r.dst) for r in tfidf.near_pairs(w, groups=groups).collect()} == pairs
        edges = [(r.src, r.dst) for r in tfidf.near_pairs(w, forest=True, groups=groups).collect()]
        assert {tuple(r) for r in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()} == clusters
    # A hundred copies have 4,950 pairs, but a tree of 99 edges.
    assert tfidf.near_pairs(tfidf.vectors(docs(spark, *["the same text again and again"] * 100), "id", F.col("text")), forest=True, groups=1).count() == 99


def test_density(spark):
    pairs = spark.createDataFrame([(0, 1), (1, 2), (2, 3), (5, 6)], "src long, dst long")
    assert {tuple(sorted(r)) for r in tfidf.core_edges(pairs, 3).collect()} == {(1, 2), (0, 1), (2, 3)}
    assert tfidf.core_edges(pairs, 2).count() == 4


def test_bloom_size():
    assert exact.bloom_size() == (143776, 10)


@pytest.mark.parametrize("method", ["minhash_lsh", "simhash", "suffix_array", "dbscan", "bloom_filter"])
def test_methods(spark, method):
    df = docs(spark, FRANCE + " " + GERMANY, (FRANCE + "  " + GERMANY).lower(), "something else altogether, of other words", "hi")
    assert sorted(r.id for r in deduplicate(df, "id", F.col("text"), method=method).collect())[-2:] == [2, 3]
    assert deduplicate(df, "id", F.col("text"), method=method).count() == 3
    assert deduplicate(df, "id", F.col("text"), method=method, enabled=False).count() == 4
    assert deduplicate(df.limit(0), "id", F.col("text"), method=method).count() == 0
