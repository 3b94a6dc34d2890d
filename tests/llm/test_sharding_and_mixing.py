"""Slots and shards; fixed-size samples."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpuskit.llm import mixing, sharding


def test_rebalancing_moves_only_what_it_must(spark, tmp_path):
    docs = spark.createDataFrame([(i, "x" * (i % 97)) for i in range(5000)], "doc_id long, text string")
    out = sharding.assign(docs, 512, 8, 10, str(tmp_path / "map")).collect()
    assert len(out) == 5000
    assert all(r.shard == r.shard_before or r.shard >= 8 for r in out)
    moved = sum(r.shard != r.shard_before for r in out) / 5000
    assert 0.1 < moved < 0.3  # a fifth is due
    sizes = Counter()
    for r in out:
        sizes[r.shard] += r.doc_id % 97
    assert len(sizes) == 10 and max(sizes.values()) < 1.3 * min(sizes.values())
    first, second = (sharding.load(spark, str(tmp_path / "map"), v) for v in (1, 2))
    assert first.count() == second.count() == 512
    with pytest.raises(Exception, match="exists"):
        sharding.store(first, str(tmp_path / "map"), 1)


def test_sharding_messy(spark, messy, nothing, tmp_path):
    out = sharding.assign(messy, path=str(tmp_path / "a")).collect()
    assert len(out) == messy.count()
    by = {}
    for r in out:
        if r.doc_id is not None:
            assert by.setdefault(r.doc_id, r.slot) == r.slot
    assert sharding.assign(nothing, path=str(tmp_path / "b")).count() == 0


def brute(docs, n):
    """Pareto order sampling in plain Python."""
    import hashlib

    sources = {}
    for i, s, t in docs:
        sources.setdefault(s, []).append((i, len(t)))
    out = {}
    for at, (s, rows) in enumerate(sorted(sources.items())):
        size, whole, ranks = n // len(sources) + (at < n % len(sources)), sum(w for _, w in rows), []
        left = size
        for i, w in rows:
            e = size * w / whole
            out[i] = int(e)
            left -= int(e)
            if e > int(e):
                u = (int(hashlib.md5((str(i) + mixing.SEED).encode()).hexdigest()[:13], 16) + 0.5) / 2**52
                p = e - int(e)
                ranks.append(((u / (1 - u)) / (p / (1 - p)), i))
        for _, i in sorted(ranks)[:left]:
            out[i] += 1
    return {i: c for i, c in out.items() if c}


def test_brute_force_and_size(spark):
    docs = [(i, f"s{min(i % 7, 3)}", "y" * (1 + i * 37 % 900)) for i in range(2000)]
    table = spark.createDataFrame(docs, "doc_id long, source string, text string")
    got = {r.doc_id: r.copies for r in mixing.sample(table).collect()}
    assert got == brute(docs, 2000)
    mixed = mixing.mix(table)
    assert mixed.columns == table.columns
    assert Counter(r.source for r in mixed.collect()) == {f"s{k}": 500 for k in range(4)}
    weighted = mixing.mix(table, {"s0": 3.0, "s1": 1.0}, fraction=0.5)
    assert Counter(r.source for r in weighted.collect()) == {"s0": 750, "s1": 250}


def test_size_is_fixed(spark):
    """Also where parts don't come out even, ids are shared, or a source has no text."""
    size = lambda df: sum(r.copies for r in df.collect())
    three = spark.createDataFrame([(i, f"s{i % 3}", "y" * (1 + i)) for i in range(100)], "doc_id long, source string, text string")
    assert size(mixing.sample(three)) == mixing.mix(three).count() == 100
    assert size(mixing.sample(three, {"s0": 1.0, "s1": 1.0, "s2": 5.0, "none": 9.0}, 0.33)) == 33
    shared = spark.createDataFrame([(7, "a", "y" * 10)] * 100 + [(i, "b", "y" * 10) for i in range(100)], "doc_id long, source string, text string")
    by = Counter()
    for r in mixing.sample(shared, fraction=0.5).collect():
        by[r.source] += r.copies
    assert by == {"a": 50, "b": 50}
    assert Counter(r.source for r in mixing.mix(shared.repartition(5), fraction=0.5).collect()) == {"a": 50, "b": 50}
    blank = shared.unionByName(spark.createDataFrame([(i, "c", "") for i in range(50)], shared.schema))
    assert Counter(r.source for r in mixing.mix(blank).collect()) == {"a": 125, "b": 125}
    assert mixing.mix(blank.where("source = 'c'")).count() == 0 and mixing.mix(shared, {}).count() == 0


def test_long_texts_weigh_in_full(spark):
    docs = [(1, "a", "y" * 10_000)] + [(i, "a", "y" * 100) for i in range(2, 102)]
    got = {r.doc_id: r.copies for r in mixing.sample(spark.createDataFrame(docs, "doc_id long, source string, text string")).collect()}
    assert got[1] in (50, 51) and sum(got.values()) == 101


def test_expected_copies(spark):
    docs = [(i, "a", "y" * (100 if i % 2 else 300)) for i in range(400)]
    table = spark.createDataFrame(docs, "doc_id long, source string, text string")
    drawn = Counter()
    for seed in "abcdefgh":
        for r in mixing.sample(table, fraction=0.25, seed=seed).collect():
            drawn[r.doc_id % 2] += r.copies
    assert sum(drawn.values()) == 800 and 550 < drawn[0] < 650  # three in four are long


def test_mixing_messy(spark, messy, nothing):
    out = mixing.sample(messy).collect()
    assert all(r.copies >= 1 for r in out) and not {6, 7} & {r.doc_id for r in out}
    mixed = mixing.mix(messy)
    assert mixed.columns == messy.columns and mixed.where(F.length("text") == 0).count() == 0
    assert mixed.count() == sum(r.copies for r in out)
    assert mixing.sample(nothing).count() == mixing.mix(nothing).count() == 0
