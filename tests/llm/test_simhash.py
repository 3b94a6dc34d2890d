"""SimHash groups against all pairs."""

import hashlib
import random
import re

import numpy as np

from corpuskit.llm import simhash_dedup as S

from .conftest import prose


def fingerprint(text):
    words = set(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower()))
    bits = [np.unpackbits(np.frombuffer(hashlib.md5(w.encode()).digest(), np.uint8)) for w in words]
    return np.packbits(np.sum(bits, axis=0) * 2 > len(words)) if words else None


def rows():
    rng = random.Random(2)
    out = []
    for g in range(60):
        words = prose(g, rng.randrange(60, 200))
        for c in range(rng.randrange(1, 5)):
            mine = list(words)
            for _ in range(c * 2):
                mine[rng.randrange(len(mine))] = prose(rng.randrange(10**6), 1)[0]
            out.append((len(out), " ".join(mine)))
    return out


def test_all_pairs(spark):
    data = rows()
    prints = np.stack([fingerprint(t) for _, t in data])
    apart = np.bitwise_count(prints[:, None] ^ prints[None]).sum(axis=2)
    want = {(i, j) for i in range(len(data)) for j in range(i) if apart[i, j] <= S.RADIUS}
    assert len(want) > 50
    docs = spark.createDataFrame(data, "doc_id long, text string")
    nodes = S.fingerprints(docs).withColumnRenamed("doc_id", "node")
    got = [tuple(r) for r in S.near_pairs(nodes).collect()]
    assert len(got) == len(set(got))  # each pair once
    got = {(max(p), min(p)) for p in got}
    assert got <= want and len(got) >= 0.98 * len(want)
    # As if there were 10**8 documents: other choices, the same recall.
    wide = {(max(p), min(p)) for p in (tuple(r) for r in S.near_pairs(nodes, chosen=S.choices(10**8)).collect())}
    assert wide <= want and len(wide) >= 0.98 * len(want)
    # All buckets of more than two rows cut into blocks: the same pairs, each once.
    small = [tuple(r) for r in S.near_pairs(nodes, block=2).collect()]
    assert len(small) == len(set(small)) and {(max(p), min(p)) for p in small} == got


def flipped(a, rng, many):
    """The same fingerprints with ``many`` bits of each turned."""
    flips = np.zeros((len(a), 128), np.uint8)
    for row in flips:
        row[rng.choice(128, many, replace=False)] = 1
    return a ^ np.packbits(flips, axis=1)


def test_no_pair_at_the_radius_is_lost(spark):
    """Pairs at the full radius, of which sampling loses some."""
    rng = np.random.default_rng(4)
    a = rng.integers(0, 256, (3000, 16), dtype=np.uint8)
    fp = np.concatenate([a, flipped(a, rng, S.RADIUS), flipped(a, rng, S.RADIUS + 1)])
    hi, lo = fp.view(">i8").astype(np.int64).T
    nodes = spark.createDataFrame(list(zip(range(len(fp)), hi.tolist(), lo.tolist())), "node long, hi long, lo long")
    want = {(i, i + 3000) for i in range(3000)}
    for block in (None, 500):
        got = [tuple(sorted(r)) for r in S.near_pairs(nodes, block=block).collect()]
        assert len(got) == len(set(got)) and set(got) == want
    sampled = [tuple(sorted(r)) for r in S.near_pairs(nodes, recall=S.RECALL).collect()]
    assert set(sampled) <= want and len(sampled) >= 0.98 * len(want)
    cut = [tuple(sorted(r)) for r in S.near_pairs(nodes, chosen=S.choices(6000), block=2).collect()]
    assert len(cut) == len(sampled) and set(cut) == set(sampled)


def test_parts_meet_all_pairs():
    """Any parts, and comparing all where rows are much alike, give what comparing all pairs gives."""
    rng = np.random.default_rng(6)
    centres = rng.integers(0, 256, (40, 16), dtype=np.uint8)
    spread = np.concatenate([flipped(np.repeat(centres, 5, axis=0), rng, k) for k in (5, 9, 13)])
    alike = spread.copy()
    alike[:, 3:15] = 7  # only four bytes differ
    assert all(sum(r + 1 for *_, r in S.parts(radius, many)) == radius + 1 for radius in (0, 3, 18, 40) for many in (6, 7, 32))
    for fp in (spread, alike):
        hi, lo = fp.view(">u8").astype(np.uint64).T.copy()
        apart = np.bitwise_count(fp[:, None] ^ fp[None]).sum(axis=2)
        for radius in (0, 3, S.RADIUS, 26):
            rows, some = S.Rows(hi, lo), S.Rows(hi[:250], lo[:250])
            for of in (None, S.parts(radius, 7), S.parts(radius, 8), S.parts(radius, 16)):
                got = [p for i, j in S.near_between(rows, rows, radius, of) for p in zip(i.tolist(), j.tolist())]
                got = [(max(p), min(p)) for p in got]
                assert len(got) == len(set(got)) and set(got) == {(i, j) for i in range(600) for j in range(i) if apart[i, j] <= radius}
                got = [p for i, j in S.near_between(some, rows, radius, of) for p in zip(i.tolist(), j.tolist())]
                assert len(got) == len(set(got)) and set(got) == set(zip(*(x.tolist() for x in np.nonzero(apart[:250] <= radius))))


def test_recall_and_growth():
    """At the full radius nearly all pairs are met; random candidates grow clearly below the square."""
    rng = np.random.default_rng(3)
    a = rng.integers(0, 256, (4000, 16), dtype=np.uint8)
    flips = np.zeros((4000, 128), np.uint8)
    for row in flips:
        row[rng.choice(128, S.RADIUS, replace=False)] = 1
    b = np.packbits(np.unpackbits(a, axis=1) ^ flips, axis=1)
    for n in (1000, 65_000, 10**8):
        keys = S.Keys(S.choices(n))
        assert ((keys.of(a) == keys.of(b)).any(axis=1)).mean() > 0.98

    def candidates(n):
        key = np.sort(S.Keys(S.choices(n)).of(rng.integers(0, 256, (n, 16), dtype=np.uint8)).ravel())
        _, many = np.unique(key, return_counts=True)
        return int((many * (many - 1) // 2).sum())

    few, more = (candidates(n) for n in (1 << 19, 1 << 20))
    assert more < 2.9 * few
    chosen = S.choices(10**8)
    assert len(chosen) * 10**8 / 2 / 2 ** chosen.shape[1] < 450  # of each fingerprint


def test_one_bucket_that_holds_a_third():
    """A hot bucket of distinct fingerprints that differ in few chosen bits."""
    keys = S.Keys(np.arange(24).reshape(2, 12))
    fp = np.zeros((300, 16), np.uint8)
    fp[:, 14:] = np.random.default_rng(0).integers(0, 256, (300, 2))
    key = keys.of(fp)[:, 0]
    src, dst = S.near_in_buckets(key, fp, np.arange(300), np.zeros(300, np.int8), 5, keys)
    apart = np.bitwise_count(fp[:, None] ^ fp[None]).sum(axis=2)
    assert {(max(p), min(p)) for p in zip(src.tolist(), dst.tolist())} == {(i, j) for i in range(300) for j in range(i) if apart[i, j] <= 5}


def test_pivots_discard_no_near_pair():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 256, (500, 16), dtype=np.uint8)
    b = a ^ (rng.random((500, 128)) < 0.1).astype(np.uint8).reshape(500, 16, 8).dot(1 << np.arange(8)).astype(np.uint8)
    apart = np.bitwise_count(a ^ b).sum(axis=1)
    seen = np.abs(S.pivot_distances(a).astype(int) - S.pivot_distances(b)).max(axis=1)
    assert (seen <= apart).all()
    r = S.references()
    assert np.array_equal(r @ r.T, 128 * np.eye(128))


def test_groups(spark):
    text = " ".join(prose(7, 90))
    docs = spark.createDataFrame([(5, text), (3, text.upper()), (9, text + " more"), (1, "quite another text"), (2, "")], "doc_id long, text string")
    assert {tuple(r) for r in S.near_duplicates(docs).collect()} == {(3, 3, 3, True), (5, 3, 3, False), (9, 3, 3, False)}
    assert {r.doc_id for r in S.deduplicated(docs).collect()} == {1, 2, 3}


def test_messy(spark, messy, nothing):
    found = {r.doc_id: r.group_id for r in S.near_duplicates(messy).collect()}
    assert found == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4}
    left = S.deduplicated(messy)
    assert left.columns == messy.columns
    assert sorted(r.doc_id or -1 for r in left.collect()) == [-1, -1, 1, 4, 6, 7, 8, 9, 9, 10]
    assert S.near_duplicates(nothing).count() == S.deduplicated(nothing).count() == 0
