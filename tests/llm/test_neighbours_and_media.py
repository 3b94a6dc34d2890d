"""HNSW against all pairs; lossless WebP round trips and files of other makers."""

import base64
import random

import numpy as np
import pytest

from corpuskit.llm import hnsw, webp, webp_write
from corpuskit.llm.catalogue import QUERIES


def test_recall(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(1500, 24)).astype(np.float32)
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    found = hnsw.neighbours(table, shards=4, every=1).collect()
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    scores = unit @ unit.T
    np.fill_diagonal(scores, -2)
    true = np.argsort(-scores, axis=1)[:, :10]
    got = {}
    for r in found:
        got.setdefault(r.vec_id, {})[r.rank] = r.neighbour_id
        assert abs(r.score - scores[r.vec_id, r.neighbour_id]) < 1e-5
    assert all(sorted(g) == list(range(1, 11)) for g in got.values())
    assert np.mean([len(set(true[i]) & set(got[i].values())) / 10 for i in range(1500)]) > 0.95


def test_vectors_that_are_left_out(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [2.0, 0.1]), (4, None), (5, []), (6, [0.0, 0.0]), (7, [1.0, None]), (8, [nan, 1.0]), (9, [inf, 1.0]), (10, [1.0, 2.0, 3.0]), (None, [1.0, 1.0])]
    table = spark.createDataFrame([(*r, 0, 0) for r in rows], "vec_id long, embedding array<double>, id int, v int")
    out = [tuple(r) for r in hnsw.neighbours(table, every=1).orderBy("vec_id", "rank").collect()]
    # The least vector of id 2 is [0, 1].
    assert [(a, b, r) for a, b, _, r in out] == [(1, 3, 1), (1, 2, 2), (2, 3, 1), (2, 1, 2), (3, 1, 1), (3, 2, 2)]
    assert hnsw.neighbours(table.limit(0)).count() == 0
    assert hnsw.neighbours(table.where("vec_id = 1"), every=1).count() == 0


def exact(vectors: np.ndarray, queries: np.ndarray, k: int) -> np.ndarray:
    """The k nearest others of some rows by comparing all."""
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    scores = unit[queries] @ unit.T
    scores[np.arange(len(queries)), queries] = -2
    return np.argsort(-scores, axis=1)[:, :k]


def test_query_against_all_pairs(spark):
    """The registered query: every hundredth vector against all."""
    d = "/root/testdata/sf0.1"
    rows = sorted(tuple(r) for r in spark.read.parquet(f"{d}/embeddings.parquet").select("vec_id", "embedding").collect())
    ids, vectors = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], np.float32)
    asked = np.flatnonzero(ids % 100 == 0)
    got = {}
    for r in QUERIES["op4_hnsw_neighbours"](spark, d).collect():
        got.setdefault(r.vec_id, set()).add(r.neighbour_id)
    assert set(got) == set(ids[asked].tolist())
    true = exact(vectors, asked, hnsw.K)
    assert np.mean([len(set(ids[t].tolist()) & got[ids[a]]) / hnsw.K for a, t in zip(asked, true)]) > 0.95


def test_layers_and_narrow_beams():
    x = np.random.default_rng(2).normal(size=(3000, 16)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    g = hnsw.Graph.build(np.arange(3000), x)
    assert [len(layer.nodes) for layer in g.layers] == sorted((len(layer.nodes) for layer in g.layers), reverse=True) and len(g.layers) > 2
    true = exact(x, np.arange(200), 4)
    for beam, least in ((1, 0.3), (3, 0.3), (5, 0.4), (8, 0.5), (64, 0.97)):
        node, score = g.search(x[:200], 5, beam)
        assert (np.diff(score, axis=1) <= 0).all() and (node[:, 0] == np.arange(200)).mean() > least
        assert np.mean([len(set(t) & set(n)) / 4 for t, n in zip(true.tolist(), node.tolist())]) > least
    assert hnsw.shard_count(0) == 1 and hnsw.shard_count(10**9) == 3815 and hnsw.shard_count(51_282) == 8


def test_files_of_other_makers():
    for data, pixel in (("UklGRhoAAABXRUJQVlA4TA0AAAAvAAAAEAcQERGIiP4HAA==", 0), ("UklGRh4AAABXRUJQVlA4TBEAAAAvAAAAAAfQ//73v/+BiOh/AAA=", 0xFFFFFFFF)):
        width, height, pixels = webp.decode_image(base64.b64decode(data))
        assert (width, height, pixels.tolist()) == (1, 1, [pixel])


def test_round_trips():
    rng = random.Random(3)
    for _ in range(150):
        w, h, few = rng.choice([1, 2, 3, 5, 8, 16, 33]), rng.choice([1, 2, 4, 7, 20]), rng.random() < 0.5
        colours = [rng.getrandbits(32) for _ in range(rng.choice([1, 2, 3, 9, 30]))]
        pixels = [rng.choice(colours) if few else rng.getrandbits(32) for _ in range(w * h)]
        transforms = tuple(rng.sample([0, 1, 2], rng.randrange(4)))
        if few and rng.random() < 0.5:
            transforms = (3, *transforms[:1])
        data = webp_write.encode_image(pixels, w, transforms, rng.choice([0, 1, 4, 10]), rng.random() < 0.6, rng.choice([0, 0, 2, 3]), tuple(rng.sample(range(14), 3)), tuple(rng.getrandbits(8) for _ in range(3)))
        width, height, got = webp.decode_image(data)
        assert (width, height, got.tolist()) == (w, h, pixels)


def plain_image(width: int, height: int, pixel: int) -> bytes:
    """A lossless image of one colour: five codes of one symbol each, no bits for the pixels."""
    bits, n = 0, 0

    def put(x: int, k: int) -> None:
        nonlocal bits, n
        bits, n = bits | x << n, n + k

    for x, k in ((0x2F, 8), (width - 1, 14), (height - 1, 14), (0, 1), (0, 3), (0, 1), (0, 1), (0, 1)):
        put(x, k)
    for s in (pixel >> 8 & 255, pixel >> 16 & 255, pixel & 255, pixel >> 24, 0):
        for x, k in ((1, 1), (0, 1), (1, 1), (s, 8)):
            put(x, k)
    body = bits.to_bytes(-(-n // 8), "little")
    body = b"VP8L" + len(body).to_bytes(4, "little") + body + b"\0" * (len(body) & 1)
    return b"RIFF" + (len(body) + 4).to_bytes(4, "little") + b"WEBP" + body


def test_large_images(spark):
    """Over 2**26 pixels, which nothing stops but a bound that is asked for."""
    data = plain_image(8200, 8200, 0x80102030)
    width, height, pixels = webp.decode_image(data)
    assert (width, height, len(pixels)) == (8200, 8200, 8200**2) and (pixels == 0x80102030).all()
    with pytest.raises(webp.Broken, match="most_pixels"):
        webp.decode_image(data, 1 << 26)
    table = spark.createDataFrame([(1, bytearray(plain_image(3000, 2000, 7))), (2, bytearray(plain_image(2000, 2100, 9)))], "vec_id long, image binary")
    out = webp.decode(table, "vec_id").selectExpr("vec_id", "width", "height", "size(pixels) n", "pixels[0] a", "array_min(pixels) b").collect()
    assert sorted(map(tuple, out)) == [(1, 3000, 2000, 6_000_000, 7, 7), (2, 2000, 2100, 4_200_000, 9, 9)]
    with pytest.raises(ValueError, match="id column"):
        webp.decode(table.withColumnRenamed("vec_id", "width"), "width")


def test_wide_rows():
    """Runs that are worked out in numpy, for each predictor mode."""
    rng = random.Random(9)
    w, h = 150, 6
    pixels = [rng.getrandbits(32) for _ in range(w * h)]
    for mode in range(14):
        data = webp_write.encode_image(pixels, w, (0,), 0, False, 0, (mode, mode, mode), (1, 2, 3))
        assert webp.decode_image(data)[2].tolist() == pixels


def test_broken_files_are_told():
    rng = random.Random(5)
    good = webp_write.encode_image([rng.getrandbits(32) for _ in range(64)], 8, (0, 1, 2), 4, True)
    for _ in range(300):
        bad = bytearray(good)
        for _ in range(rng.randrange(1, 4)):
            bad[rng.randrange(20, len(bad))] = rng.getrandbits(8)
        try:
            webp.decode_image(bytes(bad[: rng.randrange(10, len(bad) + 1)]))
        except (webp.Broken, IndexError):
            pass
    with pytest.raises(webp.Broken, match="lossy"):
        webp.decode_image(b"RIFF\x10\0\0\0WEBPVP8 \0\0\0\0")


def test_column(spark):
    rows = [(1, [1.5, -2.0, 3.25]), (1, [1.5, -2.0, 3.25]), (2, None), (3, []), (4, [1.0, None]), (None, [0.5])]
    table = spark.createDataFrame([(*r, 7) for r in rows], "vec_id long, embedding array<float>, width int")
    images = webp_write.vector_images(table)
    out = webp.decode(images.unionByName(spark.createDataFrame([(8, bytearray(b"")), (9, bytearray(b"no image"))], "vec_id long, image binary")), "vec_id").collect()
    by = {}
    for r in out:
        by.setdefault(r.vec_id, []).append(r)
    assert len(by[1]) == 2 and all(np.array(r.pixels[:3], np.int32).view(np.float32).tolist() == [1.5, -2.0, 3.25] and len(r.pixels) == 8 for r in by[1])
    assert all(by[i][0][1:] == (None, None, None, None) for i in (2, 3, 4))
    assert by[8][0].error and by[9][0].error and by[8][0].pixels is None and len(by[None]) == 1
    assert webp.decode(images.limit(0), "vec_id").count() == 0
