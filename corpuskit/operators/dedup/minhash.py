"""MinHash with banded locality-sensitive hashing."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ...functions import text as T
from ..lineage import cut
from .assemble import tied
from .grams import Digests

M = (1 << 32) - 1
#: Texts that are held at once.
TEXTS = 256


def permutations(n: int = 128, seed: int = 42) -> list[tuple[int, int]]:
    """The (a, b) of each hash (a * h + b) mod 2**32 - 1."""
    rng = random.Random(seed)
    return [(rng.randint(1, M), rng.randint(0, M)) for _ in range(n)]


def _mod(x: np.ndarray) -> np.ndarray:
    low, half = np.uint64(M), np.uint64(32)
    x = (x >> half) + (x & low)
    x = (x >> half) + (x & low)
    return np.where(x >= low, x - low, x)


def least(a: np.ndarray, b: np.ndarray, h: np.ndarray) -> np.ndarray:
    """The least (a * h + b) mod 2**32 - 1 over h, for each (a, b).

    The halves of a product are added with the carry put in at the end: that is the remainder, but that
    2**32 - 1 stands for 0. With one more added, 0 and 1 both do."""
    out, step = np.full(len(a), M, np.uint32), 256  # blocks that stay in cache
    products, sums, carry = (np.empty((len(a), step), t) for t in (np.uint64, np.uint32, bool))
    for lo in range(0, len(h), step):
        n = min(step, len(h) - lo)
        x, total, over = products[:, :n], sums[:, :n], carry[:, :n]
        np.multiply(a[:, None], h[lo : lo + step], out=x)
        x += b[:, None]
        halves = products.view(np.uint32)[:, : 2 * n]
        low = halves[:, 0::2]
        np.add(low, halves[:, 1::2], out=total)
        np.less(total, low, out=over)
        total += over
        total += np.uint32(1)
        np.minimum(out, total.min(axis=1), out=out)
    return np.maximum(out, 1) - 1


def signature_of(text: str, a: np.ndarray, b: np.ndarray, digests: Digests) -> np.ndarray | None:
    return _signed(digests.of(text)[0], a, b)


def _signed(rows: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray | None:
    if not len(rows):
        return None
    # 2**32 is 1 modulo M: a digest modulo M is the sum of its four words.
    return least(a, b, _mod(rows.view(">u4").astype(np.uint64).sum(axis=1)))


def signatures(df: DataFrame, id_column: str, text: Column, n: int = 5, hashes: int = 128, seed: int = 42) -> DataFrame:
    """(id, text, signature) on normalised text; the signature is null where the text has no n-gram."""
    a, b = (np.array(x, np.uint64) for x in zip(*permutations(hashes, seed)))

    def each(batches):
        digests = Digests(n)
        for batch in batches:
            for part in (batch.slice(at, TEXTS) for at in range(0, batch.num_rows, TEXTS)):
                texts = part.column(1).to_pylist()
                rows = [None if d is None else _signed(d[0], a, b) for d in digests.of_all(texts)]
                short = [t if r is None else None for t, r in zip(texts, rows)]
                some = [r for r in rows if r is not None]
                ends = np.cumsum([0, *(0 if r is None else len(r) for r in rows)]).astype(np.int32)
                flat = pa.array(np.concatenate(some).astype(np.int64) if some else np.zeros(0, np.int64))
                null = pa.array([r is None for r in rows])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(short, pa.string()), pa.ListArray.from_arrays(pa.array(ends), flat, mask=null)], ["id", "short", "signature"])

    narrow = df.select(F.col(id_column).cast("long").alias("id"), T.dedup_text(text).alias("text"))
    return narrow.mapInArrow(each, "id long, short string, signature array<long>")


def bands(signed: DataFrame, rows: int = 8, hashes: int = 128) -> DataFrame:
    """(id, band, part): the signature cut into bands; a last shorter one takes what is left."""
    parts = F.array(*[F.slice("signature", i + 1, min(rows, hashes - i)) for i in range(0, hashes, rows)])
    return signed.where("signature is not null").select("id", "signature", F.posexplode(parts).alias("band", "part"))


def similar_pairs(signed: DataFrame, threshold: float = 0.8, rows: int = 8, hashes: int = 128) -> DataFrame:
    """(src, dst, similarity) of pairs that share a band and agree in ``threshold`` of their hashes.

    Rows of equal signatures are one node, tied to the first of them, so that many copies make no
    quadratic number of pairs; texts too short for a signature are tied to equal ones."""
    signed = cut(signed.withColumn("short", F.when(F.col("short") != "", F.col("short"))))
    nodes, copies = tied(signed, "signature")
    _, equal = tied(signed, "short")
    nodes = cut(nodes)
    keyed = bands(nodes, rows, hashes).withColumn("key", F.xxhash64("band", "part")).select("id", "key")
    a, b = keyed.select(F.col("id").alias("src"), "key"), keyed.select(F.col("id").alias("dst"), "key")
    candidates = a.join(b, "key").where("src < dst").select("src", "dst").distinct()
    sig = nodes.select("id", "signature")
    with_both = candidates.join(sig.select(F.col("id").alias("src"), F.col("signature").alias("s")), "src").join(sig.select(F.col("id").alias("dst"), F.col("signature").alias("t")), "dst")
    same = F.aggregate(F.zip_with("s", "t", lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, x: n + x)
    near = with_both.select("src", "dst", (same / hashes).alias("similarity")).where(F.col("similarity") >= threshold)
    return near.unionByName(copies.unionByName(equal).withColumn("similarity", F.lit(1.0)))


def alike(x: np.ndarray | None, y: np.ndarray | None, threshold: float = 0.8) -> bool:
    """Whether two signatures agree in ``threshold`` of their hashes; texts without one are like none."""
    return x is not None and y is not None and float((x == y).mean()) >= threshold
