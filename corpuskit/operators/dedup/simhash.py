"""SimHash over character n-grams, pairs within a Hamming distance."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ...functions import text as T
from ..lineage import cut
from .assemble import tied
from .grams import Digests

#: Texts that are held at once.
TEXTS = 256


def fingerprint_of(text: str, digests: Digests) -> int | None:
    return _print(*digests.of(text))


def _print(rows: np.ndarray, times: np.ndarray) -> int | None:
    if not len(rows):
        return None
    votes = np.zeros(64, np.float32)
    for at in range(0, len(rows), 4096):
        votes += times[at : at + 4096].astype(np.float32) @ np.unpackbits(rows[at : at + 4096, 8:], axis=1).astype(np.float32)
    return int(np.packbits(votes.astype(np.float64) * 2 > times.sum()).view(">i8")[0])


def fingerprints(df: DataFrame, id_column: str, text: Column, n: int = 5) -> DataFrame:
    """(id, fp, short): 64 bits, each set if most n-grams (with repeats) have it set in the low half of their
    MD5. Texts without n-grams have no fingerprint but stand in ``short``, unless they are empty. One pass over the
    texts, without a row for each n-gram."""

    def each(batches):
        digests = Digests(n)
        for batch in batches:
            for part in (batch.slice(at, TEXTS) for at in range(0, batch.num_rows, TEXTS)):
                texts = part.column(1).to_pylist()
                fps = [None if d is None else _print(*d) for d in digests.of_all(texts)]
                short = [t if f is None and t else None for t, f in zip(texts, fps)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fps, pa.int64()), pa.array(short, pa.string())], ["id", "fp", "short"])

    narrow = df.select(F.col(id_column).cast("long").alias("id"), T.dedup_text(text).alias("text"))
    return narrow.mapInArrow(each, "id long, fp long, short string")


def near_pairs(prints: DataFrame, distance: int = 3) -> DataFrame:
    """(src, dst, distance) with at most ``distance`` bits apart. Of distance + 1 blocks of bits one is equal in
    such a pair, so that joining on blocks loses none. Equal fingerprints are tied to the first of them, texts too
    short for a fingerprint only to equal ones; both at distance 0."""
    prints = cut(prints)
    nodes, copies = tied(prints, "fp")
    _, equal = tied(prints, "short")
    cuts = [64 * i // (distance + 1) for i in range(distance + 2)]
    block = F.array(*[F.shiftrightunsigned("fp", a).bitwiseAND(F.lit((1 << (b - a)) - 1)) for a, b in zip(cuts, cuts[1:])])
    keyed = nodes.select("id", "fp", F.posexplode(block).alias("at", "key"))
    a, b = (keyed.select(F.col("id").alias(x), F.col("fp").alias(f"{x}_fp"), "at", "key") for x in ("src", "dst"))
    apart = F.bit_count(F.col("src_fp").bitwiseXOR(F.col("dst_fp")))
    near = a.join(b, ["at", "key"]).where("src < dst").select("src", "dst", apart.alias("distance")).where(F.col("distance") <= distance).distinct()
    return near.unionByName(copies.unionByName(equal).withColumn("distance", F.lit(0)))
