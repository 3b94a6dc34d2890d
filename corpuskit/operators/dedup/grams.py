"""MD5 of texts' character n-grams, for many n-grams at once.

Nothing is kept from one piece of texts to the next, so that a worker's memory doesn't grow with what it has met."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql.types import LongType, StructField, StructType

from ...functions import text as T

#: Texts that are held at once.
TEXTS = 256
#: Characters whose n-grams are worked out at once, or one text; n-grams that are hashed at once.
PIECE, BLOCK = 1 << 17, 4096
_MULT = np.uint64(0x9E3779B97F4A7C15)
_SINES = [int(abs(math.sin(i + 1)) * 2**32) & 0xFFFFFFFF for i in range(64)]
_TURNS = [(7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)]
_START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hashes(points: np.ndarray, n: int) -> np.ndarray:
    """Of all runs of n characters, in 64 bits."""
    h = np.zeros(max(0, len(points) - n + 1), np.uint64)
    for k in range(n):
        h = _mix(h * _MULT + points[k : k + len(h)] + np.uint64(1))
    return h


def counts(df: DataFrame, id_column: str, text: Column, n: int) -> DataFrame:
    """(id_column, n, n_distinct): how many n-grams the normalised text has, with repeats and without. A null has none."""

    def each(batches):
        for batch in batches:
            for part in (batch.slice(at, TEXTS) for at in range(0, batch.num_rows, TEXTS)):
                kinds = []
                for t in part.column(1).to_pylist():
                    h = hashes(np.frombuffer((t or "").encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64), n)
                    h.sort()
                    kinds.append((len(h), int((h[1:] != h[:-1]).sum()) + 1 if len(h) else 0))
                all_of, distinct = zip(*kinds)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(all_of, pa.int64()), pa.array(distinct, pa.int64())], [id_column, "n", "n_distinct"])

    narrow = df.select(id_column, T.dedup_text(text).alias("t"))
    return narrow.mapInArrow(each, StructType([df.schema[id_column], StructField("n", LongType()), StructField("n_distinct", LongType())]))


def md5(message: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Digests (rows of 16 bytes) of messages of up to 55 bytes, each a row that is filled up with zeros to a multiple of four."""
    padded = np.zeros((len(message), -(-(message.shape[1] + 1) // 4) * 4), np.uint8)
    padded[:, : message.shape[1]] = message
    padded[np.arange(len(message)), sizes] = 0x80
    parts = np.ascontiguousarray(padded.view("<u4").T)
    bits = (sizes * 8).astype(np.uint32)
    a, b, c, d = (np.full(len(message), x, np.uint32) for x in _START)
    for i in range(64):
        if i < 16:
            f, g = d ^ (b & (c ^ d)), i
        elif i < 32:
            f, g = c ^ (d & (b ^ c)), (5 * i + 1) % 16
        elif i < 48:
            f, g = b ^ c ^ d, (3 * i + 5) % 16
        else:
            f, g = c ^ (b | ~d), 7 * i % 16
        f += a
        f += np.uint32(_SINES[i])
        if g < len(parts):
            f += parts[g]
        elif g == 14:
            f += bits
        turn = _TURNS[i // 16][i % 4]
        high = f << np.uint32(turn)
        f >>= np.uint32(32 - turn)
        f |= high
        f += b
        a, d, c, b = d, c, b, f
    return np.stack([x + np.uint32(y) for x, y in zip((a, b, c, d), _START)], axis=1).astype("<u4").view(np.uint8)


class Digests:
    """MD5 of the n-grams of texts; those are told apart by a 64-bit hash of their characters."""

    def __init__(self, n: int):
        self.n = n

    def of(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Digests (rows of 16 bytes) of the distinct n-grams of a text, and how often each occurs."""
        return next(self.of_all([text]))

    def of_all(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray] | None]:
        """The same for each of some texts; none for a null."""
        held, size = [], 0
        for t in texts:
            held.append(t)
            size += len(t or "")
            if size >= PIECE:
                yield from self._piece(held)
                held, size = [], 0
        if held:
            yield from self._piece(held)

    def _piece(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray] | None]:
        n = self.n
        joined = "".join([t for t in texts if t])
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        if len(points) >= n:
            _, first, kinds = np.unique(hashes(points, n), return_index=True, return_inverse=True)
            rows = self._digests(joined, points, first)
        at = 0
        for t in texts:
            many = len(t or "") - n + 1
            if t is None:
                yield None
            elif many <= 0:
                yield np.zeros((0, 16), np.uint8), np.zeros(0, np.int64)
            else:
                found, times = np.unique(kinds[at : at + many], return_counts=True)
                yield rows[found], times
            at += len(t or "")

    def _digests(self, joined: str, points: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Of the n-grams that start at ``first``; some reach from one text into the next and aren't used."""
        n = self.n
        if 4 * n > 55:
            return np.frombuffer(b"".join(hashlib.md5(joined[i : i + n].encode("utf-8", "surrogatepass")).digest() for i in first.tolist()), np.uint8).reshape(-1, 16)
        data = np.frombuffer(joined.encode("utf-8", "surrogatepass") + bytes(4 * n), np.uint8)
        width = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
        starts = np.concatenate([[0], np.cumsum(width)])
        out = np.empty((len(first), 16), np.uint8)
        for lo in range(0, len(first), BLOCK):
            i = first[lo : lo + BLOCK]
            sizes = starts[i + n] - starts[i]
            place = np.arange(int(sizes.max()))
            message = data[starts[i][:, None] + place] * (place < sizes[:, None])
            out[lo : lo + BLOCK] = md5(message.astype(np.uint8), sizes)
        return out
