"""Vectorised text kernels over Arrow string buffers.

A batch of texts is handled as one flat byte array with row offsets, so that
splitting, hashing and grouping are numpy operations over all rows at once.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 1 << 19
U64 = np.uint64
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}
#: Of glibc; other C libraries have none.
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)

MULT_BYTES = 0x9E3779B97F4A7C15
MULT_A = 0xD6E8FEB86659FD93
MULT_B = 0xA0761D6478BD642F

#: Bytes that separate words: tab, newline, vertical tab, form feed, return, space.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[9, 10, 11, 12, 13, 32]] = False
#: Letters and digits; every byte of a non-ASCII character counts as a letter.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True


def text_column(batch: pa.RecordBatch, name: str) -> pa.LargeStringArray:
    """The column as large strings, nulls as empty strings."""
    col = batch.column(batch.schema.get_field_index(name))
    return pc.fill_null(col.cast(pa.large_string()), "")


def flat(texts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the offsets of each row in them."""
    _, offsets, data = texts.buffers()
    n = len(texts)
    if n == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offs = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + n + 1]
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return buf[offs[0] : offs[-1]], offs - offs[0]


def pieces(texts: pa.LargeStringArray, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes each; a longer text is a range of its own."""
    _, offs = flat(texts)
    at, n = 0, len(texts)
    while at < n:
        to = max(at + 1, int(np.searchsorted(offs, offs[at] + limit, side="right")) - 1)
        yield at, min(to, n)
        at = min(to, n)


def give_back() -> None:
    """Returns freed memory to the system. Else a worker keeps what its earlier tasks, of whatever stage, once needed."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def lean(each: Callable) -> Callable:
    """The same function of batches, for workers that are used again: freed memory is given back before and after."""

    def run(batches):
        give_back()
        try:
            yield from each(batches)
        finally:
            give_back()

    return run


def powers(mult: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """mult**i and its inverse modulo 2**64 for i < n; kept for later calls."""
    have = _POWERS.get(mult)
    if have is None or len(have[0]) < n:
        size = 1 << max(16, int(n).bit_length())
        made = []
        for m in (mult, pow(mult, -1, 1 << 64)):
            p = np.full(size, m, U64)
            p[0] = 1
            made.append(np.multiply.accumulate(p))
        have = _POWERS[mult] = (made[0], made[1])
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64 bits."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


class Prefix:
    """Hashes of any range of a sequence of numbers, from running sums."""

    def __init__(self, values: np.ndarray, mult: int):
        self.mult = mult
        self.sums = np.zeros(len(values) + 1, U64)
        p, _ = powers(mult, len(values) + 1)
        np.cumsum(p[: len(values)] * values, out=self.sums[1:])

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        _, inv = powers(self.mult, len(self.sums))
        return mix((self.sums[end] - self.sums[start]) * inv[start])


class Words:
    """Words of some texts: byte ranges, hashes and the first word of each row."""

    def __init__(self, buf: np.ndarray, offs: np.ndarray, table: np.ndarray, hashes: bool = True):
        n = len(buf)
        inside = table[buf]
        before = np.zeros(n + 1, bool)
        before[1:] = inside
        after = np.zeros(n + 1, bool)
        after[:n] = inside
        before[offs] = False
        after[offs] = False
        self.start = np.flatnonzero(inside & ~before[:n])
        self.end = np.flatnonzero(inside & ~after[1:]) + 1
        self.first = np.searchsorted(self.start, offs)
        self.buf = buf
        self.hash = Prefix(buf.astype(U64) + U64(1), MULT_BYTES).ranges(self.start, self.end) if hashes else None

    def row_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    out, have = values, 1
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def longs(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64, copy=False))
