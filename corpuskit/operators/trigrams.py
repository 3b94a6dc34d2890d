"""Character n-grams of up to three characters as numbers of 64 bits, 21 for each character."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Characters that are worked on at once, or one text; n-grams that are counted before they are passed on.
PIECE, HELD = 1 << 19, 1 << 20
WIDE = np.uint64(21)
LONGEST = 3


def pieces(texts: list[str | None]) -> Iterator[tuple[list[int], str, np.ndarray]]:
    """(places, the texts there as one, length of each); nulls are left out."""
    at, n = [], []
    size = 0
    for i, t in enumerate(texts):
        if t is not None:
            at.append(i)
            n.append(len(t))
            size += len(t)
            if size >= PIECE:
                yield at, "".join([texts[j] for j in at]), np.array(n, np.int64)
                at, n, size = [], [], 0
    if at:
        yield at, "".join([texts[j] for j in at]), np.array(n, np.int64)


def codes(text: str, lengths: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(n-grams, how many each text has), without those that reach into the next text."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    many = np.maximum(lengths - n + 1, 0)
    if len(points) < n:
        return np.zeros(0, np.uint64), many
    out = points[: len(points) - n + 1].copy()
    for k in range(1, n):
        out = (out << WIDE) | points[k : k + len(out)]
    first = np.cumsum(lengths) - lengths
    inside = np.zeros(len(points) + 1, np.int32)
    np.add.at(inside, first[many > 0], 1)
    np.add.at(inside, (first + many)[many > 0], -1)
    return out[np.cumsum(inside)[: len(out)] > 0], many


def strings(found: np.ndarray, n: int) -> list[str]:
    points = np.stack([(found >> (WIDE * np.uint64(n - 1 - k))) & np.uint64((1 << 21) - 1) for k in range(n)], axis=1)
    text = points.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
    return [text[i : i + n] for i in range(0, len(text), n)]


class Table:
    """Rows of numbers by n-gram; n-grams that it lacks have the last one, of zeros."""

    def __init__(self, found: np.ndarray, values: np.ndarray, n: int):
        order = np.argsort(found)
        self.found, self.n = found[order], n
        self.values = np.vstack([values[order], np.zeros((1, values.shape[1]))])
        # N-grams of ASCII characters are looked up at once.
        points = [(self.found >> (WIDE * np.uint64(k))) & np.uint64((1 << 21) - 1) for k in range(n)]
        low = np.logical_and.reduce([p < 128 for p in points])
        self.low = np.full(128**n, len(self.found), np.int32)
        self.low[self._low(self.found[low])] = np.flatnonzero(low)

    def _low(self, x: np.ndarray) -> np.ndarray:
        return sum(((x >> (WIDE * np.uint64(k))) & np.uint64(127)) << np.uint64(7 * k) for k in range(self.n)).astype(np.int64)

    def rows(self, x: np.ndarray) -> np.ndarray:
        high = np.uint64(sum(((1 << 21) - 128) << 21 * k for k in range(self.n)))
        out = self.low[self._low(x)]
        other = np.flatnonzero(x & high)
        if len(other):
            y = x[other]
            place = np.minimum(np.searchsorted(self.found, y), max(len(self.found) - 1, 0))
            out[other] = np.where(self.found[place] == y, place, len(self.found)) if len(self.found) else 0
        return out
