"""A small writer of lossless WebP, which makes the media columns that ``webp`` reads.

It can use every feature of the format that the reader knows, chosen by the caller, rather than
choosing what makes the smallest file.
"""

from __future__ import annotations

import heapq
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import webp as W


class Out:
    def __init__(self):
        self.value, self.size, self.done = 0, 0, bytearray()

    def write(self, value: int, n: int) -> None:
        self.value |= value << self.size
        self.size += n
        while self.size >= 8:
            self.done.append(self.value & 255)
            self.value >>= 8
            self.size -= 8

    def bytes(self) -> bytes:
        return bytes(self.done) + (bytes([self.value]) if self.size else b"")


def code_lengths(counts: Counter, size: int, most: int = 15) -> list[int]:
    """Lengths of a prefix code of at most ``most`` bits."""
    lengths = [0] * size
    counts = dict(counts) or {0: 1}
    if len(counts) == 1:
        lengths[next(iter(counts))] = 1
        return lengths
    while True:
        heap = [(n, i, (s,)) for i, (s, n) in enumerate(sorted(counts.items()))]
        depth = dict.fromkeys(counts, 0)
        heapq.heapify(heap)
        serial = len(heap)
        while len(heap) > 1:
            a, _, x = heapq.heappop(heap)
            b, _, y = heapq.heappop(heap)
            for s in x + y:
                depth[s] += 1
            heapq.heappush(heap, (a + b, serial, x + y))
            serial += 1
        if max(depth.values()) <= most:
            for s, d in depth.items():
                lengths[s] = d
            return lengths
        counts = {s: n // 2 + 1 for s, n in counts.items()}


def codes_of(lengths: list[int]) -> dict[int, tuple[int, int]]:
    """Bits (turned, as they are written) and length of each symbol's code."""
    used = sorted((n, s) for s, n in enumerate(lengths) if n)
    if len(used) == 1:
        return {used[0][1]: (0, 0)}
    out, code, last = {}, 0, 0
    for n, s in used:
        code <<= n - last
        last = n
        out[s] = (int(f"{code:0{n}b}"[::-1], 2), n)
        code += 1
    return out


def write_code(out: Out, lengths: list[int]) -> dict[int, tuple[int, int]]:
    used = [s for s, n in enumerate(lengths) if n]
    if len(used) <= 2 and max(used) < 256 and all(lengths[s] == 1 for s in used):
        out.write(1, 1)
        out.write(len(used) - 1, 1)
        wide = used[0] > 1
        out.write(wide, 1)
        out.write(used[0], 8 if wide else 1)
        if len(used) == 2:
            out.write(used[1], 8)
        return codes_of(lengths)
    out.write(0, 1)
    steps, at, end = [], 0, max(used) + 1
    while at < end:
        run = 1
        while at + run < end and lengths[at + run] == lengths[at]:
            run += 1
        if lengths[at] == 0 and run >= 3:
            run = min(run, 138)
            steps.append((17, run - 3, 3) if run <= 10 else (18, run - 11, 7))
            at += run
        elif run >= 4:
            more = min(run - 1, 6)
            steps += [(lengths[at], 0, 0), (16, more - 3, 2)]
            at += more + 1
        else:
            steps.append((lengths[at], 0, 0))
            at += 1
    of = code_lengths(Counter(s for s, _, _ in steps), 19, 7)
    n = max(i for i, s in enumerate(W.CODE_ORDER) if of[s]) + 1
    out.write(max(n, 4) - 4, 4)
    for s in W.CODE_ORDER[: max(n, 4)]:
        out.write(of[s], 3)
    if len(steps) >= 2 and end < len(lengths):
        out.write(1, 1)
        bits = max(2, (len(steps) - 2).bit_length() + ((len(steps) - 2).bit_length() & 1))
        out.write((bits - 2) // 2, 3)
        out.write(len(steps) - 2, bits)
    else:  # a code whose steps don't reach the end has two steps or more
        out.write(0, 1)
    codes = codes_of(of)
    for s, extra, width in steps:
        out.write(*codes[s])
        out.write(extra, width)
    return codes_of(lengths)


def _prefix(value: int) -> tuple[int, int, int]:
    """Symbol, extra bits and their number for a length or distance."""
    if value <= 4:
        return value - 1, 0, 0
    v = value - 1
    top = v.bit_length() - 1
    second = v >> (top - 1) & 1
    return 2 * top + second, v & ((1 << (top - 1)) - 1), top - 1


def _steps(pixels: list[int], width: int, cache_bits: int, back: bool) -> list[tuple]:
    """Literals, cache hits and copies that make up an image."""
    out, n, at = [], len(pixels), 0
    cache, places = [0] * (1 << cache_bits), {}
    near = {x + y * width: i + 1 for i, (x, y) in reversed(list(enumerate(W.NEAR))) if x + y * width >= 1}
    while at < n:
        length, distance = 0, 0
        if back and at:
            for d in {1, width, at - places.get(tuple(pixels[at : at + 2]), at)}:
                if 0 < d <= at:
                    m = 0
                    while at + m < n and m < 4096 and pixels[at + m] == pixels[at + m - d]:
                        m += 1
                    if m > length:
                        length, distance = m, d
        p = pixels[at]
        if length >= 3:
            out.append(("copy", length, near.get(distance, distance + 120)))
        elif cache_bits and cache[(p * W.CACHE_FACTOR & 0xFFFFFFFF) >> (32 - cache_bits)] == p:
            out.append(("cache", (p * W.CACHE_FACTOR & 0xFFFFFFFF) >> (32 - cache_bits), 0))
            length = 1
        else:
            out.append(("pixel", p, 0))
            length = 1
        for i in range(at, at + length):
            places[tuple(pixels[i : i + 2])] = i
            if cache_bits:
                cache[(pixels[i] * W.CACHE_FACTOR & 0xFFFFFFFF) >> (32 - cache_bits)] = pixels[i]
        at += length
    return out


def write_image(out: Out, pixels: list[int], width: int, main: bool, cache_bits: int = 0, back: bool = False, tile_bits: int = 0) -> None:
    out.write(bool(cache_bits), 1)
    if cache_bits:
        out.write(cache_bits, 4)
    steps = _steps(pixels, width, cache_bits, back)
    groups, tiles = 1, 0
    if main:
        out.write(bool(tile_bits), 1)
        if tile_bits:  # tiles take two sets of codes in turn
            side = lambda n: (n + (1 << tile_bits) - 1) >> tile_bits
            tiles, high = side(width), side(len(pixels) // width)
            out.write(tile_bits - 2, 3)
            which = [i % 2 for i in range(tiles * high)]
            groups = max(which) + 1
            write_image(out, [0xFF000000 | w << 8 for w in which], tiles, False)
    used, at = [], 0
    counts = [[Counter() for _ in range(5)] for _ in range(groups)]
    for kind, a, b in steps:
        g = ((at // width >> tile_bits) * tiles + (at % width >> tile_bits)) % 2 if groups > 1 else 0
        if kind == "pixel":
            symbols = [(0, a >> 8 & 255, 0, 0), (1, a >> 16 & 255, 0, 0), (2, a & 255, 0, 0), (3, a >> 24, 0, 0)]
        elif kind == "copy":
            symbols = [(0, 256 + (x := _prefix(a))[0], x[1], x[2]), (4, *_prefix(b))]
        else:
            symbols = [(0, 256 + W.LENGTH_CODES + a, 0, 0)]
        for c, s, _, _ in symbols:
            counts[g][c][s] += 1
        used += [(g, *x) for x in symbols]
        at += a if kind == "copy" else 1
    sizes = (256 + W.LENGTH_CODES + (1 << cache_bits if cache_bits else 0), 256, 256, 256, W.DISTANCE_CODES)
    codes = [[write_code(out, code_lengths(c, s)) for c, s in zip(of, sizes)] for of in counts]
    for g, c, s, extra, n in used:
        out.write(*codes[g][c][s])
        out.write(extra, n)


def _subtract(a: int, b: int) -> int:
    return ((a | 0x00FF00FF) - (b & 0xFF00FF00) & 0xFF00FF00) | ((a | 0xFF00FF00) - (b & 0x00FF00FF) & 0x00FF00FF)


def encode_image(pixels: list[int], width: int, transforms: tuple[int, ...] = (), cache_bits: int = 0, back: bool = False, tile_bits: int = 0, modes: tuple[int, ...] = (11,), factors: tuple[int, int, int] = (5, 250, 17)) -> bytes:
    """A WebP file. ``modes``: predictors, by turns over the tiles; ``factors``: green to red, green to blue, red to blue."""
    height = len(pixels) // width
    out = Out()
    out.write(0x2F, 8)
    out.write(width - 1, 14)
    out.write(height - 1, 14)
    out.write(1, 1)
    out.write(0, 3)
    size, side = 2, lambda n: (n + 3) >> 2
    inner, w = list(pixels), width
    for kind in transforms:
        out.write(1, 1)
        out.write(kind, 2)
        if kind == W.PREDICTOR:
            tiles = [0xFF000000 | modes[i % len(modes)] << 8 for i in range(side(w) * side(height))]
            out.write(size - 2, 3)
            write_image(out, tiles, side(w), False)
            old, inner = inner, []
            for i, p in enumerate(old):
                y, x = divmod(i, w)
                if y == 0:
                    guess = old[i - 1] if x else 0xFF000000
                elif x == 0:
                    guess = old[i - w]
                else:
                    guess = W.predicted(tiles[(y >> size) * side(w) + (x >> size)] >> 8 & 15, old[i - 1], old[i - w], old[i - w + 1], old[i - w - 1])
                inner.append(_subtract(p, guess))
        elif kind == W.CROSS_COLOUR:
            g2r, g2b, r2b = factors
            tiles = [0xFF000000 | r2b << 16 | g2b << 8 | g2r] * (side(w) * side(height))
            out.write(size - 2, 3)
            write_image(out, tiles, side(w), False)
            s = lambda x: (x & 255) - ((x & 128) << 1)
            inner = [p & 0xFF00FF00 | ((p >> 16) - (s(g2r) * s(p >> 8) >> 5) & 255) << 16 | (p - (s(g2b) * s(p >> 8) >> 5) - (s(r2b) * s(p >> 16) >> 5) & 255) for p in inner]
        elif kind == W.SUBTRACT_GREEN:
            inner = [p & 0xFF00FF00 | ((p >> 16) - (p >> 8) & 255) << 16 | (p - (p >> 8) & 255) for p in inner]
        else:
            colours = sorted(set(inner))
            if len(colours) > 256:
                raise ValueError("too many colours for a palette")
            out.write(len(colours) - 1, 8)
            write_image(out, [colours[0], *(_subtract(b, a) for a, b in zip(colours, colours[1:]))], len(colours), False)
            at, per = {c: i for i, c in enumerate(colours)}, W.palette_bits(len(colours))
            each, packed = 8 >> per, []
            for y in range(height):
                row = [at[p] for p in inner[y * w : (y + 1) * w]]
                packed += [0xFF000000 | sum(v << each * j for j, v in enumerate(row[x : x + (1 << per)])) << 8 for x in range(0, w, 1 << per)]
            inner, w = packed, (w + (1 << per) - 1) >> per
    out.write(0, 1)
    write_image(out, inner, w, True, cache_bits, back, tile_bits)
    body = out.bytes()
    body = b"VP8L" + len(body).to_bytes(4, "little") + body + bytes(len(body) & 1)
    return b"RIFF" + (len(body) + 4).to_bytes(4, "little") + b"WEBP" + body


#: Features by turns, so that every one is met.
STYLES = (
    {"transforms": (W.PREDICTOR, W.CROSS_COLOUR, W.SUBTRACT_GREEN), "modes": tuple(range(14))},
    {"transforms": (W.SUBTRACT_GREEN,), "cache_bits": 4, "back": True},
    {"transforms": (W.PALETTE,), "back": True},
    {"transforms": (W.PREDICTOR,), "modes": (12, 13, 5, 10), "tile_bits": 2},
)


def vector_images(table: DataFrame, id_column: str = "vec_id", column: str = "embedding", width: int = 8) -> DataFrame:
    """(id_column, image): the bits of each vector's floats as the pixels of an image ``width`` wide.

    Missing pixels of the last row are 0. A null or empty vector, or one with a null, has a null image."""

    def each(batches):
        for batch in batches:
            images = []
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not v or None in v:
                    images.append(None)
                    continue
                pixels = np.array(v, np.float32).view(np.uint32).tolist()
                pixels += [0] * (-len(pixels) % width)
                images.append(encode_image(pixels, width, **STYLES[(i or 0) % len(STYLES)]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(images, pa.binary())], ["id", "image"])

    narrow = table.select(F.col(id_column).cast("long").alias("id"), F.col(column).cast("array<float>").alias("v"))
    return narrow.mapInArrow(each, "id long, image binary").withColumnRenamed("id", id_column)
