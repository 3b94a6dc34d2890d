"""Lossless WebP (VP8L) to pixel arrays.

Prefix codes, back-references and the colour cache are decoded; palette, subtract-green, cross-colour
and predictor transforms are inverted. Pixels come out as 32-bit numbers 0xAARRGGBB, row by row, in a
signed int column.

A null image gives null width, height, pixels and error. One that can't be decoded, among them an empty
one and a lossy one, gives null width, height and pixels, and what is wrong in ``error``; it never stops
a job. Rows are decoded each for itself, so that repeated rows and ids don't matter. Only the
id and the image are read; other columns are ignored, also if they are called id, width, height, pixels or
error. An empty table gives an empty result. An id column that has the name of an output is refused.

Whatever the format allows is decoded, 2**28 pixels at most; ``most_pixels`` may set a lower bound where
workers lack the memory: an image takes 4 bytes a pixel, up to three times at once.
"""

from __future__ import annotations

from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PREDICTOR, CROSS_COLOUR, SUBTRACT_GREEN, PALETTE = range(4)
LENGTH_CODES, DISTANCE_CODES = 24, 40
CODE_ORDER = (17, 18, 0, 1, 2, 3, 4, 5, 16, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15)
CACHE_FACTOR = 0x1E35A7BD
#: Pixels of the largest image that a header can describe.
MOST_PIXELS = 1 << 28
#: Pixels handed on at once, and pixels whose colours are worked out at once.
BATCH_PIXELS, BLOCK_PIXELS = 1 << 22, 1 << 20


def _near() -> list[tuple[int, int]]:
    """(dx, dy) of the 120 short distance codes: by distance, then by |dx|, the left one last."""
    spots = [(0, y) for y in range(1, 8)] + [(x, y) for x in range(1, 9) for y in range(8)] + [(-x, y) for x in range(1, 8) for y in range(1, 8)]
    return sorted(spots, key=lambda p: (p[0] ** 2 + p[1] ** 2, abs(p[0]), p[0] < 0))


NEAR = _near()


class Broken(ValueError):
    """The bytes aren't a lossless WebP image."""


class Bits:
    def __init__(self, data: bytes):
        self.data, self.at, self.end = data + bytes(8), 0, len(data) * 8

    def read(self, n: int) -> int:
        at = self.at
        self.at = at + n
        if self.at > self.end:
            raise Broken("the data ends too early")
        return int.from_bytes(self.data[at >> 3 : (at >> 3) + 5], "little") >> (at & 7) & ((1 << n) - 1)


class Code:
    """A prefix code as a table over the next ``width`` bits: symbol << 4 | length."""

    def __init__(self, lengths: list[int]):
        used = [(n, s) for s, n in enumerate(lengths) if n]
        if not used:
            raise Broken("a prefix code without symbols")
        if len(used) == 1:
            self.width, self.mask, self.table = 0, 0, [used[0][1] << 4]
            return
        self.width = width = max(n for n, _ in used)
        self.mask = (1 << width) - 1
        table = [-1] * (1 << width)
        code = last = 0
        for n, s in sorted(used):
            code <<= n - last
            last = n
            if code >> n:
                raise Broken("a prefix code with too many symbols")
            turned = int(f"{code:0{n}b}"[::-1], 2)
            table[turned :: 1 << n] = [s << 4 | n] * (1 << (width - n))
            code += 1
        if code != 1 << last:
            raise Broken("a prefix code with too few symbols")
        self.table = table

    def read(self, bits: Bits) -> int:
        if not self.width:
            return self.table[0] >> 4
        at = bits.at
        got = self.table[int.from_bytes(bits.data[at >> 3 : (at >> 3) + 4], "little") >> (at & 7) & ((1 << self.width) - 1)]
        bits.at = at + (got & 15)
        if bits.at > bits.end:
            raise Broken("the data ends too early")
        return got >> 4


def read_code(bits: Bits, size: int) -> Code:
    lengths = [0] * size
    if bits.read(1):  # one or two symbols, written out
        two = bits.read(1)
        symbols = [bits.read(8 if bits.read(1) else 1)]
        if two:
            symbols.append(bits.read(8))
        for s in symbols:
            if s >= size:
                raise Broken("a symbol outside its alphabet")
            lengths[s] = 1
        return Code(lengths)
    of_lengths = [0] * 19
    for i in range(4 + bits.read(4)):
        of_lengths[CODE_ORDER[i]] = bits.read(3)
    code = Code(of_lengths)
    left = size
    if bits.read(1):
        left = 2 + bits.read(2 + 2 * bits.read(3))
        if left > size:
            raise Broken("more code lengths than symbols")
    at, before = 0, 8
    while at < size and left:
        left -= 1
        n = code.read(bits)
        if n < 16:
            lengths[at] = n
            at += 1
            before = n or before
            continue
        what, times = (before, 3 + bits.read(2)) if n == 16 else (0, 3 + bits.read(3)) if n == 17 else (0, 11 + bits.read(7))
        if at + times > size:
            raise Broken("code lengths run over")
        lengths[at : at + times] = [what] * times
        at += times
    return Code(lengths)


def _number(bits: Bits, symbol: int) -> int:
    if symbol < 4:
        return symbol + 1
    extra = (symbol - 2) >> 1
    return ((2 + (symbol & 1)) << extra) + bits.read(extra) + 1


def read_image(bits: Bits, width: int, height: int, main: bool) -> array:
    """The pixels of an entropy-coded image."""
    cache_bits = 0
    if bits.read(1):
        cache_bits = bits.read(4)
        if not 1 <= cache_bits <= 11:
            raise Broken("a colour cache of impossible size")
    groups, group_of, tile_bits, tiles = 1, None, 0, 0
    if main and bits.read(1):
        tile_bits = bits.read(3) + 2
        tiles = (width + (1 << tile_bits) - 1) >> tile_bits
        group_of = [p >> 8 & 0xFFFF for p in read_image(bits, tiles, (height + (1 << tile_bits) - 1) >> tile_bits, False)]
        groups = max(group_of) + 1
    cache_size = 1 << cache_bits if cache_bits else 0
    sizes = (256 + LENGTH_CODES + cache_size, 256, 256, 256, DISTANCE_CODES)
    codes = [[read_code(bits, s) for s in sizes] for _ in range(groups)]
    cache, shift = [0] * cache_size, 32 - cache_bits
    out, total = array("I"), width * height
    green, red, blue, alpha, distance = codes[0]
    if group_of is None and not any(c.width for c in codes[0][:4]) and green.table[0] >> 4 < 256:
        # All pixels are alike and take no bits.
        return array("I", [alpha.read(bits) << 24 | red.read(bits) << 16 | green.read(bits) << 8 | blue.read(bits)]) * total
    cached = 0  # pixels already in the cache
    data, end, word = bits.data, bits.end, int.from_bytes
    while (n := len(out)) < total:
        if group_of is not None:
            green, red, blue, alpha, distance = codes[group_of[(n // width >> tile_bits) * tiles + (n % width >> tile_bits)]]
        # The four codes of a literal take up to 60 bits, which are read at once.
        at = bits.at
        ahead = word(data[at >> 3 : (at >> 3) + 9], "little") >> (at & 7)
        got = green.table[ahead & green.mask]
        used = got & 15
        s = got >> 4
        if s < 256:
            r = red.table[ahead >> used & red.mask]
            used += r & 15
            b = blue.table[ahead >> used & blue.mask]
            used += b & 15
            a = alpha.table[ahead >> used & alpha.mask]
            used += a & 15
            bits.at = at + used
            if bits.at > end:
                raise Broken("the data ends too early")
            out.append(a >> 4 << 24 | r >> 4 << 16 | s << 8 | b >> 4)
            continue
        bits.at = at + used
        if s < 256 + LENGTH_CODES:
            length = _number(bits, s - 256)
            back = _number(bits, distance.read(bits))
            if back > 120:
                back -= 120
            else:
                dx, dy = NEAR[back - 1]
                back = max(1, dx + dy * width)
            if back > n or n + length > total:
                raise Broken("a back-reference outside the image")
            if back >= length:
                out += out[n - back : n - back + length]
            else:
                out += (out[n - back :] * (length // back + 1))[:length]
        else:
            while cached < n:
                p = out[cached]
                cache[(p * CACHE_FACTOR & 0xFFFFFFFF) >> shift] = p
                cached += 1
            out.append(cache[s - 256 - LENGTH_CODES])
    return out


def _add(a: int, b: int) -> int:
    return ((a & 0xFF00FF00) + (b & 0xFF00FF00) & 0xFF00FF00) | ((a & 0x00FF00FF) + (b & 0x00FF00FF) & 0x00FF00FF)


def _mean(a: int, b: int) -> int:
    return (((a ^ b) & 0xFEFEFEFE) >> 1) + (a & b)


def _parts(p: int) -> tuple[int, int, int, int]:
    return p >> 24, p >> 16 & 255, p >> 8 & 255, p & 255


def _pack(parts) -> int:
    a, r, g, b = (0 if x < 0 else 255 if x > 255 else x for x in parts)
    return a << 24 | r << 16 | g << 8 | b


def predicted(mode: int, left: int, top: int, right: int, corner: int) -> int:
    """What a pixel is expected to be, from its left, top, top right and top left neighbours."""
    if mode == 0:
        return 0xFF000000
    if mode < 5:
        return (left, top, right, corner)[mode - 1]
    if mode == 5:
        return _mean(_mean(left, right), top)
    if mode == 6:
        return _mean(left, corner)
    if mode == 7:
        return _mean(left, top)
    if mode == 8:
        return _mean(corner, top)
    if mode == 9:
        return _mean(top, right)
    if mode == 10:
        return _mean(_mean(left, corner), _mean(top, right))
    l, t, c = _parts(left), _parts(top), _parts(corner)
    if mode == 11:
        return left if sum(abs(y - z) for y, z in zip(t, c)) < sum(abs(x - z) for x, z in zip(l, c)) else top
    if mode == 12:
        return _pack(x + y - z for x, y, z in zip(l, t, c))
    if mode == 13:
        m = _parts(_mean(left, top))
        return _pack(x + int((x - z) / 2) for x, z in zip(m, c))
    return 0xFF000000


#: Modes that look at the row above only.
FROM_ABOVE = (0, 2, 3, 4, 8, 9, 14, 15)
#: From so many pixels on a run of one mode is worked out in numpy.
LONG_RUN = 48


def _sums(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return ((a & 0xFF00FF00) + (b & 0xFF00FF00) & 0xFF00FF00) | ((a & 0x00FF00FF) + (b & 0x00FF00FF) & 0x00FF00FF)


def _means(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (((a ^ b) & 0xFEFEFEFE) >> 1) + (a & b)


def _run(mode: int, pixels: np.ndarray, lo: int, hi: int, width: int) -> None:
    """Undo a run of one mode that doesn't need the left neighbour, or only sums up to it (mode 1)."""
    own = pixels[lo:hi].astype(np.uint64)
    if mode == 1:
        parts = [(own >> np.uint64(k)) & np.uint64(255) for k in (0, 8, 16, 24)]
        before = int(pixels[lo - 1])
        sums = [np.cumsum(p) + np.uint64(before >> k & 255) & np.uint64(255) for p, k in zip(parts, (0, 8, 16, 24))]
        pixels[lo:hi] = sums[0] | sums[1] << np.uint64(8) | sums[2] << np.uint64(16) | sums[3] << np.uint64(24)
        return
    above = lambda d: pixels[lo - width + d : hi - width + d].astype(np.uint64)
    guess = {2: lambda: above(0), 3: lambda: above(1), 4: lambda: above(-1), 8: lambda: _means(above(-1), above(0)), 9: lambda: _means(above(0), above(1))}.get(mode, lambda: np.uint64(0xFF000000))()
    pixels[lo:hi] = _sums(own, guess)


def undo_prediction(out: array, width: int, height: int, size_bits: int, modes: array) -> array:
    tiles, side = (width + (1 << size_bits) - 1) >> size_bits, 1 << size_bits
    pixels = np.frombuffer(out, np.uint32)  # the same memory
    for y in range(height):
        row = y * width
        if y == 0:
            out[0] = _add(out[0], 0xFF000000)
            runs = [(1, 1, width)]
        else:
            out[row] = _add(out[row], out[row - width])
            own = [p >> 8 & 15 for p in modes[(y >> size_bits) * tiles : ((y >> size_bits) + 1) * tiles]]
            runs, x = [], 1
            while x < width:
                mode, to = own[x >> size_bits], x
                while to < width and own[to >> size_bits] == mode:
                    to = min(width, (to | (side - 1)) + 1)
                runs.append((mode, x, to))
                x = to
        for mode, a, b in runs:
            # Beyond the right edge stands the first pixel of the same row.
            if b - a >= LONG_RUN and (mode == 1 or mode in FROM_ABOVE):
                _run(mode, pixels, row + a, row + b, width)
                continue
            for i in range(row + a, row + b):
                guess = out[i - 1] if mode == 1 else predicted(mode, out[i - 1], out[i - width], out[i - width + 1], out[i - width - 1])
                out[i] = _add(out[i], guess)
    return out


def undo_cross_colour(pixels: np.ndarray, width: int, height: int, size_bits: int, factors: np.ndarray) -> None:
    tiles = (width + (1 << size_bits) - 1) >> size_bits
    signed = lambda x: (x & 255).astype(np.uint8).view(np.int8).astype(np.int32)
    for lo in range(0, len(pixels), BLOCK_PIXELS):
        p = pixels[lo : lo + BLOCK_PIXELS].astype(np.int64)
        at = np.arange(lo, lo + len(p))
        f = factors[(at // width >> size_bits) * tiles + (at % width >> size_bits)]
        g = signed(p >> 8)
        red = (p >> 16) + (signed(f) * g >> 5) & 255
        blue = p + (signed(f >> 8) * g >> 5) + (signed(f >> 16) * signed(red) >> 5) & 255
        pixels[lo : lo + BLOCK_PIXELS] = p & 0xFF00FF00 | red << 16 | blue


def undo_subtract_green(pixels: np.ndarray) -> None:
    for lo in range(0, len(pixels), BLOCK_PIXELS):
        p = pixels[lo : lo + BLOCK_PIXELS]
        g = p >> 8 & 255
        p[:] = (p & 0xFF00FF00) | (((p >> 16) + g & 255) << 16) | (p + g & 255)


def undo_palette(pixels: np.ndarray, width: int, height: int, palette: np.ndarray) -> np.ndarray:
    per = palette_bits(len(palette))
    each, packed = 8 >> per, len(pixels) // height
    colours = np.zeros(256, np.uint32)  # those beyond the palette are transparent black
    colours[: len(palette)] = palette
    out = np.empty((height, width), np.uint32)
    rows = max(1, BLOCK_PIXELS // width)
    for y in range(0, height, rows):
        index = (pixels[y * packed : (y + rows) * packed].reshape(-1, packed) >> 8 & 255).astype(np.uint8)
        if per:
            index = (index[:, :, None] >> np.arange(0, 8, each, dtype=np.uint8) & ((1 << each) - 1)).reshape(len(index), -1)[:, :width]
        out[y : y + rows] = colours[index]
    return out.ravel()


def palette_bits(colours: int) -> int:
    """Pixels of a byte, as a power of two."""
    return 3 if colours <= 2 else 2 if colours <= 4 else 1 if colours <= 16 else 0


def chunk(data: bytes) -> bytes:
    """The VP8L chunk of a WebP file."""
    if len(data) < 12 or data[:4] != b"RIFF" or data[8:12] != b"WEBP":
        raise Broken("not a WebP file")
    at = 12
    while at + 8 <= len(data):
        size = int.from_bytes(data[at + 4 : at + 8], "little")
        if data[at : at + 4] == b"VP8L":
            return data[at + 8 : at + 8 + size]
        if data[at : at + 4] == b"VP8 ":
            raise Broken("a lossy image")
        at += 8 + size + (size & 1)
    raise Broken("no lossless image in the file")


def decode_image(data: bytes, most_pixels: int = MOST_PIXELS) -> tuple[int, int, np.ndarray]:
    """Width, height and pixels (uint32, 0xAARRGGBB)."""
    bits = Bits(chunk(data))
    if bits.read(8) != 0x2F:
        raise Broken("no signature")
    full_width, height = bits.read(14) + 1, bits.read(14) + 1
    bits.read(1)
    if bits.read(3):
        raise Broken("an unknown version")
    if full_width * height > most_pixels:
        raise Broken("more pixels than most_pixels")
    width, undo, had = full_width, [], set()
    while bits.read(1):
        kind = bits.read(2)
        if kind in had:
            raise Broken("a transform twice")
        had.add(kind)
        if kind in (PREDICTOR, CROSS_COLOUR):
            size = bits.read(3) + 2
            side = lambda n: (n + (1 << size) - 1) >> size
            undo.append((kind, width, size, read_image(bits, side(width), side(height), False)))
        elif kind == PALETTE:
            steps = read_image(bits, bits.read(8) + 1, 1, False)
            for i in range(1, len(steps)):
                steps[i] = _add(steps[i], steps[i - 1])
            undo.append((kind, width, 0, steps))
            width = (width + (1 << palette_bits(len(steps))) - 1) >> palette_bits(len(steps))
        else:
            undo.append((kind, width, 0, array("I")))
    raw = read_image(bits, width, height, True)
    pixels, made = np.frombuffer(raw, np.uint32), False
    for kind, width, size, extra in reversed(undo):
        if kind == PREDICTOR:
            if made:  # by another transform, in memory of its own
                raw = array("I", pixels.tobytes())
            pixels = np.frombuffer(undo_prediction(raw, width, height, size, extra), np.uint32)
        elif kind == CROSS_COLOUR:
            undo_cross_colour(pixels, width, height, size, np.frombuffer(extra, np.uint32))
        elif kind == PALETTE:
            pixels, made = undo_palette(pixels, width, height, np.frombuffer(extra, np.uint32)), True
        else:
            undo_subtract_green(pixels)
    return full_width, height, pixels


def decode(images: DataFrame, id_column: str, column: str = "image", most_pixels: int = MOST_PIXELS) -> DataFrame:
    """(id_column, width, height, pixels, error) of every image."""
    if id_column in ("width", "height", "pixels", "error"):
        raise ValueError(f"the id column can't be called {id_column}")

    def rows_of(batches):
        for batch in batches:
            for i, data in zip(batch.column(0), batch.column(1)):
                if not data.is_valid:
                    yield i, None, None, None, None
                    continue
                try:
                    yield (i, *decode_image(data.as_py(), most_pixels), None)
                except (Broken, IndexError) as e:
                    yield i, None, None, None, str(e) or "broken"

    def made(rows):
        ids, w, h, p, e = zip(*rows)
        sizes = np.concatenate(([0], np.cumsum([0 if x is None else len(x) for x in p]))).astype(np.int32)
        flat = np.concatenate([x for x in p if x is not None] or [np.zeros(0, np.uint32)]).view(np.int32)
        pixels = pa.ListArray.from_arrays(pa.array(sizes), pa.array(flat), mask=pa.array([x is None for x in p], pa.bool_()))
        return pa.RecordBatch.from_arrays([pa.array([i.as_py() for i in ids], pa.int64()), pa.array(w, pa.int32()), pa.array(h, pa.int32()), pixels, pa.array(e, pa.string())], ["id", "width", "height", "pixels", "error"])

    def each(batches):
        held, size = [], 0
        for row in rows_of(batches):
            held.append(row)
            size += 0 if row[3] is None else len(row[3])
            if size >= BATCH_PIXELS or len(held) >= 1024:
                yield made(held)
                held, size = [], 0
        if held:
            yield made(held)

    narrow = images.select(F.col(id_column).cast("long").alias("id"), F.col(column).cast("binary").alias("image"))
    return narrow.mapInArrow(each, "id long, width int, height int, pixels array<int>, error string").withColumnRenamed("id", id_column)
