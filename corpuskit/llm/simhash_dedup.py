"""Near-duplicate documents by SimHash, pairs pruned with a pivot distance table.

A fingerprint has 128 bits: bit k is set if most distinct words of the text (letters and
digits, lower case) have bit k set in their MD5. Two documents are near duplicates if their
fingerprints differ in at most ``radius`` bits; a group is a connected component of that.

All pairs are found. The bits are cut into parts (six to eight, by what costs least) and each part gets a radius
so that a near pair differs by no more than that in one part at least: if it differed by more in every part, the
differences would add up to more than ``radius``. For each part the rows are sorted by their bits there, and each row
looks up all values within the part's radius of its own. Where a part says so little that this would cost more than comparing all
rows, which a sample of rows tells beforehand, the rest is done by comparing all: slower, but the same pairs.

Rows are dealt into blocks, every two of which meet in a task of their own: eight blocks, or as many as it takes to
keep them at 524,288 rows or less. So up to 4 million fingerprints what is shuffled grows in proportion, beyond
that with the square. CPU time grows with the square, though of the pairs of rows only some thousandths are looked at.

For each fingerprint the Hamming distances to 128 reference fingerprints, the rows of a Hadamard matrix, are
worked out once. By the triangle inequality a pair whose distances to any reference differ by more than ``radius``
can't be near and is discarded; the survivors' own distance is then counted. References alone can't replace
the parts: random fingerprints lie about equally far from any reference, so their distances don't
say where to look.

With a ``recall`` below 1 pairs are looked for by sampling instead, among fingerprints that agree in all of some chosen
bits, for a number of choices. That loses pairs and is only for those who ask for it. ``bits`` is log2 of the number of
fingerprints, less 2, but 16 at least; there are as many choices as it takes to meet a pair at the full radius with
probability ``recall``: for 0.985 55 choices of 16 bits up to 262,144 fingerprints, 288 of 25 bits for 10**8. Buckets that
hold over ``block`` rows are found by adding up what partitions count, and are cut into blocks, every two of which meet.

A text without words (or null) has no fingerprint and no duplicates. Rows with a null doc_id
can't be named and are left out. Rows that share a doc_id count as one document. Columns other
than doc_id and text are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.graph import connected_components
from ..operators.lineage import cut
from . import arrays as A

RADIUS = 18
#: Of sampled pairs at just the radius.
RECALL = 0.985
#: Rows of a bucket of sampled pairs that are compared in one piece.
BLOCK = 16384
#: Blocks that all rows are dealt into, as far as they then have between so many rows.
BLOCKS, LEAST, MOST = 8, 1 << 13, 1 << 19
#: Pairs of rows that are compared as fast as one that was looked up.
DENSE = 20
#: Pairs compared at once.
TILE = 1 << 18
BITS = 128
PIECE = 2 << 20
#: Rows held at once while keys are made.
STEP = 4096


def choices(n: int, radius: int = RADIUS, recall: float = RECALL) -> np.ndarray:
    """Sets of bits (a row each) for n fingerprints."""
    bits = min(38, max(16, math.ceil(math.log2(max(n, 1))) - 2))
    alike = math.prod((BITS - radius - i) / (BITS - i) for i in range(bits))  # of a pair at the full radius
    many = max(1, math.ceil(math.log(1 - recall) / math.log1p(-alike)))
    rng = np.random.default_rng(5)
    out: list[np.ndarray] = []
    while len(out) < many:  # sets of one shuffle are disjoint, which spreads them
        out += list(rng.permutation(BITS)[: BITS // bits * bits].reshape(-1, bits))
    return np.sort(np.array(out[:many]), axis=1)


def references() -> np.ndarray:
    """128 reference fingerprints as rows of -1 and 1; any two differ in 64 bits."""
    h = np.ones((1, 1), np.float32)
    while len(h) < BITS:
        h = np.block([[h, h], [h, -h]])
    return h


def pivot_distances(fp: np.ndarray) -> np.ndarray:
    """Hamming distance of each fingerprint (rows of 16 bytes) to each reference, less 64."""
    signs = np.unpackbits(fp, axis=1).astype(np.float32) * 2 - 1
    return (-(signs @ references().T) / 2).astype(np.int8)


def _bits_of(raw: bytes, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    md5 = hashlib.md5
    digests = b"".join([md5(raw[s:e]).digest() for s, e in zip(start.tolist(), end.tolist())])
    return np.unpackbits(np.frombuffer(digests, np.uint8).reshape(-1, 16), axis=1)


def fingerprint_rows(texts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints (rows of 16 bytes) and which texts have one."""
    buf, offs = A.flat(pc.utf8_lower(texts))
    w = A.Words(buf, offs, A.ALNUM)
    n = len(texts)
    out, has = np.zeros((n, 16), np.uint8), np.diff(w.first) > 0
    if len(w.start):
        _, at, which = np.unique(w.hash, return_index=True, return_inverse=True)
        bits = _bits_of(buf.tobytes(), w.start[at], w.end[at])
        pairs = np.unique(w.row_of() * len(at) + which)
        row = pairs // len(at)
        begin = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
        size = np.diff(np.append(begin, len(row)))
        ones = np.zeros((len(begin), BITS), np.int64)
        step = 1 << 15
        for lo in range(0, len(row), step):  # so that the rows of bits stay in cache
            part = pairs[lo : lo + step] % len(at)
            first = np.searchsorted(begin, lo, side="right") - 1
            last = np.searchsorted(begin, lo + len(part), side="left")
            cuts = np.maximum(begin[first:last] - lo, 0)
            ones[first:last] += np.add.reduceat(bits[part], cuts, axis=0, dtype=np.int32)
        out[row[begin]] = np.packbits(ones * 2 > size[:, None], axis=1)
    return out, has


def _longs(fp: np.ndarray) -> tuple[pa.Array, pa.Array]:
    both = np.ascontiguousarray(fp).view(">u8").astype(np.uint64)
    return A.longs(both[:, 0].copy()), A.longs(both[:, 1].copy())


def _bytes(hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
    return np.stack([hi, lo], axis=1).astype(">i8").view(np.uint8).reshape(-1, 16)


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, hi, lo) of every document that has words."""

    @A.lean
    def each(batches):
        for batch in batches:
            texts, ids = A.text_column(batch, "text"), batch.column(0)
            for a, b in A.pieces(texts, PIECE):
                fp, has = fingerprint_rows(texts[a:b])
                hi, lo = _longs(fp[has])
                yield pa.RecordBatch.from_arrays([ids[a:b].filter(pa.array(has)), hi, lo], ["doc_id", "hi", "lo"])

    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("doc_id is not null and text is not null")
    return named.mapInArrow(each, "doc_id long, hi long, lo long")


class Keys:
    """The key of each fingerprint for each choice of bits."""

    def __init__(self, chosen: np.ndarray):
        self.chosen = chosen
        self.weights = np.zeros((BITS, len(chosen)))
        for t, of in enumerate(chosen):
            self.weights[of, t] = 2.0 ** np.arange(len(of))
        self.member = (self.weights > 0).astype(np.float32)
        self.table = np.arange(len(chosen), dtype=np.int64) << 40

    def of(self, fp: np.ndarray) -> np.ndarray:
        return (np.unpackbits(fp, axis=1).astype(np.float64) @ self.weights).astype(np.int64) | self.table

    def first(self, x: np.ndarray) -> np.ndarray:
        """The first choice in which no bit of x (rows of 16 bytes) is set."""
        return ((np.unpackbits(x, axis=1).astype(np.float32) @ self.member) == 0).argmax(axis=1)


def near_in_buckets(key: np.ndarray, fp: np.ndarray, node: np.ndarray, side: np.ndarray, radius: int, keys: Keys, cascade: int = 16) -> tuple[np.ndarray, np.ndarray]:
    """Near pairs among rows with equal keys (sorted), each at the first choice that has it.

    Where a group of rows has two sides only pairs across count."""
    left, right = [], []
    pivots = None
    live = np.arange(len(key) - 1)
    for step in range(1, len(key)):
        live = live[live + step < len(key)]
        live = live[key[live + step] == key[live]]
        if not len(live):
            break
        if pivots is None:
            pivots = pivot_distances(fp)
        for lo in range(0, len(live), 1 << 14):
            i = live[lo : lo + (1 << 14)]
            j = i + step
            ok = (side[i] == 0) | (side[i] != side[j])
            if not ok.all():
                i, j = i[ok], j[ok]
            for c in range(0, BITS, cascade):
                ok = np.abs(pivots[i, c : c + cascade] - pivots[j, c : c + cascade]).max(axis=1, initial=0) <= radius
                i, j = i[ok], j[ok]
            x = fp[i] ^ fp[j]
            near = np.bitwise_count(x).sum(axis=1) <= radius
            i, j, x = i[near], j[near], x[near]
            if len(i):
                first = keys.first(x) == key[i] >> 40
                left.append(node[i[first]])
                right.append(node[j[first]])
    none = np.zeros(0, np.int64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def hot_keys(prints: DataFrame, keys: Keys, block: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys with more than ``block`` rows, in order, and their number of blocks.

    A partition tells the keys of which it has the block-th part of what would make them hot if all had as
    many; keys of over two blocks can't escape that. There are at most rows / block of them for each choice."""
    least = max(2, block // max(1, prints.rdd.getNumPartitions()))

    @A.lean
    def count(batches):
        fps = [_bytes(np.asarray(b.column(1)), np.asarray(b.column(2))) for b in batches if b.num_rows]
        if not fps:
            return
        bits = np.unpackbits(np.concatenate(fps), axis=1)
        for t, of in enumerate(keys.chosen):
            key, n = np.unique(bits[:, of].astype(np.float64) @ 2.0 ** np.arange(len(of)), return_counts=True)
            key = key.astype(np.int64)
            some = n >= least
            if some.any():
                yield pa.RecordBatch.from_arrays([A.longs(key[some] | t << 40), A.longs(n[some])], ["key", "n"])

    counted = prints.select("node", "hi", "lo").mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") > block).orderBy("key")
    found = [(r.key, -(-r.n // block)) for r in counted.toLocalIterator()]
    return np.array([k for k, _ in found], np.int64), np.array([c for _, c in found], np.int64)


def parts(radius: int, many: int) -> list[tuple[int, int, int]]:
    """(first bit, bits, radius) of each part: near pairs are within the radius of a part in one at least."""
    least, more = divmod(radius + 1, many)
    width, wider = divmod(BITS, many)
    firsts = [i * width + min(i, wider) for i in range(many)]
    return [(at, width + (i < wider), least - (i >= more)) for i, at in enumerate(firsts) if least - (i >= more) >= 0]


def best_parts(a: int, b: int, radius: int) -> list[tuple[int, int, int]]:
    """Parts for a rows against b rows: more values looked up in long parts, more pairs met in short ones."""

    def cost(of: list[tuple[int, int, int]]) -> float:
        return sum(2**w + sum(math.comb(w, k) for k in range(r + 1)) * a * (1 + 8 * b / 2**w) for _, w, r in of)

    return min((parts(radius, many) for many in range(6, 33)), key=cost)


@lru_cache(maxsize=8)
def masks(width: int, radius: int) -> np.ndarray:
    """All differences of ``width`` bits of which ``radius`` at most are set."""
    return np.array([sum(1 << bit for bit in c) for k in range(radius + 1) for c in combinations(range(width), k)], np.int64)


def _part_of(hi: np.ndarray, lo: np.ndarray, at: int, width: int) -> np.ndarray:
    u = A.U64
    if at >= 64:
        x = lo << u(at - 64)
    else:
        x = (hi << u(at)) | (lo >> u(64 - at)) if at else hi
    return (x >> u(64 - width)).astype(np.int64)


class Rows:
    """Fingerprints (hi, lo as unsigned) with their distances to the references."""

    def __init__(self, hi: np.ndarray, lo: np.ndarray):
        self.hi, self.lo = hi, lo
        self.pivots = np.zeros((len(hi), BITS), np.int8)
        for at in range(0, len(hi), STEP):
            self.pivots[at : at + STEP] = pivot_distances(_bytes(hi[at : at + STEP], lo[at : at + STEP]))

    def __len__(self) -> int:
        return len(self.hi)

    def by(self, at: int, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The bits of a part in order, and the rows in that order."""
        key = _part_of(self.hi, self.lo, at, width)
        order = np.argsort(key, kind="stable")
        return key[order], order


def _near(a: Rows, b: Rows, i: np.ndarray, j: np.ndarray, radius: int, before: list[tuple[int, int, int]], cascade: int = 16) -> tuple[np.ndarray, np.ndarray]:
    """Those of the pairs i, j that are near and not within the radius of a part before."""
    for c in range(0, BITS, cascade):
        ok = np.abs(a.pivots[i, c : c + cascade].astype(np.int16) - b.pivots[j, c : c + cascade]).max(axis=1, initial=0) <= radius
        i, j = i[ok], j[ok]
    x, y = a.hi[i] ^ b.hi[j], a.lo[i] ^ b.lo[j]
    ok = np.bitwise_count(x) + np.bitwise_count(y) <= radius
    for at, width, r in before:
        ok &= np.bitwise_count(_part_of(x, y, at, width)) > r
    return i[ok], j[ok]


def _all_near(a: Rows, b: Rows, radius: int, before: list[tuple[int, int, int]], one: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """As near_between, by comparing every two rows."""
    wide = 4096
    tall = max(1, TILE // 4 // min(wide, max(1, len(b))))
    for top in range(0, len(a), tall):
        hi, lo = a.hi[top : top + tall, None], a.lo[top : top + tall, None]
        for left in range(top // wide * wide if one else 0, len(b), wide):
            apart = np.bitwise_count(hi ^ b.hi[left : left + wide]) + np.bitwise_count(lo ^ b.lo[left : left + wide])
            i, j = np.divmod(np.flatnonzero(apart <= radius), apart.shape[1])
            i, j = i + top, j + left
            if one:
                i, j = i[i < j], j[i < j]
            if len(i):
                yield _near(a, b, i, j, radius, before)


def near_between(a: Rows, b: Rows, radius: int, of: list[tuple[int, int, int]] | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All near pairs of a row of a and a row of b, each once; of two rows of a if b is a."""
    one = a is b
    if of is None:
        if len(a) * len(b) <= TILE:
            yield from _all_near(a, b, radius, [], one)
            return
        of = best_parts(len(a), len(b), radius)
    for c, (at, width, r) in enumerate(of):
        key, order = a.by(at, width)
        other, order_b = (key, order) if one else b.by(at, width)
        hi_a, hi_b = a.hi[order], b.hi[order_b]
        start = np.zeros((1 << width) + 1, np.int32)
        np.cumsum(np.bincount(other, minlength=1 << width), out=start[1:])
        tried = key[:: max(1, len(key) // 128)]
        met = sum(int((start[(tried ^ m) + 1] - start[tried ^ m]).sum(dtype=np.int64)) for m in masks(width, r).tolist())
        if met * DENSE > len(tried) * len(b):
            yield from _all_near(a, b, radius, of[:c], one)
            return
        for m in masks(width, r).tolist():
            theirs = key ^ m
            first = start[theirs]
            n = start[theirs + 1] - first
            if one and m:
                n[theirs < key] = 0  # found from the other side
            row = np.flatnonzero(n)
            if not len(row):
                continue
            n, first = n[row], first[row]
            end = np.cumsum(n, dtype=np.int64)
            for lo in range(0, int(end[-1]), TILE):
                to = min(lo + TILE, int(end[-1]))
                s = slice(int(np.searchsorted(end, lo, side="right")), int(np.searchsorted(end, to - 1, side="right")) + 1)
                begin = end[s] - n[s]
                times = np.minimum(end[s], to) - np.maximum(begin, lo)
                i, j = np.repeat(row[s], times), np.arange(lo, to) - np.repeat(begin - first[s], times)
                if one and not m:
                    i, j = i[i < j], j[i < j]
                half = np.flatnonzero(np.bitwise_count(hi_a[i] ^ hi_b[j]) <= radius)  # enough to drop most
                i, j = _near(a, b, order[i[half]], order_b[j[half]], radius, of[:c])
                if len(i):
                    yield i, j


def near_pairs(prints: DataFrame, radius: int = RADIUS, recall: float = 1.0, block: int | None = None, chosen: np.ndarray | None = None) -> DataFrame:
    """(src, dst) for all near pairs of distinct fingerprints (node, hi, lo), each once.

    ``block``: rows of a block at most, about. Pairs are sampled if ``recall`` is below 1 or bits are ``chosen``."""
    if recall < 1 or chosen is not None:
        return sampled_pairs(prints, radius, recall if recall < 1 else RECALL, block or BLOCK, chosen)
    n = prints.count()
    many = max(1, math.ceil(n / (block or min(MOST, max(LEAST, math.ceil(n / BLOCKS))))))
    tasks = many * (many + 1) // 2

    @A.lean
    def spread(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                node, hi, lo = (np.asarray(c) for c in batch.slice(at, STEP).columns)
                mine = np.repeat((A.mix(node.view(A.U64)) % A.U64(many)).astype(np.int64), many)
                row, other = np.repeat(np.arange(len(node)), many), np.tile(np.arange(many), len(node))
                a, b = np.minimum(mine, other), np.maximum(mine, other)
                side = np.where(a == b, 0, np.where(mine == a, 1, 2)).astype(np.int8)
                yield pa.RecordBatch.from_arrays([A.longs(b * (b + 1) // 2 + a), pa.array(side), A.longs(node[row]), A.longs(hi[row]), A.longs(lo[row])], ["part", "side", "node", "hi", "lo"])

    def found(held):
        side, node, hi, lo = (np.concatenate([np.asarray(b.column(c)) for b in held]) for c in range(1, 5))
        held.clear()
        sides = [np.flatnonzero(side == 0)] * 2 if (side == 0).all() else [np.flatnonzero(side == k) for k in (1, 2)]
        if len(sides[0]) and len(sides[1]):
            a = Rows(hi[sides[0]].view(A.U64), lo[sides[0]].view(A.U64))
            b = a if sides[0] is sides[1] else Rows(hi[sides[1]].view(A.U64), lo[sides[1]].view(A.U64))
            for i, j in near_between(a, b, radius):
                yield pa.RecordBatch.from_arrays([A.longs(node[sides[0][i]]), A.longs(node[sides[1][j]])], ["src", "dst"])

    @A.lean
    def pairs(batches):
        held, now = [], None
        for batch in batches:
            part = np.asarray(batch.column(0))
            ends = [*(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), len(part)] if len(part) else []
            for a, b in zip([0, *ends], ends):
                if held and part[a] != now:
                    yield from found(held)
                now = part[a]
                held.append(batch.slice(a, b - a))
        if held:
            yield from found(held)

    made = prints.select("node", "hi", "lo").mapInArrow(spread, "part long, side byte, node long, hi long, lo long")
    wide = min(tasks, max(64, n * many >> 19))
    return made.repartitionById(wide, F.col("part").cast("int")).sortWithinPartitions("part").mapInArrow(pairs, "src long, dst long")


def sampled_pairs(prints: DataFrame, radius: int = RADIUS, recall: float = RECALL, block: int = BLOCK, chosen: np.ndarray | None = None) -> DataFrame:
    """As near_pairs, but pairs that agree in no choice of bits are lost."""
    keys = Keys(choices(prints.count(), radius, recall) if chosen is None else chosen)
    hot, blocks = hot_keys(prints, keys, block)

    @A.lean
    def spread(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                node, hi, lo = (np.asarray(c) for c in batch.slice(at, STEP).columns)
                key = keys.of(_bytes(hi, lo))
                row = np.repeat(np.arange(len(node)), key.shape[1])
                key = key.ravel()
                part = np.zeros(len(key), np.int64)
                if len(hot):
                    place = np.minimum(np.searchsorted(hot, key), len(hot) - 1)
                    many = np.where(hot[place] == key, blocks[place], 1)
                    mine = (A.mix(node.view(A.U64))[row] % many.astype(A.U64)).astype(np.int64)
                    # A row of a hot bucket meets every block: (i, j), i <= j, on the side of its own.
                    copies = np.repeat(np.arange(len(key)), many)
                    other = np.arange(len(copies)) - np.repeat(np.cumsum(many) - many, many)
                    mine, is_hot = mine[copies], many[copies] > 1
                    a, b = np.minimum(mine, other), np.maximum(mine, other)
                    side = np.where(a == b, 0, np.where(mine == a, 1, 2))
                    part = np.where(is_hot, (a << 20 | b) << 2 | side, 0)
                    key, row = key[copies], row[copies]
                yield pa.RecordBatch.from_arrays([A.longs(key), A.longs(part >> 2), pa.array((part & 3).astype(np.int8)), A.longs(node[row]), A.longs(hi[row]), A.longs(lo[row])], names)

    names = ["key", "part", "side", "node", "hi", "lo"]

    @A.lean
    def pairs(batches):
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            key, part, side, node, hi, lo = (np.asarray(c) for c in batch.columns)
            rows = [key, _bytes(hi, lo), node, side, part]
            if held is not None:
                rows = [np.concatenate((h, r)) for h, r in zip(held, rows)]
            new = np.flatnonzero((rows[0][1:] != rows[0][:-1]) | (rows[4][1:] != rows[4][:-1]))
            done = int(new[-1]) + 1 if len(new) else 0
            held = [r[done:] for r in rows]
            if done:
                yield found([r[:done] for r in rows])
        if held is not None:
            yield found(held)

    def found(rows):
        key, fp, node, side, part = rows
        # Groups of one key and part are compared; the choice is in the high bits of the key.
        group = np.cumsum(np.concatenate(([0], (key[1:] != key[:-1]) | (part[1:] != part[:-1]))))
        src, dst = near_in_buckets((key >> 40 << 40) | group, fp, node, side, radius, keys)
        return pa.RecordBatch.from_arrays([A.longs(src), A.longs(dst)], ["src", "dst"])

    made = prints.select("node", "hi", "lo").mapInArrow(spread, "key long, part long, side byte, node long, hi long, lo long")
    return made.repartition("key", "part").sortWithinPartitions("key", "part").mapInArrow(pairs, "src long, dst long")


def near_duplicates(docs: DataFrame, radius: int = RADIUS, recall: float = 1.0, block: int | None = None) -> DataFrame:
    """Documents in groups of two or more: (doc_id, group_id, group_size, kept).

    group_id is the smallest doc_id of the group; that document is kept. ``radius``: bits in which
    near fingerprints may differ. ``recall``: 1, or less to sample pairs; ``block``: see near_pairs."""
    prints = cut(fingerprints(docs).distinct())
    # Documents of one fingerprint are one node, so that thousands of copies make no pairs.
    nodes = cut(prints.groupBy("hi", "lo").agg(F.min("doc_id").alias("node")))
    edges = near_pairs(nodes, radius, recall, block)
    same = prints.join(nodes, ["hi", "lo"]).select(F.col("doc_id").alias("src"), F.col("node").alias("dst")).where("src <> dst")
    groups = connected_components(edges.unionByName(same))
    sizes = groups.groupBy("comp").agg(F.count("*").alias("group_size"))
    return groups.join(sizes, "comp").select(F.col("id").alias("doc_id"), F.col("comp").alias("group_id"), "group_size", (F.col("id") == F.col("comp")).alias("kept"))


def deduplicated(docs: DataFrame, radius: int = RADIUS, recall: float = 1.0) -> DataFrame:
    """The documents without those that aren't kept; rows with a null doc_id or no words stay."""
    gone = near_duplicates(docs, radius, recall).where("not kept").select(F.col("doc_id").alias("doc_id_gone"))
    return docs.join(gone, docs["doc_id"].cast("long") == gone["doc_id_gone"], "left_anti")


def _sql() -> str:
    bits = [(h, 63 - k) for h in ("hi", "lo") for k in range(64)]
    sums = ", ".join(f"sum(({h} >> {k}) & 1) AS {h}{k}" for h, k in bits)
    packed = ", ".join(" + ".join(f"CASE WHEN 2 * {h}{k} > n THEN {1 << k}::UBIGINT ELSE 0::UBIGINT END" for g, k in bits if g == h) + f" AS {h}" for h in ("hi", "lo"))
    return rf"""
WITH RECURSIVE w AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM documents WHERE doc_id IS NOT NULL),
h AS (SELECT doc_id, ('0x' || substr(md5(w), 1, 16))::UBIGINT AS hi, ('0x' || substr(md5(w), 17, 16))::UBIGINT AS lo FROM w),
s AS (SELECT doc_id, count(*) AS n, {sums} FROM h GROUP BY doc_id),
f AS MATERIALIZED (SELECT doc_id, {packed} FROM s),
e AS MATERIALIZED (SELECT a.doc_id AS a, b.doc_id AS b FROM f a JOIN f b ON a.doc_id <> b.doc_id AND bit_count(xor(a.hi, b.hi)) + bit_count(xor(a.lo, b.lo)) <= {RADIUS}),
r AS (SELECT a AS doc_id, a AS comp FROM e UNION SELECT e.b, r.comp FROM r JOIN e ON e.a = r.doc_id),
g AS (SELECT doc_id, min(comp) AS group_id FROM r GROUP BY doc_id)
SELECT doc_id, group_id, count(*) OVER (PARTITION BY group_id) AS group_size, doc_id = group_id AS kept FROM g
"""


SQL = _sql()
