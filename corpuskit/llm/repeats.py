"""What the two searches for repeated passages share.

A passage is ``window`` consecutive words (split at blanks). Of the ``gram``-word
grams in a window the one of least hash is its anchor: equal windows have equal
anchors, so a window can only repeat if its anchor's gram does. About one gram in
thirteen is an anchor, which makes a first look at the whole corpus cheap.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import arrays as A

#: Bits of one bitmap of ``bitmap_construct_agg``.
BITMAP_BITS = 32768
#: Largest bitmap, in bytes, that is broadcast; beyond it the anchors are joined.
BROADCAST_BYTES = 64 << 20
CELL = np.uint64(0x9FB21C651E98DF25)


class Windows:
    """The windows of some rows: which word each starts at, its row and its anchor."""

    def __init__(self, words: A.Words, window: int, gram: int, keep: np.ndarray | None = None):
        self.words, n = words, len(words.start)
        counts = np.diff(words.first)
        per_row = np.maximum(counts - window + 1, 0)
        if keep is not None:
            per_row[~keep] = 0
        self.row = np.repeat(np.arange(len(counts)), per_row)
        total = int(per_row.sum())
        skip = np.cumsum(per_row) - per_row
        self.pos = np.arange(total) - np.repeat(skip, per_row)
        self.at = self.pos + np.repeat(words.first[:-1], per_row)
        self.hash = A.Prefix(words.hash, A.MULT_A)
        if total:
            start = np.arange(n - gram + 1)
            grams = self.hash.ranges(start, start + gram)
            low = np.uint64(0xFFFFFFFF)
            least = A.sliding_min((grams & ~low) | start.astype(A.U64), window - gram + 1)[self.at]
            which = (least & low).astype(np.int64)
            self.new = np.concatenate(([True], (which[1:] != which[:-1]) | (self.row[1:] != self.row[:-1])))
            self.anchor = grams[which]
        else:
            self.new, self.anchor = np.zeros(0, bool), np.zeros(0, A.U64)


def each_piece(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, A.Words, pa.RecordBatch]]:
    for batch in batches:
        texts = A.text_column(batch, "text")
        ids = np.asarray(batch.column(0).fill_null(0))
        for a, b in A.pieces(texts):
            buf, offs = A.flat(texts[a:b])
            yield ids[a:b], A.Words(buf, offs, A.NOT_SPACE), batch.slice(a, b - a)


def cells(anchor: np.ndarray, width: int, rows: int) -> list[np.ndarray]:
    """The cell of each anchor in each row of a sketch; width is a power of two."""
    out, h = [], anchor
    for r in range(rows):
        out.append((h & A.U64(width - 1)).astype(np.int64) + r * width)
        h = A.mix(h + CELL)
    return out


def usable(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("doc_id is not null and text is not null")


def sketch_width(docs: DataFrame, window: int, gram: int, per_anchor: int = 4) -> int:
    """A power of two of at least ``per_anchor`` cells for each expected anchor of the corpus."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    expected = size / 6 * 2 / (window - gram + 2)
    return max(BITMAP_BITS, 1 << int(np.ceil(np.log2(max(1.0, expected * per_anchor)))))


def bitmap(hot: DataFrame, bits: int) -> np.ndarray:
    """A bit for each number in column ``cell`` of ``hot``."""
    made = hot.groupBy(F.expr("bitmap_bucket_number(cell + 1)").alias("b")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(cell + 1))").alias("m"))
    out = np.zeros(max(1, -(-bits // BITMAP_BITS)) * BITMAP_BITS // 8, np.uint8)
    for row in made.collect():
        at = (row.b - 1) * (BITMAP_BITS // 8)
        out[at : at + len(row.m)] = np.frombuffer(bytes(row.m), np.uint8)
    return out


def set_bits(bits: np.ndarray, cell: np.ndarray) -> np.ndarray:
    return (bits[cell >> 3] >> (cell & 7).astype(np.uint8)) & 1 == 1


def candidates(docs: DataFrame, hot: DataFrame, width: int, rows: int, window: int, gram: int, emit, schema: str, limit: int, keep=None) -> DataFrame:
    """``emit(ids, windows, chosen)`` of every piece of text, where chosen marks the windows whose
    anchor has all its cells in ``hot``. The cells go to the executors as a bitmap if it takes
    at most ``limit`` bytes; otherwise the anchors are joined with them and the texts with that.
    ``keep(ids, words)`` may say which rows take part."""
    kept = keep or (lambda ids, words: None)
    spark: SparkSession = docs.sparkSession
    if width * rows // 8 <= limit:
        shared = spark.sparkContext.broadcast(bitmap(hot, width * rows))

        def near(batches):
            for ids, words, _ in each_piece(batches):
                w = Windows(words, window, gram, kept(ids, words))
                ok = np.ones(len(w.pos), bool)
                for c in cells(w.anchor, width, rows):
                    ok &= set_bits(shared.value, c)
                if ok.any():
                    yield emit(ids, w, ok)

        return docs.mapInArrow(near, schema)

    names = [f"c{r}" for r in range(rows)]

    def anchors(batches):
        for ids, words, _ in each_piece(batches):
            w = Windows(words, window, gram, kept(ids, words))
            if len(w.pos):
                begin = np.flatnonzero(w.new)
                end = np.append(begin[1:], len(w.pos)) - 1
                cols = [A.longs(ids[w.row[begin]]), A.longs(w.pos[begin]), A.longs(w.pos[end])]
                yield pa.RecordBatch.from_arrays(cols + [A.longs(c) for c in cells(w.anchor[begin], width, rows)], ["doc_id", "a", "b", *names])

    found = docs.mapInArrow(anchors, "doc_id long, a long, b long, " + ", ".join(f"{c} long" for c in names))
    for c in names:
        found = found.join(hot.select(F.col("cell").alias(c)), c, "left_semi")
    ranges = found.groupBy(F.col("doc_id").alias("id")).agg(F.collect_list("a").alias("a"), F.collect_list("b").alias("b"))

    def far(batches):
        for ids, words, part in each_piece(batches):
            w = Windows(words, window, gram, kept(ids, words))
            ok = np.zeros(len(w.pos) + 1, np.int64)
            begin = np.searchsorted(w.row, np.arange(len(ids) + 1))
            for i, (x, y) in enumerate(zip(part.column(2).to_pylist(), part.column(3).to_pylist())):
                lo, n = begin[i], begin[i + 1] - begin[i]
                x, y = np.array(x), np.array(y)
                x, y = x[x < n], y[x < n]
                np.add.at(ok, lo + x, 1)
                np.add.at(ok, lo + np.minimum(y, n - 1) + 1, -1)
            chosen = np.cumsum(ok[:-1]) > 0
            if chosen.any():
                yield emit(ids, w, chosen)

    return docs.join(ranges, docs.doc_id == ranges.id).drop("id").mapInArrow(far, schema)


def spans(found: DataFrame, window: int) -> DataFrame:
    """Windows (doc_id, pos, later) merged where they overlap or touch, by document."""

    def merged(batches):
        held = None
        names = ["doc_id", "start_word", "end_word", "repeated_windows", "later_windows"]
        for batch in batches:
            cols = [np.asarray(c) for c in batch.columns]
            if not len(cols[0]):
                continue
            doc, pos, end, n, later = cols[0], cols[1], cols[1] + window, np.ones(len(cols[0]), np.int64), cols[2].astype(np.int64)
            if held is not None:
                doc, pos, end, n, later = (np.concatenate(([h], x)) for h, x in zip(held, (doc, pos, end, n, later)))
            new = np.concatenate(([True], (doc[1:] != doc[:-1]) | (pos[1:] > end[:-1])))
            same = np.concatenate(([False], (doc[1:] == doc[:-1]) & (pos[1:] == pos[:-1])))
            n, later = np.where(same, 0, n), np.where(same, 0, later)
            at = np.flatnonzero(new)
            last = np.append(at[1:], len(doc)) - 1
            rows = [doc[at], pos[at], end[last], np.add.reduceat(n, at), np.add.reduceat(later, at)]
            # The open span goes on with the next batch; its end is that of its last window.
            held = [r[-1] for r in rows]
            if len(at) > 1:
                yield pa.RecordBatch.from_arrays([A.longs(r[:-1]) for r in rows], names)
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array([int(h)], pa.int64()) for h in held], names)

    by_doc = found.select("doc_id", "pos", "later").repartition("doc_id").sortWithinPartitions("doc_id", "pos", F.desc("later"))
    return by_doc.mapInArrow(merged, "doc_id long, start_word long, end_word long, repeated_windows long, later_windows long")


def union(found: DataFrame) -> DataFrame:
    """Spans (doc_id, pos, end) merged where they overlap or touch: (doc_id, start_word, end_word)."""

    def merged(batches):
        held, names = None, ["doc_id", "start_word", "end_word"]
        for batch in batches:
            rows = [np.asarray(c).astype(np.int64) for c in batch.columns]
            if not len(rows[0]):
                continue
            if held is not None:
                rows = [np.concatenate(([h], x)) for h, x in zip(held, rows)]
            doc, pos, end = rows
            far = np.cumsum(np.concatenate(([0], doc[1:] != doc[:-1]))) << 40
            reach = np.maximum.accumulate(far + end)
            at = np.flatnonzero(np.concatenate(([True], far[1:] + pos[1:] > reach[:-1])))
            last = np.append(at[1:], len(doc)) - 1
            rows = [doc[at], pos[at], reach[last] - far[last]]
            held = [r[-1] for r in rows]
            if len(at) > 1:
                yield pa.RecordBatch.from_arrays([A.longs(r[:-1]) for r in rows], names)
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array([int(h)], pa.int64()) for h in held], names)

    by_doc = found.select("doc_id", "pos", "end").repartition("doc_id").sortWithinPartitions("doc_id", "pos")
    return by_doc.mapInArrow(merged, "doc_id long, start_word long, end_word long")
