"""Repeated passages found with a count-min prefilter.

Every partition counts the anchors of its windows in a sparse count-min sketch; the
sketches are summed. A window whose anchor has a cell of count one in any row is
certainly unique and is dropped where its text is read. What is left is grouped
exactly, by 128 bits of hash of all its words, so that no repeated window is lost.

Rows with a null doc_id or text have no passages. A text of fewer words than a window
has none either. Equal rows, and rows that share a doc_id, count as copies of each other.
Columns other than doc_id and text are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import arrays as A
from . import repeats as R

WINDOW = 50
GRAM = 26
ROWS = 2


def partition_sketches(docs: DataFrame, width: int, rows: int, window: int, gram: int) -> DataFrame:
    """One sketch for each partition, as the cells that aren't zero: (cell, n)."""

    def count(batches):
        seen = []
        for _, words, _ in R.each_piece(batches):
            w = R.Windows(words, window, gram)
            seen.append(w.anchor[w.new])
        h = np.concatenate(seen) if seen else np.zeros(0, A.U64)
        cell, n = np.unique(np.concatenate(R.cells(h, width, rows)), return_counts=True)
        # One window has one anchor, but many windows share it: an anchor seen once stands
        # for one place in one text. Counts above one needn't be told apart.
        n = np.minimum(n, 2).astype(np.int8)
        for at in range(0, len(cell), 1 << 16):
            yield pa.RecordBatch.from_arrays([A.longs(cell[at : at + (1 << 16)]), pa.array(n[at : at + (1 << 16)])], ["cell", "n"])

    return docs.mapInArrow(count, "cell long, n byte")


def merge_sketches(sketches: DataFrame) -> DataFrame:
    """Cells whose count over all partitions is more than one."""
    return sketches.groupBy("cell").agg(F.sum("n").alias("n")).where("n > 1").select("cell")


def repeated_windows(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, rows: int = ROWS, limit: int = R.BROADCAST_BYTES) -> DataFrame:
    """(doc_id, pos, later): windows that occur again; later unless it is the first by (doc_id, pos)."""
    docs = R.usable(docs)
    width = R.sketch_width(docs, window, gram)
    hot = merge_sketches(partition_sketches(docs, width, rows, window, gram))

    def emit(ids, w, ok):
        at = w.at[ok]
        other = A.Prefix(w.words.hash, A.MULT_B)
        return pa.RecordBatch.from_arrays([A.longs(w.hash.ranges(at, at + window)), A.longs(other.ranges(at, at + window)), A.longs(ids[w.row[ok]]), pa.array(w.pos[ok].astype(np.int32))], ["h1", "h2", "doc_id", "pos"])

    found = R.candidates(docs, hot, width, rows, window, gram, emit, "h1 long, h2 long, doc_id long, pos int", limit)
    same = Window.partitionBy("h1", "h2")
    order = same.orderBy("doc_id", "pos")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .withColumn("more", F.lead(F.lit(1)).over(order))
        .where("rank > 1 or more is not null")
        .select("doc_id", "pos", (F.col("rank") > 1).alias("later"))
    )


def repeated_passages(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, rows: int = ROWS, limit: int = R.BROADCAST_BYTES) -> DataFrame:
    """Every longest run of repeated windows: (doc_id, start_word, end_word, repeated_windows, later_windows).

    ``window``: words of the shortest passage. ``gram``: words of an anchor. ``rows``: rows of the
    sketch. ``limit``: bytes of sketch that may be broadcast."""
    return R.spans(repeated_windows(docs, window, gram, rows, limit), window)


SQL = r"""
WITH w AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(text, '[^\t\n\x0B\f\r ]+') AS t FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL),
p AS (SELECT doc_id, r, i::BIGINT - 1 AS pos, array_to_string(t[i:i + 49], ' ') AS s FROM (SELECT *, unnest(range(1, len(t) - 48)) AS i FROM w WHERE len(t) >= 50)),
n AS (SELECT doc_id, pos, count(*) OVER (PARTITION BY s) AS n, row_number() OVER (PARTITION BY s ORDER BY doc_id, pos) AS k FROM p),
d AS (SELECT doc_id, pos, max((k > 1)::BIGINT) AS later FROM n WHERE n > 1 GROUP BY doc_id, pos),
b AS (SELECT *, CASE WHEN pos <= lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) + 50 THEN 0 ELSE 1 END AS new FROM d),
g AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY pos) AS g FROM b)
SELECT doc_id, min(pos)::BIGINT AS start_word, (max(pos) + 50)::BIGINT AS end_word, count(*)::BIGINT AS repeated_windows, sum(later)::BIGINT AS later_windows
FROM g GROUP BY doc_id, g
"""
