"""Repeated passages found by distributed prefix doubling.

The suffixes are those that start at a word. The first rank of a suffix is a hash of its
first ``base`` words, which needs no sort. Then, at growing offsets, Spark sorts the pairs
(rank of a position, rank of the position ``offset`` words on) and ranks them anew; each
round about doubles the words that a rank stands for, up to the threshold. A position whose
rank is unique is dropped, for nothing that starts there can repeat.

Sorting all suffixes of a corpus only to drop most of them in the first round would cost many
times its size. So the first round looks at sampled suffixes: of each window the one of least
hash (see ``repeats``). A window whose sampled suffix is unique at ``gram`` words is unique.

Texts that are equal as a whole would take part in every round only to end as one span each.
They are told by a hash of all their words; the first of them stands for the others, which get
the whole of their words as their span.

Rows with a null doc_id or text have no passages. A text of fewer words than the threshold
has none either. Equal rows, and rows that share a doc_id, count as copies of each other.
Columns other than doc_id and text are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.lineage import cut
from . import arrays as A
from . import repeats as R

THRESHOLD = 50
BASE = 10
GRAM = 26
#: Ranks are dense within a bucket of pairs: rank = bucket * 2**40 + place in the bucket.
BUCKETS = 4096


def offsets(base: int, threshold: int) -> list[int]:
    """Offsets that take a rank of ``base`` words to one of ``threshold`` words."""
    out, have = [], base
    while have < threshold:
        out.append(min(have, threshold - have))
        have += out[-1]
    return out


def _whole(words: A.Words) -> np.ndarray:
    return A.Prefix(words.hash, A.MULT_A).ranges(words.first[:-1], words.first[1:])


def _row_key(ids: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return A.mix(A.mix(ids.astype(np.int64).view(A.U64)) ^ whole)


def whole_copies(docs: DataFrame, threshold: int) -> DataFrame:
    """Rows whose words are those of another document: (doc_id, n, key, rep); rep is the first such doc_id."""

    def each(batches):
        for ids, words, _ in R.each_piece(batches):
            n = np.diff(words.first)
            some = n >= threshold
            h = _whole(words)
            other = A.Prefix(words.hash, A.MULT_B).ranges(words.first[:-1], words.first[1:])
            yield pa.RecordBatch.from_arrays([A.longs(x[some]) for x in (ids, n, h, other, _row_key(ids, h))], ["doc_id", "n", "h1", "h2", "key"])

    rows = docs.mapInArrow(each, "doc_id long, n long, h1 long, h2 long, key long")
    same = Window.partitionBy("h1", "h2", "n")
    return rows.withColumn("rep", F.min("doc_id").over(same)).withColumn("last", F.max("doc_id").over(same)).where("rep <> last").select("doc_id", "n", "key", "rep")


def sampled_suffixes(docs: DataFrame, threshold: int, gram: int, keep=None) -> DataFrame:
    """Hashes of the sampled suffixes' first ``gram`` words that occur more than once in the corpus."""

    def sample(batches):
        for ids, words, _ in R.each_piece(batches):
            w = R.Windows(words, threshold, gram, keep(ids, words) if keep else None)
            if len(w.pos):
                yield pa.RecordBatch.from_arrays([A.longs(w.anchor[w.new])], ["h"])

    return docs.mapInArrow(sample, "h long").groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h")


def rerank(pairs: DataFrame) -> DataFrame:
    """Positions (doc_id, pos, later) with the rank of their pair (r1, r2), without unique pairs."""
    pairs = pairs.withColumn("bucket", F.pmod(F.hash("r1", "r2"), F.lit(BUCKETS)))
    order = Window.partitionBy("bucket").orderBy("r1", "r2")
    first = F.col("r1").eqNullSafe(F.lag("r1").over(order)) & F.col("r2").eqNullSafe(F.lag("r2").over(order))
    again = F.col("r1").eqNullSafe(F.lead("r1").over(order)) & F.col("r2").eqNullSafe(F.lead("r2").over(order))
    ranked = pairs.withColumn("rank", F.dense_rank().over(order)).withColumn("prev", first).withColumn("next", again)
    return ranked.where("prev or next").select("doc_id", "pos", (F.col("bucket").cast("long") * (1 << 40) + F.col("rank")).alias("rank"))


def _without(copies: DataFrame, limit: int):
    """A test for the rows that take part: all but the copies, if their keys take at most ``limit``
    bytes. Beyond that all take part, with the same result."""
    away = copies.where("doc_id <> rep").select("key").distinct()
    if away.count() * 8 > limit:
        return None
    keys = np.array([r.key for r in away.toLocalIterator()], np.int64).view(A.U64)
    shared = copies.sparkSession.sparkContext.broadcast(np.sort(keys))

    def keep(ids, words):
        known = shared.value
        if not len(known):
            return None
        key = _row_key(ids, _whole(words))
        return known[np.minimum(np.searchsorted(known, key), len(known) - 1)] != key

    return keep


def repeated_positions(docs: DataFrame, threshold: int = THRESHOLD, base: int = BASE, gram: int = GRAM, limit: int = R.BROADCAST_BYTES, keep=None) -> DataFrame:
    """(doc_id, pos, rank): positions whose next ``threshold`` words occur elsewhere; equal passages have
    equal ranks. ``keep`` may say which rows take part."""
    docs = R.usable(docs)
    width = R.sketch_width(docs, threshold, gram)
    cell = F.col("h").bitwiseAND(F.lit(width - 1))
    hot = sampled_suffixes(docs, threshold, gram, keep).select(cell.alias("cell"))
    first, *rest = offsets(base, threshold)

    def emit(ids, w, ok):
        at, row = w.at[ok], w.row[ok]
        # Every word of a chosen window may be asked for at a later offset.
        return pa.RecordBatch.from_arrays([A.longs(ids[row]), pa.array(w.pos[ok].astype(np.int32)), A.longs(w.hash.ranges(at, at + base)), A.longs(w.hash.ranges(at + first, at + first + base))], ["doc_id", "pos", "r1", "r2"])

    def emit_all(ids, w, ok):
        n = len(w.words.start)
        need = np.zeros(n + 1, np.int64)
        reach = threshold - base - first
        begin = w.at[ok]
        np.add.at(need, begin, 1)
        np.add.at(need, begin + reach + 1, -1)
        at = np.flatnonzero(np.cumsum(need[:-1]) > 0)
        row = np.searchsorted(w.words.first, at, side="right") - 1
        return pa.RecordBatch.from_arrays(
            [A.longs(ids[row]), pa.array((at - w.words.first[row]).astype(np.int32)), A.longs(w.hash.ranges(at, at + base)), A.longs(w.hash.ranges(at + first, at + first + base))], ["doc_id", "pos", "r1", "r2"]
        )

    schema = "doc_id long, pos int, r1 long, r2 long"
    ranked = rerank(R.candidates(docs, hot, width, 1, threshold, gram, emit_all if rest else emit, schema, limit, keep))
    for off in rest:
        ahead = Window.partitionBy("doc_id").orderBy("pos").rangeBetween(off, off)
        pairs = ranked.withColumn("r2", F.max("rank").over(ahead)).where("r2 is not null")
        ranked = rerank(pairs.select("doc_id", "pos", F.col("rank").alias("r1"), "r2"))
    return ranked


def repeated_passages(docs: DataFrame, threshold: int = THRESHOLD, base: int = BASE, gram: int = GRAM, limit: int = R.BROADCAST_BYTES) -> DataFrame:
    """Every longest run of repeated positions, with its words: (doc_id, start_word, end_word).

    ``threshold``: words of the shortest passage. ``base``: words of the first rank; ``gram``: words by
    which sampled suffixes are compared; ``limit``: bytes that may be broadcast at once."""
    copies = cut(whole_copies(R.usable(docs), threshold))
    found = repeated_positions(docs, threshold, base, gram, limit, _without(copies, limit))
    windows = found.select("doc_id", F.col("pos").cast("long").alias("pos"), (F.col("pos").cast("long") + threshold).alias("end"))
    return R.union(windows.unionByName(copies.select("doc_id", F.lit(0).cast("long").alias("pos"), F.col("n").alias("end"))))


SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(text, '[^\t\n\x0B\f\r ]+') AS t FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL),
p AS (SELECT doc_id, i::BIGINT - 1 AS pos, array_to_string(t[i:i + 49], ' ') AS s FROM (SELECT *, unnest(range(1, len(t) - 48)) AS i FROM w WHERE len(t) >= 50)),
n AS (SELECT doc_id, pos, count(*) OVER (PARTITION BY s) AS n FROM p),
d AS (SELECT DISTINCT doc_id, pos FROM n WHERE n > 1),
b AS (SELECT *, CASE WHEN pos <= lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) + 50 THEN 0 ELSE 1 END AS new FROM d),
g AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY pos) AS g FROM b)
SELECT doc_id, min(pos)::BIGINT AS start_word, (max(pos) + 50)::BIGINT AS end_word FROM g GROUP BY doc_id, g
"""
