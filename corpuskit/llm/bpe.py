"""Byte-level BPE encoding and decoding with a two-tier lookup.

Texts are split into pre-tokens by the usual pattern of byte-level vocabularies
(contractions, letters, digits, other signs, blanks), worked out on arrays of character classes.
First tier: a minimal perfect hash over the vocabulary resolves every pre-token that is a token
as a whole. Second tier: what misses is merged by a heap over a linked list of its bytes; the
outcome is kept for the next time, for a bounded number of pre-tokens.

The vocabulary is a file of "base64 rank" lines; it is read on the driver and its size is that of
the vocabulary, not of the data. It must hold all 256 single bytes. A null text has null ids and
decodes to null; an empty one has none and decodes to the empty text. Texts of any length are
encoded whole. Rows are encoded each for itself, so repeated rows and ids don't matter; doc_id may be null. An
empty table gives an empty result. Other columns are ignored, whatever they are called. In decoding a null id or
one outside the vocabulary stands for U+FFFD, as do bytes that don't form UTF-8.

The file is named by a parameter or by the setting ``spark.corpuskit.vocabulary``.
"""

from __future__ import annotations

import base64
import heapq
import unicodedata
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrays as A

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Pre-tokens whose merges a worker remembers.
REMEMBERED = 200_000
#: Bytes of text worked on at once; the arrays for them take many times as much memory.
PIECE = 1 << 18
SPACE, LETTER, DIGIT, OTHER = range(4)
_CLASSES: list[np.ndarray] = []


def classes() -> np.ndarray:
    """The class of every code point."""
    if not _CLASSES:
        kinds = {"L": LETTER, "N": DIGIT}
        table = np.array([kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)], np.int8)
        table[[*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]] = SPACE
        _CLASSES.append(table)
    return _CLASSES[0]


def pre_tokens(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte and end of each pre-token, in order, and the first pre-token of each row."""
    at = np.flatnonzero((buf & 0xC0) != 0x80)
    n = len(at)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    points = np.frombuffer(buf.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    kind = classes()[points]
    rows = np.searchsorted(at, offs)  # first character of each row
    new = np.ones(n + 1, bool)
    new[1:n] = kind[1:] != kind[:-1]
    new[rows] = True
    first = np.zeros(n + 1, bool)
    first[rows] = True
    edge = np.flatnonzero(new)
    begin, end = edge[:-1], edge[1:]
    what = kind[begin]
    last = first[end]  # the run ends its row
    token = np.zeros(n + 1, bool)  # where tokens start
    token[rows] = True
    blank = what == SPACE
    follows = np.ones(len(begin), bool)
    follows[1:] = last[:-1]
    # A blank before a run goes with the run if it is U+0020; other blanks but the last form a token.
    token[begin[blank]] = True
    inner = blank & ~last
    token[end[inner] - 1] = True
    solid = ~blank
    before = np.zeros(len(begin), bool)
    before[1:] = blank[:-1] & ~last[:-1] & (points[end[:-1] - 1] == 0x20)
    token[begin[solid & ~before]] = True
    # Contractions: a lone apostrophe and the letters after it.
    quote = np.flatnonzero(solid & ~before & (end - begin == 1) & (points[begin] == 0x27) & ~last)
    quote = quote[what[quote + 1] == LETTER]
    if len(quote):
        q = begin[quote]
        a = points[q + 1]
        b = np.where(end[quote + 1] - q > 2, points[np.minimum(q + 2, n - 1)], 0)
        one = np.isin(a, [ord(c) for c in "stmd"])
        two = ((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l")))
        for hit, k in ((one, 1), (two & ~one, 2)):
            token[q[hit] + 1] = False
            token[q[hit] + 1 + k] = True
    token[n] = False
    start = np.flatnonzero(token[:n])
    byte = np.append(at, len(buf))
    ends = np.append(start[1:], n)
    return byte[start], byte[ends], np.searchsorted(start, rows)


class PerfectHash:
    """A minimal perfect hash of 64-bit keys: bucket displacements, free slots for lone keys."""

    STEP = np.uint64(0xC2B2AE3D27D4EB4F)

    def __init__(self, keys: np.ndarray, per_bucket: int = 4):
        self.n = n = len(keys)
        self.buckets = max(1, n // per_bucket)
        self.shift = np.zeros(self.buckets, np.int64)
        self.slot_of = np.zeros(n, np.int64)
        home = (keys % A.U64(self.buckets)).astype(np.int64)
        order = np.argsort(home, kind="stable")
        cuts = np.searchsorted(home[order], np.arange(self.buckets + 1))
        free = np.ones(n, bool)
        sizes = np.diff(cuts)
        alone = []
        for b in np.argsort(-sizes, kind="stable"):
            mine = order[cuts[b] : cuts[b + 1]]
            if len(mine) < 2:
                alone += [(b, k) for k in mine]
                continue
            for lo in range(1, 1 << 24, 512):
                d = np.arange(lo, lo + 512)
                slots = np.sort(self._slots(keys[mine][None, :], d[:, None]), axis=1)
                ok = free[slots].all(axis=1) & (slots[:, 1:] != slots[:, :-1]).all(axis=1)
                if ok.any():
                    self.shift[b] = d[int(ok.argmax())]
                    break
            else:
                raise ValueError("keys are not distinct")
            self.slot_of[mine] = self._slots(keys[mine], self.shift[b])
            free[self.slot_of[mine]] = False
        for (b, k), slot in zip(alone, np.flatnonzero(free)):
            self.shift[b] = -1 - slot
            self.slot_of[k] = slot

    def _slots(self, keys: np.ndarray, d) -> np.ndarray:
        return (A.mix(keys ^ (np.asarray(d).astype(A.U64) * self.STEP)) % A.U64(self.n)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; any slot for one that isn't in the table."""
        d = self.shift[(keys % A.U64(self.buckets)).astype(np.int64)]
        return np.where(d < 0, -1 - d, self._slots(keys, np.maximum(d, 0)))


class Vocabulary:
    def __init__(self, tokens: dict[bytes, int]):
        if any(bytes([b]) not in tokens for b in range(256)):
            raise ValueError("the vocabulary lacks single bytes")
        self.ranks = tokens
        names = sorted(tokens, key=tokens.get)
        ids = np.array([tokens[t] for t in names])
        self.flat = np.frombuffer(b"".join(names), np.uint8)
        ends = np.cumsum([len(t) for t in names])
        starts = ends - np.array([len(t) for t in names])
        #: Place of each id's bytes in ``flat``; that of ids without a token is behind the last.
        self.start, self.length = np.zeros(ids.max() + 1, np.int64), np.zeros(ids.max() + 1, np.int64)
        self.start[ids], self.length[ids] = starts, ends - starts
        keys = A.Prefix(self.flat.astype(A.U64) + A.U64(1), A.MULT_BYTES).ranges(starts, ends)
        self.hash = PerfectHash(keys)
        self.key_at, self.id_at = np.zeros(len(ids), A.U64), np.zeros(len(ids), np.int64)
        self.key_at[self.hash.slot_of], self.id_at[self.hash.slot_of] = keys, ids
        self.made: dict[bytes, bytes] = {}
        self.unknown, other = len(self.length), "\ufffd".encode()
        self.start, self.length = np.append(self.start, len(self.flat)), np.append(self.length, len(other))
        self.start[self.length == 0], self.length[self.length == 0] = len(self.flat), len(other)
        self.flat = np.concatenate([self.flat, np.frombuffer(other, np.uint8)])

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        lines = (line.split() for line in Path(path).read_bytes().splitlines() if line.strip())
        return cls({base64.b64decode(token): int(rank) for token, rank in lines})

    def whole(self, keys: np.ndarray, buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The id of each range of bytes that is a token, -1 for the others."""
        slot = self.hash.find(keys)
        ids = np.where((self.key_at[slot] == keys) & (self.length[self.id_at[slot]] == end - start), self.id_at[slot], -1)
        hit = np.flatnonzero(ids >= 0)
        size = (end - start)[hit]
        inner = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        wrong = buf[np.repeat(start[hit], size) + inner] != self.flat[np.repeat(self.start[ids[hit]], size) + inner]
        ids[np.repeat(hit, size)[wrong]] = -1
        return ids

    def merge(self, piece: bytes) -> list[int]:
        """Merges bytes, the pair of least rank and then the leftmost first."""
        ranks, n = self.ranks, len(piece)
        prev, follow, end = list(range(-1, n - 1)), list(range(1, n + 1)), list(range(1, n + 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        gone = bytearray(n)
        while heap:
            _, i, stop = heapq.heappop(heap)
            if gone[i]:
                continue
            j = follow[i]
            if j >= n or end[j] != stop:
                continue  # either side has grown since
            end[i] = stop
            gone[j] = 1
            follow[i] = k = follow[j]
            if k < n:
                prev[k] = i
                if (r := ranks.get(piece[i : end[k]])) is not None:
                    heapq.heappush(heap, (r, i, end[k]))
            p = prev[i]
            if p >= 0 and (r := ranks.get(piece[p:stop])) is not None:
                heapq.heappush(heap, (r, p, stop))
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i : end[i]]])
            i = follow[i]
        return out

    def encode(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows and the first id of each row."""
        start, end, rows = pre_tokens(buf, offs)
        if not len(start):
            return np.zeros(0, np.int32), np.zeros(len(offs), np.int64)
        keys = A.Prefix(buf.astype(A.U64) + A.U64(1), A.MULT_BYTES).ranges(start, end)
        _, at, which = np.unique(keys, return_index=True, return_inverse=True)
        ids = self.whole(keys[at], buf, start[at], end[at])
        count = np.ones(len(at), np.int64)
        raw, missed = buf.tobytes(), np.flatnonzero(ids < 0)
        parts, made = [], self.made
        for s, e in zip(start[at[missed]].tolist(), end[at[missed]].tolist()):
            piece = raw[s:e]
            got = made.get(piece)
            if got is None:
                got = np.array(self.merge(piece), np.int32).tobytes()  # smaller than an array
                if len(made) >= REMEMBERED:
                    made.clear()
                made[piece] = got
            parts.append(got)
        count[missed] = [len(p) // 4 for p in parts]
        first = np.cumsum(count) - count
        table = np.empty(int(count.sum()), np.int32)
        one = ids >= 0
        table[first[one]] = ids[one]
        if parts:
            inside = np.ones(len(table), bool)
            inside[first[one]] = False
            table[inside] = np.frombuffer(b"".join(parts), np.int32)
        size = count[which]
        ends = np.concatenate(([0], np.cumsum(size)))
        inner = np.arange(int(ends[-1])) - np.repeat(ends[:-1], size)
        return table[np.repeat(first[which], size) + inner], ends[rows]

    def decode(self, ids: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all rows and the first byte of each row."""
        ids = np.where((ids < 0) | (ids >= self.unknown), self.unknown, ids)
        size = self.length[ids]
        ends = np.concatenate(([0], np.cumsum(size)))
        inner = np.arange(int(ends[-1])) - np.repeat(ends[:-1], size)
        return self.flat[np.repeat(self.start[ids], size) + inner], ends[rows]

    def __getstate__(self):
        return self.__dict__ | {"made": {}}


def shared_vocabulary(df: DataFrame, path: str | None):
    """The vocabulary, sent to the executors; its size doesn't depend on the data."""
    spark = df.sparkSession
    return spark.sparkContext.broadcast(Vocabulary.read(path or spark.conf.get("spark.corpuskit.vocabulary", VOCABULARY)))


def encode(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, token_ids, round_trip): round_trip says that decoding the ids gave the text."""
    shared = shared_vocabulary(docs, vocabulary)

    @A.lean
    def each(batches):
        v = shared.value
        for batch in batches:
            texts, nulls = A.text_column(batch, "text"), np.asarray(batch.column(1).is_null())
            for a, b in A.pieces(texts, PIECE):
                buf, offs = A.flat(texts[a:b])
                ids, rows = v.encode(buf, offs)
                back, begin = v.decode(ids, rows)
                same = (begin[:-1] == offs[:-1]) & (begin[1:] == offs[1:])
                if len(back) == len(buf):
                    wrong = np.flatnonzero(back != buf)
                    same[np.searchsorted(offs, wrong, side="right") - 1] = False
                null = pa.array(nulls[a:b])
                lists = pa.ListArray.from_arrays(pa.array(rows.astype(np.int32)), pa.array(ids), mask=null)
                counts = pa.array(np.diff(rows), mask=nulls[a:b])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), counts, lists, pa.array(same, mask=nulls[a:b])], ["doc_id", "n_tokens", "token_ids", "round_trip"])

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(each, "doc_id long, n_tokens long, token_ids array<int>, round_trip boolean")


def decode(encoded: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """(doc_id, text) from (doc_id, token_ids)."""
    shared = shared_vocabulary(encoded, vocabulary)

    @A.lean
    def each(batches):
        v = shared.value
        for batch in batches:
            lists = batch.column(1)
            ids = np.asarray(lists.flatten().fill_null(-1)).astype(np.int64)
            sizes = np.asarray(lists.value_lengths().fill_null(0)).astype(np.int64)
            back, begin = v.decode(ids, np.concatenate(([0], np.cumsum(sizes))))
            raw = back.tobytes()
            texts = [None if null else raw[a:b].decode("utf-8", "replace") for null, a, b in zip(lists.is_null().to_pylist(), begin[:-1].tolist(), begin[1:].tolist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "token_ids").mapInArrow(each, "doc_id long, text string")
