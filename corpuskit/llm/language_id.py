"""Language identification with a byte-level convolutional network.

A text is cut into windows of ``WINDOW`` bytes, the last one padded. Bytes are embedded; filters
of several widths run over each window; the largest answer of each filter goes to a softmax. The
answers of a text's windows are averaged by their bytes. All of it is numpy, in training and use.

The network is trained on a sample of at most ``train_rows`` labelled rows, as many of each label, chosen by a
hash of doc_id, so that rare labels are learned too (of over ``train_rows`` labels the most frequent), and on made-up windows of class "und" (digits, signs, random letters, other scripts). A text
is rejected if its likeliest class is "und", if its probability is below ``least``, or if the text
is null or has no letter. A null or unknown label isn't trained on; a table without labels rejects
all. The sample doesn't depend on the order of rows; equal rows may both be in it, and of rows with equal hashes
those of lesser texts come first. Of equal probabilities the first class by name counts. Texts of any length
are read whole. An empty table gives an empty result. Other columns pass through ``keep_identified`` and are ignored by ``identify``.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import arrays as A

WINDOW = 256
EMBED = 8
WIDTHS = (2, 3, 4, 5)
FILTERS = 12
WIDEST = max(WIDTHS)
TRAIN_ROWS = 1600
STEPS = 500
BATCH = 96
LEAST = 0.4
UNKNOWN = "und"


def windows(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows (padded for the widest filter), the row of each and its bytes."""
    sizes = np.diff(offs)
    count = -(-sizes // WINDOW)
    row = np.repeat(np.arange(len(sizes)), count)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    start = offs[row] + nth * WINDOW
    size = np.minimum(WINDOW, offs[row + 1] - start)
    place = np.arange(WINDOW + WIDEST - 1)
    at = np.minimum(start[:, None] + place, max(len(buf) - 1, 0))
    out = np.where(place < size[:, None], buf[at] if len(buf) else 0, 0).astype(np.uint8)
    return out, row, size


class Network:
    def __init__(self, labels: list[str], seed: int = 0):
        rng = np.random.default_rng(seed)
        self.labels = labels
        n = FILTERS * len(WIDTHS)
        self.emb = rng.normal(0, 0.5, (256, EMBED)).astype(np.float32)
        self.emb[0] = 0
        #: Which weights a filter has: those of its own width.
        self.used = np.concatenate([np.repeat((np.arange(WIDEST) < w).astype(np.float32)[:, None], EMBED, 1).reshape(-1, 1).repeat(FILTERS, 1) for w in WIDTHS], axis=1)
        self.conv = (rng.normal(0, 0.25, (WIDEST * EMBED, n)).astype(np.float32)) * self.used
        self.bias = np.zeros(n, np.float32)
        self.out = rng.normal(0, 0.2, (n, len(labels))).astype(np.float32)
        self.shift = np.zeros(len(labels), np.float32)

    def _patches(self, x: np.ndarray) -> np.ndarray:
        e = self.emb[x]
        view = np.lib.stride_tricks.as_strided(e, (len(x), WINDOW, WIDEST * EMBED), (e.strides[0], e.strides[1], e.itemsize))
        return np.ascontiguousarray(view)

    def _softmax(self, h: np.ndarray) -> np.ndarray:
        z = h @ self.out + self.shift
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def predict(self, x: np.ndarray, chunk: int = 48) -> np.ndarray:
        """Class probabilities of each window."""
        got = np.empty((len(x), len(self.labels)), np.float32)
        for at in range(0, len(x), chunk):
            answers = self._patches(x[at : at + chunk]).reshape(-1, WIDEST * EMBED) @ self.conv
            best = answers.reshape(-1, WINDOW, answers.shape[1]).max(axis=1)
            got[at : at + chunk] = self._softmax(np.maximum(best + self.bias, 0))
        return got

    def fit(self, x: np.ndarray, y: np.ndarray, steps: int = STEPS, batch: int = BATCH, rate: float = 0.004, seed: int = 1) -> Network:
        rng = np.random.default_rng(seed)
        names = ("emb", "conv", "bias", "out", "shift")
        m = {k: np.zeros_like(getattr(self, k)) for k in names}
        v = {k: np.zeros_like(getattr(self, k)) for k in names}
        by_class = [np.flatnonzero(y == c) for c in range(len(self.labels))]
        by_class = [c for c in by_class if len(c)]
        for step in range(1, steps + 1):
            pick = np.concatenate([rng.choice(c, -(-batch // len(by_class))) for c in by_class])
            xb, yb = x[pick], y[pick]
            n = len(pick)
            patches = self._patches(xb)
            answers = (patches.reshape(-1, WIDEST * EMBED) @ self.conv).reshape(n, WINDOW, -1)
            where = answers.argmax(axis=1)  # (n, filters)
            best = np.take_along_axis(answers, where[:, None, :], 1)[:, 0] + self.bias
            h = np.maximum(best, 0)
            p = self._softmax(h)
            p[np.arange(n), yb] -= 1
            p /= n
            back = (p @ self.out.T) * (best > 0)
            chosen = patches[np.arange(n)[:, None], where]  # (n, filters, patch)
            grad = {"out": h.T @ p, "shift": p.sum(0), "bias": back.sum(0), "conv": np.einsum("nfp,nf->pf", chosen, back) * self.used}
            to_patch = back[:, :, None] * self.conv.T[None]  # (n, filters, patch)
            bytes_at = xb[np.arange(n)[:, None, None], where[:, :, None] + np.arange(WIDEST)]
            emb = np.zeros_like(self.emb)
            np.add.at(emb, bytes_at.ravel(), to_patch.reshape(-1, EMBED))
            emb[0] = 0
            grad["emb"] = emb
            for k in names:
                m[k] = 0.9 * m[k] + 0.1 * grad[k]
                v[k] = 0.999 * v[k] + 0.001 * grad[k] ** 2
                now = rate * (1 - 0.9 * step / steps)
                setattr(self, k, (getattr(self, k) - now * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32))
        return self


def unknown_windows(n: int, seed: int = 2) -> np.ndarray:
    """Made-up texts that are in no language that is told apart."""
    rng = np.random.default_rng(seed)
    sets = ["0123456789 .,-:/", "0123456789abcdef", "!\"#$%&'()*+,-./:;<=>?@[]^_`{|}~ ", "bcdfghjklmnpqrstvwxz    ", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/=", "абвгдежзийклмнопрстуфхцчшщъыьэюя  ", "αβγδεζηθικλμνξοπρστυφχψω  ", "的一是不了人我在有他这为之大来以个中上们", "アイウエオカキクケコさしすせそたちつてと"]
    texts = ["".join(rng.choice(list(sets[i % len(sets)]), int(rng.integers(20, WINDOW)))) for i in range(n)]
    return windows(*A.flat(pa.array(texts, pa.large_string())))[0]


def training_rows(docs: DataFrame, most: int) -> list:
    """At most ``most`` labelled rows, of each label those of least hash."""
    labelled = docs.where("lang is not null and text is not null and doc_id is not null").select(F.xxhash64(F.col("doc_id").cast("long")).alias("h"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    labels = [r.lang for r in labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(most).collect()]
    if not labels:
        return []
    each = most // len(labels)
    # Ranks are limited within each partition before rows are moved.
    at = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    ranked = labelled.select("lang", "h").where(F.col("lang").isin(labels)).withColumn("at", at).where(F.col("at") <= each)
    last = {r.lang: r.h for r in ranked.groupBy("lang").agg(F.max("h").alias("h")).collect()}
    upto = F.create_map(*[F.lit(x) for pair in last.items() for x in pair])[F.col("lang")]
    out, seen = [], Counter()
    for r in labelled.where(F.col("h") <= upto).orderBy("lang", "h", "text").limit(2 * most).collect():
        seen[r.lang] += 1
        if seen[r.lang] <= each:
            out.append(r)
    return sorted(out, key=lambda r: (r.h, r.text))


def train(docs: DataFrame, train_rows: int = TRAIN_ROWS, steps: int = STEPS) -> Network | None:
    rows = training_rows(docs, train_rows)
    if not rows:
        return None
    labels = sorted({r.lang for r in rows} - {UNKNOWN})
    x, row, _ = windows(*A.flat(pa.array([r.text for r in rows], pa.large_string())))
    y = np.array([labels.index(r.lang) if r.lang in labels else len(labels) for r in rows])[row]
    made = unknown_windows(max(64, len(rows) // 2))
    return Network([*labels, UNKNOWN]).fit(np.concatenate([x, made]), np.concatenate([y, np.full(len(made), len(labels))]), steps)


def classify(net: Network, texts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
    """The class of each text, as an index of labels, and its probability."""
    buf, offs = A.flat(texts)
    last = len(net.labels) - 1
    total = np.zeros((len(texts), last + 1))
    x, row, size = windows(buf, offs)
    if len(x):
        np.add.at(total, row, net.predict(x) * size[:, None])
    total /= np.maximum(np.diff(offs), 1)[:, None]
    which = total.argmax(axis=1)
    letters = np.concatenate(([0], np.cumsum(A.ALNUM[buf] & ~((buf >= 48) & (buf < 58)))))
    which[letters[offs[1:]] == letters[offs[:-1]]] = last
    return which, total[np.arange(len(texts)), which]


def identify(docs: DataFrame, train_rows: int = TRAIN_ROWS, least: float = LEAST) -> DataFrame:
    """(doc_id, language, confidence, accepted) of every document."""
    net = train(docs, train_rows)
    shared = docs.sparkSession.sparkContext.broadcast(net)

    @A.lean
    def each(batches):
        net = shared.value
        for batch in batches:
            texts = A.text_column(batch, "text")
            for a, b in A.pieces(texts):
                if net is None:
                    which, sure, names = np.zeros(b - a, int), np.zeros(b - a), [UNKNOWN]
                else:
                    (which, sure), names = classify(net, texts[a:b]), net.labels
                ok = (which < len(names) - 1) & (sure >= least)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(np.array(names)[which].tolist(), pa.string()), pa.array(np.round(sure.astype(np.float64), 6)), pa.array(ok)], ["doc_id", "language", "confidence", "accepted"])

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(each, "doc_id long, language string, confidence double, accepted boolean")


def keep_identified(docs: DataFrame, train_rows: int = TRAIN_ROWS, least: float = LEAST) -> DataFrame:
    """The documents that aren't rejected, with all their columns."""
    net = train(docs, train_rows)
    shared = docs.sparkSession.sparkContext.broadcast(net)

    @A.lean
    def each(batches):
        net = shared.value
        for batch in batches:
            texts = A.text_column(batch, "text")
            for a, b in A.pieces(texts):
                if net is not None:
                    which, sure = classify(net, texts[a:b])
                    yield batch.slice(a, b - a).filter(pa.array((which < len(net.labels) - 1) & (sure >= least)))

    return docs.mapInArrow(each, docs.schema)
