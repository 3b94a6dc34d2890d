"""Approximate nearest neighbours with one small-world graph per shard.

Vectors are hashed into shards. Each shard has a hierarchical navigable small-world graph: layers of
ever fewer nodes, each node linked to diverse near nodes that came before it and to those after it
that chose it. Nodes are inserted in blocks: a block descends through the layers as it would in a
search, keeps the nearest nodes that the walk meets in each of its layers, and adds the earlier nodes
of its own block, which the walk can't meet. A shard is stored as flat arrays: ids, vectors, and for each
layer its nodes and their neighbours, a fixed number a node, padded with -1.

Queries go to the shards, not shards to the queries: a task loads one graph and streams all queries
past it. The k best of every shard are merged. Unless ``shards`` is given there are sqrt(n) / 32 of
them, and so many more that none holds over 2**18 vectors: inserting costs n log n, searching a query
sqrt(n) / 32 short walks.

Similarity is the cosine. Rows are left out if their id or vector is null, if the vector has a null,
an infinite or no number, is zero, or isn't of the most usual length (the shorter on a tie). Rows that
share an id count as one, with the least vector. A vector isn't its own neighbour; equal vectors of other ids
are. Equal scores are ordered by id. With fewer than k others all are returned. Other columns are ignored. An
empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.lineage import cut

#: Vectors that a shard holds at most; with 64 dimensions its arrays take about 100 MB.
MOST_IN_SHARD = 1 << 18
LINKS = 16
CANDIDATES = 64
BEAM = 64
K = 10
#: Of the searching query: every hundredth vector is looked for.
EVERY = 100
BLOCK = 256


def diverse(near: np.ndarray, scores: np.ndarray, vectors: np.ndarray, most: int) -> np.ndarray:
    """Of candidates in order of score (rows of ``near``, -1 for none) up to ``most``: first those that are
    nearer to the node than to any chosen one, then the nearest of the others; padded with -1."""
    n, c = near.shape
    own = vectors[np.maximum(near, 0)]
    among = own @ own.transpose(0, 2, 1)
    chosen = np.zeros((n, c), bool)
    closest = np.full((n, c), -np.inf, np.float32)
    count = np.zeros(n, np.int64)
    for j in range(c):
        take = (near[:, j] >= 0) & (closest[:, j] < scores[:, j]) & (count < most)
        chosen[:, j] = take
        count += take
        np.maximum(closest, among[:, j], out=closest, where=take[:, None])
    order = np.argsort(np.where(near < 0, 2, np.where(chosen, 0, 1)) * c + np.arange(c), axis=1)[:, :most]
    out = np.take_along_axis(near, order, 1)
    return np.pad(out, ((0, 0), (0, most - out.shape[1])), constant_values=-1)


class Layer:
    """Nodes (numbers within the shard, ascending), their vectors, and the neighbours of each as places in the layer."""

    def __init__(self, nodes: np.ndarray, vectors: np.ndarray, graph: np.ndarray):
        self.nodes, self.vectors, self.graph = nodes, vectors, graph

    def descend(self, queries: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where walking to ever nearer neighbours ends, from place ``at`` of each query."""
        at = at.copy()
        score = np.einsum("qd,qd->q", self.vectors[at], queries)
        live = np.arange(len(queries))
        while len(live):
            near = self.graph[at[live]]
            s = np.where(near >= 0, np.einsum("qcd,qd->qc", self.vectors[np.maximum(near, 0)], queries[live]), -np.inf)
            best = s.argmax(axis=1)
            top = s[np.arange(len(live)), best]
            better = top > score[live]
            live = live[better]
            at[live], score[live] = near[better, best[better]], top[better]
        return at

    def beam(self, queries: np.ndarray, at: np.ndarray, beam: int, step: int = 8) -> tuple[np.ndarray, np.ndarray]:
        """Places (-1: none) and scores of about the ``beam`` nearest of each query, best first."""
        q, n = len(queries), len(self.nodes)
        step = min(step, beam)
        seen = np.zeros((q, n + 1), bool)
        seen[:, n] = True
        rows = np.arange(q)
        ids = np.full((q, beam), n, np.int64)
        score = np.full((q, beam), -np.inf, np.float32)
        open_ = np.zeros((q, beam), bool)
        ids[:, 0], open_[:, 0] = at, True
        score[:, 0] = np.einsum("qd,qd->q", self.vectors[at], queries)
        seen[rows, at] = True
        live = rows
        while True:
            s = np.where(open_[live], score[live], -np.inf)
            pick = np.argpartition(-s, step - 1, axis=1)[:, :step]
            fine = np.take_along_axis(s, pick, 1) > -np.inf
            more = fine.any(axis=1)
            live, pick, fine = live[more], pick[more], fine[more]
            if not len(live):
                break
            opened = open_[live]
            np.put_along_axis(opened, pick, False, 1)
            chosen = np.where(fine, ids[live[:, None], pick], -1)
            near = np.where(chosen[:, :, None] >= 0, self.graph[np.maximum(chosen, 0)], -1).reshape(len(live), -1)
            near = np.where(near < 0, n, near)
            near[seen[live[:, None], near]] = n
            near = np.sort(near, axis=1)
            near = near[:, : max(1, int((near < n).sum(axis=1).max()))]
            near[:, 1:][near[:, 1:] == near[:, :-1]] = n
            seen[live[:, None], near] = True
            new = (self.vectors[np.minimum(near, n - 1)] @ queries[live][:, :, None])[:, :, 0]
            new = np.where(near < n, new, -np.inf)
            all_ids = np.concatenate([ids[live], near], axis=1)
            all_scores = np.concatenate([score[live], new], axis=1)
            all_open = np.concatenate([opened, near < n], axis=1)
            best = np.argpartition(-all_scores, beam - 1, axis=1)[:, :beam]
            ids[live] = np.take_along_axis(all_ids, best, 1)
            score[live] = np.take_along_axis(all_scores, best, 1)
            open_[live] = np.take_along_axis(all_open, best, 1)
        order = np.lexsort((ids, -score), axis=1)
        ids, score = np.take_along_axis(ids, order, 1), np.take_along_axis(score, order, 1)
        return np.where(np.isfinite(score), ids, -1), score

    def link(self, lo: int, hi: int, found: np.ndarray, scores: np.ndarray, links: int) -> None:
        """Link the places from lo to hi to diverse ones of what the walk found (-1: none) and of the places
        between lo and themselves, and these back, pruned where there is no more room."""
        own, room = self.vectors[lo:hi], self.graph.shape[1]
        among = own @ own.T
        among[np.arange(hi - lo)[None, :] >= np.arange(hi - lo)[:, None]] = -np.inf  # only earlier ones
        near = np.concatenate([found, np.broadcast_to(np.arange(lo, hi), among.shape)], axis=1)
        got = np.concatenate([np.where(found >= 0, scores, -np.inf), among], axis=1).astype(np.float32)
        c = min(CANDIDATES, near.shape[1])
        best = np.argpartition(-got, c - 1, axis=1)[:, :c]
        near, got = np.take_along_axis(near, best, 1), np.take_along_axis(got, best, 1)
        order = np.argsort(-got, axis=1, kind="stable")
        near, got = np.take_along_axis(near, order, 1), np.take_along_axis(got, order, 1)
        near = np.where(np.isfinite(got), near, -1)
        mine = np.concatenate([diverse(near[at : at + 64], got[at : at + 64], self.vectors, links) for at in range(0, len(near), 64)])
        self.graph[lo:hi, :links] = mine
        to = mine.ravel()
        source = np.repeat(np.arange(lo, hi), links)[to >= 0]
        to = to[to >= 0]
        order = np.argsort(to, kind="stable")
        to, source = to[order], source[order]
        nodes, first, many = np.unique(to, return_index=True, return_counts=True)
        if not len(nodes):
            return
        wide = np.full((len(nodes), room + int(many.max())), -1, np.int64)
        wide[:, :room] = self.graph[nodes]
        wide[np.repeat(np.arange(len(nodes)), many), room + np.arange(len(to)) - np.repeat(first, many)] = source
        for at in range(0, len(nodes), 256):
            w, each = wide[at : at + 256], nodes[at : at + 256]
            used = w >= 0
            full = used.sum(axis=1) > room
            room_left = np.argsort(~used[~full], axis=1, kind="stable")[:, :room]
            self.graph[each[~full]] = np.take_along_axis(w[~full], room_left, 1)
            if full.any():
                w, each = w[full], each[full]
                s = np.where(w >= 0, np.einsum("ncd,nd->nc", self.vectors[np.maximum(w, 0)], self.vectors[each]), -np.inf)
                order = np.argsort(-s, axis=1, kind="stable")
                self.graph[each] = diverse(np.take_along_axis(w, order, 1), np.take_along_axis(s, order, 1), self.vectors, room)


class Graph:
    def __init__(self, ids: np.ndarray, vectors: np.ndarray, layers: list[Layer]):
        self.ids, self.vectors, self.layers = ids, vectors, layers

    @classmethod
    def build(cls, ids: np.ndarray, vectors: np.ndarray, links: int = LINKS, candidates: int = CANDIDATES, seed: int = 7) -> Graph:
        order = np.argsort(ids, kind="stable")
        ids, vectors = ids[order], np.ascontiguousarray(vectors[order])
        level = np.floor(-np.log(1 - np.random.default_rng(seed).random(len(ids))) / np.log(links)).astype(int)
        layers = []
        for at in range(int(level.max(initial=0)) + 1):
            nodes = np.flatnonzero(level >= at).astype(np.int32)
            layers.append(Layer(nodes, vectors[nodes] if at else vectors, np.full((len(nodes), links * (1 if at else 2)), -1, np.int32)))
        out = cls(ids, vectors, layers)
        for lo in range(0, len(ids), BLOCK):
            out._insert(lo, min(len(ids), lo + BLOCK), level, links, candidates)
        return out

    def _insert(self, lo: int, hi: int, level: np.ndarray, links: int, candidates: int) -> None:
        """Insert the nodes from lo to hi: from the top layer down, first those that aren't in a layer walk
        through it, then those that are look for their neighbours there."""
        queries, at = self.vectors[lo:hi], None
        for depth in range(len(self.layers) - 1, -1, -1):
            layer = self.layers[depth]
            a, b = np.searchsorted(layer.nodes, (lo, hi))
            inside = np.flatnonzero(level[lo:hi] >= depth)
            found, scores = np.zeros((b - a, 0), np.int64), np.zeros((b - a, 0), np.float32)
            if a:  # some node was there before
                place = np.zeros(hi - lo, np.int64) if at is None else np.searchsorted(layer.nodes, at)
                outside = np.flatnonzero(level[lo:hi] < depth)
                if len(outside):
                    place[outside] = layer.descend(queries[outside], place[outside])
                if b > a:
                    found, scores = layer.beam(queries[inside], place[inside], candidates)
                    place[inside] = found[:, 0]
                at = layer.nodes[place]
            if b > a:
                layer.link(a, b, found, scores, links)

    def flat(self) -> dict:
        return {
            "ids": self.ids.tobytes(),
            "vectors": self.vectors.tobytes(),
            "nodes": [layer.nodes.tobytes() for layer in self.layers],
            "neighbours": [layer.graph.tobytes() for layer in self.layers],
        }

    @classmethod
    def of(cls, ids: bytes, vectors: bytes, nodes: list[bytes], neighbours: list[bytes]) -> Graph:
        i = np.frombuffer(ids, np.int64)
        v = np.frombuffer(vectors, np.float32).reshape(len(i), -1)
        layers = []
        for a, b in zip(nodes, neighbours):
            n = np.frombuffer(a, np.int32)
            layers.append(Layer(n, v[n] if layers else v, np.frombuffer(b, np.int32).reshape(len(n), -1)))
        return cls(i, v, layers)

    def search(self, queries: np.ndarray, k: int, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
        """Nodes (-1: none) and scores of about the k nearest of each query, best first."""
        at = np.zeros(len(queries), np.int64)
        for depth in range(len(self.layers) - 1, 0, -1):
            layer = self.layers[depth]
            at = np.searchsorted(self.layers[depth - 1].nodes, layer.nodes[layer.descend(queries, at)])
        nodes, score = self.layers[0].beam(queries, at, max(beam, k))
        return nodes[:, :k], score[:, :k]


def usable(table: DataFrame, id_column: str, column: str) -> DataFrame:
    """(id, v): unit vectors of the most usual length, one for each id."""
    rows = table.select(F.col(id_column).cast("long").alias("id"), F.col(column).cast("array<double>").alias("v")).where("id is not null and v is not null and size(v) > 0")
    rows = rows.where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    rows = rows.groupBy("id").agg(F.min("v").alias("v"))
    usual = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").select("d").first()
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    return rows.where(F.size("v") == (usual.d if usual else 0)).withColumn("norm", norm).where("norm > 0").select("id", F.transform("v", lambda x: x / F.col("norm")).cast("array<float>").alias("v"))


def _matrix(column: pa.ChunkedArray | pa.Array, n: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten()).astype(np.float32).reshape(n, -1)


INDEX = "shard int, ids binary, vectors binary, nodes array<binary>, neighbours array<binary>"


def shard_count(n: int) -> int:
    return max(1, math.ceil(math.sqrt(n) / 32), -(-n // MOST_IN_SHARD))


def build_index(vectors: DataFrame, shards: int, links: int = LINKS, candidates: int = CANDIDATES) -> DataFrame:
    """One row a shard, with the flat arrays of its graph, from (id, v)."""

    def build(key, table):
        g = Graph.build(np.asarray(table.column("id")), _matrix(table.column("v"), table.num_rows), links, candidates)
        flat = g.flat()
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "ids": pa.array([flat["ids"]], pa.binary()), "vectors": pa.array([flat["vectors"]], pa.binary()), "nodes": pa.array([flat["nodes"]], pa.list_(pa.binary())), "neighbours": pa.array([flat["neighbours"]], pa.list_(pa.binary()))})

    of = vectors.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int"))
    return of.groupBy("shard").applyInArrow(build, INDEX)


def search(index: DataFrame, shards: int, queries: DataFrame, k: int = K, beam: int = BEAM) -> DataFrame:
    """(id, neighbour, score, rank) for queries (id, v) over all shards of an index."""

    def each(batches):
        g = None
        for batch in batches:
            graphs = np.flatnonzero(~np.asarray(batch.column(1).is_null()))
            for at in graphs.tolist():  # the first row of the task
                g = Graph.of(*(batch.column(c)[at].as_py() for c in range(1, 5)))
            part = batch.filter(batch.column(0).is_valid())
            if g is None or not part.num_rows:
                continue
            ids, v = np.asarray(part.column(0)), _matrix(part.column(5), part.num_rows)
            for at in range(0, len(ids), BLOCK):
                mine = ids[at : at + BLOCK]
                node, score = g.search(v[at : at + BLOCK], k + 1, beam)
                other = np.where(node >= 0, g.ids[np.maximum(node, 0)], mine[:, None])
                ok = other != mine[:, None]
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(mine, ok.sum(axis=1))), pa.array(other[ok]), pa.array(score[ok].astype(np.float64))], ["id", "neighbour", "score"])

    graphs = index.select("shard", F.lit(None).cast("long").alias("id"), "ids", "vectors", "nodes", "neighbours", F.lit(None).cast("array<float>").alias("v"))
    none = [F.lit(None).cast(t).alias(c) for c, t in (("ids", "binary"), ("vectors", "binary"), ("nodes", "array<binary>"), ("neighbours", "array<binary>"))]
    asked = queries.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), "id", *none, "v")
    # A partition for each shard: its graph comes first, then all queries.
    dealt = graphs.unionByName(asked).repartitionById(shards, "shard").sortWithinPartitions("id")
    found = dealt.drop("shard").mapInArrow(each, "id long, neighbour long, score double")
    best = Window.partitionBy("id").orderBy(F.desc("score"), "neighbour")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("id", "neighbour", F.round("score", 6).alias("score"), "rank")


def neighbours(table: DataFrame, id_column: str = "vec_id", column: str = "embedding", k: int = K, shards: int | None = None, links: int = LINKS, candidates: int = CANDIDATES, beam: int = BEAM, every: int = EVERY) -> DataFrame:
    """The k nearest others of every vector whose id is divisible by ``every``: (vec_id, neighbour_id, score, rank).

    All vectors are indexed. ``links``: links a node makes in each layer; ``candidates``: nodes held while
    a place for a new node is sought, ``beam``: in a search (more: better and slower)."""
    vectors = cut(usable(table, id_column, column))
    shards = shards or shard_count(vectors.count())
    index = build_index(vectors, shards, links, candidates)
    asked = vectors.where(F.pmod("id", F.lit(every)) == 0)
    return search(index, shards, asked, k, beam).select(F.col("id").alias("vec_id"), F.col("neighbour").alias("neighbour_id"), "score", "rank")
