"""Centroid clustering (Lloyd's rounds in integers) by filtering centroids through kd-trees.

Vectors are turned into integers once and stand in small kd-trees, a row of the written table each: the points in tree
order, and for every node their number, integer sums and bounding box.  A round is a pass over the trees without any
shuffle of points.  Going down a tree, a centroid is dropped from a node when another is strictly nearer to every
corner of its box; a node with one centroid left is counted whole by its sums; the points of leaves are compared with
the centroids that are left there.  All of it is integer arithmetic, so ties and results are exact and the order of
tasks changes nothing.

The driver holds the centroids and one sum a cluster, nothing that grows with the rows.

Defined results: a vector takes part if it has exactly ``dims`` components, none null or not finite; others are left
out.  A component beyond ``BOUND`` after scaling counts as ``BOUND``, so distances stay in a long.  Rows that repeat an
id are vectors of their own; where such rows are first centroids, they come in the order of their components.  A
vector without an id is assigned like any other and never a first centroid.  With fewer vectors than centroids there
are as many centroids as vectors with an id; without any, every vector is in no cluster (null).  An empty table gives
an empty result.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise, scope, settle

#: Vectors of a tree and of a leaf, and the largest component.
TREE, LEAF, BOUND = 8_192, 32, 1 << 26
#: Below this size of all components, sums of squares of differences are exact in doubles.
EXACT = 1 << 21


def proper(vector: str, dims: int) -> Column:
    """True of vectors that take part."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(vector) == dims) & ~bad, F.lit(False))


def integers(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of doubles, within the bound."""
    return np.clip(np.floor(scale * values.astype(np.float64)), -BOUND, BOUND).astype(np.int32)


class Tree:
    """A balanced kd-tree: nodes in order of level, the children of ``i`` are ``2 i + 1`` and ``2 i + 2``."""

    def __init__(self, points: np.ndarray) -> None:
        n, depth = len(points), 0
        while n >> depth > LEAF:
            depth += 1
        nodes = (2 << depth) - 1
        self.bounds = np.zeros((nodes, 2), np.int64)
        order = np.arange(n)
        self.bounds[0] = 0, n
        for i in range((1 << depth) - 1):
            a, b = self.bounds[i]
            middle = (a + b) // 2
            part = points[order[a:b]]
            widest = int(np.argmax(part.max(axis=0).astype(np.int64) - part.min(axis=0))) if b > a else 0
            order[a:b] = order[a:b][np.argpartition(part[:, widest], middle - a)] if b - a > 1 else order[a:b]
            self.bounds[2 * i + 1], self.bounds[2 * i + 2] = (a, middle), (middle, b)
        self.order, self.points = order, points[order]
        self.sums = np.zeros((nodes, points.shape[1]), np.int64)
        self.low, self.high = np.zeros((nodes, points.shape[1]), np.int32), np.zeros((nodes, points.shape[1]), np.int32)
        for i in range(nodes):
            part = self.points[self.bounds[i, 0] : self.bounds[i, 1]]
            if len(part):
                self.sums[i], self.low[i], self.high[i] = part.sum(axis=0, dtype=np.int64), part.min(axis=0), part.max(axis=0)

    FIELDS = (("points", np.int32), ("sums", np.int64), ("low", np.int32), ("high", np.int32), ("bounds", np.int64))

    def pack(self) -> list[bytes]:
        return [np.ascontiguousarray(getattr(self, f), kind).tobytes() for f, kind in self.FIELDS]

    @classmethod
    def unpack(cls, bodies: list[bytes], dims: int) -> Tree:
        tree = cls.__new__(cls)
        for (f, kind), body in zip(cls.FIELDS, bodies, strict=True):
            setattr(tree, f, np.frombuffer(body, kind).reshape(-1, 2 if f == "bounds" else dims))
        return tree

    def survivors(self, nodes: np.ndarray, alive: np.ndarray, centroids: np.ndarray) -> np.ndarray:
        """Of the centroids ``alive`` at ``nodes``, those that no other dominates strictly over the whole box."""
        low, high = self.low[nodes].astype(np.int64), self.high[nodes].astype(np.int64)
        middle = ((low + high)[:, None, :] / 2 - centroids[None]) ** 2  # any of the alive may judge the rest, this is a good one
        best = np.argmin(np.where(alive, middle.sum(axis=2), np.inf), axis=1)
        near = centroids[best]
        apart = centroids[None] - near[:, None, :]
        corner = np.where(apart > 0, high[:, None, :], low[:, None, :])  # the corner that is best for the other
        farther = (apart * (centroids[None] + near[:, None, :] - 2 * corner)).sum(axis=2)
        return alive & ~(farther > 0)

    def filter(self, centroids: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``(nodes, alive)``: nodes whose points all belong to the one centroid alive, or leaves with several."""
        nodes, alive = np.zeros(1, np.int64), np.ones((1, len(centroids)), bool)
        step = max(1, (1 << 20) // centroids.size)
        while len(nodes):
            alive = np.concatenate([self.survivors(nodes[a : a + step], alive[a : a + step], centroids) for a in range(0, len(nodes), step)])
            done = (alive.sum(axis=1) == 1) | (2 * nodes + 1 >= len(self.bounds))
            yield nodes[done], alive[done]
            nodes, alive = nodes[~done], alive[~done]
            nodes, alive = np.concatenate([2 * nodes + 1, 2 * nodes + 2]), np.concatenate([alive, alive])


def distances(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances of all to all, exact."""
    if max(np.abs(points).max(initial=0), np.abs(centroids).max(initial=0)) < EXACT:
        p, c = points.astype(np.float64), centroids.astype(np.float64)
        return ((p * p).sum(axis=1)[:, None] - 2 * (p @ c.T) + (c * c).sum(axis=1)).astype(np.int64)
    out = np.empty((len(points), len(centroids)), np.int64)
    for k, c in enumerate(centroids):
        out[:, k] = ((points - c) ** 2).sum(axis=1)
    return out


def resolve(tree: Tree, node: int, alive: np.ndarray, centroids: np.ndarray) -> tuple[slice, np.ndarray, np.ndarray]:
    """Of a node: its points, and the number and squared distance of the nearest centroid alive; ties to the smaller."""
    at, left = slice(*tree.bounds[node]), np.flatnonzero(alive)
    d = distances(tree.points[at].astype(np.int64), centroids[left])
    nearest = np.argmin(d, axis=1)
    return at, left[nearest], d[np.arange(len(d)), nearest]


def assign(tree: Tree, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    cluster, distance = np.zeros(len(tree.points), np.int32), np.zeros(len(tree.points), np.int64)
    for nodes, alive in tree.filter(centroids):
        for node, left in zip(nodes, alive, strict=True):
            at, k, d = resolve(tree, node, left, centroids)
            cluster[at], distance[at] = k, d
    return cluster, distance


def sums(tree: Tree, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and sum of the points of every centroid."""
    count, total = np.zeros(len(centroids), np.int64), np.zeros(centroids.shape, np.int64)
    for nodes, alive in tree.filter(centroids):
        whole = alive.sum(axis=1) == 1
        owner = np.argmax(alive[whole], axis=1)
        np.add.at(count, owner, np.diff(tree.bounds[nodes[whole]], axis=1).ravel())
        np.add.at(total, owner, tree.sums[nodes[whole]])
        for node, left in zip(nodes[~whole], alive[~whole], strict=True):
            at, k, _ = resolve(tree, node, left, centroids)
            np.add.at(count, k, 1)
            np.add.at(total, k, tree.points[at].astype(np.int64))
    return count, total


def build_trees(vectors: DataFrame, id_col: str, vector: str, dims: int, scale: int) -> DataFrame:
    """``(ids, points, sums, low, high, bounds)``, a row for up to ``TREE`` vectors, as a written table."""
    source = vectors.where(proper(vector, dims)).select(F.col(id_col).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    names = ["ids", *(f for f, _ in Tree.FIELDS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, TREE):
                part = batch.slice(a, TREE)
                values = part["v"].flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
                tree = Tree(integers(values, scale))
                ids = pa.array([part["id"].take(pa.array(tree.order))], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([ids, *(pa.array([b], pa.binary()) for b in tree.pack())], names=names)
        settle()

    return materialise(source.mapInArrow(run, "ids array<long>, points binary, sums binary, low binary, high binary, bounds binary"), "trees")


def _each(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[tuple[pa.RecordBatch, int, Tree]]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch, i, Tree.unpack([batch[f][i].as_py() for f, _ in Tree.FIELDS], dims)


def first_centroids(vectors: DataFrame, id_col: str, vector: str, dims: int, scale: int, clusters: int, seed: int) -> np.ndarray:
    """The vectors with the smallest sha256 of ``seed:id``, in that order."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("long").cast("string")), 256)
    found = vectors.where(proper(vector, dims) & F.col(id_col).isNotNull()).select(key.alias("key"), F.col(vector).cast("array<double>").alias("v"))
    rows = found.orderBy("key", "v").limit(clusters).collect()
    return integers(np.array([r["v"] for r in rows], np.float64).reshape(-1, dims), scale).astype(np.int64)


def settled_centroids(trees: DataFrame, centroids: np.ndarray, rounds: int) -> np.ndarray:
    """Rounds of assignment and exact floored means; they end early once nothing moves, as no later one would."""
    k, dims = centroids.shape
    columns = [f"s{i}" for i in range(dims)]

    def totals(now: np.ndarray):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            count, total = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
            for _, _, tree in _each(batches, dims):
                more = sums(tree, now)
                count, total = count + more[0], total + more[1]
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(k, dtype=np.int32)), pa.array(count), *(pa.array(np.ascontiguousarray(c)) for c in total.T)], names=["cluster", "n", *columns])

        return run

    schema = "cluster int, n long, " + ", ".join(f"{c} long" for c in columns)
    for _ in range(rounds if k else 0):
        was, now = centroids, centroids.copy()
        added = trees.mapInArrow(totals(was), schema).groupBy("cluster").agg(*[F.sum(c).alias(c) for c in ("n", *columns)])
        for r in added.where("n > 0").collect():
            now[r["cluster"]] = [r[c] // r["n"] for c in columns]
        centroids = now
        if np.array_equal(was, now):
            break
    return centroids


def cluster_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector: str = "embedding",
    dims: int = 64,
    clusters: int = 8,
    rounds: int = 10,
    scale: int = 1024,
    seed: int = 3,
) -> DataFrame:
    """Return ``id_col, cluster, distance, cluster_inertia, inertia, centroid`` for every vector that takes part.

    ``distance`` is squared, in scaled integers; ``centroid`` is the array of the integers of the cluster's centroid.
    """
    with scope(vectors.sparkSession) as own:
        trees = build_trees(vectors, id_col, vector, dims, scale)
        final = settled_centroids(trees, first_centroids(vectors, id_col, vector, dims, scale, clusters, seed), rounds)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch, i, tree in _each(batches, dims):
                ids = batch["ids"][i].values
                if len(final):
                    k, d = map(pa.array, assign(tree, final))
                else:
                    k, d = pa.nulls(len(ids), pa.int32()), pa.nulls(len(ids), pa.int64())
                yield pa.RecordBatch.from_arrays([ids, k, d], names=["id", "cluster", "distance"])

        placed = own.keep(materialise(trees.mapInArrow(run, "id long, cluster int, distance long"), "placed"))
    inertia = {r["cluster"]: int(r["d"]) for r in placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect() if r["d"] is not None}
    if not inertia:
        nothing = {c: F.lit(None).cast("long") for c in ("cluster_inertia", "inertia")} | {"centroid": F.lit(None).cast("array<long>")}
        return placed.select(F.col("id").alias(id_col), "cluster", "distance").withColumns(nothing)
    at = F.col("cluster") + 1
    of_cluster = F.element_at(F.array(*[F.lit(inertia.get(k, 0)).cast("long") for k in range(len(final))]), at)
    centre = F.element_at(F.array(*[F.array(*[F.lit(int(x)).cast("long") for x in c]) for c in final]), at)
    return placed.select(F.col("id").alias(id_col), "cluster", "distance", of_cluster.alias("cluster_inertia"), F.lit(sum(inertia.values())).cast("long").alias("inertia"), centre.alias("centroid"))


def centroid_digest(centroid: str = "centroid") -> Column:
    """Lower-case hexadecimal sha256 of the components in decimal, joined by commas."""
    return F.sha2(F.array_join(F.col(centroid).cast("array<string>"), ","), 256)

