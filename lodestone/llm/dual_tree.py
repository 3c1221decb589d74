"""Centroid clustering: Lloyd's rounds by dual trees, exact on integer vectors.

The vectors are dealt into trees of a bounded number of rows. Each tree is a cover tree, built once and
written as a row: a node has a pivot and the distance of its farthest vector from it; children's pivots are
farther apart than the radius that they cover. In each round the centroids
get a tree of the same kind, which every task holds. A task walks a tree of vectors and the tree of centroids
together, level by level. A pair of nodes goes when the distance of the pivots less both radii exceeds what
the vectors of the node have at most to some other centroid. A node that is left with one centroid goes to
it as a whole; where leaves are left with several, vectors and centroids are compared exactly. Each task sends one sum a centroid to the driver's new means.

All distances that decide are integers. Bounds are taken in double with a margin, and a pair is dropped only
if it is strictly farther, so ties go to the smaller number as if all pairs had been compared.

Defined results: components beyond REACH are held there, so that distances fit 64 bits; rows that are equal,
or share an id, each count; a null id is hashed as an empty one; where there are fewer vectors than clusters,
there are as many centroids as vectors; a sum beyond 64 bits is null; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, small_batches

#: Largest component, and components up to which products of doubles are exact for any usual dimension.
REACH, EXACT_REACH = 1 << 27, 1 << 20
#: Vectors of a tree, and of a leaf; trees that a task holds at a time.
TREE_ROWS, LEAF_ROWS, TREES_HELD = 2048, 16, 16
#: Centroids that are sent to each task at most.
MAX_CENTROIDS = 4096
_MARGIN = 1e-6
_TREES = "ids array<long>, vectors binary, nodes binary"
_SUMS = "cluster int, n long, dim int, total decimal(38,0)"
_NODE = np.dtype([("first", "<i4"), ("end", "<i4"), ("child", "<i4"), ("last_child", "<i4"), ("pivot", "<i4"), ("radius", "<f8")])


class Tree(NamedTuple):
    """Vectors in the order of the leaves, and nodes level by level; a leaf has no children (child == last_child)."""

    vectors: np.ndarray
    nodes: np.ndarray


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of x to all rows of y."""
    most = max(np.abs(x).max(initial=0), np.abs(y).max(initial=0))
    if most <= EXACT_REACH and x.shape[1] <= 1024:
        a, b = x.astype(float), y.astype(float)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)).astype(np.int64)
    return np.stack([((x - c) ** 2).sum(1) for c in y], axis=1) if len(y) else np.zeros((len(x), 0), np.int64)


def build(vectors: np.ndarray, leaf_rows: int = LEAF_ROWS) -> tuple[np.ndarray, Tree]:
    """A cover tree of integer vectors: the order of the rows in it, and the tree.

    A node's first child keeps its pivot; each next pivot is the first row that no child covers yet.
    """
    order = np.arange(len(vectors))
    nodes: list[list] = []
    far = np.sqrt(_distances(vectors, vectors[:1])[:, 0]) if len(vectors) else np.zeros(0)
    # Of each node: its place, its distances from the pivot, and the radius that its children cover.
    level = [(0, len(vectors), 0, far)] if len(vectors) else []
    if level:
        nodes.append([0, len(vectors), 0, 0, 0, float(far.max())])
    at = 0
    while level:
        below = []
        for first, end, pivot, far in level:
            node, at = nodes[at], at + 1
            radius = far.max()
            if end - first <= leaf_rows or radius == 0:
                continue
            covers = radius / 2
            rows, left, children = order[first:end].copy(), np.ones(end - first, bool), []
            p, d = pivot, far
            place = first
            while True:
                own = left & (d <= covers)
                children.append((place, place + int(own.sum()), p, d[own]))
                order[place : place + int(own.sum())] = rows[own]
                place += int(own.sum())
                left &= ~own
                if place == end:
                    break
                p = int(rows[left.argmax()])
                d = np.full(len(rows), np.inf)
                d[left] = np.sqrt(_distances(vectors[rows[left]], vectors[p : p + 1])[:, 0])
            node[2:4] = [len(nodes), len(nodes) + len(children)]
            nodes += [[a, b, 0, 0, q, float(e.max())] for a, b, q, e in children]
            below += children
        level = below
    table = np.array([tuple(n) for n in nodes], _NODE)
    # Pivots by their place in the order.
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    table["pivot"] = place[table["pivot"]] if len(order) else table["pivot"]
    return order, Tree(vectors[order], table)


def walk(tree: Tree, own: Tree, numbers: np.ndarray) -> tuple[np.ndarray, int]:
    """For each vector of the tree its nearest centroid's number; and how many pairs were compared exactly.

    own: the tree of centroids, with leaves of one; numbers: theirs, in the order of that tree.
    """
    v, c = tree.nodes, own.nodes
    to, compared = np.full(len(tree.vectors), -1, np.int64), 0
    c_pivot = own.vectors[c["pivot"]]
    inner, above = c["child"] < c["last_child"], np.zeros(len(c), np.int64)
    for i in np.flatnonzero(inner):
        above[c["child"][i] : c["last_child"][i]] = i
    front, near = np.zeros(min(1, len(v)), np.int64), np.zeros((min(1, len(v)), len(c)), bool)
    near[:, :1] = True
    while len(front):
        # One level down the tree of centroids; leaves stay.
        near = near[:, above] & (np.arange(len(c)) > 0) & inner[above] | near & ~inner
        some = np.flatnonzero(near.any(0))
        d = np.sqrt(_distances(tree.vectors[v["pivot"][front]], c_pivot[some]))
        reach = v["radius"][front][:, None]
        # No vector of a node is farther from its nearest centroid than this.
        least = np.where(near[:, some], d + reach, np.inf).min(1)[:, None]
        near[:, some] &= d - reach - c["radius"][some] <= least * (1 + 1e-12) + _MARGIN
        unfinished = (near & inner).any(1)
        single = ~unfinished & (near.sum(1) == 1)
        leaf = v["child"][front] == v["last_child"][front]
        for i in np.flatnonzero(single):
            to[v["first"][front[i]] : v["end"][front[i]]] = numbers[c["pivot"][near[i].argmax()]]
        for i in np.flatnonzero(~unfinished & ~single & leaf):
            n, places = v[front[i]], c["pivot"][near[i]]
            d = _distances(tree.vectors[n["first"] : n["end"]], own.vectors[places])
            compared += d.size
            # Of the nearest, the smallest number.
            to[n["first"] : n["end"]] = np.where(d == d.min(1)[:, None], numbers[places], np.iinfo(np.int64).max).min(1)
        stay, split = unfinished & leaf, ~single & ~leaf
        n = v[front[split]]
        children = n["last_child"] - n["child"]
        starts = np.repeat(n["child"] - (np.cumsum(children) - children), children)
        below = starts + np.arange(children.sum())
        front = np.concatenate([front[stay], below]).astype(np.int64)
        near = np.concatenate([near[stay], np.repeat(near[split], children, axis=0)])
    return to, compared


def _loaded(vectors: bytes, nodes: bytes, dim: int) -> Tree:
    return Tree(np.frombuffer(vectors, "<i4").reshape(-1, dim).astype(np.int64), np.frombuffer(nodes, _NODE))


def plant(vectors: DataFrame, dim: int, tree_rows: int | None = None) -> DataFrame:
    """Trees of vectors (id, x: array of dim integers), a row each."""
    tree_rows = tree_rows or TREE_ROWS

    def trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, rows = [], []

        def tree() -> pa.RecordBatch:
            nonlocal ids, rows
            x = np.clip(np.concatenate(rows), -REACH, REACH)
            order, made = build(x)
            out = [[[ids[i] for i in order]], [made.vectors.astype("<i4").tobytes()], [made.nodes.tobytes()]]
            ids, rows = [], []
            return pa.RecordBatch.from_arrays([pa.array(out[0], pa.list_(pa.int64())), *(pa.array(o, "binary") for o in out[1:])], ["ids", "vectors", "nodes"])

        for batch in batches:
            for lo in range(0, batch.num_rows, tree_rows):
                part = batch.slice(lo, tree_rows)
                ids += part.column(0).to_pylist()
                rows.append(part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim))
                if len(ids) >= tree_rows:
                    yield tree()
        if ids:
            yield tree()

    return vectors.select(F.col("id").cast("long"), F.col("x").cast("array<long>")).mapInArrow(trees, _TREES)


def _centroid_tree(centroids: list[list[int]]) -> tuple[np.ndarray, Tree]:
    """Tree of the distinct centroids with leaves of one, and the smallest number of each."""
    x, first = np.unique(np.array(centroids, np.int64), axis=0, return_index=True)
    order, tree = build(x, 1)
    return first[order], tree


def _sums(trees: DataFrame, centroids: list[list[int]], dim: int) -> list:
    numbers, own = _centroid_tree(centroids)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = [0] * len(centroids), np.zeros((len(centroids), dim), object)
        for batch in batches:
            for vectors, nodes in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                tree = _loaded(vectors, nodes, dim)
                to, _ = walk(tree, own, numbers)
                for k in np.unique(to):
                    rows = tree.vectors[to == k]
                    n[k] += len(rows)
                    total[k] += rows.sum(0).astype(object)
        rows = [(k, n[k], j, int(total[k, j])) for k in range(len(n)) if n[k] for j in range(dim)]
        kinds = (pa.int32(), pa.int64(), pa.int32(), pa.decimal128(38, 0))
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows, strict=True)) or [[]] * 4, kinds, strict=True)], ["cluster", "n", "dim", "total"])

    # A row a task, centroid and dimension; clusters x dimensions rows come to the driver.
    parts = trees.select("vectors", "nodes").mapInArrow(summed, _SUMS)
    return parts.groupBy("cluster", "dim").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect()


def first_centroids(vectors: DataFrame, k: int) -> list[list[int]]:
    """The vectors whose hash of `1:<id>` is smallest; equal hashes in order of the vectors."""
    key = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    return [list(r["x"]) for r in vectors.select(key.alias("h"), "x").orderBy("h", "x").limit(k).collect()]


def cluster(vectors: DataFrame, scratch: Scratch, dim: int, k: int, rounds: int) -> DataFrame:
    """id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of vectors (id, x) after so many rounds and a last assignment."""
    if not 1 <= k <= MAX_CENTROIDS:
        raise ValueError(f"clusters must be 1 to {MAX_CENTROIDS}")
    held = vectors.select("id", F.transform("x", lambda x: F.least(F.greatest(x.cast("long"), F.lit(-REACH)), F.lit(REACH))).alias("x"))
    centroids = first_centroids(held, k)
    trees = scratch.table("trees", plant(held, dim))
    schema = "id long, cluster int, distance long"
    if not centroids:
        return vectors.sparkSession.createDataFrame([], f"{schema}, cluster_inertia long, inertia long, centroid_sha256 string")
    with small_batches(vectors.sparkSession, TREES_HELD):
        for _ in range(rounds):
            for r in _sums(trees, centroids, dim):
                centroids[r["cluster"]][r["dim"]] = int(r["total"]) // r["n"]
    numbers, own = _centroid_tree(centroids)
    means = np.array(centroids, np.int64)

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, vectors, nodes in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                tree = _loaded(vectors, nodes, dim)
                to, _ = walk(tree, own, numbers)
                d = ((tree.vectors - means[to]) ** 2).sum(1)
                yield pa.RecordBatch.from_arrays([pa.array(ids, "int64"), pa.array(to.astype(np.int32)), pa.array(d)], ["id", "cluster", "distance"])

    with small_batches(vectors.sparkSession, TREES_HELD):
        placed = scratch.table("placed", trees.mapInArrow(assigned, schema))
    return placed.join(F.broadcast(_inertia(placed, centroids)), "cluster").select("id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _inertia(placed: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """cluster, cluster_inertia, inertia, centroid_sha256: a row for each centroid that has vectors."""
    rows = [(r["cluster"], r["s"]) for r in placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()]
    fits = lambda x: int(x) if x < 1 << 63 else None
    total = fits(sum(s for _, s in rows))
    named = [(k, fits(s), total, hashlib.sha256(",".join(map(str, centroids[k])).encode()).hexdigest()) for k, s in rows]
    return placed.sparkSession.createDataFrame(named, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")


def quantised(vector: Column, factor: int) -> Column:
    """floor(factor * x) of each component, as double."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * factor))


def usable(vector: Column, dim: int) -> Column:
    """Whether a vector has so many components, none null, NaN or infinite."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return F.coalesce((F.size(vector) == dim) & F.forall(vector, finite), F.lit(False))
