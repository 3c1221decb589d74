"""Density and average-link clustering against plain versions that look at all pairs."""

import math
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestone.operators import density, evaluation, graph, linkage
from lodestone.plans import registry


def blobs(rng, n, dim, centres, noise=0.15, spread=0.12):
    middle = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(centres)]
    out = []
    for _ in range(n):
        if rng.random() < noise:
            out.append([rng.gauss(0, 1) for _ in range(dim)])
        else:
            c = rng.choice(middle)
            out.append([x + rng.gauss(0, spread) for x in c])
    return out


def all_pairs(rows, least, k, epsilon=0.0):
    """Labels of unit vectors by a full matrix, all pairs in order, and a condensed tree from the top down."""
    x = np.array(rows, float)
    x = np.rint(x / np.maximum(np.linalg.norm(x, axis=1), 1e-300)[:, None] * density.SCALE)
    n = len(x)
    d = ((x[:, None] - x[None]) ** 2).sum(2).astype(np.int64)
    core = np.array([np.sort(np.delete(r, i))[min(k, n - 1) - 1] for i, r in enumerate(d)])
    lo, hi = np.triu_indices(n, 1)
    w = np.maximum(np.maximum(d[lo, hi], core[lo]), core[hi])
    top, node, size, kids, length = list(range(n)), list(range(n)), [1] * n, {}, {}

    def find(a):
        while top[a] != a:
            top[a] = top[top[a]]
            a = top[a]
        return a

    for i in np.lexsort((hi, lo, w)):
        a, b = find(lo[i]), find(hi[i])
        if a != b:
            new = len(size)
            kids[new], length[new] = (node[a], node[b]), math.sqrt(max(w[i], 1)) / density.SCALE
            size.append(size[node[a]] + size[node[b]])
            top[b], node[a] = a, new
            if len(size) == 2 * n - 1:
                break

    def leaves(t):
        stack, out = [t], []
        while stack:
            t = stack.pop()
            if t in kids:
                stack += kids[t]
            else:
                out.append(t)
        return out

    parent, birth, stability, home = [None], [0.0], [0.0], {}
    stack = [(2 * n - 2, 0)]
    while stack:
        t, c = stack.pop()
        if t not in kids:
            home[t] = c
            continue
        lam, big = 1 / length[t], [s for s in kids[t] if size[s] >= least]
        for s in kids[t]:
            if s not in big:
                for leaf in leaves(s):
                    home[leaf] = c
                    stability[c] += lam - birth[c]
        if len(big) == 1:
            stack.append((big[0], c))
        for s in big if len(big) == 2 else []:
            stability[c] += size[s] * (lam - birth[c])
            parent.append(c)
            birth.append(lam)
            stability.append(0.0)
            stack.append((s, len(parent) - 1))

    def best(c):
        below = [best(s) for s in range(len(parent)) if parent[s] == c]
        total, take = sum(b for b, _ in below), [t for _, ts in below for t in ts]
        return (total, take) if c == 0 or total > stability[c] else (stability[c], [c])

    picked = set()
    for c in best(0)[1]:
        while 1 / birth[c] < epsilon and parent[c] != 0:
            c = parent[c]
        picked.add(c)

    def up(c):
        chain = []
        while c is not None:
            chain.append(c)
            c = parent[c]
        return next((x for x in reversed(chain) if x in picked), None)

    names, out = {}, []
    for i in range(n):
        c = up(home[i])
        out.append(-1 if c is None else names.setdefault(c, len(names)))
    return out


def run(spark, rows, least, parts=3, **more):
    """Rows are numbered by partition, so a table of one partition keeps the order that ties go by."""
    frame = spark.createDataFrame([(i, v, 1) for i, v in enumerate(rows)], "vec_id long, embedding array<double>, label int").coalesce(parts)
    got = density.clusters(frame, "vec_id", least, **more).collect()
    assert sorted(r["vec_id"] for r in got) == list(range(len(rows)))
    return [r["label"] for r in sorted(got, key=lambda r: r["vec_id"])]


@pytest.mark.parametrize("least, k, epsilon, block, finish", [(8, 8, 0.0, 2048, 10**6), (12, 5, 0.0, 60, 10**6), (6, 6, 0.35, 90, 10**6), (8, 4, 0.0, 150, 3)])
def test_density_clusters_are_those_of_all_pairs(spark, monkeypatch, least, k, epsilon, block, finish):
    rng = random.Random(least * 100 + block)
    rows = blobs(rng, 420, 5, 6) + [[1.0, 0.0, 0.0, 0.0, 0.0]] * 25
    monkeypatch.setattr(density, "BLOCK_ROWS", block)
    monkeypatch.setattr(density, "FINISH_EDGES", finish)
    want = all_pairs(rows, least, k, epsilon)
    assert len(set(want)) >= 3
    assert run(spark, rows, least, neighbours=k, epsilon=epsilon) == want


def test_density_clusters_of_two_thousand_rows(spark):
    rows = blobs(random.Random(5), 2000, 16, 12, 0.2, 0.25)
    want = all_pairs(rows, 20, 20)
    assert len(set(want)) >= 6 and want.count(-1) > 50
    assert run(spark, rows, 20) == want


def test_density_clusters_of_awkward_rows(spark):
    rng = random.Random(3)
    good = blobs(rng, 60, 3, 2, 0.0, 0.05)
    rows = [*good, None, [], [float("nan"), 1.0, 0.0], [1.0, None, 0.0], [1.0, 2.0], [0.0, 0.0, 0.0]]
    got = run(spark, rows, 5)
    assert got[60:65] == [-1] * 5 and got[:60] == all_pairs(good + [[0.0, 0.0, 0.0]], 5, 5)[:60]
    assert run(spark, [[1.0, 0.0]] * 9, 5) == [-1] * 9
    assert run(spark, [[1.0, 0.0]] * 40 + [[0.0, 1.0]] * 40, 5) == [0] * 40 + [1] * 40
    empty = spark.createDataFrame([], "vec_id long, embedding array<double>")
    assert density.clusters(empty, "vec_id", 2).collect() == []
    with pytest.raises(ValueError):
        density.clusters(empty, "vec_id", 1)


def test_least_edges_are_those_of_all_pairs_and_few_pairs_are_measured(monkeypatch):
    rng, measured, whole = np.random.default_rng(4), [], density._measured
    monkeypatch.setattr(density, "_PAIRS", 50)
    monkeypatch.setattr(density, "_measured", lambda a, b, i, j: (measured.append(len(i)), whole(a, b, i, j))[1])
    x = rng.normal(size=(900, 16))
    x[600:620] = x[:20]
    x = np.rint(x / np.linalg.norm(x, axis=1)[:, None] * density.SCALE)
    core = rng.choice(density._squares(x[:30], x[30:60]).ravel(), 900)
    block = lambda rows, part: density._Block(rows, x[rows], core[rows], part[rows])
    for part in (np.arange(900) // 3, np.arange(900) % 4, np.arange(900) // 300 * 300):
        own, others = block(np.arange(300), part), [block(np.arange(k, k + 300), part) for k in (0, 300, 600)]
        fresh = lambda: {"w": np.full(300, density._FAR), "to": np.full(300, density._FAR), "other": np.full(300, -1)}
        names, at = np.unique(own.part, return_inverse=True)
        state, want = {"b": own, "at": at, "least": np.full(len(names), density._FAR), **fresh()}, fresh()
        for other in others:
            density._least_edges(state, other)
            density._nearest_other(own, other, want["w"], want["to"], want["other"])
        picks = lambda s: density._picks(own.part, s["w"], own.row, s["to"], s["other"]).to_pylist()  # noqa: E731, B023
        assert picks(state) == picks(want) and len(picks(want)) == len(names)
    assert sum(measured) < 0.2 * 3 * 300 * 900


def test_single_precision_leaves_out_no_near_pair():
    rng = np.random.default_rng(6)
    for dimension in (2, 64, 300):
        x = rng.normal(size=(400, dimension))
        x[200:] = x[:200] + rng.normal(size=(200, dimension)) * 10.0 ** -rng.integers(0, 8, (200, 1))
        x = np.rint(x / np.linalg.norm(x, axis=1)[:, None] * density.SCALE)
        exact = density._squares(x, x)
        far = exact[np.arange(400), rng.integers(0, 400, 400)]
        near, can = density._maybe_near(x, x, far)
        assert can[exact <= far[:, None]].all() and np.abs(near - exact / density.SCALE**2).max() <= density._error(dimension)


def test_a_spanning_tree_between_blocks_is_that_of_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(density, "BLOCK_ROWS", 30)
    rows = blobs(random.Random(8), 200, 4, 5)
    frame = spark.createDataFrame(list(enumerate(rows)), "vec_id long, embedding array<double>").coalesce(1)
    folder = graph.shared_folder(spark)
    with graph.small_batches(spark, 2):
        _, points, n = density._points(frame, "vec_id", "embedding", folder)
        cores = density._cores(points, 4, n, folder)
        tree = [tuple(r) for r in density.spanning_tree(points, cores, folder).select("w", "lo", "hi").collect()]
    x = {r["row"]: np.array(r["x"], float) for r in points.collect()}
    core = {r["row"]: r["core"] for r in cores.collect()}
    ids = sorted(x)
    pairs = sorted((max(core[a], core[b], int(((x[a] - x[b]) ** 2).sum())), a, b) for i, a in enumerate(ids) for b in ids[i + 1 :])
    root = {i: i for i in ids}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    want = []
    for w, a, b in pairs:
        p, q = find(a), find(b)
        if p != q:
            root[q] = p
            want.append((w, a, b))
    assert points.agg(F.count_distinct("block")).first()[0] > 5 and sorted(tree) == want


def average_linkage(rows, threshold):
    """Plain average linkage by cosine: the closest two clusters merge while they are nearer than the threshold."""
    x = np.array(rows, float)
    x = x / np.maximum(np.linalg.norm(x, axis=1), 1e-300)[:, None]
    d = 1 - x @ x.T
    groups = [[i] for i in range(len(x))]
    apart = d.copy()
    np.fill_diagonal(apart, np.inf)
    while len(groups) > 1:
        i, j = sorted(np.unravel_index(apart.argmin(), apart.shape))
        if apart[i, j] >= threshold:
            break
        n, m = len(groups[i]), len(groups[j])
        row = (n * apart[i] + m * apart[j]) / (n + m)
        groups[i] += groups.pop(j)
        apart[i], apart[:, i] = row, row
        apart[i, i] = np.inf
        apart = np.delete(np.delete(apart, j, 0), j, 1)
    return sorted(sorted(g) for g in groups)


def linked(spark, rows, threshold, parts=3):
    frame = spark.createDataFrame([(i, v, 1) for i, v in enumerate(rows)], "vec_id long, embedding array<double>, label int").coalesce(parts)
    got = linkage.clusters(frame, "vec_id", threshold).collect()
    assert sorted(r["vec_id"] for r in got) == list(range(len(rows)))
    groups = {}
    for r in got:
        groups.setdefault(r["label"], []).append(r["vec_id"])
    return sorted(sorted(g) for g in groups.values() if g), {r["vec_id"]: r["label"] for r in got}


@pytest.mark.parametrize("threshold, block", [(0.3, 2048), (0.1, 90), (0.7, 60)])
def test_average_linkage_is_the_plain_one(spark, monkeypatch, threshold, block):
    monkeypatch.setattr(linkage, "BLOCK_ROWS", block)
    rows = blobs(random.Random(block), 200, 4, 6) + [[0.0, 1.0, 0.0, 0.0]] * 30
    want = average_linkage(rows, threshold)
    assert 1 < len(want) < 200
    assert linked(spark, rows, threshold)[0] == want


@pytest.mark.parametrize("threshold, group", [(0.3, 25), (0.7, 40)])
def test_average_linkage_of_groups_too_large_for_a_task(spark, monkeypatch, threshold, group):
    """They are parted at higher similarities, with the same clusters; links that none parts merge by pairs."""
    monkeypatch.setattr(linkage, "BLOCK_ROWS", 50)
    monkeypatch.setattr(linkage, "GROUP_ROWS", group)
    rows = blobs(random.Random(group), 150, 4, 3) + [[0.0, 1.0, 0.0, 0.0]] * 40
    assert linked(spark, rows, threshold)[0] == average_linkage(rows, threshold)
    monkeypatch.setattr(linkage, "GROUP_ROWS", 2)
    even = [[float(i == j) for j in range(5)] for i in range(5)]
    assert len(linked(spark, even, 1.1)[0]) == len(average_linkage(even, 1.1)) == 1


def test_average_linkage_takes_no_pass_for_each_merge(spark, monkeypatch):
    """A group of near copies merges a pair or two at a time: that is one task's work, not a pass over all blocks each time."""
    monkeypatch.setattr(linkage, "BLOCK_ROWS", 40)
    written, kept = [], graph.kept
    monkeypatch.setattr(graph, "kept", lambda df, path: written.append(path) or kept(df, path))
    rng = random.Random(8)
    rows = [[1 + rng.gauss(0, 0.05) if k == 0 else rng.gauss(0, 0.05) for k in range(8)] for _ in range(120)] + blobs(rng, 60, 8, 60)
    assert linked(spark, rows, 0.3)[0] == average_linkage(rows, 0.3)
    assert len(written) < 40


def test_average_linkage_of_awkward_rows(spark):
    rows = [[1.0, 0.0], [2.0, 0.0], None, [float("nan"), 0.0], [0.0, 0.0], [0.0, 0.0], [1.0], [0.0, -3.0]]
    groups, label = linked(spark, rows, 0.5)
    assert {label[2], label[3], label[6]} == {None} and [0, 1] in groups and [7] in groups and [4] in groups and [5] in groups
    empty = spark.createDataFrame([], "vec_id long, embedding array<double>")
    assert linkage.clusters(empty, "vec_id", 0.5).collect() == []


def test_silhouette_is_that_of_all_pairs(spark):
    rng = random.Random(2)
    rows = [(i, v, rng.choice([-1, 0, 1, 2, None])) for i, v in enumerate(blobs(rng, 150, 5, 4))]
    rows += [(200, rows[0][1], 9), (201, None, 1), (202, [0.0] * 5, 2), (203, rows[1][1], 0)]
    got = {r["vec_id"]: r["silhouette"] for r in evaluation.silhouettes(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), "vec_id").collect()}
    used = [(i, np.array(v) / (np.linalg.norm(v) or 1), k) for i, v, k in rows if v is not None and k not in (None, -1)]
    assert got.keys() == {i for i, _, _ in used}
    for i, u, k in used:
        far = {}
        for j, v, m in used:
            if i != j:
                far.setdefault(m, []).append(1 - u @ v)
        if k not in far:
            assert got[i] == 0
            continue
        a, b = np.mean(far[k]), min(np.mean(x) for m, x in far.items() if m != k)
        assert got[i] == pytest.approx((b - a) / max(a, b), abs=1e-9)
    one = spark.createDataFrame([(1, [1.0], 0), (2, [1.0], 0)], "vec_id long, embedding array<double>, label int")
    assert [r["silhouette"] for r in evaluation.silhouettes(one, "vec_id").collect()] == [None, None]


FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_cluster_queries_are_those_of_all_pairs(spark):
    rows = [r["embedding"] for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").orderBy("vec_id").collect()]
    labels = lambda name: [r["label"] for r in sorted(registry.queries()[name](spark, FOLDER).collect(), key=lambda r: r["vec_id"])]
    least = max(2, int(0.01 * len(rows)))
    assert same_groups(labels("density_clusters"), all_pairs(rows, least, least))
    assert same_groups(labels("density_clusters_with_epsilon"), all_pairs(rows, least, 5, 0.4**0.5))
    got = {}
    for i, label in enumerate(labels("average_link_clusters")):
        got.setdefault(label, []).append(i)
    assert sorted(got.values()) == average_linkage(rows, 0.5)


def same_groups(a, b):
    """Whether two labellings are one up to the names; noise is noise in both."""
    return len(set(zip(a, b, strict=True))) == len(set(a)) == len(set(b)) and all((x == -1) == (y == -1) for x, y in zip(a, b, strict=True))


def test_no_block_is_sent_to_the_blocks_that_meet_it(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(density, "BLOCK_ROWS", 20)
    plans, kept = {}, density.graph.kept
    monkeypatch.setattr(density.graph, "kept", lambda df, path: (plans.update({path.split("/")[-1]: df._jdf.queryExecution().toString()}), kept(df, path))[1])
    rng = np.random.default_rng(4)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.normal(size=(150, 6)))], "k long, v array<double>")
    _, points, n = density._points(frame, "k", "v", f"file://{tmp_path}")
    assert density._cores(points, 3, n, f"file://{tmp_path}").count() == 150
    assert "Exchange" not in plans["cores"]
