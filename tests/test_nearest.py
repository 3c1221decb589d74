"""The vector index against all pairs."""

import random

import numpy as np
import pytest

from lodestone.operators import metrics, nearest


def rows_of(rng, n, dim, crowd=30):
    middle = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(9)]
    rows = [(i, [x + rng.gauss(0, 0.2) for x in rng.choice(middle)], i % 4 if i % 5 else None) for i in range(n)]
    rows += [(n + i, rows[0][1], 7) for i in range(crowd)]
    return rows


def unit(v):
    v = np.array(v, float)
    return v / (np.linalg.norm(v) or 1)


@pytest.mark.parametrize("block, k", [(2048, 4), (40, 4), (25, 60)])
def test_neighbours_are_those_of_all_pairs(spark, monkeypatch, block, k):
    monkeypatch.setattr(nearest, "BLOCK_ROWS", block)
    rows = rows_of(random.Random(block), 240, 6)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(4)
    got = {}
    for r in metrics.nearest_neighbours(frame, "vec_id", k).collect():
        got.setdefault((r["query"], r["query_label"]), {})[r["rank"]] = (r["neighbour"], r["label"], r["similarity"])
    u = {i: unit(v) for i, v, _ in rows}
    label = {i: m for i, _, m in rows}
    assert got.keys() == {(i, m) for i, _, m in rows}
    for (q, _), found in got.items():
        sims = sorted((-float(u[q] @ u[j]), j) for j in u if j != q)[:k]
        assert sorted(found) == list(range(1, k + 1))
        assert np.allclose([found[i + 1][2] for i in range(k)], [-s for s, _ in sims])
        # Up to ties of the last digits, the same rows.
        bar = -sims[-1][0]
        assert {j for s, j in sims if -s > bar + 1e-9} <= {found[i + 1][0] for i in range(k)}
        assert all(found[i][1] == label[found[i][0]] for i in found)


def test_equal_rows_come_by_key_and_few_blocks_meet(spark, monkeypatch):
    monkeypatch.setattr(nearest, "BLOCK_ROWS", 20)
    rows = [(i, [1.0, 0.0], 0) for i in range(70)] + [(100 + i, [0.0, 1.0], 1) for i in range(70)]
    index = nearest.build(spark.createDataFrame(rows, "k long, v array<double>, l int"), "k", "v", "l")
    got = {}
    for r in nearest.neighbours(index, 3).collect():
        got.setdefault(r["query"], []).append((r["rank"], r["neighbour"]))
    assert sorted(got[5]) == [(1, 0), (2, 1), (3, 2)] and sorted(got[100]) == [(1, 101), (2, 102), (3, 103)]
    far = nearest._least(index, 0)
    assert (far > 1.4).any() and (far < 0.1).any()


def test_probes_lose_what_recall_counts(spark, monkeypatch):
    monkeypatch.setattr(nearest, "BLOCK_ROWS", 30)
    rows = rows_of(random.Random(1), 300, 8, 0)
    index = nearest.build(spark.createDataFrame(rows, "k long, v array<double>, l int"), "k", "v", "l")
    exact = nearest.neighbours(index, 5)
    share = [nearest.recall(nearest.neighbours(index, 5, probes=p), exact).first() for p in (1, 4, len(index.radius))]
    assert share[0]["n"] == 1500 and share[0]["recall"] < share[1]["recall"] <= share[2]["recall"] == 1 and share[1]["recall"] >= 0.9


def test_ranks_are_those_of_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(nearest, "BLOCK_ROWS", 40)
    rng = random.Random(6)
    rows = [(i, v, [x + rng.gauss(0, 0.15) for x in v]) for i, v, _ in rows_of(rng, 200, 5, 10)]
    got = {r["k"]: r["rank"] for r in metrics.identity_ranks(spark.createDataFrame(rows, "k long, t array<double>, f array<double>"), "k", "t", "f").collect()}
    t = {i: unit(a) for i, a, _ in rows}
    for i, a, b in rows:
        own = unit(a) @ unit(b)
        sims = [t[j] @ unit(b) for j in t if j != i]
        assert sum(s > own + 1e-9 for s in sims) < got[i] <= 1 + sum(s > own - 1e-9 for s in sims)


def test_awkward_vectors(spark):
    rows = [(1, [1.0, 0.0], 0), (2, None, 0), (3, [float("nan"), 1.0], 0), (4, [0.0, 0.0], 0), (5, [1.0], 0), (None, [1.0, 0.0], 1), (6, [2.0, 0.0], None), (6, [3.0, 0.0], None)]
    frame = spark.createDataFrame(rows, "k long, v array<double>, l int")
    got = {(r["query"], r["rank"]): (r["neighbour"], r["label"]) for r in nearest.neighbours(nearest.build(frame, "k", "v", "l"), 2).collect()}
    assert got[1, 1] == (6, None) and {q for q, _ in got} == {1, 4, 6} and got[6, 1] == (1, 0)
    empty = nearest.build(frame.limit(0), "k", "v", "l")
    assert nearest.neighbours(empty, 2).collect() == [] and nearest.ranks(empty).collect() == []


def test_no_block_is_sent_to_the_blocks_that_meet_it(spark, monkeypatch):
    monkeypatch.setattr(nearest, "BLOCK_ROWS", 20)
    rows, plans, kept = rows_of(random.Random(2), 200, 8, 0), {}, nearest.graph.kept
    monkeypatch.setattr(nearest.graph, "kept", lambda df, path: (plans.update({path.split("/")[-1]: df._jdf.queryExecution().toString()}), kept(df, path))[1])
    index = nearest.build(spark.createDataFrame(rows, "k long, v array<double>, l int"), "k", "v", "l")
    assert nearest.neighbours(index, 3).count() == 600 and nearest.ranks(index).count() == 200
    assert "Exchange" not in plans["found"] and "Exchange" not in plans["ranks"]
