"""Projections against numpy, alignment against a search of turns, inference with models that fail."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestone.functions import inference
from lodestone.operators import projection

NAN, INF = float("nan"), float("inf")


def vectors(spark, rows):
    return spark.createDataFrame(rows, "id long, v array<double>, coordinates string")


def test_projection_equals_numpy(spark):
    x = np.random.default_rng(3).normal(size=(400, 6)) @ np.diag([9, 5, 3, 2, 1, 0.5]) + 50
    bad = [None, [], [1.0] * 5, [1.0] * 7, [None] * 6, [NAN] * 6, [INF] * 6]
    rows = [(i, r, "kept") for i, r in enumerate(x.tolist())] + [(1000 + i, v, None) for i, v in enumerate(bad)]
    out = {r["id"]: r["xy"] for r in projection.projected(vectors(spark, rows), "v", 6, 3, "xy").collect()}
    assert len(out) == len(rows) and all(out[1000 + i] is None for i in range(len(bad)))
    _, _, axes = np.linalg.svd(x - x.mean(0), full_matrices=False)
    axes = axes[:3] * np.array([1 if a[np.argmax(np.abs(a))] > 0 else -1 for a in axes[:3]])[:, None]
    assert np.allclose(np.array([out[i] for i in range(400)]), (x - x.mean(0)) @ axes.T, atol=1e-8)


@pytest.mark.parametrize("rows", [[], [(1, [3.0, 4.0], "a")], [(1, None, "a")], [(1, [2.0, 2.0], "a"), (2, [2.0, 2.0], "b"), (2, [2.0, 2.0], "b")]])
def test_projection_of_few_rows(spark, rows):
    out = projection.projected(vectors(spark, rows), "v", 2, out="xy").collect()
    assert [r["xy"] for r in out] == [None if v is None else [0.0, 0.0] for _, v, _ in rows]
    with pytest.raises(ValueError):
        projection.projected(vectors(spark, rows), "v", 2, 3)


def test_alignment_undoes_a_turn(spark):
    rng = np.random.default_rng(5)
    fixed = rng.normal(size=(300, 3))
    turn, _ = np.linalg.qr(rng.normal(size=(3, 3)))
    moving = 2.5 * fixed @ turn + 7
    rows = [(i, m, f) for i, (m, f) in enumerate(zip(moving.tolist(), fixed.tolist()))]
    rows += [(900, None, fixed[0].tolist()), (901, moving[1].tolist(), None), (902, [NAN] * 3, None)]
    out = {r["id"]: r["aligned"] for r in projection.aligned(spark.createDataFrame(rows, "id long, m array<double>, f array<double>"), "m", "f", 3).collect()}
    assert np.allclose([out[i] for i in range(300)], fixed) and out[900] is None and out[902] is None and np.allclose(out[901], fixed[1])


def test_no_other_turn_lies_better(spark):
    rng = np.random.default_rng(6)
    fixed, moving = rng.normal(size=(80, 2)), rng.normal(size=(80, 2))
    df = spark.createDataFrame([(m, f) for m, f in zip(moving.tolist(), fixed.tolist())], "m array<double>, f array<double>")
    best = sum(math.dist(r["aligned"], r["f"]) ** 2 for r in projection.aligned(df, "m", "f").collect())
    a, b = fixed - fixed.mean(0), moving - moving.mean(0)
    b = b * math.sqrt((a**2).sum() / (b**2).sum())
    for side in (1, -1):
        for w in np.linspace(0, 2 * math.pi, 720):
            r = np.array([[math.cos(w), math.sin(w)], [-side * math.sin(w), side * math.cos(w)]])
            assert ((b @ r - a) ** 2).sum() >= best - 1e-9


def test_alignment_of_awkward_rows(spark):
    schema = "m array<double>, f array<double>"
    run = lambda rows: [r["aligned"] for r in projection.aligned(spark.createDataFrame(rows, schema), "m", "f").collect()]
    assert run([]) == [] and run([([1.0, 2.0], None), (None, None)]) == [[1.0, 2.0], None]
    assert run([([1.0, 2.0], [5.0, 5.0]), ([1.0, 2.0], [7.0, 7.0])]) == [[6.0, 6.0], [6.0, 6.0]]
    with pytest.raises(ValueError):
        projection.aligned(spark.createDataFrame([], schema), "m", "f", 17)


def encode(spark, texts, load, **sizes):
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string").coalesce(1)
    return [(r["e"]["vector"], r["e"]["error"]) for r in df.select("id", inference.encoded(F.col("text"), load, 2, **sizes).alias("e")).orderBy("id").collect()]


def careful_model():
    """A loader of a model that has room for four texts and refuses some; nested, so that workers needn't import the tests."""

    def careful():
        def model(texts):
            if len(texts) > 4:
                raise MemoryError
            if any("bad" in t for t in texts):
                raise RuntimeError("bad text")
            assert [len(t) for t in texts] == sorted(len(t) for t in texts)
            return np.array([[len(t), t.count("a")] for t in texts])

        return model

    return careful


def test_a_failing_text_costs_one_row(spark):
    texts = ["a" * (i * 7 % 23) for i in range(40)] + [None, "", "bad", "a bad one", "b" * 50000] + ["aa"] * 3
    plain = [([0.0, 0.0], "RuntimeError: bad text") if "bad" in (t or "") else ([float(len(t or "")), float((t or "").count("a"))], None) for t in texts]
    for batch, least in ((64, 2), (64, 8), (3, 1), (1, 1)):
        assert encode(spark, texts, careful_model(), batch=batch, least=least) == plain
    assert encode(spark, [], careful_model()) == []


def test_rows_of_a_wrong_form_are_errors(spark):
    wide = lambda: lambda texts: np.ones((len(texts), 3))
    vain = lambda: lambda texts: np.array([[NAN if t == "x" else 1.0, 2.0] for t in texts])
    assert all(v == [0.0, 0.0] and e.startswith("ValueError") for v, e in encode(spark, ["x", "y"], wide))
    (a, failed), (b, fine) = encode(spark, ["x", "y"], vain)
    assert a == [0.0, 0.0] and failed.startswith("ValueError") and b == [1.0, 2.0] and fine is None
