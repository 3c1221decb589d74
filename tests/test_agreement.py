"""Agreement by run against counts of pairs, joint statuses, accuracy by size of group, sizes after cleaning, categories."""

import math
import random
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from lodestone.functions import files
from lodestone.operators import agreement


def plain_agreement(rows):
    pairs = [(x[0] == y[0], x[1] == y[1]) for x, y in combinations(rows, 2)]
    both, a, b = sum(p and q for p, q in pairs), sum(p for p, _ in pairs), sum(q for _, q in pairs)
    chance = a * b / len(pairs) if pairs else 0
    ari = (both - chance) / ((a + b) / 2 - chance) if (a + b) / 2 != chance else 1.0
    entropy = lambda xs: -sum(c / len(rows) * math.log(c / len(rows)) for c in Counter(xs).values())
    of_a, of_b = entropy(r[0] for r in rows), entropy(r[1] for r in rows)
    return ari, 2 * (of_a + of_b - entropy(rows)) / (of_a + of_b) if of_a + of_b else 1.0


def test_agreement_equals_counts_of_pairs(spark):
    rng = random.Random(4)
    runs = {i: [(rng.choice("abc"), rng.randint(0, i % 4)) for _ in range(rng.randint(1, 60))] for i in range(12)}
    runs[20], runs[21], runs[22] = [("a", 1)], [("a", 1)] * 9, [(str(i), i) for i in range(9)]
    rows = [(k, a, b, 0) for k, v in runs.items() for a, b in v] + [(None, "a", 1, 0), (3, None, 1, 0), (3, "a", None, 0), (30, None, 1, 0)]
    df = spark.createDataFrame(rows, "run int, a string, b int, n int")
    out = {r["run"]: (r["n"], r["ari"], r["nmi"]) for r in agreement.agreement_by_run(df, "run", "a", "b").collect()}
    assert set(out) == set(runs)
    for k, v in runs.items():
        assert out[k][0] == len(v) and out[k][1:] == pytest.approx(plain_agreement(v), abs=1e-9)
    assert agreement.agreement_by_run(df.limit(0), "run", "a", "b").collect() == []


def test_spread(spark):
    df = spark.createDataFrame([("p", 1.0), ("p", 3.0), ("p", None), ("q", None)], "g string, v double")
    out = {r["g"]: tuple(r)[1:] for r in agreement.spread(df, "v", by=("g",)).collect()}
    assert out == {"p": (2.0, 1.0, 1.0, 3.0, 2.0), "q": (None,) * 5}
    assert tuple(agreement.spread(df.limit(0), "v").first()) == (None,) * 5


def test_joint_statuses(spark):
    rows = [("match", "match"), ("match", None), ("mismatch", "match"), (None, None), ("match", "match"), ("other", "mismatch")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "n int, a string, b string")
    subsets = {"every one": F.lit(True), "late": F.col("n") >= 3, "none": F.col("n") > 99, "null": F.lit(None).cast("boolean")}
    out = {r["subset"]: tuple(r)[1:] for r in agreement.joint_statuses(df, ["a", "b"], subsets).collect()}
    assert out["every one"] == (6, 2, 2 / 6, 2, 2 / 6) and out["late"] == (3, 1, 1 / 3, 1, 1 / 3)
    assert out["none"] == out["null"] == (0, 0, None, 0, None)


def test_accuracy_by_group(spark):
    rows = [("g", "x", "x"), ("g", "x", None), ("g", None, "x"), ("h", "y", "y"), (None, "x", "y"), (None, "x", "x"), ("k", None, None)]
    df = spark.createDataFrame(rows, "g string, t string, n string")
    run = lambda d: {r["part"]: (r["n"], r["correct"]) for r in agreement.accuracy_by_group(d, F.col("g"), F.col("t"), F.col("n")).collect()}
    assert run(df) == {"all": (5, 3), "single": (3, 2), "in_group": (2, 1)}
    assert run(df.limit(0)) == {} and run(df.filter("g = 'k'")) == {}


def test_sizes_after_cleaning(spark):
    rows = [("a", "keep"), ("a", "delete"), ("a", None), ("b", "delete"), (None, "keep")]
    out = agreement.sizes_after(spark.createDataFrame(rows, "g string, action string"), "g").collect()
    assert {tuple(r) for r in out} == {("a", 3, 2), ("b", 1, 0)}


def test_categories(spark):
    table = {"table": (".xls", ".xlsx"), "text": (".txt", ".xls")}
    df = spark.createDataFrame([(p,) for p in ("a/b.XLS", "c.txt", "d", "e.x/y", None, ".txt", "f.txt.zip")], "path string")
    assert [r[0] for r in df.select(files.category(F.col("path"), table, "rest")).collect()] == ["table", "text", "rest", "rest", "rest", "text", "rest"]
    assert [r[0] for r in df.limit(1).select(files.category(F.col("path"), {})).collect()] == [None]
