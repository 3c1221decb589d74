"""Operators whose work is spread or bounded anew, against plain versions."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestone.operators import metrics, sampling, themes
from lodestone.sources import sinks


def plain_merge(rows, threshold):
    """The closest two, tried anew over all pairs, until none is near enough."""
    sums = {label: np.array(c, float) * n for label, c, n in rows}
    owner = {label: label for label in sums}
    cosine = lambda a, b: a @ b / ((np.linalg.norm(a) or 1) * (np.linalg.norm(b) or 1))
    while len(sums) > 1:
        best = max(((cosine(sums[a], sums[b]), -a, -b) for a in sums for b in sums if a < b))
        if best[0] < threshold:
            break
        a, b = -best[1], -best[2]
        sums[a] = sums[a] + sums.pop(b)
        owner = {k: a if v == b else v for k, v in owner.items()}
    number = {old: new for new, old in enumerate(sorted(set(owner.values())))}
    return {k: number[v] for k, v in owner.items()}


@pytest.mark.parametrize("threshold", [-1.0, 0.2, 0.6, 0.9, 0.99, 1.1])
def test_merge_is_that_of_all_pairs(spark, threshold):
    rng = np.random.default_rng(8)
    rows = [(int(i * 3 + 1), (rng.normal(size=5) + 2 * rng.integers(0, 2, size=5)).tolist(), int(rng.integers(1, 9))) for i in range(40)]
    rows += [(500, [0.0] * 5, 3), (501, [0.0] * 5, 1)]
    got = themes.merge_themes(spark.createDataFrame(rows, "label int, centroid array<double>, n long"), threshold)
    assert got == plain_merge(rows, threshold)


def test_merge_of_one_theme_and_of_none(spark):
    one = spark.createDataFrame([(7, [1.0, 0.0], 2)], "label int, centroid array<double>, n long")
    assert themes.merge_themes(one, 0.5) == {7: 0} and themes.merge_themes(one.filter("false"), 0.5) == {}


def test_relabelled_keeps_what_the_mapping_lacks(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (-1, "c"), (None, "d"), (9, "e")], "label int, _x string")
    out = themes.relabelled(rows, {1: 5, 2: 1, 30: 4})
    assert out.schema == rows.schema
    assert {r["_x"]: r["label"] for r in out.collect()} == {"a": 5, "b": 1, "c": -1, "d": None, "e": 9}
    assert themes.relabelled(rows, {}).collect() == rows.collect()


@pytest.mark.parametrize("order", ["i", "-i", "x,-i"])
def test_budget_of_a_group_over_many_ranges(spark, order):
    rng = random.Random(4)
    rows = [(rng.choice("aaaaab") if i % 50 else None, i, rng.choice([None, 0, *range(9)]), rng.randrange(3)) for i in range(2000)]
    df = spark.createDataFrame(rows, "g string, i int, size int, x int").repartition(6)
    with_many = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = sorted(tuple(r) for r in sampling.within_budget(df, "g", "size", 1500, *(F.desc(c[1:]) if c[0] == "-" else c for c in order.split(","))).select("i").collect())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", with_many)
    key = {"i": lambda r: r[1], "-i": lambda r: -r[1], "x,-i": lambda r: (r[3], -r[1])}[order]
    want = []
    for g in ("a", "b", None):
        before = 0
        for r in sorted((r for r in rows if r[0] == g), key=key):
            if before < 1500:
                want.append((r[1],))
            before += r[2] or 0
    assert got == sorted(want)
    assert sampling.within_budget(df.filter("false"), "g", "size", 10, "i").collect() == []


def test_bounds_are_errors_not_losses(spark, tmp_path):
    with pytest.raises(ValueError, match="more than 3 rows"):
        sinks.report(spark.range(4), str(tmp_path / "r"), most=3)
    sinks.report(spark.range(3), str(tmp_path / "r"), most=3)
    assert spark.read.option("header", True).csv(str(tmp_path / "r")).count() == 3
    many = spark.range(metrics.MAX_GROUPS + 1).select(F.col("id").alias("group"), F.lit("t").alias("theme"), F.lit(1.0).alias("share"))
    with pytest.raises(ValueError, match="groups"):
        metrics.divergence(many)
