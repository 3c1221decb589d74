"""Work that must be dealt to all tasks, or left out, as tables grow."""

import math
import os
import random

import pytest
from pyspark.sql import functions as F

from lodestone.operators import graph, reports, themes
from lodestone.plans import registry

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@tables
def test_invoices_are_written_by_all_tasks(spark):
    assert registry.queries()["invoice_text"](spark, FOLDER).rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


@tables
def test_references_are_looked_for_by_all_tasks(spark):
    assert registry.queries()["without_references"](spark, FOLDER).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_percentiles_are_those_of_spark_without_one_task_for_all(spark, monkeypatch):
    rng = random.Random(3)
    shares = [0.0, 0.003, 0.25, 0.5, 0.997, 1.0]
    for values in ([rng.gauss(0, 1) for _ in range(500)] + [None] * 5, [1.5] * 7 + [2.5], [4.0], [None], []):
        rows = spark.createDataFrame([(v, v) for v in values], "x double, y double")
        assert reports.percentiles(rows, "x", shares) == list(rows.agg(*(F.percentile("x", p) for p in shares)).first())
    monkeypatch.setattr(F, "percentile", None)
    rows = spark.createDataFrame([(float(i % 10), float(i)) for i in range(100)], "x double, y double")
    assert reports.histogram_2d(rows, "x", "y", 4).agg(F.sum("n")).first()[0] == 100


def test_terms_that_cannot_be_among_the_best_are_not_scored(spark, monkeypatch):
    rng = random.Random(4)
    names = ["".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(300)]
    docs = [(rng.choice(["p", "q", "r", None]), " ".join(names[int(rng.random() ** 3 * 300)] for _ in range(80))) for _ in range(60)] + [("few", "one two"), ("none", "")]
    sizes, kept = [], graph.kept
    monkeypatch.setattr(graph, "kept", lambda df, path: (out := kept(df, path), sizes.append(out.count()))[0])
    frame = spark.createDataFrame(docs, "g string, text string")
    got = {(r["group"], r["term"]): (r["tf"], round(r["score"], 9), r["rank"]) for r in themes.class_terms(frame, "g").collect()}
    assert len(sizes) == 2 and sizes[1] < sizes[0] / 3
    count = {}
    for g, text in docs:
        w = text.split()
        for term in w + [f"{a} {b}" for a, b in zip(w, w[1:])]:
            count.setdefault(g, {}).setdefault(term, 0)
            count[g][term] += 1
    mean = sum(sum(c.values()) for c in count.values()) / len(count)
    score = lambda g, t: round(count[g][t] * math.log(1 + mean / sum(t in c for c in count.values())), 9)
    want = {(g, t): (c[t], score(g, t), k + 1) for g, c in count.items() for k, t in enumerate(sorted(c, key=lambda t: (-score(g, t), t))[:10])}
    assert got.keys() == want.keys() and all(got[k][0] == want[k][0] and got[k][2] == want[k][2] and abs(got[k][1] - want[k][1]) < 1e-6 for k in want)


@tables
def test_words_are_compared_by_all_tasks(spark):
    plan = registry.queries()["word_substitutions"](spark, FOLDER)._jdf.queryExecution().toString()
    assert f"RoundRobinPartitioning({spark.sparkContext.defaultParallelism})" in plan
