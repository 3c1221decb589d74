"""Operators without an SQL twin, and their invariants."""

import os
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestone.functions import answers
from lodestone.operators import changes, dedup, graph, metrics, sampling, text_pairs, themes
from lodestone.sources import readers, sinks
from lodestone.streaming import incremental


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")


def test_assignment_takes_the_smallest_of_equal_themes_and_nulls_are_unknown(spark):
    t = spark.createDataFrame([(5, [1.0, 0.0]), (2, [2.0, 0.0]), (9, [0.0, 1.0])], "label int, centroid array<double>")
    rows = vectors(spark, [(1, [3.0, 0.0], 0), (2, None, 0), (3, [0.0, 0.0], 0), (4, [0.6, 0.8], 0)])
    got = {r["vec_id"]: (r["assigned_theme"], r["similarity"], r["is_unknown"]) for r in themes.assign(rows, t).collect()}
    assert got[1] == (2, 1.0, False)
    assert got[2] == (None, None, True)
    assert got[3][1:] == (0.0, True)
    assert got[4][0] == 9 and got[4][2] == (got[4][1] < 0.8)


def test_merge_leaves_no_pair_at_the_threshold(spark):
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 1) + (i % 3) * 4 for _ in range(4)], i % 12) for i in range(120)]
    t = themes.centroids(vectors(spark, rows))
    mapping = themes.merge_themes(t, 0.9)
    assert sorted(set(mapping.values())) == list(range(len(set(mapping.values()))))
    merged = themes.relabelled(vectors(spark, rows), mapping)
    again = themes.merge_themes(themes.centroids(merged), 0.9)
    assert len(set(again.values())) == len(again)


def test_greedy_and_registry(spark):
    t = spark.createDataFrame([(0, [1.0, 0.0], 20), (1, [0.99, 0.1], 30), (2, [0.0, 1.0], 10), (3, [0.0, 2.0], 5)], "label int, centroid array<double>, n long")
    assert themes.greedy_topics(t, 0.68) == {0: 0, 1: 0, 2: 2, 3: 2}
    assert themes.extend_registry(t.filter("label = 0"), t.filter("label > 0")) == {1: 0, 2: 1}


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(100, 101), (101, 100)], "a long, b long")
    got = {r["node"]: r["root"] for r in graph.components(edges).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, 100: 100, 101: 100}


def test_near_duplicates_and_split(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghijkl") for _ in range(7))
    base = [" ".join(word() for _ in range(60)) for _ in range(6)]
    near = [b.rsplit(" ", 1)[0] + " " + word() for b in base[:3]]
    rows = list(enumerate(base + near + [base[0].upper(), None, ""]))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["group_id"] for r in dedup.near(docs, "doc_id").collect()}
    assert got == {0: 0, 1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: 0, 7: 1, 8: 2, 9: 0, 10: 10, 11: 10}
    groups = spark.createDataFrame([(i, "k", i // 3) for i in range(300)] + [(i, "big", 999) for i in range(300, 360)], "doc_id long, kind string, g long")
    split = sampling.grouped_split(groups, "doc_id", "kind", "g")
    torn = split.groupBy("g").agg(F.count_distinct("split").alias("n")).filter("n > 1")
    assert torn.isEmpty() and split.filter("g = 999 and split = 'test'").isEmpty()
    assert 66 <= split.filter("split = 'test'").count() <= 69


def test_large_sets_that_differ_are_not_held_against_each_other(spark):
    # Parities of BITS groups let any two sets of 4,000 pass; sketches let pass what is similar, at all sizes.
    rng = np.random.default_rng(5)
    fresh = lambda k: rng.integers(0, 2**63, k, dtype=np.uint64)
    a, b, small = fresh(4000), fresh(4000), fresh(900)
    sets = [a, b, small, np.concatenate([a[:3700], fresh(300)]), np.concatenate([a, fresh(2000)]), np.concatenate([a, fresh(200)]), np.concatenate([small, fresh(300)])]
    names = ["i", "n", *dedup.PARITIES, "sketch"]
    rows = spark.createDataFrame([(i, len(g), *dedup.parities(g).tolist(), dedup.sketch(g).tolist()) for i, g in enumerate(sets)], f"i long, n long, {', '.join(f'{w} long' for w in dedup.PARITIES)}, sketch array<long>")
    side = lambda s: rows.select(*(F.col(c).alias(f"{c}_{s}") for c in names))
    pairs = side("x").join(side("y"), F.col("i_x") < F.col("i_y")).filter(dedup._can_link("x", "y", 0.8))
    loose, tight = ({(r[0], r[1]) for r in df.select("i_x", "i_y").collect()} for df in (pairs, pairs.filter(dedup._sketches_fit("x", "y", 0.8))))
    assert (0, 1) in loose and (0, 1) not in tight
    cosine = lambda x, y: len(np.intersect1d(x, y)) / np.sqrt(len(x) * len(y))
    links = {(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets)) if cosine(sets[i], sets[j]) >= 0.8}
    assert {(0, 3), (0, 4), (0, 5), (2, 6)} <= links <= tight


def test_near_duplicates_are_all_links_of_crowded_buckets(spark):
    rng = random.Random(9)
    vocabulary = ["".join(rng.choice("abcdefghijklmnop") for _ in range(7)) for _ in range(90)]
    texts = [rng.sample(vocabulary, 50) for _ in range(260)]
    for k in range(60):
        copy = list(texts[k])
        for at in rng.sample(range(50), 7 + k % 4):
            copy[at] = rng.choice(vocabulary)
        texts.append(copy)
    rng.shuffle(texts)
    texts = [" ".join(t) for t in texts]
    sets = [set(dedup.grams(t).tolist()) for t in texts]
    keys = [set(dedup.band_keys(dedup.grams(t))) for t in texts]
    root = list(range(len(texts)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    shared = linked = 0
    for i in range(len(texts)):
        for j in range(i):
            if keys[i] & keys[j]:
                shared += 1
                if len(sets[i] & sets[j]) >= 0.8 * (len(sets[i]) * len(sets[j])) ** 0.5:
                    linked += 1
                    x, y = sorted((top(i), top(j)))
                    root[y] = x
    assert shared > 10 * len(texts) and linked > 30
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["group_id"] for r in dedup.near(docs, "doc_id").collect()}
    assert got == {i: top(i) for i in range(len(texts))}


def test_word_errors_against_plain_edit_distance(spark):
    pairs = [("a b c", "a x c"), ("a b", "a b c d"), ("", "a"), ("q", "")]
    rows = spark.createDataFrame(pairs, "truth string, found string")
    got = [r["w"] for r in rows.select(text_pairs.word_error_rate(F.col("truth"), F.col("found")).alias("w")).collect()]
    assert got == [1 / 3, 1.0, 1.0, 1.0]


def test_word_edits_against_the_plain_table():
    rng = random.Random(4)

    def table(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            before, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
        return row[-1]

    for _ in range(400):
        words = [str(i) for i in range(rng.choice([2, 5, 60]))]
        a, b = ([rng.choice(words) for _ in range(rng.randrange(0, 90))] for _ in range(2))
        assert text_pairs.edits(a, b) == table(a, b)
    assert text_pairs.edits(["x"] * 300 + ["y"], ["y"] + ["x"] * 300) == 2


def test_word_edits_of_very_long_pairs(spark):
    # More different words than the 16-bit characters that once stood for them.
    a = [f"w{i}" for i in range(60_000)]
    b = [f"v{i}" if i % 1000 == 0 else w for i, w in enumerate(a) if i % 777]
    began = time.time()
    assert text_pairs.edits(a, b) == len(a) - len(b) + sum(i % 777 > 0 for i in range(0, len(a), 1000))
    assert time.time() - began < 60
    rows = spark.createDataFrame([(" ".join(a), " ".join(a[1:])), (None, "x"), ("x", None)], "truth string, found string")
    got = [r["w"] for r in rows.select(text_pairs.word_error_rate(F.col("truth"), F.col("found")).alias("w")).collect()]
    assert got[0] == 1 / 60_000


def test_references_of_texts_with_many_digits(spark):
    began = time.time()
    texts = ["услуги по договору № 5 " + " ".join(str(i) for i in range(3000)), "сумма " + "1 2 3 " * 3000, None, ""]
    got = [r["t"] for r in spark.createDataFrame([(t,) for t in texts], "text string").select(answers.without_references(F.col("text")).alias("t")).collect()]
    assert got[0] == "услуги" and got[1].endswith("1 2 3") and len(got[1]) > 17_000 and got[2:] == [None, ""]
    assert time.time() - began < 60


def test_neighbours_against_all_pairs(spark):
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 1) for _ in range(8)], i % 3) for i in range(60)]
    got = {(r["query"], r["rank"]): r["neighbour"] for r in metrics.nearest_neighbours(vectors(spark, rows), "vec_id", 4).collect()}
    unit = {i: [x / sum(y * y for y in v) ** 0.5 for x in v] for i, v, _ in rows}
    for q in unit:
        best = sorted((-sum(a * b for a, b in zip(unit[q], unit[j], strict=True)), j) for j in unit if j != q)[:4]
        assert [got[q, k + 1] for k in range(4)] == [j for _, j in best]


def test_every_row_is_a_query_and_too_many_themes_are_an_error(spark, monkeypatch):
    # More rows than the 15,000 that were queries at most.
    rows = spark.range(15_200).selectExpr("id as vec_id", "array(cos(id * 0.0004), sin(id * 0.0004)) as embedding", "cast(id % 3 as int) as label")
    got = metrics.nearest_neighbours(rows, "vec_id", 1).groupBy("query").count()
    assert got.count() == 15_200 and got.filter("count <> 1").isEmpty()
    monkeypatch.setattr(themes, "MAX_THEMES", 2)
    small = rows.limit(30)
    found = spark.createDataFrame([(i, [1.0, 0.0]) for i in range(3)], "label int, centroid array<double>")
    for call in (lambda: metrics.within_clusters(small, found), lambda: themes.top_members(small, found, "vec_id"), lambda: themes.second_level(small)):
        with pytest.raises(ValueError):
            call()


def test_updates(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, v string")
    new = spark.createDataFrame([(2, "b"), (3, "c"), (4, "d")], "k int, v string")
    assert {tuple(r) for r in changes.upsert(old, new, ["k"]).collect()} == {(1, "a"), (2, "b"), (3, "c"), (4, "d")}
    assert {tuple(r) for r in changes.update(old, new, ["k"], ["v"], True).collect()} == {(1, "a", False), (2, "b", False), (3, "c", True)}
    assert {tuple(r) for r in changes.insert_missing(old, new, ["k"]).collect()} == {(1, "a"), (2, "b"), (3, None), (4, "d")}


def test_sources_and_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("  x\n")
    (tmp_path / "in" / "b.csv").write_text(" a , ,b\n,,\nc\n")
    got = {os.path.basename(r["path"]): r["text"] for r in readers.delimited(spark, f"{tmp_path}/in").collect()}
    assert got["b.csv"] == "a | b\nc"
    xml = spark.createDataFrame([("<a x='1'><b/></a>",), ("broken <",), (None,)], "xml string")
    assert [r["structure"] for r in readers.xml_structure(xml).collect()] == ["/a /a/@x /a/b", "broken <", None]
    rows = vectors(spark, [(i, [float(i % 2), 1.0], i % 2) for i in range(10)])
    sinks.table(rows, f"{tmp_path}/vectors")
    registry = themes.centroids(rows)
    for _ in range(2):
        stream = spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/vectors")
        incremental.assign_stream(stream, registry, f"{tmp_path}/out", f"{tmp_path}/cp", "vec_id").awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out").count() == 10
    with pytest.raises(ValueError):
        sinks.run_state("paused")


def test_leave_one_out_holds_few_similarities_at_a_time(spark, monkeypatch):
    # 90 labels, some of them single: each batch is scored in pieces, with the same result.
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=8).tolist(), i % 60 if i % 4 else 100 + i) for i in range(240)]
    score = lambda: sorted(map(tuple, metrics.leave_one_out(vectors(spark, rows).withColumnRenamed("embedding", "v"), "vec_id", vector="v", singles=True).collect()))
    whole = score()
    monkeypatch.setattr(metrics, "SIMILARITIES", 256)
    pieces = score()
    assert len(whole) == 240 and [r[0] for r in whole] == [r[0] for r in pieces]
    for a, b in zip(whole, pieces, strict=True):
        assert a[1] == b[1] and a[4:] == b[4:] and a[2:4] == pytest.approx(b[2:4])
