"""Gates, pools, positions, answers and references on small awkward tables."""

import pytest
from pyspark.sql import functions as F

from lodestone.functions import answers as A
from lodestone.operators import evaluation as E
from lodestone.operators import gates as G
from lodestone.operators import sampling as S
from lodestone.operators import reports as R
from lodestone.plans import gate_queries
from lodestone.plans.catalog import Tables


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "answer, want",
    [
        (None, (None, None, None)),
        ("", (None, None, None)),
        ("no keys here", (None, None, None)),
        ("ТЕМА: Связь\nТИП: Счёт\nНАЗНАЧЕНИЕ: оплата\nза март", ("Связь", "Счёт", "оплата за март")),
        ("<think>TOPIC: x\n</think>**Topic**: Rent.\n2) type — Act,\nSUMMARY:", ("Rent", "Act", None)),
        ("TOPIC: предметная область: Кадры и т.д.\n_more_", ("Кадры и т.д. more", None, None)),
        ("TYPE: вид документа - Акт и т.д.", (None, "Акт", None)),
    ],
)
def test_answer_parts(spark, answer, want):
    assert tuple(one(spark, A.answer_parts(F.lit(answer)))) == want


def test_enriched_keeps_the_original_without_topic_and_type(spark):
    text = lambda a: one(spark, A.enriched(A.answer_parts(F.lit(a)), F.lit("original")))
    assert text("SUMMARY: s") == "original" and text("TOPIC: t") == "[Тема: t] "
    assert text("TYPE: a\nSUMMARY: b") == "original[Тип: a] [Назначение: b]"


@pytest.mark.parametrize(
    "text, want",
    [
        ("Аренда офиса по договору № 12/3 от 01.02.2024 г.", "Аренда офиса"),
        ("Услуги согласно ДС № 5 по Договору № Д25 за март 2026 г.", "Услуги"),
        ("по договору № 7", "по договору № 7"),
        ("Связь , , за период с 01.03.2026 по 31.03.2026 г., Москва", "Связь,, Москва"),
        ("", ""),
        (None, None),
    ],
)
def test_without_references(spark, text, want):
    assert one(spark, A.without_references(F.lit(text))) == want


def test_positions_and_halves(spark):
    rows = spark.createDataFrame([(i * 7 % 101, "x") for i in range(101)], "k long, x string")
    got = {r["k"]: r["position"] for r in G.numbered(rows, "k").collect()}
    assert got == {k: k for k in range(101)}
    assert sorted(r["k"] for r in G.by_position(rows, "k").collect()) == [k for k in range(101) if k % 10 < 6]
    parts = [r["part"] for r in S.halves(rows, "k").collect()]
    assert (parts.count("train"), parts.count("test")) == (50, 51)
    assert S.halves(rows.limit(0), "k").collect() == [] and G.numbered(rows.limit(0), "k").collect() == []


def test_not_in_with_nulls(spark):
    rows = spark.createDataFrame([(1,), (2,), (None,)], "k long")
    others = lambda *v: spark.createDataFrame([(x,) for x in v], "o long")
    left = lambda o: {r["k"] for r in G.not_in(rows, "k", o).collect()}
    assert left(others(1)) == {2} and left(others(1, None)) == set() and left(others()) == {1, 2, None}


def test_last_runs_takes_listed_columns_only(spark):
    rows = spark.createDataFrame([(1, 5), (2, 9)], "k long, v long")
    assert [r["k"] for r in G.last_runs(rows, "v", 1, ("v",), "k").collect()] == [2]
    with pytest.raises(ValueError):
        G.last_runs(rows, "k; drop", 1, ("v",), "k")


def test_pool_and_cleaning(spark):
    a = spark.createDataFrame([(1, "x"), (2, "x"), (3, "?")], "k long, label string")
    b = spark.createDataFrame([(1, "y"), (4, "y")], "k long, label string")
    known = spark.createDataFrame([("x",), ("y",)], "label string")
    out = G.pooled([a, b], "k", "label", known, spark.createDataFrame([(4,)], "k long"))
    assert {r["k"]: r["label"] for r in out.collect()} == {1: "y", 2: "x"}
    rows = spark.createDataFrame([("a", "a", 10, None, None), ("a", "b", 9, "b", None), ("a", "b", 9, None, "c"), ("a", "b", 8, "b", "b"), ("a", None, 9, "b", "b")], "f string, e string, n int, m string, j string")
    out = G.cleaned_labels(rows, F.col("f"), F.col("e"), F.col("n"), F.col("m"), F.col("j")).collect()
    assert [(r["action"], r["label"]) for r in out] == [("keep", "a"), ("relabel", "b"), ("delete", None), ("keep", "a"), ("keep", "a")]


def test_nearest_ranks_are_values_at_places(spark):
    rows = spark.createDataFrame([("a", v) for v in (5, 1, 1, 9, None)] + [("b", 2)], "g string, v long")
    got = {r["g"]: (r["m"], r["p"]) for r in R.nearest_ranks(rows, "g", "v", {"m": (1, 2), "p": (9, 10)}).collect()}
    assert got == {"a": (5, 9), "b": (2, 2)}


def test_group_out_of_a_label_that_is_one_group(spark):
    rows = spark.createDataFrame([(1, 0, 7, [1.0, 0.0]), (2, 0, 7, [1.0, 0.1]), (3, 1, 8, [0.0, 1.0]), (4, 1, 9, [0.0, 2.0])], "k long, label int, g long, embedding array<double>")
    got = {r["k"]: r for r in E.leave_group_out(rows, "k", "label", "g").collect()}
    assert got[1]["own"] == -2 and not got[1]["correct"] and got[3]["correct"] and abs(got[3]["own"] - 1) < 1e-12


def test_own_groups_and_validity_of_one_cluster(spark):
    rows = spark.createDataFrame([(1, -1), (2, 4), (3, -1)], "k long, label int")
    assert {r["k"]: r["group"] for r in E.own_groups(rows, "k", "label").collect()} == {1: 5, 2: 4, 3: 6}
    alone = spark.createDataFrame([(1, 0, [1.0, 2.0])], "k long, label int, embedding array<double>")
    assert tuple(E.validity(alone).first()) == (None, None, None)


def test_grams_of_names_are_counted_by_many_tasks_however_few_read_them(spark, tmp_path, monkeypatch):
    names = spark.range(2000).select(F.col("id").alias("p_partkey"), F.concat(F.lit("almond antique "), F.col("id")).alias("p_name"))
    names.coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    monkeypatch.setattr(gate_queries, "NAMES_A_PART", 100)
    found = gate_queries.char_gram_vector(Tables(spark, str(tmp_path)))
    sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 20 and max(sizes) < sum(sizes) / 10
