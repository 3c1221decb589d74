"""Column functions on hand-made rows, nulls and empty values among them."""

import pytest
from pyspark.sql import functions as F

from lodestone.functions import files, text, validate, vectors


def value(spark, column, **row):
    kinds = {str: "string", int: "int", float: "double", bytes: "binary", list: "array<double>"}
    schema = ", ".join(f"{k} {kinds.get(type(v), 'string')}" for k, v in row.items())
    return spark.createDataFrame([tuple(row.values())], schema).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "raw, want",
    [(None, "none"), (" \n ", "none"), ("a" * 99, "poor"), ("a" * 100, "good"), ("1" * 71 + "я" * 29, "poor"), ("1" * 70 + "я" * 30, "good")],
)
def test_quality(spark, raw, want):
    assert value(spark, text.quality(F.col("t")), t=raw) == want


def test_single_letters_join(spark):
    assert value(spark, text.joined_single_letters(F.col("t")), t="С Ч Е Т на о п л а т у") == "СЧЕТ на оплату"


def test_first_rule_wins_and_only_rule_is_single(spark):
    rules = [("a", "счет"), ("b", "акт")]
    assert value(spark, text.first_rule(F.col("t"), rules), t="Акт и СЧЕТ") == "a"
    assert value(spark, text.only_rule(F.col("t"), rules), t="Акт и СЧЕТ") is None
    assert value(spark, text.only_rule(F.col("t"), rules), t="АКТ") == "b"
    assert value(spark, text.first_rule(F.col("t"), rules), t=None) is None


def test_empty_field_does_not_take_the_next_line(spark):
    raw = "Предмет:\nТИП: акт\n"
    assert value(spark, text.field(F.col("t"), "ПРЕДМЕТ"), t=raw) is None
    assert value(spark, text.field(F.col("t"), "ТИП"), t=raw) == "акт"


def test_text_forms(spark):
    t = F.col("t")
    assert value(spark, text.head_tail(t, 4, "|"), t="abcdef") == "ab|ef"
    assert value(spark, text.without_reasoning(t), t="<think>x\ny</think> ok") == "ok"
    assert value(spark, text.canonical_type(t, "Без типа"), t="  СЧЁТ   на ") == "Счет на"
    assert value(spark, text.canonical_type(t, "Без типа"), t=None) == "Без типа"
    assert value(spark, text.without_markup(t), t="[a](u) ![b](u) <i>c</i>\n\n\n\nd") == "a !b c\n\nd"
    assert value(spark, text.most_alphabetic(t), t="12\tab 7\tcd") == "ab"
    assert value(spark, F.size(text.recognised_words(t)), t=None) == 1
    assert value(spark, text.duplicate_key(t), t=" A  12 b34 ") == "a 0 b0"
    assert value(spark, text.ritual(t), t="Услуги оказаны в срок") is True
    assert value(spark, text.code(t, ["T1"]), t="ответ: t1") == "T1"
    assert value(spark, F.array_join(text.compressed_runs(F.split(t, ",")), ","), t="a,a,b,a") == "a (×2),b,a"


def test_tax_numbers(spark):
    holds = validate.tax_number_holds(F.col("t"))
    for number, want in (("7707083893", True), ("7707083894", False), ("500100732259", True), ("500100732258", False), ("77070838931", False), ("", False), (None, False)):
        assert value(spark, holds, t=number) is want


def test_counterparty(spark):
    got = value(spark, validate.counterparty(F.col("t")), t="ООО Ромашка | ИНН 7707083893 | КПП 770701001 | Москва")
    assert tuple(got) == ("ООО Ромашка", "7707083893", "770701001", "Москва")
    assert tuple(value(spark, validate.counterparty(F.col("t")), t=None)) == (None, None, None, None)


@pytest.mark.parametrize(
    "found, short, full, want",
    [
        ("ООО «Ромашка»", "Ромашка", None, "match"),
        ("Ромашка Плюс", None, "Общество с ограниченной ответственностью Ромашка", "match"),
        ("Ромашко Поле", "Поле Ромашка", None, "match"),
        ("Лютик", "Ромашка", None, "mismatch"),
        ("", "Ромашка", None, "llm_missing"),
        ("Лютик", None, "", "edo_missing"),
    ],
)
def test_names(spark, found, short, full, want):
    assert value(spark, validate.name_status(F.col("a"), F.col("b"), F.col("c")), a=found, b=short, c=full) == want


def test_common_subsequence(spark):
    for a, b, want in (("abcd", "acbd", 3), ("", "x", 0), ("abc", "abc", 3), ("xaybz", "ab", 2)):
        assert value(spark, validate.common_subsequence(F.col("a"), F.col("b")), a=a, b=b) == want


def test_signatures(spark):
    for content, want in ((b"%PDF-1.4", "pdf"), (b"PK\x03\x04xx", "zip"), (b"plain text", "text"), (b"\0\1\0\2\0\3", None), (b"", None)):
        assert value(spark, files.signature(F.col("c")), c=content) == want
    assert value(spark, files.is_marked(F.col("t")), t="a_b_c_d_e_f_g_1") is True
    assert value(spark, files.is_marked(F.col("t")), t="a_b") is False


def test_vectors(spark):
    a, b = [3.0, 4.0], [0.0, 0.0]
    assert value(spark, vectors.normalised(F.col("a")), a=a) == [0.6, 0.8]
    assert value(spark, vectors.normalised(F.col("a")), a=b) == b
    assert value(spark, vectors.cosine(F.col("a"), F.col("b")), a=a, b=b) == 0.0
    assert value(spark, vectors.combined(F.col("a"), F.col("b")), a=a, b=b) == [1.5, 2.0]
