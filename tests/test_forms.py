"""Word substitutions, repaired splits, kinds of archives, names of variants, against plain versions."""

import io
import random
import zipfile
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lodestone.functions import files
from lodestone.functions import text as T
from lodestone.operators import metrics, sampling, text_pairs


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, before = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


def plain_substitutions(truth, found):
    a, b = Counter(truth), Counter(found)
    missed, invented, out = list((a - b).elements()), list((b - a).elements()), []
    n = len(missed), len(invented)
    for w in missed:
        near = [(edits(w, x), i) for i, x in enumerate(invented) if abs(len(x) - len(w)) <= 2]
        if near and min(near)[0] <= 2:
            out.append((w, invented.pop(min(near)[1])))
    return (*n, out)


def test_word_substitutions(spark):
    rng = random.Random(5)
    words = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 6))) for _ in range(40)]
    rows = [(i, rng.choices(words, k=rng.randint(0, 30)), rng.choices(words, k=rng.randint(0, 30))) for i in range(60)] + [(60, ["a"], ["a"]), (61, [], None)]
    pairs = spark.createDataFrame(rows, "id long, a array<string>, b array<string>")
    got = {r["id"]: (r["n_missed"], r["n_invented"], [tuple(x) for x in r["substitutions"]]) for r in text_pairs.word_substitutions(pairs, "id", F.col("a"), F.col("b")).collect()}
    want = {i: plain_substitutions(a, b or []) for i, a, b in rows}
    assert got == {i: w for i, w in want.items() if w[0] or w[1]}


def test_a_kind_with_groups_has_both_sides(spark):
    rows = [(i, "few", i) for i in range(2)] + [(i, "big", i // 50) for i in range(100, 200)] + [(300, "one", 300)] + [(400 + i, "mixed", 400 + i // 3) for i in range(30)]
    split = sampling.grouped_split(spark.createDataFrame(rows, "id long, kind string, g long"), "id", "kind", "g")
    sides = {r["kind"]: set(r["s"]) for r in split.groupBy("kind").agg(F.collect_set("split").alias("s")).collect()}
    assert split.count() == len(rows)
    assert all(sides[k] == {"train", "test"} for k in ("few", "big", "mixed")) and len(sides["one"]) == 1
    assert split.groupBy("g").agg(F.count_distinct("split").alias("n")).filter("n > 1").isEmpty()


def archive(**members):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, body in members.items():
            z.writestr(name.replace("__", "/"), body)
    return out.getvalue()


def test_kinds_of_archives(spark):
    rows = [
        (archive(**{"[Content_Types].xml": "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main"}), "excel"),
        (archive(**{"word__document.xml": "x"}), "word"), (archive(**{"xl__a.xml": "x"}), "excel"),
        (archive(mimetype="application/vnd.oasis.opendocument.text"), "word"),
        (archive(**{"META-INF__manifest.xml": "a Spreadsheet"}), "excel"),
        (archive(a="b"), None), (b"PK\x03\x04broken", None), (b"%PDF", "pdf"), (b"", None), (None, None), (b"plain", "text"),
        (b"\xd0\xcf\x11\xe0\xa1\xb1", None), (b"RIFF0000WEBP", "image"),
    ]
    table = spark.createDataFrame([(i, c) for i, (c, _) in enumerate(rows)], "id long, c binary")
    got = {r["id"]: r["k"] for r in table.select("id", files.kind(F.col("c")).alias("k")).collect()}
    assert got == {i: want for i, (_, want) in enumerate(rows)}


def test_a_variant_must_be_an_identifier(spark):
    table = spark.createDataFrame([("a b", None)], "o string, s string")
    with pytest.raises(Exception, match="not a variant name"):
        table.select(T.variant(F.col("o"), F.col("s"))).collect()


def test_identity_ranks_of_no_rows(spark):
    none = spark.createDataFrame([(1, None, [1.0])], "id long, a array<double>, b array<double>")
    assert metrics.identity_ranks(none, "id", "a", "b").count() == 0
