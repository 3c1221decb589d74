"""Comparison of a recognised text with its truth: error rates, word bags, n-gram overlap, paired runs."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from ..functions import text as T

TIE = 0.01
LOOP = 1.5


def char_error_rate(truth: Column, found: Column) -> Column:
    """Edits per character of the truth; 0 for an empty truth."""
    a, b = T.recognised(truth), T.recognised(found)
    return F.when(F.length(a) > 0, F.levenshtein(a, b) / F.length(a)).otherwise(F.lit(0.0))


#: Words that stand this often in a truth keep their bits; the bits of others are made when they are met.
_OFTEN = 64


def edits(a: list[str], b: list[str]) -> int:
    """Least number of words to put in, take out or exchange that makes b of a.

    A column of the table of distances is two whole numbers, a bit a word of a: which differences to the cell above
    are +1 and which -1. So memory grows with the lengths, and a word of b costs a few operations on all bits.
    """
    first, last = 0, 0
    least = min(len(a), len(b))
    while first < least and a[first] == b[first]:
        first += 1
    while last < least - first and a[-1 - last] == b[-1 - last]:
        last += 1
    a, b = a[first : len(a) - last], b[first : len(b) - last]
    if not a or not b:
        return len(a) + len(b)
    places: dict[str, list[int]] = {}
    for i, w in enumerate(a):
        places.setdefault(w, []).append(i)
    bits = lambda at: sum(1 << i for i in at)
    kept = {w: bits(at) for w, at in places.items() if len(at) >= _OFTEN}
    full, top, distance = (1 << len(a)) - 1, len(a) - 1, len(a)
    rises, falls = full, 0
    for w in b:
        same = kept.get(w) if w in kept else bits(places.get(w, ()))
        stays = same | falls
        across = (((same & rises) + rises) ^ rises) | same
        up, down = falls | (full & ~(across | rises)), rises & across
        distance += (up >> top & 1) - (down >> top & 1)
        up, down = (up << 1 | 1) & full, down << 1 & full
        rises, falls = down | (full & ~(stays | up)), up & stays
    return distance


@F.pandas_udf(LongType())
def _edits(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else edits(list(x), list(y)) for x, y in zip(a, b, strict=True)], dtype="Int64")


def word_error_rate(truth: Column, found: Column) -> Column:
    """Word edits per word of the truth."""
    a, b = T.recognised_words(truth), T.recognised_words(found)
    return _edits(a, b) / F.size(a)


def length_coverage(truth: Column, found: Column) -> Column:
    a, b = F.length(T.recognised(truth)), F.length(T.recognised(found))
    return F.when(a > 0, b / a).otherwise(F.when(b > 0, F.lit(1.0)).otherwise(F.lit(0.0)))


def ngram_counts(text: Column, n: int) -> Column:
    """Character n-grams of the compared form; a text shorter than n is one."""
    body = T.recognised(text)
    return F.when(F.length(body) < n, F.array(body)).otherwise(F.transform(F.sequence(F.lit(1), F.greatest(F.length(body) - n + 1, F.lit(1))), lambda i: F.substring(body, i, F.lit(n))))


def bag_overlap(pairs: DataFrame, key: str, truth: Column, found: Column) -> DataFrame:
    """key, n_truth, n_found, common, missed, invented of two arrays as multisets.

    One row for each item and pair, counted before the shuffle; no pair's items are gathered in a task.
    """
    items = lambda c, side: pairs.select(key, F.explode(c).alias("item"), F.lit(side).alias("side"))
    both = items(truth, 1).unionByName(items(found, 0))
    per = both.groupBy(key, "item").agg(F.sum("side").alias("a"), F.sum(1 - F.col("side")).alias("b"))
    return per.groupBy(key).agg(
        F.sum("a").alias("n_truth"), F.sum("b").alias("n_found"), F.sum(F.least("a", "b")).alias("common"),
        F.sum(F.greatest(F.col("a") - F.col("b"), F.lit(0))).alias("missed"), F.sum(F.greatest(F.col("b") - F.col("a"), F.lit(0))).alias("invented"),
    )


def word_substitutions(pairs: DataFrame, key: str, truth: Column, found: Column, most: int = 2) -> DataFrame:
    """key, n_missed, n_invented, substitutions: missed words (in order) each with the nearest invented word not taken yet.

    Nearest is by edits, at most `most` of them, between words whose lengths differ by no more than 2; of equal
    ones the first. Words are counted before the shuffle, and only those that differ are gathered by pair.
    """
    items = lambda c, side: pairs.select(key, F.posexplode(c).alias("at", "item"), F.lit(side).alias("side"))
    both = items(truth, 1).unionByName(items(found, -1))
    surplus = both.groupBy(key, "item").agg(F.sum("side").alias("n"), F.min(F.when(F.col("side") == 1, F.col("at"))).alias("a"), F.min(F.when(F.col("side") == -1, F.col("at"))).alias("b"))
    of = lambda keep, at: F.collect_list(F.when(keep, F.struct(at, "item", F.abs("n").cast("int").alias("n"))))
    sides = surplus.filter("n <> 0").groupBy(key).agg(of(F.col("n") > 0, "a").alias("missed"), of(F.col("n") < 0, "b").alias("invented"))
    spelt = lambda c: F.flatten(F.transform(F.array_sort(c), lambda x: F.array_repeat(x["item"], x["n"])))
    sides = sides.select(key, spelt("missed").alias("missed"), spelt("invented").alias("invented"))
    start = F.struct(F.col("invented").alias("left"), F.array().cast("array<struct<word string, found string>>").alias("out"))

    def step(state: Column, word: Column) -> Column:
        def edits(x: Column, i: Column) -> Column:
            near = F.abs(F.length(x) - F.length(word)) <= 2
            return F.struct(F.when(near, F.levenshtein(x, word)).otherwise(most + 1).alias("d"), i.alias("i"), x.alias("x"))

        def taken(best: Column) -> Column:
            rest = F.filter(state["left"], lambda _, i: i != best["i"])
            pair = F.struct(word.alias("word"), best["x"].alias("found"))
            return F.when(best["d"] <= most, F.struct(rest.alias("left"), F.concat(state["out"], F.array(pair)).alias("out"))).otherwise(state)

        return F.get(F.transform(F.array(F.array_min(F.transform(state["left"], edits))), taken), 0)

    paired_words = F.aggregate("missed", start, step, lambda s: s["out"])
    return sides.select(key, F.size("missed").alias("n_missed"), F.size("invented").alias("n_invented"), paired_words.alias("substitutions"))


def bag_f1(overlap: DataFrame) -> DataFrame:
    """overlap with f1 of precision and recall, 0 without a common item."""
    return overlap.withColumn("f1", 2 * F.col("common") / (F.col("n_truth") + F.col("n_found")))


def gram_similarity(overlap: DataFrame) -> DataFrame:
    """overlap with common / sqrt(n_truth * n_found)."""
    return overlap.withColumn("similarity", F.col("common") / F.sqrt(F.col("n_truth") * F.col("n_found")))


def paired(scores: DataFrame, key: str, a: str, b: str, tie: float = TIE) -> DataFrame:
    """One row: wins, ties and losses of a against b, and in how many pairs a reaches each mark."""
    gap = F.col(a) - F.col(b)
    marks = [F.count_if(F.col(a) >= m).alias(f"at_{int(m * 100)}") for m in (0.95, 0.80, 0.50)]
    return scores.agg(
        F.count(key).alias("pairs"), F.count_if(gap > tie).alias("wins"), F.count_if(F.abs(gap) <= tie).alias("ties"),
        F.count_if(gap < -tie).alias("losses"), *marks, F.avg(gap).alias("mean_gap"),
    )


def tail_mean(scores: DataFrame, score: str, n: int = 20) -> DataFrame:
    """One row: sum of the n lowest scores over n."""
    return scores.select(score).filter(F.col(score).isNotNull()).orderBy(score).limit(n).agg((F.sum(score) / n).alias("tail_mean"))


def loops(truth: Column, found: Column) -> Column:
    """Whether a recogniser ran on: far more text than the truth has."""
    return length_coverage(truth, found) > LOOP


def lost_digits(truth: Column, found: Column) -> Column:
    """Digits of the truth beyond those found."""
    n = lambda c: F.regexp_count(F.coalesce(c, F.lit("")), F.lit("[0-9]"))
    return F.greatest(n(truth) - n(found), F.lit(0))


def mixed_script(text: Column) -> Column:
    """Words with both Latin and Cyrillic letters."""
    return F.size(F.filter(T.recognised_words(text), lambda w: w.rlike("[a-z]") & w.rlike("[а-яё]")))
