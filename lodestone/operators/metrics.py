"""Evaluation: leave-one-out centroids, neighbours, partition agreement, calibration, classifiers, votes, shares.

Everything is counted on contingency tables or in one pass over the rows; only theme-sized tables are broadcast.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import vectors as V
from . import nearest
from . import themes as TH

MAX_GROUPS = 2_000

#: Similarities that a task of `leave_one_out` holds at a time.
SIMILARITIES = 1 << 21


def leave_one_out(vectors: DataFrame, key: str, label: str = "label", vector: str = "embedding", singles: bool = False) -> DataFrame:
    """key, label, own (cosine to the label's centroid without the row), best_other, correct (own > best_other), in_top_3.

    Vectors are normalised first; rows alone under their label are left out, or with `singles` have own 0, as their
    centroid has no row. in_top_3: fewer than three other labels are at least as similar as the own one. The label
    sums are a theme-sized table sent to each task, so no row is paired with themes.
    """
    unit = vectors.filter(F.col(label).isNotNull() & F.col(vector).isNotNull()).withColumn("_u", V.normalised(F.col(vector)))
    sums = TH.collected(TH.centroids(unit, label, "_u"), "centroid", "n")
    labels, n = np.array([r["label"] for r in sums]), np.array([r["n"] for r in sums], float)
    total = np.array([r["centroid"] for r in sums], float) * n[:, None] if sums else np.zeros((0, 1))
    sent = vectors.sparkSession.sparkContext.broadcast((labels, n, total))

    @F.pandas_udf("own double, best_other double, third_other double")
    def score(own_label: pd.Series, units: pd.Series) -> pd.DataFrame:
        labels, n, total = sent.value
        x, at = TH._unit(np.stack(units.to_numpy()).astype(float)), np.searchsorted(labels, own_label.to_numpy())
        rest = total[at] - x
        length = np.linalg.norm(rest, axis=1)
        own = np.where(n[at] > 1, (rest * x).sum(1) / np.where(length > 0, length, 1), 0.0 if singles else np.nan)
        # Labels may grow with the rows: so many rows at a time that their similarities to all labels fit SIMILARITIES.
        centres, best, third = TH._unit(total).T, np.full(len(x), np.nan), np.full(len(x), -2.0)
        step = max(1, SIMILARITIES // max(1, len(labels)))
        for i in range(0, len(x), step):
            sims = x[i : i + step] @ centres
            sims[np.arange(len(sims)), at[i : i + step]] = -2
            if len(labels) > 1:
                best[i : i + step] = sims.max(1)
            if len(labels) > 3:
                sims.partition(len(labels) - 3, axis=1)
                third[i : i + step] = sims[:, -3]
        return pd.DataFrame({"own": own, "best_other": best, "third_other": third})

    out = unit.filter(F.col(label) != TH.NOISE).withColumn("_s", score(F.col(label), F.col(vector)))
    out = out.select(key, F.col(label).alias("label"), F.col("_s.own").alias("own"), F.col("_s.best_other").alias("best_other"), (F.col("_s.own") > F.col("_s.third_other")).alias("in_top_3"))
    return out.filter(~F.isnan("own")).withColumn("correct", F.col("own") > F.col("best_other"))


def nearest_neighbours(vectors: DataFrame, key: str, k: int = 10, label: str = "label", vector: str = "embedding") -> DataFrame:
    """query, query_label, neighbour, label, similarity, rank: the k rows most similar to each row, itself left out.

    Every row is a query, and all are answered exactly in one job over a vector index. Of equal ones the smaller
    key comes first.
    """
    return nearest.neighbours(nearest.build(vectors, key, vector, label), k)


def identity_ranks(pairs: DataFrame, key: str, truth: str, found: str) -> DataFrame:
    """key, own (cosine of the row's two vectors), rank: 1 + how many rows have a truth more similar to its found vector.

    Every row with both vectors is a query, in one job; tasks add up counts, so no pairs are made.
    """
    out = nearest.ranks(nearest.build(pairs, key, truth, ask=found))
    return out.select(F.col("key").alias(key), "own", (F.col("above") + 1).alias("rank"))


def match_margins(terms: DataFrame, key: str, match: str, vector: str, candidates: DataFrame) -> DataFrame:
    """key, own (cosine to the candidate that is the term's match), best_other, margin, hit (own > best_other).

    candidates: label and centroid, a bounded table. Terms without a vector or a known match are left out.
    """
    rows = TH.collected(candidates, "centroid")
    labels, total = np.array([r["label"] for r in rows]), np.array([r["centroid"] for r in rows], float)
    sent = terms.sparkSession.sparkContext.broadcast((labels, total))

    @F.pandas_udf("own double, best_other double")
    def score(label: pd.Series, vector: pd.Series) -> pd.DataFrame:
        labels, total = sent.value
        sims, at = TH._unit(np.stack(vector.to_numpy()).astype(float)) @ TH._unit(total).T, np.searchsorted(labels, label.to_numpy())
        rows = np.arange(len(sims))
        own = sims[rows, at].copy()
        sims[rows, at] = -2
        return pd.DataFrame({"own": own, "best_other": sims.max(1)})

    known = terms.filter(F.col(vector).isNotNull() & F.col(match).isin([int(x) for x in labels]))
    out = known.withColumn("_s", score(F.col(match), F.col(vector))).select(key, "_s.own", "_s.best_other")
    return out.withColumn("margin", F.col("own") - F.col("best_other")).withColumn("hit", F.col("margin") > 0)


def contingency(rows: DataFrame, a: str, b: str) -> DataFrame:
    return rows.groupBy(F.col(a).alias("a"), F.col(b).alias("b")).agg(F.count("*").cast("double").alias("n"))


def agreement(rows: DataFrame, a: str, b: str) -> DataFrame:
    """One row: adjusted Rand index and normalised mutual information (arithmetic mean) of two labellings."""
    table = contingency(rows, a, b)
    choose = lambda c: F.sum(c * (c - 1) / 2)
    n = F.col("n")
    side = lambda c: table.groupBy(c).agg(F.sum("n").alias("n"))
    total = table.agg(F.sum("n").alias("total"), choose(n).alias("pairs"), F.sum(n * F.log(n)).alias("xlogx"))
    left = side("a").agg(choose(n).alias("pairs_a"), F.sum(n * F.log(n)).alias("xlogx_a"))
    right = side("b").agg(choose(n).alias("pairs_b"), F.sum(n * F.log(n)).alias("xlogx_b"))
    one = total.join(left).join(right)  # one row each
    t = F.col("total")
    expected = F.col("pairs_a") * F.col("pairs_b") / (t * (t - 1) / 2)
    middle = (F.col("pairs_a") + F.col("pairs_b")) / 2
    mutual = (F.col("xlogx") - F.col("xlogx_a") - F.col("xlogx_b")) / t + F.log(t)
    entropy = lambda s: F.log(t) - F.col(s) / t
    mean = (entropy("xlogx_a") + entropy("xlogx_b")) / 2
    return one.select(
        F.when(middle == expected, F.lit(1.0)).otherwise((F.col("pairs") - expected) / (middle - expected)).alias("ari"),
        F.when(mean == 0, F.lit(1.0)).otherwise(mutual / mean).alias("nmi"),
    )


def calibration(scored: DataFrame, own: str = "own", correct: str = "correct", low: int = 300, high: int = 990, step: int = 5, least: int = 50) -> DataFrame:
    """threshold, kept, unknown_share, accuracy at each threshold (in thousandths); fewer than `least` kept are left out.

    Rows are counted by the highest threshold they reach, then summed up: one pass, no row per threshold.
    """
    bins = (high - low) // step
    reached = F.least(F.floor((F.col(own) * 1000 - low) / step + 1e-9), F.lit(bins))
    counted = scored.withColumn("_b", reached).groupBy("_b").agg(F.count("*").alias("n"), F.sum(F.col(correct).cast("long")).alias("right"))
    total = scored.agg(F.count("*").alias("total"))
    grid = scored.sparkSession.range(bins + 1).select(F.col("id").alias("_b"))
    above = Window.orderBy(F.desc("_b")).rowsBetween(Window.unboundedPreceding, 0)
    summed = grid.join(counted, "_b", "left").select("_b", F.sum(F.coalesce("n", F.lit(0))).over(above).alias("kept"), F.sum(F.coalesce("right", F.lit(0))).over(above).alias("right"))
    out = summed.join(F.broadcast(total)).filter(F.col("kept") >= least)
    return out.select(((F.col("_b") * step + low) / 1000).alias("threshold"), "kept", (1 - F.col("kept") / F.col("total")).alias("unknown_share"), (F.col("right") / F.col("kept")).alias("accuracy"))


def classifier(rows: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Per class: n, tp, fp, fn, precision, recall, f1. A null prediction is a miss and no false positive."""
    table = rows.groupBy(F.col(truth).alias("t"), F.col(predicted).alias("p")).agg(F.count("*").alias("n"))
    of_truth = table.groupBy(F.col("t").alias("class")).agg(F.sum("n").alias("n"), F.sum(F.when(F.col("t") == F.col("p"), F.col("n")).otherwise(0)).alias("tp"))
    of_guess = table.filter("p is not null").groupBy(F.col("p").alias("class")).agg(F.sum(F.when(~F.col("t").eqNullSafe(F.col("p")), F.col("n")).otherwise(0)).alias("fp"))
    out = of_truth.filter("class is not null").join(of_guess, "class", "full").fillna(0, ["n", "tp", "fp"])
    per = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    out = out.withColumn("fn", F.col("n") - F.col("tp"))
    out = out.withColumns({"precision": per(F.col("tp"), F.col("tp") + F.col("fp")), "recall": per(F.col("tp"), F.col("n"))})
    return out.withColumn("f1", per(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))


def summary(per_class: DataFrame) -> DataFrame:
    """accuracy over all rows and macro F1 over classes with rows."""
    return per_class.agg((F.sum("tp") / F.sum("n")).alias("accuracy"), F.avg(F.when(F.col("n") > 0, F.col("f1"))).alias("macro_f1"))


def confusions(rows: DataFrame, truth: str, predicted: str, n: int = 12) -> DataFrame:
    """The n most frequent wrong pairs."""
    wrong = rows.filter(~F.col(truth).eqNullSafe(F.col(predicted)))
    return wrong.groupBy(F.col(truth).alias("true_class"), F.col(predicted).alias("predicted_class")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "true_class", "predicted_class").limit(n)


def first_majority(votes: list[Column]) -> Column:
    """The most frequent vote; of equally frequent ones the first to stand in the list."""
    every = F.array(*votes)
    scored = F.transform(every, lambda v, i: F.struct(F.size(F.filter(every, lambda w: w == v)).alias("n"), (-i).alias("i"), v.alias("v")))
    return F.array_max(scored)["v"]


def vote_of_two(a: Column, a_confidence: Column, b: Column, b_confidence: Column) -> Column:
    """struct(label, confidence): agreed with the mean confidence, else the surer one, the first of equals."""
    label = F.when((a == b) | (a_confidence >= b_confidence), a).otherwise(b)
    sure = F.when(a == b, (a_confidence + b_confidence) / 2).otherwise(F.greatest(a_confidence, b_confidence))
    return F.struct(label.alias("label"), sure.alias("confidence"))


def shares(rows: DataFrame, group: str, theme: str) -> DataFrame:
    """group, theme, share of the group's rows."""
    counted = rows.groupBy(F.col(group).alias("group"), F.col(theme).alias("theme")).agg(F.count("*").alias("n"))
    return counted.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("group"))).drop("n")


def divergence(shared: DataFrame) -> DataFrame:
    """a, b, js (nats), cosine of each two groups' shares; themes that a group lacks count as 0.

    The result is a row for each pair, so more than MAX_GROUPS groups are an error. The join is on the theme, and what only one of
    two has adds share * ln 2 / 2 to js.
    """
    if shared.select("group").distinct().limit(MAX_GROUPS + 1).count() > MAX_GROUPS:
        raise ValueError(f"more than {MAX_GROUPS} groups")
    x, y = (shared.select(F.col("group").alias(g), "theme", F.col("share").alias(s)) for g, s in (("a", "p"), ("b", "q")))
    both = x.join(y, "theme").filter("a < b")
    m = (F.col("p") + F.col("q")) / 2
    common = both.groupBy("a", "b").agg(
        F.sum((F.col("p") * F.log(F.col("p") / m) + F.col("q") * F.log(F.col("q") / m)) / 2).alias("js_common"),
        F.sum("p").alias("sum_p"), F.sum("q").alias("sum_q"), F.sum(F.col("p") * F.col("q")).alias("pq"),
    )
    groups = shared.groupBy("group").agg(F.sqrt(F.sum(F.col("share") * F.col("share"))).alias("length"))
    pairs = groups.select(F.col("group").alias("a"), F.col("length").alias("length_a")).join(groups.select(F.col("group").alias("b"), F.col("length").alias("length_b")), F.expr("a < b"))
    out = pairs.join(common, ["a", "b"], "left").fillna(0.0, ["js_common", "sum_p", "sum_q", "pq"])
    return out.select("a", "b", (F.col("js_common") + (2 - F.col("sum_p") - F.col("sum_q")) * F.log(F.lit(2.0)) / 2).alias("js"), (F.col("pq") / (F.col("length_a") * F.col("length_b"))).alias("cosine"))


def over_seeds(rows: DataFrame, key: str, value: str) -> DataFrame:
    """mean, least, most and population deviation of a value over runs; null values are passed over."""
    v = F.col(value)
    return rows.groupBy(key).agg(F.avg(v).alias("mean"), F.min(v).alias("least"), F.max(v).alias("most"), F.stddev_pop(v).alias("deviation"))


def within_clusters(vectors: DataFrame, themes: DataFrame) -> DataFrame:
    """label, n, mean, median and least cosine of the members to their centroid."""
    scored = vectors.join(F.broadcast(TH.bounded(themes).select("label", "centroid")), "label")
    s = V.cosine(F.col("embedding"), F.col("centroid"))
    return scored.withColumn("s", s).groupBy("label").agg(F.count("*").alias("n"), F.avg("s").alias("mean"), F.percentile("s", 0.5).alias("median"), F.min("s").alias("least"))
