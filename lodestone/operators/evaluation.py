"""More evaluation: leave-one-out by group, common cores, cluster validity, accuracy by class, runs and passes.

Theme-sized tables are broadcast after a check of their size; everything else is one aggregation.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import vectors as V
from . import themes as TH


def leave_group_out(vectors: DataFrame, key: str, label: str, group: str, vector: str = "embedding") -> DataFrame:
    """key, label, own, best_other, correct: cosines to the labels' centroids without any row of the row's group.

    A label with no other rows has cosine -2; a row whose own label is left empty counts too. A group's sums
    by label are joined to its rows by the group, and the label sums are a theme-sized table in each task.
    """
    unit = vectors.filter(F.col(label).isNotNull() & F.col(vector).isNotNull()).withColumn("_u", V.normalised(F.col(vector)))
    sums = TH.collected(TH.centroids(unit, label, "_u"), "centroid", "n")
    labels, n = np.array([r["label"] for r in sums]), np.array([r["n"] for r in sums], float)
    total = np.array([r["centroid"] for r in sums], float) * n[:, None] if sums else np.zeros((0, 1))
    sent = vectors.sparkSession.sparkContext.broadcast((labels, n, total))
    of_group = unit.groupBy(F.col(group).alias("_g"), F.col(label).alias("_l")).agg(F.count("*").alias("_n"), *(TH.mean_of("_u").alias("_m"),))
    of_group = of_group.groupBy("_g").agg(F.collect_list(F.struct("_l", "_n", "_m")).alias("_own"))

    @F.pandas_udf("own double, best_other double")
    def score(own_label: pd.Series, units: pd.Series, own: pd.Series) -> pd.DataFrame:
        labels, n, total = sent.value
        x, every = TH._unit(np.stack(units.to_numpy()).astype(float)), np.arange(len(units))
        # All labels by one product; then only those that a row's group has a part of.
        length = np.linalg.norm(total, axis=1)
        sims = np.where(n > 0, x @ total.T / np.where(length > 0, length, 1), -2.0)
        parts = [(i, p["_l"], p["_n"], p["_m"]) for i, ps in enumerate(own) for p in ps]
        row, lab, m, mean = (np.array(c) for c in zip(*parts, strict=True))
        known = np.isin(lab, labels)
        row, m, mean, lab = row[known], m[known], np.stack(mean[known]).astype(float) if known.any() else np.zeros((0, x.shape[1])), np.searchsorted(labels, lab[known])
        rest = total[lab] - mean * m[:, None]
        length = np.linalg.norm(rest, axis=1)
        sims[row, lab] = np.where(n[lab] > m, (rest * x[row]).sum(1) / np.where(length > 0, length, 1), -2)
        at = np.searchsorted(labels, own_label.to_numpy())
        mine = sims[every, at]
        sims[every, at] = -2
        return pd.DataFrame({"own": mine, "best_other": sims.max(1)})

    joined = unit.filter(F.col(label) != TH.NOISE).join(of_group, F.col(group).eqNullSafe(F.col("_g")))
    out = joined.withColumn("_s", score(F.col(label), F.col(vector), F.col("_own")))
    return out.select(key, F.col(label).alias("label"), "_s.own", "_s.best_other", (F.col("_s.own") > F.col("_s.best_other")).alias("correct"))


def common_core(scored: DataFrame, key: str, model: str, similarity: str, correct: str, least: float) -> DataFrame:
    """model, n, accuracy on the rows that every model is sure of."""
    core = scored.groupBy(key).agg(F.min(similarity).alias("_s")).filter(F.col("_s") >= least).select(key)
    return scored.join(core, key, "left_semi").groupBy(model).agg(F.count("*").alias("n"), F.avg(F.col(correct).cast("int")).alias("accuracy"))


def threshold_for(curve: DataFrame, target: float) -> DataFrame:
    """One row: the least threshold of a calibration curve whose accuracy reaches the target, null if none does."""
    return curve.agg(F.min(F.when(F.col("accuracy") >= target, F.col("threshold"))).alias("threshold"))


def silhouettes(vectors: DataFrame, key: str, label: str = "label", vector: str = "embedding") -> DataFrame:
    """key, label, silhouette (cosine): each row compared with all others, exactly, in one pass over the rows.

    For a unit vector u and a label of n rows with sum S, the mean distance is 1 - u.S / n, and to the other
    rows of its own label (n - u.S - (1 - u.u)) / (n - 1); so label sums, which are theme-sized, stand for
    all pairs. A row alone under its label has 0; with less than two labels it is null. Noise, null labels and
    null vectors are left out; a zero vector has distance 1 to every row but itself.
    """
    rows = vectors.filter(F.col(label).isNotNull() & (F.col(label) != TH.NOISE) & F.col(vector).isNotNull())
    unit = rows.withColumn("_u", V.normalised(F.col(vector)))
    sums = TH.collected(TH.centroids(unit, label, "_u"), "centroid", "n")
    labels, n = np.array([r["label"] for r in sums]), np.array([r["n"] for r in sums], float)
    sent = vectors.sparkSession.sparkContext.broadcast((labels, n, np.array([r["centroid"] for r in sums], float)))

    @F.pandas_udf("double")
    def score(own: pd.Series, x: pd.Series) -> pd.Series:
        labels, n, mean = sent.value
        if len(labels) < 2:
            return pd.Series([None] * len(own), dtype="float64")
        u, at, every = TH._unit(np.stack(x.to_numpy()).astype(float)), np.searchsorted(labels, own.to_numpy()), np.arange(len(own))
        near = u @ mean.T
        m = n[at]
        a = (m - 1 - near[every, at] * m + (u * u).sum(1)) / np.maximum(m - 1, 1)
        near[every, at] = -np.inf
        b = 1 - near.max(1)
        most = np.maximum(a, b)
        return pd.Series(np.where((m > 1) & (most > 0), (b - a) / np.where(most > 0, most, 1), 0.0))

    return unit.select(key, F.col(label).alias("label"), score(F.col(label), F.col(vector)).alias("silhouette"))


def validity(vectors: DataFrame, label: str = "label", vector: str = "embedding") -> DataFrame:
    """One row: Davies-Bouldin, Calinski-Harabasz and the mean centroid silhouette (cosine) of a clustering.

    This silhouette compares a row's distance to its own centroid with that to the nearest other one;
    `silhouettes` compares a row with all rows. Labels are theme-sized and broadcast.
    """
    rows = vectors.filter(F.col(label).isNotNull() & (F.col(label) != TH.NOISE) & F.col(vector).isNotNull())
    themes = TH.collected(TH.centroids(rows, label, vector), "centroid", "n")
    labels, n, c = np.array([r["label"] for r in themes]), np.array([r["n"] for r in themes], float), np.array([r["centroid"] for r in themes], float)
    sent = vectors.sparkSession.sparkContext.broadcast((labels, c))

    @F.pandas_udf("distance double, square double, silhouette double")
    def measured(own: pd.Series, x: pd.Series) -> pd.DataFrame:
        labels, c = sent.value
        v, at = np.stack(x.to_numpy()).astype(float), np.searchsorted(labels, own.to_numpy())
        far = np.linalg.norm(v - c[at], axis=1)
        apart = 1 - TH._unit(v) @ TH._unit(c).T
        a = apart[np.arange(len(v)), at]
        apart[np.arange(len(v)), at] = np.inf
        b = apart.min(1)
        return pd.DataFrame({"distance": far, "square": far**2, "silhouette": (b - a) / np.maximum(np.maximum(a, b), 1e-300)})

    m = rows.select(F.col(label).alias("label"), measured(F.col(label), F.col(vector)).alias("m"))
    per = {r["label"]: r for r in m.groupBy("label").agg(F.avg("m.distance").alias("spread"), F.sum("m.square").alias("within"), F.sum("m.silhouette").alias("s")).collect()}
    k, total = len(labels), n.sum()
    if k < 2:
        return vectors.sparkSession.createDataFrame([(None, None, None)], "davies_bouldin double, calinski_harabasz double, silhouette double")
    spread = np.array([per[x]["spread"] for x in labels.tolist()])
    square, worst = (c * c).sum(1), np.empty(k)
    for lo in range(0, k, TH.BLOCK):
        # A block of labels against all, by products: no array of labels x labels x dimensions.
        own = slice(lo, lo + TH.BLOCK)
        gap = np.sqrt(np.maximum(square[own, None] - 2 * c[own] @ c.T + square, 0))
        gap[np.arange(len(gap)), np.arange(lo, lo + len(gap))] = np.inf
        worst[own] = ((spread[own, None] + spread) / gap).max(1)
    db = worst.mean()
    mean = (c * n[:, None]).sum(0) / total
    between, within = (n * ((c - mean) ** 2).sum(1)).sum(), sum(r["within"] for r in per.values())
    row = (float(db), float(between / (k - 1) / (within / (total - k))), float(sum(r["s"] for r in per.values()) / total))
    return vectors.sparkSession.createDataFrame([row], "davies_bouldin double, calinski_harabasz double, silhouette double")


def recall_delta(rows: DataFrame, run: str, base: str, other: str, seed: str, truth: str, hit: str) -> DataFrame:
    """class, mean over seeds of its recall in one run, in another, and the difference; a run without the class has null."""
    per = rows.groupBy(F.col(run).alias("_run"), F.col(seed).alias("_seed"), F.col(truth).alias("class")).agg(F.avg(F.col(hit).cast("int")).alias("_r"))
    mean = lambda name: per.filter(F.col("_run") == name).groupBy("class").agg(F.avg("_r").alias(f"recall_{name}"))
    out = mean(base).join(mean(other), "class", "full")
    return out.withColumn("delta", F.col(f"recall_{other}") - F.col(f"recall_{base}"))


def orientation(rows: DataFrame, truth: str, predicted: str, confidence: str) -> DataFrame:
    """angle (null: all), n, accuracy, mean confidence where right and where wrong."""
    right = F.col(truth) == F.col(predicted)
    out = rows.rollup(F.col(truth).alias("angle")).agg(
        F.count("*").alias("n"), F.avg(right.cast("int")).alias("accuracy"), F.avg(F.when(right, F.col(confidence))).alias("sure_right"),
        F.avg(F.when(~right, F.col(confidence))).alias("sure_wrong"),
    )
    return out


def status_shares(rows: DataFrame, subset: str, fields: list[str]) -> DataFrame:
    """field, subset, status, n and its share of the subset's rows for the field."""
    pairs = F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("status")) for f in fields)))
    n = rows.select(F.col(subset).alias("subset"), pairs.alias("p")).groupBy("p.field", "subset", "p.status").agg(F.count("*").alias("n"))
    return n.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("field", "subset")))


def settled(first: Column, second: Column, sure_first: Column, sure_second: Column, turned: int) -> Column:
    """Of two passes, the second over a turned page: the angle that both name, else the surer one's."""
    back = F.pmod(second - turned, F.lit(360))
    return F.when(first == back, first).when(sure_second > sure_first, back).otherwise(first)


def run_difference(rows: DataFrame, run: str, base: str, other: str, corrected: Column, confidence: str, low: float) -> DataFrame:
    """One row: share corrected, share of low confidence and mean confidence of two runs, and their differences."""
    per = rows.groupBy(F.col(run).alias("_run")).agg(
        F.avg(corrected.cast("int")).alias("corrected"), F.avg((F.col(confidence) < low).cast("int")).alias("low"), F.avg(confidence).alias("confidence")
    )
    names = ("corrected", "low", "confidence")
    one = lambda name: per.filter(F.col("_run") == name).select(*(F.col(c).alias(f"{c}_{name}") for c in names))
    return one(base).join(F.broadcast(one(other))).select("*", *((F.col(f"{c}_{other}") - F.col(f"{c}_{base}")).alias(f"{c}_delta") for c in names))


def banded(similarity: Column, least: float, band: float = 0.12) -> Column:
    """yes at the threshold or above, maybe down to a band below it, else no."""
    return F.when(similarity >= least, "yes").when(similarity >= least - band, "maybe").otherwise("no")


def own_groups(rows: DataFrame, key: str, label: str, name: str = "group") -> DataFrame:
    """rows with a group: the label, or for noise a number of its own beyond all labels, in order of the keys."""
    from .gates import numbered

    top = rows.agg(F.coalesce(F.max(label), F.lit(-1)).alias("_top"))
    alone = numbered(rows.filter(F.col(label) == TH.NOISE), key, name="_at").join(F.broadcast(top))
    alone = alone.withColumn(name, (F.col("_top") + 1 + F.col("_at")).cast("long")).drop("_top", "_at")
    return rows.filter(F.col(label) != TH.NOISE).withColumn(name, F.col(label).cast("long")).unionByName(alone)
