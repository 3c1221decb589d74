"""Themes: centroids, nearest-centroid assignment, override, drift, merging, the registry, top terms.

A theme table is small by nature (a row a theme); where it goes to the driver or to every executor, its
size is checked against MAX_THEMES first. Vectors never leave the executors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import vectors as V
from . import graph

NOISE, OVERRIDE_THEME = -1, 90
ASSIGN, MERGE, REGISTRY, TOPIC_MERGE = 0.8, 0.92, 0.90, 0.68
MAX_THEMES = 20_000
#: Themes that one matrix product holds.
BLOCK = 4_096
_ASSIGNED = "assigned_theme int, similarity double, second_similarity double"


def centroids(vectors: DataFrame, label: str = "label", vector: str = "embedding") -> DataFrame:
    """label, centroid (mean, not normalised), n; noise, null labels and null vectors are left out.

    One aggregation: each task sends a partial sum for each label, whatever the number of rows.
    """
    known = vectors.filter(F.col(label).isNotNull() & (F.col(label) != NOISE) & F.col(vector).isNotNull())
    mean = Summarizer.mean(array_to_vector(F.col(vector).cast("array<double>")))
    return known.groupBy(F.col(label).cast("int").alias("label")).agg(vector_to_array(mean).alias("centroid"), F.count("*").alias("n"))


def mean_of(vector: str) -> Column:
    """Mean of a group's vectors."""
    return vector_to_array(Summarizer.mean(array_to_vector(F.col(vector).cast("array<double>"))))

#: Below any similarity: no other theme is left, or the theme itself is gone.
_ALONE, _GONE = -2.0, -3.0


def collected(themes: DataFrame, *columns: str) -> list:
    """The rows of a theme table, on the driver, in order of their labels."""
    rows = themes.select("label", *columns).limit(MAX_THEMES + 1).collect()
    if len(rows) > MAX_THEMES:
        raise ValueError(f"more than {MAX_THEMES} themes")
    return sorted(rows, key=lambda r: r["label"])


def bounded(themes: DataFrame) -> DataFrame:
    """The theme table itself; an error where it has more than MAX_THEMES rows."""
    if themes.limit(MAX_THEMES + 1).count() > MAX_THEMES:
        raise ValueError(f"more than {MAX_THEMES} themes")
    return themes


def _unit(matrix: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(matrix, axis=1, keepdims=True)
    return matrix / np.where(length > 0, length, 1.0)


def scorer(themes: DataFrame):
    """vector column -> struct(assigned_theme, similarity, second_similarity) by cosine; of equal ones the smallest label."""
    rows = collected(themes, "centroid")
    labels = np.array([r["label"] for r in rows], np.int64)
    matrix = _unit(np.array([r["centroid"] for r in rows], float)) if rows else np.zeros((0, 1))
    sent = themes.sparkSession.sparkContext.broadcast((labels, matrix))

    @F.pandas_udf(_ASSIGNED)
    def nearest(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        labels, matrix = sent.value
        for vectors in parts:
            known = vectors.notna().to_numpy()
            out = pd.DataFrame({"assigned_theme": pd.array([pd.NA] * len(vectors), "Int32"), "similarity": np.nan, "second_similarity": np.nan})
            if known.any() and len(labels):
                x = _unit(np.stack(vectors[known].to_numpy()).astype(float))
                best, second, at = np.full(len(x), -2.0), np.full(len(x), -2.0), np.zeros(len(x), np.int64)
                for lo in range(0, len(labels), BLOCK):
                    s = x @ matrix[lo : lo + BLOCK].T
                    two = -np.partition(-s, min(1, s.shape[1] - 1), axis=1)[:, :2]
                    top, i = s.max(1), s.argmax(1)
                    runner = two[:, 1] if s.shape[1] > 1 else np.full(len(x), -2.0)
                    second = np.maximum(np.where(top > best, best, top), np.maximum(np.where(top > best, runner, second), np.where(top > best, -2.0, second)))
                    at, best = np.where(top > best, lo + i, at), np.maximum(best, top)
                out.loc[known, "assigned_theme"] = labels[at].astype(np.int32)
                out.loc[known, "similarity"] = best
                out.loc[known, "second_similarity"] = np.where(second > -2, second, np.nan)
            yield out

    return nearest


def assign(vectors: DataFrame, themes: DataFrame, vector: str = "embedding", threshold: float = ASSIGN) -> DataFrame:
    """vectors with assigned_theme, similarity, second_similarity and is_unknown (similarity below the threshold).

    A map over the rows without a shuffle. A null vector has null results and is unknown.
    """
    nearest = scorer(themes)
    out = vectors.withColumn("_a", nearest(F.col(vector)))
    some = lambda c: F.when(~F.isnan(c), c)
    out = out.withColumns({"assigned_theme": F.col("_a.assigned_theme"), "similarity": some(F.col("_a.similarity")), "second_similarity": some(F.col("_a.second_similarity"))})
    return out.drop("_a").withColumn("is_unknown", F.coalesce(F.col("similarity") < threshold, F.lit(True)))


def override(assigned: DataFrame, marked: DataFrame, key: str, theme: int = OVERRIDE_THEME) -> DataFrame:
    """Rows whose key is marked go to the given theme and are known; the similarity stays."""
    flags = marked.select(key).distinct().withColumn("_marked", F.lit(True))
    out = assigned.join(flags, key, "left").withColumn("_marked", F.coalesce("_marked", F.lit(False)))
    return out.withColumns(
        {
            "assigned_theme": F.when(F.col("_marked"), F.lit(theme)).otherwise(F.col("assigned_theme")),
            "is_unknown": F.col("is_unknown") & ~F.col("_marked"),
        }
    ).drop("_marked")


def drifted(assigned: DataFrame, drift_themes: DataFrame, vector: str = "embedding", threshold: float = ASSIGN) -> DataFrame:
    """Unknown rows of a first assignment that a drift theme takes."""
    rest = assigned.filter("is_unknown").drop("assigned_theme", "similarity", "second_similarity", "is_unknown")
    return assign(rest, drift_themes, vector, threshold).filter(~F.col("is_unknown"))


def resolved(marked: Column, drift: Column, unknown: Column, theme: Column) -> Column:
    """The label that counts: marked before drift before unknown before the theme."""
    return F.when(marked, F.lit("marked")).when(drift.isNotNull(), F.concat(F.lit("D"), drift.cast("string"))).when(
        F.coalesce(unknown, F.lit(True)) | theme.isNull(), F.lit("noise")
    ).otherwise(F.concat(F.lit("T"), theme.cast("string")))


def coverage(assigned: DataFrame, theme: str = "assigned_theme") -> DataFrame:
    """A row per theme: n, avg_similarity, n_unknown."""
    return assigned.groupBy(theme).agg(F.count("*").alias("n"), F.avg("similarity").alias("avg_similarity"), F.sum(F.col("is_unknown").cast("long")).alias("n_unknown"))


def merge_themes(themes: DataFrame, threshold: float = MERGE) -> dict[int, int]:
    """label -> new label: the closest two are merged while at least that similar, means recomputed, then renumbered.

    The sums stay exact by the sizes. Of equally similar pairs the one with the smallest labels goes first;
    a merged theme has the smaller label.
    """
    rows = collected(themes, "centroid", "n")
    if not rows:
        return {}
    labels = [r["label"] for r in rows]
    sums = np.array([np.array(r["centroid"], float) * r["n"] for r in rows])
    unit = _unit(sums)
    sims = unit @ unit.T
    np.fill_diagonal(sims, _GONE)
    # The nearest of each theme, the first of several; a merge changes it only where it was one of the two.
    near = sims.argmax(axis=1)
    top = sims[np.arange(len(rows)), near]
    owner = list(range(len(rows)))
    while top[i := int(top.argmax())] >= threshold:
        a, b = sorted((i, int(near[i])))
        owner[b] = a
        sums[a] += sums[b]
        unit[a] = sums[a] / (np.linalg.norm(sums[a]) or 1)
        new = np.where(top > _GONE, unit @ unit[a], _GONE)
        new[[a, b]] = _GONE
        sims[a], sims[:, a] = new, new
        sims[b], sims[:, b], top[b] = _GONE, _GONE, _GONE
        stale = (near == a) | (near == b)
        stale[a], stale[b] = True, False
        stale &= top > _GONE
        closer = ~stale & ((new > top) | ((new == top) & (a < near))) & (top > _GONE)
        near[closer], top[closer] = a, new[closer]
        for k in np.flatnonzero(stale):
            near[k] = sims[k].argmax()
            # A theme left alone has none near; it stays above those that are gone, and below any threshold.
            top[k] = max(sims[k, near[k]], _ALONE)
    for k in range(len(owner)):
        owner[k] = owner[owner[k]]
    number = {old: new for new, old in enumerate(sorted({labels[k] for k in owner}))}
    return {label: number[labels[k]] for label, k in zip(labels, owner, strict=True)}


def relabelled(rows: DataFrame, mapping: dict[int, int], label: str = "label") -> DataFrame:
    """label by the mapping; noise and labels that it lacks stay."""
    if not mapping:
        return rows
    table = rows.sparkSession.createDataFrame([(int(old), int(new)) for old, new in mapping.items()], "_old long, _new long")
    known = rows.join(F.broadcast(table), F.col(label) == F.col("_old"), "left")
    return known.withColumn(label, F.coalesce(F.col("_new").cast(rows.schema[label].dataType), F.col(label))).drop("_old", "_new")


def greedy_topics(themes: DataFrame, threshold: float = TOPIC_MERGE) -> dict[int, int]:
    """label -> leader: in order of the labels each free theme takes all later free ones that are more similar; no new means."""
    rows = collected(themes, "centroid")
    unit = _unit(np.array([r["centroid"] for r in rows], float)) if rows else np.zeros((0, 1))
    leader: dict[int, int] = {}
    for i, r in enumerate(rows):
        if r["label"] in leader:
            continue
        leader[r["label"]] = r["label"]
        for j in np.flatnonzero(unit[i + 1 :] @ unit[i] > threshold) + i + 1:
            leader.setdefault(rows[j]["label"], r["label"])
    return leader


def extend_registry(registry: DataFrame, found: DataFrame, threshold: float = REGISTRY, min_size: int = 10) -> dict[int, int]:
    """found label -> registry label: the largest first, each to the nearest theme known by then, or as a new one."""
    known = [(r["label"], np.array(r["centroid"], float)) for r in collected(registry, "centroid")]
    out: dict[int, int] = {}
    top = max([k for k, _ in known], default=-1)
    for r in sorted(collected(found, "centroid", "n"), key=lambda r: (-r["n"], r["label"])):
        if r["n"] < min_size:
            continue
        v = np.array(r["centroid"], float)
        v = v / (np.linalg.norm(v) or 1)
        sims = [float(v @ c / (np.linalg.norm(c) or 1)) for _, c in known]
        if sims and max(sims) >= threshold:
            out[r["label"]] = known[int(np.argmax(sims))][0]
        else:
            top += 1
            known.append((top, v))
            out[r["label"]] = top
    return out


def top_members(vectors: DataFrame, themes: DataFrame, key: str, k: int = 5) -> DataFrame:
    """The k members nearest to each theme's centroid: label, key, similarity, rank."""
    both = vectors.join(F.broadcast(bounded(themes).select("label", "centroid")), "label")
    scored = both.select("label", key, V.cosine(F.col("embedding"), F.col("centroid")).alias("similarity"))
    order = Window.partitionBy("label").orderBy(F.desc("similarity"), key)
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def second_level(vectors: DataFrame, parent: str = "label", vector: str = "embedding", per_child: int = 50, most: int = 5, seed: int = 42) -> DataFrame:
    """sub_label by k-means within each parent, k = max(2, min(most, n // per_child)); one distributed fit for each parent."""
    from pyspark.ml.clustering import KMeans

    rows = vectors.withColumn("_f", array_to_vector(F.col(vector).cast("array<double>")))
    sizes = bounded(rows.groupBy(parent).count()).collect()
    out = None
    for r in sorted(sizes, key=lambda r: (r[parent] is None, r[parent])):
        own = rows.filter(F.col(parent).eqNullSafe(F.lit(r[parent])))
        k = min(r["count"], max(2, min(most, r["count"] // per_child)))
        part = KMeans(k=k, seed=seed, featuresCol="_f", predictionCol="sub_label").fit(own).transform(own) if k > 1 else own.withColumn("sub_label", F.lit(0))
        out = part if out is None else out.unionByName(part)
    return (rows.withColumn("sub_label", F.lit(0)) if out is None else out).drop("_f")


def class_terms(docs: DataFrame, group: str, text: str = "text", n: int = 10) -> DataFrame:
    """Class-based TF-IDF of one- and two-word terms: group, term, tf, score, rank of the best n of each.

    score = tf * ln(1 + mean words of a class / number of classes with the term); of equal ones the term decides.
    """
    words = graph.spread(docs.select(F.col(group).alias("group"), F.col(text).alias("text"))).select("group", T.term_words(F.col("text")).alias("w"))
    pairs = F.zip_with(F.slice("w", 1, F.greatest(F.size("w") - 1, F.lit(0))), F.slice("w", 2, F.greatest(F.size("w") - 1, F.lit(0))), lambda a, b: F.concat(a, F.lit(" "), b))
    tf = words.select("group", F.explode(F.concat("w", pairs)).alias("term")).groupBy("group", "term").agg(F.count("*").alias("tf"))
    # Written, as three steps read it: no text is cut into words twice.
    tf = graph.kept(tf, graph.shared_folder(docs.sparkSession))
    # Both totals come from the counted terms: a class's words are its terms here.
    totals = tf.groupBy("group").agg(F.sum("tf").alias("n")).agg(F.avg("n").alias("mean_words"), F.count("*").alias("groups"))
    # The nth greatest tf of a class, from how many terms have each tf. Its score is that of a term in all classes at
    # least, and a tf whose score would be below that even for a term in one class is not among the best n.
    per = tf.groupBy("group", "tf").agg(F.count("*").alias("terms"))
    upto = per.withColumn("upto", F.sum("terms").over(Window.partitionBy("group").orderBy(F.desc("tf"))))
    nth = upto.groupBy("group").agg(F.coalesce(F.max(F.when(F.col("upto") >= n, F.col("tf"))), F.min("tf")).alias("nth")).join(F.broadcast(totals))
    least = nth.select(F.col("group").alias("_g"), (F.col("nth") * F.log(1 + F.col("mean_words") / F.col("groups")) / F.log(1 + F.col("mean_words")) * (1 - 1e-9) - 1e-6).alias("_least"))
    may = graph.kept(tf.join(least, F.col("group").eqNullSafe(F.col("_g")) & (F.col("tf") >= F.col("_least"))).select("group", "term", "tf"), graph.shared_folder(docs.sparkSession))
    df = tf.join(may.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.count("*").alias("df"))
    scored = may.join(df, "term").join(F.broadcast(totals.select("mean_words")))
    scored = scored.withColumn("score", F.col("tf") * F.log(1 + F.col("mean_words") / F.col("df"))).filter("score > 0")
    order = Window.partitionBy("group").orderBy(F.desc(F.round("score", 9)), "term")
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n).select("group", "term", "tf", "score", "rank")
