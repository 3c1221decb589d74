"""Projection of vectors on their principal axes, and alignment of one projection with another."""

from __future__ import annotations

import numpy as np
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Most coordinates that `aligned` takes: their covariances are one aggregate each.
MOST_COORDINATES = 16


def whole(vector: Column, dimensions: int) -> Column:
    """Whether a vector has so many entries, all of them finite numbers."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))
    return F.coalesce((F.size(vector) == dimensions) & F.forall(vector, finite), F.lit(False))


def projected(df: DataFrame, vector: str, dimensions: int, k: int = 2, out: str = "coordinates") -> DataFrame:
    """df with its vectors' places on the k principal axes, measured from their mean, as an array of doubles.

    Every whole vector counts for the axes. An axis points to where its largest entry (of equal ones the
    first) is positive. Rows without a whole vector get null. Fewer than two whole vectors lie at the origin.
    The covariance, dimensions x dimensions, is added up by tasks; only it reaches the driver.
    """
    if not 1 <= k <= dimensions:
        raise ValueError(f"{k} axes of {dimensions} dimensions")
    good = whole(F.col(vector), dimensions)
    entries = F.transform(vector, lambda x: x.cast("double"))
    fit = df.filter(good).select(array_to_vector(entries).alias("v"))
    if len(fit.take(2)) < 2:
        return df.withColumn(out, F.when(good, F.lit([0.0] * k)))
    mean = fit.agg(Summarizer.mean(F.col("v")).alias("mean")).first()["mean"].toArray()
    axes = PCA(k=k, inputCol="v", outputCol="p").fit(fit).pc.toArray().T
    axes = axes * np.array([1.0 if a[np.argmax(np.abs(a) > np.abs(a).max() - 1e-12)] > 0 else -1.0 for a in axes])[:, None]
    origin = (axes @ mean).tolist()
    place = lambda a, o: F.aggregate(F.zip_with(entries, F.lit(a), lambda x, y: x * y), F.lit(-o), lambda s, x: s + x)
    return df.withColumn(out, F.when(good, F.array(*(place(a, o) for a, o in zip(axes.tolist(), origin)))))


def aligned(df: DataFrame, moving: str, fixed: str, k: int = 2, out: str = "aligned") -> DataFrame:
    """df with `moving` turned, mirrored, scaled and shifted as a whole, so that it lies on `fixed` as well as it can.

    Rows whose both columns are k finite numbers count for the fit, an orthogonal Procrustes one by k x k
    covariances in a single pass. Other rows are moved too where they have k numbers, else they get null.
    Without spread in `moving` it is only shifted; without rows to fit, it stays.
    """
    if not 1 <= k <= MOST_COORDINATES:
        raise ValueError(f"{k} coordinates, at most {MOST_COORDINATES}")
    b, a = ([F.get(c, i).cast("double") for i in range(k)] for c in (moving, fixed))
    sums = [F.count("*").alias("n")]
    sums += [F.avg(c).alias(f"{s}{i}") for s, side in (("b", b), ("a", a)) for i, c in enumerate(side)]
    sums += [F.var_pop(c).alias(f"v{s}{i}") for s, side in (("b", b), ("a", a)) for i, c in enumerate(side)]
    sums += [F.covar_pop(x, y).alias(f"c{i}_{j}") for i, x in enumerate(b) for j, y in enumerate(a)]
    of = df.filter(whole(F.col(moving), k) & whole(F.col(fixed), k)).agg(*sums).first()
    if not of["n"]:
        return df.withColumn(out, F.when(whole(F.col(moving), k), F.transform(moving, lambda x: x.cast("double"))))
    take = lambda s: np.array([of[f"{s}{i}"] for i in range(k)])
    spread, turn = take("vb").sum(), np.eye(k)
    if spread > 0:
        u, _, v = np.linalg.svd(np.array([[of[f"c{i}_{j}"] for j in range(k)] for i in range(k)]))
        turn = u @ v * np.sqrt(take("va").sum() / spread)
    shift = take("a") - take("b") @ turn
    place = lambda j: sum((b[i] * float(turn[i, j]) for i in range(k)), F.lit(float(shift[j])))
    return df.withColumn(out, F.when(whole(F.col(moving), k), F.array(*(place(j) for j in range(k)))))
