"""Projections of vectors and vectors by a model."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ..functions import inference
from ..operators import projection
from .catalog import query

#: A stand-in for a model: how often these letters stand; it refuses texts with this word.
LETTERS, REFUSED = "aeionrst", "moron"


def letter_model() -> inference.Model:
    def model(texts: list[str]) -> np.ndarray:
        if any(REFUSED in t for t in texts):
            raise ValueError("refused")
        return np.array([[t.count(c) for c in LETTERS] for t in texts])

    return model


@query()
def projected_vectors(t):
    """No SQL: eigenvectors. Held against numpy in the tests."""
    out = projection.projected(t.embeddings.select("vec_id", "embedding"), "embedding", 64)
    return out.select("vec_id", F.round(F.col("coordinates")[0], 6).alias("x"), F.round(F.col("coordinates")[1], 6).alias("y"))


@query("""
WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings),
p AS (SELECT vec_id, v[1] AS ax, v[2] AS ay, 3 * v[2] + v[3] / 2 + 1 AS cx, 3 * v[1] - v[4] / 2 - 2 AS cy FROM e),
s AS (SELECT avg(ax) AS max_, avg(ay) AS may, avg(cx) AS mcx, avg(cy) AS mcy, covar_pop(cx, ax) AS a, covar_pop(cx, ay) AS b, covar_pop(cy, ax) AS c, covar_pop(cy, ay) AS d,
 sqrt((var_pop(ax) + var_pop(ay)) / (var_pop(cx) + var_pop(cy))) AS f FROM p),
r AS (SELECT *, sqrt((a + d) ** 2 + (b - c) ** 2) AS turned, sqrt((a - d) ** 2 + (b + c) ** 2) AS mirrored FROM s),
m AS (SELECT *, CASE WHEN turned >= mirrored THEN (a + d) / turned ELSE (a - d) / mirrored END * f AS xx, CASE WHEN turned >= mirrored THEN (b - c) / turned ELSE (b + c) / mirrored END * f AS xy,
 CASE WHEN turned >= mirrored THEN 1 ELSE -1 END AS side FROM r)
SELECT vec_id, round((cx - mcx) * xx - side * (cy - mcy) * xy + max_, 5) AS x, round((cx - mcx) * xy + side * (cy - mcy) * xx + may, 5) AS y FROM p CROSS JOIN m""")
def aligned_projection(t):
    """The first two entries, mirrored, scaled and blurred by the next two, laid back on themselves; SQL has plane turns in closed form."""
    at = lambda i: F.get("embedding", i).cast("double")
    pairs = t.embeddings.select("vec_id", F.array(at(0), at(1)).alias("fixed"), F.array(3 * at(1) + at(2) / 2 + 1, 3 * at(0) - at(3) / 2 - 2).alias("moving"))
    out = projection.aligned(pairs, "moving", "fixed")
    return out.select("vec_id", F.round(F.col("aligned")[0], 5).alias("x"), F.round(F.col("aligned")[1], 5).alias("y"))


@query(f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
v AS (SELECT doc_id, contains(t, '{REFUSED}') AS refused, [{', '.join(f"length(t) - length(replace(t, '{c}', ''))" for c in LETTERS)}] AS v FROM d)
SELECT doc_id, CASE WHEN refused THEN 'ValueError: refused' END AS error, {', '.join(f"CASE WHEN refused THEN 0 ELSE v[{i + 1}] END AS {c}" for i, c in enumerate(LETTERS))} FROM v""")
def encoded_texts(t):
    rows = t.documents.select("doc_id", inference.encoded(F.col("text"), letter_model, len(LETTERS)).alias("e"))
    return rows.select("doc_id", "e.error", *(F.col("e.vector")[i].cast("long").alias(c) for i, c in enumerate(LETTERS)))
