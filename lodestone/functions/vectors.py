"""Column functions on array<float> or array<double> vectors; all arithmetic is in double."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def norm(v: Column) -> Column:
    return F.sqrt(dot(v, v))


def normalised(v: Column) -> Column:
    """v at length 1; a zero vector stays as it is. The length is bound, so it is taken once and not at each place."""
    divided = lambda length: F.transform(v, lambda x: x.cast("double") / length)
    length = norm(v)
    return F.get(F.transform(F.array(F.when(length > 0, length).otherwise(F.lit(1.0))), divided), 0)


def cosine(a: Column, b: Column) -> Column:
    """0 where either vector is zero, null where either is null."""
    lengths = norm(a) * norm(b)
    return F.when(lengths > 0, dot(a, b) / lengths).otherwise(F.when(lengths.isNotNull(), F.lit(0.0)))


def combined(text: Column, image: Column) -> Column:
    """A document's vector: the mean of both, else the one there is, else null."""
    return F.coalesce(F.zip_with(text, image, lambda a, b: (a + b) / 2), text, image)


def truncated(v: Column, dimensions: int) -> Column:
    """The first dimensions, normalised again."""
    return normalised(F.slice(v, 1, dimensions))


def is_zero(v: Column) -> Column:
    return ~F.exists(v, lambda x: x != 0)
