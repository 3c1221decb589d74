"""Which rows go on: the filters that a run starts with, orders of work, positions, resume points."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import graph

#: The order in which kinds of files are worked on; others come last.
KIND_ORDER = ("pdf", "word", "excel", "image", "xml")
_BLANK = " \t\n\x0b\x0c\r"


def _empty(c: Column) -> Column:
    return F.coalesce(c, F.lit("")) == ""


def for_clustering(rows: DataFrame, done: Column, error: Column, enriched: str) -> DataFrame:
    """Finished rows without an error, with the enriched text, empty where there is none, as `text`."""
    return rows.filter(F.coalesce(done, F.lit(False)) & _empty(error)).withColumn("text", F.coalesce(F.col(enriched), F.lit("")))


def for_embedding(rows: DataFrame, kind: Column, text: Column, image: Column) -> DataFrame:
    """Rows of the kind with a text or an image."""
    return rows.filter(kind & (~_empty(text) | image.isNotNull()))


def quality_gate(rows: DataFrame, quality: str, text: str, known: DataFrame, key: str, passing: tuple = ("good", "poor")) -> DataFrame:
    """Rows of passing quality with a text that have no vector yet."""
    return rows.filter(F.col(quality).isin(*passing) & ~_empty(F.col(text))).join(known.select(key).distinct(), key, "left_anti")


def for_summary(rows: DataFrame, done: Column, text: Column, least: int = 100) -> DataFrame:
    """Rows not summarised yet whose text has enough characters between its blanks."""
    return rows.filter(~F.coalesce(done, F.lit(False)) & (F.length(F.trim(text, F.lit(_BLANK))) >= least))


def of_family(kind: Column, parts: list[str]) -> Column:
    """Whether a kind's name has one of the parts in it, whatever its case."""
    return reduce(lambda a, b: a | b, (F.contains(F.lower(kind), F.lit(p)) for p in parts))


def worth_sampling(similarity: Column, unknown: Column, theme: Column, subject: Column, least: float, length: int, override: int = 90) -> Column:
    """A similar known theme, or the theme that a mark sets; either way with a long enough subject."""
    return (((similarity >= least) & ~unknown) | (theme == override)) & (F.length(subject) >= length)


def kind_rank(kind: Column) -> Column:
    """A kind's place in the order of work."""
    ranked = reduce(lambda c, i: c.when(F.lower(kind) == KIND_ORDER[i], i), range(1, len(KIND_ORDER)), F.when(F.lower(kind) == KIND_ORDER[0], 0))
    return ranked.otherwise(len(KIND_ORDER))


def numbered(rows: DataFrame, *order: str, name: str = "position") -> DataFrame:
    """rows with their position, from 0, in the order of all rows.

    Ranges of the order go to different tasks; a position is the number of rows in the ranges before, one
    number a range, and the place in its own. The ranges are written first, so that both see the same.
    """
    spark = rows.sparkSession
    dealt = graph.kept(rows.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), graph.shared_folder(spark))
    sizes = sorted((r["_range"], r["count"]) for r in dealt.groupBy("_range").count().collect())
    starts, at = [], 0
    for k, n in sizes:
        starts.append((k, at))
        at += n
    first = spark.createDataFrame(starts, "_range int, _start long")
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*order)) - 1
    return dealt.withColumn("_place", place).join(F.broadcast(first), "_range").withColumn(name, F.col("_start") + F.col("_place")).drop("_range", "_start", "_place")


def by_position(rows: DataFrame, *order: str, of: int = 10, first: int = 6) -> DataFrame:
    """The first 6 of each 10 rows in order: a split by position."""
    return numbered(rows, *order, name="_position").filter(F.pmod("_position", F.lit(of)) < first).drop("_position")


def not_in(rows: DataFrame, key: str, others: DataFrame) -> DataFrame:
    """SQL's NOT IN: nothing where `others` (one column) has a null, null keys go; all where it has no row."""
    other = others.columns[0]
    state = others.agg(F.count("*").alias("_n"), F.count_if(F.col(other).isNull()).alias("_nulls"))
    left = rows.join(others.filter(F.col(other).isNotNull()).select(F.col(other).alias(key)), key, "left_anti")
    return left.join(F.broadcast(state)).filter((F.col("_n") == 0) | ((F.col("_nulls") == 0) & F.col(key).isNotNull())).drop("_n", "_nulls")


def resume_point(stages: DataFrame, number: str, done: str) -> DataFrame:
    """One row: the first stage that isn't complete, null if all are."""
    return stages.agg(F.min(F.when(~F.coalesce(F.col(done), F.lit(False)), F.col(number))).alias("resume_at"))


def last_runs(rows: DataFrame, column: str, n: int, allowed: tuple[str, ...], key: str) -> DataFrame:
    """The n rows greatest by one of the allowed columns; another name is an error."""
    if column not in allowed:
        raise ValueError(f"not a column to order by: {column}")
    return rows.orderBy(F.desc(column), key).limit(n)


def pooled(parts: list[DataFrame], key: str, label: str, known: DataFrame, wrong: DataFrame) -> DataFrame:
    """One row per key: later parts win; labels that aren't known and keys known to be wrong go."""
    every = None
    for i, p in enumerate(parts):
        p = p.withColumn("_part", F.lit(i))
        every = p if every is None else every.unionByName(p)
    rest = [c for c in parts[0].columns if c != key]
    last = every.groupBy(key).agg(F.max(F.struct("_part", *rest)).alias("_m")).select(key, *(F.col(f"_m.{c}").alias(c) for c in rest))
    return last.join(known.select(label).distinct(), label, "left_semi").join(wrong.select(key).distinct(), key, "left_anti")


def cleaned_labels(rows: DataFrame, folder: Column, ensemble: Column, votes: Column, name: Column, judge: Column, least: int = 9) -> DataFrame:
    """rows with `action` and `label`: kept, relabelled where name or judge back the ensemble, or deleted."""
    flagged = F.coalesce((ensemble != folder) & (votes >= least), F.lit(False))
    backed = F.coalesce(name == ensemble, F.lit(False)) | F.coalesce(judge == ensemble, F.lit(False))
    action = F.when(~flagged, "keep").when(backed, "relabel").otherwise("delete")
    return rows.withColumns({"action": action, "label": F.when(~flagged, folder).when(backed, ensemble)})
