"""Counts, coverage and listings: one aggregation each, with partial aggregation before the shuffle."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import graph


def counted(rows: DataFrame, conditions: dict[str, Column], by: list[str] | None = None) -> DataFrame:
    """n and the number of rows for which each condition holds, in one pass."""
    parts = [F.count_if(F.coalesce(c, F.lit(False))).alias(name) for name, c in conditions.items()]
    return rows.groupBy(*(by or [])).agg(F.count("*").alias("n"), *parts)


def with_zeros(rows: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """A count for every key of the dimension, 0 where no row has it."""
    n = rows.groupBy(key).agg(F.count("*").alias("n"))
    return dimension.select(key).distinct().join(n, key, "left").fillna(0, ["n"])


def top_value(rows: DataFrame, group: str, value: str) -> DataFrame:
    """The most frequent value of each group; of equally frequent ones the smallest."""
    n = rows.filter(F.col(value).isNotNull()).groupBy(group, value).agg(F.count("*").alias("n"))
    order = Window.partitionBy(group).orderBy(F.desc("n"), value)
    return n.withColumn("_r", F.row_number().over(order)).filter("_r = 1").drop("_r")


def nearest_ranks(rows: DataFrame, group: str, value: str, shares: dict[str, tuple[int, int]]) -> DataFrame:
    """For each share the value at place n * share of the group's sorted values, from 0: a median or p90 that is one of them.

    Values are counted first, so a group is as many rows as it has different values.
    """
    counted = rows.filter(F.col(value).isNotNull()).groupBy(group, value).agg(F.count("*").alias("n"))
    own = Window.partitionBy(group)
    placed = counted.withColumns({"upto": F.sum("n").over(own.orderBy(value)), "total": F.sum("n").over(own)})
    return placed.groupBy(group).agg(*(F.min(F.when(F.col("upto") > F.floor(F.col("total") * a / b), F.col(value))).alias(name) for name, (a, b) in shares.items()))


def coverage_at(rows: DataFrame, value: str, thresholds: list[float]) -> DataFrame:
    """threshold, n: rows at or above each, counted in one pass."""
    one = rows.agg(*(F.count_if(F.col(value) >= t).alias(f"_{i}") for i, t in enumerate(thresholds)))
    parts = F.array(*(F.struct(F.lit(t).alias("threshold"), F.col(f"_{i}").alias("n")) for i, t in enumerate(thresholds)))
    return one.select(F.inline(parts))


def listed(value: str, order: str | None = None) -> Column:
    """Distinct values in order, comma-joined; or all, by `order` downwards, then by value."""
    if order is None:
        return F.array_join(F.array_sort(F.collect_set(value)), ", ")
    pairs = F.sort_array(F.collect_list(F.struct((-F.col(order)).alias("o"), F.col(value).alias("v"))))
    return F.array_join(F.transform(pairs, lambda p: p["v"]), ", ")


def nested_counts(rows: DataFrame, group: str, value: str) -> DataFrame:
    """group, n, parts: `value=count` in order of the counts, then the values."""
    n = rows.groupBy(group, value).agg(F.count("*").alias("c"))
    parts = F.sort_array(F.collect_list(F.struct((-F.col("c")).alias("o"), F.col(value).alias("v"))))
    text = F.transform(parts, lambda p: F.concat(p["v"], F.lit("="), (-p["o"]).cast("string")))
    return n.groupBy(group).agg(F.sum("c").alias("n"), F.array_join(text, ", ").alias("parts"))


def by_source(tables: dict[str, DataFrame], key: str) -> DataFrame:
    """key, a count column for each table, and their total."""
    every = None
    for name, t in tables.items():
        part = t.select(key, *(F.lit(int(n == name)).alias(n) for n in tables))
        every = part if every is None else every.unionByName(part)
    out = every.groupBy(key).agg(*(F.sum(n).alias(n) for n in tables))
    return out.withColumn("total", sum((F.col(n) for n in tables), F.lit(0)))


def percentiles(rows: DataFrame, value: str, shares: list[float]) -> list[float | None]:
    """What F.percentile gives for each share, without all values in one task: they are counted and dealt by ranges, and a rank is looked up in its range."""
    counted = rows.select(F.col(value).cast("double").alias("v")).filter("v is not null").groupBy("v").agg(F.count("*").alias("n"))
    dealt = graph.kept(counted.repartitionByRange("v").select("v", "n", F.spark_partition_id().alias("part")), graph.shared_folder(rows.sparkSession))
    # One row a range.
    parts, before, first = sorted(dealt.groupBy("part").agg(F.sum("n").alias("n")).collect()), 0, []
    for part, n in parts:
        first.append((before, before + n, part))
        before += n
    if not before:
        return [None] * len(shares)
    places = [share * (before - 1) for share in shares]
    ranks = sorted({r for p in places for r in (math.floor(p), math.ceil(p))})
    held = {r: next((part, r - lo) for lo, hi, part in first if lo <= r < hi) for r in ranks}
    upto = dealt.filter(F.col("part").isin(*{part for part, _ in held.values()})).withColumn("upto", F.sum("n").over(Window.partitionBy("part").orderBy("v")))
    found = upto.agg(*(F.min(F.when((F.col("part") == part) & (F.col("upto") > at), F.col("v"))).alias(f"_{r}") for r, (part, at) in held.items())).first()
    at = lambda r: found[f"_{r}"]
    between = lambda p, lo, hi: at(lo) if at(lo) == at(hi) else (hi - p) * at(lo) + (p - lo) * at(hi)
    return [between(p, math.floor(p), math.ceil(p)) for p in places]


def histogram_2d(points: DataFrame, x: str, y: str, cells: int, low: float = 0.003, high: float = 0.997) -> DataFrame:
    """cx, cy, n, log_n of cells in a frame clipped at two percentiles; points outside go to the edge cells."""
    ends = {c: [F.lit(v).cast("double") for v in percentiles(points, c, [low, high])] for c in (x, y)}
    cell = lambda c: F.least(F.greatest(F.floor((F.col(c) - ends[c][0]) / (ends[c][1] - ends[c][0]) * cells), F.lit(0)), F.lit(cells - 1)).cast("int")
    placed = points.select(cell(x).alias("cx"), cell(y).alias("cy"))
    return placed.groupBy("cx", "cy").agg(F.count("*").alias("n")).withColumn("log_n", F.log1p("n"))
