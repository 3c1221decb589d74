"""Samples, caps, budgets, splits, runs. Random order is the order of md5(seed:id), the same at every run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import graph

TEST_SHARE, GROUP_CAP = 0.22, 40


def shuffled(key: str, seed: int = 42) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def sample(rows: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """n rows in random order: each task keeps n, the driver none."""
    return rows.orderBy(shuffled(key, seed), key).limit(n)


def capped(rows: DataFrame, group: str, n: int, *order) -> DataFrame:
    """The first n rows of each group in the given order."""
    place = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    return rows.withColumn("_r", place).filter(F.col("_r") <= n).drop("_r")


def stratified(rows: DataFrame, group: str, key: str, n: int, seed: int = 42) -> DataFrame:
    return capped(rows, group, n, shuffled(key, seed), F.col(key))


def shard(rows: DataFrame, key: str, shards: int, k: int) -> DataFrame:
    return rows.filter(F.pmod(F.col(key), F.lit(shards)) == k)


def halves(rows: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """rows with `part`: of n rows the n // 2 first by hash are train, the others test.

    Rows are counted by the first four digits of their hash; only those with the digits at which the half is
    reached, one in 65,536, are ordered.
    """
    marked = rows.withColumn("_h", shuffled(key, seed)).withColumn("_d", F.substring("_h", 1, 4))
    counts, at, pivot = sorted((r["_d"] or "", r["count"]) for r in marked.groupBy("_d").count().collect()), 0, ""
    half = sum(n for _, n in counts) // 2
    for pivot, n in counts:  # noqa: B007
        if at + n > half:
            break
        at += n
    digits = F.coalesce("_d", F.lit(""))
    inside = marked.filter(digits == pivot).withColumn("_r", F.row_number().over(Window.orderBy("_h", key)))
    inside = inside.withColumn("part", F.when(F.col("_r") <= half - at, F.lit("train")).otherwise(F.lit("test"))).drop("_r")
    outside = marked.filter(digits != pivot).withColumn("part", F.when(digits < pivot, F.lit("train")).otherwise(F.lit("test")))
    return outside.unionByName(inside).drop("_h", "_d")


def within_budget(rows: DataFrame, group: str, size: str, budget: int, *order) -> DataFrame:
    """Rows of each group, in order, while the sizes before them are less than the budget.

    Ranges of group and order go to different tasks, so that one group may fill many. What stands before a range of its group is the sum
    of the group's ranges before, one number for each, and only the rest is summed row by row. The ranges are
    written first, so that both see the same. Null sizes count as none.
    """
    dealt = graph.kept(rows.repartitionByRange(F.col(group), *order).withColumn("_range", F.spark_partition_id()), graph.shared_folder(rows.sparkSession))
    earlier = Window.partitionBy("_group").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = dealt.groupBy(F.col(group).alias("_group"), F.col("_range").alias("_part")).agg(F.sum(size).alias("_sum"))
    sums = sums.withColumn("_start", F.coalesce(F.sum("_sum").over(earlier), F.lit(0))).drop("_sum")
    here = Window.partitionBy(group, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    summed = dealt.withColumn("_s", F.coalesce(F.sum(size).over(here), F.lit(0)))
    at = (F.col("_range") == F.col("_part")) & F.col(group).eqNullSafe(F.col("_group"))
    return summed.join(sums, at).filter(F.col("_start") + F.col("_s") < budget).select(*rows.columns)


def top_or_rest(counts: DataFrame, name: str, n: int, rest: str = "rest") -> DataFrame:
    """The n most frequent names, all others as one; counts: a row per name with its n."""
    top = counts.orderBy(F.desc("n"), name).limit(n).select(F.col(name).alias("_top"))
    out = counts.join(F.broadcast(top), F.col(name) == F.col("_top"), "left")
    kept = F.when(F.col("_top").isNotNull(), F.col(name)).otherwise(F.lit(rest)).alias(name)
    return out.select(kept, "n").groupBy(name).agg(F.sum("n").alias("n"))


def runs(rows: DataFrame, group: str, order: list[str], value: str) -> DataFrame:
    """Runs of equal neighbours: group, run (from 1), value, length."""
    w = Window.partitionBy(group).orderBy(*order)
    new = F.coalesce((~F.col(value).eqNullSafe(F.lag(value).over(w))).cast("int"), F.lit(1))
    first = F.row_number().over(w) == 1
    marked = rows.withColumn("_new", F.when(first, F.lit(1)).otherwise(new))
    return marked.withColumn("run", F.sum("_new").over(w)).groupBy(group, "run", value).agg(F.count("*").alias("length"))


def grouped_split(rows: DataFrame, key: str, kind: str, group: str, share: float = TEST_SHARE, cap: int = GROUP_CAP, seed: int = 42) -> DataFrame:
    """rows with `split`, train or test, no group in both.

    Per kind, the share (rounded half to even) of the singles and, by running total, of the small groups go to
    test; groups over the cap are always in train. Groups are taken in random order of their names. Where a kind
    of two groups or more has one side only, its smallest group goes to the other. A group of several kinds is
    decided by the first kind in order. Only one row a group is ordered, not the rows.
    """
    groups = rows.groupBy(group).agg(F.count("*").alias("n"), F.min(kind).alias("_kind"))
    groups = groups.withColumn("_tier", F.when(F.col("n") == 1, 0).when(F.col("n") <= cap, 1).otherwise(2))
    by_tier = Window.partitionBy("_kind", "_tier")
    before = F.coalesce(F.sum("n").over(by_tier.orderBy(shuffled(group, seed), group).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    target = F.sum("n").over(by_tier) * share
    test = (F.col("_tier") < 2) & (before < F.when(F.col("_tier") == 0, F.bround(target)).otherwise(target))
    dealt = groups.select(group, "n", "_kind", test.alias("_test"))
    sides = dealt.groupBy("_kind").agg(
        F.count("*").alias("_groups"), F.bool_and("_test").alias("_all"), F.bool_or("_test").alias("_any"), F.min(F.struct("n", shuffled(group, seed), F.col(group).alias("g")))["g"].alias("_least"),
    )
    lone = (F.col("_groups") >= 2) & (F.col("_all") | ~F.col("_any")) & F.col(group).eqNullSafe(F.col("_least"))
    dealt = dealt.join(sides.withColumnRenamed("_kind", "_k"), F.col("_kind").eqNullSafe(F.col("_k")))
    return rows.join(dealt.select(group, F.when(F.col("_test") != lone, "test").otherwise("train").alias("split")), group)
