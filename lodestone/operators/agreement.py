"""Agreement of partitions by run, statuses held together, accuracy by size of group, sizes after cleaning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def agreement_by_run(rows: DataFrame, run: str, a: str, b: str) -> DataFrame:
    """run, n, ari, nmi of the partitions a and b in each run: adjusted Rand index, and mutual information over the mean entropy.

    Rows without a run, an a or a b don't count. Two partitions that can't differ (each in one piece, or all
    rows apart in both) agree fully: 1. Rows are counted to a table of labels before anything else moves.
    """
    table = rows.filter(F.col(run).isNotNull() & F.col(a).isNotNull() & F.col(b).isNotNull()).select(F.col(run).alias("_run"), F.col(a).alias("_a"), F.col(b).alias("_b"))
    table = table.groupBy("_run", "_a", "_b").agg(F.count("*").cast("double").alias("_n"))
    sets = [[F.col("_run"), F.col("_a"), F.col("_b")], [F.col("_run"), F.col("_a")], [F.col("_run"), F.col("_b")]]
    side = table.groupingSets(sets, F.col("_run"), F.col("_a"), F.col("_b")).agg(F.sum("_n").alias("_n"), F.grouping_id().alias("_side"))
    n = F.col("_n")
    measures = [F.sum(F.when(F.col("_side") == i, x)).alias(f"{s}{i}") for i in range(3) for s, x in (("p", n * (n - 1) / 2), ("x", n * F.log(n)))]
    s = side.groupBy("_run").agg(F.sum(F.when(F.col("_side") == 0, n)).alias("t"), *measures)
    t, p, l, r = F.col("t"), F.col("p0"), F.col("p1"), F.col("p2")
    chance = F.when(t > 1, l * r / (t * (t - 1) / 2)).otherwise(F.lit(0.0))
    most = (l + r) / 2
    of_a, of_b = F.log(t) - F.col("x1") / t, F.log(t) - F.col("x2") / t
    shared = (F.col("x0") - F.col("x1") - F.col("x2")) / t + F.log(t)
    ari = F.when(F.abs(most - chance) > 1e-12 * (most + 1), (p - chance) / (most - chance)).otherwise(1.0)
    nmi = F.when(of_a + of_b > 1e-12, 2 * shared / (of_a + of_b)).otherwise(1.0)
    return s.select(F.col("_run").alias(run), t.cast("long").alias("n"), ari.alias("ari"), nmi.alias("nmi"))


def spread(rows: DataFrame, *measures: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Mean, population deviation, least, most and their distance of each measure over the rows; nulls don't count."""
    of = lambda m: (F.avg(m).alias(f"{m}_mean"), F.stddev_pop(m).alias(f"{m}_std"), F.min(m).alias(f"{m}_min"), F.max(m).alias(f"{m}_max"), (F.max(m) - F.min(m)).alias(f"{m}_spread"))
    return rows.groupBy(*by).agg(*(x for m in measures for x in of(m)))


def joint_statuses(rows: DataFrame, statuses: list[str], subsets: dict[str, Column], match: str = "match", mismatch: str = "mismatch") -> DataFrame:
    """subset, n, all_match, all_match_share, any_mismatch, any_mismatch_share: one row a subset, counted in one pass.

    A row is in every subset whose condition it meets. A status that is null is no match and no mismatch; an
    empty subset has shares of null.
    """
    every, some = F.lit(True), F.lit(False)
    for s in statuses:
        every, some = every & F.coalesce(F.col(s) == match, F.lit(False)), some | F.coalesce(F.col(s) == mismatch, F.lit(False))
    counts = {"n": F.lit(True), "all_match": every, "any_mismatch": some}
    sums = rows.agg(*(F.struct(*(F.count_if(c & x).alias(k) for k, x in counts.items())).alias(name) for name, c in subsets.items()))
    each = sums.select(F.explode(F.array(*(F.struct(F.lit(name).alias("subset"), *(F.col(f"`{name}`.{k}").alias(k) for k in counts)) for name in subsets))).alias("s")).select("s.*")
    share = lambda k: F.when(F.col("n") > 0, F.col(k) / F.col("n")).alias(f"{k}_share")
    return each.select("subset", "n", "all_match", share("all_match"), "any_mismatch", share("any_mismatch"))


def accuracy_by_group(rows: DataFrame, group: Column, truth: Column, predicted: Column) -> DataFrame:
    """part (all, single, in_group), n, correct, accuracy: rows alone in their group, and those that share one.

    A row without a group is alone; a prediction of null is wrong; rows without a truth don't count for the
    accuracy but do for the sizes of groups. A part without rows is left out. Rows are counted
    to one row a group first, so none is joined to its size.
    """
    named = rows.select(group.alias("_g"), truth.alias("_t"), F.coalesce(predicted == truth, F.lit(False)).alias("_hit"))
    groups = named.groupBy("_g").agg(F.count("*").alias("_size"), F.count("_t").alias("n"), F.count_if(F.col("_hit") & F.col("_t").isNotNull()).alias("correct"))
    single = F.col("_g").isNull() | (F.col("_size") == 1)
    parts = F.explode(F.array(F.lit("all"), F.when(single, "single").otherwise("in_group"))).alias("part")
    out = groups.select(parts, "n", "correct").groupBy("part").agg(F.sum("n").alias("n"), F.sum("correct").alias("correct"))
    return out.filter("n > 0").withColumn("accuracy", F.col("correct") / F.col("n"))


def sizes_after(cleaned: DataFrame, group: str, action: str = "action", before: str = "size_before", after: str = "size_after") -> DataFrame:
    """group, its size before and after the rows to delete went; groups without a name are left out, emptied ones have 0."""
    kept = F.count_if(F.coalesce(F.col(action) != "delete", F.lit(True)))
    return cleaned.filter(F.col(group).isNotNull()).groupBy(group).agg(F.count("*").alias(before), kept.alias(after))
