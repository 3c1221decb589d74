"""Upserts, updates, rollbacks and snapshots as functions from the old table to the new one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest(rows: DataFrame, key: list[str], order: str) -> DataFrame:
    """One row per key, the last by `order`: one pre-aggregated struct, no sort."""
    rest = [c for c in rows.columns if c not in key]
    last = rows.groupBy(*key).agg(F.max(F.struct(F.col(order).alias("_o"), *rest)).alias("_m"))
    return last.select(*key, *(F.col(f"_m.{c}").alias(c) for c in rest)).select(*rows.columns)


def upsert(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Rows of new replace those of old with their key, and come in where there are none; keys of new are unique."""
    return old.join(new.select(*key), key, "left_anti").unionByName(new)


def insert_missing(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Rows of new come in only where old lacks their key; of repeated keys in new one."""
    return old.unionByName(new.dropDuplicates(key).join(old.select(*key), key, "left_anti").select(*old.columns))


def pending(source: DataFrame, done: DataFrame, key: list[str]) -> DataFrame:
    """Rows of source that are not done; null keys always are pending."""
    return source.join(done.select(*key).distinct(), key, "left_anti")


def update(old: DataFrame, new: DataFrame, key: list[str], columns: list[str], only_changed: bool = False) -> DataFrame:
    """columns from new where it has the key; with only_changed, `changed` says whether any differed."""
    theirs = new.select(*key, *(F.col(c).alias(f"_n_{c}") for c in columns), F.lit(True).alias("_hit"))
    out = old.join(theirs, key, "left")
    hit = F.coalesce("_hit", F.lit(False))
    differs = hit & F.exists(F.array(*(~F.col(c).eqNullSafe(F.col(f"_n_{c}")) for c in columns)), lambda x: x)
    values = {c: F.when(hit, F.col(f"_n_{c}")).otherwise(F.col(c)) for c in columns}
    if only_changed:
        values["changed"] = differs
    return out.withColumns(values).drop("_hit", *(f"_n_{c}" for c in columns))


def cleared(rows: DataFrame, when: Column, empty: list[str], flags: list[str]) -> DataFrame:
    """Where the condition holds, columns become null and flags false: a stage's reset, or one format's rollback."""
    hit = F.coalesce(when, F.lit(False))
    kinds = dict(rows.dtypes)
    out = {c: F.when(~hit, F.col(c)).cast(kinds[c]) for c in empty}
    return rows.withColumns(out | {c: F.when(hit, F.lit(False)).otherwise(F.col(c)) for c in flags})


def delete_of(rows: DataFrame, owners: DataFrame, key: list[str]) -> DataFrame:
    return rows.join(owners.select(*key).distinct(), key, "left_anti")


def flagged(rows: DataFrame, ids: DataFrame, key: list[str], flag: str) -> DataFrame:
    """flag becomes true for rows whose key is among ids."""
    hit = ids.select(*key).distinct().withColumn("_hit", F.lit(True))
    return rows.join(hit, key, "left").withColumn(flag, F.coalesce("_hit", F.col(flag), F.lit(False))).drop("_hit")


def snapshot(rows: DataFrame, key: list[str], required: list[str]) -> DataFrame:
    """Rows with all required columns, one per key."""
    return rows.dropna(subset=required).dropDuplicates(key)


def merged_maps(left: Column, right: Column) -> Column:
    """Both maps, the right one's values where both have a key; a null map is empty."""
    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    a, b = F.coalesce(left, none), F.coalesce(right, none)
    return F.map_concat(F.map_filter(a, lambda k, _: ~F.map_contains_key(b, k)), b)


def unique_names(rows: DataFrame, folder: str, name: str, order: str) -> DataFrame:
    """`unique_name`: stem_N.ext from the second row on that has the same name in a folder."""
    from pyspark.sql import Window

    n = F.row_number().over(Window.partitionBy(folder, name).orderBy(order)) - 1
    stem, ext = F.regexp_extract(name, r"^(.*?)(\.[^.]*)?$", 1), F.regexp_extract(name, r"(\.[^.]*)?$", 0)
    return rows.withColumn("_n", n).withColumn("unique_name", F.when(F.col("_n") == 0, F.col(name)).otherwise(F.concat(stem, F.lit("_"), F.col("_n").cast("string"), ext))).drop("_n")
