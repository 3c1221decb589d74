"""Connected components of an edge table by least labels and pointer jumping."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def shared_folder(spark) -> str:
    """A new folder below the one that all executors share."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def kept(df: DataFrame, path: str) -> DataFrame:
    """df, written and read back."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark, rows: int) -> Iterator[None]:
    """Within it, a batch that goes to Python holds so many rows at most: for rows that are large."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def spread(df: DataFrame) -> DataFrame:
    """df over all cores: a table that is read in fewer parts than there are cores is dealt anew, so one of any size is not."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def components(edges: DataFrame, folder: str | None = None) -> DataFrame:
    """node, root of edges (a, b): root is the least node that a node is connected to.

    Each round is written to the shared folder, so lineage stays short and a lost executor costs one round.
    Rounds are few: labels jump to their label's label, which halves the distance each time.
    """
    folder = folder or shared_folder(edges.sparkSession)

    both = kept(edges.select("a", "b").union(edges.select("b", "a")).toDF("node", "near").filter("node <> near").distinct(), f"{folder}/edges")
    labels = kept(both.groupBy("node").agg(F.least(F.min("near"), "node").alias("root")), f"{folder}/labels0")
    turn = 0
    while True:
        turn += 1
        of_near = labels.select(F.col("node").alias("near"), F.col("root").alias("offer"))
        offers = both.join(of_near, "near").groupBy("node").agg(F.min("offer").alias("offer"))
        hooked = labels.join(offers, "node").select("node", "root", F.least("root", "offer").alias("next"))
        jump = labels.select(F.col("node").alias("next"), F.col("root").alias("beyond"))
        out = hooked.join(jump, "next", "left").select("node", "root", F.least("next", F.coalesce("beyond", "next")).alias("new"))
        step = kept(out, f"{folder}/labels{turn}")
        labels = step.select("node", F.col("new").alias("root"))
        if step.filter("new <> root").isEmpty():
            return labels
