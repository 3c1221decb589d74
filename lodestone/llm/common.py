"""What several training-data operators share: tables, words, scratch space."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space as the operators see it (fixed): blank, tab, LF, VT, FF, CR.
SPACE = r"[\x20\x09-\x0D]+"
TOKENIZER = "word_bpe_49k.json"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def tokenizer_path(name: str = TOKENIZER) -> str:
    """Place of a public tokenizer's vocabulary file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def words(text: Column) -> Column:
    """Words of a text between white space, in order; none for null."""
    parts = F.split(F.coalesce(text, F.lit("")), SPACE)
    return F.filter(parts, lambda w: w != "")


def has_word(line: Column) -> Column:
    """Whether anything but white space is in a line."""
    return F.length(F.ltrim(line, F.lit(" \t\n\x0b\x0c\r"))) > 0


def bound(value: Column, f: Callable[[Column], Column]) -> Column:
    """f(value), with value made once."""
    return F.get(F.transform(F.array(value), f), 0)


def running(values: Column, merge: Callable[[Column, Column], Column]) -> Column:
    """For each place of an array of ints, what merge makes of the values up to it: sums, or the greatest so far.

    Each pass doubles how far back a place has looked, so an array of n takes n log n steps.
    """

    def further(a: Column, k: Column) -> Column:
        back = F.lit(1).cast("long") * F.pow(F.lit(2.0), k).cast("long")
        return F.transform(a, lambda x, i: F.when(i < back, x).otherwise(merge(x, F.get(a, (i - back).cast("int")))))

    return bound(values, lambda v: F.aggregate(F.sequence(F.lit(0), F.ceil(F.log2(F.greatest(F.size(v), F.lit(1)))).cast("int")), v, further))


@contextmanager
def small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Within it, a batch that goes to Python holds so many rows at most: for rows that are large."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


class Scratch:
    """Tables written to the folder that all executors share, to cut lineage.

    The folder is that of ``spark.checkpoint.dir``; where a session on one machine names none, the warehouse
    folder takes its place, and on a cluster that is an error. A table is written by Spark's committer, so a lost executor's half-written files
    are never read, and what a finished step wrote needs no recomputation.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            if not spark.sparkContext.master.startswith("local["):
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            base = f"{spark.conf.get('spark.sql.warehouse.dir')}/scratch"
        if not re.match(r"\w+:", base):
            base = f"file://{base}"
        self.root = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table(self, name: str, df: DataFrame) -> DataFrame:
        """Write df and return what was written. The shuffle files of the step go when it has ended."""
        before = self.spark.conf.get(_CLEANUP)
        self.spark.conf.set(_CLEANUP, "true")
        try:
            df.write.mode("overwrite").option("compression", "zstd").parquet(self.path(name))
        finally:
            self.spark.conf.set(_CLEANUP, before)
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        """Delete tables that no later step reads."""
        fs = self.spark._jvm.org.apache.hadoop.fs
        for name in names:
            place = fs.Path(self.path(name))
            place.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(place, True)
