"""Sources: files by folder, text, delimited lines, XML structure, keyed JSON lines, database tables, vectors."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators.changes import latest


def files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """path, modificationTime, length, content of every file below a folder."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    return (reader.option("pathGlobFilter", glob) if glob else reader).load(path)


def texts(spark: SparkSession, path: str) -> DataFrame:
    """path, text: whole files as trimmed text; bytes that aren't UTF-8 are replaced."""
    rows = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True)
    return rows.select(F.input_file_name().alias("path"), T.stripped(F.col("value")).alias("text"))


def delimited(spark: SparkSession, path: str, separator: str = ",") -> DataFrame:
    """path, text: a file's rows as lines, the cells trimmed and joined by a bar."""
    rows = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True)
    lines = F.transform(F.split("value", r"\r?\n"), lambda x: T.csv_line(F.split(x, F.lit(separator))))
    return rows.select(F.input_file_name().alias("path"), F.array_join(F.filter(lines, lambda x: x != ""), "\n").alias("text"))


def xml_structure(documents: DataFrame, xml: str = "xml", limit: int = 8000) -> DataFrame:
    """documents with `structure`: the sorted set of element and @attribute paths; the raw text where XML doesn't parse."""
    @F.pandas_udf("string")
    def paths(column: pd.Series) -> pd.Series:
        from xml.etree import ElementTree

        def walk(node, above: str, out: set) -> set:
            here = f"{above}/{node.tag}"
            out.add(here)
            out.update(f"{here}/@{a}" for a in node.attrib)
            for child in node:
                walk(child, here, out)
            return out

        def of(text: str | None) -> str | None:
            try:
                return text and " ".join(sorted(walk(ElementTree.fromstring(text), "", set())))
            except ElementTree.ParseError:
                return text[:limit]

        return column.map(of, na_action="ignore")

    return documents.withColumn("structure", paths(F.col(xml)))


def json_lines(spark: SparkSession, path: str, schema: str, key: list[str], order: str) -> DataFrame:
    """One row per key, the last by `order`."""
    return latest(spark.read.schema(schema).json(path), key, order)


def merged_outputs(rows: DataFrame, key: str, engine: str, output: str, order: str) -> DataFrame:
    """key, outputs: a map from engine to its last output."""
    last = latest(rows.select(key, engine, output, order), [key, engine], order)
    return last.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct(engine, output))).alias("outputs"))


def database(spark: SparkSession, url: str, table: str, key: str, low: int, high: int, parts: int, **options: str) -> DataFrame:
    """A table by JDBC, read in ranges of a numeric key: filters and columns go to the database."""
    bounds = {"partitionColumn": key, "lowerBound": low, "upperBound": high, "numPartitions": parts}
    return spark.read.format("jdbc").options(url=url, dbtable=table, **bounds, **options).load()


def vectors_of(sample: DataFrame, shards: DataFrame, key: str) -> DataFrame:
    """The sample with its vectors, by key; a sample row without a vector is an error when it is read."""
    joined = sample.join(shards, key, "left")
    absent = F.raise_error(F.concat(F.lit("no vector for "), F.col(key).cast("string")))
    return joined.withColumn("embedding", F.coalesce(F.col("embedding"), absent.cast(joined.schema["embedding"].dataType)))


def exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)
