"""Sinks: partitioned tables, snapshots, reports; schemas for separate runs."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

REPORT_ROWS = 1_000_000
RUN_STATES = ("running", "success", "failed", "rolled_back")
_NAME = re.compile(r"[A-Za-z_]\w*\Z")


def table(rows: DataFrame, path: str, by: list[str] | None = None, mode: str = "overwrite") -> None:
    """Parquet in folders of the given columns, so a later filter on them reads only its own."""
    writer = rows.write.mode(mode)
    (writer.partitionBy(*by) if by else writer).parquet(path)


def report(rows: DataFrame, path: str, kind: str = "csv", most: int = REPORT_ROWS) -> None:
    """A small result as one file; an error where it has more than `most` rows."""
    if rows.limit(most + 1).count() > most:
        raise ValueError(f"more than {most} rows for one file")
    writer = rows.coalesce(1).write.mode("overwrite")
    writer.option("header", True).csv(path) if kind == "csv" else writer.json(path)


def create_run_schema(spark: SparkSession, run: str) -> str:
    if not _NAME.match(run):
        raise ValueError(f"not a run name: {run}")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS exp_{run}")
    return f"exp_{run}"


def drop_run_schema(spark: SparkSession, run: str) -> None:
    if not _NAME.match(run):
        raise ValueError(f"not a run name: {run}")
    spark.sql(f"DROP DATABASE IF EXISTS exp_{run} CASCADE")


def copy_tables(spark: SparkSession, names: list[str], source: str, target: str) -> None:
    for name in names:
        spark.table(f"{source}.{name}").write.mode("overwrite").saveAsTable(f"{target}.{name}")


def run_state(state: str) -> str:
    """The state, if it is one that a run can have."""
    if state not in RUN_STATES:
        raise ValueError(f"not a run state: {state}")
    return state
