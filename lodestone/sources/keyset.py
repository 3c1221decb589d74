"""A growing table behind a database driver, page by page in the order of its key, as a batch or as a stream.

No page is read by an offset: each begins after the last key of the one before, so a page costs the database one walk of its
index. A batch cuts the keys into ranges, one for each task. As a stream, the offset is the greatest key that has been
handed out; Spark's checkpoint keeps it, so a query that was stopped or killed goes on after the last batch that
ended, and a batch that was broken off is read again between the same keys.

The driver is any DB-API module: `module` names it, `database` is what its connect() takes, `mark` its sign for a
parameter. Keys are whole numbers and grow: a row that comes later with a key below the offset isn't seen, as in any scan of this kind.

Defined results: rows with a null key are never read; an empty table gives no rows; equal keys are read together, so a key may
repeat, but not by more rows than a page holds: that is an error, not a loss.
"""

from __future__ import annotations

import importlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

PAGE_ROWS, RANGES = 10_000, 8
_NAME = re.compile(r"[A-Za-z_][\w.]*\Z")


@dataclass
class Keys(InputPartition):
    """Keys after `low`, up to `high`."""

    low: int
    high: int


def ranges(low: int, high: int, n: int) -> list[Keys]:
    """(low, high] in at most n ranges of near equal width, none of them empty."""
    n = max(1, min(n, high - low))
    cuts = [low + (high - low) * i // n for i in range(n + 1)]
    return [Keys(a, b) for a, b in zip(cuts, cuts[1:], strict=False) if a < b]


class _Table:
    """The source's options, and pages of rows by them."""

    def __init__(self, options: dict[str, str], columns: list[str]):
        self.module, self.database, self.mark = options.get("module", "sqlite3"), options["database"], options.get("mark", "?")
        self.table, self.key, self.columns = options["table"], options["key"], columns
        self.where, self.page, self.n = options.get("where", ""), int(options.get("pageRows", PAGE_ROWS)), int(options.get("ranges", RANGES))
        for name in (self.table, self.key, *columns):
            if not _NAME.match(name):
                raise ValueError(f"not a name of a table or column: {name}")

    def _rows(self, sql: str, *values: int) -> list[tuple]:
        connection = importlib.import_module(self.module).connect(self.database)
        try:
            cursor = connection.cursor()
            cursor.execute(sql, values)
            return cursor.fetchall()
        finally:
            connection.close()

    def _also(self, word: str) -> str:
        return f" {word} ({self.where})" if self.where else ""

    def bounds(self) -> tuple[int | None, int | None]:
        return self._rows(f"SELECT MIN({self.key}), MAX({self.key}) FROM {self.table}{self._also('WHERE')}")[0]

    def pages(self, part: Keys) -> Iterator[tuple]:
        """Rows of a range. A full page gives up its last key, whose other rows may not be on it, to the next page."""
        columns, after = ", ".join([self.key, *self.columns]), part.low
        sql = f"SELECT {columns} FROM {self.table} WHERE {self.key} > {self.mark} AND {self.key} <= {self.mark}{self._also('AND')} ORDER BY {self.key} LIMIT {self.page + 1}"
        while rows := self._rows(sql, after, part.high):
            if len(rows) > self.page:
                last = rows[-1][0]
                rows = [r for r in rows if r[0] < last]
                if not rows:
                    raise ValueError(f"more than {self.page} rows have the key {last}")
            yield from (tuple(r[1:]) for r in rows)
            after = rows[-1][0]


class _Batch(DataSourceReader):
    def __init__(self, table: _Table):
        self.table = table

    def partitions(self) -> list[Keys]:
        low, high = self.table.bounds()
        return [Keys(0, 0)] if low is None else ranges(low - 1, high, self.table.n)

    def read(self, partition: Keys) -> Iterator[tuple]:
        return self.table.pages(partition)


class _Stream(DataSourceStreamReader):
    def __init__(self, table: _Table):
        self.table = table

    def initialOffset(self) -> dict[str, int]:
        return {"key": -(1 << 63)}

    def latestOffset(self) -> dict[str, int]:
        return {"key": self.initialOffset()["key"] if (high := self.table.bounds()[1]) is None else high}

    def partitions(self, start: dict[str, int], end: dict[str, int]) -> list[Keys]:
        low, high = start["key"], end["key"]
        if low == self.initialOffset()["key"] and (least := self.table.bounds()[0]) is not None:
            low = min(least - 1, high)
        return ranges(low, high, self.table.n) or [Keys(0, 0)]

    def read(self, partition: Keys) -> Iterator[tuple]:
        return self.table.pages(partition)


class KeysetTable(DataSource):
    """Options: module, database, table, key, where, mark, pageRows, ranges."""

    @classmethod
    def name(cls) -> str:
        return "keyset_table"

    def reader(self, schema: StructType) -> _Batch:
        return _Batch(_Table(self.options, schema.names))

    def streamReader(self, schema: StructType) -> _Stream:
        return _Stream(_Table(self.options, schema.names))


def batch(spark: SparkSession, schema: str, **options: str | int) -> DataFrame:
    """The table as it is now."""
    spark.dataSource.register(KeysetTable)
    return spark.read.format("keyset_table").schema(schema).options(**options).load()


def stream(spark: SparkSession, schema: str, **options: str | int) -> DataFrame:
    """The table and what is added to it."""
    spark.dataSource.register(KeysetTable)
    return spark.readStream.format("keyset_table").schema(schema).options(**options).load()
