"""A vector index of inverted lists, and exact searches of every row in one job.

Unit vectors lie in lists around coarse centroids, each with a centre and a radius; a crowded list is several
blocks. A block of queries meets the blocks of the index nearest first, and no further than the triangle
inequality allows its rows to hold anything better: so the search is exact, and far blocks aren't read at all.
Blocks are files; a task holds a few blocks of queries and reads each block that one of them may need once.
With `probes`, a block of queries meets so many blocks only; what that finds is a part of the exact answer,
and `recall` measures how much.

Defined results: null and non-finite vectors, and those of another length than most, are neither found nor
asked for; a zero vector has similarity 0; of equal similarities the smaller key comes first; rows that share a
key never find each other; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import blocks as B, graph

#: Rows of a block, and blocks. Beyond their product, blocks grow.
BLOCK_ROWS, MAX_BLOCKS = 2048, 4096
_TILE = 1024
_SLACK = 1e-9
#: Blocks of queries that a task holds, at most.
_HELD = 16
_BLOCK = "block int, key binary, label binary, x binary, asked binary"


class _Rows(NamedTuple):
    """A block's keys in order, labels (the least number for null), vectors, and vectors to ask with, where they were read."""

    key: np.ndarray
    label: np.ndarray
    x: np.ndarray
    asked: np.ndarray


class Index(NamedTuple):
    spark: SparkSession
    blocks: B.Blocks
    #: The blocks' numbers.
    numbers: list[int]
    #: Centre and radius of each block's vectors, and of those to ask with.
    centre: np.ndarray
    radius: np.ndarray
    asked_centre: np.ndarray
    asked_radius: np.ndarray


def _open(blocks: B.Blocks, block: int, asked: bool = True) -> _Rows:
    r = blocks.open(block, ["key", "label", "x", *(["asked"] if asked else [])])
    key = np.frombuffer(r["key"], "<i8")
    shaped = lambda c: np.frombuffer(r[c], "<f8").reshape(len(key), -1) if c in r else np.empty((0, 0))
    return _Rows(key, np.frombuffer(r["label"], "<i8"), shaped("x"), shaped("asked"))


def build(rows: DataFrame, key: str, vector: str, label: str | None = None, ask: str | None = None, folder: str | None = None) -> Index:
    """The index of a table's vectors; `ask` names the vectors to search with, where they are others."""
    spark, folder = rows.sparkSession, folder or graph.shared_folder(rows.sparkSession)
    double = lambda c: F.col(c).cast("array<double>")
    fine = lambda v: F.coalesce((F.size(v) > 0) & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))), F.lit(False))
    known = rows.select(F.col(key).cast("long").alias("key"), (F.col(label).cast("long") if label else F.lit(None).cast("long")).alias("label"), double(vector).alias("x"), double(ask or vector).alias("asked"))
    known = graph.kept(known.filter(fine(F.col("x")) & fine(F.col("asked")) & (F.size("x") == F.size("asked")) & F.col("key").isNotNull()), f"{folder}/known")
    usual = known.groupBy(F.size("x").alias("n")).count().orderBy(F.desc("count"), "n").first()
    known = known.filter(F.size("x") == (usual["n"] if usual else 0))
    n = usual["count"] if usual else 0
    pivots = max(1, min(MAX_BLOCKS, -(-n // BLOCK_ROWS)))
    at = [r["x"] for r in known.orderBy(F.xxhash64("key"), "key").limit(pivots).collect()]
    sent = spark.sparkContext.broadcast(_unit(np.array(at, float)) if at else np.zeros((1, 1)))

    @F.pandas_udf("int")
    def cell(x: pd.Series) -> pd.Series:
        return pd.Series((_unit(np.stack(x.to_numpy()).astype(float)) @ sent.value.T).argmax(1).astype(np.int32))

    celled = graph.kept(known.withColumn("cell", cell("x")), f"{folder}/cells")
    most, first, table = max(BLOCK_ROWS, -(-n // MAX_BLOCKS)), 0, []
    for r in sorted(celled.groupBy("cell").count().collect()):
        table.append((r[0], first, -(-r[1] // most)))
        first += table[-1][2]
    cells = F.broadcast(spark.createDataFrame(table, "cell int, first int, parts int"))
    dealt = celled.join(cells, "cell").withColumn("block", (F.col("first") + F.pmod(F.xxhash64("key", F.lit(3)), F.col("parts"))).cast("int"))

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("key", kind="stable")
        label = pdf["label"].astype("Int64").fillna(np.iinfo(np.int64).min).to_numpy(np.int64)
        flat = lambda c: _unit(np.stack(pdf[c].to_numpy()).astype(float)).astype("<f8").tobytes()
        return pd.DataFrame({"block": pdf["block"].iloc[:1], "key": [pdf["key"].to_numpy().astype("<i8").tobytes()], "label": [label.astype("<i8").tobytes()], "x": [flat("x")], "asked": [flat("asked")]})

    blocks = B.kept(dealt.select("block", "key", "label", "x", "asked").groupBy("block").applyInPandas(pack, _BLOCK), f"{folder}/blocks")

    def measured(group: list[int]) -> Iterator[pa.RecordBatch]:
        for block in group:
            b = _open(blocks, block)
            ball = lambda x: (x.mean(0).tolist(), float(np.linalg.norm(x - x.mean(0), axis=1).max()))
            out = (block, *ball(b.x), *ball(b.asked))
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(out, ("int32", pa.list_(pa.float64()), "float64", pa.list_(pa.float64()), "float64"), strict=True)], ["block", "c", "r", "ac", "ar"])

    there = [[r["block"]] for r in dealt.select("block").distinct().collect()]
    # Bounded by MAX_BLOCKS and the crowded lists' parts: about twice that at most.
    found = sorted(B.tasks(spark, there, measured, "block int, c array<double>, r double, ac array<double>, ar double").collect(), key=lambda r: r["block"])
    return Index(spark, blocks, [r["block"] for r in found], *(np.array([r[c] for r in found]) for c in ("c", "r", "ac", "ar")))


def _unit(x: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(length > 0, length, 1)


def _least(index: Index, q: int) -> np.ndarray:
    """Least distance of each block's vectors to what the block in place q asks with."""
    return np.maximum(np.linalg.norm(index.centre - index.asked_centre[q], axis=1) - index.radius - index.asked_radius[q] - _SLACK, 0)


def _met(index: Index, start, step, bar, end, schema: str, probes: int | None = None) -> DataFrame:
    """end(state) of each block of queries, made by start(rows) and, for blocks that may hold something better, step(state, rows).

    bar(state) is the least similarity that still matters. A task's queries meet their own blocks first, then the nearest; with
    `probes`, the blocks with so many nearest centres, whatever they may hold.
    """
    spark, n, known = index.spark, len(index.radius), index._replace(spark=None)
    sent = spark.sparkContext.broadcast(known)
    held = max(1, min(_HELD, n // (4 * spark.sparkContext.defaultParallelism)))

    def meet(group: list[int]) -> Iterator[pa.RecordBatch]:
        index = sent.value
        states, near, wanted = {}, {}, {}
        for q in group:
            states[q] = start(b := _open(index.blocks, index.numbers[q]))
            step(states[q], b)
            near[q] = _least(index, q)
            wanted[q] = np.full(n, True)
            if probes is not None:
                wanted[q][np.linalg.norm(index.centre - index.asked_centre[q], axis=1).argsort(kind="stable")[probes:]] = False
            wanted[q][q] = False
        # A similarity of unit vectors is 1 - distance squared / 2; a zero vector's is 0.
        better = lambda q, k: near[q][k] <= 0 or max(1 - near[q][k] ** 2 / 2, 0) + _SLACK >= bar(states[q])
        for k in np.argsort(np.min([near[q] for q in group], axis=0), kind="stable"):
            for_it = [q for q in group if wanted[q][k] and better(q, k)]
            if for_it:
                other = _open(index.blocks, index.numbers[k], asked=False)
                for q in for_it:
                    step(states[q], other)
        for q in group:
            yield end(states[q])

    return B.tasks(spark, [list(range(i, min(i + held, n))) for i in range(0, n, held)], meet, schema)


class _Best:
    """The k best of each query so far, as flat arrays in order of the queries."""

    def __init__(self, b: _Rows, k: int):
        self.b, self.k = b, k
        self.least = np.full(len(b.key), -np.inf)
        self.row, self.sim = np.empty(0, np.int64), np.empty(0)
        self.key, self.label = np.empty(0, np.int64), np.empty(0, np.int64)

    def meet(self, other: _Rows) -> None:
        parts = [(self.row, self.sim, self.key, self.label)]
        for lo in range(0, len(self.b.key), _TILE):
            s = self.b.asked[lo : lo + _TILE] @ other.x.T
            s[self.b.key[lo : lo + _TILE, None] == other.key] = -np.inf
            m = min(self.k, s.shape[1])
            bar = np.maximum(np.partition(s, -m, axis=1)[:, -m], self.least[lo : lo + _TILE])
            i, j = np.nonzero((s >= bar[:, None]) & (s > -np.inf))
            parts.append((i + lo, s[i, j], other.key[j], other.label[j]))
        row, sim, key, label = (np.concatenate(c) for c in zip(*parts, strict=True))
        order = np.lexsort((key, -sim, row))
        row, sim, key, label = row[order], sim[order], key[order], label[order]
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        self.row, self.sim, self.key, self.label = (c[rank < self.k] for c in (row, sim, key, label))
        last = rank == self.k - 1
        self.least[row[last]] = sim[last]

    def rows(self) -> pa.RecordBatch:
        null = lambda v: pa.array(v, mask=v == np.iinfo(np.int64).min).cast("int32")
        rank = np.arange(len(self.row)) - np.searchsorted(self.row, self.row) + 1
        return pa.RecordBatch.from_arrays(
            [pa.array(self.b.key[self.row]), null(self.b.label[self.row]), pa.array(self.key), null(self.label), pa.array(self.sim), pa.array(rank.astype(np.int32))],
            ["query", "query_label", "neighbour", "label", "similarity", "rank"],
        )


_FOUND = "query long, query_label int, neighbour long, label int, similarity double, rank int"


def neighbours(index: Index, k: int, probes: int | None = None, folder: str | None = None) -> DataFrame:
    """query, query_label, neighbour, label, similarity, rank: the k most similar rows of each row, itself left out.

    Exact without `probes`; with it, a block of queries looks into that many blocks, those with the nearest centres.
    """
    if not len(index.radius):
        return index.spark.createDataFrame([], _FOUND)
    folder = folder or graph.shared_folder(index.spark)
    return graph.kept(_met(index, lambda b: _Best(b, k), _Best.meet, lambda best: best.least.min(), _Best.rows, _FOUND, probes), f"{folder}/found")


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """n, recall: of the exact neighbours, how many are among those found."""
    hits = exact.select("query", "neighbour").join(found.select("query", "neighbour", F.lit(1).alias("hit")), ["query", "neighbour"], "left")
    return hits.agg(F.count("*").alias("n"), F.avg(F.coalesce("hit", F.lit(0))).alias("recall"))


def ranks(index: Index, folder: str | None = None) -> DataFrame:
    """key, own (similarity of the row's two vectors), above: how many rows' vectors are more similar to what the row asks with."""
    schema = "key long, own double, above long"
    if not len(index.radius):
        return index.spark.createDataFrame([], schema)
    folder = folder or graph.shared_folder(index.spark)

    def start(b: _Rows) -> dict:
        return {"b": b, "own": (b.x * b.asked).sum(1), "above": np.zeros(len(b.key), np.int64)}

    def step(state: dict, other: _Rows) -> None:
        b = state["b"]
        for lo in range(0, len(b.key), _TILE):
            s = b.asked[lo : lo + _TILE] @ other.x.T
            # A row isn't above itself, whatever the order of its sums.
            more = (s > state["own"][lo : lo + _TILE, None]) & (b.key[lo : lo + _TILE, None] != other.key)
            state["above"][lo : lo + _TILE] += more.sum(1)

    def end(state: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(state["b"].key), pa.array(state["own"]), pa.array(state["above"])], ["key", "own", "above"])

    # Blocks that can hold nothing above the least own similarity stay away.
    return graph.kept(_met(index, start, step, lambda state: state["own"].min(), end, schema), f"{folder}/ranks")
