"""Average-link clustering by cosine, without a matrix of distances.

For unit vectors the mean distance of two clusters is 1 - S_a.S_b / (n_a n_b), so a cluster is its sum and
its size. Clusters without a path of links above a similarity never merge above it, whatever else merges: a mean
is no greater than its greatest part. So equal vectors are one cluster from the start; then a pass over blocks of
clusters, read by the tasks that hold them, leaves a forest of greatest links that spans the connected groups
at each similarity. A group of bounded size is merged by one task, alone. Of a larger one, the parts that hang together
at a higher similarity are merged down to that, and what they make goes into the next pass; clusters without
a link are done. Each pass's clusters are written.

Defined results: clusters merge while their mean distance is below the threshold; rows whose vector is null or
non-finite, or of another length than most, have a null label; a zero vector has distance 1 to all; the label of a
cluster is the least number of its rows, and rows are numbered as they come; where two distances are equal to
the last digit, the smaller numbers merge first; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import vectors as V
from . import blocks as B
from . import graph

#: Clusters of a block, and blocks. Beyond their product, blocks grow.
BLOCK_ROWS, MAX_BLOCKS = 2048, 4096
#: Clusters of a group that one task merges, at most: their similarities are a matrix there.
GROUP_ROWS = 4096
#: Blocks that a task holds, and links after which it keeps their forest alone.
HELD, MANY_LINKS = 16, 500_000
_SLACK, _SINGLE_SLACK = 1e-9, 1e-5


class _Blocks(NamedTuple):
    """Centre and radius of each block's cluster means."""

    centre: np.ndarray
    radius: np.ndarray

    def between(self, own: int) -> np.ndarray:
        """The greatest similarity that clusters of each block may have to those of this one."""
        c, r = self.centre, self.radius
        length = np.linalg.norm(c, axis=1)
        return c @ c[own] + length * r[own] + length[own] * r + r * r[own] + _SLACK


def _merged(n: np.ndarray, total: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Merge reciprocal pairs until none is nearer than `least`: live clusters, the place that each went to, sizes, totals."""
    n, total, to = n.astype(float), total.copy(), np.arange(len(n))
    # Places of the clusters that the matrix holds; it is made anew when half of them are gone.
    here = np.arange(len(n))
    while len(here) > 1:
        mean, size = total[here] / n[here, None], len(here)
        sims, every, live = mean @ mean.T, np.arange(size), np.ones(size, bool)
        np.fill_diagonal(sims, -np.inf)
        best = sims.argmax(1)
        value = sims[every, best]
        while True:
            open_ = live & (value > least)
            if not open_.any():
                here = here[:0]
                break
            a = np.flatnonzero(open_ & (best[best] == every) & (every < best))
            if not len(a):
                # Rounding may leave a circle; its nearest pair merges.
                top = int(np.where(open_, value, -np.inf).argmax())
                a = np.array([min(top, best[top])])
                b = np.array([max(top, best[top])])
            else:
                b = best[a]
            n[here[a]] += n[here[b]]
            total[here[a]] += total[here[b]]
            to[here[b]] = here[a]
            live[b] = False
            mean[a] = total[here[a]] / n[here[a], None]
            sims[b, :] = sims[:, b] = -np.inf
            new = mean[a] @ mean.T
            new[:, ~live] = -np.inf
            sims[a], sims[:, a] = new, new.T
            sims[a, a] = -np.inf
            # A merged cluster is no nearer than its nearer part was: only those that pointed to a part look again.
            changed = np.zeros(size, bool)
            changed[a] = changed[b] = True
            again = np.flatnonzero(live & (changed | changed[best]))
            best[again] = sims[again].argmax(1)
            value[again] = sims[again, best[again]]
            if 2 * live.sum() < size > 64:
                # Those without a link have none later.
                here = here[live & (value > least)]
                break
    while (to[to] != to).any():
        to = to[to]
    return to == np.arange(len(n)), to, n, total


def _forest(a: np.ndarray, b: np.ndarray, similarity: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A spanning forest of greatest links (a < b); of equal ones, those of smaller numbers."""
    order = np.lexsort((b, a, -similarity))
    nodes, at = np.unique(np.concatenate([a[order], b[order]]), return_inverse=True)
    u, v, comp, chosen = at[: len(a)], at[len(a) :], np.arange(len(nodes)), []
    alive = np.arange(len(a))
    while True:
        cu, cv = comp[u[alive]], comp[v[alive]]
        apart = cu != cv
        alive, cu, cv = alive[apart], cu[apart], cv[apart]
        if not len(alive):
            break
        # Of assignments to one place the last holds, so from the back the greatest link does.
        none = len(alive)
        first = np.full((2, len(nodes)), none)
        back = np.arange(none)[::-1]
        first[0, cu[::-1]], first[1, cv[::-1]] = back, back
        first = first.min(0)
        has = np.flatnonzero(first < none)
        chosen.append(alive[np.unique(first[has])])
        up = np.arange(len(nodes))
        up[has] = np.where(cu[first[has]] == has, cv[first[has]], cu[first[has]])
        both = (up[up] == np.arange(len(nodes))) & (np.arange(len(nodes)) < up)
        up[both] = np.flatnonzero(both)
        while (up[up] != up).any():
            up = up[up]
        comp = up[comp]
    kept = order[np.concatenate(chosen)] if chosen else order[:0]
    return a[kept], b[kept], similarity[kept]


def _dealt(clusters: DataFrame, count: int, folder: str) -> DataFrame:
    """clusters with a block: that of the pivot nearest to the mean; a crowded one is dealt to several."""
    spark = clusters.sparkSession
    pivots = min(MAX_BLOCKS, -(-count // BLOCK_ROWS))
    if pivots < 2:
        return clusters.withColumn("block", F.lit(0))
    at = np.array([np.array(r["total"]) / r["n"] for r in clusters.orderBy(F.xxhash64("cluster"), "cluster").limit(pivots).collect()])
    sent = spark.sparkContext.broadcast(at)

    @F.pandas_udf("int")
    def cell(n: pd.Series, total: pd.Series) -> pd.Series:
        mean, at = np.stack(total.to_numpy()) / n.to_numpy()[:, None], sent.value
        return pd.Series(((at * at).sum(1) - 2 * mean @ at.T).argmin(1).astype(np.int32))

    celled = graph.kept(clusters.withColumn("cell", cell("n", "total")), f"{folder}/cells")
    most, first, table = max(BLOCK_ROWS, -(-count // MAX_BLOCKS)), 0, []
    for r in sorted(celled.groupBy("cell").count().collect()):
        table.append((r[0], first, -(-r[1] // most)))
        first += table[-1][2]
    cells = F.broadcast(spark.createDataFrame(table, "cell int, first int, parts int"))
    block = (F.col("first") + F.pmod(F.xxhash64("cluster", F.lit(3)), F.col("parts"))).cast("int")
    return celled.join(cells, "cell").select("cluster", "n", "total", block.alias("block"))


_BLOCK = "block int, cluster array<long>, mean binary"
_LINK = "a long, b long, similarity double"


def _packed(dealt: DataFrame) -> DataFrame:
    """A row a block."""

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("cluster")
        mean = np.stack(pdf["total"].to_numpy()) / pdf["n"].to_numpy()[:, None]
        return pd.DataFrame({"block": pdf["block"].iloc[:1], "cluster": [pdf["cluster"].tolist()], "mean": [mean.astype("<f8").tobytes()]})

    return dealt.select("block", "cluster", "n", "total").groupBy("block").applyInPandas(pack, _BLOCK)


def _open(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers, means, and means in single precision."""
    ids = np.array(row["cluster"])
    mean = np.frombuffer(row["mean"], "<f8").reshape(len(ids), -1)
    return ids, mean, mean.astype(np.float32)


def _known(blocks: DataFrame) -> tuple[list[int], _Blocks]:
    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                _, mean, _ = _open(r)
                centre = mean.mean(0)
                yield pa.RecordBatch.from_arrays([pa.array([r["block"]], "int32"), pa.array([centre.tolist()]), pa.array([float(np.linalg.norm(mean - centre, axis=1).max())])], ["block", "centre", "radius"])

    found = sorted(blocks.mapInArrow(measured, "block int, centre array<double>, radius double").collect(), key=lambda r: r["block"])
    return [r["block"] for r in found], _Blocks(np.array([r["centre"] for r in found]), np.array([r["radius"] for r in found]))


def _links(clusters: DataFrame, count: int, least: float, folder: str) -> DataFrame:
    """Links above `least`, as far as they are in the forest of a task: they span the connected groups at each similarity."""
    spark = clusters.sparkSession
    blocks = B.kept(_packed(_dealt(clusters, count, folder)), f"{folder}/blocks")
    names, known = _known(blocks.table(spark, _BLOCK))
    n, sent = len(names), spark.sparkContext.broadcast((names, known))

    def pairs(x: tuple, y: tuple, own: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        rough = x[2] @ y[2].T
        i, j = np.nonzero(rough > least - _SINGLE_SLACK)
        if own:
            i, j = i[i < j], j[i < j]
        exact = (x[1] @ y[1].T)[i, j] if len(i) > 100_000 else (x[1][i] * y[1][j]).sum(1)
        some = exact > least
        one, two = x[0][i[some]], y[0][j[some]]
        return np.minimum(one, two), np.maximum(one, two), exact[some]

    def meet(group: list[int]) -> Iterator[pa.RecordBatch]:
        names, known = sent.value
        opened = lambda k: _open(blocks.open(names[k], ["cluster", "mean"]))
        held = {q: (opened(q), known.between(q)) for q in group}
        found, many = [], 0

        def forest() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            return _forest(*(np.concatenate(c) for c in zip(*found, strict=True)))

        for k in range(n):
            # Each two blocks meet once, and each block meets about as many.
            asking = [q for q in group if q == k or ((q + k) % 2 == 0) == (q < k) and held[q][1][k] > least]
            other = held[k][0] if k in held else opened(k) if asking else None
            for q in asking:
                found.append(pairs(held[q][0], other, q == k))
                many += len(found[-1][0])
                if many > MANY_LINKS:
                    found = [forest()]
                    many = len(found[0][0])
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in forest()], ["a", "b", "similarity"])

    per = max(1, min(HELD, n // (3 * spark.sparkContext.defaultParallelism)))
    groups = [list(range(lo, min(lo + per, n))) for lo in range(0, n, per)]
    return graph.kept(B.tasks(spark, groups, meet, _LINK), f"{folder}/links")


def _groups(links: DataFrame, least: float, folder: str) -> tuple[DataFrame, DataFrame | None, DataFrame | None]:
    """cluster, root, least of groups that may be merged alone, the clusters of those too large, and links that no similarity parts."""
    found, rest, inside, cut, turn = [], None, links, least, 0
    while True:
        turn += 1
        roots = graph.components(inside.select("a", "b"), f"{folder}/cut{turn}")
        # At most one large group for each GROUP_ROWS clusters.
        large = F.broadcast(graph.kept(roots.groupBy("root").count().filter(F.col("count") > GROUP_ROWS).select("root"), f"{folder}/large{turn}"))
        found.append(roots.join(large, "root", "left_anti").select(F.col("node").alias("cluster"), "root", F.lit(cut).alias("least")))
        crowded = roots.join(large, "root", "left_semi")
        if crowded.isEmpty():
            return reduce(DataFrame.union, found), rest, None
        rest = crowded.select(F.col("node").alias("cluster")) if rest is None else rest
        inside = graph.kept(inside.join(crowded.select(F.col("node").alias("a")), "a"), f"{folder}/inside{turn}")
        cut = inside.approxQuantile("similarity", [0.5], 0.001)[0]
        higher = inside.filter(F.col("similarity") > cut)
        if higher.isEmpty():
            return reduce(DataFrame.union, found), rest, inside
        inside = higher


def _merge_groups(clusters: DataFrame, groups: DataFrame) -> DataFrame:
    """cluster, to, and for those that stand n and total."""

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("cluster")
        ids = pdf["cluster"].to_numpy()
        live, to, n, total = _merged(pdf["n"].to_numpy(), np.stack(pdf["total"].to_numpy()), float(pdf["least"].iloc[0]))
        return pd.DataFrame({"cluster": ids, "to": ids[to], "n": n.astype(np.int64), "total": [t if keep else None for t, keep in zip(total, live, strict=True)]})

    return clusters.join(groups, "cluster").groupBy("root").applyInPandas(merge, "cluster long, to long, n long, total array<double>")


def _reciprocal(links: DataFrame) -> DataFrame:
    """cluster, to: links that are the greatest of both their ends. Of equal similarities smaller numbers come first, so there is one."""
    order = F.struct((-F.col("similarity")).alias("s"), "a", "b")
    ends = links.select(F.col("a").alias("end"), order.alias("o")).union(links.select(F.col("b").alias("end"), order.alias("o")))
    twice = ends.groupBy("end").agg(F.min("o").alias("o")).groupBy("o.a", "o.b").count().filter("count = 2")
    return twice.select(F.col("b").alias("cluster"), F.col("a").alias("to"))


def clusters(vectors: DataFrame, key: str, threshold: float, vector: str = "embedding", folder: str | None = None) -> DataFrame:
    """key, label of average-link clusters: those nearer than the threshold, by mean cosine distance, merge."""
    spark, folder, least = vectors.sparkSession, folder or graph.shared_folder(vectors.sparkSession), 1 - threshold
    v = F.col(vector).cast("array<double>")
    fine = F.coalesce((F.size(v) > 0) & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))), F.lit(False))
    rows = graph.kept(vectors.select(F.col(key).alias("key"), F.when(fine, v).alias("v")).withColumn("row", F.monotonically_increasing_id()), f"{folder}/rows")
    usual = rows.filter("v is not null").groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    known_rows = rows.filter(F.size("v") == (usual["n"] if usual else 0))
    units = graph.kept(known_rows.select("row", V.normalised(F.col("v")).alias("total")), f"{folder}/units")
    # Equal vectors have similarity 1, so they merge before all others; zero vectors have none.
    same = F.when(F.lit(least < 1 - _SLACK) & ~V.is_zero(F.col("total")), F.lit(0)).otherwise(F.col("row"))
    alike = graph.kept(units.groupBy("total", same.alias("same")).agg(F.min("row").alias("cluster"), F.count("*").alias("n")), f"{folder}/alike")
    copies = units.withColumn("same", same).join(alike.filter("n > 1").select("total", "same", "cluster"), ["total", "same"])
    owner, turn = units.select("row").join(graph.kept(copies.select("row", "cluster"), f"{folder}/copies"), "row", "left").select("row", F.coalesce("cluster", "row").alias("cluster")), 0
    live = alike.select("cluster", "n", F.transform("total", lambda x: x * F.col("n")).alias("total"))

    def renamed(owner: DataFrame, moves: DataFrame, name: str) -> DataFrame:
        return graph.kept(owner.join(moves, "cluster", "left").select("row", F.coalesce("to", "cluster").alias("cluster")), f"{folder}/{name}")

    with graph.small_batches(spark, 2000):
        while count := live.count():
            turn += 1
            links = _links(live, count, least, f"{folder}/pass{turn}")
            if links.isEmpty():
                break
            groups, rest, stuck = _groups(links, least, f"{folder}/groups{turn}")
            merged = graph.kept(_merge_groups(live, groups), f"{folder}/merged{turn}")
            owner = renamed(owner, merged.filter("cluster <> to").select("cluster", "to"), f"owner{turn}")
            if rest is None:
                break
            # What became of the clusters in groups too large goes on.
            stands = live.join(rest, "cluster").join(merged.select("cluster", F.col("total").alias("now"), F.col("n").alias("now_n"), F.lit(True).alias("met")), "cluster", "left")
            stands = stands.filter("met is null or now is not null")
            live = graph.kept(stands.select("cluster", F.coalesce("now_n", "n").alias("n"), F.coalesce("now", "total").alias("total")), f"{folder}/live{turn}")
            if stuck is not None:
                moves = graph.kept(_reciprocal(stuck), f"{folder}/moves{turn}")
                owner = renamed(owner, moves, f"after{turn}")
                # Two rows at most for each new cluster.
                both = live.join(moves, "cluster", "left").groupBy(F.coalesce("to", "cluster").alias("cluster")).agg(F.sum("n").alias("n"), F.collect_list("total").alias("t"))
                total = F.when(F.size("t") == 1, F.get("t", F.lit(0))).otherwise(F.zip_with(F.get("t", F.lit(0)), F.get("t", F.lit(1)), lambda a, b: a + b))
                live = graph.kept(both.select("cluster", "n", total.alias("total")), f"{folder}/pairs{turn}")
    return rows.join(owner, "row", "left").select(F.col("key").alias(key), F.col("cluster").alias("label"))
