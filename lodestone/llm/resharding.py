"""Minimum-cost-flow resharding.

A shard's rows fall into blocks by the hash of their id and text: a fixed number of blocks a shard, whatever
the data, so block sizes are the only thing the driver sees. A block of several rows that holds more than one
in HEAVY of a new shard, as when equal rows are many, is cut further by row number; the rows are written with
their numbers first, so that all later steps see the same ones. A minimum-cost flow from old shard sizes to new
capacities says how many bytes each shard sends where, with a byte that stays costing nothing; whole
blocks are then chosen for each transfer, the largest that still fit first. The plan is a table of bounded
size, so joining it to the rows needs no shuffle. Only shards that send or get a block are rewritten.

Defined results: a null text has no bytes but counts 1 as every row does; rows with a null id, or a null
old shard, form blocks like others; rows that are equal in all columns keep separate slots; an empty
table gives no rows.
"""

from __future__ import annotations

import heapq
from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch

#: Blocks in each old shard. Shard sizes come out equal to about a block's share of a shard.
BLOCKS = 1024
#: A block of several rows that holds more than one in so many of a new shard's bytes is cut into parts of about that size.
HEAVY = 128
#: Bytes of a file that a rewritten shard is cut into, about.
FILE_BYTES = 256 << 20


class Transfer(NamedTuple):
    source: int
    target: int
    size: int


def min_cost_flow(supply: list[int], capacity: list[int], cost) -> list[Transfer]:
    """Cheapest transfers that empty `supply` into `capacity`, by shortest augmenting paths with potentials.

    cost(i, j) is what a byte from source i to target j costs. Shards are few, so a dense matrix will do.
    """
    n, m = len(supply), len(capacity)
    if sum(supply) > sum(capacity):
        raise ValueError("the capacities are too small")
    flow = [[0] * m for _ in range(n)]
    left, room = list(supply), list(capacity)
    height = [0] * (n + m)  # potentials
    while any(left):
        # Dijkstra over reduced costs, from all sources with something left.
        far, parent = [float("inf")] * (n + m), [-1] * (n + m)
        queue = [(0, i) for i in range(n) if left[i]]
        for _, i in queue:
            far[i] = 0
        while queue:
            d, u = heapq.heappop(queue)
            if d > far[u]:
                continue
            edges = ((n + j, cost(u, j)) for j in range(m)) if u < n else ((i, -cost(i, u - n)) for i in range(n) if flow[i][u - n])
            for v, c in edges:
                reduced = d + c + height[u] - height[v]
                if reduced < far[v]:
                    far[v], parent[v] = reduced, u
                    heapq.heappush(queue, (reduced, v))
        end = min((v for v in range(n, n + m) if room[v - n]), key=lambda v: far[v] + height[v])
        limit = far[end]
        height = [h + min(f, limit) for h, f in zip(height, far, strict=True)]
        path, v = [end], end
        while parent[v] >= 0:
            v = parent[v]
            path.append(v)
        path.reverse()
        amount = min(left[path[0]], room[end - n])
        for a, b in zip(path, path[1:], strict=False):
            if a >= n:
                amount = min(amount, flow[b][a - n])
        for a, b in zip(path, path[1:], strict=False):
            if a < n:
                flow[a][b - n] += amount
            else:
                flow[b][a - n] -= amount
        left[path[0]] -= amount
        room[end - n] -= amount
    return [Transfer(i, j, f) for i, row in enumerate(flow) for j, f in enumerate(row) if f]


def choose_blocks(blocks: dict[tuple[int, int], int], transfers: list[Transfer], sizes: list[int]) -> dict[tuple[int, int], int]:
    """A target for each (old shard, block) of the given bytes, as near to the transfers as whole blocks allow."""
    of: dict[int, list[tuple[int, int]]] = {}
    for (shard, block), size in blocks.items():
        of.setdefault(shard, []).append((size, block))
    out: dict[tuple[int, int], int] = {}
    debt = [0] * len(sizes)  # bytes that a target got beyond, or short of, its due
    for shard, own in of.items():
        due = {t.target: t.size for t in transfers if t.source == shard}
        due.setdefault(shard, 0) if shard < len(sizes) else None
        for size, block in sorted(own, reverse=True):
            # The largest block goes to who is still due most; a block stays where that is no worse.
            target = max(due, key=lambda j: (due[j] - debt[j], j == shard, -j))
            due[target] -= size
            out[shard, block] = target
        for j, short in due.items():
            debt[j] -= short
    return out


def reshard(
    rows: DataFrame, out: str, scratch: Scratch, *, id_column: str, text_column: str, old_shard: str, shards: int,
    blocks: int = BLOCKS, file_bytes: int = FILE_BYTES,
) -> tuple[DataFrame, list[Transfer]]:
    """Rewrite rows below `out`, one folder a shard; all rows with `shard`, `slot` and `moved`, and the transfers.

    Input columns named like the results are replaced.

    Shards that neither send nor get a block are left out of what is written: their files stand, and their
    rows come from the input.
    """
    spark = rows.sparkSession
    rows = rows.drop(*({"shard", "slot", "moved"} - {id_column, text_column, old_shard}))
    block = F.pmod(F.xxhash64(F.col(id_column), F.col(text_column), F.lit(9)), F.lit(blocks)).cast("int")
    size = F.coalesce(F.octet_length(text_column), F.lit(0)).cast("long") + 1
    marked = rows.withColumns({"_old": F.coalesce(F.col(old_shard), F.lit(0)), "_block": block, "_size": size})
    # At most `blocks` rows for each old shard, whatever the data.
    by_block = lambda: marked.groupBy("_old", "_block").agg(F.sum("_size").alias("size"), F.count("*").alias("n")).collect()
    stats = by_block()
    share = sum(r["size"] for r in stats) / shards / HEAVY
    # At most HEAVY * shards blocks, and about twice as many parts.
    if heavy := [(r["_old"], r["_block"], -int(-r["size"] // share)) for r in stats if r["n"] > 1 and r["size"] > share]:
        cut = F.broadcast(spark.createDataFrame(heavy, "_old int, _block int, _heavy int"))
        part = F.coalesce(F.pmod(F.col("_row"), F.col("_heavy")), F.lit(0)).cast("int")
        numbered = scratch.table("numbered", marked.withColumns({"_row": F.monotonically_increasing_id(), "_old": F.col("_old").cast("int")}))
        marked = numbered.join(cut, ["_old", "_block"], "left").withColumn("_block", F.col("_block") + blocks * part).drop("_row", "_heavy")
        stats = by_block()
    sizes = {(r["_old"], r["_block"]): r["size"] for r in stats}
    rows_of = {(r["_old"], r["_block"]): r["n"] for r in stats}
    total, sources = sum(sizes.values()), max([shards, *(s + 1 for s, _ in sizes)])
    supply = [0] * sources
    for (s, _), v in sizes.items():
        supply[s] += v
    capacity = [total // shards + (j < total % shards) for j in range(shards)]
    transfers = min_cost_flow(supply, capacity, lambda i, j: int(i != j))
    to = choose_blocks(sizes, transfers, capacity)
    changed = {j for (s, _), j in to.items() if s != j} | {s for (s, _), j in to.items() if s != j}
    # Blocks of a shard go to groups of about a file's bytes; a group's rows get consecutive slots.
    plan, filled, at, group = [], {}, {}, {}
    for key, target in sorted(to.items(), key=lambda x: (x[1], x[0])):
        if filled.get(target, 0) >= file_bytes:
            filled[target] = 0
            group[target] = group.get(target, 0) + 1
        g = group.setdefault(target, 0)
        filled[target] = filled.get(target, 0) + sizes[key]
        plan.append((*key, target, g, at.get(target, 0), int(key[0] != target)))
        at[target] = at.get(target, 0) + rows_of[key]
    schema = "_old int, _block int, shard int, _group int, _base long, moved int"
    marked = marked.withColumn("_old", F.col("_old").cast("int"))
    # A block is a small, even part of a shard: its rows are numbered by one sort in one task.
    order = Window.partitionBy("shard", "_group", "_old", "_block").orderBy(F.col(id_column), F.col(text_column))

    def slots(part: list[tuple]) -> DataFrame:
        placed = marked.join(F.broadcast(spark.createDataFrame(part, schema)), ["_old", "_block"]).repartition("shard", "_group")
        numbered = placed.withColumn("slot", F.col("_base") + F.row_number().over(order) - 1)
        return numbered.drop("_old", "_block", "_group", "_base", "_size", old_shard).withColumn("moved", F.col("moved") == 1)

    rewritten = slots([p for p in plan if p[2] in changed])
    rewritten.write.mode("overwrite").partitionBy("shard").option("compression", "zstd").parquet(out)
    written = spark.read.schema(rewritten.schema).parquet(out)
    standing = [p for p in plan if p[2] not in changed]
    return written.unionByName(slots(standing)) if standing else written, transfers
