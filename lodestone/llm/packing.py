"""Best-fit packing with certified bin counts.

Every text becomes ids plus an end id; longer ones are cut into pieces of a sequence's length. The pieces
(ids stay behind, a piece is a few numbers) are dealt at random into partitions of bounded size, and each
partition is packed by best-fit decreasing. Dual feasible functions bound from below how many sequences
a partition needs, which certifies a packing that takes no more. Partitions with a gap exchange documents:
the pieces of their unfilled sequences are dealt anew and packed again, those of certified ones wait. When
no partition has a gap, or an exchange saves nothing, the waiting sequences count as one partition with its
own bound; if the whole has a gap still, they are exchanged too. It ends when the bound of the whole is met
or neither exchange saves a sequence.

Defined results: a null or empty text is one piece of the end id; repeated rows are packed as often as
they stand there; a null doc_id is kept; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens
from .common import Scratch, tokenizer_path

LENGTH = 4096
END_ID = 1
#: Pieces that one task packs at a time, about; their number sets the number of partitions.
PARTITION_PIECES = 100_000
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PACKED = "row long, length long, part long, bin long, offset long, fill long, bound long, bins long"


def pieces(docs: DataFrame, path: str | None = None, length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """The pieces of docs (doc_id, text), without their ids."""
    path = path or tokenizer_path()
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, step = tokens.encoder(path), 4 * length
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = encode(text) + end
                for k, at in enumerate(range(0, len(ids), step)):
                    own = ids[at : at + step]
                    rows.append((doc_id, k, at // 4, len(own) // 4, tokens.crc(own)))
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            kinds = ("int64", "int32", "int64", "int64", "int64")
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(cut, _PIECES)


def lower_bound(count: np.ndarray, capacity: int) -> int:
    """Bins that any packing of count[s] pieces of each size s needs: the best of two families of dual feasible functions.

    The first maps sizes over capacity - a to the whole bin and those below a to nothing, for each a up
    to half a bin; the second rounds size / capacity to k-ths, for k up to 20.
    """
    value = np.arange(capacity + 1, dtype=np.int64)
    total = int((count * value).sum())
    best = -(-total // capacity)
    up_to, sums = np.cumsum(count), np.cumsum(count * value)
    half = capacity // 2
    a = np.arange(0, half + 1)
    above = np.where(a > 0, up_to[capacity] - up_to[capacity - a], 0)  # larger than capacity - a: a bin each
    middle = np.where(a > 0, sums[capacity - a] - sums[np.maximum(a - 1, 0)], total)
    best = max(best, int((above + -(-middle // capacity)).max()))
    for k in range(1, 21):
        scaled = (k + 1) * value
        exact = scaled % capacity == 0
        # In units of 1 / (k * capacity).
        weight = np.where(exact, value * k, scaled // capacity * capacity)
        best = max(best, int(-(-(count * weight).sum() // (k * capacity))))
    return best


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each size; open bins are found by their free room, in a bit set."""
    bins, offsets = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, made = 0, 0
    for i in np.argsort(-sizes, kind="stable"):
        size = int(sizes[i])
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            b = open_bins[room].pop()
            if not open_bins[room]:
                rooms ^= 1 << room
        else:
            room, b, made = capacity, made, made + 1
        bins[i], offsets[i] = b, capacity - room
        left = room - size
        if left:
            if not open_bins[left]:
                rooms |= 1 << left
            open_bins[left].append(b)
    return bins, offsets


def pack(found: DataFrame, scratch: Scratch, length: int = LENGTH, target: int = PARTITION_PIECES) -> DataFrame:
    """Pieces with sequence_id and offset."""
    spark = found.sparkSession
    # The row number is written with the pieces, so a task that runs again sees the same numbers.
    stored = scratch.table("pieces", found.withColumn("row", F.monotonically_increasing_id()))
    whole = stored.filter(F.col("length") == length).select("row", F.lit(0).cast("long").alias("offset"), F.col("row").alias("sequence_id"))
    histogram = {r["length"]: r["n"] for r in stored.groupBy("length").agg(F.count("*").alias("n")).collect()}
    rest = {k: v for k, v in histogram.items() if k < length}
    counts = np.zeros(length + 1, np.int64)
    counts[list(rest)] = list(rest.values())
    least = lower_bound(counts, length)

    def packed(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("row")
        lengths = pdf["length"].to_numpy()
        bins, offsets = best_fit_decreasing(lengths, length)
        fill = np.bincount(bins, lengths).astype(np.int64) if len(bins) else bins
        return pd.DataFrame(
            {
                "row": pdf["row"].to_numpy(), "length": lengths, "part": pdf["part"].to_numpy(), "bin": bins, "offset": offsets,
                "fill": fill[bins], "bound": lower_bound(np.bincount(lengths, minlength=length + 1), length), "bins": int(bins.max(initial=-1)) + 1,
            }
        )

    # Sequences that stay, and unfilled ones of certified partitions, which wait.
    done, used, waiting, n_waiting = [whole], 0, None, 0
    pool, n, turn, kept = stored.filter(F.col("length") < length).select("row", "length"), sum(rest.values()), 0, None
    while n:
        parts = -(-n // target)
        part = F.pmod(F.xxhash64("row", F.lit(turn)), F.lit(parts))
        dealt = pool.withColumn("part", part).repartition(parts, "part").groupBy("part").applyInPandas(packed, _PACKED)
        now = scratch.table(f"turn{turn}", dealt)
        number = F.lit(-(turn + 1) << 56) - F.col("part") * (1 << 32) - F.col("bin")
        rows = now.select("row", "length", "offset", number.alias("sequence_id"), (F.col("fill") == length).alias("full"), (F.col("bins") > F.col("bound")).alias("gap"))
        found = rows.select("sequence_id", "full", "gap").distinct().agg(
            F.count("*").alias("bins"), F.count_if("full").alias("full"), F.count_if(~F.col("full") & ~F.col("gap")).alias("certified"),
            F.count_if(~F.col("full") & F.col("gap")).alias("open"),
        ).first()
        if kept is not None and found["bins"] >= kept[1]:
            # No fewer than before: what was there stays.
            done.append(kept[0])
            used, again = used + kept[1], None
        elif parts == 1 or used + n_waiting + found["bins"] <= least:
            done.append(rows)
            used, again = used + found["bins"], None
        else:
            done.append(rows.filter("full"))
            used += found["full"]
            if found["certified"]:
                own = rows.filter("not full and not gap")
                waiting, n_waiting = own if waiting is None else waiting.unionByName(own), n_waiting + found["certified"]
            again = (rows.filter("not full and gap"), found["open"]) if found["open"] else None
        if again is None and waiting is not None:
            if used + n_waiting <= least:
                done.append(waiting)
                break
            again, waiting, n_waiting = (waiting, n_waiting), None, 0
        if again is None:
            break
        kept, turn = again, turn + 1
        pool = kept[0].select("row", "length")
        n = pool.count()
    done = [d.select("row", "offset", "sequence_id") for d in done]
    placed = done[0]
    for d in done[1:]:
        placed = placed.unionByName(d)
    placed = placed.withColumn("least_sequences", F.lit(least + histogram.get(length, 0)).cast("long"))
    return stored.join(placed, "row").drop("row")

