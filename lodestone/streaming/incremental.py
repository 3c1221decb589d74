"""Work that arrives bit by bit: resumable assignment, and counts per event time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import themes


def assign_stream(vectors: DataFrame, registry: DataFrame, out: str, checkpoint: str, key: str, threshold: float = themes.ASSIGN):
    """Assign a stream of vectors to a registry of themes, written below `out`; what a batch has done is not done again.

    The assignment is a map without state. A batch's folder is overwritten if it runs again, so a restart after
    a lost executor or driver neither loses nor repeats rows.
    """

    def batch(rows: DataFrame, number: int) -> None:
        done = themes.assign(rows, registry, threshold=threshold).select(key, "assigned_theme", "similarity", "is_unknown")
        done.write.mode("overwrite").parquet(f"{out}/batch={number}")

    return vectors.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def counts(events: DataFrame, time: str, by: str, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """window start, by, n. On a stream, events later than `late` are left out and closed windows leave the state."""
    marked = events.withWatermark(time, late) if events.isStreaming else events
    return marked.groupBy(F.window(time, width).alias("w"), by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), by, "n")
