"""Themes that gather rows within a span of time: buffered until there are enough, then given out; as a batch or on a stream.

A row is given out just if some interval of the span holds it and at least `least` rows of its theme, so neither the
order of arrival nor the size of a batch matters. Time is cut into pieces as long as the span: all that can
decide about a row lies in its own piece and the two beside it, so a theme that holds a third of all rows is worked on
in as many tasks as it has pieces, at the price of three copies of key and time.

On a stream a piece is a group with state, which holds the keys and times that have come and which of them have been
given out. It leaves the state when the watermark passes the piece after it. A lost executor's groups are restored from the
checkpoint, and no row is given out twice.

Defined results: rows with a null theme or time are never given out; a null key counts and is given out; rows that are equal count
and are given out each; an empty table gives none. On a stream, rows later than `late` are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

LEAST, SPAN_SECONDS, LATE = 15, 7 * 86_400, "1 day"


def _pieces(rows: DataFrame, key: str, theme: str, time: str, span: int) -> DataFrame:
    """_theme, _piece, _key, _time, _at (microseconds), _mine: each row in its own piece and the two beside it."""
    at = F.unix_micros(F.col(time).cast("timestamp"))
    plain = rows.select(F.col(theme).alias("_theme"), F.col(key).alias("_key"), F.col(time).alias("_time"), at.alias("_at"))
    own = F.floor(F.col("_at") / F.lit(span)).cast("long")
    beside = F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1)))
    out = plain.filter("_theme is not null and _at is not null").select("*", beside.alias("_step"))
    return out.select("_theme", (own + F.col("_step")).alias("_piece"), "_key", "_time", "_at", (F.col("_step") == 0).alias("_mine"))


def _crowded(at: np.ndarray, least: int, span: int) -> np.ndarray:
    """Which of the times lie in an interval of the span with at least so many of them."""
    order = np.argsort(at, kind="stable")
    sorted_at, n = at[order], len(at)
    out = np.zeros(n, bool)
    if n >= least:
        begins = np.flatnonzero(sorted_at[least - 1 :] - sorted_at[: n - least + 1] <= span)
        edges = np.zeros(n + 1, int)
        np.add.at(edges, begins, 1)
        np.add.at(edges, begins + least, -1)
        out[order] = np.cumsum(edges[:n]) > 0
    return out


def _on_stream(pieces: DataFrame, least: int, span: int) -> DataFrame:
    types = {f.name: f.dataType.simpleString() for f in pieces.schema}
    given = f"_theme {types['_theme']}, _key {types['_key']}, _at long"
    held = f"keys array<{types['_key']}>, at array<long>, mine array<boolean>, told array<boolean>"

    def gather(group: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        keys, at, mine, told = (list(part) for part in state.get) if state.exists else ([], [], [], [])
        for frame in frames:
            # Missing whole numbers come as NaN; what is whole goes back to whole.
            keys += [None if pd.isna(k) else int(k) if isinstance(k, (float, np.floating)) and types["_key"] in ("int", "bigint") else getattr(k, "item", lambda k=k: k)() for k in frame["_key"]]
            at += [int(x) for x in frame["_at"]]
            mine += [bool(x) for x in frame["_mine"]]
            told += [False] * len(frame)
        now = _crowded(np.array(at, np.int64), least, span) & np.array(mine) & ~np.array(told)
        out = np.flatnonzero(now)
        state.update((keys, at, mine, [bool(t) for t in now | np.array(told)]))
        state.setTimeoutTimestamp((int(group[1]) + 2) * span // 1000)
        if len(out):
            yield pd.DataFrame({"_theme": group[0], "_key": pd.Series([keys[i] for i in out], dtype=object), "_at": [at[i] for i in out]})

    return pieces.groupBy("_theme", "_piece").applyInPandasWithState(gather, given, held, "append", GroupStateTimeout.EventTimeTimeout)


def bursts(rows: DataFrame, key: str, theme: str, time: str, least: int = LEAST, span_seconds: int = SPAN_SECONDS, late: str = LATE) -> DataFrame:
    """theme, key, time of the rows that have enough of their theme about them."""
    span = span_seconds * 1_000_000
    if rows.isStreaming:
        found = _on_stream(_pieces(rows.withWatermark(time, late), key, theme, time, span), least, span)
        return found.select(F.col("_theme").alias(theme), F.col("_key").alias(key), F.timestamp_micros("_at").alias(time))
    order = Window.partitionBy("_theme", "_piece").orderBy("_at", "_key")
    begins = F.coalesce(F.lead("_at", least - 1).over(order) - F.col("_at") <= span, F.lit(False))
    marked = _pieces(rows, key, theme, time, span).withColumn("_begins", begins)
    found = marked.withColumn("_in", F.max("_begins").over(order.rowsBetween(1 - least, 0))).filter("_in and _mine")
    return found.select(F.col("_theme").alias(theme), F.col("_key").alias(key), F.timestamp_micros("_at").alias(time))
