"""Queries of operators that work on a stream, over whole tables as a batch."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..streaming.bursts import bursts
from .catalog import Tables, query


def _sql(theme: str, least: int, seconds: int) -> str:
    return f"""
    WITH s AS (
        SELECT *, coalesce(epoch_us(lead(ts, {least - 1}) OVER w) - epoch_us(ts) <= {seconds}000000, false) AS begins
        FROM events WHERE {theme} IS NOT NULL AND ts IS NOT NULL WINDOW w AS (PARTITION BY {theme} ORDER BY ts, event_id)
    ), c AS (SELECT *, bool_or(begins) OVER (PARTITION BY {theme} ORDER BY ts, event_id ROWS BETWEEN {least - 1} PRECEDING AND CURRENT ROW) AS held FROM s)
    SELECT {theme}, event_id, epoch_us(ts) AS at FROM c WHERE held
    """


@query(_sql("user_id", 5, 86_400))
def user_bursts(t: Tables) -> DataFrame:
    return bursts(t.events, "event_id", "user_id", "ts", 5, 86_400).selectExpr("user_id", "event_id", "unix_micros(cast(ts AS timestamp)) AS at")


@query(_sql("event_type", 12, 3_600))
def type_bursts(t: Tables) -> DataFrame:
    """Few themes, so that each is cut into pieces of time."""
    return bursts(t.events, "event_id", "event_type", "ts", 12, 3_600).selectExpr("event_type", "event_id", "unix_micros(cast(ts AS timestamp)) AS at")
