"""Bursts of a theme: batch against brute force, and the stream against the batch in any order of arrival."""

import random
from datetime import datetime, timedelta

import pytest

from lodestone.streaming.bursts import bursts

START = datetime(2024, 5, 1)
SCHEMA = "id long, theme string, at timestamp, _key string"


def events(rng, n, themes="abc", days=20):
    rows = [(i, rng.choice(themes), START + timedelta(minutes=rng.randrange(days * 1440)), "clash") for i in range(n)]
    return rows + [(None, "a", START, "x"), (n, None, START, "x"), (n + 1, "a", None, "x"), rows[0], rows[0]]


def brute(rows, least, span):
    """A row stands for itself if an interval that begins at some row of its theme holds it and enough others."""
    out = []
    for i, theme, at, _ in rows:
        if theme is None or at is None:
            continue
        own = [t for _, x, t, _ in rows if x == theme and t is not None]
        if any(s <= at <= s + span and sum(s <= t <= s + span for t in own) >= least for s in own):
            out.append((theme, i, at))
    return sorted(out, key=str)


def plain(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize(("least", "hours"), [(1, 1), (2, 3), (5, 24), (9, 48), (500, 24)])
def test_batch_is_brute_force(spark, least, hours):
    rows = events(random.Random(least), 150)
    got = bursts(spark.createDataFrame(rows, SCHEMA), "id", "theme", "at", least, hours * 3600)
    assert got.columns == ["theme", "id", "at"]
    assert plain(got) == brute(rows, least, timedelta(hours=hours))


def test_no_rows(spark):
    assert bursts(spark.createDataFrame([], SCHEMA), "id", "theme", "at").collect() == []


def streamed(spark, folder, batches, least, hours, late):
    for i, batch in enumerate(batches):
        spark.createDataFrame(batch, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        rows = spark.readStream.schema(SCHEMA).parquet(f"{folder}/in")
        found = bursts(rows, "id", "theme", "at", least, hours * 3600, late)
        run = found.writeStream.format("parquet").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start(f"{folder}/out")
        run.awaitTermination()
        held = run.lastProgress["stateOperators"][0]["numRowsTotal"] if i else 0
    return plain(spark.read.parquet(f"{folder}/out")), held


def test_stream_is_the_batch_in_any_order(spark, tmp_path):
    """Each batch is a run of its own, so all state comes back from the checkpoint."""
    rng = random.Random(3)
    rows = events(rng, 120)
    want = brute(rows, 4, timedelta(hours=24))
    rng.shuffle(rows)
    got, _ = streamed(spark, tmp_path, [rows[:50], rows[50:70], rows[70:]], 4, 24, "60 days")
    assert 0 < len(want) < len(rows) and got == want


def test_state_leaves_with_time(spark, tmp_path):
    rng = random.Random(5)
    rows = sorted((r for r in events(rng, 120) if r[1] and r[2]), key=lambda r: r[2])
    got, held = streamed(spark, tmp_path, [rows[:40], rows[40:80], rows[80:]], 4, 6, "1 hour")
    assert got == brute(rows, 4, timedelta(hours=6))
    pieces = {(r[1], int(r[2].timestamp()) // 21600 + s) for r in rows for s in (-1, 0, 1)}
    assert held < len(pieces) / 10
