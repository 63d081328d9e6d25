"""Keyed state over streams: what a daily run carries to the next, per key, with expiry."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from gleanery.config import CONFIG

#: Milliseconds of a day.
DAY_MS = 86_400_000


def blocked_stream(log: DataFrame, limit: int = CONFIG.blocked_limit) -> DataFrame:
    """source, streak, blocked after each batch of a run log (source, event_id, status): errors in a row, ended by any success.

    The state of a source is its streak; rows of a batch are taken in order of event_id.
    """

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        streak = state.get[0] if state.exists else 0
        rows = pd.concat(list(batches)).sort_values("event_id")
        for status in rows["status"]:
            streak = streak + 1 if status == "error" else 0 if status in ("ok", "produced") else streak
        state.update((streak,))
        yield pd.DataFrame({"source": [key[0]], "streak": [streak], "blocked": [streak >= limit]})

    return log.groupBy("source").applyInPandasWithState(step, "source string, streak long, blocked boolean", "streak long", "update", GroupStateTimeout.NoTimeout)


def windowed_counts(events: DataFrame, late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """Events of each type and window of event time; rows later than the watermark don't count."""
    return events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("value"))


def block_cache(blocks: DataFrame, keep_days: int = CONFIG.block_keep_days) -> DataFrame:
    """hash, first_day, day, hit for each sight of a block in a stream (hash, day): a block unseen for keep_days is forgotten.

    Days are event time: sights that come more than keep_days late don't count, and state goes once the watermark has passed its last day by keep_days.
    """

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        first, last = state.get if state.exists else (None, None)
        out = []
        for day in sorted(pd.concat(list(batches))["day"]):
            hit = last is not None and day - last <= keep_days
            first = first if hit else int(day)
            last = max(int(day), last or 0)
            out.append((key[0], first, int(day), hit))
        state.update((first, last))
        state.setTimeoutTimestamp(max((last + keep_days + 1) * DAY_MS, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame(out, columns=["hash", "first_day", "day", "hit"])

    timed = blocks.withColumn("at", F.timestamp_millis(F.col("day") * DAY_MS)).withWatermark("at", f"{keep_days} days")
    return timed.groupBy("hash").applyInPandasWithState(step, "hash string, first_day long, day long, hit boolean", "first long, last long", "append", GroupStateTimeout.EventTimeTimeout)
