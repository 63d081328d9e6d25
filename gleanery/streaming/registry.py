"""The registry as keyed state over a stream of probes, with timers: when a resting source is due again, and when an unseen one is forgotten."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from gleanery.config import CONFIG
from gleanery.operators.registry import TOLD, Entry, step, verdicts

#: Milliseconds of a day.
DAY_MS = 86_400_000
_COLUMNS = [c.split()[0] for c in TOLD.split(", ")]


class RegistryProcessor(StatefulProcessor):
    """One source: its standing and its failures as values, its former addresses as a list, two timers in event time.

    A batch's rows are taken in order of day. Timers fire when the watermark passes them: "due" once the rest after failures is over, "forgotten" when the
    source wasn't seen for the days that entries are kept; then all its state goes.
    """

    def __init__(self, limit: int, recheck: int, keep: int):
        self.limit, self.recheck, self.keep = limit, recheck, keep

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.standing = handle.getValueState("standing", "url string, dead boolean, seen long")
        self.failing = handle.getValueState("failing", "failures long, since long, last_try long")
        self.former = handle.getListState("former", "url string")

    def _load(self) -> Entry:
        entry = Entry()
        if self.standing.exists():
            entry.url, entry.dead, entry.seen = self.standing.get()
        if self.failing.exists():
            entry.failures, entry.since, entry.last_try = self.failing.get()
        entry.former = [u for (u,) in self.former.get()] if self.former.exists() else []
        return entry

    def _save(self, entry: Entry) -> None:
        self.standing.update((entry.url, entry.dead, entry.seen))
        if entry.failures:
            self.failing.update((entry.failures, entry.since, entry.last_try))
        else:
            self.failing.clear()
        if entry.former:
            self.former.put([(u,) for u in entry.former])
        else:
            self.former.clear()

    def _forgotten_at(self, entry: Entry) -> int:
        return (entry.seen + self.keep + 1) * DAY_MS

    def _due_at(self, entry: Entry) -> int | None:
        return (entry.last_try + self.recheck) * DAY_MS if entry.failures >= self.limit and entry.last_try is not None else None

    def _set_timers(self, entry: Entry, now: int) -> None:
        for at in list(self.handle.listTimers()):
            self.handle.deleteTimer(at)
        due = self._due_at(entry)
        for at in {self._forgotten_at(entry), *([due] if due is not None and due > now else [])}:
            self.handle.registerTimer(max(at, now + 1))

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        entry, out = self._load(), []
        for r in pd.concat(list(rows)).sort_values(["day", "outcome"]).itertuples(index=False):
            entry, told = step(entry, int(r.day), r.url, r.outcome, r.new_url, self.limit, self.recheck, self.keep)
            out.append((key[0], *told))
        self._save(entry)
        self._set_timers(entry, timerValues.getCurrentWatermarkInMs())
        yield pd.DataFrame(out, columns=_COLUMNS)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        entry, at = self._load(), expiredTimerInfo.getExpiryTimeInMs()
        if entry.seen is None:
            return
        gone = at >= self._forgotten_at(entry)
        if gone:
            for state in (self.standing, self.failing, self.former):
                state.clear()
        yield pd.DataFrame([(key[0], at // DAY_MS, "forgotten" if gone else "due", None, entry.url, entry.dead, entry.failures, len(entry.former))], columns=_COLUMNS)


def registry_stream(probes: DataFrame, limit: int = CONFIG.blocked_limit, recheck: int = CONFIG.blocked_recheck_days, keep: int = CONFIG.registry_keep_days, late: str = "1 day") -> DataFrame:
    """What operators.registry.replay tells, from a stream of probes (source_id, day as a number of days, and the columns of verdicts), with rows of timers besides.

    The session needs the RocksDB state store. Probes later than the watermark by ``late`` don't count.
    """
    judged = verdicts(probes).where("source_id is not null and day is not null").select("source_id", F.col("day").cast("long").alias("day"), "url", "outcome", "new_url")
    timed = judged.withColumn("at", F.timestamp_millis(F.col("day") * DAY_MS)).withWatermark("at", late)
    return timed.groupBy("source_id").transformWithStateInPandas(statefulProcessor=RegistryProcessor(limit, recheck, keep), outputStructType=TOLD, outputMode="Append", timeMode="EventTime")
