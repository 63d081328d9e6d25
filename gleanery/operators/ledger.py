"""Ranked budgets, caches with their verdicts, and mutes that runs carry on."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.config import CONFIG


def value_queue(rows: DataFrame, daily: float, probation: float = CONFIG.probation_share, min_runs: int = CONFIG.min_runs, ceiling: float | None = CONFIG.price_ceiling) -> DataFrame:
    """Sources in their queue: id, verdict, rank, usd_per_fetch, usd_per_novel, cumulative. Columns: id, fetched, usd_per_fetch, usd_per_novel.

    Those fetched often enough have a price (none: without end) and stand in order of it under the budget less the share for probation: one over the
    ceiling takes nothing, one that doesn't fit, or gives nothing new, is passed over. The others stand in order of how seldom they were fetched
    under that share. The walk is sequential: narrow rows of the registry stream through a task for each of the two lanes, which holds one sum.
    """
    budget = max(0.0, daily)
    apart = budget * max(0.0, probation)
    limits = {True: budget - apart, False: apart}
    price = F.coalesce("usd_per_novel", F.lit(float("inf")))
    lane = (F.col("fetched") >= min_runs).alias("measured")
    narrow = rows.select(lane, F.when(F.col("fetched") >= min_runs, price).otherwise(F.col("fetched").cast("double")).alias("place"), "id", F.col("usd_per_fetch").cast("double").alias("usd_per_fetch"))

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        spent, rank = {True: 0.0, False: 0.0}, 0
        for batch in batches:
            out = []
            for r in batch.itertuples(index=False):
                after = spent[r.measured] + r.usd_per_fetch
                if not r.measured:
                    fits = after <= limits[False]
                    verdict, place, novel = "probation" if fits else "waiting", None, None
                else:
                    rank += 1
                    place, novel = rank, None if r.place == float("inf") else r.place
                    over = ceiling is not None and r.place > ceiling
                    fits = not over and novel is not None and after <= limits[True]
                    verdict = "over-ceiling" if over else "in-budget" if fits else "over-budget"
                if fits:
                    spent[r.measured] = after
                out.append((r.id, verdict, place, r.usd_per_fetch, novel, round(spent[r.measured] if verdict == "over-ceiling" else after, 4)))
            yield pd.DataFrame(out, columns=["id", "verdict", "rank", "usd_per_fetch", "usd_per_novel", "cumulative"]).astype({"rank": "Int32"})

    sorted_lanes = narrow.repartition(2, "measured").sortWithinPartitions("measured", "place", "id")
    return sorted_lanes.mapInPandas(walk, "id string, verdict string, rank int, usd_per_fetch double, usd_per_novel double, cumulative double")


def marginal_price(queue: DataFrame) -> DataFrame:
    """The price of the last source in the budget; null if there is none."""
    return queue.where("verdict = 'in-budget'").agg(F.max_by("usd_per_novel", "rank").alias("marginal"), F.count("*").alias("n_in"))


def cache_verdict(at: Column, seen: Column, n_events: Column, last_day: Column, today: Column, empty_days: int, keep_days: int | None) -> Column:
    """Of a cached entry: 'none', 'pruned' (unseen for too long), 'past' (all its events are), 'stale' (long empty) or 'hit'."""
    out = F.when(at.isNull(), "none")
    if keep_days is not None:
        out = out.when(F.datediff(today, seen) > keep_days, "pruned")
    return out.when((n_events > 0) & (last_day < today), "past").when((n_events == 0) & (F.datediff(today, at) > empty_days), "stale").otherwise("hit")


def fold_days(log: DataFrame, key: str, order: str, columns: list[str], start: Column, step: Callable[[Column, Column], Column]) -> DataFrame:
    """key and state: the days of a key, in order, folded into one struct. A key has one row for each day."""
    days = log.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(order, *columns))).alias("days"))
    return days.select(key, F.aggregate("days", start, step).alias("state"))


def _fields(**values: Column) -> Column:
    return F.struct(*[v.alias(k) for k, v in values.items()])


def host_mutes(log: DataFrame, limit: int = CONFIG.host_limit, recheck: int = CONFIG.host_recheck_days) -> DataFrame:
    """host, runs, since, last_try, n_tried, n_skipped after a log (host, day, yielded): runs in a row without a published event.

    From the limit on a host isn't tried until so many days after its last try; a try that yields forgets it.
    """
    none = F.lit(None).cast("date")

    def step(s: Column, x: Column) -> Column:
        muted = (s["runs"] >= limit) & (x["day"] < F.date_add(s["last_try"], recheck))
        muted = F.coalesce(muted, F.lit(False))
        runs = F.when(muted, s["runs"]).when(x["yielded"], F.lit(0)).otherwise(s["runs"] + 1)
        since = F.when(muted, s["since"]).when(x["yielded"], none).otherwise(F.coalesce(s["since"], x["day"]))
        last = F.when(muted, s["last_try"]).when(x["yielded"], none).otherwise(x["day"])
        return _fields(runs=runs, since=since, last_try=last, n_tried=s["n_tried"] + F.when(muted, 0).otherwise(1), n_skipped=s["n_skipped"] + F.when(muted, 1).otherwise(0))

    start = _fields(runs=F.lit(0), since=none, last_try=none, n_tried=F.lit(0), n_skipped=F.lit(0))
    return fold_days(log, "host", "day", ["yielded"], start, step).select("host", "state.*")


def author_mutes(log: DataFrame, limit: int = CONFIG.author_limit, days: int = CONFIG.author_mute_days) -> DataFrame:
    """author, empty, until, n_read, n_skipped after a log (author, day, n_events): readings without an event in a row mute an author for some days.

    A mute that has run out gives all tries anew; any event ends a series.
    """
    none = F.lit(None).cast("date")

    def step(s: Column, x: Column) -> Column:
        muted = F.coalesce(s["until"] > x["day"], F.lit(False))
        before = F.when(s["until"].isNotNull(), F.lit(0)).otherwise(s["empty"])
        empty = F.when(x["n_events"] > 0, F.lit(0)).otherwise(before + 1)
        until = F.when(empty >= limit, F.date_add(x["day"], days)).otherwise(none)
        return _fields(empty=F.when(muted, s["empty"]).otherwise(empty), until=F.when(muted, s["until"]).otherwise(until), n_read=s["n_read"] + F.when(muted, 0).otherwise(1), n_skipped=s["n_skipped"] + F.when(muted, 1).otherwise(0))

    start = _fields(empty=F.lit(0), until=none, n_read=F.lit(0), n_skipped=F.lit(0))
    return fold_days(log, "author", "day", ["n_events"], start, step).select("author", "state.*")


def cost_mutes(log: DataFrame, days: int = CONFIG.mute_days) -> DataFrame:
    """source, since, until, n_set, n_cleared, n_lapsed after a log (source, day, verdict: 'mute', 'fetch' or else).

    A mute runs from its first verdict and isn't made longer; a fetching verdict clears it; it lapses on its last day.
    """
    none = F.lit(None).cast("date")

    def step(s: Column, x: Column) -> Column:
        lapsed = F.coalesce(x["day"] >= s["until"], F.lit(False))
        held = s["until"].isNotNull() & ~lapsed
        sets, clears = (x["verdict"] == "mute") & ~held, (x["verdict"] == "fetch") & held
        since = F.when(sets, x["day"]).when(clears | ~held, none).otherwise(s["since"])
        until = F.when(sets, F.date_add(x["day"], days)).when(clears | ~held, none).otherwise(s["until"])
        count = lambda hit: F.when(hit, 1).otherwise(0)
        return _fields(since=since, until=until, n_set=s["n_set"] + count(sets), n_cleared=s["n_cleared"] + count(clears), n_lapsed=s["n_lapsed"] + count(lapsed))

    start = _fields(since=none, until=none, n_set=F.lit(0), n_cleared=F.lit(0), n_lapsed=F.lit(0))
    return fold_days(log, "source", "day", ["verdict"], start, step).select("source", "state.*")


def remembered(log: DataFrame, key: str, days: int) -> DataFrame:
    """key, checked, n_checks, n_remembered after a log (key, day): what a check tells holds for some days, then the next sight checks again."""

    def step(s: Column, x: Column) -> Column:
        due = s["checked"].isNull() | (x["day"] >= F.date_add(s["checked"], days))
        return _fields(checked=F.when(due, x["day"]).otherwise(s["checked"]), n_checks=s["n_checks"] + F.when(due, 1).otherwise(0), n_remembered=s["n_remembered"] + F.when(due, 0).otherwise(1))

    start = _fields(checked=F.lit(None).cast("date"), n_checks=F.lit(0), n_remembered=F.lit(0))
    return fold_days(log, key, "day", [], start, step).select(key, "state.*")
