"""The registry's verdicts on sources: a ladder of rules over what a probe found, and the state that each source carries from probe to probe."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.config import CONFIG
from gleanery.functions.urls import url_key

#: What a replacement must not answer, and the only symptom that needs no second opinion. Fixed values.
CANDIDATE_FAILED = ("dns-dead", "http-error", "placeholder")
HOPELESS = "dns-dead"
#: Ways to fetch that a plain probe can't judge. Fixed values.
NOT_PROBED = ("fb", "fb_group")


def origin(url: Column) -> Column:
    """Scheme, host and port."""
    return F.regexp_extract(url, "^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)


def rebase(template: Column, resolved: Column, probed: Column) -> Column:
    """The address to register after a probe of ``probed`` ended at ``resolved``: the template as it is, the template with the new origin where only that has changed, or what answered."""
    rest = lambda u: F.regexp_replace(F.regexp_replace(u, "^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", ""), "#.*$", "")
    whole = lambda u: F.when(rest(u) == "", "/").otherwise(rest(u))
    known = (origin(resolved) != "") & (origin(probed) != "")
    return F.when(resolved == probed, template).when(known & (whole(resolved) == whole(probed)), F.replace(template, origin(probed), origin(resolved))).otherwise(resolved)


def verdicts(probes: DataFrame) -> DataFrame:
    """The probes with outcome, new_url (null: as it was) and why.

    Columns: url, fetch; reach, answered, reached_url, reached_fetch; can_search, candidate, candidate_reach, candidate_url; verdict of the profile, dated (a feed
    with days is there), is_new, harvested. Outcomes: "skipped" where a probe says nothing; "ok"; "fixed" with another address or way; "dead"; "error", to be tried again.

    An address that answers lives; one that doesn't is replaced by a candidate that is another address and answers. Else, without a search only a dead
    domain is final; a source that gave events is never dead; all others are. A profile that finds no events kills new sources alone, and only without a feed that has days.
    """
    probed = F.replace(F.col("url"), F.lit("{page}"), F.lit("1"))
    replaced = F.col("can_search") & F.col("candidate").isNotNull() & (url_key(F.col("candidate")) != url_key(F.col("url"))) & ~F.coalesce(F.col("candidate_reach"), F.lit("http-error")).isin(*CANDIDATE_FAILED)
    moved = (F.col("reached_url") != probed) | (F.col("reached_fetch") != F.col("fetch"))
    barren = (F.col("verdict") == "none") & ~F.coalesce("dated", F.lit(False)) & F.col("is_new")
    lives = F.col("answered") | replaced
    no_search = ~F.col("can_search") & (F.col("reach") != HOPELESS)
    rules = [
        (F.col("fetch").isin(*NOT_PROBED), "skipped", "not-probed"),
        (lives & F.coalesce(barren, F.lit(False)), "dead", "no-events"),
        (F.col("answered") & F.coalesce(moved, F.lit(False)), "fixed", "moved"),
        (F.col("answered"), "ok", "answered"),
        (F.coalesce(replaced, F.lit(False)), "fixed", "replaced"),
        (no_search, "error", "no-search"),
        (F.coalesce("harvested", F.lit(0)) > 0, "error", "harvested"),
    ]
    outcome, why = F.lit("dead"), F.lit("unreachable")
    for rule, name, reason in reversed(rules):
        outcome, why = F.when(rule, name).otherwise(outcome), F.when(rule, reason).otherwise(why)
    at = F.when(F.col("answered"), rebase(F.col("url"), F.col("reached_url"), probed)).when(F.coalesce(replaced, F.lit(False)), rebase(F.col("url"), F.coalesce("candidate_url", "candidate"), F.col("url")))
    told = probes.withColumn("outcome", outcome).withColumn("why", why)
    return told.withColumn("new_url", F.when(F.col("outcome") != "skipped", F.when(at != F.col("url"), at)))


@dataclass
class Entry:
    """What is known of a source: its address and former ones, whether it is dead, failures in a row since a day, the last try, and the day it was last seen."""

    url: str | None = None
    dead: bool = False
    failures: int = 0
    since: int | None = None
    last_try: int | None = None
    seen: int | None = None
    former: list[str] = field(default_factory=list)


def step(entry: Entry, day: int, url: str, outcome: str, new_url: str | None, limit: int, recheck: int, keep: int) -> tuple[Entry, tuple]:
    """The entry after one probe, and what is told of it: (day, action, outcome, url, dead, failures, n_former).

    A source with ``limit`` failures in a row isn't tried until ``recheck`` days after the last try; a source unseen for more than ``keep`` days is a new one.
    """
    if entry.seen is not None and day - entry.seen > keep:
        entry = Entry()
    entry.seen = day
    entry.url = entry.url or url
    if entry.failures >= limit and entry.last_try is not None and day < entry.last_try + recheck:
        return entry, (day, "resting", None, entry.url, entry.dead, entry.failures, len(entry.former))
    if outcome in ("error", "dead"):
        entry.failures, entry.since, entry.last_try = entry.failures + 1, day if entry.since is None else entry.since, day
        entry.dead = entry.dead or outcome == "dead"
    elif outcome in ("ok", "fixed"):
        entry.failures, entry.since, entry.last_try, entry.dead = 0, None, None, False
    if new_url is not None and outcome in ("ok", "fixed") and new_url != entry.url:
        entry.former.append(entry.url)
        entry.url = new_url
    return entry, (day, "tried", outcome, entry.url, entry.dead, entry.failures, len(entry.former))


TOLD = "source_id string, day long, action string, outcome string, url string, dead boolean, failures long, n_former long"


def replay(judged: DataFrame, limit: int = CONFIG.blocked_limit, recheck: int = CONFIG.blocked_recheck_days, keep: int = CONFIG.registry_keep_days) -> DataFrame:
    """source_id, day, action, outcome, url, dead, failures, n_former after every probe of a log (source_id, day, url, outcome, new_url): the batch twin of streaming.registry.

    Rows of a source stream by in order of day (a number of days), then of outcome; only one source's entry is held.
    """
    columns = [c.split()[0] for c in TOLD.split(", ")]

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, entry = None, Entry()
        for batch in batches:
            out = []
            for r in batch.itertuples(index=False):
                if r.source_id != now:
                    now, entry = r.source_id, Entry()
                entry, told = step(entry, int(r.day), r.url, r.outcome, r.new_url, limit, recheck, keep)
                out.append((now, *told))
            yield pd.DataFrame(out, columns=columns)

    rows = judged.where("source_id is not null and day is not null").select("source_id", F.col("day").cast("long").alias("day"), "url", "outcome", "new_url")
    return rows.repartition("source_id").sortWithinPartitions("source_id", "day", "outcome").mapInPandas(walk, TOLD)
