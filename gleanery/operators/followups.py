"""Follow-up pages: which of the proposed addresses are read, what reading them gives, and how far links are followed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.config import CONFIG
from gleanery.functions.urls import host, url_key
from gleanery.operators.durable import release, settle


def known_same(same_page: DataFrame, today: Column, days: int = CONFIG.same_page_days) -> DataFrame:
    """(source_id, url_key) of addresses that gave the source's own page not long ago: a verdict (source_id, url_key, at) holds for so many days, none with 0."""
    return same_page.where(F.lit(days > 0) & (F.date_add("at", days) > today)).select("source_id", "url_key").distinct()


def queue(proposals: DataFrame, page_events: DataFrame, muted: DataFrame, same_page: DataFrame, today: Column, limit: int = CONFIG.followups_per_source) -> DataFrame:
    """source_id, pos, url, url_key, wanted, verdict, rank of every proposed address (source_id, pos, url).

    Addresses of muted hosts (host) go first ("muted"), then those known as the source's own page ("same-page"). Of the others, those of the source's
    events (source_id, source_url, venue, time_start) that lack a venue or an hour come before the rest, each part in the order of proposal;
    the first ``limit`` of a source are "taken" and ranked from 1, the rest is "over". Repeated addresses keep their rows: the order decides.
    """
    lacking = page_events.where("coalesce(venue, '') = '' or coalesce(time_start, '') = ''").where("coalesce(source_url, '') <> ''").select("source_id", url_key(F.col("source_url")).alias("url_key")).distinct().withColumn("wanted", F.lit(True))
    own = proposals.select("source_id", "pos", "url", url_key(F.col("url")).alias("url_key"), host(F.col("url")).alias("host"))
    told = own.join(muted.select("host").distinct().withColumn("is_muted", F.lit(True)), "host", "left").join(known_same(same_page, today).withColumn("is_same", F.lit(True)), ["source_id", "url_key"], "left").join(lacking, ["source_id", "url_key"], "left")
    dropped = F.when(F.col("is_muted"), "muted").when(F.col("is_same"), "same-page")
    told = told.select("source_id", "pos", "url", "url_key", F.coalesce("wanted", F.lit(False)).alias("wanted"), dropped.alias("dropped"))
    order = Window.partitionBy("source_id", F.col("dropped").isNull()).orderBy(F.desc("wanted"), "pos")
    ranked = told.withColumn("place", F.row_number().over(order))
    verdict = F.coalesce("dropped", F.when(F.col("place") <= limit, "taken").otherwise("over"))
    return ranked.select("source_id", "pos", "url", "url_key", "wanted", verdict.alias("verdict"), F.when(verdict == "taken", F.col("place")).alias("rank"))


def with_entrypoints(taken: DataFrame, entries: DataFrame, same_page: DataFrame, today: Column, limit: int = CONFIG.followups_per_source) -> DataFrame:
    """source_id, rank, url, url_key, via: a source's entry (source_id, url, page_url) comes before what it took (source_id, rank, url, url_key), cut at the limit again.

    An entry that is the page itself, is taken already, or is known as the same page adds nothing.
    """
    keyed = entries.select("source_id", "url", url_key(F.col("url")).alias("url_key"), url_key(F.col("page_url")).alias("page_key")).where("url_key <> page_key").drop("page_key")
    fresh = keyed.join(taken.select("source_id", "url_key"), ["source_id", "url_key"], "left_anti").join(known_same(same_page, today), ["source_id", "url_key"], "left_anti")
    first = fresh.groupBy("source_id").agg(F.min(F.struct("url_key", "url")).alias("e")).select("source_id", F.lit(0).alias("rank"), "e.url", "e.url_key", F.lit("entrypoint").alias("via"))
    both = taken.select("source_id", "rank", "url", "url_key", F.lit("proposal").alias("via")).unionByName(first)
    return both.withColumn("rank", F.row_number().over(Window.partitionBy("source_id").orderBy("rank", "url_key"))).where(F.col("rank") <= limit)


def outcomes(taken: DataFrame, captures: DataFrame, pages: DataFrame, cache: DataFrame) -> DataFrame:
    """source_id, url_key, outcome, events of every taken address (source_id, url_key).

    A capture (url_key, hash, not_modified, failed, events) is an "error" if it failed or isn't there; "unchanged" if the server said so, or if its hash is the
    cached one (url_key, hash, events): the cache's events count; "same-as-page" if its hash is that of the source's own page (source_id, page_hash), which
    gives no events; else "ok", with the capture's events. "Unchanged" without a cached entry is an "error": there is nothing to take events from.
    """
    own = taken.select("source_id", "url_key").join(captures, "url_key", "left").join(pages.select("source_id", "page_hash"), "source_id", "left")
    told = own.join(cache.select("url_key", F.col("hash").alias("cached_hash"), F.col("events").alias("cached_events")), "url_key", "left")
    cached = F.col("cached_hash").isNotNull()
    outcome = (
        F.when(F.coalesce("failed", F.lit(True)), "error")
        .when(F.col("not_modified"), F.when(cached, "unchanged").otherwise("error"))
        .when(cached & (F.col("cached_hash") == F.col("hash")), "unchanged")
        .when(F.col("hash") == F.col("page_hash"), "same-as-page")
        .otherwise("ok")
    )
    events = F.when(F.col("outcome") == "unchanged", F.col("cached_events")).when(F.col("outcome") == "ok", F.col("events"))
    return told.withColumn("outcome", outcome).select("source_id", "url_key", "hash", "outcome", F.coalesce(events, F.lit(0)).cast("long").alias("events"))


def next_cache(cache: DataFrame, told: DataFrame) -> DataFrame:
    """url_key, hash, events after a run: "ok" addresses are kept anew, "same-as-page" ones go, others stay. An address that several sources took is one entry."""
    verdict = told.groupBy("url_key").agg(F.bool_or(F.col("outcome") == "same-as-page").alias("gone"), F.max(F.when(F.col("outcome") == "ok", F.struct("hash", "events"))).alias("new"))
    both = cache.select("url_key", F.struct("hash", "events").alias("old")).join(verdict, "url_key", "full_outer").where("not coalesce(gone, false)")
    kept = both.select("url_key", F.coalesce("new", "old").alias("e")).where("e is not null")
    return kept.select("url_key", "e.hash", "e.events")


def next_same_page(same_page: DataFrame, told: DataFrame, today: Column) -> DataFrame:
    """source_id, url_key, at after a run: verdicts of today take the place of older ones."""
    fresh = told.where("outcome = 'same-as-page'").select("source_id", "url_key", today.alias("at"))
    return same_page.select("source_id", "url_key", "at").unionByName(fresh).groupBy("source_id", "url_key").agg(F.max("at").alias("at"))


def expand(seeds: DataFrame, links: DataFrame, hops: int, per_source: int = CONFIG.followups_per_source, per_run: int = CONFIG.followups_per_run) -> DataFrame:
    """source_id, hop, rank, url_key, parent: what is read when links (url_key, pos, to_key) are followed from each source's seeds (source_id, url_key).

    In a hop, addresses that the last one read lead on to those that the source hasn't visited yet. An address that several lead to comes from the one of
    smallest rank, then of smallest pos, then of smallest name. Each source takes its first ``per_source``; when all sources together would take more than is left of ``per_run``, first
    choices come before second ones, sources by name. Seeds are hop 0, and visited. Each hop is written before the next one reads it; no page is read twice for a source, so it ends
    after ``hops`` hops, when nothing is left to follow, or when the run's share is used up. Ids that are null lead nowhere.
    """
    rank = F.row_number().over(Window.partitionBy("source_id").orderBy("url_key"))
    start = seeds.where("source_id is not null and url_key is not null").select("source_id", "url_key").distinct()
    told = [settle(start.select("source_id", F.lit(0).alias("hop"), rank.alias("rank"), "url_key", F.lit(None).cast("string").alias("parent")))]
    left = per_run
    for hop in range(1, hops + 1):
        if left <= 0:
            break
        visited = told[0]
        for earlier in told[1:]:
            visited = visited.unionByName(earlier)
        last = told[-1].select("source_id", F.col("rank").alias("from_rank"), F.col("url_key").alias("parent"))
        onward = last.join(links.where("to_key is not null").select(F.col("url_key").alias("parent"), "pos", F.col("to_key").alias("url_key")), "parent")
        fresh = onward.join(visited.select("source_id", "url_key"), ["source_id", "url_key"], "left_anti")
        first = fresh.groupBy("source_id", "url_key").agg(F.min(F.struct("from_rank", "pos", "parent")).alias("by"))
        order = Window.partitionBy("source_id").orderBy("by.from_rank", "by.pos", "url_key")
        ranked = first.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= per_source)
        taken = settle(ranked.select("source_id", F.lit(hop).alias("hop"), "rank", "url_key", F.col("by.parent").alias("parent")).orderBy("rank", "source_id").limit(left))
        n = taken.count()
        if not n:
            release(taken)
            break
        told.append(taken)
        left -= n
    out = told[0]
    for taken in told[1:]:
        out = out.unionByName(taken)
    return out
