"""Sources: matching, registering, ranking links, following up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.config import CONFIG


def match_hit(proposals: DataFrame, hits: DataFrame) -> DataFrame:
    """proposal_id, hit_id, tier: the hit of a proposal, by equal key, else by one key beginning the other, else by host; then the earliest.

    Columns: proposal_id, key, host; hit_id, hit_pos, hit_key, hit_host. A host's proposals and hits make no pairs: the earliest hit of each host, key and beginning of a key is
    found first, and proposals, and the beginnings of their keys, look these up.
    """
    p = proposals.where("host is not null").select("proposal_id", "host", "key")
    first = F.min(F.struct("hit_pos", "hit_id")).alias("h")
    by_key = hits.where("hit_host is not null").groupBy(F.col("hit_host").alias("host"), F.col("hit_key").alias("key")).agg(first)
    least = lambda rows, *by: rows.groupBy(*by).agg(F.min("h").alias("h"))
    found = lambda rows, tier: rows.select("proposal_id", F.struct(F.lit(tier).alias("tier"), "h.hit_pos", "h.hit_id").alias("b"))
    starts = lambda rows: rows.where("key is not null").withColumn("key", F.explode(F.transform(F.sequence(F.lit(0), F.length("key")), lambda n: F.substring("key", F.lit(1), n))))
    known = p.select("host", "key").distinct()
    met = found(p.join(by_key, ["host", "key"]), 0)
    met = met.unionByName(found(starts(p).join(by_key, ["host", "key"]), 1))
    met = met.unionByName(found(p.join(least(starts(by_key).join(known, ["host", "key"], "left_semi"), "host", "key"), ["host", "key"]), 1))
    met = met.unionByName(found(p.join(least(by_key, "host"), "host"), 2))
    best = met.groupBy("proposal_id").agg(F.min("b").alias("b"))
    return best.select("proposal_id", F.col("b.hit_id").alias("hit_id"), F.col("b.tier").alias("tier"))


def best_peer(pages: DataFrame, peers: DataFrame, rare: DataFrame, config=CONFIG) -> DataFrame:
    """page_id, peer_id, score: the peer in a page's town whose word stems agree most; rare stems weigh more. Ties to the smaller peer.

    Columns: page_id, town, stem; peer_id, town, stem; town, stem of rare stems. Rows meet on town and stem. Pages of the same stems find the same peer, and of peers
    of the same stems the smallest is found: classes of them make pairs, not they themselves.
    """

    def classes(rows: DataFrame, own: str) -> tuple[DataFrame, DataFrame]:
        told = rows.where("town is not null and stem is not null").groupBy(own).agg(F.array_sort(F.collect_list(F.struct("town", "stem"))).alias("told")).withColumn("h", F.xxhash64("told"))
        first = told.groupBy("h", "told").agg(F.min(own).alias("_first"))
        return told.withColumnRenamed(own, "_own").join(first, ["h", "told"]).select(F.col("_own"), F.col("_first")), first.select(F.col("_first").alias(own), F.inline("told"))

    (members, pages), (_, peers) = classes(pages, "page_id"), classes(peers, "peer_id")
    shared = pages.join(peers, ["town", "stem"]).join(rare.withColumn("rare", F.lit(True)), ["town", "stem"], "left")
    score = F.sum(F.when(F.col("rare"), config.rare_weight).otherwise(config.common_weight))
    scored = shared.groupBy("page_id", "peer_id").agg(score.alias("score"))
    best = scored.groupBy("page_id").agg(F.max_by("peer_id", F.struct("score", -F.col("peer_id"))).alias("peer_id"), F.max("score").alias("score"))
    return members.join(best, F.col("_first") == F.col("page_id")).select(F.col("_own").alias("page_id"), "peer_id", "score")


def unique_ids(rows: DataFrame, base: str, order: str) -> DataFrame:
    """Rows with id: the base, and for later rows of a base the base with -2, -3 and so on."""
    n = F.row_number().over(Window.partitionBy(base).orderBy(order))
    return rows.withColumn("id", F.when(n == 1, F.col(base)).otherwise(F.concat(F.col(base), F.lit("-"), n.cast("string"))))


def reconcile(sources: DataFrame, seen: DataFrame, harvest: DataFrame, limit: int = CONFIG.miss_limit) -> DataFrame:
    """Sources with missed and inactive: not seen again so often, and without any harvest. Columns: id, missed."""
    joined = sources.join(seen.select("id").distinct().withColumn("_seen", F.lit(True)), "id", "left").join(harvest, "id", "left")
    missed = F.when(F.col("_seen"), 0).otherwise(F.col("missed") + 1)
    return joined.select("id", missed.alias("missed"), (~F.coalesce("_seen", F.lit(False)) & (missed >= limit) & (F.coalesce("events", F.lit(0)) == 0)).alias("inactive"))


def drop_umbrellas(events: DataFrame, suspect: Column, least: int = CONFIG.container_children) -> DataFrame:
    """Drops suspects under whose address enough other events stand. Columns: url_key."""
    children = F.count_if(~F.col("_s")).over(Window.partitionBy("url_key"))
    marked = events.withColumn("_s", suspect).withColumn("_n", children)
    return marked.where(~(F.col("_s") & (F.col("_n") >= least))).drop("_s", "_n")


def ground(proposed: DataFrame, inventory: DataFrame) -> DataFrame:
    """page, key, how: addresses that a model proposed, tied to those on the page: by key, else by a file name that one address alone has; others of the
    page's own host go, foreign ones stay. First of a key stays. Columns: page, pos, key, host, file, page_host; page, inv_key, inv_file."""
    by_key = inventory.select("page", F.col("inv_key").alias("key")).distinct().withColumn("_exact", F.lit(True))
    by_file = inventory.groupBy("page", F.col("inv_file").alias("file")).agg(F.count_distinct("inv_key").alias("_n"), F.min("inv_key").alias("_snap"))
    joined = proposed.join(by_key, ["page", "key"], "left").join(by_file, ["page", "file"], "left")
    how = F.when(F.col("_exact"), "exact").when((F.col("_n") == 1) & (F.col("file") != ""), "file").when(F.col("host") != F.col("page_host"), "foreign")
    settled = joined.withColumn("how", how).where(F.col("how").isNotNull()).withColumn("key", F.when(F.col("how") == "file", F.col("_snap")).otherwise(F.col("key")))
    first = settled.groupBy("page", "key").agg(F.min(F.struct("pos", "how")).alias("f"))
    return first.select("page", "key", F.col("f.how").alias("how"), F.col("f.pos").alias("pos"))


#: Words that speak for a page of events and against it. Fixed values.
GOOD_WORDS = "wydarzen|kalendar|imprez|koncert|aktualno|program|repertuar|events?"
BAD_WORDS = "polityka|prywatno|rodo|cookie|regulamin|kontakt|bip|deklaracj|login"


def link_hint(text: Column, url: Column, in_nav: Column, depth: Column) -> Column:
    """How likely a link leads to a list of events: 3 by its text, 2 by its address, 1 in the menu, less below, 0 for what surely doesn't."""
    t, u = F.lower(text), F.lower(url)
    score = F.when(t.rlike(GOOD_WORDS), 3).otherwise(0) + F.when(u.rlike(GOOD_WORDS), 2).otherwise(0) + F.when(in_nav, 1).otherwise(0) - F.when(depth > 2, 1).otherwise(0)
    return F.when(t.rlike(BAD_WORDS) | u.rlike(BAD_WORDS), 0).otherwise(F.greatest(F.lit(0), score))


def capped_takes(rows: DataFrame, group: str, order: str, per_group: int, in_all: int) -> DataFrame:
    """group, n, taken: how many rows of each group, in order of groups, are taken under a cap for each and one for all.

    Each group takes one at least, so the cap for all is spent after as many groups: these, found by partitions, are all that the ordered window holds.
    """
    counts = rows.groupBy(group).agg(F.count("*").alias("n"), F.min(order).alias("first"))
    w = Window.orderBy("first", group).rowsBetween(Window.unboundedPreceding, -1)
    early = counts.orderBy("first", group).limit(in_all).withColumn("may", F.least("n", F.lit(per_group))).withColumn("before", F.coalesce(F.sum("may").over(w), F.lit(0)))
    taken = early.select(F.col(group).alias("_g"), F.greatest(F.lit(0), F.least(F.col("may"), F.lit(in_all) - F.col("before"))).alias("taken"))
    return counts.join(taken, F.col(group) == F.col("_g"), "left").select(group, "n", F.coalesce("taken", F.lit(0)).alias("taken"))


def geocode_ladder(queries: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """id, place, rung: the first rung of a place's queries that the gazetteer knows. Columns: id, rung, q; q, place."""
    hit = queries.join(gazetteer, "q")
    return hit.groupBy("id").agg(F.min_by("place", F.struct("rung", "place")).alias("place"), F.min("rung").alias("rung"))


def capped_trail(steps: DataFrame, source: str, order: str, cap: int = 200) -> DataFrame:
    """A source's first steps up to the cap, with truncated: how many more there were."""
    n = F.row_number().over(Window.partitionBy(source).orderBy(order))
    total = F.count("*").over(Window.partitionBy(source))
    return steps.withColumn("n", n).withColumn("truncated", F.greatest(F.lit(0), total - cap)).where(F.col("n") <= cap)


def weighted_reuse(rows: DataFrame, group: str) -> DataFrame:
    """Char-weighted mean of reuse and ceiling. Columns: chars, reuse, ceiling."""
    mean = lambda c: F.sum(F.col(c) * F.col("chars")) / F.sum("chars")
    return rows.groupBy(group).agg(F.sum("chars").alias("chars"), mean("reuse").alias("reuse"), mean("ceiling").alias("ceiling"))
