"""Connected components of links, by stars: rounds of joins and minima, each written."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.operators.durable import release, settle


def _signature(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(links: DataFrame) -> DataFrame:
    """id, component (the smallest id reachable) of every id that a link (a, b) names; null ends and loops tie nothing.

    Two steps take turns until links no longer change: every id hangs its larger neighbours on the smallest id it sees, then itself and its smaller
    neighbours. What is left are stars around the smallest id of each component. No step gathers a neighbourhood: minima are aggregated by id and
    joined back, so an id with many links is dealt out like a skewed join. Rounds grow with the logarithm of the ids. An id whose only link is to a smaller one
    is left out of them, and follows it in the end.
    """
    ends = settle(links.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = ends.select("a").unionByName(ends.select(F.col("b").alias("a"))).groupBy("a").agg(F.count("*").alias("links"))
    dealt = settle(ends.join(seen, "a"))
    release(ends)
    single = dealt.where("links = 1").select(F.col("a").alias("leaf"), F.col("b").alias("on"))
    now = settle(dealt.where("links > 1").select("a", "b"))
    before = _signature(now)
    while before[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        wide = large.where("a <> b").distinct()
        down = wide.groupBy("a").agg(F.min("b").alias("m"))
        small = wide.join(down, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(down.select("a", F.col("m").alias("b")))
        after = settle(small.where("a <> b").distinct())
        release(now)
        now, told = after, _signature(after)
        if told == before:
            break
        before = told
    star = settle(now.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()))
    release(now)
    hung = single.join(star.withColumnRenamed("id", "on"), "on", "left").select(F.col("leaf").alias("id"), F.coalesce("component", "on").alias("component"))
    alone = single.select(F.col("on").alias("id")).distinct().join(star, "id", "left_anti").select("id", F.col("id").alias("component"))
    return star.unionByName(alone).unionByName(hung)
