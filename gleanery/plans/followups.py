"""Queries of follow-up pages over captured pages and their links."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleanery.config import CONFIG
from gleanery.functions.urls import host
from gleanery.operators import followups
from gleanery.plans.registry import query
from gleanery.sources.tables import LINKS_SQL, links, table

TODAY = "2026-08-20"
_HOST_SQL = "regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), '^www\\.', '')"

#: A link leads to the page whose number its place and its length give; a page's key is its number, a source is a host, and its seed the first page of the host.
SITE_SQL = f"""{LINKS_SQL}, n AS (SELECT max(page_id) + 1 AS n FROM pages), lk AS (SELECT 'p' || page_id AS url_key, pos, 'p' || ((page_id * 7 + pos * 13 + length(href)) % n) AS to_key FROM links, n),
hp AS (SELECT page_id, {_HOST_SQL} AS host, html FROM pages), seeds AS (SELECT host AS source_id, 'p' || min(page_id) AS url_key FROM hp GROUP BY host)"""


def site(spark, sf_dir):
    """Links between pages by key, and the seed of every source."""
    pages = table(spark, sf_dir, "pages")
    n = pages.agg((F.max("page_id") + 1).alias("n"))
    key = lambda c: F.concat(F.lit("p"), c.cast("string"))
    to = (F.col("page_id") * 7 + F.col("pos") * 13 + F.length("href")) % F.col("n")
    found = links(spark, sf_dir).crossJoin(F.broadcast(n)).select(key(F.col("page_id")).alias("url_key"), "pos", key(to).alias("to_key"))  # n is one row
    seeds = pages.groupBy(host(F.col("url")).alias("source_id")).agg(key(F.min("page_id")).alias("url_key"))
    return found, seeds


_PER_SOURCE, _PER_RUN = CONFIG.followups_per_source, CONFIG.followups_per_run


def _hop_sql(h: int) -> str:
    before = " UNION ALL ".join(f"SELECT source_id, url_key FROM h{k}" for k in range(h))
    used = " + ".join(["0", *[f"(SELECT count(*) FROM h{k})" for k in range(1, h)]])
    return f"""h{h} AS MATERIALIZED (SELECT source_id, {h} AS hop, rank, url_key, parent FROM (SELECT *, row_number() OVER (ORDER BY rank, source_id) AS g FROM (SELECT source_id, url_key, b.p AS parent, row_number() OVER (PARTITION BY source_id ORDER BY b.r, b.k, url_key) AS rank FROM
(SELECT h.source_id, l.to_key AS url_key, min({{'r': h.rank, 'k': l.pos, 'p': h.url_key}}) AS b FROM h{h - 1} h JOIN lk l ON l.url_key = h.url_key WHERE NOT EXISTS (SELECT 1 FROM ({before}) v WHERE v.source_id = h.source_id AND v.url_key = l.to_key) GROUP BY ALL)) WHERE rank <= {_PER_SOURCE}) WHERE g <= {_PER_RUN} - ({used}))"""


FRONTIER_SQL = f"""{SITE_SQL}, h0 AS MATERIALIZED (SELECT source_id, 0 AS hop, row_number() OVER (PARTITION BY source_id ORDER BY url_key) AS rank, url_key, CAST(NULL AS VARCHAR) AS parent FROM seeds), {_hop_sql(1)}, {_hop_sql(2)},
frontier AS (SELECT * FROM h0 UNION ALL SELECT * FROM h1 UNION ALL SELECT * FROM h2)"""


@query(f"WITH {FRONTIER_SQL} SELECT source_id, hop, CAST(rank AS INTEGER) AS rank, url_key, parent FROM frontier")
def followup_frontier(spark, sf_dir):
    """Two hops over links from each host's first page, with caps by source and by run."""
    found, seeds = site(spark, sf_dir)
    return followups.expand(seeds, found, 2)


#: What reading gives: the first sign of the page's digest as its hash, every ninth page unreachable, every fifth unchanged by its server; two thirds are cached.
CAPTURES_SQL = "cap AS (SELECT 'p' || page_id AS url_key, substr(md5(html), 1, 1) AS hash, page_id % 5 = 0 AS not_modified, page_id % 9 = 4 AS failed, length(html) % 6 AS events FROM pages), cache AS (SELECT 'p' || page_id AS url_key, CASE WHEN page_id % 2 = 0 THEN substr(md5(html), 1, 1) ELSE 'old' END AS hash, page_id % 4 AS events FROM pages WHERE page_id % 3 <> 0)"


@query(f"""WITH {FRONTIER_SQL}, {CAPTURES_SQL}, own AS (SELECT s.source_id, c.hash AS page_hash FROM seeds s JOIN cap c USING (url_key)),
t AS (SELECT f.source_id, f.url_key, c.*, o.page_hash, k.hash AS ch, k.events AS ce FROM frontier f JOIN cap c ON c.url_key = f.url_key LEFT JOIN own o ON o.source_id = f.source_id LEFT JOIN cache k ON k.url_key = f.url_key WHERE hop > 0),
v AS (SELECT *, CASE WHEN failed THEN 'error' WHEN not_modified THEN CASE WHEN ch IS NULL THEN 'error' ELSE 'unchanged' END WHEN ch = hash THEN 'unchanged' WHEN hash = page_hash THEN 'same-as-page' ELSE 'ok' END AS outcome FROM t)
SELECT source_id, url_key, outcome, CAST(CASE outcome WHEN 'unchanged' THEN ce WHEN 'ok' THEN events ELSE 0 END AS BIGINT) AS events FROM v""")
def followup_outcomes(spark, sf_dir):
    """What each followed page gave: unchanged, the source's own page again, read anew, or an error."""
    found, seeds = site(spark, sf_dir)
    pages = table(spark, sf_dir, "pages")
    key, short = F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("url_key"), F.substring(F.md5("html"), 1, 1)
    captures = pages.select(key, short.alias("hash"), (F.col("page_id") % 5 == 0).alias("not_modified"), (F.col("page_id") % 9 == 4).alias("failed"), (F.length("html") % 6).alias("events"))
    cache = pages.where("page_id % 3 <> 0").select(key, F.when(F.col("page_id") % 2 == 0, short).otherwise("old").alias("hash"), (F.col("page_id") % 4).alias("events"))
    own = seeds.join(captures, "url_key").select("source_id", F.col("hash").alias("page_hash"))
    taken = followups.expand(seeds, found, 2).where("hop > 0")
    return followups.outcomes(taken, captures, own, cache).select("source_id", "url_key", "outcome", "events")


@query(f"""WITH {LINKS_SQL}, h AS (SELECT page_id, {_HOST_SQL} AS host FROM pages), p AS (SELECT l.page_id AS source_id, l.pos, h.host || '/' || lower(ltrim(rtrim(l.href, '/'), '/')) AS k, h.host FROM links l JOIN h USING (page_id) WHERE starts_with(l.href, '/') AND regexp_full_match(l.href, '[A-Za-z0-9/]+')),
w AS (SELECT *, length(k) % 3 = 0 AS wanted, CASE WHEN length(host) % 7 = 0 THEN 'muted' WHEN length(k) % 5 = 0 AND DATE '2026-08-01' + CAST(pos AS INTEGER) + {CONFIG.same_page_days} > DATE '{TODAY}' THEN 'same-page' END AS dropped FROM p),
r AS (SELECT *, row_number() OVER (PARTITION BY source_id, dropped IS NULL ORDER BY wanted DESC, pos) AS place FROM w)
SELECT source_id, pos, k AS url_key, wanted, coalesce(dropped, CASE WHEN place <= {_PER_SOURCE} THEN 'taken' ELSE 'over' END) AS verdict, CASE WHEN dropped IS NULL AND place <= {_PER_SOURCE} THEN CAST(place AS INTEGER) END AS rank FROM r""")
def followup_verdicts(spark, sf_dir):
    """The queue of every page's own links: muted hosts and the page itself again are left out, addresses of records that lack something come first."""
    own = links(spark, sf_dir).where(F.col("href").rlike("^/[A-Za-z0-9/]*$")).withColumn("host", host(F.col("url")))
    proposals = own.select(F.col("page_id").alias("source_id"), "pos", F.concat(F.lit("https://"), "host", "href").alias("url"))
    keyed = own.select(F.col("page_id").alias("source_id"), "pos", "host", F.concat("host", F.lit("/"), F.lower(F.trim("href", F.lit("/")))).alias("k"), F.concat(F.lit("https://"), "host", "href").alias("url"))
    events = keyed.where(F.length("k") % 3 == 0).select("source_id", F.col("url").alias("source_url"), F.lit("").alias("venue"), F.lit("18:00").alias("time_start"))
    muted = keyed.where(F.length("host") % 7 == 0).select("host").distinct()
    same = keyed.where(F.length("k") % 5 == 0).select("source_id", F.col("k").alias("url_key"), F.date_add(F.lit("2026-08-01").cast("date"), F.col("pos").cast("int")).alias("at"))
    latest = same.groupBy("source_id", "url_key").agg(F.max("at").alias("at"))
    return followups.queue(proposals, events, muted, latest, F.lit(TODAY).cast("date")).select("source_id", "pos", "url_key", "wanted", "verdict", "rank")


@query(f"""WITH {FRONTIER_SQL}, t AS (SELECT source_id, rank, url_key FROM h1), e AS (SELECT source_id, 'p' || (CAST(substr(url_key, 2) AS BIGINT) // 2) AS url_key, url_key AS page_key FROM seeds), k AS (SELECT source_id, url_key FROM e WHERE length(source_id) % 4 = 0),
f AS (SELECT source_id, 0 AS rank, url_key, 'entrypoint' AS via FROM e WHERE url_key <> page_key AND NOT EXISTS (SELECT 1 FROM t WHERE t.source_id = e.source_id AND t.url_key = e.url_key) AND NOT EXISTS (SELECT 1 FROM k WHERE k.source_id = e.source_id)),
u AS (SELECT source_id, rank, url_key, 'proposal' AS via FROM t UNION ALL SELECT * FROM f), r AS (SELECT source_id, url_key, via, row_number() OVER (PARTITION BY source_id ORDER BY rank, url_key) AS rank FROM u)
SELECT source_id, CAST(rank AS INTEGER) AS rank, url_key, via FROM r WHERE rank <= {_PER_SOURCE}""")
def attached_entrypoints(spark, sf_dir):
    """Each host's way in before what its first page proposes, unless it is that page, is proposed anyway, or is known to be the page again."""
    found, seeds = site(spark, sf_dir)
    taken = followups.expand(seeds, found, 1).where("hop = 1").select("source_id", "rank", F.col("url_key").alias("url"), "url_key")
    half = F.concat(F.lit("p"), F.expr("cast(substring(url_key, 2) as bigint) div 2").cast("string"))
    entries = seeds.select("source_id", half.alias("url"), F.col("url_key").alias("page_url"))
    same = entries.where(F.length("source_id") % 4 == 0).select("source_id", F.col("url").alias("url_key"), F.lit("2026-08-19").cast("date").alias("at"))
    return followups.with_entrypoints(taken, entries, same, F.lit(TODAY).cast("date")).select("source_id", "rank", "url_key", "via")
