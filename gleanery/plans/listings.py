"""Queries of listing shapes, pagers and ways in, over captured pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleanery.functions.urls import host
from gleanery.operators import listing
from gleanery.plans.registry import query
from gleanery.sources.tables import LINKS_SQL, links, table

_HOST = "regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), '^www\\.', '')"
#: A page's links as those of a site: each leads to an entry in one of four places, by its number, its day, its name, or as a page of a list.
ENTRIES_SQL = f"""{LINKS_SQL}, e AS (SELECT page_id AS page, {_HOST} AS host, regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS page_path, pos, pos < 5 AND page_id % 3 <> 0 AS in_nav, CASE WHEN (pos + page_id) % 7 < 3 THEN '/wydarzenia/' || (1000 + pos) WHEN (pos + page_id) % 7 < 5 THEN '/fr/kalendarz/2026-08-' || lpad(CAST(1 + pos % 28 AS VARCHAR), 2, '0') WHEN (pos + page_id) % 7 = 5 THEN '/koncert-numer-' || pos ELSE '/en/lista?page=' || pos END AS p FROM links)"""


def entries(spark, sf_dir):
    """page, page_url, url, in_nav of every link, as an entry of the page's site."""
    l = links(spark, sf_dir)
    turn, pos = (F.col("pos") + F.col("page_id")) % 7, F.col("pos")
    where = F.when(turn < 3, F.concat(F.lit("/wydarzenia/"), 1000 + pos)).when(turn < 5, F.concat(F.lit("/fr/kalendarz/2026-08-"), F.lpad((1 + pos % 28).cast("string"), 2, "0"))).when(turn == 5, F.concat(F.lit("/koncert-numer-"), pos)).otherwise(F.concat(F.lit("/en/lista?page="), pos))
    return l.select(F.col("page_id").alias("page"), F.col("url").alias("page_url"), "pos", F.concat(F.lit("https://"), host(F.col("url")), where).alias("url"), ((pos < 5) & (F.col("page_id") % 3 != 0)).alias("in_nav"))


GROUPS_SQL = f"""{ENTRIES_SQL}, u AS (SELECT page, page_path, p, bool_and(in_nav) AS in_nav FROM e GROUP BY ALL),
t AS (SELECT *, CASE WHEN starts_with(p, '/wydarzenia/') THEN '/wydarzenia/{{id}}' WHEN starts_with(p, '/fr/') THEN '/fr/kalendarz/{{date}}' WHEN starts_with(p, '/koncert') THEN '/{{slug}}' ELSE '/en/lista?page={{page}}' END AS template FROM u),
g AS (SELECT page, template, page_path, count(*) AS n_urls, avg(CASE WHEN in_nav THEN 0.0 ELSE 1.0 END) AS ratio FROM t GROUP BY ALL),
s AS (SELECT page, template, n_urls, ratio, CASE WHEN template LIKE '/en/%' THEN 0 ELSE 1 END AS slots, CASE WHEN split_part(template, '/', 2) LIKE '{{%' OR len(list_filter(string_split(page_path, '/'), lambda x: x <> '')) = 0 THEN false ELSE CASE WHEN len(list_filter(string_split(page_path, '/'), lambda x: x <> '')) = 1 OR split_part(template, '/', 3) LIKE '{{%' THEN lower(regexp_replace(split_part(page_path, '/', 2), '\\.[A-Za-z0-9]{{2,5}}$', '')) = split_part(template, '/', 2)
  ELSE lower(regexp_replace(split_part(page_path, '/', 2), '\\.[A-Za-z0-9]{{2,5}}$', '')) = split_part(template, '/', 2) AND lower(regexp_replace(split_part(page_path, '/', 3), '\\.[A-Za-z0-9]{{2,5}}$', '')) = split_part(split_part(template, '/', 3), '?', 1) END END AS near FROM g),
r AS (SELECT *, round(log2(1 + n_urls) * (0.35 + 0.65 * ratio) * CASE WHEN template = '/{{slug}}' THEN 0.55 ELSE 1.0 END * CASE WHEN template LIKE '%date%' THEN 0.4 ELSE 1.0 END * CASE WHEN near THEN {listing.SAME_SECTION} ELSE 1.0 END, 6) AS score FROM s)"""


@query(f"WITH {GROUPS_SQL} SELECT page, template, n_urls, round(ratio, 6) AS content_ratio, CAST(slots AS INTEGER) AS slots, near AS same_section, score FROM r")
def listing_groups(spark, sf_dir):
    """The shapes of every page's links, and how much each looks like its entries."""
    told = listing.groups(entries(spark, sf_dir))
    return told.select("page", "template", "n_urls", F.round("content_ratio", 6).alias("content_ratio"), "slots", "same_section", F.round("score", 6).alias("score"))


@query(f"""WITH {GROUPS_SQL}, w AS (SELECT *, row_number() OVER (PARTITION BY page ORDER BY score DESC, n_urls DESC, template) AS k, lead(score) OVER (PARTITION BY page ORDER BY score DESC, n_urls DESC, template) AS n, count(*) OVER (PARTITION BY page) - 1 AS n_rivals FROM r WHERE n_urls >= 3 AND slots >= 1)
SELECT page, template, n_urls, near AS same_section, score, n_rivals, round(score - coalesce(n, 0), 5) AS lead FROM w WHERE k = 1""")
def listing_shape(spark, sf_dir):
    """The shape of every page's entries: one winner, the rivals that it beat, and by how much."""
    won = listing.winners(listing.groups(entries(spark, sf_dir)))
    return won.select("page", "template", "n_urls", "same_section", F.round("score", 6).alias("score"), "n_rivals", F.round("lead", 5).alias("lead"))


@query("""WITH n AS (SELECT * FROM (VALUES (0, 'page'), (1, 'p'), (2, 'strona'), (3, 'pg'), (4, 'start'), (5, 'offset')) t(place, name)), u AS (SELECT page_id AS page, regexp_replace(url, '#.*$', '') AS u FROM pages), q AS (SELECT page, split_part(u, '?', 1) AS head, list_filter(string_split(CASE WHEN contains(u, '?') THEN regexp_extract(u, '\\?(.*)$', 1) ELSE '' END, '&'), lambda x: x <> '') AS kept FROM u)
SELECT page, place, head || '?' || array_to_string(CASE WHEN len(list_filter(kept, lambda x: split_part(x, '=', 1) = name)) > 0 THEN list_transform(kept, lambda x: CASE WHEN split_part(x, '=', 1) = name THEN name || '={page}' ELSE x END) ELSE list_append(kept, name || '={page}') END, '&') AS template FROM q, n""")
def page_candidates(spark, sf_dir):
    """Where each page's further ones may lie, by the parameters that sites use."""
    return listing.page_candidates(table(spark, sf_dir, "pages").select(F.col("page_id").alias("page"), F.col("url").alias("page_url")))


@query(f"""WITH {GROUPS_SQL}, w AS (SELECT page, template FROM (SELECT *, row_number() OVER (PARTITION BY page ORDER BY score DESC, n_urls DESC, template) AS k FROM r WHERE n_urls >= 3 AND slots >= 1) WHERE k = 1),
c AS (SELECT t.page AS cand, a.page AS page, t.p, t.template FROM (SELECT DISTINCT page, p, template FROM t) t JOIN (SELECT DISTINCT page FROM e) a ON a.page = t.page - 1), ce AS (SELECT DISTINCT c.page, c.cand, c.p FROM c JOIN w ON w.page = c.page AND w.template = c.template),
x AS (SELECT ce.page, ce.cand, count(*) AS n_entries, count(*) FILTER (WHERE o.p IS NULL) AS n_new FROM ce LEFT JOIN (SELECT DISTINCT page, p FROM t) o ON o.page = ce.page AND o.p = ce.p GROUP BY ALL)
SELECT a.page, a.cand AS candidate, coalesce(n_entries, 0) AS n_entries, coalesce(n_new, 0) AS n_new, CASE WHEN w.page IS NULL THEN 'no-listing' WHEN coalesce(n_entries, 0) = 0 THEN 'none' WHEN n_new < 2 THEN 'same' ELSE 'next' END AS verdict FROM (SELECT DISTINCT page, cand FROM c) a LEFT JOIN w ON w.page = a.page LEFT JOIN x ON x.page = a.page AND x.cand = a.cand""")
def pager_verdicts(spark, sf_dir):
    """Whether the page after each one is a further page of its listing, as if both were of one site."""
    e = entries(spark, sf_dir)
    local = e.withColumn("url", F.regexp_replace("url", "^https://[^/]*", "https://x.pl"))
    shapes = listing.winners(listing.groups(e))
    own = local.select("page", "url")
    later = local.select((F.col("page") - 1).alias("page"), F.col("page").alias("candidate"), "url").join(own.select("page").distinct(), "page", "left_semi")
    return listing.next_pages(own, later, shapes)


@query(f"""WITH {ENTRIES_SQL}, m AS (SELECT host AS source_id, 'https://' || host || split_part(substr(p, 2), '/', 1) AS url, count(*) AS n_entries, count(*) FILTER (WHERE contains(p, '2026')) AS n_dated, max(pos) % 4 AS hint FROM e WHERE length(host) % 3 > 0 OR pos < 2 GROUP BY 1, 2),
g AS (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY n_dated DESC, n_entries DESC, hint DESC, length(url), url) AS k FROM m WHERE n_dated > 0 OR n_entries >= 3), b AS (SELECT * FROM g WHERE k = 1),
q AS (SELECT source_id, url, (length(url) % 10) / 10.0 AS confidence FROM m), a AS (SELECT q.*, row_number() OVER (PARTITION BY source_id ORDER BY confidence DESC, length(url), url) AS k FROM q WHERE confidence >= 0.5 AND source_id NOT IN (SELECT source_id FROM b))
SELECT source_id, url, 'measured' AS via, round(CASE WHEN n_dated > 0 THEN 0.5 + 0.5 * n_dated / greatest(n_entries, n_dated) ELSE 0.5 END, 6) AS confidence FROM b UNION ALL SELECT source_id, url, 'asked', round(confidence, 6) FROM a WHERE k = 1""")
def chosen_entrypoints(spark, sf_dir):
    """Each host's way in: measured where anything measures, asked elsewhere."""
    e = entries(spark, sf_dir).withColumn("host", host(F.col("page_url"))).withColumn("p", F.regexp_replace("url", "^https://[^/]*", ""))
    e = e.where((F.length("host") % 3 > 0) | (F.col("pos") < 2))
    first = F.concat(F.lit("https://"), "host", F.split_part(F.substring("p", 2, 500), F.lit("/"), F.lit(1)))
    measured = e.groupBy(F.col("host").alias("source_id"), first.alias("url")).agg(F.count("*").alias("n_entries"), F.count_if(F.col("p").contains("2026")).alias("n_dated"), (F.max("pos") % 4).alias("hint"))
    asked = measured.select("source_id", "url", ((F.length("url") % 10) / 10.0).alias("confidence"))
    return listing.entrypoints(measured, asked).withColumn("confidence", F.round("confidence", 6))
