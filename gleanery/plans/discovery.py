"""Queries over sources and their pages: matching, registering, following up, parsing."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from gleanery.config import CONFIG
from gleanery.functions import geo, parsing, text, urls
from gleanery.operators import blocks, budget, cards, discovery, filters, yields
from gleanery.plans.registry import query
from gleanery.sources.tables import CATALOG_SQL, DUMPS_SQL, LINKS_SQL, POSTS_SQL, RUNS_SQL, catalog, dumps, links, posts, runs, table

PAGE_SQL = """pg AS (SELECT page_id, url, regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), '^www\\.', '') AS host, lower(regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/+$', '')) AS path FROM pages)"""


def pages(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", "url", urls.host(F.col("url")).alias("host"), F.lower(urls.path(F.col("url"))).alias("path"))


@query(f"""WITH {PAGE_SQL}, p AS (SELECT page_id AS proposal_id, host || path AS key, host FROM pg WHERE page_id % 2 = 0), h AS (SELECT page_id AS hit_id, host || path AS hit_key, host FROM pg WHERE page_id % 2 = 1),
m AS (SELECT proposal_id, hit_id, CASE WHEN key = hit_key THEN 0 WHEN starts_with(key, hit_key) OR starts_with(hit_key, key) THEN 1 ELSE 2 END AS tier FROM p JOIN h ON p.host = h.host)
SELECT proposal_id, hit_id, CAST(tier AS INTEGER) AS tier FROM (SELECT *, row_number() OVER (PARTITION BY proposal_id ORDER BY tier, hit_id) AS r FROM m) WHERE r = 1""")
def match_hit(spark, sf_dir):
    """Proposed pages and the search hits they come from."""
    p = pages(spark, sf_dir).withColumn("key", F.concat("host", "path"))
    a = p.where("page_id % 2 = 0").select(F.col("page_id").alias("proposal_id"), "key", "host")
    b = p.where("page_id % 2 = 1").select(F.col("page_id").alias("hit_id"), F.col("page_id").alias("hit_pos"), F.col("key").alias("hit_key"), F.col("host").alias("hit_host"))
    return discovery.match_hit(a, b)


@query(f"""WITH {CATALOG_SQL}, w AS (SELECT DISTINCT source_id, town, substr(x, 1, 5) AS stem FROM (SELECT source_id, town, unnest(string_split(replace(lower(title), '#', ''), ' ')) AS x FROM catalog) WHERE length(x) >= 3),
a AS (SELECT CAST(substr(source_id, 2) AS BIGINT) AS id, town, stem FROM w), f AS (SELECT town, stem, count(*) AS n FROM a GROUP BY ALL), s AS (SELECT p.id AS page_id, q.id AS peer_id, sum(CASE WHEN f.n <= 2 THEN 3 ELSE 1 END) AS score FROM a p JOIN a q ON p.town = q.town AND p.stem = q.stem JOIN f ON f.town = p.town AND f.stem = p.stem WHERE p.id % 2 = 0 AND q.id % 2 = 1 GROUP BY ALL)
SELECT page_id, peer_id, CAST(score AS BIGINT) AS score FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY score DESC, peer_id) AS r FROM s) WHERE r = 1""")
def peer_stems(spark, sf_dir):
    """Each page's best peer of its town, by word stems."""
    t = catalog(spark, sf_dir).select(F.substring("source_id", 2, 20).cast("long").alias("id"), "town", text.stems(F.replace(F.col("title"), F.lit("#"), F.lit(""))).alias("stems")).distinct()
    stems = t.select("id", "town", F.explode("stems").alias("stem")).distinct()
    rare = stems.groupBy("town", "stem").agg(F.count("*").alias("n")).where("n <= 2").select("town", "stem")
    return discovery.best_peer(stems.where("id % 2 = 0").withColumnRenamed("id", "page_id"), stems.where("id % 2 = 1").withColumnRenamed("id", "peer_id"), rare)


@query(f"WITH {PAGE_SQL} SELECT page_id, CASE WHEN r = 1 THEN host ELSE host || '-' || r END AS id FROM (SELECT page_id, host, row_number() OVER (PARTITION BY host ORDER BY page_id) AS r FROM pg)")
def unique_source_ids(spark, sf_dir):
    return discovery.unique_ids(pages(spark, sf_dir), "host", "page_id").select("page_id", "id")


@query(f"""WITH {RUNS_SQL}, s AS (SELECT DISTINCT source, CAST(substr(source, 2) AS BIGINT) % 3 AS missed FROM runs), e AS (SELECT source, count(*) FILTER (WHERE status = 'produced' AND day < DATE '2024-01-05') AS ev FROM runs GROUP BY source), n AS (SELECT DISTINCT source FROM runs WHERE day = DATE '2024-01-30' AND status = 'ok'),
j AS (SELECT s.source, n.source IS NOT NULL AS seen, CASE WHEN n.source IS NOT NULL THEN 0 ELSE missed + 1 END AS missed, coalesce(ev, 0) AS ev FROM s LEFT JOIN n USING (source) LEFT JOIN e USING (source))
SELECT source, CAST(missed AS BIGINT) AS missed, NOT seen AND missed >= 2 AND ev = 0 AS inactive FROM j""")
def reconcile(spark, sf_dir):
    """Sources not seen any more, and which fall asleep for it."""
    r = runs(spark, sf_dir)
    own = r.select(F.col("source").alias("id"), (F.substring("source", 2, 20).cast("long") % 3).alias("missed")).distinct()
    seen = r.where((F.col("day") == F.lit("2024-01-30").cast("date")) & (F.col("status") == "ok")).select(F.col("source").alias("id"))
    harvest = r.where(F.col("day") < F.lit("2024-01-05").cast("date")).groupBy(F.col("source").alias("id")).agg(F.count_if(F.col("status") == "produced").alias("events"))
    return discovery.reconcile(own, seen, harvest).select(F.col("id").alias("source"), F.col("missed").cast("long").alias("missed"), "inactive")


@query(f"""WITH {CATALOG_SQL}, s AS (SELECT pos, venue || '|' || town AS url_key, coalesce(date_end - date_start + 1 >= 40, false) AS suspect FROM catalog), n AS (SELECT *, count(*) FILTER (WHERE NOT suspect) OVER (PARTITION BY url_key) AS c FROM s)
SELECT url_key, count(*) AS n, count(*) FILTER (WHERE suspect) AS n_suspect FROM n WHERE NOT (suspect AND c >= 500) GROUP BY url_key""")
def umbrella_drop(spark, sf_dir):
    """Long frames go where enough single events stand under their address."""
    e = catalog(spark, sf_dir).withColumn("url_key", F.concat_ws("|", "venue", "town"))
    suspect = filters.container_suspect(F.col("date_start"), F.col("date_end"), None, None, None, 40)
    kept = discovery.drop_umbrellas(e, suspect, 500)
    return kept.groupBy("url_key").agg(F.count("*").alias("n"), F.count_if(suspect).alias("n_suspect"))


@query(f"""WITH {CATALOG_SQL}, s AS (SELECT venue, date_start, max(date_end - date_start + 1) AS days, min(pos) AS p FROM catalog WHERE date_end - date_start + 1 >= 8 GROUP BY ALL), f AS (SELECT venue, arg_min(date_start, p) AS date_start, arg_min(days, p) AS days, min(p) AS p FROM s GROUP BY venue)
SELECT venue, CAST(days AS INTEGER) AS days, CAST(row_number() OVER (ORDER BY extract(month FROM date_start) NULLS FIRST, days DESC, venue) AS INTEGER) AS place FROM f QUALIFY place <= 30""")
def plan_probes(spark, sf_dir):
    """The first suspect of each address; those longest unprobed first, then the longest; thirty at most."""
    c = catalog(spark, sf_dir).withColumn("days", F.datediff("date_end", "date_start") + 1).where("days >= 8")
    s = c.groupBy("venue", "date_start").agg(F.max("days").alias("days"), F.min("pos").alias("p"))
    first = s.groupBy("venue").agg(F.min_by(F.struct("date_start", "days"), "p").alias("f")).select("venue", "f.*")
    order = [F.month("date_start"), F.desc("days"), F.col("venue")]
    # the first thirty are found by partitions; only they are numbered
    return first.orderBy(*order).limit(30).withColumn("place", F.row_number().over(Window.orderBy(*order))).select("venue", "days", "place")


@query(f"""WITH {LINKS_SQL}, l AS (SELECT page_id, href, CAST(min(pos) AS INTEGER) AS pos FROM links GROUP BY ALL), o AS (SELECT *, lag(page_id) OVER (PARTITION BY href ORDER BY page_id) AS earlier FROM l)
SELECT page_id, count(*) AS n, count(*) FILTER (WHERE earlier IS NULL) AS n_new, count(*) FILTER (WHERE earlier IS NULL) >= 2 AS is_next FROM o GROUP BY page_id""")
def next_page(spark, sf_dir):
    """Whether a page has enough links that no page before it has."""
    l = links(spark, sf_dir).groupBy("page_id", "href").agg(F.min("pos").alias("pos"))
    first = l.join(l.groupBy("href").agg(F.min("page_id").alias("first")), "href")
    new = F.count_if(F.col("page_id") == F.col("first"))
    return first.groupBy("page_id").agg(F.count("*").alias("n"), new.alias("n_new"), (new >= 2).alias("is_next"))


@query(f"""WITH {LINKS_SQL}, i AS (SELECT DISTINCT page_id AS page, href AS k, regexp_extract(href, '([^/]*)$', 1) AS f FROM links), pr AS (SELECT page_id AS page, pos, CASE pos % 3 WHEN 0 THEN href WHEN 1 THEN '/old' || href ELSE '/none/' || pos END AS k, CASE WHEN pos % 4 = 3 THEN 'other' ELSE 'own' END AS host FROM links),
x AS (SELECT pr.*, regexp_extract(k, '([^/]*)$', 1) AS f FROM pr), c AS (SELECT page, f, count(DISTINCT k) AS n, min(k) AS snap FROM i GROUP BY ALL),
j AS (SELECT x.page, x.pos, x.host, x.k, c.snap, CASE WHEN e.k IS NOT NULL THEN 'exact' WHEN c.n = 1 AND x.f <> '' THEN 'file' WHEN x.host <> 'own' THEN 'foreign' END AS how FROM x LEFT JOIN (SELECT DISTINCT page, k FROM i) e ON e.page = x.page AND e.k = x.k LEFT JOIN c ON c.page = x.page AND c.f = x.f),
s AS (SELECT page, CASE WHEN how = 'file' THEN snap ELSE k END AS key, pos, how FROM j WHERE how IS NOT NULL)
SELECT page, key, how, pos FROM (SELECT *, row_number() OVER (PARTITION BY page, key ORDER BY pos, how) AS r FROM s) WHERE r = 1""")
def ground_followups(spark, sf_dir):
    """Proposed addresses tied to those that the page really has."""
    l = links(spark, sf_dir)
    file = lambda c: F.regexp_extract(c, "([^/]*)$", 1)
    inv = l.select(F.col("page_id").alias("page"), F.col("href").alias("inv_key"), file("href").alias("inv_file")).distinct()
    key = F.when(F.col("pos") % 3 == 0, F.col("href")).when(F.col("pos") % 3 == 1, F.concat(F.lit("/old"), F.col("href"))).otherwise(F.concat(F.lit("/none/"), F.col("pos").cast("string")))
    proposed = l.select(F.col("page_id").alias("page"), "pos", key.alias("key"), F.when(F.col("pos") % 4 == 3, "other").otherwise("own").alias("host"), F.lit("own").alias("page_host")).withColumn("file", file("key"))
    return discovery.ground(proposed, inv).select("page", "key", "how", "pos")


@query(f"""WITH {LINKS_SQL}, s AS (SELECT href, greatest(0, CASE WHEN regexp_matches(lower(href), 'wydarzen|kalendar|imprez|koncert|aktualno|program|repertuar|events?') THEN 5 ELSE 0 END + CASE WHEN pos < 5 THEN 1 ELSE 0 END - CASE WHEN len(string_split(href, '/')) - 1 > 2 THEN 1 ELSE 0 END) * CASE WHEN regexp_matches(lower(href), 'polityka|prywatno|rodo|cookie|regulamin|kontakt|bip|deklaracj|login') THEN 0 ELSE 1 END AS hint FROM links)
SELECT href, CAST(max(hint) AS INTEGER) AS hint FROM s GROUP BY href""")
def rank_links(spark, sf_dir):
    """The best hint of every address that pages link to."""
    depth = F.size(F.split("href", "/")) - 1
    hint = discovery.link_hint(F.col("href"), F.col("href"), F.col("pos") < 5, depth)
    return links(spark, sf_dir).select("href", hint.alias("hint")).groupBy("href").agg(F.max("hint").cast("int").alias("hint"))


@query(f"""WITH {POSTS_SQL}, c AS (SELECT conv_id, count(*) AS n FROM posts GROUP BY conv_id), o AS (SELECT *, coalesce(sum(least(n, 3)) OVER (ORDER BY conv_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM c) SELECT conv_id, n, CAST(greatest(0, least(least(n, 3), 40 - b)) AS BIGINT) AS taken FROM o""")
def capped_takes(spark, sf_dir):
    """Three of each group, forty in all, in order."""
    p = posts(spark, sf_dir).withColumn("o", F.col("conv_id"))
    return discovery.capped_takes(p, "conv_id", "o", 3, 40).select("conv_id", "n", F.col("taken").cast("long").alias("taken"))


@query("""WITH g AS (SELECT n_name AS q, n_nationkey AS place FROM nation), s AS (SELECT s_suppkey AS id, s_name, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey), q AS (SELECT id, 0 AS rung, s_name || ', ' || n_name AS q FROM s UNION ALL SELECT id, 1, CASE WHEN id % 3 = 0 THEN 'nowhere' ELSE n_name END FROM s UNION ALL SELECT id, 2, lower(n_name) FROM s UNION ALL SELECT id, 3, n_name FROM s)
SELECT id, CAST(arg_min(place, rung) AS INTEGER) AS place, CAST(min(rung) AS INTEGER) AS rung FROM q JOIN g USING (q) GROUP BY id""")
def geocode_ladder(spark, sf_dir):
    """The first form of a place's name that the gazetteer knows."""
    n = table(spark, sf_dir, "nation")
    s = table(spark, sf_dir, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey"))
    forms = F.array(F.concat_ws(", ", "s_name", "n_name"), F.when(F.col("s_suppkey") % 3 == 0, "nowhere").otherwise(F.col("n_name")), F.lower("n_name"), F.col("n_name"))
    q = s.select(F.col("s_suppkey").alias("id"), F.posexplode(forms).alias("rung", "q"))
    return discovery.geocode_ladder(q, n.select(F.col("n_name").alias("q"), F.col("n_nationkey").alias("place")))


@query("""WITH p AS (SELECT s_suppkey, n_name, 50.0 + (s_suppkey * 37 % 500) / 100.0 AS lat, 15.0 + (s_suppkey * 53 % 400) / 100.0 AS lon FROM supplier JOIN nation ON s_nationkey = n_nationkey), d AS (SELECT *, sqrt(pow((lat - 52.4) * 111.32, 2) + pow((lon - 16.9) * 111.32 * cos(radians(lat)), 2)) AS km FROM p) SELECT n_name, count(*) AS n, round(min(km), 6) AS nearest FROM d WHERE km <= 120 GROUP BY n_name""")
def towns_in_radius(spark, sf_dir):
    """Places within a distance of the centre."""
    s = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    lat, lon = F.lit(50.0) + (F.col("s_suppkey") * 37 % 500) / 100.0, F.lit(15.0) + (F.col("s_suppkey") * 53 % 400) / 100.0
    km = geo.distance_to_bounds(lat, lon, F.lit(52.4), F.lit(16.9), F.lit(52.4), F.lit(16.9))
    return s.select("n_name", km.alias("km")).where("km <= 120").groupBy("n_name").agg(F.count("*").alias("n"), F.round(F.min("km"), 6).alias("nearest"))


@query(f"""WITH {RUNS_SQL}, n AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY event_id) AS n, count(*) OVER (PARTITION BY source) AS t FROM runs) SELECT source, status, count(*) AS n, max(greatest(0, t - 50)) AS truncated FROM n WHERE n <= 50 GROUP BY ALL""")
def audit_trail(spark, sf_dir):
    """A source's first fifty steps by status, and how many more there were."""
    t = discovery.capped_trail(runs(spark, sf_dir), "source", "event_id", 50)
    return t.groupBy("source", "status").agg(F.count("*").alias("n"), F.max("truncated").alias("truncated"))


@query(f"""WITH {DUMPS_SQL}, s AS (SELECT source, length(text) AS chars, (doc_id % 10) / 10.0 AS reuse, least(1.0, (doc_id % 10) / 10.0 + 0.2) AS ceiling FROM dumps) SELECT source, CAST(sum(chars) AS BIGINT) AS chars, round(sum(reuse * chars) / sum(chars), 6) AS reuse, round(sum(ceiling * chars) / sum(chars), 6) AS ceiling FROM s GROUP BY source""")
def reuse_weighted(spark, sf_dir):
    reuse = (F.col("doc_id") % 10) / 10.0
    s = dumps(spark, sf_dir).select("source", F.length("text").alias("chars"), reuse.alias("reuse"), F.least(F.lit(1.0), reuse + 0.2).alias("ceiling"))
    return discovery.weighted_reuse(s, "source").select("source", "chars", F.round("reuse", 6).alias("reuse"), F.round("ceiling", 6).alias("ceiling"))


@query(f"""WITH {POSTS_SQL}, a AS (SELECT conv_id, role, count(*) AS n FROM posts GROUP BY ALL) SELECT conv_id, count(*) AS n_authors, max(n) AS most, count(*) FILTER (WHERE n > 1) AS n_repeat FROM a GROUP BY conv_id""")
def post_extras(spark, sf_dir):
    """Authors of a group and how much the busiest wrote."""
    a = posts(spark, sf_dir).groupBy("conv_id", "role").agg(F.count("*").alias("n"))
    return a.groupBy("conv_id").agg(F.count("*").alias("n_authors"), F.max("n").alias("most"), F.count_if(F.col("n") > 1).alias("n_repeat"))


@query(f"""WITH {POSTS_SQL}, e AS (SELECT conv_id, turn, role, length(text) % 4 = 0 AS has_image FROM posts WHERE turn % 2 = 0), o AS (SELECT conv_id, turn FROM posts WHERE turn % 3 = 0)
SELECT has_image, count(*) AS n_events, count(o.turn) AS n_linked, count(*) - count(o.turn) AS n_unlinked, count(DISTINCT CASE WHEN o.turn IS NOT NULL THEN e.conv_id END) AS n_groups FROM e LEFT JOIN o ON e.conv_id = o.conv_id AND e.turn = o.turn GROUP BY has_image""")
def poster_yield(spark, sf_dir):
    """Events that lead back to a post and those that don't, with and without a picture."""
    p = posts(spark, sf_dir)
    e = p.where("turn % 2 = 0").select("conv_id", "turn", (F.length("text") % 4 == 0).alias("has_image"))
    o = p.where("turn % 3 = 0").select("conv_id", "turn", F.lit(True).alias("hit"))
    j = e.join(o, ["conv_id", "turn"], "left")
    return j.groupBy("has_image").agg(F.count("*").alias("n_events"), F.count("hit").alias("n_linked"), (F.count("*") - F.count("hit")).alias("n_unlinked"), F.count_distinct(F.when(F.col("hit"), F.col("conv_id"))).alias("n_groups"))


@query(f"""WITH {RUNS_SQL}, s AS (SELECT source, day, event_id, k FROM runs WHERE k IS NOT NULL), b AS (SELECT DISTINCT source, k FROM s WHERE day < DATE '2024-01-20'), n AS (SELECT s.*, row_number() OVER (PARTITION BY source, k ORDER BY day, event_id) AS r FROM s WHERE day >= DATE '2024-01-20')
SELECT n.source, count(*) AS n, count(*) FILTER (WHERE b.k IS NULL AND r = 1) AS n_fresh FROM n LEFT JOIN b ON n.source = b.source AND n.k = b.k GROUP BY n.source""")
def block_reuse(spark, sf_dir):
    """Blocks that no earlier run has seen, each once."""
    s = runs(spark, sf_dir).where("k is not null").select("source", F.concat_ws(":", "source", F.col("k").cast("string")).alias("hash"), F.col("day").alias("page"), F.col("event_id").alias("pos"))
    cut = F.lit("2024-01-20").cast("date")
    marked = blocks.reuse_against(s.where(F.col("page") >= cut), s.where(F.col("page") < cut))
    return marked.groupBy("source").agg(F.count("*").alias("n"), F.count_if("fresh").alias("n_fresh"))


@query(f"""WITH {CATALOG_SQL}, c AS (SELECT source_id, round(avg(price) / 1000, 4) AS p FROM catalog GROUP BY source_id), o AS (SELECT *, row_number() OVER (ORDER BY p, source_id) AS rank FROM c) SELECT max(p) FILTER (WHERE rank <= 5) AS marginal, count(*) FILTER (WHERE rank > 5) AS n_over FROM o""")
def marginal_price(spark, sf_dir):
    """The price of the last source in the budget of five."""
    c = catalog(spark, sf_dir).groupBy("source_id").agg(F.round(F.avg("price") / 1000, 4).alias("p"))
    top = c.orderBy("p", "source_id").limit(5)
    return top.agg(F.max("p").alias("marginal"), F.count("*").alias("k")).join(F.broadcast(c.agg(F.count("*").alias("n")))).select("marginal", (F.col("n") - F.col("k")).alias("n_over"))


@query(f"""WITH {RUNS_SQL}, d AS (SELECT source, day, event_id, cost, sum(CASE WHEN status = 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY source, day ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS fatal, row_number() OVER (PARTITION BY source, day ORDER BY event_id) AS n FROM runs)
SELECT source, count(*) AS n, count(*) FILTER (WHERE coalesce(fatal, 0) = 0 AND n <= 2) AS n_sent FROM d GROUP BY source""")
def search_budget(spark, sf_dir):
    """Searches that a day's cap of two and a stop after the first failure let through."""
    w = Window.partitionBy("source", "day").orderBy("event_id")
    r = runs(spark, sf_dir).withColumn("n", F.row_number().over(w)).withColumn("fatal", F.coalesce(F.sum((F.col("status") == "error").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return r.groupBy("source").agg(F.count("*").alias("n"), F.count_if((F.col("fatal") == 0) & (F.col("n") <= 2)).alias("n_sent"))


@query("""SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE CASE event_id % 2 WHEN 0 THEN 'x' ELSE 'y' END END IS NULL AS no_title, list_filter([CASE WHEN event_id % 3 = 0 THEN 'title' END, CASE WHEN value IS NULL OR value < 10 THEN 'value' END, CASE WHEN event_type NOT IN ('click', 'view', 'purchase') THEN 'type' END], lambda x: x IS NOT NULL)[1] AS first_reason FROM events""")
def validated(spark, sf_dir):
    """Records with the rules they break."""
    e = table(spark, sf_dir, "events").withColumn("title", F.when(F.col("event_id") % 3 != 0, "x"))
    out = parsing.validated(e, {"title": F.col("title").isNotNull(), "value": F.col("value") >= 10, "type": F.col("event_type").isin("click", "view", "purchase")})
    return out.select("event_id", F.col("title").isNull().alias("no_title"), F.get("reasons", F.lit(0)).alias("first_reason"))


@query("""SELECT event_id, CAST(ts AS DATE) AS day, CASE WHEN event_id % 4 = 0 THEN NULL ELSE strftime(ts, '%H:%M') END AS time FROM events""")
def clock_parts(spark, sf_dir):
    """Moments told in several ways, to a day and a time."""
    ts = F.col("ts").cast("timestamp")
    told = F.when(F.col("event_id") % 4 == 0, F.date_format(ts, "yyyy-MM-dd")).when(F.col("event_id") % 4 == 1, F.date_format(ts, "yyyy-MM-dd HH:mm:ss")).when(F.col("event_id") % 4 == 2, F.unix_timestamp(ts).cast("string")).otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm"))
    return table(spark, sf_dir, "events").select("event_id", parsing.clock_parts(told).alias("p")).select("event_id", "p.day", "p.time")


@query()
def dom_cards(spark, sf_dir):
    """How many cards each page has, and how long they are."""
    p = table(spark, sf_dir, "pages")
    found = cards.cards(p, "page_id", "html").groupBy(F.col("page").alias("page_id")).agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"))
    return p.select("page_id").join(found, "page_id", "left").select("page_id", F.coalesce("n", F.lit(0)).alias("n_cards"), F.coalesce("chars", F.lit(0)).alias("chars"))


@query()
def salvaged_objects(spark, sf_dir):
    """Complete objects of arrays cut somewhere: the users' events as JSON, cut at nine tenths."""
    e = table(spark, sf_dir, "events")
    arrays = e.groupBy("user_id").agg(F.to_json(F.array_sort(F.collect_list(F.struct("event_id", "event_type", "props")))).alias("j"))
    cut = arrays.select("user_id", F.expr("substring(j, 1, cast(length(j) * 0.9 as int))").alias("j"))
    return cut.select("user_id", F.size(parsing.salvaged(F.col("j"))).alias("n_objects"), parsing.parse_verdict(F.col("j")).alias("verdict"))


_HINTS = (r"[0-9]{4}-[0-9]{2}-[0-9]{2}", rf"{filters._LEFT}[0-9]{{1,2}}\s*[./-]\s*[0-9]{{1,2}}(?:$|[^A-Za-z0-9_])", rf"(?i){filters._LEFT}[0-9]{{1,2}}\s*(?:{filters.MONTH_WORDS})", rf"(?i){filters._LEFT}(?:{filters.WEEKDAY_WORDS})", rf"(?i){filters._LEFT}(?:{filters.NEAR_WORDS})")
HINT_SQL = "(" + " OR ".join(f"regexp_matches(regexp_replace({{0}}, 'https?://\\S+', ' ', 'g'), '{p}')" for p in (x.replace("{", "{{").replace("}", "}}") for x in _HINTS)) + ")"


@query(f"WITH {POSTS_SQL} SELECT conv_id, turn, {HINT_SQL.format('text')} AS own, coalesce({HINT_SQL.format('original')}, false) AS before FROM posts")
def date_evidence(spark, sf_dir):
    """Turns that tell a day, and turns that stand because the one before them does."""
    p = posts(spark, sf_dir)
    return p.select("conv_id", "turn", filters.has_date_hint(F.col("text")).alias("own"), F.coalesce(filters.has_date_hint(F.col("original")), F.lit(False)).alias("before"))


@query(f"WITH {RUNS_SQL}, a AS (SELECT source, status, round(sum(cost), 4) AS c FROM runs WHERE day < DATE '2024-01-16' GROUP BY ALL), b AS (SELECT source, status, round(sum(cost), 4) AS c FROM runs WHERE day >= DATE '2024-01-16' GROUP BY ALL) SELECT a.source, a.status, a.c AS then_cost, b.c AS now_cost FROM a JOIN b ON a.source = b.source AND a.status = b.status WHERE abs(a.c - b.c) > 50")
def drift(spark, sf_dir):
    """Values that moved between two halves of the month."""
    cut = F.lit("2024-01-16").cast("date")
    half = lambda cond, name: runs(spark, sf_dir).where(cond).groupBy("source", "status").agg(F.round(F.sum("cost"), 4).alias(name))
    a, b = half(F.col("day") < cut, "then_cost"), half(F.col("day") >= cut, "now_cost")
    return a.join(b, ["source", "status"]).where(F.abs(F.col("then_cost") - F.col("now_cost")) > 50)


@query(f"""WITH {CATALOG_SQL}, h AS (SELECT DISTINCT venue, town FROM catalog), r AS (SELECT DISTINCT venue FROM catalog WHERE p_size % 9 = 0 AND quantity > 45) SELECT town, count(*) AS n_foreign FROM h WHERE venue NOT IN (SELECT venue FROM r) GROUP BY town""")
def foreign_hosts(spark, sf_dir):
    """Hosts that the registry does not have."""
    c = catalog(spark, sf_dir)
    known = c.where("p_size % 9 = 0 and quantity > 45").select("venue").distinct()
    return c.select("venue", "town").distinct().join(known, "venue", "left_anti").groupBy("town").agg(F.count("*").alias("n_foreign"))


@query(f"""WITH {CATALOG_SQL}, l AS (SELECT town, list(CAST(length(title) + length(venue) + 4 AS BIGINT) ORDER BY pos) AS sizes FROM catalog WHERE date_start = DATE '1997-05-01' GROUP BY town)
SELECT town, CAST(len(sizes) AS INTEGER) AS n, CAST(list_reduce(sizes, lambda a, x: CASE WHEN a.s > 0 AND a.s + x.s > {CONFIG.digest_chars} THEN {{'s': x.s, 'c': a.c + 1}} ELSE {{'s': a.s + x.s, 'c': a.c}} END, {{'s': 0::BIGINT, 'c': 0}}).c + 1 AS INTEGER) AS n_messages FROM (SELECT town, sizes AS raw, list_transform(sizes, lambda z: {{'s': z, 'c': 0}}) AS sizes FROM l)""")
def chunked_digest(spark, sf_dir):
    """The lines of a digest in messages of bounded length, for each town."""
    lines = catalog(spark, sf_dir).where(F.col("date_start") == F.lit("1997-05-01").cast("date")).select("town", "pos", (F.length("title") + F.length("venue") + 4).cast("long").alias("size"))
    arrays = lines.groupBy("town").agg(F.array_sort(F.collect_list(F.struct("pos", "size"))).alias("items"))
    chunks = budget.greedy_chunks(F.transform("items", lambda x: x["size"]), CONFIG.digest_chars)
    return arrays.select("town", F.size("items").alias("n"), (F.array_max(chunks) + 1).alias("n_messages"))
