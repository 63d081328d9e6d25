"""Queries over budgets in full, caches and mutes with their rules, costs, and small set and lookup operators."""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import Window
from pyspark.sql import functions as F

from gleanery.config import CONFIG
from gleanery.functions import dates as D
from gleanery.functions import parsing, small, text, urls
from gleanery.operators import ledger
from gleanery.plans.registry import query
from gleanery.sources.tables import CATALOG_SQL, DUMPS_SQL, LINKS_SQL, RUNS_SQL, catalog, dumps, links, runs, table

#: Task of a run by its status, and the costs' categories.
TASKS = {"ok": "llm-page", "produced": "llm-poster", "unchanged": "fetch", "empty": "fetch", "error": "search"}
TASK_SQL = "CASE status " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in TASKS.items()) + " END"
#: A source's fetches, price of one, and price of something new, of the run log; the daily budget and the ceiling follow from them. Prices are whole ten-thousandths, halves up, counted in
#: decimals and integers: quotients and sums of doubles fall on either side of a half by chance.
PRICED_SQL = f"""{RUNS_SQL}, per AS (SELECT source AS id, count(DISTINCT day) AS fetched, CAST(round(sum(CAST(cost AS DECIMAL(18, 6))), 2) * 100 AS BIGINT) AS cents, count(DISTINCT key) FILTER (WHERE status = 'produced') AS novel FROM runs GROUP BY source),
units AS (SELECT id, fetched, (cents * 200 + fetched) // (fetched * 2) AS per_fetch, CASE WHEN novel > 0 THEN (cents * 200 + novel) // (novel * 2) END AS per_novel FROM per),
priced AS (SELECT id, fetched, per_fetch, per_fetch / 10000 AS usd_per_fetch, per_novel / 10000 AS usd_per_novel FROM units)"""
NEED, SHARE_OF_ALL, CEILING = 12, 0.3, 200.0


def _priced(spark, sf_dir):
    spent = F.round(F.sum(F.col("cost").cast("decimal(18,6)")), 2)
    per = runs(spark, sf_dir).groupBy(F.col("source").alias("id")).agg(F.count_distinct("day").alias("fetched"), (spent * 100).cast("long").alias("cents"), F.count_distinct(F.when(F.col("status") == "produced", F.col("key"))).alias("novel"))
    units = per.select("id", "fetched", F.expr("(cents * 200 + fetched) div (fetched * 2)").alias("per_fetch"), F.expr("CASE WHEN novel > 0 THEN (cents * 200 + novel) div (novel * 2) END").alias("per_novel"))
    return units.select("id", "fetched", "per_fetch", (F.col("per_fetch") / 10000).alias("usd_per_fetch"), (F.col("per_novel") / 10000).alias("usd_per_novel"))


def _queue(spark, sf_dir):
    priced = _priced(spark, sf_dir)
    units = priced.agg(F.sum("per_fetch")).first()[0] or 0
    daily = (units * Decimal(str(SHARE_OF_ALL)) / 10000).quantize(Decimal("0.01"), ROUND_HALF_UP)
    return ledger.value_queue(priced, float(daily), CONFIG.probation_share, NEED, CEILING)


QUEUE_SQL = f"""WITH RECURSIVE {PRICED_SQL}, b AS (SELECT CAST(round(CAST(sum(per_fetch) AS DECIMAL(24, 0)) * {SHARE_OF_ALL} * 0.0001, 2) AS DOUBLE) AS daily FROM priced),
o AS (SELECT *, fetched >= {NEED} AS m, row_number() OVER (PARTITION BY fetched >= {NEED} ORDER BY CASE WHEN fetched >= {NEED} THEN coalesce(usd_per_novel, 'Infinity'::DOUBLE) ELSE fetched END, id) AS k FROM priced),
lim AS (SELECT m, CASE WHEN m THEN daily - daily * {CONFIG.probation_share} ELSE daily * {CONFIG.probation_share} END AS most FROM b, (VALUES (true), (false)) t(m)),
walk AS (SELECT m, CAST(0 AS BIGINT) AS k, CAST(0 AS DOUBLE) AS s, CAST(0 AS DOUBLE) AS shown, '' AS verdict FROM lim UNION ALL
  SELECT o.m, o.k, CASE WHEN (NOT o.m OR (o.usd_per_novel IS NOT NULL AND o.usd_per_novel <= {CEILING})) AND walk.s + o.usd_per_fetch <= lim.most THEN walk.s + o.usd_per_fetch ELSE walk.s END,
    CASE WHEN o.m AND coalesce(o.usd_per_novel, 'Infinity'::DOUBLE) > {CEILING} THEN walk.s ELSE walk.s + o.usd_per_fetch END,
    CASE WHEN NOT o.m THEN CASE WHEN walk.s + o.usd_per_fetch <= lim.most THEN 'probation' ELSE 'waiting' END WHEN coalesce(o.usd_per_novel, 'Infinity'::DOUBLE) > {CEILING} THEN 'over-ceiling' WHEN walk.s + o.usd_per_fetch <= lim.most THEN 'in-budget' ELSE 'over-budget' END
  FROM walk JOIN o ON o.m = walk.m AND o.k = walk.k + 1 JOIN lim ON lim.m = o.m),
queue AS (SELECT o.id, walk.verdict, CAST(CASE WHEN o.m THEN o.k END AS INTEGER) AS rank, o.usd_per_fetch, CASE WHEN o.m THEN o.usd_per_novel END AS usd_per_novel, round(walk.shown, 4) AS cumulative FROM o JOIN walk ON o.m = walk.m AND o.k = walk.k)"""


@query(f"{QUEUE_SQL} SELECT * FROM queue")
def value_queue(spark, sf_dir):
    """Sources in the two lanes of the budget, with their verdicts and what the walk has spent."""
    return _queue(spark, sf_dir)


@query(f"""{QUEUE_SQL} SELECT verdict, count(*) AS n, CAST(round(sum(CAST(usd_per_fetch AS DECIMAL(18, 4))), 2) AS DOUBLE) AS usd, (SELECT arg_max(usd_per_novel, rank) FROM queue WHERE verdict = 'in-budget') AS marginal FROM queue GROUP BY verdict""")
def queue_summary(spark, sf_dir):
    """How many sources got each verdict, what a day of them costs, and the price at the budget's line."""
    q = _queue(spark, sf_dir)
    sums = q.groupBy("verdict").agg(F.count("*").alias("n"), F.round(F.sum(F.col("usd_per_fetch").cast("decimal(18,4)")), 2).cast("double").alias("usd"))
    return sums.join(F.broadcast(ledger.marginal_price(q).select("marginal")))  # one row


TODAY = "1997-06-01"


@query(f"""WITH e AS (SELECT o_orderkey, o_orderdate AS stored, (SELECT max(l_shipdate) FROM lineitem l WHERE l.l_orderkey = o.o_orderkey) AS seen, count(l_orderkey) AS n, max(l_shipdate) AS last FROM orders o LEFT JOIN (SELECT * FROM lineitem WHERE l_returnflag = 'R') r ON o.o_orderkey = r.l_orderkey GROUP BY ALL),
v AS (SELECT *, CAST(stored AS DATE) AS a, CAST(coalesce(seen, stored) AS DATE) AS s, CAST(last AS DATE) AS l, DATE '{TODAY}' AS t FROM e)
SELECT o_orderkey, CASE WHEN t - s > {CONFIG.block_keep_days} THEN 'pruned' WHEN n > 0 AND l < t THEN 'past' WHEN n = 0 AND t - a > {CONFIG.block_empty_days} THEN 'stale' ELSE 'hit' END AS block,
  CASE WHEN n > 0 AND l < t THEN 'past' WHEN n = 0 AND t - a > 7 THEN 'stale' ELSE 'hit' END AS event_page, CASE WHEN n > 0 AND l < t THEN 'past' WHEN n = 0 AND t - a > 30 THEN 'stale' ELSE 'hit' END AS poster FROM v""")
def cache_verdicts(spark, sf_dir):
    """What three caches say of an entry on a day: blocks, pages of events, posters. An order is an entry, its returned items are its events."""
    items = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("seen"), F.count_if(F.col("l_returnflag") == "R").alias("n"), F.max(F.when(F.col("l_returnflag") == "R", F.col("l_shipdate"))).alias("last"))
    e = table(spark, sf_dir, "orders").join(items, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    at, seen, n = F.col("o_orderdate").cast("date"), F.coalesce("seen", "o_orderdate").cast("date"), F.coalesce("n", F.lit(0))
    verdict = lambda empty, keep: ledger.cache_verdict(at, seen, n, F.col("last").cast("date"), F.lit(TODAY).cast("date"), empty, keep)
    return e.select("o_orderkey", verdict(CONFIG.block_empty_days, CONFIG.block_keep_days).alias("block"), verdict(CONFIG.event_page_days, None).alias("event_page"), verdict(CONFIG.poster_empty_days, None).alias("poster"))


@query(f"""WITH {DUMPS_SQL}, p AS (SELECT source, md5(text) AS h, lag(md5(text)) OVER (PARTITION BY source ORDER BY doc_id) AS before FROM dumps) SELECT source, count(*) AS n, count(*) FILTER (WHERE h = before) AS n_hits, count(*) FILTER (WHERE before IS NULL) AS n_first FROM p GROUP BY source""")
def page_cache(spark, sf_dir):
    """How often a source's page is what it was the time before, so that nothing is extracted anew."""
    p = dumps(spark, sf_dir).select("source", "doc_id", F.md5("text").alias("h")).withColumn("before", F.lag("h").over(Window.partitionBy("source").orderBy("doc_id")))
    return p.groupBy("source").agg(F.count("*").alias("n"), F.count_if(F.coalesce(F.col("h") == F.col("before"), F.lit(False))).alias("n_hits"), F.count_if(F.col("before").isNull()).alias("n_first"))


@query(f"""WITH {RUNS_SQL}, d AS (SELECT source AS host, day, bool_or(status = 'produced') AS yielded FROM runs GROUP BY ALL),
f AS (SELECT host, list_reduce(list({{'day': day, 'yielded': yielded}} ORDER BY day), lambda s, x: CASE WHEN s.runs >= {CONFIG.host_limit} AND x.day < s.last_try + {CONFIG.host_recheck_days} THEN {{'runs': s.runs, 'since': s.since, 'last_try': s.last_try, 'n_tried': s.n_tried, 'n_skipped': s.n_skipped + 1}}
  WHEN x.yielded THEN {{'runs': 0, 'since': NULL::DATE, 'last_try': NULL::DATE, 'n_tried': s.n_tried + 1, 'n_skipped': s.n_skipped}} ELSE {{'runs': s.runs + 1, 'since': coalesce(s.since, x.day), 'last_try': x.day, 'n_tried': s.n_tried + 1, 'n_skipped': s.n_skipped}} END,
  {{'runs': 0, 'since': NULL::DATE, 'last_try': NULL::DATE, 'n_tried': 0, 'n_skipped': 0}}) AS s FROM d GROUP BY host) SELECT host, s.runs AS runs, s.since AS since, s.last_try AS last_try, s.n_tried AS n_tried, s.n_skipped AS n_skipped FROM f""")
def host_mutes(spark, sf_dir):
    """Hosts that gave nothing run after run, and how often each was tried and passed over."""
    log = runs(spark, sf_dir).groupBy(F.col("source").alias("host"), "day").agg(F.bool_or(F.col("status") == "produced").alias("yielded"))
    return ledger.host_mutes(log)


@query(f"""WITH {RUNS_SQL}, d AS (SELECT source AS author, day, count(*) FILTER (WHERE status = 'produced') AS n_events FROM runs GROUP BY ALL),
f AS (SELECT author, list_reduce(list({{'day': day, 'n': n_events}} ORDER BY day), lambda s, x: CASE WHEN s.until > x.day THEN {{'empty': s.empty, 'until': s.until, 'n_read': s.n_read, 'n_skipped': s.n_skipped + 1}}
  WHEN x.n > 0 THEN {{'empty': 0, 'until': NULL::DATE, 'n_read': s.n_read + 1, 'n_skipped': s.n_skipped}} ELSE {{'empty': CASE WHEN s.until IS NULL THEN s.empty + 1 ELSE 1 END,
    'until': CASE WHEN (CASE WHEN s.until IS NULL THEN s.empty + 1 ELSE 1 END) >= {CONFIG.author_limit} THEN x.day + {CONFIG.author_mute_days} END, 'n_read': s.n_read + 1, 'n_skipped': s.n_skipped}} END,
  {{'empty': 0, 'until': NULL::DATE, 'n_read': 0, 'n_skipped': 0}}) AS s FROM d GROUP BY author) SELECT author, s.empty AS empty, s.until AS until, s.n_read AS n_read, s.n_skipped AS n_skipped FROM f""")
def author_mutes(spark, sf_dir):
    """Authors whose posters gave no event time after time."""
    log = runs(spark, sf_dir).groupBy(F.col("source").alias("author"), "day").agg(F.count_if(F.col("status") == "produced").alias("n_events"))
    return ledger.author_mutes(log)


@query(f"""WITH {RUNS_SQL}, d AS (SELECT source, day, CASE WHEN bool_or(status = 'error') THEN 'mute' WHEN bool_or(status = 'produced') THEN 'fetch' ELSE 'none' END AS verdict FROM runs GROUP BY ALL),
f AS (SELECT source, list_reduce(list({{'day': day, 'v': verdict}} ORDER BY day), lambda s, x: CASE WHEN x.v = 'mute' AND (s.until IS NULL OR x.day >= s.until) THEN {{'since': x.day, 'until': x.day + {CONFIG.mute_days}, 'n_set': s.n_set + 1, 'n_cleared': s.n_cleared, 'n_lapsed': s.n_lapsed + CASE WHEN x.day >= s.until THEN 1 ELSE 0 END}}
  WHEN s.until IS NOT NULL AND x.day >= s.until THEN {{'since': NULL::DATE, 'until': NULL::DATE, 'n_set': s.n_set, 'n_cleared': s.n_cleared, 'n_lapsed': s.n_lapsed + 1}}
  WHEN x.v = 'fetch' AND s.until IS NOT NULL THEN {{'since': NULL::DATE, 'until': NULL::DATE, 'n_set': s.n_set, 'n_cleared': s.n_cleared + 1, 'n_lapsed': s.n_lapsed}} ELSE s END,
  {{'since': NULL::DATE, 'until': NULL::DATE, 'n_set': 0, 'n_cleared': 0, 'n_lapsed': 0}}) AS s FROM d GROUP BY source) SELECT source, s.since AS since, s.until AS until, s.n_set AS n_set, s.n_cleared AS n_cleared, s.n_lapsed AS n_lapsed FROM f""")
def cost_mutes(spark, sf_dir):
    """Mutes by verdicts of cost: set once, cleared by a fetching verdict, lapsed on their last day."""
    verdict = F.when(F.bool_or(F.col("status") == "error"), "mute").when(F.bool_or(F.col("status") == "produced"), "fetch").otherwise("none")
    return ledger.cost_mutes(runs(spark, sf_dir).groupBy("source", "day").agg(verdict.alias("verdict")))


def _costs(spark, sf_dir):
    task = F.create_map(*[F.lit(x) for pair in TASKS.items() for x in pair])
    return runs(spark, sf_dir).select("day", "source", task[F.col("status")].alias("category"), "cost", (F.col("status") == "empty").alias("estimated"))


COSTS_SQL = f"{RUNS_SQL}, costs AS (SELECT day, source, {TASK_SQL} AS category, cost, status = 'empty' AS estimated FROM runs)"


@query(f"WITH {COSTS_SQL} SELECT day, category, round(sum(cost), 4) AS usd, count(*) AS units, bool_or(estimated) AS estimated FROM costs GROUP BY day, category")
def daily_costs(spark, sf_dir):
    """What each category of tasks cost on each day, and whether part of it is an estimate."""
    return _costs(spark, sf_dir).groupBy("day", "category").agg(F.round(F.sum("cost"), 4).alias("usd"), F.count("*").alias("units"), F.bool_or("estimated").alias("estimated"))


@query(f"WITH {COSTS_SQL} SELECT day, round(sum(cost), 4) AS usd, round(coalesce(sum(cost) FILTER (WHERE category LIKE 'llm-%'), 0), 4) AS usd_models, round(coalesce(sum(cost) FILTER (WHERE category = 'search'), 0), 4) AS usd_search FROM costs GROUP BY day")
def cost_lines(spark, sf_dir):
    """A day's spending: in all, on models, on searches."""
    part = lambda hit, name: F.round(F.coalesce(F.sum(F.when(hit, F.col("cost"))), F.lit(0.0)), 4).alias(name)
    return _costs(spark, sf_dir).groupBy("day").agg(F.round(F.sum("cost"), 4).alias("usd"), part(F.col("category").startswith("llm-"), "usd_models"), part(F.col("category") == "search", "usd_search"))


@query(f"WITH {COSTS_SQL} SELECT category, CASE category WHEN 'llm-page' THEN 0 WHEN 'llm-poster' THEN 1 WHEN 'fetch' THEN 2 ELSE 3 END AS place, count(*) AS units, count(DISTINCT source) AS n_sources, round(sum(cost), 4) AS usd, bool_or(estimated) AS estimated FROM costs GROUP BY category")
def cost_volumes(spark, sf_dir):
    """Volumes by category, in the order in which they are shown."""
    place = F.when(F.col("category") == "llm-page", 0).when(F.col("category") == "llm-poster", 1).when(F.col("category") == "fetch", 2).otherwise(3)
    return _costs(spark, sf_dir).groupBy("category", place.alias("place")).agg(F.count("*").alias("units"), F.count_distinct("source").alias("n_sources"), F.round(F.sum("cost"), 4).alias("usd"), F.bool_or("estimated").alias("estimated"))


@query(f"WITH {RUNS_SQL} SELECT source, count(*) AS n_runs, count(*) FILTER (WHERE status <> 'unchanged') AS n_fetched, count(DISTINCT key) FILTER (WHERE status = 'produced') AS n_events, round(sum(cost), 4) AS usd, count(*) FILTER (WHERE status = 'error') AS n_errors, min(day) AS first_day, max(day) AS last_day FROM runs GROUP BY source")
def source_history(spark, sf_dir):
    """A source's runs in sum."""
    status = F.col("status")
    return runs(spark, sf_dir).groupBy("source").agg(
        F.count("*").alias("n_runs"), F.count_if(status != "unchanged").alias("n_fetched"), F.count_distinct(F.when(status == "produced", F.col("key"))).alias("n_events"), F.round(F.sum("cost"), 4).alias("usd"),
        F.count_if(status == "error").alias("n_errors"), F.min("day").alias("first_day"), F.max("day").alias("last_day"),
    )


@query(f"{QUEUE_SQL} SELECT verdict IN ('in-budget', 'probation') AS admitted, count(*) AS n, CAST(round(sum(CAST(usd_per_fetch AS DECIMAL(18, 4))), 2) AS DOUBLE) AS usd_next FROM queue GROUP BY 1")
def fetch_forecast(spark, sf_dir):
    """What the next run's admitted fetches will cost, and what is left out."""
    return _queue(spark, sf_dir).groupBy(F.col("verdict").isin("in-budget", "probation").alias("admitted")).agg(F.count("*").alias("n"), F.round(F.sum(F.col("usd_per_fetch").cast("decimal(18,4)")), 2).cast("double").alias("usd_next"))


@query(f"WITH {CATALOG_SQL} SELECT town, count(*) AS n, count(*) FILTER (WHERE is_noise) AS n_noise, count(*) FILTER (WHERE date_end IS NOT NULL) AS n_spans, count(*) FILTER (WHERE NOT is_noise AND p_size <= 10) AS n_young FROM catalog GROUP BY town")
def overview_counts(spark, sf_dir):
    """How many records each of the overview's filters holds."""
    return catalog(spark, sf_dir).groupBy("town").agg(F.count("*").alias("n"), F.count_if("is_noise").alias("n_noise"), F.count_if(F.col("date_end").isNotNull()).alias("n_spans"), F.count_if(~F.col("is_noise") & (F.col("p_size") <= 10)).alias("n_young"))



@query(f"""WITH {LINKS_SQL}, reg AS (SELECT regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host, max(page_id) AS id FROM pages GROUP BY 1), a AS (SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host FROM pages)
SELECT a.page_id, reg.id AS source_id, a.page_id = reg.id AS is_source FROM a JOIN reg ON a.host = reg.host""")
def registry_lookup(spark, sf_dir):
    """The source of each page: of several registered under one host the last."""
    pages = table(spark, sf_dir, "pages").select("page_id", F.regexp_extract("url", "^[a-z]+://([^/?#]+)", 1).alias("host"))
    registry = pages.groupBy("host").agg(F.max("page_id").alias("source_id"))
    return pages.join(registry, "host").select("page_id", "source_id", (F.col("page_id") == F.col("source_id")).alias("is_source"))


@query("SELECT c_custkey, count(o_orderkey) AS n_events, coalesce(max(o_orderstatus), 'nieznany') AS status FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey")
def web_peers(spark, sf_dir):
    """Every source with what it gave; one that never ran has nothing, and an unknown status."""
    given = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"), F.max("o_orderstatus").alias("s"))
    return table(spark, sf_dir, "customer").join(given, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", F.coalesce("n", F.lit(0)).alias("n_events"), F.coalesce("s", F.lit("nieznany")).alias("status"))


@query("""SELECT c_custkey, o_orderkey, count(l_orderkey) AS n_proposals, count(DISTINCT l_partkey) AS n_entries FROM customer LEFT JOIN orders ON c_custkey = o_custkey LEFT JOIN (SELECT * FROM lineitem WHERE l_returnflag = 'R') l ON o_orderkey = l_orderkey GROUP BY c_custkey, o_orderkey""")
def discovery_trace(spark, sf_dir):
    """From a query to its hits, their proposals and entries; a query without hits and a hit without proposals stay."""
    kept = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").groupBy("l_orderkey").agg(F.count("*").alias("n"), F.count_distinct("l_partkey").alias("e"))
    hits = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "orders"), F.col("c_custkey") == F.col("o_custkey"), "left")
    return hits.join(kept, F.col("o_orderkey") == F.col("l_orderkey"), "left").select("c_custkey", "o_orderkey", F.coalesce("n", F.lit(0)).alias("n_proposals"), F.coalesce("e", F.lit(0)).alias("n_entries"))


@query(f"""WITH {RUNS_SQL}, k AS (SELECT day, source, sum(cost) AS usd FROM runs WHERE status = 'ok' GROUP BY ALL), d AS (SELECT day, source, count(*) AS n FROM runs GROUP BY ALL)
SELECT d.day, count(*) AS n_sources, count(*) FILTER (WHERE usd IS NULL) AS n_unpriced, round(sum(coalesce(usd, 0)), 4) AS usd FROM d LEFT JOIN k USING (day, source) GROUP BY d.day""")
def cost_lookup(spark, sf_dir):
    """Costs of each day's sources; one without a cost counts as nought."""
    r = runs(spark, sf_dir)
    cost = r.where("status = 'ok'").groupBy("day", "source").agg(F.sum("cost").alias("usd"))
    return r.select("day", "source").distinct().join(cost, ["day", "source"], "left").groupBy("day").agg(F.count("*").alias("n_sources"), F.count_if(F.col("usd").isNull()).alias("n_unpriced"), F.round(F.sum(F.coalesce("usd", F.lit(0.0))), 4).alias("usd"))


@query(f"WITH {CATALOG_SQL} SELECT source_id, title, count(*) AS n, min(date_start) AS first_day, max(date_start) AS last_day FROM catalog WHERE contains(lower(title), 'green') OR contains(lower(venue), '#000000001') OR source_id = 's7' GROUP BY source_id, title")
def explain_search(spark, sf_dir):
    """What is known of the sources and titles that hold a word: by id, by name, by title."""
    hit = F.lower("title").contains("green") | F.lower("venue").contains("#000000001") | (F.col("source_id") == "s7")
    return catalog(spark, sf_dir).where(hit).groupBy("source_id", "title").agg(F.count("*").alias("n"), F.min("date_start").alias("first_day"), F.max("date_start").alias("last_day"))


FILE_SQL = "lower(regexp_extract(regexp_replace(href, '[?#].*$', ''), '([^/]+)/*$', 1))"


@query(f"WITH {LINKS_SQL}, f AS (SELECT {FILE_SQL} AS file, href FROM links) SELECT file, count(*) AS n, CASE WHEN count(DISTINCT href) = 1 THEN max(href) END AS href FROM f WHERE file <> '' GROUP BY file")
def links_by_file(spark, sf_dir):
    """The address behind each file name, where it names one address alone."""
    file = F.lower(F.regexp_extract(F.regexp_replace("href", "[?#].*$", ""), "([^/]+)/*$", 1))
    each = links(spark, sf_dir).select(file.alias("file"), "href").where("file <> ''")
    return each.groupBy("file").agg(F.count("*").alias("n"), F.when(F.count_distinct("href") == 1, F.max("href")).alias("href"))


@query(f"WITH {LINKS_SQL} SELECT href, min(page_id) AS page_id, count(*) AS n, count(DISTINCT page_id) AS n_pages FROM links GROUP BY href")
def link_union(spark, sf_dir):
    """Addresses of all pages together, each kept where it stands first."""
    return links(spark, sf_dir).groupBy("href").agg(F.min("page_id").alias("page_id"), F.count("*").alias("n"), F.count_distinct("page_id").alias("n_pages"))


HINT_SQL = "CASE WHEN regexp_matches({0}, '[?&](?:page|p|strona|pg|start|offset)=[0-9]+|/(?:page|strona|pg)/[0-9]+') THEN 3 ELSE greatest(0, 3 - len(list_filter(string_split(regexp_replace({0}, '[?#].*$', ''), '/'), lambda x: x <> ''))) END"


@query(f"""WITH {LINKS_SQL}, c AS (SELECT href AS url, {HINT_SQL.format('href')} AS hint FROM links UNION ALL SELECT url, 2 AS hint FROM pages) SELECT url, max(hint) AS hint, count(*) AS n FROM c GROUP BY url""")
def merged_candidates(spark, sf_dir):
    """Candidates of two origins as one list, each with its best hint."""
    depth = F.size(F.filter(F.split(F.regexp_replace("href", "[?#].*$", ""), "/"), lambda x: x != ""))
    own = links(spark, sf_dir).select(F.col("href").alias("url"), F.when(small.is_paged(F.col("href")), 3).otherwise(F.greatest(F.lit(0), 3 - depth)).alias("hint"))
    return own.unionByName(table(spark, sf_dir, "pages").select("url", F.lit(2).alias("hint"))).groupBy("url").agg(F.max("hint").alias("hint"), F.count("*").alias("n"))


@query("SELECT page_id, array_to_string(list_sort(list_distinct(regexp_extract_all(html, '[/=]([0-9]{2,})', 1))), ',') AS ids, CAST(len(list_distinct(regexp_extract_all(html, '[/=]([0-9]{2,})', 1))) AS INTEGER) AS n FROM pages")
def event_ids(spark, sf_dir):
    """The distinct ids in a page's addresses."""
    ids = F.array_distinct(F.regexp_extract_all("html", F.lit("[/=]([0-9]{2,})"), F.lit(1)))
    return table(spark, sf_dir, "pages").select("page_id", F.array_join(F.array_sort(ids), ",").alias("ids"), F.size(ids).alias("n"))


@query(f"""WITH {RUNS_SQL}, o AS (SELECT source, status, cost, event_id, row_number() OVER (PARTITION BY source ORDER BY CASE status WHEN 'produced' THEN 0 WHEN 'ok' THEN 1 WHEN 'unchanged' THEN 2 WHEN 'empty' THEN 3 ELSE 4 END, cost DESC, event_id) AS r FROM runs) SELECT source, status, cost, event_id FROM o WHERE r = 1""")
def best_capability(spark, sf_dir):
    """Each source's best way in: the first kind there is, then the surest of that kind."""
    kind = F.array_position(F.array(*map(F.lit, ("produced", "ok", "unchanged", "empty", "error"))), F.col("status"))
    best = runs(spark, sf_dir).groupBy("source").agg(F.min_by(F.struct("status", "cost", "event_id"), F.struct(kind, -F.col("cost"), F.col("event_id"))).alias("b"))
    return best.select("source", "b.*")


BUCKET_SQL = "CASE WHEN n = 0 THEN 'no-site' WHEN n < 10 THEN 'weak' ELSE 'covered' END"


@query(f"""WITH p AS (SELECT c_custkey, c_nationkey, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY ALL), b AS (SELECT *, {BUCKET_SQL} AS bucket FROM p)
SELECT c_custkey, bucket, CAST(row_number() OVER (PARTITION BY c_nationkey ORDER BY CASE bucket WHEN 'no-site' THEN 0 WHEN 'weak' THEN 1 ELSE 2 END, c_custkey) AS INTEGER) AS place FROM b""")
def page_classes(spark, sf_dir):
    """Pages by what their town's sites already cover, those that nothing covers first."""
    given = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"))
    p = table(spark, sf_dir, "customer").join(given, F.col("c_custkey") == F.col("o_custkey"), "left").withColumn("n", F.coalesce("n", F.lit(0)))
    bucket = F.when(F.col("n") == 0, "no-site").when(F.col("n") < 10, "weak").otherwise("covered")
    order = F.when(F.col("n") == 0, 0).when(F.col("n") < 10, 1).otherwise(2)
    return p.select("c_custkey", bucket.alias("bucket"), F.row_number().over(Window.partitionBy("c_nationkey").orderBy(order, "c_custkey")).alias("place"))


@query("SELECT page_id, md5(trim(regexp_replace(regexp_replace(html, '<[^>]*>', ' ', 'g'), '[ \\t\\n\\r\\f]+', ' ', 'g'))) AS text_md5, length(trim(regexp_replace(regexp_replace(html, '<[^>]*>', ' ', 'g'), '[ \\t\\n\\r\\f]+', ' ', 'g'))) AS n FROM pages")
def stripped_pages(spark, sf_dir):
    """Pages without their tags."""
    plain = small.strip_tags(F.col("html"))
    return table(spark, sf_dir, "pages").select("page_id", F.md5(plain).alias("text_md5"), F.length(plain).cast("long").alias("n"))


@query("""SELECT page_id, CASE WHEN length(t) > 40 THEN rtrim(substr(t, 1, 39)) || '…' ELSE t END AS short, replace(replace(replace(replace(replace(t, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#39;') AS safe FROM (SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS t FROM pages)""")
def page_titles(spark, sf_dir):
    """Titles cut short, and written out for markup."""
    t = F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    return table(spark, sf_dir, "pages").select("page_id", small.shortened(t, 40).alias("short"), small.escaped(t).alias("safe"))


@query("SELECT page_id, CASE WHEN regexp_matches(url, '^https?://[^?#]+') THEN 'fbposter:' || regexp_extract(url, '^https?://([^?#]+)', 1) END AS poster_key, regexp_matches(url, '[?&](?:page|p|strona|pg|start|offset)=[0-9]+|/(?:page|strona|pg)/[0-9]+') AS paged FROM pages")
def poster_keys(spark, sf_dir):
    """What a poster is remembered by, and whether an address is a page of a list."""
    return table(spark, sf_dir, "pages").select("page_id", small.poster_key(F.col("url")).alias("poster_key"), small.is_paged(F.col("url")).alias("paged"))


@query("SELECT regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host, arg_min(url, page_id) AS next_page, count(*) AS n FROM pages WHERE regexp_matches(url, '[?&](?:page|p|strona|pg|start|offset)=[0-9]+|/(?:page|strona|pg)/[0-9]+') GROUP BY 1")
def pagination(spark, sf_dir):
    """The first address of each host that leads on in a list."""
    host = F.regexp_extract("url", "^[a-z]+://([^/?#]+)", 1)
    return table(spark, sf_dir, "pages").where(small.is_paged(F.col("url"))).groupBy(host.alias("host")).agg(F.min_by("url", "page_id").alias("next_page"), F.count("*").alias("n"))


@query("SELECT user_id, substr(sha256('salt' || user_id), 1, 16) AS author, count(*) AS n FROM events GROUP BY user_id")
def author_keys(spark, sf_dir):
    """Authors under salted hashes."""
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.count("*").alias("n")).select("user_id", text.author_key("salt", F.col("user_id").cast("string")).alias("author"), "n")


@query("""SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) + 7 AS DATE) AS week_on, CAST(CAST(o_orderdate AS DATE) - DATE '1995-01-01' AS INTEGER) AS days, CAST(dayofweek(o_orderdate) AS INTEGER) AS weekday, day(o_orderdate) || '.' || lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0') AS short FROM orders""")
def day_parts(spark, sf_dir):
    """Days a week on, counted, by the week (Sunday is 0), and in short."""
    d = F.col("o_orderdate").cast("date")
    return table(spark, sf_dir, "orders").select("o_orderkey", F.date_add(d, 7).alias("week_on"), F.datediff(d, F.lit("1995-01-01").cast("date")).alias("days"), D.day_of_week(d).alias("weekday"), F.concat(F.dayofmonth(d), F.lit("."), F.lpad(F.month(d).cast("string"), 2, "0")).alias("short"))


DATES_SQL = "list_filter(list_concat(list_transform(regexp_extract_all(t, '(19|20)[0-9]{2}-[0-9]{2}-[0-9]{2}'), lambda d: TRY_CAST(d AS DATE)), list_transform(regexp_extract_all(t, '[0-9]{2}\\.[0-9]{2}\\.(19|20)[0-9]{2}'), lambda d: TRY_CAST(substr(d, 7, 4) || '-' || substr(d, 4, 2) || '-' || substr(d, 1, 2) AS DATE))), lambda d: d IS NOT NULL)"


@query(f"""WITH p AS (SELECT o_orderkey, o_orderdate, 'dnia ' || CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || ' oraz ' || strftime(CAST(o_orderdate AS DATE) + 30, '%d.%m.%Y') || ', nr ' || o_orderstatus || ' ' || CAST(o_orderkey AS VARCHAR) || '.13.1999' AS t FROM orders), d AS (SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN [] ELSE {DATES_SQL} END AS d FROM p)
SELECT o_orderkey, CAST(len(d) AS INTEGER) AS n, len(d) = 0 OR len(list_filter(d, lambda x: x >= DATE '{TODAY}')) > 0 AS worth FROM d""")
def worth_reading(spark, sf_dir):
    """Whether a page that names days names one that isn't past; some pages name none."""
    d = F.col("o_orderdate").cast("date")
    written = F.concat(F.lit("dnia "), d.cast("string"), F.lit(" oraz "), F.date_format(F.date_add(d, 30), "dd.MM.yyyy"), F.lit(", nr "), F.col("o_orderstatus"), F.lit(" "), F.col("o_orderkey").cast("string"), F.lit(".13.1999"))
    found = F.when(F.col("o_orderkey") % 4 == 0, F.array().cast("array<date>")).otherwise(small.dates_in(written))
    return table(spark, sf_dir, "orders").select("o_orderkey", found.alias("d")).select("o_orderkey", F.size("d").alias("n"), small.worth_reading(F.col("d"), F.lit(TODAY).cast("date")).alias("worth"))


@query("""SELECT p_partkey, contains(lower(p_type), 'brass') AS free, CASE WHEN contains(lower(p_type), 'brass') THEN 0.0 ELSE TRY_CAST(replace(regexp_extract(CAST(p_size AS VARCHAR) || ',5 zł', '([0-9]+(?:[.,][0-9]{1,2})?)', 1), ',', '.') AS DOUBLE) END AS amount,
 CASE WHEN contains(p_name, p_brand) THEN p_name WHEN contains(p_brand, p_name) THEN p_brand ELSE p_name || ', ' || p_brand END AS venue FROM part""")
def price_and_venue(spark, sf_dir):
    """Price texts read, and names joined with what they don't hold."""
    raw = F.concat(F.col("p_size").cast("string"), F.lit(",5 zł"), F.when(F.lower("p_type").contains("brass"), F.lit(" wstęp wolny")).otherwise(F.lit("")))
    price = text.price_of(raw)
    return table(spark, sf_dir, "part").select("p_partkey", price["free"].alias("free"), price["amount"].alias("amount"), parsing.venue_of(F.col("p_name"), F.col("p_brand")).alias("venue"))


@query("SELECT s_suppkey, n_name, contains(lower(s_name), lower(n_name)) OR contains(lower(n_name), lower(right(s_name, 1))) AS inside FROM supplier JOIN nation ON s_nationkey = n_nationkey")
def in_town(spark, sf_dir):
    """Whether a field of an address holds the town's name, or the name the field."""
    joined = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    return joined.select("s_suppkey", "n_name", small.holds_either([F.col("s_name"), F.right("s_name", F.lit(1))], F.col("n_name")).alias("inside"))


@query("SELECT p_partkey, regexp_matches(w, '^\\p{Lu}[\\p{L}-]+( \\p{Lu}?[\\p{L}-]+){0,2}$') AS town FROM (SELECT p_partkey, p_name AS w FROM part)")
def town_shapes(spark, sf_dir):
    """Names that could be a town's."""
    return table(spark, sf_dir, "part").select("p_partkey", small.looks_like_town(F.col("p_name")).alias("town"))


@query(f"""WITH {RUNS_SQL}, s AS (SELECT source, bool_and(status = 'error') AS dead, min(CASE status WHEN 'produced' THEN 0 WHEN 'ok' THEN 1 WHEN 'unchanged' THEN 2 WHEN 'empty' THEN 3 ELSE 4 END) AS best FROM runs GROUP BY source)
SELECT source, CASE WHEN dead THEN 'dead' WHEN best <= 1 THEN 'alive' WHEN best = 2 THEN 'idle' ELSE 'doubtful' END AS reach FROM s""")
def reach(spark, sf_dir):
    """Dead if every try failed, else by the best of them."""
    best = F.min(F.array_position(F.array(*map(F.lit, ("produced", "ok", "unchanged", "empty", "error"))), F.col("status")))
    s = runs(spark, sf_dir).groupBy("source").agg(F.bool_and(F.col("status") == "error").alias("dead"), best.alias("best"))
    return s.select("source", F.when(F.col("dead"), "dead").when(F.col("best") <= 2, "alive").when(F.col("best") == 3, "idle").otherwise("doubtful").alias("reach"))


@query("""SELECT page_id, array_to_string([s || w || r, s || v || r, t || w || r, t || v || r], ' ') AS variants FROM (SELECT page_id, regexp_replace(url, '^https?://(www\\.)?', '') AS r, CASE WHEN starts_with(url, 'https://') THEN 'https://' ELSE 'http://' END AS s, CASE WHEN starts_with(url, 'https://') THEN 'http://' ELSE 'https://' END AS t,
 CASE WHEN regexp_matches(url, '^https?://www\\.') THEN 'www.' ELSE '' END AS w, CASE WHEN regexp_matches(url, '^https?://www\\.') THEN '' ELSE 'www.' END AS v FROM pages)""")
def address_variants(spark, sf_dir):
    """The ways in which an address may also be reached."""
    return table(spark, sf_dir, "pages").select("page_id", F.array_join(small.variants(F.col("url")), " ").alias("variants"))


@query(f"""WITH {RUNS_SQL}, s AS (SELECT source, round(sum(cost), 2) AS usd, count(*) AS n, count(*) FILTER (WHERE status = 'error') AS e FROM runs GROUP BY source), r AS (SELECT *, usd / 4 AS raw, power(10.0, floor(log10(usd / 4))) AS p FROM s)
SELECT source, round(e / n, 4) AS error_share, p * CASE WHEN raw / p <= 1 THEN 1 WHEN raw / p <= 2 THEN 2 WHEN raw / p <= 5 THEN 5 ELSE 10 END AS step, greatest(0.0, 900 / 30 - round(usd / 30, 4)) AS left_daily FROM r""")
def shares_and_steps(spark, sf_dir):
    """Shares of errors, steps for an axis of costs, and what a month's budget leaves for a day."""
    s = runs(spark, sf_dir).groupBy("source").agg(F.round(F.sum("cost"), 2).alias("usd"), F.count("*").alias("n"), F.count_if(F.col("status") == "error").alias("e"))
    return s.select("source", small.share(F.col("e"), F.col("n")).alias("error_share"), small.nice_step(F.col("usd")).alias("step"), small.daily_share(F.lit(900.0), F.round(F.col("usd") / 30, 4)).alias("left_daily"))


@query(f"""WITH {LINKS_SQL}, u AS (SELECT page_id, list(href ORDER BY pos) AS l FROM links GROUP BY page_id) SELECT page_id, CAST(len(list_filter(l, lambda h: NOT regexp_matches(lower(h), '/({"|".join(CONFIG.repertoire)}|the)(/|$)'))) AS INTEGER) AS n_kept, CAST(len(l) AS INTEGER) AS n FROM u""")
def fetchable_urls(spark, sf_dir):
    """A page's addresses without those of repertoires, in their order."""
    words = "|".join([*CONFIG.repertoire, "the"])
    lists = links(spark, sf_dir).groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct("pos", "href"))).alias("l"))
    kept = F.filter("l", lambda x: ~F.lower(x["href"]).rlike(f"/({words})(/|$)"))
    return lists.select("page_id", F.size(kept).alias("n_kept"), F.size("l").alias("n"))


@query(f"WITH {RUNS_SQL} SELECT source, count(*) FILTER (WHERE status IN ('ok', 'produced')) AS n_bag, count(DISTINCT key) FILTER (WHERE status IN ('ok', 'produced')) AS n_set FROM runs GROUP BY source")
def event_union(spark, sf_dir):
    """What two kinds of runs gave together, as a bag and as a set."""
    r = runs(spark, sf_dir).select("source", "key", "status")
    both = r.where("status = 'ok'").unionByName(r.where("status = 'produced'")).groupBy("source").agg(F.count("*").alias("n_bag"), F.count_distinct("key").alias("n_set"))
    return r.select("source").distinct().join(both, "source", "left").select("source", F.coalesce("n_bag", F.lit(0)).alias("n_bag"), F.coalesce("n_set", F.lit(0)).alias("n_set"))
