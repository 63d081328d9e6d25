"""Queries over captured bodies: calendars, plug-ins, linked data, pages to text and links; bodies are written from the orders, or are the pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.functions import markup
from gleanery.operators import filters
from gleanery.plans.discovery import HINT_SQL
from gleanery.plans.registry import query
from gleanery.sources import feeds
from gleanery.sources.tables import CATALOG_SQL, catalog, table


def _orders(spark, sf_dir) -> DataFrame:
    """An event for each order: its customer is the source; every third has an end two days on, every second a time."""
    o = table(spark, sf_dir, "orders")
    d = F.col("o_orderdate").cast("date")
    return o.select(F.concat(F.lit("c"), "o_custkey").alias("source_id"), F.col("o_orderkey").alias("k"), d.alias("day"), F.when(F.col("o_orderkey") % 3 == 0, F.date_add(d, 2)).alias("last"), (F.col("o_orderkey") % 2 == 0).alias("timed"))


def _bodies(events: DataFrame, item: Column, head: str, between: str, tail: str) -> DataFrame:
    """source_id, body: the items of each source in one body, in order."""
    items = events.groupBy("source_id").agg(F.sort_array(F.collect_list(F.struct("k", item.alias("item")))).alias("items"))
    return items.select("source_id", F.concat(F.lit(head), F.array_join("items.item", between), F.lit(tail)).alias("body"))


def _ical(spark, sf_dir, stamp: str = "20240101T000000Z") -> DataFrame:
    compact = lambda c: F.date_format(c, "yyyyMMdd")
    start = F.when(F.col("timed"), F.concat(F.lit("DTSTART;TZID=Europe/Warsaw:"), compact("day"), F.lit("T183000"))).otherwise(F.concat(F.lit("DTSTART;VALUE=DATE:"), compact("day")))
    end = F.coalesce(F.concat(F.lit("DTEND;VALUE=DATE:"), compact("last"), F.lit("\r\n")), F.lit(""))
    item = F.concat(F.lit("BEGIN:VEVENT\r\n"), start, F.lit(f"\r\nDTSTAMP:{stamp}\r\n"), end, F.lit("SUMMARY:Zam\r\n ówienie "), F.col("k"), F.lit("\\, duże\r\nLOCATION:Sala "), F.col("k") % 7, F.lit("\\; parter\r\nURL:https://x.pl/e/"), F.col("k"), F.lit("\r\nEND:VEVENT\r\n"))
    return _bodies(_orders(spark, sf_dir), item, "BEGIN:VCALENDAR\r\n", "", "END:VCALENDAR\r\n")


EVENT_SQL = """SELECT 'c' || o_custkey AS source_id, '{title}' AS title, CAST(o_orderdate AS DATE) AS date_start, CASE WHEN o_orderkey % 2 = 0 THEN '18:30' END AS time_start,
 CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderdate AS DATE) + 2 END AS date_end, '{venue}' AS venue, 'https://x.pl/e/' || o_orderkey AS url FROM orders"""


def _event_sql(title: str, venue: str) -> str:
    return EVENT_SQL.replace("'{title}'", title).replace("'{venue}'", venue)


@query(_event_sql("'Zamówienie ' || o_orderkey || ', duże'", "'Sala ' || (o_orderkey % 7) || '; parter'"))
def ical_events(spark, sf_dir):
    """Events of calendars with folded lines and escapes."""
    return feeds.from_ical(_ical(spark, sf_dir))


@query("SELECT 'c' || o_custkey AS source_id, count(*) AS n FROM orders GROUP BY 1")
def feed_hashes(spark, sf_dir):
    """Calendars fetched twice: bodies that differ in their stamps alone count as the same. n: events of those that do."""
    key = lambda stamp: _ical(spark, sf_dir, stamp).select("source_id", F.md5(feeds.hashable_feed(F.col("body"))).alias("h"), F.size(F.regexp_extract_all("body", F.lit("BEGIN:VEVENT"), F.lit(0))).cast("long").alias("n"))
    return key("20240101T000000Z").join(key("20240202T101010Z").drop("n"), ["source_id", "h"]).select("source_id", "n")


def _plugin(spark, sf_dir) -> DataFrame:
    day, last = F.col("day").cast("string"), F.coalesce("last", "day").cast("string")
    times = F.when(F.col("timed"), F.array(F.lit(" 18:30:00"), F.lit(" 20:00:00"))).otherwise(F.array(F.lit(" 00:00:00"), F.lit(" 23:59:59")))
    venue = F.struct(F.concat(F.lit("Sala "), (F.col("k") % 7).cast("string")).alias("venue"), F.lit("Rynek 1").alias("address"))
    item = F.to_json(F.struct(F.concat(F.lit(" Zamówienie "), F.col("k").cast("string")).alias("title"), F.concat(F.lit("https://x.pl/e/"), F.col("k").cast("string")).alias("url"), F.concat(day, times[0]).alias("start_date"), F.concat(last, times[1]).alias("end_date"), venue.alias("venue")))
    return _bodies(_orders(spark, sf_dir), item, '{"events":[', ",", '],"rest_url":"x"}')


@query(_event_sql("'Zamówienie ' || o_orderkey", "'Sala ' || (o_orderkey % 7) || ', Rynek 1'"))
def plugin_events(spark, sf_dir):
    """Events of a calendar plug-in's JSON."""
    return feeds.from_plugin(_plugin(spark, sf_dir))


def _linked(spark, sf_dir) -> DataFrame:
    start = F.concat(F.col("day").cast("string"), F.when(F.col("timed"), "T18:30:00").otherwise(""))
    node = F.struct(F.when(F.col("k") % 4 == 0, "MusicEvent").when(F.col("k") % 4 == 1, "Organization").otherwise("Event").alias("@type"), F.concat(F.lit("Zamówienie "), F.col("k").cast("string")).alias("name"), F.concat(F.lit("https://x.pl/e/"), F.col("k").cast("string")).alias("url"), start.alias("startDate"), F.col("last").cast("string").alias("endDate"), F.struct(F.concat(F.lit("Sala "), (F.col("k") % 7).cast("string")).alias("name")).alias("location"))
    return _bodies(_orders(spark, sf_dir), F.to_json(node), '<html><script type="application/ld+json">{"@graph":[', ",", "]}</script></html>")


@query(_event_sql("'Zamówienie ' || o_orderkey", "'Sala ' || (o_orderkey % 7)") + " WHERE o_orderkey % 4 <> 1")
def json_ld_events(spark, sf_dir):
    """Events of linked data; nodes of other types are none."""
    return feeds.from_json_ld(_linked(spark, sf_dir).withColumnRenamed("body", "html"))


CAPABILITY = "SELECT 'c' || o_custkey AS source_id, '{kind}' AS kind, count(*) AS items_seen, count(*) AS dates_parsed, count(*) FILTER (WHERE CAST(o_orderdate AS DATE) + CASE WHEN o_orderkey % 3 = 0 THEN 2 ELSE 0 END >= DATE '1997-01-01') AS n_coming FROM orders {where} GROUP BY 1"


@query(" UNION ALL ".join(CAPABILITY.format(kind=k, where=w) for k, w in (("ical", ""), ("plugin", ""), ("jsonld", "WHERE o_orderkey % 4 <> 1"))))
def capabilities(spark, sf_dir):
    """What each source's bodies offer: kind, items, days read, items to come. Each body goes to the parser of the kind that it is."""
    bodies = _ical(spark, sf_dir).unionByName(_plugin(spark, sf_dir)).unionByName(_linked(spark, sf_dir))
    return feeds.capabilities(bodies, F.lit("1997-01-01").cast("date"))


def _text_sql() -> str:
    out = "html"
    for pattern, to in markup.STEPS:
        out = f"regexp_replace({out}, '{pattern}', '{to.replace('$', chr(92)) if to else ''}', 'g')".replace("'\\n'", "chr(10)")
    for name, sign in markup.NAMED:
        out = f"replace({out}, '{name}', '{sign}')"
    for pattern, to in markup.SQUEEZE:
        out = f"regexp_replace({out}, '{pattern}', '{to}', 'g')".replace("'\n'", "chr(10)")
    return f"trim({out}, ' ' || chr(10))"


@query(f"SELECT page_id, md5(t) AS text_md5, length(t) AS n FROM (SELECT page_id, {_text_sql()} AS t FROM pages)")
def page_texts(spark, sf_dir):
    """Pages as texts: without furniture tags, links with their address behind them, a line for each block."""
    t = markup.to_text(F.col("html"))
    return table(spark, sf_dir, "pages").select("page_id", F.md5(t).alias("text_md5"), F.length(t).cast("long").alias("n"))


@query("""WITH h AS (SELECT page_id, regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1) AS host, list_distinct(regexp_extract_all(html, 'href="([^"#]+)"', 1)) AS every, regexp_extract_all(array_to_string(regexp_extract_all(html, '(?is)<nav\\b.*?</nav>'), ' '), 'href="([^"#]+)"', 1) AS nav FROM pages),
l AS (SELECT page_id, host, nav, unnest(every) AS href FROM h) SELECT page_id, href, list_contains(nav, href) AS in_nav FROM l WHERE starts_with(href, '/') OR contains(href, '://' || host || '/')""")
def site_links(spark, sf_dir):
    """A page's distinct links within its host, and which of them stand in its navigation."""
    return markup.site_links(table(spark, sf_dir, "pages"))


FOUNDED_SQL = f"""WITH {CATALOG_SQL}, e AS (SELECT pos, source_id AS key, title, CASE WHEN p_size % 9 = 0 THEN 'sb' ELSE '' END AS repeat FROM catalog),
p AS (SELECT 's' || s_suppkey AS key, CASE s_suppkey % 3 WHEN 0 THEN 'Zapraszamy w sobotę do nas' WHEN 1 THEN 'Nowa oferta https://x.pl/2024-01-01' ELSE 'Start 12.05, wejście wolne' END AS t FROM supplier WHERE s_suppkey % 4 <> 0)
SELECT e.key, count(*) AS n FROM e LEFT JOIN p ON e.key = p.key WHERE CASE WHEN repeat <> '' THEN true WHEN t IS NOT NULL THEN {HINT_SQL.format('t')} ELSE {HINT_SQL.format("(title || ' 3 maja')")} END GROUP BY e.key"""


@query(FOUNDED_SQL)
def founded_dates(spark, sf_dir):
    """Events whose day some text tells: by rhythm, by their post, or where there is none by the text as a whole."""
    e = catalog(spark, sf_dir).select("pos", F.col("source_id").alias("key"), "title", F.when(F.col("p_size") % 9 == 0, "sb").otherwise("").alias("repeat"))
    third = F.col("s_suppkey") % 3
    t = F.when(third == 0, "Zapraszamy w sobotę do nas").when(third == 1, "Nowa oferta https://x.pl/2024-01-01").otherwise("Start 12.05, wejście wolne")
    p = table(spark, sf_dir, "supplier").where("s_suppkey % 4 <> 0").select(F.concat(F.lit("s"), "s_suppkey").alias("key"), t.alias("post_text"))
    return filters.keep_founded_dates(e, p, F.concat("title", F.lit(" 3 maja"))).groupBy("key").agg(F.count("*").alias("n"))


PHRASES = ("Półkolonie letnie", "polkolonie w domu kultury", "Zebranie organizacyjne chóru", "organizacyjna zbiórka harcerzy", "zwolniło się jedno miejsce", "Koncert w parku", "Warsztaty")
_RULES = [(n, p.replace("(?iu)", "(?i)")) for n, p in filters.NON_EVENTS]
_WHY = "CASE " + " ".join(f"WHEN regexp_matches(t, '{p}') OR regexp_matches(container, '{p}') OR regexp_matches(tag, '{p}') THEN '{n}'" for n, p in _RULES) + " ELSE 'kept' END"


@query(f"""WITH {CATALOG_SQL}, e AS (SELECT source_id, title || ' ' || [{', '.join(f"'{p}'" for p in PHRASES)}][p_size % 7 + 1] AS t, CASE WHEN p_size % 11 = 0 THEN 'PÓŁKOLONIE 2024' ELSE '' END AS container, CASE WHEN p_size % 13 = 0 THEN 'polkolonie' ELSE 'muzyka' END AS tag FROM catalog)
SELECT {_WHY} AS why, count(*) AS n, count(DISTINCT source_id) AS n_sources FROM e GROUP BY 1""")
def dropped_non_events(spark, sf_dir):
    """What the shipped rules drop, by the first rule that does, over titles, containers and tags."""
    phrase = F.get(F.array(*map(F.lit, PHRASES)), F.col("p_size") % 7)
    e = catalog(spark, sf_dir).select("source_id", F.concat_ws(" ", "title", phrase).alias("title"), F.when(F.col("p_size") % 11 == 0, "PÓŁKOLONIE 2024").otherwise("").alias("container"), F.array(F.when(F.col("p_size") % 13 == 0, "polkolonie").otherwise("muzyka")).alias("tags"))
    kept, dropped = filters.without_non_events(e)
    return dropped.unionByName(kept.withColumn("why", F.lit("kept"))).groupBy("why").agg(F.count("*").alias("n"), F.count_distinct("source_id").alias("n_sources"))
