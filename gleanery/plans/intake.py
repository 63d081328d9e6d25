"""Queries over providers' records and syndicated feeds; the bodies are written from the orders, in several shapes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.functions import places
from gleanery.plans.registry import query
from gleanery.sources import providers, syndication
from gleanery.sources.tables import table

TODAY = "1997-01-01"
#: Months as Polish texts name a day in them, in order. Fixed values.
GENITIVE = ("stycznia", "lutego", "marca", "kwietnia", "maja", "czerwca", "lipca", "sierpnia", "września", "października", "listopada", "grudnia")


def today():
    return F.lit(TODAY).cast("date")


def records(spark, sf_dir) -> DataFrame:
    """A provider's record for each order, in one of five shapes: names, kinds of moments and places differ; some lack a title or a day, some are cut short."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.concat(F.lit("c"), "o_custkey").alias("source_id"), F.col("o_orderdate").cast("date").alias("d"))
    k, d = F.col("k"), F.col("d")
    title = F.when(k % 11 != 0, F.concat(F.lit(" Zamówienie "), k, F.lit(" ")))
    ms = F.unix_date(d).cast("long") * 86_400_000
    shapes = [
        F.to_json(F.struct(title.alias("name"), F.concat(d.cast("string"), F.lit("T18:00:00Z")).alias("start_date"), F.lit("Sala 1").alias("location"), F.lit("ul. X 1, 61-000 Poznań").alias("address"))),
        F.to_json(F.struct(F.lit(True).alias("name"), title.alias("title"), ms.alias("startDate"), F.date_add(d, 2).cast("string").alias("endDate"), F.lit("Luboń").alias("city"), F.lit("Koncert").alias("category"))),
        F.to_json(F.struct(title.alias("event_name"), F.when(k % 7 != 2, F.concat(F.lit("od "), d.cast("string"), F.lit(" 20:30"))).otherwise("wkrótce").alias("start"), d.cast("string").alias("end"), F.lit("Klub, ul. Y 2").alias("place_name"), F.lit("ul. Y 2").alias("full_address"))),
        F.to_json(F.struct(F.struct(title.alias("x")).alias("name"), F.lit("  ").alias("title"), d.cast("string").alias("start_date"))),
        F.concat(F.lit('{"name": "'), title, F.lit('", "start_date": "'), d.cast("string")),
    ]
    return o.select("k", "source_id", F.get(F.array(*shapes), (k % 5).cast("int")).alias("body"))


RECORDS_SQL = f"""o AS (SELECT o_orderkey AS k, 'c' || o_custkey AS source_id, CAST(o_orderdate AS DATE) AS d, o_orderkey % 5 AS shape, CASE WHEN o_orderkey % 11 <> 0 THEN 'Zamówienie ' || o_orderkey END AS t FROM orders),
drafted AS (SELECT k, source_id, CASE WHEN shape < 3 THEN t END AS title, CASE WHEN shape > 3 OR (shape = 2 AND k % 7 = 2) THEN NULL ELSE d END AS date_start, CASE shape WHEN 0 THEN '18:00' WHEN 2 THEN CASE WHEN k % 7 <> 2 THEN '20:30' END END AS time_start, CASE shape WHEN 1 THEN d + 2 WHEN 2 THEN d END AS date_end,
CASE shape WHEN 0 THEN 'Sala 1, ul. X 1, 61-000 Poznań' WHEN 2 THEN 'Klub, ul. Y 2' ELSE '' END AS venue, CASE shape WHEN 0 THEN 'Poznań' WHEN 1 THEN 'Luboń' WHEN 2 THEN 'ul. Y 2' ELSE '' END AS town, CASE shape WHEN 1 THEN 'fb:koncert' ELSE 'fb:wydarzenie' END AS tag FROM o),
told AS (SELECT *, CASE WHEN title IS NULL THEN 'no_title' WHEN date_start IS NULL THEN 'no_date' WHEN coalesce(date_end, date_start) < DATE '{TODAY}' THEN 'past' ELSE 'kept' END AS why FROM drafted)"""


@query(f"WITH {RECORDS_SQL} SELECT k, source_id, title, date_start, time_start, CAST(nullif(date_end, date_start) AS DATE) AS date_end, venue, town, tag FROM told WHERE why = 'kept'")
def provider_events(spark, sf_dir):
    """Providers' records that become events."""
    kept = providers.to_events(providers.drafts(records(spark, sf_dir)), today())
    return kept.select("k", "source_id", "title", "date_start", "time_start", "date_end", "venue", "town", "tag")


@query(f"WITH {RECORDS_SQL} SELECT source_id, count(*) AS seen, count(*) FILTER (WHERE why = 'kept') AS kept, count(*) FILTER (WHERE why = 'no_title') AS no_title, count(*) FILTER (WHERE why = 'no_date') AS no_date, count(*) FILTER (WHERE why = 'past') AS past FROM told GROUP BY source_id")
def provider_drops(spark, sf_dir):
    """How many records of each source become events, and what the others lack, in one pass."""
    why = providers.drafts(records(spark, sf_dir)).select("source_id", providers.why_dropped(today()).alias("why"))
    return why.groupBy("source_id").agg(F.count("*").alias("seen"), F.count_if(F.col("why").isNull()).alias("kept"), *[F.count_if(F.col("why") == r).alias(r) for r in providers.REASONS])


def feed_bodies(spark, sf_dir) -> DataFrame:
    """A feed for each customer with an item for each order, as RSS or Atom; every seventh is cut short. Items tell their day in three ways, and all have a day of publication."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("c"), F.col("o_orderdate").cast("date").alias("d"))
    k, d = F.col("k"), F.col("d")
    month = F.get(F.array(*map(F.lit, GENITIVE)), F.month(d) - 1)
    told = F.when(k % 3 == 0, F.date_format(d, "dd.MM.yyyy")).when(k % 3 == 1, d.cast("string")).otherwise(F.concat_ws(" ", F.dayofmonth(d), month))
    words = F.when(k % 4 == 0, F.lit("Zapraszamy &amp; czekamy")).otherwise(F.concat(F.lit("<![CDATA[<p>odbędzie się "), told, F.lit("</p>]]>")))
    rss = F.concat(F.lit("<item><title>Zamówienie "), k, F.lit("</title><pubDate>Thu, 30 Jul 2026 21:24:07 +0200</pubDate><description>"), words, F.lit("</description></item>"))
    atom = F.concat(F.lit('<entry><title type="html">Zamówienie '), k, F.lit("</title><updated>2026-07-30T00:00:00Z</updated><summary>"), words, F.lit("</summary></entry>"))
    items = o.groupBy("c").agg(F.array_sort(F.collect_list(F.struct("k", F.when(F.col("c") % 2 == 0, rss).otherwise(atom).alias("x")))).alias("items"))
    joined = F.array_join("items.x", "")
    body = F.when(F.col("c") % 2 == 0, F.concat(F.lit('<?xml version="1.0"?><rss version="2.0"><channel><title>x</title>'), joined, F.lit("</channel></rss>"))).otherwise(F.concat(F.lit('<feed xmlns="http://www.w3.org/2005/Atom"><title>x</title>'), joined, F.lit("</feed>")))
    cut = F.when(F.col("c") % 7 == 0, F.expr("left(body, length(body) - 9)")).otherwise(F.col("body"))
    return items.select("c", body.alias("body")).select(F.concat(F.lit("c"), "c").alias("source_id"), cut.alias("body"))


@query(f"""WITH o AS (SELECT 'c' || o_custkey AS source_id, o_custkey AS c, o_orderkey AS k, CASE WHEN o_orderkey % 3 = 2 THEN CASE WHEN month(o_orderdate) = 2 AND day(o_orderdate) = 29 THEN NULL ELSE make_date({TODAY[:4]}, month(o_orderdate), day(o_orderdate)) END ELSE CAST(o_orderdate AS DATE) END AS d FROM orders)
SELECT source_id, CASE WHEN c % 7 = 0 THEN 'malformed' WHEN c % 2 = 0 THEN 'rss' ELSE 'atom' END AS kind, CASE WHEN c % 7 = 0 THEN 0 ELSE count(*) END AS items_seen, CASE WHEN c % 7 = 0 THEN 0 ELSE count(*) FILTER (WHERE k % 4 <> 0 AND d >= DATE '{TODAY}') END AS dates_parsed FROM o GROUP BY source_id, c""")
def feed_probes(spark, sf_dir):
    """What each feed offers: items, and those that name a day to come; days of publication don't count."""
    return syndication.probe_feeds(feed_bodies(spark, sf_dir), today())


def collection_bodies(spark, sf_dir) -> DataFrame:
    """A collection for each customer with a record for each order; the day of the event lies in one of five places, one of them too deep, one the day of publication."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("c"), F.col("o_orderdate").cast("date").cast("string").alias("d"))
    k, d = F.col("k"), F.col("d")
    shapes = [
        F.to_json(F.struct(k.alias("id"), d.alias("start_date"))),
        F.to_json(F.struct(k.alias("id"), F.struct(F.array(F.struct(F.concat(d, F.lit(" 18:00")).alias("mec_start_date"))).alias("x")).alias("meta"))),
        F.to_json(F.struct(k.alias("id"), F.concat(d, F.lit("T10:00:00")).alias("date"), F.struct(d.alias("start")).alias("modified"))),
        F.to_json(F.struct(F.struct(F.struct(F.struct(F.struct(d.alias("start_date")).alias("d")).alias("c")).alias("b")).alias("a"))),
        F.to_json(F.struct(k.alias("start_position"), (F.unix_date(F.col("d").cast("date")).cast("long") * 86_400_000).alias("dtstart"))),
    ]
    item = F.get(F.array(*shapes), (k % 5).cast("int"))
    items = o.groupBy("c").agg(F.array_sort(F.collect_list(F.struct("k", item.alias("x")))).alias("items"))
    return items.select(F.concat(F.lit("c"), "c").alias("source_id"), F.concat(F.lit("["), F.array_join("items.x", ","), F.lit("]")).alias("body"))


@query(f"SELECT 'c' || o_custkey AS source_id, 'wp-rest' AS kind, count(*) AS items_seen, count(*) FILTER (WHERE o_orderkey % 5 IN (0, 1, 4) AND CAST(o_orderdate AS DATE) >= DATE '{TODAY}') AS dates_parsed FROM orders GROUP BY o_custkey")
def collection_probes(spark, sf_dir):
    """What each JSON collection offers: records, and those that hold a day to come, however nested, down to a fixed depth."""
    return syndication.probe_collections(collection_bodies(spark, sf_dir), today())


@query(f"""WITH g AS (SELECT unnest({list(syndication.GUESSED)}) AS p, generate_subscripts({list(syndication.GUESSED)}, 1) AS i), s AS (SELECT page_id, regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1) AS origin FROM pages)
SELECT page_id AS source_id, CAST(i - 1 AS INTEGER) + CASE WHEN page_id % 3 < 2 THEN 1 ELSE 0 END AS place, origin || p AS url FROM s, g WHERE NOT (page_id % 3 = 0 AND i = 1) AND NOT (page_id % 3 = 1 AND i = 3)
UNION ALL SELECT page_id, 0, CASE page_id % 3 WHEN 0 THEN origin || '/feed/' ELSE origin || '/aktualnosci.xml' END FROM s WHERE page_id % 3 < 2""")
def feed_candidates(spark, sf_dir):
    """Feeds that pages declare, and where undeclared ones may lie; an address that is both comes once, as declared."""
    p = table(spark, sf_dir, "pages")
    link = F.when(F.col("page_id") % 3 == 0, '<link rel="alternate" type="application/rss+xml" href="/feed/">').when(F.col("page_id") % 3 == 1, "<LINK type='application/atom+xml' href='/aktualnosci.xml'>").otherwise('<link type="text/css" href="/x.css">')
    return syndication.feed_candidates(p.select(F.col("page_id").alias("source_id"), "url", F.concat(link, "html").alias("html")))


#: Venues as sources write them, each with what to ask of it in turn; {k} stands for the supplier's number, an @ before a town that the part names itself.
VENUES = (
    ("Hipodrom Wola, ul. Lutycka {k}", ("Hipodrom Wola", "Lutycka {k}")),
    ("Mosina ul. Jana Cybisa {k} - garaż", ("Jana Cybisa {k}@Mosina",)),
    ("Start: przy fontannie na placu Wolności {k}", ("plac Wolności {k}",)),
    ("Sala kolumnowa, Akademia {k} (Ostrów Tumski)", ("Akademia {k}", "Ostrów Tumski")),
    ("Cytadela poznańska / parking", ("Cytadela poznańska", "Cytadela")),
    ("Akademia Lubrańskiego Muzeum Archidiecezjalne {k}", ("Akademia Lubrańskiego Muzeum Archidiecezjalne {k}", "Akademia Lubrańskiego", "Muzeum Archidiecezjalne {k}")),
    ("Park Wilsona, park Wilsona; Sala", ("Park Wilsona",)),
)


@query(f"""WITH v AS (SELECT unnest({[list(asked) for _, asked in VENUES]!r}) AS asked, generate_subscripts({[list(asked) for _, asked in VENUES]!r}, 1) AS i), s AS (SELECT s_suppkey, unnest(asked) AS a, generate_subscripts(asked, 1) - 1 AS place FROM supplier JOIN v ON s_suppkey % {len(VENUES)} = i - 1)
SELECT s_suppkey, CAST(place AS INTEGER) AS place, replace(split_part(a, '@', 1), '{{k}}', CAST(s_suppkey AS VARCHAR)) AS q, CASE WHEN contains(a, '@') THEN split_part(a, '@', 2) END AS town FROM s""")
def place_ladders(spark, sf_dir):
    """What to ask a geocoder about every supplier's venue, in turn."""
    written = F.get(F.array(*[F.lit(v) for v, _ in VENUES]), (F.col("s_suppkey") % len(VENUES)).cast("int"))
    venue = F.replace(written, F.lit("{k}"), F.col("s_suppkey").cast("string"))
    asked = table(spark, sf_dir, "supplier").select("s_suppkey", F.posexplode(places.place_queries(venue, F.lit("Poznań"))).alias("place", "x"))
    return asked.select("s_suppkey", "place", "x.q", "x.town")
