"""RSS, Atom and WordPress collections: where they may lie, what they hold, and whether their items name days to come."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.functions.urls import url_key

#: Paths that feeds of towns' sites have without declaring them. Fixed values.
GUESSED = ("/feed", "/rss.xml", "/aktualnosci.xml", "/rss/wydarzenia_pl.xml", "/rss/aktualnosci_pl.xml")
#: Keys that hold the day of publication; names of keys that hold the day of an event; how Polish months begin, in order. Fixed values.
PUBLISH_KEYS = ("date", "date_gmt", "modified", "modified_gmt")
EVENT_DATE_KEY = "(?i)(start|begin|termin|data|event_?date|when|dtstart)"
MONTHS = ("stycz", "lut", "mar", "kwiet", "maj", "czerw", "lip", "sierp", "wrze", "paździer", "listopad", "grud")
#: Levels of nested objects that are searched below the first one.
DEPTH = 3

_RSS = "struct<channel struct<item array<struct<title string, description string>>>>"
_ATOM = "struct<entry array<struct<title string, summary string, content string>>>"
_DATE = "(?iu)[0-9]{1,2}[./-][0-9]{1,2}[./-][0-9]{4}|[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}\\s+(?:" + "|".join(MONTHS) + ")"


def resolved(href: Column, root: Column) -> Column:
    """An address as seen from a page: whole, with the page's scheme, from its root, or from its folder."""
    scheme, origin = F.regexp_extract(root, "^([A-Za-z][A-Za-z0-9+.-]*:)", 1), F.regexp_extract(root, "^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    folder = F.regexp_replace(F.regexp_replace(root, "[?#].*$", ""), "(?<![:/])/[^/]*$", "")
    return F.when(href.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), href).when(href.startswith("//"), F.concat(scheme, href)).when(href.startswith("/"), F.concat(origin, href)).otherwise(F.concat(folder, F.lit("/"), href))


def feed_candidates(pages: DataFrame) -> DataFrame:
    """source_id, place, url: feeds that a site's page (source_id, url, html) declares, then those at the guessed paths; of addresses with one key the first."""
    tags = F.regexp_extract_all("html", F.lit("(?i)<link[^>]+type=[\"']application/(?:rss|atom)\\+xml[\"'][^>]*>"), F.lit(0))
    hrefs = F.filter(F.transform(tags, lambda t: F.regexp_extract(t, "(?i)href=[\"']([^\"']+)[\"']", 1)), lambda h: h != "")
    every = pages.select("source_id", F.col("url").alias("root"), F.posexplode(F.concat(F.coalesce(hrefs, F.array().cast("array<string>")), F.array(*map(F.lit, GUESSED)))).alias("place", "href"))
    found = every.select("source_id", "place", resolved(F.col("href"), F.col("root")).alias("url")).withColumn("key", url_key(F.col("url")))
    return found.groupBy("source_id", "key").agg(F.min(F.struct("place", "url")).alias("f")).select("source_id", "f.place", "f.url")


def event_dates(text: Column, today: Column) -> Column:
    """The days that a text names, in order: 05.09.2026, 2026-09-05, and "5 września", which is read in today's year. What is no day of the calendar isn't one."""
    numeric = lambda m, k: F.regexp_extract(m, "^([0-9]{1,2})[./-]([0-9]{1,2})[./-]([0-9]{4})$", k)
    name = lambda m: F.lower(F.regexp_extract(m, "(?u)^[0-9]{1,2}\\s+(.+)$", 1))

    def day(m: Column) -> Column:
        month = F.coalesce(*[F.when(name(m) == stem, F.lit(k + 1)) for k, stem in enumerate(MONTHS)])
        spoken = F.try_make_timestamp(F.year(today), month, F.regexp_extract(m, "^([0-9]{1,2})", 1).try_cast("int"), F.lit(0), F.lit(0), F.lit(0)).cast("date")
        figures = F.try_make_timestamp(numeric(m, 3).try_cast("int"), numeric(m, 2).try_cast("int"), numeric(m, 1).try_cast("int"), F.lit(0), F.lit(0), F.lit(0)).cast("date")
        return F.when(numeric(m, 1) != "", figures).when(m.rlike("^[0-9]{4}-"), m.try_cast("date")).otherwise(spoken)

    return F.array_compact(F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(_DATE), F.lit(0)), day))


def prose(*parts: Column) -> Column:
    """Texts as one, without tags."""
    return F.regexp_replace(F.concat_ws(" ", *parts), "<[^>]+>", " ")


def feed_items(bodies: DataFrame) -> DataFrame:
    """source_id, kind ("rss", "atom" or "malformed"), text of every item of feeds (source_id, body): title and what describes it, never the day of publication. A feed that is no XML gives one malformed row without text."""
    told = bodies.where(F.col("body").rlike("(?i)<(rss|feed)\\b"))
    rss = told.where(F.col("body").rlike("(?i)<rss\\b")).withColumn("x", F.from_xml("body", _RSS, {"mode": "PERMISSIVE"}))
    atom = told.where(~F.col("body").rlike("(?i)<rss\\b")).withColumn("x", F.from_xml("body", _ATOM, {"mode": "PERMISSIVE"}))
    none = F.array().cast("array<string>")
    from_rss = F.transform("x.channel.item", lambda i: prose(i["title"], i["description"]))
    from_atom = F.transform("x.entry", lambda i: prose(i["title"], F.coalesce(i["summary"], i["content"])))
    both = rss.select("source_id", F.lit("rss").alias("kind"), from_rss.alias("texts")).unionByName(atom.select("source_id", F.lit("atom").alias("kind"), from_atom.alias("texts")))
    whole = both.where("texts is not null").select("source_id", "kind", F.explode("texts").alias("text"))
    broken = both.where("texts is null").select("source_id", F.lit("malformed").alias("kind"), F.lit(None).cast("string").alias("text"))
    return whole.unionByName(broken).withColumn("text", F.coalesce("text", F.array_join(none, "")))


def _future(value: Column, today: Column) -> Column:
    """Whether a JSON value is a moment not past: an ISO day at the start of a text, a mail's date, or a number of milliseconds."""
    text = F.try_variant_get(value, "$", "string")
    kind = F.schema_of_variant(value)
    iso = F.nullif(F.regexp_extract(text, "^([0-9]{4}-[0-9]{2}-[0-9]{2})", 1), F.lit("")).try_cast("date")
    mail = F.try_to_timestamp(F.regexp_extract(text, "^[A-Za-z]{3}, ([0-9]{1,2} [A-Za-z]{3} [0-9]{4})", 1), F.lit("d MMM yyyy")).cast("date")
    number = F.when(kind.rlike("^(BIGINT|INT|SMALLINT|TINYINT|DECIMAL|DOUBLE|FLOAT)"), F.try_variant_get(value, "$", "double"))
    ms = F.timestamp_millis(F.when(F.abs(number) < 8.64e15, number).cast("long")).cast("date")
    day = F.when(kind == "STRING", F.coalesce(iso, mail)).otherwise(ms)
    return F.coalesce((F.length(text) >= 6) & (day >= today), F.lit(False))


def with_event_date(records: DataFrame, key: str, body: str, today: Column) -> DataFrame:
    """key, has_date for each record whose body is JSON: whether a key that names an event's day holds a moment not past, in the record or in what it nests, down to a fixed depth; publication keys and what is below them don't count.

    A walk by levels: each explodes the objects and arrays of the one before. Bodies that are no JSON have no date.
    """
    spark = records.sparkSession
    level = records.select(key, F.try_parse_json(F.col(body)).alias("value"))
    found = None
    for _ in range(DEPTH + 1):
        inner = level.lateralJoin(spark.tvf.variant_explode(F.col("value").outer())).toDF(key, "_parent", "_pos", "_key", "_value")
        level = inner.where(~F.coalesce(F.col("_key"), F.lit("")).isin(*PUBLISH_KEYS)).select(key, "_key", F.col("_value").alias("value"))
        hits = level.where(F.col("_key").rlike(EVENT_DATE_KEY) & _future(F.col("value"), today)).select(key)
        found = hits if found is None else found.unionByName(hits)
        level = level.drop("_key")
    return records.select(key).join(found.distinct().withColumn("has_date", F.lit(True)), key, "left").select(key, F.coalesce("has_date", F.lit(False)).alias("has_date"))


def probe_feeds(bodies: DataFrame, today: Column) -> DataFrame:
    """source_id, kind, items_seen, dates_parsed of the feeds among the bodies: items, and those that name a day not past. Malformed ones have their own rows, without items."""
    dated = F.exists(event_dates(F.col("text"), today), lambda d: d >= today)
    real = F.col("kind") != "malformed"
    return feed_items(bodies).groupBy("source_id", "kind").agg(F.count_if(real).alias("items_seen"), F.count_if(real & dated).alias("dates_parsed"))


def probe_collections(bodies: DataFrame, today: Column) -> DataFrame:
    """source_id, kind ("wp-rest"), items_seen, dates_parsed of JSON collections among the bodies: arrays of records."""
    arrays = bodies.where(F.ltrim("body").startswith("[")).select("source_id", F.try_parse_json("body").alias("v"))
    spark = bodies.sparkSession
    items = arrays.lateralJoin(spark.tvf.variant_explode(F.col("v").outer())).toDF("source_id", "_v", "_pos", "_key", "_value").select("source_id", F.to_json("_value").alias("body"), F.concat_ws("#", "source_id", F.col("_pos").cast("string")).alias("item"))
    told = items.join(with_event_date(items, "item", "body", today), "item")
    return told.groupBy("source_id").agg(F.count("*").alias("items_seen"), F.count_if("has_date").alias("dates_parsed")).select("source_id", F.lit("wp-rest").alias("kind"), "items_seen", "dates_parsed")
