"""Structured feeds to event records: calendars, event plug-ins and linked data, from captured bodies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.operators.durable import settle

EVENT = ["source_id", "title", "date_start", "time_start", "date_end", "venue", "url"]


def from_ical(bodies: DataFrame) -> DataFrame:
    """Events of iCalendar bodies (source_id, body): long lines joined, escapes undone, UTC times in local time (Europe/Warsaw)."""
    unfolded = F.regexp_replace(F.regexp_replace("body", "\r\n", "\n"), "\n[ \t]", "")
    parts = bodies.select("source_id", F.explode(F.regexp_extract_all(unfolded, F.lit("(?s)BEGIN:VEVENT\n(.*?)END:VEVENT"), F.lit(1))).alias("e"))

    def field(name: str) -> Column:
        raw = F.regexp_extract("e", f"(?m)^{name}(?:;[^:\n]*)?:(.*)$", 1)
        return F.regexp_replace(F.regexp_replace(raw, "\\\\n", " "), "\\\\([,;\\\\])", "$1")

    def moment(name: str) -> tuple[Column, Column]:
        raw = field(name)
        # what isn't there isn't parsed: each failure would cost an exception
        told = lambda pattern: F.nullif(F.regexp_extract(raw, pattern, 1), F.lit(""))
        at = F.try_to_timestamp(told("^([0-9]{8}T[0-9]{6})"), F.lit("yyyyMMdd'T'HHmmss"))
        local = F.when(raw.endswith("Z"), F.from_utc_timestamp(at, "Europe/Warsaw")).otherwise(at)
        day = F.try_to_timestamp(told("^([0-9]{8})$"), F.lit("yyyyMMdd"))
        return F.coalesce(local, day).cast("date"), F.date_format(local, "HH:mm")

    start, time = moment("DTSTART")
    end, _ = moment("DTEND")
    return parts.select("source_id", F.trim(field("SUMMARY")).alias("title"), start.alias("date_start"), time.alias("time_start"), F.nullif(end, start).alias("date_end"), F.trim(field("LOCATION")).alias("venue"), F.trim(field("URL")).alias("url")).where("title <> '' and date_start is not null")


def from_plugin(bodies: DataFrame) -> DataFrame:
    """Events of a calendar plug-in's JSON (source_id, body): an array ``events``; a day from 00:00 to 23:59 has no times."""
    item = "struct<title string, url string, start_date string, end_date string, venue struct<venue string, address string>>"
    rows = bodies.select("source_id", F.explode(F.from_json("body", f"struct<events array<{item}>>")["events"]).alias("e")).select("source_id", "e.*")
    clock = lambda c: F.nullif(F.regexp_extract(c, "[ T]([0-9]{2}:[0-9]{2})", 1), F.lit(""))
    day = lambda c: F.try_to_timestamp(F.substring(c, 1, 10), F.lit("yyyy-MM-dd")).cast("date")
    whole = (clock("start_date") == "00:00") & F.coalesce(clock("end_date") == "23:59", F.lit(True))
    name, address = F.coalesce("venue.venue", F.lit("")), F.coalesce("venue.address", F.lit(""))
    place = F.when(name.contains(address), name).otherwise(F.concat_ws(", ", F.nullif(name, F.lit("")), address))
    return rows.select("source_id", F.trim(F.col("title")).alias("title"), day("start_date").alias("date_start"), F.when(~whole, clock("start_date")).alias("time_start"), F.nullif(day("end_date"), day("start_date")).alias("date_end"), place.alias("venue"), F.col("url").alias("url")).where("title <> '' and date_start is not null")


def from_json_ld(pages: DataFrame) -> DataFrame:
    """Events of linked data in pages (source_id, html): nodes whose type names an event, alone, in an array or in a graph."""
    scripts = pages.select("source_id", F.explode(F.regexp_extract_all("html", F.lit("(?is)<script[^>]*application/ld\\+json[^>]*>(.*?)</script>"), F.lit(1))).alias("raw"))
    node = "struct<`@type` string, name string, url string, startDate string, endDate string, location struct<name string>>"
    many = F.coalesce(F.from_json("raw", f"struct<`@graph` array<{node}>>")["@graph"], F.when(F.ltrim(F.col("raw")).startswith("["), F.from_json("raw", f"array<{node}>")).otherwise(F.array(F.from_json("raw", node))))
    rows = scripts.select("source_id", F.explode(many).alias("e")).where(F.col("e")["@type"].contains("Event")).select("source_id", "e.*")
    day = lambda c: F.try_to_timestamp(F.substring(c, 1, 10), F.lit("yyyy-MM-dd")).cast("date")
    return rows.select("source_id", F.trim(F.col("name")).alias("title"), day("startDate").alias("date_start"), F.nullif(F.regexp_extract("startDate", "T([0-9]{2}:[0-9]{2})", 1), F.lit("")).alias("time_start"), F.nullif(day("endDate"), day("startDate")).alias("date_end"), F.col("location.name").alias("venue"), F.col("url").alias("url")).where("title <> '' and date_start is not null")


def hashable_feed(body: Column) -> Column:
    """A feed's body without what changes at every fetch."""
    return F.regexp_replace(F.regexp_replace(body, "(?m)^DTSTAMP[^\n]*\n?", ""), '"(?:next_)?rest_url"\\s*:\\s*"[^"]*"\\s*,?', "")


def kind_of(body: Column) -> Column:
    """What a body is: 'ical', 'plugin', 'jsonld', or 'none'."""
    return F.when(body.contains("BEGIN:VCALENDAR"), "ical").when(F.ltrim(body).startswith("{") & body.contains('"events"'), "plugin").when(body.contains("application/ld+json"), "jsonld").otherwise("none")


def capabilities(bodies: DataFrame, today: Column) -> DataFrame:
    """source_id, kind, items_seen, dates_parsed, n_coming of what each source's bodies (source_id, body) offer. Each body goes to the parser of its kind.

    Bodies are written with their kinds first: three parsers read them, and reading deals them anew, however few tasks made them.
    """
    told = settle(bodies.select("source_id", "body", kind_of(F.col("body")).alias("kind")))
    of = lambda kind: told.where(F.col("kind") == kind).drop("kind")
    parsed = (("ical", from_ical(of("ical"))), ("plugin", from_plugin(of("plugin"))), ("jsonld", from_json_ld(of("jsonld").withColumnRenamed("body", "html"))))
    events = None
    for kind, found in parsed:
        found = found.select("source_id", F.lit(kind).alias("kind"), "date_start", "date_end")
        events = found if events is None else events.unionByName(found)
    coming = F.coalesce("date_end", "date_start") >= today
    return events.groupBy("source_id", "kind").agg(F.count("*").alias("items_seen"), F.count("date_start").alias("dates_parsed"), F.count_if(coming).alias("n_coming"))
