"""Records of data providers, whose fields go by many names, to event records; drops are counted on the way."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from gleanery.functions.parsing import strip_all_day
from gleanery.functions.text import let

#: Names that providers give a field, in order of preference. Fixed values.
NAMES = {
    "title": ("name", "title", "event_name"),
    "start": ("start_date", "startDate", "date_start", "start_time", "start"),
    "end": ("end_date", "endDate", "date_end", "end_time", "end"),
    "place": ("location", "venue", "place", "place_name", "location_name"),
    "address": ("address", "full_address", "location_address"),
    "city": ("city",),
    "category": ("category", "event_type"),
    "registration": ("ticket_url", "tickets_url", "external_url", "registration_url"),
    "source_url": ("url", "event_url", "input_url", "link"),
}
#: What a drop is for, in the order that is asked. Fixed values.
REASONS = ("no_title", "no_date", "past")


def picked(record: Column, names: tuple[str, ...]) -> Column:
    """The first of the names that holds a text that isn't blank, trimmed, or a number; other kinds of values are passed over."""

    def text_of(value: Column) -> Column:
        text = F.nullif(F.trim(F.try_variant_get(value, "$", "string")), F.lit(""))
        return F.when(F.schema_of_variant(value).rlike("^(STRING|BIGINT|INT|SMALLINT|TINYINT|DECIMAL|DOUBLE|FLOAT)"), text)

    found = F.transform(F.array(*[F.try_variant_get(record, f"$.{n}", "variant") for n in names]), text_of)
    return F.get(F.filter(found, lambda x: x.isNotNull()), F.lit(0))


def moment(raw: Column) -> Column:
    """(day, time) of a moment: ten digits are seconds, up to thirteen milliseconds, both without a time; else the first ISO day in the text, with the time behind it."""

    def told(text: Column) -> Column:
        digits = text.rlike("^[0-9]{10,13}$")
        number = F.when(digits, text).try_cast("long")
        unix = F.timestamp_millis(F.when(F.length(text) == 10, number * 1000).otherwise(number)).cast("date")
        iso = F.nullif(F.regexp_extract(text, "([0-9]{4}-[0-9]{2}-[0-9]{2})", 1), F.lit("")).try_cast("date")
        time = F.nullif(F.regexp_extract(text, "[0-9]{4}-[0-9]{2}-[0-9]{2}[T ]([0-9]{2}:[0-9]{2})", 1), F.lit(""))
        return F.struct(F.when(digits, unix).otherwise(iso).alias("day"), F.when(~digits, time).alias("time"))

    return let(raw, told)


def venue_of(place: Column, address: Column) -> Column:
    """The place with its address behind it, unless it holds it; either alone where the other is missing."""
    both = F.struct(place.alias("p"), address.alias("a"))
    return let(both, lambda x: F.when(x["p"].isNotNull() & x["a"].isNotNull() & ~x["p"].contains(x["a"]), F.concat_ws(", ", x["p"], x["a"])).otherwise(F.coalesce(x["p"], x["a"], F.lit(""))))


def town_of(address: Column) -> Column:
    """The last part of an address without its post code; null if nothing is left."""
    parts = F.filter(F.transform(F.split(address, ","), F.trim), lambda p: p != "")
    last = F.try_element_at(parts, F.lit(-1))
    return F.nullif(F.trim(F.regexp_replace(last, "^(.*?)[0-9]{2}-[0-9]{3}", "$1")), F.lit(""))


def drafts(records: DataFrame, body: str = "body") -> DataFrame:
    """The records with draft columns: title, date_start, time_start, date_end, time_end, venue, town, tag, registration, source_url. A body that is no JSON object gives an empty draft."""
    parsed = records.withColumn("_r", F.try_parse_json(F.col(body)))
    field = lambda name: picked(F.col("_r"), NAMES[name])
    wide = parsed.select(*records.columns, *[field(n).alias(f"_{n}") for n in NAMES])
    start, end, address = moment(F.col("_start")), moment(F.col("_end")), F.col("_address")
    return wide.select(
        *records.columns,
        F.col("_title").alias("title"),
        start["day"].alias("date_start"),
        start["time"].alias("time_start"),
        end["day"].alias("date_end"),
        end["time"].alias("time_end"),
        venue_of(F.col("_place"), address).alias("venue"),
        F.coalesce("_city", town_of(address), F.lit("")).alias("town"),
        F.concat(F.lit("fb:"), F.coalesce(F.lower("_category"), F.lit("wydarzenie"))).alias("tag"),
        F.coalesce("_registration", F.lit("")).alias("registration"),
        F.coalesce("_source_url", F.lit("")).alias("source_url"),
    )


def why_dropped(today: Column) -> Column:
    """What keeps a draft from becoming an event: no title, no day, or a last day before today; null if nothing does."""
    over = F.coalesce("date_end", "date_start") < today
    return F.when(F.coalesce(F.trim("title"), F.lit("")) == "", "no_title").when(F.col("date_start").isNull(), "no_date").when(over, "past")


def to_events(told: DataFrame, today: Column, counts: Observation | None = None) -> DataFrame:
    """Drafts that become events: an end on the first day is none. The drops are counted by ``counts`` while the rows go by, besides ``seen`` and ``kept``; no second scan.

    Counts hold where the rows are read once, as by a write: a total sort reads its input twice, to find its ranges.
    """
    judged = told.withColumn("_why", why_dropped(today))
    if counts is not None:
        judged = judged.observe(counts, F.count(F.lit(1)).alias("seen"), F.count_if(F.col("_why").isNull()).alias("kept"), *[F.count_if(F.col("_why") == r).alias(r) for r in REASONS])
    return judged.where("_why is null").drop("_why").withColumn("date_end", F.when(F.col("date_end") != F.col("date_start"), F.col("date_end")))


def whole_days(events: DataFrame) -> DataFrame:
    """Events from midnight to a minute before it, or to nothing, lose their times."""
    start, end = strip_all_day(F.col("time_start"), F.col("time_end"))
    return events.withColumns({"time_start": start, "time_end": end})
