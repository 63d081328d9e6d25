"""Filters over event records: each keeps rows, or tells why a row goes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.config import CONFIG
from gleanery.functions.dates import last_day, span_days

#: What isn't an event, by name: a pattern over title, container and tags. Fixed values.
NON_EVENTS = (
    ("półkolonie", "(?iu)p[oó][łl]koloni"),
    ("spotkanie organizacyjne", "(?iu)(?:spotkani|zebrani|zbi[oó]rk)[A-Za-z0-9_]*\\s+organizacyjn|organizacyjn[A-Za-z0-9_]*\\s+(?:spotkani|zebrani|zbi[oó]rk)"),
    ("zwolniony termin w usłudze", "(?iu)zwolni[łl][A-Za-z0-9_]*\\s+si[eę](?:\\s+\\S+){0,2}\\s+(?:termin|miejsc)"),
)


def reason_of(rules: tuple[tuple[str, str], ...], texts: list[Column], tags: Column | None = None) -> Column:
    """The name of the first rule whose pattern one of the texts or tags meets, or null."""
    out = None
    for name, pattern in rules:
        hit = F.lit(False)
        for text in texts:
            hit = hit | F.coalesce(text.rlike(pattern), F.lit(False))
        if tags is not None:
            hit = hit | F.coalesce(F.exists(tags, lambda t: t.rlike(pattern)), F.lit(False))
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out


def without_non_events(events: DataFrame, rules: tuple[tuple[str, str], ...] = NON_EVENTS) -> tuple[DataFrame, DataFrame]:
    """Events, and the dropped ones with their reason (why). Columns: title, container, tags."""
    marked = events.withColumn("why", reason_of(rules, [F.col("title"), F.col("container")], F.col("tags")))
    return marked.where(F.col("why").isNull()).drop("why"), marked.where(F.col("why").isNotNull())


def within_region(events: DataFrame) -> DataFrame:
    """Drops what is surely elsewhere; unknown places and nulls stay."""
    return events.where(~F.coalesce(F.col("locality"), F.lit("unknown")).isin("far", "abroad"))


def drop_past(events: DataFrame, today: Column) -> DataFrame:
    """Keeps events whose last day isn't over."""
    dates = F.col("dates") if "dates" in events.columns else None
    return events.where(last_day(dates, F.col("date_start"), F.col("date_end")) >= today)


def repertoire_hit(path: Column, words: tuple[str, ...] = CONFIG.repertoire) -> Column:
    """Whether a decoded, lower-case segment of a path is one of the words."""
    segments = F.transform(F.split(path, "/"), lambda s: F.lower(F.coalesce(F.try_url_decode(s), s)))
    return F.arrays_overlap(segments, F.array(*[F.lit(w) for w in words]))


def container_suspect(start: Column, end: Column, dates: Column | None, repeat: Column | None, time: Column | None, days: int = CONFIG.container_days) -> Column:
    """A long span without rhythm, days or time: perhaps a frame for other events."""
    out = F.coalesce(span_days(start, end) >= days, F.lit(False))
    if repeat is not None:
        out = out & (F.coalesce(repeat, F.lit("")) == "")
    if dates is not None:
        out = out & (F.coalesce(F.size(dates), F.lit(0)) == 0)
    if time is not None:
        out = out & (F.coalesce(time, F.lit("")) == "")
    return out


def age_ok(age: Column, least: Column, most: Column) -> Column:
    """Whether an age lies within bounds that may be open."""
    return (least.isNull() | (age >= least)) & (most.isNull() | (age <= most))


#: Words of days, months and near days, beginnings only.
MONTH_WORDS = "stycz|lut|marz|marc|kwiet|maj|czerw|lip|sierp|wrze|paździer|pazdzier|listopad|grud"
WEEKDAY_WORDS = "poniedział|poniedzial|wtor|środ|srod|czwart|piąt|piat|sobot|niedziel"
NEAR_WORDS = "dziś|dzis|dzisiaj|jutro|pojutrze|weekend|codziennie|w każd|w kazd|najbliższ|najblizsz"
_LEFT = "(?:^|[^A-Za-z0-9_])"


def has_date_hint(text: Column) -> Column:
    """Whether a text tells any day, outside of addresses."""
    clean = F.regexp_replace(text, "https?://\\S+", " ")
    patterns = ("[0-9]{4}-[0-9]{2}-[0-9]{2}", f"{_LEFT}[0-9]{{1,2}}\\s*[./-]\\s*[0-9]{{1,2}}(?:$|[^A-Za-z0-9_])", f"(?iu){_LEFT}[0-9]{{1,2}}\\s*(?:{MONTH_WORDS})", f"(?iu){_LEFT}(?:{WEEKDAY_WORDS})", f"(?iu){_LEFT}(?:{NEAR_WORDS})")
    out = F.lit(False)
    for p in patterns:
        out = out | clean.rlike(p)
    return out


def keep_founded_dates(events: DataFrame, posts: DataFrame, whole_text: Column) -> DataFrame:
    """Events with a rhythm, or whose post tells a day; without a post the whole text has to. posts: key, post_text."""
    joined = events.join(posts.groupBy("key").agg(F.first("post_text").alias("post_text")), "key", "left")
    good = F.when(F.coalesce(F.col("repeat"), F.lit("")) != "", F.lit(True)).when(F.col("post_text").isNotNull(), has_date_hint(F.col("post_text"))).otherwise(has_date_hint(whole_text))
    return joined.where(good).drop("post_text")


def skip_status(fetch: Column, dead: Column, inactive: Column, muted: Column, blocked: Column, social_ready: Column) -> Column:
    """Why a source isn't visited; 'process' if it is. The first reason that holds counts."""
    return (
        F.when(fetch.startswith("fb") & ~social_ready, "fb-unavailable")
        .when(fetch == "fb_event", "fb_event")
        .when(F.coalesce(dead, F.lit(False)), "dead")
        .when(F.coalesce(inactive, F.lit(False)), "inactive")
        .when(F.coalesce(muted, F.lit(False)), "muted")
        .when(F.coalesce(blocked, F.lit(False)), "blocked")
        .otherwise("process")
    )


def search(events: DataFrame, query: str, title: Column, rest: Column) -> DataFrame:
    """Events that hold all words, with a score: 3 if the title has all and begins with the first, 2 if it has all, else 1."""
    from gleanery.functions.text import fold

    words = F.filter(F.split(fold(F.lit(query)), "\\s+"), lambda w: w != "")
    t, r = fold(title), fold(rest)
    found = events.withColumn("_t", t).withColumn("_r", r).where(F.forall(words, lambda w: F.col("_t").contains(w) | F.col("_r").contains(w)))
    score = F.when(F.forall(words, lambda w: F.col("_t").contains(w)), F.when(F.col("_t").startswith(words[0]), 3).otherwise(2)).otherwise(1)
    return found.withColumn("score", score).drop("_t", "_r")
